"""Session construction and the shared scratch location.

Operators never build or stop a session; they take the caller's. The helpers
here are for entry points (jobs, bench, tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# HotSpot options: JIT-compile Spark's large generated methods, and room for
# the compiled code of many generated classes in a long-lived JVM.
JIT_OPTIONS = "-XX:-DontCompileHugeMethods -XX:ReservedCodeCacheSize=512m"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DEBUG_CONF = "spark.python.sql.dataFrameDebugging.enabled"


def build_session(master: str | None = None, app_name: str = "touchline",
                  shuffle_partitions: int | None = None, extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE on, UI off and a UTC session clock.

    On a cluster ``master`` is left to spark-submit. ``shuffle_partitions`` is
    only an upper bound: AQE coalesces small shuffle partitions and splits
    skewed ones at run time. Static settings (JVM options, the codegen class
    cache) take effect only when this call creates the session; an existing
    session is reused as it is.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        # PySpark 4 sends the Python call site of every Column/function call
        # to the JVM (4-5 extra gateway round trips each); building the gold
        # plan alone took over 7,000 round trips. Off, plans are built 2-3x
        # faster; analysis errors then lack the Python line. Pass
        # extra_conf={DEBUG_CONF: "true"} to get it back while debugging.
        .config(DEBUG_CONF, "false")
        # Compiled generated classes kept per JVM, by source text. With the
        # default 100 a session running the pipeline's queries evicted and
        # re-compiled (and re-JITted) its own code every round: warm rounds of
        # the bench took 34 s against 23.5 s with room for 2000 (measured).
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    # Whole-stage codegen fuses a layer's ~25 parse expressions into one
    # method larger than HotSpot's 8 KB JIT limit; without the first flag that
    # method runs interpreted (3x slower on silver). The flags are appended to
    # the site's own JVM options (spark-submit's settings when launched
    # through it), never replacing them or a value the site set itself.
    known = SparkConf()
    for key in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        builder = builder.config(key, with_jit_option(known.get(key, None)))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def with_jit_option(existing: str | None) -> str:
    """The site's own JVM options plus each of :data:`JIT_OPTIONS` whose flag
    the site does not set already."""
    existing = (existing or "").strip()
    added = [opt for opt in JIT_OPTIONS.split() if _flag_name(opt) not in map(_flag_name, existing.split())]
    return " ".join([existing, *added]).strip()


def _flag_name(option: str) -> str:
    """``-XX:-DontCompileHugeMethods`` -> ``DontCompileHugeMethods``;
    ``-XX:ReservedCodeCacheSize=512m`` -> ``ReservedCodeCacheSize``."""
    name = option.split("=", 1)[0]
    if name.startswith("-XX:"):
        name = name[4:].lstrip("+-")
    return name


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` as named by the cluster).
    Only where nothing is set and the master is local (tests, the bench) is a
    fresh folder made; on a cluster a machine-local folder would not survive
    a lost executor, so an unset folder is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        sc.setCheckpointDir(shared_folder(configured, sc.master) if configured else _local_only_folder(sc.master))
        return sc.getCheckpointDir()
    if not configured:
        configured = _local_only_folder(spark.conf.get("spark.master", ""))
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def shared_folder(configured: str, master: str) -> str:
    """The configured folder. ``local-cluster`` and local masters may name a
    ``file:`` folder; on any other master executors would not share it."""
    if configured.startswith("file:") and not (master or "").startswith("local"):
        raise ValueError(f"spark.checkpoint.dir {configured} is local to each machine: name a folder that every "
                         "executor and the driver share")
    return configured


def _local_only_folder(master: str) -> str:
    if not (master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that every executor and the "
                         "driver share (HDFS, object store, shared mount)")
    return tempfile.mkdtemp(prefix="touchline-ckpt-")


def let_workers_import(spark: SparkSession) -> None:
    """Tell Python workers where this package lies, for sessions started from
    another folder (a cluster installs the package)."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder; what is written
    there goes when the session's file system closes."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return remove_at_exit(spark, f"{root}/touchline/{name}-{uuid.uuid4().hex[:12]}")


#: Settings that hold while a table is written, in sessions that this package did not build too.
WRITE_CONF = {
    # HotSpot does not compile a method of over 8,000 bytes unless JIT_OPTIONS are set; a layer's parse
    # expressions then run interpreted. Plans with such a method run in smaller ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task keeps a file open for each partition it meets, up to this number (only rows of further ones are
    # sorted), instead of sorting all its rows: a Parquet split of 128 MB holds gigabytes of rows.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


@contextmanager
def write_conf(spark: SparkSession) -> Iterator[None]:
    """:data:`WRITE_CONF` for the writes inside; the session's own values come back behind them."""
    before = {key: spark.conf.get(key, None) for key in WRITE_CONF}
    for key, value in WRITE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_table(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet into the shared folder and read back; the
    files go when the session's file system closes."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    with write_conf(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def uri_of(spark: SparkSession, path: str) -> str:
    """``path`` as Spark names it in ``_metadata.file_path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().toString()


def remove_at_exit(spark: SparkSession, path: str) -> str:
    """Have the JVM's file system delete ``path`` when it closes."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return os.fspath(path)
