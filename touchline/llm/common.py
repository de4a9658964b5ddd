"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import let_workers_import, scratch_path

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Tasks that a list of work items is spread over at most.
MOST_TASKS = 20_000

#: Parts that the rows of one key are dealt into where its totals go back to them.
SALTS = 1024

#: The characters that part words: space and U+0009 to U+000D.
WORD_GAPS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table. Python workers are told where this package lies, for
    sessions started from another folder (a cluster installs the package)."""
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` as Parquet into the shared folder and read it back.

    The result no longer depends on the steps before it: a lost executor costs
    a reread and not a recomputation, and the shuffle files of the steps before
    are dropped as soon as the table is written. The table is removed when the
    session's file system closes.
    """
    spark = frame.sparkSession
    let_workers_import(spark)
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """``(row, whole)``: the rows of ``docs`` as one struct each, under a number that every job gives alike.

    Rows of a Parquet table are numbered by their file and their place in it,
    which do not depend on how a scan is split (that follows from the cores at
    hand when a job is planned, so it changes when executors come or go). The
    number is a hash of the file's path, in a number of bits and with a salt for
    which no two files share one, above the place in the file. Rows of anything
    but a plain Parquet scan are written once with their number.
    """
    let_workers_import(docs.sparkSession)
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("whole")
    plan = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
    paths = docs.inputFiles() if plan == "LogicalRelation" else []
    if not paths or not all(p.endswith(".parquet") for p in paths):
        return cut(docs.select(F.monotonically_increasing_id().alias("row"), whole), "numbered")
    bits = max(31, 2 * len(paths).bit_length() + 2)
    prefix = next(s for s in map(str, range(1000)) if len({_file_code(s, p, bits) for p in paths}) == len(paths))
    place = docs.metadataColumn("_metadata")
    path = F.regexp_replace(place["file_path"], _SCHEME, "")  # file:/x and file:///x are one path
    code = F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(prefix), path)), 64 - bits)
    many = F.raise_error(F.lit(f"more than {1 << (63 - bits)} rows in a file")).cast("long")
    inside = F.when(place["row_index"] >= F.lit(1 << (63 - bits)), many).otherwise(place["row_index"])
    return docs.select((F.shiftleft(code, 63 - bits) + inside).alias("row"), whole)


_SCHEME = "^[^:/]*:/*"


def _file_code(prefix: str, path: str, bits: int) -> int:
    return xxhash.xxh64_intdigest((prefix + re.sub(_SCHEME, "", path)).encode(), 42) >> (64 - bits)


def before_each(frame: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``frame`` with ``place`` (its row's number, from 0, in the given order) and, under each name, the sum over
    the rows before it. Rows are dealt by range; only a row per range passes one task."""
    given = {f"by_{i}": c for i, c in enumerate(order)}
    added = {f"add_{name}": c for name, c in sums.items()}
    dealt = frame.withColumns(given | added | {"one": F.lit(1).cast("long")})
    dealt = cut(dealt.repartitionByRange(*given).withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(*given).rowsBetween(Window.unboundedPreceding, -1)
    names = {"place": "one", **{name: f"add_{name}" for name in sums}}
    rows = dealt.withColumns({f"in_{name}": F.sum(column).over(inside) for name, column in names.items()})
    parts = dealt.groupBy(F.col("part").alias("of_part")).agg(*[F.sum(column).alias(f"own_{name}") for name, column in names.items()])
    earlier = Window.partitionBy(F.lit(0)).orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("of_part", *[F.sum(f"own_{name}").over(earlier).alias(f"pre_{name}") for name in names])
    joined = rows.join(parts, F.col("part") == F.col("of_part"))
    return joined.select(*frame.columns, *[
        (F.coalesce(f"in_{name}", F.lit(0)) + F.coalesce(f"pre_{name}", F.lit(0))).alias(name) for name in names])


def discard(frame: DataFrame) -> None:
    """Remove the files of a table that :func:`cut` wrote and that no later step reads."""
    spark = frame.sparkSession
    for folder in {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spread(work: DataFrame, *order: str) -> DataFrame:
    """Work items (a short row each, much work behind it) over as many tasks as
    there are items, up to ``MOST_TASKS``. Without a number, adaptive execution
    would merge such short rows into one task."""
    return work.repartitionByRange(max(1, min(work.count(), MOST_TASKS)), *order)


def is_empty(frame: DataFrame) -> bool:
    return not frame.take(1)


def salt(*columns: str) -> Column:
    """A number below ``SALTS`` that deals the rows of one key out evenly."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def shared_totals(rows: DataFrame, keys: tuple[str, ...], totals: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``rows`` (which hold a stored ``salt``) with totals over each key's rows as further columns.

    A total is a pair: the aggregate over rows and the one that merges its
    parts. Parts are taken by (key, salt), merged by key and handed back by
    (key, salt), so a key that holds most rows is dealt over all salts both
    ways. Null keys are keys like any other.
    """
    parts = rows.groupBy(*keys, "salt").agg(*[first.alias(name) for name, (first, _) in totals.items()])
    whole = parts.groupBy(*keys).agg(*[merge.alias(name) for name, (_, merge) in totals.items()])
    whole = whole.select(*[F.col(k).alias(f"of_{k}") for k in keys], *totals)
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    parts = parts.select(*keys, "salt").join(whole, on=reduce(and_, same))
    parts = parts.select(*[f"of_{k}" for k in keys], F.col("salt").alias("of_salt"), *totals)
    handed = rows.join(parts, on=reduce(and_, [*same, F.col("salt") == F.col("of_salt")]))
    return handed.select(*rows.columns, *totals)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge table ``(a, b)`` of longs.

    Returns ``(node, root)`` for every node that has an edge; ``root`` is the
    smallest node that can be reached. Each round takes the smallest root among
    a node's neighbours and then jumps to the root's own root, so a chain
    halves each round. Rows stay in Spark tables throughout; only the count of
    changed nodes reaches the driver.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
               "edges")
    held = roots = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = (both.join(roots, both.b == roots.node).groupBy(F.col("a").alias("near"))
                .agg(F.min("root").alias("seen")))
        lower = roots.join(near, roots.node == near.near).select("node", "root", F.least("root", "seen").alias("low"))
        lower = cut(lower, "low")
        ahead = lower.select(F.col("node").alias("low_node"), F.col("low").alias("jump"))
        step = cut(lower.join(ahead, F.col("low") == F.col("low_node"))
                   .select("node", F.least("low", "jump").alias("next"), "root"), "step")
        roots = step.select("node", F.col("next").alias("root"))
        discard(lower)
        discard(held)
        held = step
        if is_empty(step.where(F.col("next") != F.col("root"))):
            discard(both)
            return roots
