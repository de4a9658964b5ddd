"""Layer paths and Parquet I/O for the lake's tables.

Every table is Parquet partitioned by (league_code, season). Reads always
pass the table's schema, so partition values keep their text form (``0001``
stays ``0001``; inference would turn it into the integer 1).

A full overwrite never touches the rows it replaces: it writes a new version
folder (``_versions/<version>/<layer>/<table>``), and publishing makes it the
table's folder by one small file, ``_published/<number>.json`` (table ->
version), which appears under its name only when whole. The greatest number
holds. A table that no such file names lies in ``<layer>/<table>``. A run that
breaks anywhere before leaves the last run's rows readable; what it wrote goes
with the next :func:`prune`. One run at a time writes to a lake.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..session import write_conf

LAYER_TABLES = {
    "bronze.matches": ("bronze", "matches"),
    "silver.matches": ("silver", "matches"),
    "gold.team_season_table": ("gold", "team_season_table"),
    "gold.league_season_summary": ("gold", "league_season_summary"),
}


def layer_path(lake_root: str, table: str) -> str:
    """``<lake_root>/<layer>/<table>``; writer and catalog use the same path."""
    layer, name = LAYER_TABLES[table]
    return f"{lake_root.rstrip('/')}/{layer}/{name}"


VERSIONS, PUBLISHED = "_versions", "_published"


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def _pointers(spark: SparkSession, lake_root: str) -> list[str]:
    return [n for n in _names(spark, f"{lake_root.rstrip('/')}/{PUBLISHED}") if n.endswith(".json") and n[:-5].isdigit()]


def published(spark: SparkSession, lake_root: str) -> dict[str, str]:
    """Table -> version of every table that has one."""
    numbered = _pointers(spark, lake_root)
    if not numbered:
        return {}
    files, path = _folder(spark, f"{lake_root.rstrip('/')}/{PUBLISHED}/{max(numbered)}")
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def new_version(run_id: str) -> str:
    return f"{run_id}-{uuid.uuid4().hex[:8]}"


def version_root(lake_root: str, version: str | None) -> str:
    """Where a version's tables lie; the lake itself for tables without one."""
    return f"{lake_root.rstrip('/')}/{VERSIONS}/{version}" if version else lake_root


def table_path(spark: SparkSession, lake_root: str, table: str, version: str | None = None) -> str:
    """The folder of a table: of the given version, or of the published one."""
    return layer_path(version_root(lake_root, version or published(spark, lake_root).get(table)), table)


def publish(spark: SparkSession, lake_root: str, version: str, tables: list[str]) -> None:
    """Make ``version`` the published one of ``tables``, all at once."""
    numbered = _pointers(spark, lake_root)
    number = int(max(numbered)[:-5]) + 1 if numbered else 1
    held = published(spark, lake_root) | dict.fromkeys(tables, version)
    root = f"{lake_root.rstrip('/')}/{PUBLISHED}"
    files, draft = _folder(spark, f"{root}/.{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        stream.write(bytearray(json.dumps(held, sort_keys=True).encode()))
    finally:
        stream.close()
    if not files.rename(draft, _folder(spark, f"{root}/{number:012d}.json")[1]):
        raise RuntimeError(f"another run published to {lake_root} at the same time")


def prune(spark: SparkSession, lake_root: str) -> None:
    """Remove what no table's published version holds: replaced tables, and versions of broken runs."""
    held = published(spark, lake_root)
    for table in held:
        remove_folder(spark, layer_path(lake_root, table))
    for version in _names(spark, f"{lake_root.rstrip('/')}/{VERSIONS}"):
        root = version_root(lake_root, version)
        if version not in held.values():
            remove_folder(spark, root)
            continue
        for table in LAYER_TABLES:
            if held.get(table) != version:
                remove_folder(spark, layer_path(root, table))
    for name in _pointers(spark, lake_root)[:-1]:
        remove_folder(spark, f"{lake_root.rstrip('/')}/{PUBLISHED}/{name}")


def write_layer(frame: DataFrame, path: str, *, rebalance: bool = True, dynamic: bool = False,
                partition_by: tuple[str, ...] = schemas.PARTITION_COLUMNS) -> str:
    """Overwrite a partitioned Parquet table.

    ``rebalance`` adds a REBALANCE on the partition columns before the write:
    rows of one (league, season) meet in few tasks, so each partition gets few
    files, and AQE splits a partition that holds a large share of the rows
    over several tasks instead of one. Skip it when the input is already laid
    out by partition (a scan of a table partitioned the same way).
    ``dynamic`` replaces only the partitions present in ``frame``.
    """
    out = frame.hint("rebalance", *partition_by) if rebalance else frame
    with write_conf(frame.sparkSession):
        (out.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
         .partitionBy(*partition_by)
         .parquet(path))
    return path


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Partitioned Parquet read with a fixed schema (partition pruning applies)."""
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, lake_root: str, table: str, version: str | None = None) -> DataFrame:
    """A table of the lake: the given version, or the published one."""
    return read_layer(spark, table_path(spark, lake_root, table, version), schemas.TABLES[table])
