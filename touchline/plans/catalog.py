"""Catalog: external tables over the lake's Parquet folders, and the views.

DDL text is generated from the StructTypes in ``schemas``. Tables are created
if absent (``CREATE OR REPLACE TABLE … USING PARQUET`` is not supported by
Spark's session catalog). An external partitioned table over existing files
reads zero rows until its partitions are registered: a run that wrote a whole
table recovers them with ``MSCK REPAIR TABLE ... SYNC PARTITIONS`` (which also
drops partitions whose folders are gone); a run that wrote some partitions
registers those alone and lists no other folder. A table that points to
another folder (another lake, or the version a run published before) or has
another schema is dropped and created anew; its files stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators.views import VIEWS, ViewDef
from ..sources.layers import folder_exists, table_path


def qualified(name: str, prefix: str = "") -> str:
    """``layer.table`` -> quoted ``prefixlayer.table``."""
    db, table = name.split(".")
    return f"{schemas.quote(prefix + db)}.{schemas.quote(table)}"


def table_ddl(name: str, location: str, prefix: str = "") -> str:
    schema = schemas.TABLES[name]
    parts = ", ".join(schemas.PARTITION_COLUMNS)
    return (
        f"CREATE TABLE IF NOT EXISTS {qualified(name, prefix)} (\n  {schemas.column_ddl(schema)}\n)\n"
        f"USING PARQUET\nPARTITIONED BY ({parts})\nLOCATION '{_escaped(location)}'"
    )


def _escaped(text: str) -> str:
    """Text inside a SQL string literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _same_table(spark: SparkSession, name: str, location: str, prefix: str) -> bool:
    """Whether the catalog's table has this location and this schema."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    wanted = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    rows = spark.sql(f"DESCRIBE FORMATTED {qualified(name, prefix)}").collect()
    stored = next((r.data_type for r in rows if r.col_name == "Location"), "")
    fields = [(f.name, f.dataType) for f in schemas.TABLES[name].fields]
    held = [(f.name, f.dataType) for f in spark.table(qualified(name, prefix)).schema.fields]
    return spark._jvm.org.apache.hadoop.fs.Path(stored).equals(wanted) and held == fields


def view_ddl(view: ViewDef, prefix: str = "") -> str:
    return f"CREATE OR REPLACE VIEW {qualified(view.name, prefix)} AS\n" + view.sql(qualified(view.source, prefix))


#: Partitions that one ALTER TABLE names at most.
PARTITIONS_AT_ONCE = 500


def register_table(spark: SparkSession, name: str, location: str, prefix: str = "",
                   partitions: list[tuple[str, str]] | None = None) -> DataFrame:
    """Create the table if it is absent and register its partitions: all that
    have a folder, or only the (league_code, season) pairs that a run wrote."""
    db = prefix + name.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schemas.quote(db)}")
    held = spark.catalog.tableExists(f"{db}.{name.split('.')[1]}")
    if held and not _same_table(spark, name, location, prefix):
        spark.sql(f"DROP TABLE {qualified(name, prefix)}")  # external: the files stay
        held = False
    spark.sql(table_ddl(name, location, prefix))
    if partitions is None or not held:
        spark.sql(f"MSCK REPAIR TABLE {qualified(name, prefix)} SYNC PARTITIONS")
    else:
        register_partitions(spark, name, location, prefix, partitions)
    return spark.table(qualified(name, prefix))


def register_partitions(spark: SparkSession, name: str, location: str, prefix: str,
                        partitions: list[tuple[str, str]]) -> None:
    """Register the given partitions that have a folder, and drop the entries of those that have none."""
    table = qualified(name, prefix)
    written, gone = [], []
    for code, season in sorted(set(partitions)):
        folder = f"{location.rstrip('/')}/{partition_folder(spark, code, season)}"
        spec = f"PARTITION (league_code = '{_escaped(code)}', season = '{_escaped(season)}')"
        (written if folder_exists(spark, folder) else gone).append((spec, folder))
    for at in range(0, len(written), PARTITIONS_AT_ONCE):
        some = " ".join(f"{spec} LOCATION '{_escaped(folder)}'" for spec, folder in written[at:at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
    for at in range(0, len(gone), PARTITIONS_AT_ONCE):
        some = ", ".join(spec for spec, _ in gone[at:at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {some}")
    spark.catalog.refreshTable(table)


def partition_folder(spark: SparkSession, code: str, season: str) -> str:
    """The folder Spark's writer gives a partition (special characters escaped)."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"league_code={escape(code)}/season={escape(season)}"


def drop_lake(spark: SparkSession, prefix: str) -> None:
    """Drop the databases of a prefix with their views and table entries; external files stay."""
    if not prefix:
        raise ValueError("drop_lake needs a database prefix")
    names = {n.split(".")[0] for n in schemas.TABLES} | {v.name.split(".")[0] for v in VIEWS}
    for name in sorted(names):
        spark.sql(f"DROP DATABASE IF EXISTS {schemas.quote(prefix + name)} CASCADE")


def register_lake(spark: SparkSession, lake_root: str, prefix: str = "", tables: tuple[str, ...] = tuple(schemas.TABLES),
                  partitions: list[tuple[str, str]] | None = None) -> list[str]:
    """Create-if-absent every table over its published folder with its partitions, then (re)create the views."""
    for name in tables:
        register_table(spark, name, table_path(spark, lake_root, name), prefix, partitions)
    for view in VIEWS:
        if view.source in tables:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {schemas.quote(prefix + view.name.split('.')[0])}")
            spark.sql(view_ddl(view, prefix))
    return [qualified(n, prefix) for n in tables]
