"""Landed CSV files -> bronze match rows (all text, with provenance).

Headers drift between seasons (columns appear, and some are inserted in the
middle), and one CSV scan with one header would shift values into wrong
columns. So the files are scanned once *by position*, every column as text, and
the file dimension says for each file which position holds which column: the
values meet it by path and are picked by its positions. The plan is one scan
however many headers and files there are. League, code and season are worked
out in the file dimension, once a file. Only the widest header's length reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.silver import conform_bronze
from ..params import DEFAULT_LEAGUES
from ..session import scratch_table
from .landing import folder_path, header_columns, landed_headers, readable_path, with_path_keys  # noqa: F401 - also named here


def code_of_league(name: Column, leagues: dict[str, str] | None = None) -> Column:
    """League code of a folder name; NULL if unknown. One CASE over the league dictionary."""
    code = F.lit(None).cast("string")
    for known, folder in sorted((leagues or DEFAULT_LEAGUES).items(), reverse=True):
        code = F.when(name == folder, known).otherwise(code)
    return code


def file_dimension(files: DataFrame, path: str = "file_path", leagues: dict[str, str] | None = None) -> DataFrame:
    """A row per file with ``league_name``, ``league_code`` and ``season``.

    An unknown league folder gives a NULL ``league_code`` (rows are kept in
    bronze and dropped by silver).
    """
    keyed = files if "league_name" in files.columns else with_path_keys(files, path)
    return keyed.withColumn("league_code", code_of_league(F.col("league_name"), leagues))


def with_provenance(rows: DataFrame, run_id: str, leagues: dict[str, str] | None = None) -> DataFrame:
    """``rows`` (with their ``source_file``) and the five provenance columns, met by path.

    The paths are parsed once a file; Spark broadcasts the files where their
    size allows it.
    """
    files = file_dimension(rows.select("source_file").distinct(), "source_file", leagues)
    added = ("ingestion_run_id", "league_name", "league_code", "season")
    bare = rows.drop(*added)
    return bare.join(files, "source_file").select(*bare.columns, F.lit(run_id).alias("ingestion_run_id"),
                                                  "league_name", "league_code", "season")


def positions(columns: Column) -> list[Column]:
    """Where a file's header holds the known raw columns (from 1; 0: nowhere), and the names and places of all others."""
    known = F.array(*[F.lit(c) for c in schemas.RAW_MATCH_COLUMNS])
    places = F.transform(F.sequence(F.lit(1), F.size(columns)), lambda i: F.struct(i.alias("at"), F.get(columns, i - 1).alias("name")))
    others = F.filter(places, lambda p: ~F.array_contains(known, p["name"]))
    return [F.transform(known, lambda name: F.array_position(columns, name).cast("int")).alias("known_at"),
            F.transform(others, lambda p: p["name"]).alias("other_names"),
            F.transform(others, lambda p: p["at"]).alias("other_at")]


def read_by_position(spark: SparkSession, run_root: str, width: int) -> DataFrame:
    """``(source_file, cells)``: every row of every landed CSV file of the run, its cells in file order."""
    names = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    scan = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(folder_path(run_root)))
    return scan.select(F.col("_metadata.file_path").alias("source_file"), F.array(*names).alias("cells"))


def bronze_from_landing(spark: SparkSession, run_root: str, run_id: str,
                        leagues: dict[str, str] | None = None, headers: DataFrame | None = None) -> DataFrame | None:
    """All landed files of a run -> bronze rows: the 50 known columns, and every
    other landed column in ``extra_columns``.

    ``headers`` names the files to take (:func:`landing.landed_headers`, or a
    part of it, as a stored table). Returns None when no file with content
    landed (nothing to write).
    """
    headers = headers if headers is not None else scratch_table(landed_headers(spark, run_root), "landed")
    width = headers.agg(F.max(F.size("columns"))).first()[0]
    if not width:
        return None
    files = file_dimension(headers, leagues=leagues).select(
        F.col("file_path").alias("source_file"), *positions(F.col("columns")), "league_name", "league_code", "season")
    # Spark broadcasts the files where their size allows it; the rows are then not shuffled
    rows = read_by_position(spark, run_root, width).join(files, "source_file")
    cell = lambda at: F.get("cells", at - 1)  # noqa: E731 - NULL where the header lacks the column
    raw = [cell(F.get("known_at", F.lit(i))).alias(name) for i, name in enumerate(schemas.RAW_MATCH_COLUMNS)]
    others = F.map_from_arrays("other_names", F.transform("other_at", cell))
    return conform_bronze(rows.select(
        "source_file", F.lit(run_id).alias("ingestion_run_id"), "league_name", "league_code", "season", *raw,
        F.map_filter(others, lambda _, value: value.isNotNull()).alias(schemas.EXTRA)))
