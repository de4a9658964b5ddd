"""Landing: season calendar, ingest manifest, landing check and summary.

Downloading is not rebuilt (no network); landed files are the input. The
manifest says which (league, season) files are expected, the check says which
of them landed with content.

Layout of landed files, under ``<landing>/_runs/<run_id>/``:

* ``<league_name>/<season>.csv`` (one file per league and season), or
* ``league_name=<league_name>/season=<season>/<part>.csv`` as Spark's own
  partitioned CSV writer lays it out.

League name and season are read from the path in both layouts.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import season_code, season_start_year
from ..session import let_workers_import

# The path patterns for league folder and season file stem.
LEAGUE_FROM_PATH = r"([^/\\]+)[/\\][^/\\]+\.csv$"
SEASON_FROM_PATH = r"([^/\\]+)\.csv$"
HIVE_LEAGUE = r"league_name=([^/\\]+)[/\\]"
HIVE_PLACE = r"^(.*league_name=[^/\\]+[/\\]season=[^/\\]+)[/\\][^/\\]+$"
HIVE_SEASON = r"season=([^/\\]+)[/\\]"


def run_folder(landing_root: str, run_id: str) -> str:
    return f"{landing_root.rstrip('/')}/_runs/{run_id}"


def _percent_decoded(text: Column) -> Column:
    """``%XX`` escapes of a file URI decoded (``premier%20league`` ->
    ``premier league``). Spark's ``url_decode`` is form decoding, so a literal
    ``+`` is protected first; text that does not decode is kept as is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def league_name_from_path(path: Column) -> Column:
    """League folder name of a landed file (``_metadata.file_path`` is a
    URI, so escapes are decoded)."""
    hive = F.regexp_extract(path, HIVE_LEAGUE, 1)
    return _percent_decoded(F.when(hive != "", hive).otherwise(F.regexp_extract(path, LEAGUE_FROM_PATH, 1)))


def season_from_path(path: Column) -> Column:
    hive = F.regexp_extract(path, HIVE_SEASON, 1)
    return _percent_decoded(F.when(hive != "", hive).otherwise(F.regexp_extract(path, SEASON_FROM_PATH, 1)))


# --- S1 season calendar ------------------------------------------------------

def season_calendar(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    """One row per season from ``start_year`` to ``end_year`` inclusive."""
    if start_year > end_year:
        raise ValueError(f"start_year {start_year} is after end_year {end_year}")
    years = spark.range(start_year, end_year + 1, numPartitions=1).select(F.col("id").cast("int").alias("season_start_year"))
    return years.select("season_start_year", season_code("season_start_year").alias("season"))


def observed_calendar(matches: DataFrame, season_col: str = "season") -> DataFrame:
    """Calendar spanning the seasons present in ``matches`` (gaps included).

    One partial/final aggregate to a single (min, max) row, then a generator:
    no join and no driver round trip.
    """
    years = season_start_year(season_col)
    bounds = matches.agg(F.min(years).alias("lo"), F.max(years).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("season_start_year")).select(
        "season_start_year", season_code("season_start_year").alias("season"))


# --- S2 ingest manifest ------------------------------------------------------

def ingest_manifest(leagues: DataFrame, first_year: Column | int, last_year: Column | int,
                    run_root: str) -> DataFrame:
    """Leagues x seasons with the expected landing path.

    Seasons are generated per league row (``explode(sequence)``), so this is a
    generator over the small league dimension, not a join. ``first_year`` and
    ``last_year`` may be literals or scalar subqueries over data.
    """
    if isinstance(first_year, int) and isinstance(last_year, int) and first_year > last_year:
        raise ValueError(f"first_year {first_year} is after last_year {last_year}")
    lo = F.lit(first_year) if isinstance(first_year, int) else first_year
    hi = F.lit(last_year) if isinstance(last_year, int) else last_year
    # a descending range over data is an error too, not a sequence that counts down
    hi = F.when(lo > hi, F.raise_error(F.lit("first_year is after last_year")).cast("int")).otherwise(hi)
    per_league = leagues.select("league_code", "league_name", F.explode(F.sequence(lo, hi)).alias("season_start_year"))
    season = season_code("season_start_year")
    return per_league.select(
        "league_code", "league_name", season.alias("season"),
        F.concat(F.lit(run_root.rstrip("/") + "/"), F.col("league_name"), F.lit("/"), season, F.lit(".csv")).alias("path"),
    )


# --- S3 landing check --------------------------------------------------------

#: Bytes of a landed file that are read at a time until its first line is whole.
HEAD_BYTES = 1 << 16
BLANKS = bytes(range(33))
_LINE_END = re.compile(rb"[\r\n]")
_GLOB_CHARS = re.compile(r"([\\{}\[\]*?])")

LANDED_SCHEMA = "file_path string, header string, columns array<string>"


def header_columns(header: str) -> list[str]:
    """CSV header line -> non-empty column names, unique without regard to case.

    A repeated name gets the first free ``_1``, ``_2`` ... behind it.
    """
    names = [raw.strip() or f"_c{i}" for i, raw in enumerate(next(csv.reader(io.StringIO(header)), []))]
    given = {name.lower() for name in names}
    used: set[str] = set()
    out = []
    for name in names:
        unique, n = name, 0
        while unique.lower() in used or (n and unique.lower() in given):
            n += 1
            unique = f"{name}_{n}"
        used.add(unique.lower())
        out.append(unique)
    return out


def first_line(file) -> str | None:
    """The first line with a character above U+0020, without byte order mark; None if there is none.

    Reads on only until that line is whole. What the CSV reader skips as blank is skipped here.
    """
    held, piece = b"", file.read(HEAD_BYTES).removeprefix(b"\xef\xbb\xbf")
    while piece:
        held = (held + piece).lstrip(BLANKS)
        end = _LINE_END.search(held)
        if end:
            held = held[:end.start()]
            break
        piece = file.read(HEAD_BYTES)
    return held.decode("utf-8", "replace") if held else None


@lru_cache
def _store(scheme: str, host: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(f"{scheme}://{host}/")[0]


def opened(uri: str):
    """The file of a ``_metadata.file_path`` (``file:/x`` or ``scheme://host/x``, escapes encoded) as a stream of bytes."""
    place = urlsplit(uri)
    full = f"{place.scheme}://{place.netloc}{place.path}"
    return _store(place.scheme, place.netloc).open_input_stream(fs.FileSystem.from_uri(full)[1])


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_path, header, columns) of the files of a batch that have a header."""
    for batch in batches:
        found = []
        for uri in batch.column("file_path").to_pylist():
            with opened(uri) as file:
                header = first_line(file)
            if header is not None:
                found.append((uri, header, header_columns(header)))
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                          pa.array(columns[2], pa.list_(pa.string()))], ["file_path", "header", "columns"])


def folder_path(path: str) -> str:
    """A folder's name as the file readers accept it (they expand globs)."""
    return _GLOB_CHARS.sub(r"\\\1", path)


def readable_path(file_uri: str) -> str:
    """A ``_metadata.file_path`` URI as a path the file readers accept: escapes
    decoded (``%20`` -> space) and glob characters escaped."""
    return folder_path(unquote(file_uri))


def landed_headers(spark: SparkSession, run_root: str) -> DataFrame:
    """The file dimension of a run: ``(file_path, header, columns, league_name, season)`` for every
    landed CSV file that has a non-blank line.

    Spark lists the folder (names and lengths only, spread over tasks); each
    task reads the heads of its files up to the first non-blank line, so the
    cost grows with the files and not with their bytes. League and season come
    from the path, once a file. Empty or blank files yield no row, and a run
    folder that does not exist yields no rows. The folder must be one that
    ``pyarrow.fs`` opens (file, HDFS, S3, GCS).
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_root)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        let_workers_import(spark)
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
                 .load(folder_path(run_root)).select(F.col("_metadata.file_path").alias("file_path"), "length"))
        heads = files.mapInArrow(_heads, LANDED_SCHEMA)
    else:
        heads = spark.createDataFrame([], LANDED_SCHEMA)
    return with_path_keys(heads)


def with_path_keys(files: DataFrame, path: str = "file_path") -> DataFrame:
    """A row per file, with the ``league_name`` and ``season`` its path names."""
    return files.withColumns({"league_name": league_name_from_path(F.col(path)), "season": season_from_path(F.col(path))})


def landing_results(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows with ``success`` and ``message``; ``path`` is where the file landed (the season's
    folder in Spark's layout, the first by name of several places), or where it was expected if none did.

    ``landed`` has ``file_path``, and ``league_name`` and ``season`` where they
    are known already. A task succeeds when at least one non-blank file landed
    for its league and season. Both sides are bounded by the number of
    (league, season) files, so AQE plans the join from runtime sizes.
    """
    if "league_name" not in landed.columns:
        landed = with_path_keys(landed)
    # a set of at most one place a layout: hashed, where the minimum of a text column would sort
    place = F.regexp_replace("file_path", HIVE_PLACE, "$1")
    present = landed.groupBy("league_name", "season").agg(F.array_min(F.collect_set(place)).alias("landed_path"))
    joined = manifest.join(present, ["league_name", "season"], "left")
    ok = F.col("landed_path").isNotNull()
    return joined.select(
        "league_code", "league_name", "season", F.coalesce("landed_path", "path").alias("path"), ok.alias("success"),
        F.when(ok, F.concat(F.lit("landed "), F.col("league_code"), F.lit(" season "), F.col("season")))
        .otherwise(F.concat(F.lit("no data for "), F.col("league_code"), F.lit(" season "), F.col("season")))
        .alias("message"),
    )


# --- S4 / S5 -----------------------------------------------------------------

def successful(results: DataFrame) -> DataFrame:
    return results.where("success")


def ingest_summary(results: DataFrame) -> DataFrame:
    """(successes, total) in one row."""
    return results.agg(F.count_if(F.col("success")).alias("successes"), F.count(F.lit(1)).alias("total"))
