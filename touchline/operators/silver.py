"""Bronze (raw text) -> silver (one typed row per match).

A single narrow projection plus a filter: no shuffle, and the NOT NULL key
filter reaches the Parquet scan (team columns) and the partition filter
(league_code, season) when bronze is read from the lake.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.parsing import lenient_int, match_date, season_start_year

REQUIRED_KEYS = ("home_team", "away_team", "league_code", "season")


def conform_bronze(frame: DataFrame) -> DataFrame:
    """Any raw frame -> the bronze layout.

    The 50 known columns are cast to STRING, absent ones become typed NULLs;
    every other landed column (odds of other bookmakers, …) is kept by name in
    the map ``extra_columns``, where it has a value.
    """
    present = set(frame.columns)
    known = {f.name for f in schemas.BRONZE.fields}
    text = [(F.col(schemas.quote(f.name)).cast("string") if f.name in present else F.lit(None).cast("string")).alias(f.name)
            for f in schemas.BRONZE.fields if f.name != schemas.EXTRA]
    pairs = [part for c in frame.columns if c not in known for part in (F.lit(c), F.col(schemas.quote(c)).cast("string"))]
    if schemas.EXTRA in present:
        extra = F.col(schemas.EXTRA)
    elif pairs:
        extra = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    else:
        extra = F.create_map().cast("map<string,string>")
    return frame.select(*text, extra.alias(schemas.EXTRA)).select(*schemas.BRONZE.names)


def _raw(frame: DataFrame, name: str) -> Column:
    """Raw column, or a NULL when an older file layout lacks it."""
    return F.col(schemas.quote(name)) if name in frame.columns else F.lit(None).cast("string")


def typed_match_columns(bronze: DataFrame) -> list[Column]:
    """The 23 silver columns as expressions over raw bronze columns."""
    side_stats = []
    for home_raw, away_raw, stem in schemas.SIDE_STATS:
        side_stats += [lenient_int(_raw(bronze, home_raw)).alias(f"home_{stem}"),
                       lenient_int(_raw(bronze, away_raw)).alias(f"away_{stem}")]
    return [
        season_start_year("season").alias("season_start_year"),
        match_date(_raw(bronze, "Date")).alias("match_date"),
        _raw(bronze, "HomeTeam").alias("home_team"),
        _raw(bronze, "AwayTeam").alias("away_team"),
        F.coalesce(lenient_int(_raw(bronze, "FTHG")), F.lit(0)).alias("full_time_home_goals"),
        F.coalesce(lenient_int(_raw(bronze, "FTAG")), F.lit(0)).alias("full_time_away_goals"),
        lenient_int(_raw(bronze, "HTHG")).alias("half_time_home_goals"),
        lenient_int(_raw(bronze, "HTAG")).alias("half_time_away_goals"),
        F.coalesce(_raw(bronze, "FTR"), F.lit("U")).alias("full_time_result"),
        *side_stats,
        F.col("league_code").cast("string").alias("league_code"),
        F.col("season").cast("string").alias("season"),
    ]


def required_keys_present() -> Column:
    return F.expr(" AND ".join(f"{k} IS NOT NULL" for k in REQUIRED_KEYS))


def silver_matches(bronze: DataFrame) -> DataFrame:
    """Typed match rows; rows missing a team, league code or season are dropped."""
    return bronze.select(*typed_match_columns(bronze)).where(required_keys_present())


def rejected_matches(bronze: DataFrame) -> DataFrame:
    """Bronze rows that silver drops, with the reason (for data-quality counts)."""
    reason = (
        F.when(_raw(bronze, "HomeTeam").isNull(), "missing home_team")
        .when(_raw(bronze, "AwayTeam").isNull(), "missing away_team")
        .when(F.col("league_code").isNull(), "unknown league")
        .when(F.col("season").isNull(), "missing season")
    )
    return bronze.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
