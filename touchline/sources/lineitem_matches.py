"""Raw match rows derived from the driver's ``lineitem`` table.

No match files are available offline, so the test and bench input is a
deterministic mapping of every ``lineitem`` row to one landed match row, in the
bronze text layout (FIXTURES.md F6). It deliberately carries three date
formats, seasons on both sides of 2000, NULL home teams, non-numeric goals,
empty strings, NULL shots and missing results.

The mapping is a single narrow projection: it scans six ``lineitem`` columns
and never shuffles, so it scales with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Supplier key modulo 4 -> (league code, league folder name).
LEAGUE_BY_SUPPLIER = (
    ("E0", "england_premier_league"),
    ("SP1", "spain_la_liga"),
    ("I1", "italy_serie_a"),
    ("D1", "germany_bundesliga_1"),
)
RUN_ID = "run0"
SOURCE_PREFIX = "file:///landing/_runs/run0/"

LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")


def read_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six ``lineitem`` columns the mapping needs (pruned at the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*LINEITEM_COLUMNS)


def _by_supplier(index: int) -> str:
    """SQL CASE over the supplier key: the league code (0) or folder name (1)."""
    arms = " ".join(f"WHEN {i} THEN '{pair[index]}'" for i, pair in enumerate(LEAGUE_BY_SUPPLIER))
    return f"CASE l_suppkey % {len(LEAGUE_BY_SUPPLIER)} {arms} END"


def _two(expr: str) -> str:
    return f"lpad(CAST({expr} AS STRING), 2, '0')"


def _team(expr: str) -> str:
    return f"concat('T', {_two(expr)})"


# The mapping in SQL text (FIXTURES.md F6 in Spark's dialect): three narrow
# projections, parsed once on the JVM instead of built from a few hundred
# Column calls through the Python gateway.
_KEYS = (
    "l_orderkey AS ok", "l_partkey AS pk", "l_suppkey AS sk", "l_linenumber AS ln",
    "CAST(l_quantity AS INT) % 5 AS hg",
    "CAST(l_partkey % 4 AS INT) AS ag",
    f"{_two('day(l_shipdate)')} AS dd",
    f"{_two('month(l_shipdate)')} AS mm",
    "CAST(year(l_shipdate) AS STRING) AS yyyy",
    "CASE WHEN month(l_shipdate) >= 7 THEN year(l_shipdate) ELSE year(l_shipdate) - 1 END AS sy",
    f"{_by_supplier(1)} AS league_name",
    f"{_by_supplier(0)} AS league_code",
)
_SEASON = "concat(substring(CAST(sy AS STRING), 3, 2), substring(CAST(sy + 1 AS STRING), 3, 2)) AS season"
_NO_SHOTS = "pk % 11 = 0"
_ROW = (
    f"'{RUN_ID}' AS ingestion_run_id",
    f"concat('{SOURCE_PREFIX}', league_name, '/', season, '.csv') AS source_file",
    "league_name",
    "league_code AS `Div`",
    "CASE WHEN ok % 3 = 0 THEN concat_ws('/', dd, mm, substring(yyyy, 3, 2)) "
    "WHEN ok % 3 = 1 THEN concat_ws('/', dd, mm, yyyy) ELSE concat_ws('-', yyyy, mm, dd) END AS `Date`",
    f"CASE WHEN ok % 101 <> 0 THEN {_team('pk % 20')} END AS `HomeTeam`",
    f"{_team('(pk % 20 + 1 + ok % 19) % 20')} AS `AwayTeam`",
    "CASE WHEN ok % 53 = 0 THEN 'x' ELSE CAST(hg AS STRING) END AS `FTHG`",
    "CAST(ag AS STRING) AS `FTAG`",
    "CASE WHEN ok % 53 <> 0 THEN CASE WHEN hg > ag THEN 'H' WHEN hg < ag THEN 'A' ELSE 'D' END END AS `FTR`",
    "CASE WHEN ln <> 7 THEN CAST(least(hg, CAST(ok % 3 AS INT)) AS STRING) END AS `HTHG`",
    "CASE WHEN ln = 7 THEN '' ELSE CAST(least(ag, CAST(sk % 3 AS INT)) AS STRING) END AS `HTAG`",
    # padded, decimal, suffixed and exponent texts reach the integer parse
    f"CASE WHEN NOT ({_NO_SHOTS}) THEN concat(CASE WHEN ok % 41 = 0 THEN ' ' ELSE '' END, "
    "CAST(hg + sk % 4 + pk % 9 AS STRING), CASE WHEN ok % 41 = 0 THEN ' ' WHEN ok % 43 = 0 THEN '.0' "
    "WHEN ok % 47 = 0 THEN 'd' WHEN ok % 59 = 0 THEN 'e2' WHEN ok % 61 = 0 THEN '.7' ELSE '' END) END AS `HS`",
    f"CASE WHEN NOT ({_NO_SHOTS}) THEN CAST(ag + sk % 4 + ok % 8 AS STRING) END AS `AS`",
    f"CASE WHEN NOT ({_NO_SHOTS}) THEN CAST(hg + sk % 4 AS STRING) END AS `HST`",
    f"CASE WHEN NOT ({_NO_SHOTS}) THEN CAST(ag + sk % 4 AS STRING) END AS `AST`",
    "CAST(ok % 9 AS STRING) AS `HC`",
    "CAST(pk % 8 AS STRING) AS `AC`",
    "CAST(8 + ok % 7 AS STRING) AS `HF`",
    "CAST(8 + sk % 7 AS STRING) AS `AF`",
    "CAST(ln % 4 AS STRING) AS `HY`",
    "CAST(ok % 5 AS STRING) AS `AY`",
    "CASE WHEN ok % 17 = 0 THEN '1' ELSE '0' END AS `HR`",
    "CASE WHEN pk % 23 = 0 THEN '1' ELSE '0' END AS `AR`",
    "league_code",
    "season",
)


def raw_matches(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` -> raw match rows (all STRING, bronze names)."""
    keyed = lineitem.selectExpr(*_KEYS).selectExpr("*", _SEASON)
    return keyed.selectExpr(*_ROW)


def load_raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_matches(read_lineitem(spark, sf_dir))
