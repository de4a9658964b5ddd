"""Property tests: the Spark parsers against plain-Python models, and the
skew behaviour of partitioned writes."""

from __future__ import annotations

import datetime as dt
import glob
import re
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.functions.parsing import CENTURY_PIVOT, lenient_int, match_date
from touchline.session import local_path
from touchline.sources.layers import write_layer

INT32 = (-(2 ** 31), 2 ** 31 - 1)


def model_int(text):
    """Sign, digits and an optional fraction, which is cut off; exponents and suffixes are no numbers."""
    shape = re.fullmatch(r" *([+-]?\d+)(\.\d*)? *", text or "")
    if not shape:
        return None
    whole = int(shape[1])
    return whole if INT32[0] <= whole <= INT32[1] else None


def model_date(text):
    """dd/MM/yy (century pivot), dd/MM/yyyy or yyyy-MM-dd; impossible dates are None."""
    try:
        if len(text) == 8 and text[2] == text[5] == "/":
            yy = int(text[6:])
            return dt.date(yy + (1900 if yy >= CENTURY_PIVOT else 2000), int(text[3:5]), int(text[:2]))
        if len(text) == 10 and text[2] == text[5] == "/":
            return dt.date(int(text[6:]), int(text[3:5]), int(text[:2]))
        if len(text) == 10 and text[4] == text[7] == "-":
            return dt.date(int(text[:4]), int(text[5:7]), int(text[8:]))
    except ValueError:
        return None
    return None


numeric_text = st.text(alphabet=" 0123456789.-+edDfF", max_size=12)


@settings(max_examples=15, deadline=None)
@given(st.lists(numeric_text, min_size=20, max_size=60))
def test_lenient_int_matches_python_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(lenient_int("v")).collect()]
    assert got == [model_int(v) for v in values]


date_parts = st.tuples(st.integers(0, 32), st.integers(0, 13), st.integers(1900, 2099), st.sampled_from((0, 1, 2)))


def render(day, month, year, form):
    if form == 0:
        return f"{day:02d}/{month:02d}/{year % 100:02d}"
    if form == 1:
        return f"{day:02d}/{month:02d}/{year:04d}"
    return f"{year:04d}-{month:02d}-{day:02d}"


@settings(max_examples=15, deadline=None)
@given(st.lists(date_parts, min_size=20, max_size=60))
def test_match_date_matches_python_model(spark, parts):
    texts = [render(*p) for p in parts]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(match_date("v")).collect()]
    assert got == [model_date(t) for t in texts]


def test_rebalance_splits_a_hot_partition(spark, tmp_dir):
    """One (league, season) holds 90 % of the rows: the rebalance before the
    write lets AQE split it over several tasks (several files) instead of one."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 9, F.lit("E0")).otherwise(F.lit("SP1")).alias("league_code"),
        F.when(F.col("id") % 10 < 9, F.lit("2324")).otherwise((F.col("id") % 7).cast("string")).alias("season"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        path = write_layer(rows, os.path.join(tmp_dir, "skewed"))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    hot = glob.glob(os.path.join(local_path(path), "league_code=E0", "season=2324", "*.parquet"))
    cold = glob.glob(os.path.join(local_path(path), "league_code=SP1", "season=3", "*.parquet"))
    assert len(hot) > 1 and len(cold) >= 1
    assert spark.read.parquet(path).count() == 200_000


_goal = st.one_of(st.none(), st.integers(0, 5).map(str))
_stat = st.one_of(st.none(), st.integers(0, 12).map(str))
_match = st.tuples(
    st.sampled_from(["E0", "SP1"]), st.sampled_from(["9394", "0001"]),
    st.sampled_from(["A", "B", "C", "D"]), st.sampled_from(["A", "B", "C", "D"]),
    _goal, _goal, st.sampled_from(["H", "D", "A", None]), _goal, _goal,
    *[_stat] * 12,
)
_MATCH_COLS = ("league_code season HomeTeam AwayTeam FTHG FTAG FTR HTHG HTAG "
               "HS AS HST AST HC AC HF AF HY AY HR AR").split()


@settings(max_examples=12, deadline=None)
@given(st.lists(_match, min_size=1, max_size=25))
def test_gold_job_path_equals_direct_aggregations(spark, matches):
    """Random seasons with unknown goals, results and stats: the gold job's
    one-pass tables (per-team-and-venue aggregates, team sum, league roll-up
    of home rows) equal the direct aggregations over the matches."""
    from touchline.operators import gold, silver

    raw = spark.createDataFrame(matches, ", ".join(f"`{c}` string" for c in _MATCH_COLS))
    s = silver.silver_matches(raw)
    per_venue = gold.team_venue_aggregates(s)

    def rows(df, key):
        return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}

    lk, tk = ("league_code", "season"), ("league_code", "season", "team")
    assert rows(gold.league_summary_from(per_venue), lk) == rows(gold.league_season_summary(s), lk)
    assert rows(gold.team_table_from(per_venue), tk) == rows(gold.team_season_table(s), tk)
