"""Plan shape: one scan and one exchange for the team table, filters pushed to
the scan, partition pruning, window group limit for the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import gold, silver, views
from touchline.sources.layers import read_layer, write_layer
from touchline.sources.lineitem_matches import load_raw_matches

from helpers import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _silver_table(spark, tmp_dir):
    s = silver.silver_matches(load_raw_matches(spark, SF_SMALL))
    return read_layer(spark, write_layer(s, f"{tmp_dir}/silver"), schemas.SILVER)


def test_team_table_one_scan_one_exchange(spark, tmp_dir):
    plan = _plan(gold.team_season_table(_silver_table(spark, tmp_dir)))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Generate inline" in plan
    assert "partial_sum" in plan


def test_team_table_reads_only_needed_columns(spark, tmp_dir):
    df = gold.team_season_table(_silver_table(spark, tmp_dir))
    scan = [ln for ln in _plan(df).splitlines() if "FileScan parquet" in ln][0]
    assert "match_date" not in scan and "season_start_year" not in scan


def test_silver_filter_pushed_to_bronze_scan(spark, tmp_dir):
    bronze = silver.conform_bronze(load_raw_matches(spark, SF_SMALL))
    path = write_layer(bronze, f"{tmp_dir}/bronze")
    plan = _plan(silver.silver_matches(read_layer(spark, path, schemas.BRONZE)))
    assert "PushedFilters: [IsNotNull(HomeTeam), IsNotNull(AwayTeam)]" in plan
    assert "PartitionFilters: [isnotnull(league_code" in plan


def test_league_filter_prunes_partitions(spark, tmp_dir):
    df = _silver_table(spark, tmp_dir).where(F.col("league_code") == "E0")
    assert "PartitionFilters: [isnotnull(league_code" in _plan(df) and "= E0" in _plan(df)


def test_champions_uses_window_group_limit(spark, tmp_dir):
    champs = views.champions(gold.team_season_table(_silver_table(spark, tmp_dir)))
    assert "WindowGroupLimit" in _plan(champs)


def test_jit_options_are_appended_once_and_never_override_the_site():
    from touchline.session import JIT_OPTIONS, with_jit_option
    assert with_jit_option(None) == JIT_OPTIONS
    assert with_jit_option("-XX:+UseG1GC") == f"-XX:+UseG1GC {JIT_OPTIONS}"
    assert with_jit_option(f"-Xss4m {JIT_OPTIONS}") == f"-Xss4m {JIT_OPTIONS}"
    site = "-XX:ReservedCodeCacheSize=1g -XX:+DontCompileHugeMethods"
    assert with_jit_option(site) == site


def test_registered_queries_read_what_they_need_and_shuffle_once(spark):
    from touchline.plans.queries import REGISTRY
    calendar = _plan(REGISTRY["season_calendar"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_shipdate:" in calendar and "l_orderkey" not in calendar
    assert _plan(REGISTRY["team_season_table"](spark, SF_SMALL)).count("Exchange ") == 1


def test_model_season_bound_prunes_partitions(spark, tmp_dir):
    from touchline.operators.model import match_features
    plan = _plan(match_features(_silver_table(spark, tmp_dir), 1998))
    part = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    # the bound on the derived start year is evaluated over the season folders
    assert "PartitionFilters: [(CASE WHEN (try_cast(substring(season" in part


def test_no_cross_join_nested_loop_or_python_udf_in_any_query(spark):
    """Every registered query (the forest aside: its plan is MLlib's) plans
    without a cartesian product, a nested-loop join or a Python UDF."""
    from touchline.plans.queries import REGISTRY
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
    for name, fn in REGISTRY.items():
        if name == "outcome_model":
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert not [b for b in banned if b in plan], name


def test_silver_job_plan_has_no_shuffle(spark, tmp_dir):
    bronze = silver.conform_bronze(load_raw_matches(spark, SF_SMALL))
    path = write_layer(bronze, f"{tmp_dir}/bronze")
    assert "Exchange" not in _plan(silver.silver_matches(read_layer(spark, path, schemas.BRONZE)))
