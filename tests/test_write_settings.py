"""How the lake's tables are written: the rows of a task are not sorted, and no plan has a method too large to compile."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from touchline.operators import model
from touchline.params import RunParams
from touchline.plans import jobs
from touchline.plans.queries import _split_features
from touchline.session import scratch_table
from touchline.sources.layers import layer_path, write_layer
from touchline.sources.lineitem_matches import load_raw_matches
from touchline.operators.silver import conform_bronze, silver_matches

SF = "/root/testdata/sf0.001"
HUGE = "spark.sql.codegen.hugeMethodLimit"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def last_plan(spark) -> str:
    return spark._jsparkSession.sharedState().statusStore().executionsList().last().physicalPlanDescription()


def bronze_lake(spark, tmp_dir) -> RunParams:
    params = RunParams(lake_root=f"{tmp_dir}/lake")
    write_layer(conform_bronze(load_raw_matches(spark, SF)), layer_path(params.lake_root, "bronze.matches"))
    return params


def test_silver_write_holds_no_sorted_rows(spark, tmp_dir):
    params = bronze_lake(spark, tmp_dir)
    jobs.build_silver(spark, params)
    assert "Sort" not in last_plan(spark)


def test_bronze_write_holds_no_sorted_rows(spark, tmp_dir):
    raw = load_raw_matches(spark, SF)
    params = RunParams(lake_root=f"{tmp_dir}/lake", landing_root=f"{tmp_dir}/landing", start_year=1990, end_year=2005)
    jobs.landing_from_rows(raw, f"{tmp_dir}/landing/_runs/run0")
    assert "Sort" not in last_plan(spark)
    results, headers = jobs.land(spark, params, "run0")
    jobs.build_bronze(spark, params, "run0", headers, results)
    assert "InsertIntoHadoopFs" in last_plan(spark) and "Sort [" not in last_plan(spark)


def test_more_partitions_than_open_files(spark, tmp_dir):
    """Rows of partitions beyond the open files are sorted and written all the same."""
    rows = spark.range(0, 3000, 1, 1).select("id", (F.col("id") % 150).cast("string").alias("season"),
                                             F.lit("E0").alias("league_code"))
    path = write_layer(rows, f"{tmp_dir}/many", rebalance=False)
    back = spark.read.schema("id long, league_code string, season string").parquet(path)
    assert sorted(map(tuple, back.select("id", "season").collect())) == sorted((i, str(i % 150)) for i in range(3000))


@pytest.mark.parametrize("own", [None, "60000"])
def test_writes_compile_in_methods_hotspot_takes(spark, tmp_dir, monkeypatch, own):
    at_write = []
    for kind in ("parquet", "csv"):
        plain = getattr(DataFrameWriter, kind)

        def noted(self, *args, _plain=plain, **kwargs):
            at_write.append((spark.conf.get(HUGE), int(spark.conf.get(WRITERS))))
            return _plain(self, *args, **kwargs)
        monkeypatch.setattr(DataFrameWriter, kind, noted)
    default = spark.conf.get(HUGE)
    if own:
        spark.conf.set(HUGE, own)
    try:
        raw = load_raw_matches(spark, SF)
        write_layer(silver_matches(raw), f"{tmp_dir}/silver")
        scratch_table(raw.limit(5), "few")
        jobs.landing_from_rows(raw, f"{tmp_dir}/landing/_runs/run0")
        assert at_write == [("8000", 64)] * 3
        assert spark.conf.get(HUGE) == (own or default) and int(spark.conf.get(WRITERS)) == 0
    finally:
        spark.conf.unset(HUGE)


def test_rows_are_scored_once_by_each_model(spark, tmp_dir, monkeypatch):
    calls = []
    plain = PipelineModel.transform
    monkeypatch.setattr(PipelineModel, "transform", lambda self, *a, **k: calls.append(self) or plain(self, *a, **k))
    trained, predictions = model.train_outcome_model(_split_features(spark, SF), num_trees=3, save_to=f"{tmp_dir}/model")
    assert sum(r.train_rows + r.test_rows for r in trained.evaluation().collect()) == trained.features.count()
    assert predictions.count() == trained.test_rows
    loaded = PipelineModel.load(f"{tmp_dir}/model")
    assert trained.predicts_alike(loaded)
    assert calls == [trained.model, loaded]
