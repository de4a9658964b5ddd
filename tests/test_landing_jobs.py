"""Landing, header-drifted CSV -> bronze, layer jobs end to end.

Hand-written landed files in the layout ``<run>/<league_name>/<season>.csv``
(FIXTURES.md F1): narrow 1990s header, a leading-zero season, a column
inserted mid-header, a blank trailing line with an extra odds column, an
unknown league, and an empty and a blank file.
"""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.params import RunParams, league_dimension, leagues_from_text, parse_league_list, params_from_env
from touchline.plans import catalog, jobs
from touchline.sources import landing
from touchline.sources.bronze import bronze_from_landing, header_columns
from touchline.sources.layers import layer_path, read_layer, read_table

from helpers import types_of, write_text

RUN = "20240101T000000Z"
FILES = {
    "england_premier_league/9394.csv":
        "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\nE0,14/08/93,Arsenal,Coventry,0,3,A\nE0,14/08/93,Leeds,Wimbledon,1,0,H\n",
    "england_premier_league/0001.csv":
        "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HTHG,HTAG,HTR,Attendance,Referee,HS,AS\n"
        "E0,19/08/00,Charlton,Man City,4,0,H,2,0,H,20043,R Styles,17,8\n",
    "england_premier_league/2324.csv":
        "Div,Date,Time,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HTHG,HTAG,HTR,HS,AS\n"
        "E0,11/08/2023,20:00,Burnley,Man City,0,3,A,0,2,A,6,17\n",
    "spain_la_liga/2324.csv":
        "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,B365H\nSP1,11/08/2023,Almeria,Vallecano,0,2,A,2.3\n,,,,,,,\n",
    "unknown_league/2324.csv":
        "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\nX1,11/08/2023,A,B,1,1,D\n",
    "italy_serie_a/2324.csv": "",
    "france_ligue_1/2324.csv": "  \n \n",
}
LEAGUES = {"E0": "england_premier_league", "SP1": "spain_la_liga", "I1": "italy_serie_a", "F1": "france_ligue_1"}


@pytest.fixture()
def landed(tmp_dir):
    run_root = landing.run_folder(f"{tmp_dir}/landing", RUN)
    for rel, text in FILES.items():
        write_text(f"{run_root}/{rel}", text)
    return tmp_dir, run_root


def test_season_calendar(spark):
    cal = landing.season_calendar(spark, 1998, 2001).collect()
    assert [r.season for r in cal] == ["9899", "9900", "0001", "0102"]
    with pytest.raises(ValueError):
        landing.season_calendar(spark, 2002, 2001)


def test_league_text_parsing(spark):
    assert leagues_from_text(spark, " E0=england , ,SP1 = spain, E0=eng2") == {"E0": "eng2", "SP1": "spain"}
    with pytest.raises(ValueError):
        leagues_from_text(spark, "E0")
    with pytest.raises(ValueError):
        leagues_from_text(spark, " , ")
    df = spark.createDataFrame([(" E0=england , ,SP1 = spain, E0=eng2",)], "league_list string")
    got = {(r.league_code, r.league_name) for r in parse_league_list(df).collect()}
    assert got == {("E0", "eng2"), ("SP1", "spain")}


def test_header_columns_dedupes_and_names_blanks():
    assert header_columns('Div,"Date",,Referee,Referee') == ["Div", "Date", "_c2", "Referee", "Referee_1"]


def test_landing_check_and_summary(spark, landed):
    _, run_root = landed
    manifest = landing.ingest_manifest(league_dimension(spark, LEAGUES), 2023, 2023, run_root)
    results = landing.landing_results(manifest, landing.landed_headers(spark, run_root))
    status = {(r.league_code, r.season): r.success for r in results.collect()}
    assert status == {("E0", "2324"): True, ("SP1", "2324"): True, ("I1", "2324"): False, ("F1", "2324"): False}
    summary = landing.ingest_summary(results).first()
    assert (summary.successes, summary.total) == (2, 4)


def test_bronze_maps_drifted_headers_by_name(spark, landed):
    _, run_root = landed
    bronze = bronze_from_landing(spark, run_root, RUN, LEAGUES)
    assert types_of(bronze) == types_of(schemas.BRONZE)
    rows = {(r.HomeTeam, r.season): r for r in bronze.collect()}
    burnley = rows[("Burnley", "2324")]
    assert burnley.AwayTeam == "Man City" and burnley.FTHG == "0" and burnley.league_code == "E0"
    assert rows[("Charlton", "0001")].Referee == "R Styles"
    assert rows[("A", "2324")].league_code is None and rows[("A", "2324")].league_name == "unknown_league"
    assert rows[("Arsenal", "9394")].source_file.endswith("england_premier_league/9394.csv")
    assert all(r.ingestion_run_id == RUN for r in rows.values())


def test_run_all_end_to_end(spark, landed):
    tmp, _ = landed
    params = RunParams(lake_root=f"{tmp}/lake", landing_root=f"{tmp}/landing", start_year=1993, end_year=2023,
                       leagues=LEAGUES, database_prefix="t_e2e_")
    report = jobs.run_all(spark, params, RUN, min_start_year=2000)
    assert (report.successes, report.total) == (4, 4 * 31)
    bronze_rows = read_table(spark, params.lake_root, "bronze.matches")
    # only files of manifest tasks: the unknown league's folder is not read
    assert bronze_rows.count() == 6 and bronze_rows.where("league_name = 'unknown_league'").count() == 0
    silver_rows = read_table(spark, params.lake_root, "silver.matches")
    assert silver_rows.count() == 5  # the blank trailing line is dropped
    by_team = {r.home_team: r for r in silver_rows.collect()}
    assert by_team["Arsenal"].season == "9394" and by_team["Arsenal"].season_start_year == 1993
    assert by_team["Arsenal"].match_date == dt.date(1993, 8, 14)
    assert by_team["Charlton"].season == "0001" and by_team["Charlton"].season_start_year == 2000
    assert by_team["Burnley"].home_shots == 6
    champs = spark.sql("SELECT team FROM t_e2e_gold_v.team_season_table_ranked "
                       "WHERE league_code = 'E0' AND season = '2324' AND league_position = 1").collect()
    assert [r.team for r in champs] == ["Man City"]
    parts = {r.partition for r in spark.sql("SHOW PARTITIONS t_e2e_silver.matches").collect()}
    assert "league_code=E0/season=0001" in parts
    # second run over the same landing is an idempotent overwrite
    jobs.run_all(spark, params, RUN, with_model=False)
    assert read_table(spark, params.lake_root, "silver.matches").count() == 5


def test_nothing_landed_writes_nothing(spark, tmp_dir):
    write_text(landing.run_folder(f"{tmp_dir}/landing", RUN) + "/italy_serie_a/2324.csv", "")
    params = RunParams(lake_root=f"{tmp_dir}/lake", landing_root=f"{tmp_dir}/landing", start_year=2023,
                       end_year=2023, leagues=LEAGUES)
    report = jobs.run_all(spark, params, RUN)
    assert report.successes == 0 and report.outputs == {}


def test_partition_roundtrip_keeps_text_seasons(spark, tmp_dir):
    from touchline.sources.layers import write_layer
    df = spark.createDataFrame([(1, "E0", "0001"), (2, "E0", "9394")], "x int, league_code string, season string")
    path = write_layer(df, f"{tmp_dir}/t")
    back = read_layer(spark, path, df.schema)
    assert sorted(r.season for r in back.collect()) == ["0001", "9394"]
    pruned = back.where("season = '0001'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "0001" in plan
    assert pruned.count() == 1


def test_catalog_ddl_generated_from_schema():
    ddl = catalog.table_ddl("gold.team_season_table", "/x", "p_")
    assert "`p_gold`.`team_season_table`" in ddl and "PARTITIONED BY (league_code, season)" in ddl
    assert ddl.count("DOUBLE") == 42 and ddl.count("BIGINT") == 35
    assert layer_path("/lake", "gold.team_season_table") == "/lake/gold/team_season_table"


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_dir):
    """A run that lands one league replaces only that league's partitions."""
    import dataclasses
    root = landing.run_folder(f"{tmp_dir}/landing", RUN)
    write_text(f"{root}/england_premier_league/2324.csv", FILES["england_premier_league/2324.csv"])
    write_text(f"{root}/spain_la_liga/2324.csv", FILES["spain_la_liga/2324.csv"])
    params = RunParams(lake_root=f"{tmp_dir}/lake", landing_root=f"{tmp_dir}/landing", start_year=2023,
                       end_year=2023, leagues=LEAGUES, database_prefix="t_dyn_", partition_overwrite="dynamic")
    jobs.run_all(spark, params, RUN, with_model=False)
    run2 = "20240102T000000Z"
    write_text(landing.run_folder(f"{tmp_dir}/landing", run2) + "/spain_la_liga/2324.csv",
               "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\nSP1,12/08/2023,Sevilla,Valencia,1,2,A\n")
    e0_files = {(p, os.path.getmtime(p)) for p in glob.glob(f"{tmp_dir}/lake/*/*/league_code=E0/*/*.parquet")}
    assert e0_files
    jobs.run_all(spark, params, run2, with_model=False)
    teams = {(r.league_code, r.home_team) for r in read_table(spark, params.lake_root, "silver.matches").collect()}
    assert teams == {("E0", "Burnley"), ("SP1", "Sevilla")}
    # the second run read and rewrote only SP1: E0's silver and gold files are untouched
    assert {(p, os.path.getmtime(p)) for p in glob.glob(f"{tmp_dir}/lake/*/*/league_code=E0/*/*.parquet")} == e0_files
    league = {r.league_code: r.matches for r in read_table(spark, params.lake_root, "gold.league_season_summary").collect()}
    assert league == {"E0": 1, "SP1": 1}
    static = dataclasses.replace(params, partition_overwrite="static")
    jobs.run_all(spark, static, run2, with_model=False)
    assert {r.league_code for r in read_table(spark, params.lake_root, "silver.matches").collect()} == {"SP1"}


def test_checkpoint_folder_is_never_machine_local_on_a_cluster():
    from touchline.session import _local_only_folder
    assert _local_only_folder("local[4]")
    for master in ("yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(ValueError):
            _local_only_folder(master)


def test_landed_folders_with_spaces_and_glob_characters(spark, tmp_dir):
    """File paths come back as URIs (``%20``) and readers expand globs: a
    folder named ``premier league`` or ``liga[1]`` must still be read, and
    provenance must hold the real folder name."""
    run_root = landing.run_folder(f"{tmp_dir}/landing", RUN)
    header = "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\n"
    write_text(f"{run_root}/premier league/9394.csv", header + "E0,14/08/93,A,B,1,0,H\n")
    write_text(f"{run_root}/liga[1]/9394.csv", header + "L1,14/08/93,C,D,0,0,D\n")
    write_text(f"{run_root}/a+b/9394.csv", header + "P1,14/08/93,E,F,2,2,D\n")
    leagues = {"E0": "premier league", "L1": "liga[1]", "P1": "a+b"}
    rows = bronze_from_landing(spark, run_root, RUN, leagues).collect()
    assert sorted((r.league_name, r.league_code, r.HomeTeam) for r in rows) == [
        ("a+b", "P1", "E"), ("liga[1]", "L1", "C"), ("premier league", "E0", "A")]
    manifest = landing.ingest_manifest(league_dimension(spark, leagues), 1993, 1993, run_root)
    results = landing.landing_results(manifest, landing.landed_headers(spark, run_root)).collect()
    assert all(r.success for r in results) and len(results) == 3


def test_odd_column_names_and_quoted_fields(spark, tmp_dir):
    """Odds columns with dots and comparison signs, a quoted referee with a
    comma, a BOM and CRLF line ends: read by name, unknown columns kept by name."""
    run_root = landing.run_folder(f"{tmp_dir}/landing", RUN)
    text = ("﻿Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,Referee,BbMx>2.5,B365<2.5,HS\r\n"
            'E0,11/08/2023,Burnley,Man City,0,3,A,"Smith, J",1.8,2.1,6\r\n')
    write_text(f"{run_root}/england_premier_league/2324.csv", text)
    row = bronze_from_landing(spark, run_root, RUN, LEAGUES).first()
    assert (row.Div, row.Referee, row.HS, row.league_code, row.season) == ("E0", "Smith, J", "6", "E0", "2324")
    assert row.extra_columns == {"BbMx>2.5": "1.8", "B365<2.5": "2.1"}


def test_headers_that_repeat_names_or_differ_in_case(spark, tmp_dir):
    from touchline.sources.bronze import header_columns
    assert header_columns("Referee,Referee,Referee_1") == ["Referee", "Referee_2", "Referee_1"]
    assert header_columns("AHH,AHh,,") == ["AHH", "AHh_1", "_c2", "_c3"]
    run_root = landing.run_folder(f"{tmp_dir}/landing", RUN)
    write_text(f"{run_root}/england_premier_league/2324.csv",
               "Div,Date,HomeTeam,AwayTeam,Referee,Referee,Referee_1,AHH,AHh\nE0,11/08/2023,A,B,r,s,t,1,2\n")
    row = bronze_from_landing(spark, run_root, RUN, LEAGUES).first()
    assert row.Referee == "r" and row.extra_columns == {"Referee_2": "s", "Referee_1": "t", "AHH": "1", "AHh_1": "2"}


def _lake_params(tmp_dir, name, **more):
    return RunParams(lake_root=f"{tmp_dir}/{name}", landing_root=f"{tmp_dir}/landing-{name}", start_year=2022, end_year=2023,
                     leagues=LEAGUES, database_prefix="t_follow_", **more)


def test_catalog_follows_the_lake_and_drops_lost_partitions(spark, tmp_dir):
    from touchline.plans import catalog
    head = "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\n"
    try:
        for lake, home in (("lake1", "First"), ("lake2", "Second")):
            params = _lake_params(tmp_dir, lake)
            for season in ("2223", "2324"):
                write_text(landing.run_folder(params.landing, RUN) + f"/england_premier_league/{season}.csv",
                           head + f"E0,12/08/2023,{home},B,1,0,H\n")
            jobs.run_all(spark, params, RUN, with_model=False)
            assert {r.home_team for r in spark.table("t_follow_silver.matches").collect()} == {home}
        assert spark.sql("SHOW PARTITIONS t_follow_silver.matches").count() == 2
        run2 = "20240102T000000Z"
        write_text(landing.run_folder(params.landing, run2) + "/england_premier_league/2223.csv", head + "E0,12/08/2022,Third,B,1,0,H\n")
        jobs.run_all(spark, params, run2, with_model=False)
        assert spark.sql("SHOW PARTITIONS t_follow_silver.matches").count() == 1
    finally:
        before = {d.name for d in spark.catalog.listDatabases()}
        catalog.drop_lake(spark, "t_follow_")
        assert {d.name for d in spark.catalog.listDatabases()} == {d for d in before if not d.startswith("t_follow_")}


def test_location_text_is_escaped():
    from touchline.plans.catalog import table_ddl
    assert "LOCATION '/o\\'brien/x'" in table_ddl("silver.matches", "/o'brien/x")


def test_run_path_rules(spark, tmp_dir, monkeypatch):
    params = _lake_params(tmp_dir, "rules")
    report = jobs.run_all(spark, params, "no-such-run", with_model=False)
    assert report.outputs == {} and report.successes == 0 and not os.path.exists(f"{tmp_dir}/rules/bronze")
    with pytest.raises(ValueError):
        landing.ingest_manifest(league_dimension(spark, LEAGUES), 2005, 2003, "/x")
    root = landing.run_folder(params.landing, RUN)
    head = "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\n"
    write_text(f"{root}/england_premier_league/2324.csv", head + "E0,12/08/2023,A,B,1,0,H\nE0,12/08/2023,,C,1,0,H\n")
    write_text(f"{root}/england_premier_league/9394.csv", head + "E0,12/08/1993,A,B,1,0,H\n")
    monkeypatch.setenv("TOUCHLINE_LAKE_ROOT", f"{tmp_dir}/rules")
    monkeypatch.setenv("TOUCHLINE_LANDING_ROOT", f"{tmp_dir}/landing-rules")
    monkeypatch.setenv("TOUCHLINE_START_YEAR", "2022")
    monkeypatch.setenv("TOUCHLINE_END_YEAR", "2023")
    monkeypatch.setenv("TOUCHLINE_LEAGUES", "E0=england_premier_league, SP1=spain_la_liga")
    report = jobs.run_all(spark, params_from_env(spark), RUN, with_model=False)
    assert (report.successes, report.total, report.unlisted_files, report.rejected_rows) == (1, 4, 1, 1)


def test_saved_model_predicts_like_the_trained_one(spark, tmp_dir):
    from pyspark.ml import PipelineModel
    from touchline.operators import model
    from touchline.plans.queries import _split_features
    trained, predictions = model.train_outcome_model(_split_features(spark, "/root/testdata/sf0.001"), num_trees=5, save_to=f"{tmp_dir}/model")
    again = PipelineModel.load(f"{tmp_dir}/model").transform(predictions.drop("features", "rawPrediction", "probability", "prediction"))
    key = [*model.FEATURES, "label", "prediction"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, predictions.select(key).collect()))
    assert trained.test_rows == predictions.count()


def test_file_checkpoint_folder_is_refused_on_a_cluster():
    from touchline.session import shared_folder
    assert shared_folder("file:///x", "local-cluster[2,1,1024]") and shared_folder("hdfs:///x", "yarn")
    with pytest.raises(ValueError):
        shared_folder("file:///x", "yarn")
