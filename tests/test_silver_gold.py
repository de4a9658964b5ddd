"""Silver typing, team rows, gold aggregates and views.

Hand-made frames for the edge cases, and invariants over the raw match rows
derived from sf0.001 ``lineitem``.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import gold, silver, views
from touchline.sources.lineitem_matches import load_raw_matches

from helpers import SF_SMALL, types_of

RAW_COLS = ("Div Date HomeTeam AwayTeam FTHG FTAG FTR HTHG HTAG HS AS HST AST HC AC HF AF HY AY HR AR "
            "league_code season").split()


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RAW_COLS))


def match(home="A", away="B", fthg="1", ftag="0", ftr="H", hthg="0", htag="0", season="2324", league="E0", **kw):
    base = dict(Div=league, Date="12/08/2023", HomeTeam=home, AwayTeam=away, FTHG=fthg, FTAG=ftag, FTR=ftr,
                HTHG=hthg, HTAG=htag, HS="10", AS="5", HST="4", AST="2", HC="6", AC="3", HF="11", AF="12",
                HY="1", AY="2", HR="0", AR="1", league_code=league, season=season)
    base.update(kw)
    return tuple(base[c] for c in RAW_COLS)


@pytest.fixture(scope="module")
def raw_small(spark):
    return load_raw_matches(spark, SF_SMALL).cache()


def test_silver_schema_and_required_keys(spark):
    raw = raw_frame(spark, [match(), match(home=None), match(league=None), match(season=None)])
    out = silver.silver_matches(raw)
    assert types_of(out) == types_of(schemas.SILVER)
    assert out.count() == 1
    reasons = {r.reject_reason for r in silver.rejected_matches(raw).collect()}
    assert reasons == {"missing home_team", "unknown league", "missing season"}


def test_missing_result_and_goals_defaults(spark):
    out = silver.silver_matches(raw_frame(spark, [match(fthg="x", ftr=None, hthg=None)])).first()
    assert out.full_time_home_goals == 0 and out.full_time_result == "U" and out.half_time_home_goals is None


def test_drifted_input_missing_columns(spark):
    narrow = spark.createDataFrame([("E0", "14/08/93", "A", "B", "2", "1", "H", "E0", "9394")],
                                   "Div string, Date string, HomeTeam string, AwayTeam string, FTHG string, "
                                   "FTAG string, FTR string, league_code string, season string")
    out = silver.silver_matches(narrow).first()
    assert out.season_start_year == 1993 and str(out.match_date) == "1993-08-14"
    assert out.home_shots is None and out.half_time_home_goals is None
    assert types_of(silver.conform_bronze(narrow)) == types_of(schemas.BRONZE)


def test_u_result_counts_as_comeback_and_blown_lead(spark):
    # home leads at half time, result unknown: a blown lead for home;
    # away trails and did not lose: a comeback for away
    s = silver.silver_matches(raw_frame(spark, [match(ftr=None, hthg="1", htag="0")]))
    rows = {r.team: r for r in gold.team_match_rows(s).collect()}
    assert rows["A"].blown_leads == 1 and rows["A"].leading_at_half == 1
    assert rows["B"].comeback_results == 1 and rows["B"].trailing_at_half == 1
    assert rows["A"].wins == rows["A"].draws == rows["A"].losses == 0


def test_half_time_unknown_sums_to_null_and_ratios_guarded(spark):
    s = silver.silver_matches(raw_frame(spark, [match(hthg=None, htag=None, HS="0", AS="0", HST="0", AST="0")]))
    team = {r.team: r for r in gold.team_season_table(s).collect()}["A"]
    assert team.leading_at_half is None and team.first_half_goals_for is None
    assert team.fast_start_rate is None and team.comeback_rate is None
    assert team.shot_accuracy is None and team.opponent_suppression_rate is None
    assert team.clean_sheets == 1 and team.points == 3 and team.matches_played == 1


def test_team_table_schema_and_invariants(raw_small):
    s = silver.silver_matches(raw_small)
    team = gold.team_season_table(s)
    assert types_of(team) == types_of(schemas.TEAM_SEASON)
    assert team.count() > 0
    per_league = team.groupBy("league_code", "season").agg(
        F.sum("wins").alias("w"), F.sum("losses").alias("l"), F.sum("goals_for").alias("gf"),
        F.sum("goals_against").alias("ga"), F.sum("matches_played").alias("mp"),
        F.sum("comeback_results").alias("cb"), F.sum("blown_leads").alias("bl"), F.sum("points").alias("pts"))
    league = gold.league_season_summary(s)
    assert types_of(league) == types_of(schemas.LEAGUE_SUMMARY)
    joined = per_league.join(league, ["league_code", "season"]).collect()
    assert joined
    for r in joined:
        assert r.w == r.l and r.gf == r.ga and r.cb == r.bl
        assert r.mp == 2 * r.matches
        assert r.pts == 3 * (r.home_wins + r.away_wins) + 2 * r.draws
    assert team.where("wins + draws + losses > matches_played").count() == 0


def test_team_rows_double_the_matches(raw_small):
    s = silver.silver_matches(raw_small)
    assert gold.team_match_rows(s).count() == 2 * s.count()


def test_league_position_dense_and_gapless(raw_small):
    ranked = views.team_season_ranked(gold.team_season_table(silver.silver_matches(raw_small)))
    check = ranked.groupBy("league_code", "season").agg(
        F.count(F.lit(1)).alias("n"), F.max("league_position").alias("mx"),
        F.countDistinct("league_position").alias("d"))
    assert check.where("n <> mx OR n <> d").count() == 0
    champs = views.champions(gold.team_season_table(silver.silver_matches(raw_small)))
    assert champs.count() == check.count()


def test_views_columns(raw_small):
    s = silver.silver_matches(raw_small)
    enriched = views.matches_enriched(s)
    assert enriched.columns[-5:] == ["total_goals", "first_half_goals", "second_half_goals", "winning_team", "is_draw"]
    assert dict(enriched.dtypes)["is_draw"] == "boolean"
    assert len(views.bronze_view(silver.conform_bronze(raw_small)).columns) == 26
    assert views.league_summary_view(gold.league_season_summary(s)).columns[-1] == "home_goal_advantage"



def test_team_table_with_a_hot_team_matches_brute_force(raw_small):
    """One team hosts a third of all matches (a hot key): the aggregate still
    equals a row-by-row count in pandas over the same silver rows."""
    hot = raw_small.withColumn(
        "HomeTeam", F.when(F.xxhash64("Date", "AwayTeam", "FTHG") % 3 == 0, F.lit("HOT")).otherwise(F.col("HomeTeam")))
    s = silver.silver_matches(hot)
    got = {(r.league_code, r.season, r.team): r for r in gold.team_season_table(s).collect()}
    pdf = s.select("league_code", "season", "home_team", "away_team", "full_time_result",
                   "full_time_home_goals", "full_time_away_goals").toPandas()
    expected: dict = {}
    for row in pdf.itertuples(index=False):
        for team, own, gf, ga in ((row.home_team, "H", row.full_time_home_goals, row.full_time_away_goals),
                                  (row.away_team, "A", row.full_time_away_goals, row.full_time_home_goals)):
            e = expected.setdefault((row.league_code, row.season, team), [0, 0, 0, 0])
            e[0] += 1
            e[1] += row.full_time_result == own
            e[2] += row.full_time_result == "D"
            e[3] += gf - ga
    assert sum(v[0] for k, v in expected.items() if k[2] == "HOT") > len(pdf) / 4
    assert set(got) == set(expected)
    for key, (mp, wins, draws, gd) in expected.items():
        r = got[key]
        assert (r.matches_played, r.wins, r.draws, r.goal_difference, r.points) == (mp, wins, draws, gd, 3 * wins + draws)


def _by_key(df, key=("league_code", "season")):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def test_gold_from_venue_aggregates_equals_direct(spark, raw_small):
    """The gold job's one-pass path (per-team-and-venue aggregates, then a
    team sum and a league roll-up of home rows) equals the direct
    aggregations, on the derived rows and on edge cases: a league-season with
    no known shots (AVG is NULL), a missing result, unknown goals."""
    edge = raw_frame(spark, [
        match(home="A", away="B", HS=None, season="9394"),
        match(home="B", away="A", ftr=None, fthg="x", HS=None, AS="3", season="9394"),
        match(home="A", away="C", ftr="D", fthg="1", ftag="1", hthg=None, season="0001", league="SP1"),
        match(home="B", away="C", ftr="A", fthg="0", ftag="2", HY="", season="0001", league="SP1"),
    ])
    for raw in (edge, raw_small):
        s = silver.silver_matches(raw)
        per_venue = gold.team_venue_aggregates(s)
        league, direct = gold.league_summary_from(per_venue), gold.league_season_summary(s)
        assert types_of(league) == types_of(direct) == types_of(schemas.LEAGUE_SUMMARY)
        assert _by_key(league) == _by_key(direct)
        team = gold.team_table_from(per_venue)
        assert types_of(team) == types_of(schemas.TEAM_SEASON)
        key = ("league_code", "season", "team")
        assert _by_key(team, key) == _by_key(gold.team_season_table(s), key)
    no_shots = _by_key(gold.league_summary_from(gold.team_venue_aggregates(silver.silver_matches(edge))))
    assert no_shots[("E0", "9394")]["avg_shots_per_match"] is None


def test_gold_job_path_reads_the_matches_once(spark, tmp_dir):
    """One scan and one Exchange for the per-venue aggregates; the league
    roll-up over their checkpoint reads no Parquet."""
    from touchline.sources.layers import read_layer, write_layer
    s = silver.silver_matches(load_raw_matches(spark, SF_SMALL))
    matches = read_layer(spark, write_layer(s, f"{tmp_dir}/silver"), schemas.SILVER)
    per_venue = gold.team_venue_aggregates(matches)
    plan = per_venue._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    saved = per_venue.checkpoint()
    for derived in (gold.league_summary_from(saved), gold.team_table_from(saved)):
        assert "FileScan parquet" not in derived._jdf.queryExecution().executedPlan().toString()
