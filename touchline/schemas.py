"""Fixed schemas of the four stored tables and DDL text generated from them."""

from __future__ import annotations

from pyspark.sql import types as T

PARTITION_COLUMNS = ("league_code", "season")

# Raw column names of the landed match files, in the order the
# bronze table stores them (provenance first, partition columns last).
BRONZE_PROVENANCE = ("ingestion_run_id", "source_file", "league_name")
RAW_MATCH_COLUMNS = (
    "Div", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HTR",
    "Attendance", "Referee", "HS", "AS", "HST", "AST", "HHW", "AHW", "HC", "AC", "HF", "AF",
    "HO", "AO", "HY", "AY", "HR", "AR", "HBP", "ABP", "GBH", "GBD", "GBA", "IWH", "IWD", "IWA",
    "LBH", "LBD", "LBA", "SBH", "SBD", "SBA", "WHH", "WHD", "WHA",
)

# Landed columns outside RAW_MATCH_COLUMNS, by name.
EXTRA = "extra_columns"

BRONZE = T.StructType(
    [T.StructField(c, T.StringType()) for c in BRONZE_PROVENANCE + RAW_MATCH_COLUMNS]
    + [T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType()))]
    + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS]
)


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in spec])


_I, _L, _D, _S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# Per-side match statistics: (raw home column, raw away column, silver stem).
SIDE_STATS = (
    ("HS", "AS", "shots"),
    ("HST", "AST", "shots_on_target"),
    ("HC", "AC", "corners"),
    ("HF", "AF", "fouls"),
    ("HY", "AY", "yellow_cards"),
    ("HR", "AR", "red_cards"),
)

SILVER = _fields(
    [("season_start_year", _I), ("match_date", T.DateType()), ("home_team", _S), ("away_team", _S),
     ("full_time_home_goals", _I), ("full_time_away_goals", _I),
     ("half_time_home_goals", _I), ("half_time_away_goals", _I), ("full_time_result", _S)]
    + [(f"{side}_{stem}", _I) for _, _, stem in SIDE_STATS for side in ("home", "away")]
    + [("league_code", _S), ("season", _S)]
)

# The sums and the derived metrics kept per team and season, in stored order.
TEAM_COUNTS = (
    "matches_played", "home_matches", "away_matches", "wins", "draws", "losses",
    "goals_for", "goals_against", "first_half_goals_for", "first_half_goals_against",
    "second_half_goals_for", "second_half_goals_against", "shots_for", "shots_against",
    "shots_on_target_for", "shots_on_target_against", "corners_for", "corners_against",
    "fouls_for", "fouls_against", "yellow_cards", "red_cards", "clean_sheets", "failed_to_score",
    "both_teams_scored_matches", "over_1_5_matches", "over_2_5_matches", "over_3_5_matches",
    "leading_at_half", "trailing_at_half", "comeback_results", "blown_leads",
)

TEAM_DERIVED = (
    ("goal_difference", _L), ("points", _L),
    ("win_rate", _D), ("draw_rate", _D), ("loss_rate", _D), ("points_per_match", _D),
    ("goals_for_per_match", _D), ("goals_against_per_match", _D), ("goal_difference_per_match", _D),
    ("clean_sheet_rate", _D), ("failed_to_score_rate", _D), ("both_teams_scored_rate", _D),
    ("over_1_5_rate", _D), ("over_2_5_rate", _D), ("over_3_5_rate", _D),
    ("first_half_goals_for_per_match", _D), ("first_half_goals_against_per_match", _D),
    ("second_half_goals_for_per_match", _D), ("second_half_goals_against_per_match", _D),
    ("avg_shots_for", _D), ("avg_shots_against", _D), ("avg_shots_on_target_for", _D),
    ("avg_shots_on_target_against", _D), ("shot_dominance_index", _D),
    ("on_target_dominance_index", _D), ("territorial_dominance_proxy", _D), ("shot_accuracy", _D),
    ("shot_conversion_rate", _D), ("net_efficiency", _D), ("pressure_without_payoff", _D),
    ("opponent_suppression_rate", _D), ("avg_corners_for", _D), ("avg_corners_against", _D),
    ("avg_fouls_for", _D), ("avg_fouls_against", _D), ("avg_yellow_cards", _D), ("avg_red_cards", _D),
    ("fast_start_rate", _D), ("second_half_surge_index", _D), ("second_half_collapse_index", _D),
    ("comeback_rate", _D), ("blown_lead_rate", _D), ("first_half_control_index", _D),
    ("discipline_points", _L), ("discipline_points_per_match", _D),
)

TEAM_SEASON = _fields(
    [("team", _S)] + [(c, _L) for c in TEAM_COUNTS] + list(TEAM_DERIVED)
    + [("league_code", _S), ("season", _S)]
)

LEAGUE_SUMMARY = _fields(
    [("matches", _L), ("home_wins", _L), ("draws", _L), ("away_wins", _L), ("home_goals", _L),
     ("away_goals", _L), ("avg_goals_per_match", _D), ("total_goals", _L),
     ("both_teams_scored_matches", _L), ("over_1_5_matches", _L), ("over_2_5_matches", _L),
     ("over_3_5_matches", _L), ("avg_shots_per_match", _D), ("avg_shots_on_target_per_match", _D),
     ("avg_corners_per_match", _D), ("avg_fouls_per_match", _D), ("avg_yellow_cards_per_match", _D),
     ("avg_red_cards_per_match", _D), ("home_win_rate", _D), ("draw_rate", _D), ("away_win_rate", _D),
     ("avg_home_goals", _D), ("avg_away_goals", _D), ("both_teams_scored_rate", _D),
     ("over_1_5_rate", _D), ("over_2_5_rate", _D), ("over_3_5_rate", _D),
     ("league_code", _S), ("season", _S)]
)

TABLES = {
    "bronze.matches": BRONZE,
    "silver.matches": SILVER,
    "gold.team_season_table": TEAM_SEASON,
    "gold.league_season_summary": LEAGUE_SUMMARY,
}


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_ddl(schema: T.StructType) -> str:
    """``name TYPE, ...`` text for CREATE TABLE, generated from the StructType."""
    return ",\n  ".join(f"{quote(f.name)} {f.dataType.simpleString().upper()}" for f in schema.fields)
