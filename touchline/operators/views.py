"""The four SQL views, each defined once as a select list.

The same definition serves two uses: :func:`apply_view` projects a DataFrame,
and ``plans.catalog`` renders ``CREATE OR REPLACE VIEW`` text over catalog
tables. Catalyst plans both identically.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas


@dataclass(frozen=True)
class ViewDef:
    name: str            # catalog name, e.g. "gold_v.team_season_table_ranked"
    source: str          # catalog table it reads
    columns: tuple[str, ...]                 # pass-through columns
    computed: tuple[tuple[str, str], ...] = ()  # (alias, SQL expression)

    def select_list(self) -> list[str]:
        return [schemas.quote(c) for c in self.columns] + [f"{expr} AS {schemas.quote(alias)}" for alias, expr in self.computed]

    def sql(self, table_ref: str | None = None) -> str:
        body = ",\n  ".join(self.select_list())
        return f"SELECT\n  {body}\nFROM {table_ref or self.source}"


# The rank expression, and the columns of the four views in their order.
LEAGUE_POSITION = (
    "DENSE_RANK() OVER (PARTITION BY league_code, season "
    "ORDER BY points DESC, goal_difference DESC, goals_for DESC, team ASC)"
)

BRONZE_VIEW = ViewDef(
    "bronze_v.matches", "bronze.matches",
    ("ingestion_run_id", "league_code", "season", "source_file", "Div", "Date", "HomeTeam", "AwayTeam",
     "FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HTR", "HS", "AS", "HST", "AST", "HC", "AC", "HF", "AF",
     "HY", "AY", "HR", "AR"),
)

MATCHES_ENRICHED = ViewDef(
    "silver_v.matches_enriched", "silver.matches",
    ("league_code", "season") + tuple(f.name for f in schemas.SILVER.fields[:-2]),
    (
        ("total_goals", "full_time_home_goals + full_time_away_goals"),
        ("first_half_goals", "half_time_home_goals + half_time_away_goals"),
        ("second_half_goals",
         "(full_time_home_goals - half_time_home_goals) + (full_time_away_goals - half_time_away_goals)"),
        ("winning_team",
         "CASE WHEN full_time_result = 'H' THEN home_team WHEN full_time_result = 'A' THEN away_team END"),
        ("is_draw", "CASE WHEN full_time_result = 'D' THEN TRUE ELSE FALSE END"),
    ),
)

TEAM_SEASON_RANKED = ViewDef(
    "gold_v.team_season_table_ranked", "gold.team_season_table",
    ("league_code", "season", "team", "matches_played", "home_matches", "away_matches", "wins", "draws",
     "losses", "points", "goal_difference", "goals_for", "goals_against", "win_rate", "points_per_match",
     "goals_for_per_match", "goals_against_per_match", "clean_sheet_rate", "both_teams_scored_rate",
     "over_2_5_rate", "shot_dominance_index", "on_target_dominance_index", "territorial_dominance_proxy",
     "net_efficiency", "pressure_without_payoff", "opponent_suppression_rate", "fast_start_rate",
     "second_half_surge_index", "second_half_collapse_index", "comeback_rate", "blown_lead_rate",
     "first_half_control_index", "shot_accuracy", "shot_conversion_rate", "discipline_points_per_match"),
    (("league_position", LEAGUE_POSITION),),
)

LEAGUE_SUMMARY_VIEW = ViewDef(
    "gold_v.league_season_summary", "gold.league_season_summary",
    ("league_code", "season", "matches", "home_wins", "draws", "away_wins", "total_goals",
     "avg_goals_per_match", "avg_home_goals", "avg_away_goals", "home_win_rate", "draw_rate",
     "away_win_rate", "both_teams_scored_matches", "both_teams_scored_rate", "over_1_5_matches",
     "over_1_5_rate", "over_2_5_matches", "over_2_5_rate", "over_3_5_matches", "over_3_5_rate",
     "avg_shots_per_match", "avg_shots_on_target_per_match", "avg_corners_per_match",
     "avg_fouls_per_match", "avg_yellow_cards_per_match", "avg_red_cards_per_match"),
    (("home_goal_advantage", "avg_home_goals - avg_away_goals"),),
)

VIEWS = (BRONZE_VIEW, MATCHES_ENRICHED, TEAM_SEASON_RANKED, LEAGUE_SUMMARY_VIEW)


def apply_view(view: ViewDef, frame: DataFrame) -> DataFrame:
    return frame.selectExpr(*view.select_list())


def bronze_view(bronze: DataFrame) -> DataFrame:
    return apply_view(BRONZE_VIEW, bronze)


def matches_enriched(silver: DataFrame) -> DataFrame:
    return apply_view(MATCHES_ENRICHED, silver)


def team_season_ranked(team_table: DataFrame) -> DataFrame:
    """Ranked view. Its window shuffles only the gold table (one row per
    team and season), never match rows; filters on league_code / season pass
    below the window because they are its PARTITION BY keys."""
    return apply_view(TEAM_SEASON_RANKED, team_table)


def league_summary_view(summary: DataFrame) -> DataFrame:
    return apply_view(LEAGUE_SUMMARY_VIEW, summary)


def champions(team_table: DataFrame) -> DataFrame:
    """League position 1 per league and season (planned with a WindowGroupLimit)."""
    return team_season_ranked(team_table).where(F.col("league_position") == 1)
