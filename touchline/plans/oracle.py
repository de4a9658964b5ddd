"""DuckDB SQL equal to each named query, for the driver's correctness gate.

Independent of the Spark code: hand-written SQL over the registered views of
the driver's tables. Every text starts from the raw-match mapping of
``lineitem`` (FIXTURES.md F6) as a CTE. DuckDB sums of integers are HUGEINT,
so they are cast to BIGINT; ratios are guarded with ``CASE WHEN d <> 0``.
"""

from __future__ import annotations

RAW_SQL = """WITH k AS (
 SELECT l.*,
  (CASE WHEN month(l_shipdate)>=7 THEN year(l_shipdate) ELSE year(l_shipdate)-1 END) AS sy,
  CAST(l_quantity AS INT)%5 AS hg, CAST(l_partkey%4 AS INT) AS ag,
  lpad(CAST(day(l_shipdate) AS VARCHAR(10)),2,'0') AS dd,
  lpad(CAST(month(l_shipdate) AS VARCHAR(10)),2,'0') AS mm,
  CAST(year(l_shipdate) AS VARCHAR(10)) AS yy,
  CASE l_suppkey%4 WHEN 0 THEN 'E0' WHEN 1 THEN 'SP1' WHEN 2 THEN 'I1' ELSE 'D1' END AS lc,
  CASE l_suppkey%4 WHEN 0 THEN 'england_premier_league' WHEN 1 THEN 'spain_la_liga' WHEN 2 THEN 'italy_serie_a' ELSE 'germany_bundesliga_1' END AS ln
 FROM lineitem l),
j AS (
 SELECT k.*, concat(substr(CAST(sy AS VARCHAR(10)),3,2),substr(CAST(sy+1 AS VARCHAR(10)),3,2)) AS sc FROM k)
SELECT
 'run0' AS ingestion_run_id,
 concat('file:///landing/_runs/run0/',ln,'/',sc,'.csv') AS source_file,
 ln AS league_name, lc AS "Div",
 CASE WHEN l_orderkey%3=0 THEN concat(dd,'/',mm,'/',substr(yy,3,2)) WHEN l_orderkey%3=1 THEN concat(dd,'/',mm,'/',yy) ELSE concat(yy,'-',mm,'-',dd) END AS "Date",
 CASE WHEN l_orderkey%101=0 THEN NULL ELSE concat('T',lpad(CAST(l_partkey%20 AS VARCHAR(10)),2,'0')) END AS "HomeTeam",
 concat('T',lpad(CAST((l_partkey%20+1+l_orderkey%19)%20 AS VARCHAR(10)),2,'0')) AS "AwayTeam",
 CASE WHEN l_orderkey%53=0 THEN 'x' ELSE CAST(hg AS VARCHAR(10)) END AS "FTHG",
 CAST(ag AS VARCHAR(10)) AS "FTAG",
 CASE WHEN l_orderkey%53=0 THEN NULL WHEN hg>ag THEN 'H' WHEN hg<ag THEN 'A' ELSE 'D' END AS "FTR",
 CASE WHEN l_linenumber=7 THEN NULL ELSE CAST(least(hg,CAST(l_orderkey%3 AS INT)) AS VARCHAR(10)) END AS "HTHG",
 CASE WHEN l_linenumber=7 THEN '' ELSE CAST(least(ag,CAST(l_suppkey%3 AS INT)) AS VARCHAR(10)) END AS "HTAG",
 CASE WHEN l_partkey%11=0 THEN NULL ELSE concat(CASE WHEN l_orderkey%41=0 THEN ' ' ELSE '' END, CAST(hg+l_suppkey%4+l_partkey%9 AS VARCHAR(10)),
  CASE WHEN l_orderkey%41=0 THEN ' ' WHEN l_orderkey%43=0 THEN '.0' WHEN l_orderkey%47=0 THEN 'd' WHEN l_orderkey%59=0 THEN 'e2' WHEN l_orderkey%61=0 THEN '.7' ELSE '' END) END AS "HS",
 CASE WHEN l_partkey%11=0 THEN NULL ELSE CAST(ag+l_suppkey%4+l_orderkey%8 AS VARCHAR(10)) END AS "AS",
 CASE WHEN l_partkey%11=0 THEN NULL ELSE CAST(hg+l_suppkey%4 AS VARCHAR(10)) END AS "HST",
 CASE WHEN l_partkey%11=0 THEN NULL ELSE CAST(ag+l_suppkey%4 AS VARCHAR(10)) END AS "AST",
 CAST(l_orderkey%9 AS VARCHAR(10)) AS "HC", CAST(l_partkey%8 AS VARCHAR(10)) AS "AC",
 CAST(8+l_orderkey%7 AS VARCHAR(10)) AS "HF", CAST(8+l_suppkey%7 AS VARCHAR(10)) AS "AF",
 CAST(l_linenumber%4 AS VARCHAR(10)) AS "HY", CAST(l_orderkey%5 AS VARCHAR(10)) AS "AY",
 CASE WHEN l_orderkey%17=0 THEN '1' ELSE '0' END AS "HR", CASE WHEN l_partkey%23=0 THEN '1' ELSE '0' END AS "AR",
 lc AS league_code, sc AS season
FROM j"""


def r(num: str, den: str) -> str:
    """Guarded DOUBLE ratio."""
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def iint(text: str) -> str:
    """Sign and digits with an optional fraction, which is cut off; anything else is NULL."""
    return (f"CASE WHEN regexp_full_match({text}, '\\s*[+-]?\\d+(\\.\\d*)?\\s*') "
            f"THEN try_cast(trim(split_part({text}, '.', 1)) AS INT) END")


_CENTURY = "CASE WHEN try_cast(substr({t},7,2) AS INT) >= 70 THEN '19' ELSE '20' END"
_DATE_NORM = (
    "CASE WHEN regexp_matches({t}, '^\\d{{2}}/\\d{{2}}/\\d{{2}}$') "
    "THEN concat(substr({t},1,6), " + _CENTURY + ", substr({t},7,2)) ELSE {t} END"
)


def date_expr(t: str) -> str:
    n = _DATE_NORM.format(t=t)
    return f"CAST(coalesce(try_strptime({n}, '%d/%m/%Y'), try_strptime({n}, '%Y-%m-%d')) AS DATE)"


def start_year_expr(season: str) -> str:
    yy = f"try_cast(substr({season},1,2) AS INT)"
    return f"CAST(CASE WHEN {yy} >= 70 THEN {yy} + 1900 ELSE {yy} + 2000 END AS INT)"


_STATS = (("HS", "AS", "shots"), ("HST", "AST", "shots_on_target"), ("HC", "AC", "corners"),
          ("HF", "AF", "fouls"), ("HY", "AY", "yellow_cards"), ("HR", "AR", "red_cards"))


def silver_select(src: str = "raw") -> str:
    stats = ",\n  ".join(
        f'{iint(chr(34) + h + chr(34))} AS home_{s}, {iint(chr(34) + a + chr(34))} AS away_{s}' for h, a, s in _STATS
    )
    return f"""SELECT
  {start_year_expr('season')} AS season_start_year,
  {date_expr('"Date"')} AS match_date,
  "HomeTeam" AS home_team,
  "AwayTeam" AS away_team,
  coalesce({iint('"FTHG"')}, 0) AS full_time_home_goals,
  coalesce({iint('"FTAG"')}, 0) AS full_time_away_goals,
  {iint('"HTHG"')} AS half_time_home_goals,
  {iint('"HTAG"')} AS half_time_away_goals,
  coalesce("FTR", 'U') AS full_time_result,
  {stats},
  league_code,
  season
FROM {src}
WHERE "HomeTeam" IS NOT NULL AND "AwayTeam" IS NOT NULL AND league_code IS NOT NULL AND season IS NOT NULL"""


def _side(own: str, opp: str, win: str, loss: str) -> str:
    gf, ga = f"full_time_{own}_goals", f"full_time_{opp}_goals"
    hf, ha = f"half_time_{own}_goals", f"half_time_{opp}_goals"
    return f"""SELECT league_code, season, {own}_team AS team, '{own}' AS venue,
  CASE WHEN full_time_result = '{win}' THEN 1 ELSE 0 END AS wins,
  CASE WHEN full_time_result = 'D' THEN 1 ELSE 0 END AS draws,
  CASE WHEN full_time_result = '{loss}' THEN 1 ELSE 0 END AS losses,
  {gf} AS goals_for, {ga} AS goals_against,
  {hf} AS first_half_goals_for, {ha} AS first_half_goals_against,
  {gf} - {hf} AS second_half_goals_for, {ga} - {ha} AS second_half_goals_against,
  {own}_shots AS shots_for, {opp}_shots AS shots_against,
  {own}_shots_on_target AS shots_on_target_for, {opp}_shots_on_target AS shots_on_target_against,
  {own}_corners AS corners_for, {opp}_corners AS corners_against,
  {own}_fouls AS fouls_for, {opp}_fouls AS fouls_against,
  {own}_yellow_cards AS yellow_cards, {own}_red_cards AS red_cards,
  CASE WHEN {ga} = 0 THEN 1 ELSE 0 END AS clean_sheets,
  CASE WHEN {gf} = 0 THEN 1 ELSE 0 END AS failed_to_score,
  CAST(({gf} > 0 AND {ga} > 0) AS INT) AS both_teams_scored_matches,
  CASE WHEN {gf} + {ga} >= 2 THEN 1 ELSE 0 END AS over_1_5_matches,
  CASE WHEN {gf} + {ga} >= 3 THEN 1 ELSE 0 END AS over_2_5_matches,
  CASE WHEN {gf} + {ga} >= 4 THEN 1 ELSE 0 END AS over_3_5_matches,
  CAST({hf} > {ha} AS INT) AS leading_at_half,
  CAST({hf} < {ha} AS INT) AS trailing_at_half,
  CASE WHEN {hf} < {ha} AND full_time_result <> '{loss}' THEN 1 ELSE 0 END AS comeback_results,
  CASE WHEN {hf} > {ha} AND full_time_result <> '{win}' THEN 1 ELSE 0 END AS blown_leads
FROM silver"""


TEAM_ROWS = _side("home", "away", "H", "A") + "\nUNION ALL\n" + _side("away", "home", "A", "H")

_SUMMED = ("wins draws losses goals_for goals_against first_half_goals_for first_half_goals_against "
           "second_half_goals_for second_half_goals_against shots_for shots_against shots_on_target_for "
           "shots_on_target_against corners_for corners_against fouls_for fouls_against yellow_cards red_cards "
           "clean_sheets failed_to_score both_teams_scored_matches over_1_5_matches over_2_5_matches "
           "over_3_5_matches leading_at_half trailing_at_half comeback_results blown_leads").split()

TEAM_COUNTS = (
    "SELECT league_code, season, team, count(*) AS matches_played,\n  "
    + big("sum(CASE WHEN venue = 'home' THEN 1 ELSE 0 END)") + " AS home_matches,\n  "
    + big("sum(CASE WHEN venue = 'away' THEN 1 ELSE 0 END)") + " AS away_matches,\n  "
    + ",\n  ".join(f"{big(f'sum({c})')} AS {c}" for c in _SUMMED)
    + "\nFROM team_rows GROUP BY league_code, season, team"
)

_MP = "matches_played"
_TEAM_METRICS = [
    ("goal_difference", "goals_for - goals_against"),
    ("points", "wins * 3 + draws"),
    ("win_rate", r("wins", _MP)),
    ("draw_rate", r("draws", _MP)),
    ("loss_rate", r("losses", _MP)),
    ("points_per_match", r("wins * 3 + draws", _MP)),
    ("goals_for_per_match", r("goals_for", _MP)),
    ("goals_against_per_match", r("goals_against", _MP)),
    ("goal_difference_per_match", r("goals_for - goals_against", _MP)),
    ("clean_sheet_rate", r("clean_sheets", _MP)),
    ("failed_to_score_rate", r("failed_to_score", _MP)),
    ("both_teams_scored_rate", r("both_teams_scored_matches", _MP)),
    ("over_1_5_rate", r("over_1_5_matches", _MP)),
    ("over_2_5_rate", r("over_2_5_matches", _MP)),
    ("over_3_5_rate", r("over_3_5_matches", _MP)),
    ("first_half_goals_for_per_match", r("first_half_goals_for", _MP)),
    ("first_half_goals_against_per_match", r("first_half_goals_against", _MP)),
    ("second_half_goals_for_per_match", r("second_half_goals_for", _MP)),
    ("second_half_goals_against_per_match", r("second_half_goals_against", _MP)),
    ("avg_shots_for", r("shots_for", _MP)),
    ("avg_shots_against", r("shots_against", _MP)),
    ("avg_shots_on_target_for", r("shots_on_target_for", _MP)),
    ("avg_shots_on_target_against", r("shots_on_target_against", _MP)),
    ("shot_dominance_index", r("shots_for - shots_against", _MP)),
    ("on_target_dominance_index", r("shots_on_target_for - shots_on_target_against", _MP)),
    ("territorial_dominance_proxy", r("corners_for - corners_against", _MP)),
    ("shot_accuracy", r("shots_on_target_for", "shots_for")),
    ("shot_conversion_rate", r("goals_for", "shots_for")),
    ("net_efficiency", f"{r('goals_for', 'shots_on_target_for')} - {r('goals_against', 'shots_on_target_against')}"),
    ("pressure_without_payoff", f"{r('shots_for', _MP)} - {r('goals_for', _MP)}"),
    ("opponent_suppression_rate", f"1.0 - {r('shots_on_target_against', 'shots_against')}"),
    ("avg_corners_for", r("corners_for", _MP)),
    ("avg_corners_against", r("corners_against", _MP)),
    ("avg_fouls_for", r("fouls_for", _MP)),
    ("avg_fouls_against", r("fouls_against", _MP)),
    ("avg_yellow_cards", r("yellow_cards", _MP)),
    ("avg_red_cards", r("red_cards", _MP)),
    ("fast_start_rate", r("leading_at_half", _MP)),
    ("second_half_surge_index", r("second_half_goals_for", "goals_for")),
    ("second_half_collapse_index", r("second_half_goals_against", "goals_against")),
    ("comeback_rate", r("comeback_results", "trailing_at_half")),
    ("blown_lead_rate", r("blown_leads", "leading_at_half")),
    ("first_half_control_index", r("first_half_goals_for - first_half_goals_against", _MP)),
    ("discipline_points", "yellow_cards + red_cards * 2"),
    ("discipline_points_per_match", r("yellow_cards + red_cards * 2", _MP)),
]

TEAM_TABLE = (
    "SELECT team, matches_played, home_matches, away_matches, " + ", ".join(_SUMMED) + ",\n  "
    + ",\n  ".join(f"{e} AS {n}" for n, e in _TEAM_METRICS)
    + ",\n  league_code, season\nFROM team_counts"
)

_TOTAL = "(full_time_home_goals + full_time_away_goals)"
LEAGUE_SUMMARY = f"""SELECT * ,
  {r('home_wins', 'matches')} AS home_win_rate,
  {r('draws', 'matches')} AS draw_rate,
  {r('away_wins', 'matches')} AS away_win_rate,
  {r('home_goals', 'matches')} AS avg_home_goals,
  {r('away_goals', 'matches')} AS avg_away_goals,
  {r('both_teams_scored_matches', 'matches')} AS both_teams_scored_rate,
  {r('over_1_5_matches', 'matches')} AS over_1_5_rate,
  {r('over_2_5_matches', 'matches')} AS over_2_5_rate,
  {r('over_3_5_matches', 'matches')} AS over_3_5_rate
FROM (
 SELECT league_code, season, count(*) AS matches,
  {big("sum(CASE WHEN full_time_result = 'H' THEN 1 ELSE 0 END)")} AS home_wins,
  {big("sum(CASE WHEN full_time_result = 'D' THEN 1 ELSE 0 END)")} AS draws,
  {big("sum(CASE WHEN full_time_result = 'A' THEN 1 ELSE 0 END)")} AS away_wins,
  {big('sum(full_time_home_goals)')} AS home_goals,
  {big('sum(full_time_away_goals)')} AS away_goals,
  avg({_TOTAL}) AS avg_goals_per_match,
  {big(f'sum({_TOTAL})')} AS total_goals,
  {big('sum(CASE WHEN full_time_home_goals > 0 AND full_time_away_goals > 0 THEN 1 ELSE 0 END)')} AS both_teams_scored_matches,
  {big(f'sum(CASE WHEN {_TOTAL} >= 2 THEN 1 ELSE 0 END)')} AS over_1_5_matches,
  {big(f'sum(CASE WHEN {_TOTAL} >= 3 THEN 1 ELSE 0 END)')} AS over_2_5_matches,
  {big(f'sum(CASE WHEN {_TOTAL} >= 4 THEN 1 ELSE 0 END)')} AS over_3_5_matches,
  avg(home_shots + away_shots) AS avg_shots_per_match,
  avg(home_shots_on_target + away_shots_on_target) AS avg_shots_on_target_per_match,
  avg(home_corners + away_corners) AS avg_corners_per_match,
  avg(home_fouls + away_fouls) AS avg_fouls_per_match,
  avg(home_yellow_cards + away_yellow_cards) AS avg_yellow_cards_per_match,
  avg(home_red_cards + away_red_cards) AS avg_red_cards_per_match
 FROM silver GROUP BY league_code, season) s"""

RANKED_COLUMNS = (
    "league_code, season, team, matches_played, home_matches, away_matches, wins, draws, losses, points, "
    "goal_difference, goals_for, goals_against, win_rate, points_per_match, goals_for_per_match, "
    "goals_against_per_match, clean_sheet_rate, both_teams_scored_rate, over_2_5_rate, shot_dominance_index, "
    "on_target_dominance_index, territorial_dominance_proxy, net_efficiency, pressure_without_payoff, "
    "opponent_suppression_rate, fast_start_rate, second_half_surge_index, second_half_collapse_index, "
    "comeback_rate, blown_lead_rate, first_half_control_index, shot_accuracy, shot_conversion_rate, "
    "discipline_points_per_match"
)
RANKED = (
    f"SELECT {RANKED_COLUMNS},\n  DENSE_RANK() OVER (PARTITION BY league_code, season "
    "ORDER BY points DESC, goal_difference DESC, goals_for DESC, team ASC) AS league_position\nFROM team_table"
)

SILVER_COLUMNS = (
    "season_start_year, match_date, home_team, away_team, full_time_home_goals, full_time_away_goals, "
    "half_time_home_goals, half_time_away_goals, full_time_result, home_shots, away_shots, "
    "home_shots_on_target, away_shots_on_target, home_corners, away_corners, home_fouls, away_fouls, "
    "home_yellow_cards, away_yellow_cards, home_red_cards, away_red_cards"
)


def with_ctes(final: str, *names: str) -> str:
    """``WITH raw AS (F6), <named stages …> <final>``; stages in dependency order."""
    stages = {
        "silver": silver_select(),
        "team_rows": TEAM_ROWS,
        "team_counts": TEAM_COUNTS,
        "team_table": TEAM_TABLE,
        "league_summary": LEAGUE_SUMMARY,
        "ranked": RANKED,
    }
    parts = [f"raw AS (\n{RAW_SQL}\n)"] + [f"{n} AS (\n{stages[n]}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + final


_GOLD = ("silver", "team_rows", "team_counts", "team_table")

BRONZE_VIEW_COLUMNS = (
    'ingestion_run_id, league_code, season, source_file, "Div", "Date", "HomeTeam", "AwayTeam", "FTHG", '
    '"FTAG", "FTR", "HTHG", "HTAG", CAST(NULL AS VARCHAR) AS "HTR", "HS", "AS", "HST", "AST", "HC", "AC", '
    '"HF", "AF", "HY", "AY", "HR", "AR"'
)

ORACLE: dict[str, str] = {
    "raw_matches": with_ctes("SELECT * FROM raw"),
    "silver_matches": with_ctes("SELECT * FROM silver", "silver"),
    "bronze_view": with_ctes(f"SELECT {BRONZE_VIEW_COLUMNS} FROM raw"),
    "matches_enriched": with_ctes(
        f"""SELECT league_code, season, {SILVER_COLUMNS},
  full_time_home_goals + full_time_away_goals AS total_goals,
  half_time_home_goals + half_time_away_goals AS first_half_goals,
  (full_time_home_goals - half_time_home_goals) + (full_time_away_goals - half_time_away_goals) AS second_half_goals,
  CASE WHEN full_time_result = 'H' THEN home_team WHEN full_time_result = 'A' THEN away_team END AS winning_team,
  CASE WHEN full_time_result = 'D' THEN TRUE ELSE FALSE END AS is_draw
FROM silver""", "silver"),
    "team_match_rows": with_ctes("SELECT * FROM team_rows", "silver", "team_rows"),
    "team_season_counts": with_ctes("SELECT * FROM team_counts", "silver", "team_rows", "team_counts"),
    "team_season_table": with_ctes("SELECT * FROM team_table", *_GOLD),
    "league_season_summary": with_ctes("SELECT * FROM league_summary", "silver", "league_summary"),
    "league_summary_view": with_ctes(
        """SELECT league_code, season, matches, home_wins, draws, away_wins, total_goals, avg_goals_per_match,
  avg_home_goals, avg_away_goals, home_win_rate, draw_rate, away_win_rate, both_teams_scored_matches,
  both_teams_scored_rate, over_1_5_matches, over_1_5_rate, over_2_5_matches, over_2_5_rate, over_3_5_matches,
  over_3_5_rate, avg_shots_per_match, avg_shots_on_target_per_match, avg_corners_per_match, avg_fouls_per_match,
  avg_yellow_cards_per_match, avg_red_cards_per_match, avg_home_goals - avg_away_goals AS home_goal_advantage
FROM league_summary""", "silver", "league_summary"),
    "league_table_ranked": with_ctes("SELECT * FROM ranked", *_GOLD, "ranked"),
    "champions": with_ctes("SELECT * FROM ranked WHERE league_position = 1", *_GOLD, "ranked"),
}


# --- column functions, provenance, drift, landing ------------------------------

_LEAGUE_RE = r"([^/\\]+)[/\\][^/\\]+\.csv$"
_SEASON_RE = r"([^/\\]+)\.csv$"
# The league dictionary, as a lookup for the oracle side.
_LEAGUES = (("E0", "england_premier_league"), ("E1", "england_championship"), ("SP1", "spain_la_liga"),
            ("SP2", "spain_segunda_division"), ("I1", "italy_serie_a"), ("I2", "italy_serie_b"),
            ("F1", "france_ligue_1"), ("F2", "france_ligue_2"), ("D1", "germany_bundesliga_1"),
            ("D2", "germany_bundesliga_2"), ("N1", "netherlands_eredivisie"), ("P1", "portugal_primeira_liga"))
_LEAGUE_VALUES = ", ".join(f"('{c}', '{n}')" for c, n in _LEAGUES)


def code_of(name_expr: str) -> str:
    return "CASE " + " ".join(f"WHEN {name_expr} = '{n}' THEN '{c}'" for c, n in _LEAGUES) + " END"


def season_code_sql(y: str) -> str:
    return f"lpad(CAST(({y}) % 100 AS VARCHAR), 2, '0') || lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0')"


_LEAGUE_OF = f"regexp_extract(source_file, '{_LEAGUE_RE}', 1)"
_SEASON_OF = f"regexp_extract(source_file, '{_SEASON_RE}', 1)"
_CALENDAR = (f"SELECT CAST(y AS INT) AS season_start_year, {season_code_sql('y')} AS season FROM "
             f"(SELECT unnest(generate_series(min(sy), max(sy))) AS y FROM (SELECT {start_year_expr('season')} AS sy FROM raw))")
_MANIFEST = (f"SELECT l.code AS league_code, l.name AS league_name, c.season AS season, "
             f"'file:///landing/_runs/run0/' || l.name || '/' || c.season || '.csv' AS path "
             f"FROM (VALUES {_LEAGUE_VALUES}) l(code, name) CROSS JOIN calendar c")
_LANDING = (
    "SELECT m.league_code, m.league_name, m.season, m.path, f.league_name IS NOT NULL AS success, "
    "CASE WHEN f.league_name IS NOT NULL THEN 'landed ' || m.league_code || ' season ' || m.season "
    "ELSE 'no data for ' || m.league_code || ' season ' || m.season END AS message "
    f"FROM manifest m LEFT JOIN (SELECT DISTINCT {_LEAGUE_OF} AS league_name, {_SEASON_OF} AS season FROM raw) f "
    "ON m.league_name = f.league_name AND m.season = f.season"
)
_NARROW = ('ingestion_run_id, source_file, league_name, "Div", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", '
           '"FTR", league_code, season')


def with_stages(final: str, **stages: str) -> str:
    """``WITH raw AS (F6), <given stages> <final>``."""
    parts = [f"raw AS (\n{RAW_SQL}\n)"] + [f"{n} AS (\n{sql}\n)" for n, sql in stages.items()]
    return "WITH " + ",\n".join(parts) + "\n" + final


def bronze_select(src: str) -> str:
    """The bronze table of landed files with the columns of ``src``; blank cells are NULL in CSV, absent columns too."""
    held = ("Div", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HS", "AS", "HST", "AST", "HC", "AC",
            "HF", "AF", "HY", "AY", "HR", "AR")
    absent = ("HTR", "Attendance", "Referee", "HHW", "AHW", "HO", "AO", "HBP", "ABP", "GBH", "GBD", "GBA", "IWH", "IWD", "IWA",
              "LBH", "LBD", "LBA", "SBH", "SBD", "SBA", "WHH", "WHD", "WHA")
    cells = [f'nullif("{c}", \'\') AS "{c}"' for c in held] + [f'CAST(NULL AS VARCHAR) AS "{c}"' for c in absent]
    return ("SELECT 'run0' AS ingestion_run_id, 'run0/league_name=' || league_name || '/season=' || season AS source_file, "
            f"league_name, league_code, season, {', '.join(cells)}, '{{}}' AS extra_columns FROM {src}")


_DRIFT = (f"SELECT {_NARROW} FROM raw WHERE {start_year_expr('season')} < 1996\n"
          f"UNION ALL BY NAME\nSELECT * FROM raw WHERE NOT ({start_year_expr('season')} < 1996)")

ORACLE.update({
    "match_dates": with_ctes(f'SELECT "Date" AS date_text, {date_expr(chr(34) + "Date" + chr(34))} AS match_date FROM raw'),
    "lenient_int": with_ctes(
        "SELECT " + ", ".join(f'"{c}" AS {c.lower()}_text, {iint(chr(34) + c + chr(34))} AS {c.lower()}_int'
                              for c in ("FTHG", "HTAG", "HS")) + " FROM raw"),
    "null_defaults": with_ctes(
        "SELECT full_time_result, count(*) AS matches, CAST(sum(full_time_home_goals) AS BIGINT) AS home_goals, "
        "CAST(count_if(full_time_home_goals = 0) AS BIGINT) AS home_zero_goals FROM silver GROUP BY full_time_result",
        "silver"),
    "season_start_year": with_ctes(
        f"SELECT season, {start_year_expr('season')} AS season_start_year, count(*) AS matches FROM raw GROUP BY season"),
    "required_keys": with_ctes(
        "SELECT league_code, season, reason AS reject_reason, count(*) AS matches FROM ("
        "SELECT league_code, season, CASE WHEN \"HomeTeam\" IS NULL THEN 'missing home_team' "
        "WHEN \"AwayTeam\" IS NULL THEN 'missing away_team' WHEN league_code IS NULL THEN 'unknown league' "
        "WHEN season IS NULL THEN 'missing season' END AS reason FROM raw) t "
        "WHERE reason IS NOT NULL GROUP BY league_code, season, reason"),
    "path_provenance": with_ctes(
        f"SELECT source_file, 'run0' AS ingestion_run_id, {_LEAGUE_OF} AS league_name, "
        f"{code_of(_LEAGUE_OF)} AS league_code, {_SEASON_OF} AS season FROM raw"),
    "league_code_lookup": with_ctes(
        f"SELECT league_name, {code_of('league_name')} AS league_code, count(*) AS matches "
        f"FROM (SELECT {_LEAGUE_OF} AS league_name FROM raw) t GROUP BY league_name"),
    "schema_drift_union": with_stages("SELECT * FROM silver", drift=_DRIFT, silver=silver_select("drift")),
    "season_calendar": with_stages("SELECT * FROM calendar", calendar=_CALENDAR),
    "ingest_manifest": with_stages("SELECT * FROM manifest", calendar=_CALENDAR, manifest=_MANIFEST),
    "landing_results": with_stages("SELECT * FROM landing", calendar=_CALENDAR, manifest=_MANIFEST, landing=_LANDING),
    "ingest_summary": with_stages(
        "SELECT CAST(count_if(success) AS BIGINT) AS successes, count(*) AS total FROM landing",
        calendar=_CALENDAR, manifest=_MANIFEST, landing=_LANDING),
    "league_list_parse": with_ctes('SELECT DISTINCT season, "Div" AS league_code, league_name FROM raw'),
})


# --- write/read back, catalog, landed CSV, model --------------------------------
# Writing a layer and reading it back (directly, through the catalog, or from
# landed CSV files) must not change a value, so these compare with the direct
# computation over the same tables.

_FEATURES = ("full_time_home_goals, full_time_away_goals, half_time_home_goals, half_time_away_goals, "
             "home_shots, away_shots")

ORACLE.update({
    "partition_roundtrip": ORACLE["silver_matches"],
    "pruned_read": with_ctes("SELECT * FROM silver WHERE league_code = 'E0'", "silver"),
    "catalog_tables": ORACLE["silver_matches"],
    "catalog_views": ORACLE["league_table_ranked"],
    "landing_check": ORACLE["landing_results"],
    "landing_to_silver": ORACLE["schema_drift_union"],
    "bronze_extra_columns": with_ctes(
        """SELECT league_code, season, "Date", "AwayTeam", "HC", "HC" || '.25' AS b365h,
        CASE WHEN "AC" <> '0' THEN "AC" || '.5' END AS psh, CASE WHEN "AC" <> '0' THEN 2 ELSE 1 END AS n_extra FROM raw"""),
    "outcome_split": with_ctes(
        f"SELECT {_FEATURES}, CASE full_time_result WHEN 'D' THEN 0 WHEN 'H' THEN 1 WHEN 'A' THEN 2 END AS label, "
        "CAST('0x' || substr(md5(concat_ws('|', league_code, season, coalesce(CAST(match_date AS VARCHAR), ''), home_team, away_team)), 1, 8) AS BIGINT) % 100 < 20 AS in_test "
        "FROM silver WHERE season_start_year >= 1998 AND full_time_result IN ('D', 'H', 'A') AND "
        + " AND ".join(f"{c.strip()} IS NOT NULL" for c in _FEATURES.split(",")), "silver"),
    "ingest_success": with_stages("SELECT league_code, league_name, season, success, message FROM landing WHERE success",
                                  calendar=_CALENDAR, manifest=_MANIFEST, landing=_LANDING),
    "job_bronze": with_ctes(
        'SELECT league_code, season, "Date", "HomeTeam", "AwayTeam", "FTHG", '
        f"""CASE WHEN {start_year_expr('season')} >= 1996 THEN trim("HS") END AS "HS" FROM raw"""),
    "job_silver": ORACLE["schema_drift_union"],
    "job_run_all": with_stages("SELECT * FROM league_summary", drift=_DRIFT, silver=silver_select("drift"),
                               league_summary=LEAGUE_SUMMARY),
    "match_features": with_ctes(
        f"SELECT {_FEATURES}, CASE full_time_result WHEN 'D' THEN 0 WHEN 'H' THEN 1 WHEN 'A' THEN 2 END AS label "
        "FROM silver WHERE season_start_year >= 1998 AND full_time_result IN ('D', 'H', 'A') AND "
        + " AND ".join(f"{c.strip()} IS NOT NULL" for c in _FEATURES.split(",")), "silver"),
})

ORACLE.update({
    # the label's rows by side; that the forest's answers lie within the bound is the claim
    "outcome_evaluation": f"""SELECT n.label, p.predicted, n.train_rows_of_label, n.test_rows_of_label,
  TRUE AS train_within_bound, TRUE AS test_within_bound, TRUE AS loaded_model_alike
FROM (SELECT label, count(*) FILTER (WHERE NOT in_test) AS train_rows_of_label, count(*) FILTER (WHERE in_test) AS test_rows_of_label
      FROM ({ORACLE['outcome_split']}) GROUP BY label) n
CROSS JOIN (VALUES (0), (1), (2)) p(predicted)""",
    "run_ids": """SELECT DISTINCT s AS unix_seconds, strftime(make_timestamp(s * 1000000), '%Y%m%dT%H%M%SZ') AS run_id
FROM (SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) - CASE WHEN l_linenumber % 2 = 0 THEN 12000 ELSE 0 END AS BIGINT) * 86400
             + CASE WHEN l_linenumber = 1 THEN 86399 ELSE l_orderkey * 7919 % 86400 END AS s FROM lineitem)""",
    "job_run_report": with_stages(
        """SELECT 'run0' AS run_id, layer, rows, rejected_rows, unlisted_files, CAST(946684799 AS BIGINT) AS finished_second
FROM (SELECT 'landing' AS layer, count_if(listed) AS rows, (SELECT count(*) FROM manifest) - count_if(listed) AS rejected_rows,
             count_if(NOT listed) AS unlisted_files FROM files
      UNION ALL SELECT 'bronze.matches', (SELECT count(*) FROM drift), 0, 0
      UNION ALL SELECT 'silver.matches', (SELECT count(*) FROM silver), (SELECT count(*) FROM drift) - (SELECT count(*) FROM silver), 0
      UNION ALL SELECT 'gold.team_season_table', (SELECT count(*) FROM (SELECT league_code, season, home_team AS team FROM silver
        UNION SELECT league_code, season, away_team FROM silver)), 0, 0
      UNION ALL SELECT 'gold.league_season_summary', (SELECT count(*) FROM (SELECT DISTINCT league_code, season FROM silver)), 0, 0)""",
        files=f"SELECT league_code <> 'I1' AND {start_year_expr('season')} >= 1995 AS listed FROM (SELECT DISTINCT league_code, season FROM raw)",
        manifest=f"SELECT 1 FROM (VALUES {_LEAGUE_VALUES}) l(code, name), range(1995, 2006) WHERE l.code <> 'I1'",
        drift=f"SELECT * FROM raw WHERE league_code <> 'I1' AND {start_year_expr('season')} >= 1995",
        silver=silver_select("drift")),
    # what the run landed: old seasons narrow; every column the wide layout holds, blanks around values kept
    "job_bronze": with_stages("SELECT * FROM bronze", drift=_DRIFT, bronze=bronze_select("drift")),
})


# --- metric families of the team table --------------------------------------------

_FAMILIES = {
    "team_season_rates": "win_rate, draw_rate, loss_rate, points_per_match, goals_for_per_match, "
                         "goals_against_per_match, goal_difference_per_match, clean_sheet_rate, failed_to_score_rate, "
                         "both_teams_scored_rate, over_1_5_rate, over_2_5_rate, over_3_5_rate",
    "team_shot_metrics": "shots_for, shots_against, shots_on_target_for, shots_on_target_against, avg_shots_for, "
                         "avg_shots_against, avg_shots_on_target_for, avg_shots_on_target_against, shot_dominance_index, "
                         "on_target_dominance_index, territorial_dominance_proxy, shot_accuracy, shot_conversion_rate, "
                         "net_efficiency, pressure_without_payoff, opponent_suppression_rate, avg_corners_for, "
                         "avg_corners_against, avg_fouls_for, avg_fouls_against",
    "team_half_metrics": "first_half_goals_for, first_half_goals_against, second_half_goals_for, "
                         "second_half_goals_against, leading_at_half, trailing_at_half, comeback_results, blown_leads, "
                         "first_half_goals_for_per_match, first_half_goals_against_per_match, "
                         "second_half_goals_for_per_match, second_half_goals_against_per_match, fast_start_rate, "
                         "second_half_surge_index, second_half_collapse_index, comeback_rate, blown_lead_rate, "
                         "first_half_control_index",
    "team_discipline": "yellow_cards, red_cards, avg_yellow_cards, avg_red_cards, discipline_points, "
                       "discipline_points_per_match",
}
ORACLE.update({name: with_ctes(f"SELECT league_code, season, team, {cols} FROM team_table", *_GOLD)
               for name, cols in _FAMILIES.items()})
