"""Look-back features."""

from pyspark.sql import functions as F

from twosided.catalog.contest_sql import CONTESTS, participants
from twosided.operators.features import (
    contest_features,
    home_away_features,
    participant_features,
    side_form,
    team_season_features,
)
from twosided.operators.ordered import LookBackSum, SumBefore, with_ordered
from twosided.operators.sides import attach, to_contests, to_participants
from twosided.plans.contest_view import ROW_KEY, contest_table

ORDER = ["match_round", "home_team", "away_team"]
LONG_ORDER = ["match_round", "side_ord", "home_team", "away_team"]
SEASON_TEAM = ["team", "season_year"]


def side_form_last5(spark, sf_dir):
    rows = to_participants(contest_table(spark, sf_dir), ["team", "points"], ["match_round", *ROW_KEY])
    rows = with_ordered(rows, SEASON_TEAM, LONG_ORDER, {"form": LookBackSum("points", 5)})
    return to_contests(rows, ROW_KEY, ["form"])


def side_total_before(spark, sf_dir):
    rows = to_participants(contest_table(spark, sf_dir), ["team", "goals"], ["match_round", *ROW_KEY])
    rows = with_ordered(rows, SEASON_TEAM, LONG_ORDER, {"total_goals": SumBefore("goals")})
    return to_contests(rows, ROW_KEY, ["total_goals"])


def discipline_last5(spark, sf_dir):
    rows = participant_features(contest_table(spark, sf_dir), ROW_KEY)
    return rows.select(*ROW_KEY, "side", "team", F.round("discipline", 6).alias("discipline"))


def home_form_last3(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "match_round", "home_points")
    return side_form(df, "home", ORDER).drop("match_round", "home_points")


def away_form_last3(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "match_round", "away_points")
    return side_form(df, "away", ORDER).drop("match_round", "away_points")


def home_away_frame(spark, sf_dir):
    columns = ["match_round", "home_points", "away_points", "home_goals", "away_goals"]
    return home_away_features(contest_table(spark, sf_dir).select(*ROW_KEY, *columns), ORDER).drop(*columns)


def goals_conceded_at_home(spark, sf_dir):
    columns = ["match_round", "home_points", "away_points", "home_goals", "away_goals"]
    df = contest_table(spark, sf_dir).select(*ROW_KEY, *columns)
    df = home_away_features(df, ORDER, away_goals_by="home_team")
    return df.select(*ROW_KEY, F.col("away_team_away_total_goals").alias("conceded_before"))


def team_season_frame(spark, sf_dir):
    wide = team_season_features(contest_table(spark, sf_dir), ROW_KEY)
    return wide.withColumns({f"{s}_discipline": F.round(f"{s}_discipline", 6) for s in ("home", "away")})


def raw_contest_features(spark, sf_dir):
    df = contest_features(contest_table(spark, sf_dir).drop("date"), ROW_KEY)
    return df.withColumns({f"{s}_discipline": F.round(f"{s}_discipline", 6) for s in ("home", "away")})


def reshape_round_trip(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "home_goals", "away_goals", "home_elo", "away_elo")
    rows = to_participants(df, ["team", "goals", "elo"], ROW_KEY)
    return attach(df, to_contests(rows, ROW_KEY, ["goals", "elo"]), ROW_KEY)


def participant_rows(spark, sf_dir):
    columns = ["team", "goals", "yellow", "red", "points", "elo"]
    return to_participants(contest_table(spark, sf_dir), columns, ["match_round", "league", *ROW_KEY])


QUERIES = {
    "side_form_last5": side_form_last5,
    "side_total_before": side_total_before,
    "discipline_last5": discipline_last5,
    "home_form_last3": home_form_last3,
    "away_form_last3": away_form_last3,
    "home_away_features": home_away_frame,
    "goals_conceded_at_home": goals_conceded_at_home,
    "team_season_features": team_season_frame,
    "contest_features": raw_contest_features,
    "reshape_round_trip": reshape_round_trip,
    "participant_rows": participant_rows,
}

LONG = f"WITH {CONTESTS}, {participants('contests')}"
LONG_WINDOW = "PARTITION BY team, season_year ORDER BY match_round, side_ord, home_team, away_team"
LAST5 = f"OVER ({LONG_WINDOW} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
BEFORE = f"OVER ({LONG_WINDOW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _wide(*measures: str) -> str:
    columns = [f"max(CASE WHEN side = '{s}' THEN {m} END) AS {s}_{m}" for s in ("home", "away") for m in measures]
    return "SELECT home_team, away_team, season_year, " + ", ".join(columns)


def side_window(side: str, frame: str, by: str = "") -> str:
    return (
        f"OVER (PARTITION BY {by or side}_team, season_year ORDER BY match_round, home_team, away_team "
        f"ROWS BETWEEN {frame} AND 1 PRECEDING)"
    )


def _side_sum(side: str, column: str, frame: str, by: str = "") -> str:
    return f"CAST(coalesce(sum({side}_{column}) {side_window(side, frame, by)}, 0) AS BIGINT)"


SIDE_COLUMNS = ", ".join(
    [f"{_side_sum(s, 'points', '3 PRECEDING')} AS {s}_team_{s}_form" for s in ("home", "away")]
    + [f"{_side_sum(s, 'goals', 'UNBOUNDED PRECEDING')} AS {s}_team_{s}_total_goals" for s in ("home", "away")]
)

LONG_FEATURES = f"""SELECT *,
  CAST(coalesce(sum(points) {LAST5}, 0) AS BIGINT) AS form,
  CAST(coalesce(sum(goals) {BEFORE}, 0) AS BIGINT) AS total_goals,
  round(coalesce(sum(red + yellow * 0.2) {LAST5}, 0), 6) AS discipline
FROM participants"""
TEAM_SEASON = f"{_wide('form', 'total_goals', 'discipline')} FROM ({LONG_FEATURES}) GROUP BY ALL"
CONTEST_FEATURES = f"""SELECT c.* EXCLUDE (date), {SIDE_COLUMNS}, t.home_form, t.home_total_goals, t.home_discipline,
  t.away_form, t.away_total_goals, t.away_discipline
FROM contests c JOIN ({TEAM_SEASON}) t USING (home_team, away_team, season_year)"""

ORACLE = {
    "side_form_last5": f"""{LONG} {_wide("form")} FROM (SELECT *,
        CAST(coalesce(sum(points) {LAST5}, 0) AS BIGINT) AS form FROM participants) GROUP BY ALL""",
    "side_total_before": f"""{LONG} {_wide("total_goals")} FROM (SELECT *,
        CAST(coalesce(sum(goals) {BEFORE}, 0) AS BIGINT) AS total_goals FROM participants) GROUP BY ALL""",
    "discipline_last5": f"""{LONG} SELECT home_team, away_team, season_year, side, team,
        round(coalesce(sum(red + yellow * 0.2) {LAST5}, 0), 6) AS discipline FROM participants""",
    "home_form_last3": f"""WITH {CONTESTS} SELECT home_team, away_team, season_year,
        {_side_sum("home", "points", "3 PRECEDING")} AS home_team_home_form FROM contests""",
    "away_form_last3": f"""WITH {CONTESTS} SELECT home_team, away_team, season_year,
        {_side_sum("away", "points", "3 PRECEDING")} AS away_team_away_form FROM contests""",
    "home_away_features": f"WITH {CONTESTS} SELECT home_team, away_team, season_year, {SIDE_COLUMNS} FROM contests",
    "goals_conceded_at_home": f"""WITH {CONTESTS} SELECT home_team, away_team, season_year,
        {_side_sum("away", "goals", "UNBOUNDED PRECEDING", "home")} AS conceded_before FROM contests""",
    "team_season_features": f"{LONG} {TEAM_SEASON}",
    "contest_features": f"{LONG} {CONTEST_FEATURES}",
    "reshape_round_trip": f"""WITH {CONTESTS} SELECT home_team, away_team, season_year, home_goals, away_goals,
        home_elo, away_elo FROM contests""",
    "participant_rows": f"{LONG} SELECT * FROM participants",
}
