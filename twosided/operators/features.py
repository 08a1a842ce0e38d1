"""Features of a participant's earlier contests; the contest itself never enters its own features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosided.operators.impute import CleanedRows
from twosided.operators.ordered import MAX_GROUP_ROWS, LookBackSum, SumBefore, oversized_groups, with_ordered
from twosided.operators.sides import SIDES, attach, to_contests, to_participants

# Names of the model's inputs: fixed values.
FEATURES = [
    "season_year", "match_round", "capacity", "missing_cards", "missing_elo", "home_elo", "away_elo",
    "home_team_home_form", "away_team_away_form", "home_team_home_total_goals", "away_team_away_total_goals",
    "home_form", "home_total_goals", "home_discipline", "away_form", "away_total_goals", "away_discipline",
]

# Difference features: name -> (home column, away column).
DIFFERENCES = {
    "elo_diff": ("home_elo", "away_elo"),
    "team_home_away_form_diff": ("home_team_home_form", "away_team_away_form"),
    "team_home_away_total_goals_diff": ("home_team_home_total_goals", "away_team_away_total_goals"),
    "form_diff": ("home_form", "away_form"),
    "total_goals_diff": ("home_total_goals", "away_total_goals"),
    "discipline_diff": ("home_discipline", "away_discipline"),
}


def card_score(yellow: str = "yellow", red: str = "red", red_weight: float = 1.0, yellow_weight: float = 0.2) -> Column:
    return F.col(red) * red_weight + F.col(yellow) * yellow_weight


def side_form(
    df: DataFrame,
    side: str,
    order: Sequence[str],
    window_length: int = 3,
    season: str = "season_year",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Points from the side's last contests on that same side in the season: ``home_team_home_form`` and so on."""
    scans = {f"{side}_team_{side}_form": LookBackSum(f"{side}_points", window_length)}
    return with_ordered(df, [f"{side}_team", season], order, scans, max_rows)


def side_goals(
    df: DataFrame,
    side: str,
    order: Sequence[str],
    season: str = "season_year",
    by: str | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Goals of the side so far in the season; ``by`` names another team column to group on."""
    scans = {f"{side}_team_{side}_total_goals": SumBefore(f"{side}_goals")}
    return with_ordered(df, [by or f"{side}_team", season], order, scans, max_rows)


def home_away_features(
    df: DataFrame, order: Sequence[str], window_length: int = 3, away_goals_by: str = "away_team", **options
) -> DataFrame:
    """The four features of one side's own contests, on the frame of contests.

    ``away_goals_by='home_team'`` sums the goals conceded at home instead of the away team's own.
    """
    for side in SIDES:
        df = side_form(df, side, order, window_length, **options)
    df = side_goals(df, "home", order, **options)
    return side_goals(df, "away", order, by=away_goals_by, **options)


def participant_features(
    df: DataFrame,
    row_key: Sequence[str],
    order: Sequence[str] = ("match_round",),
    window_length: int = 5,
    red_weight: float = 1.0,
    yellow_weight: float = 0.2,
    side_window_length: int | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per participant with ``form``, ``total_goals`` and ``discipline`` over both sides' contests.

    With ``side_window_length`` also ``side_form`` and ``side_goals``, over contests on the same side: they need
    no further shuffle, as rows partitioned by (team, season) serve the finer grouping by side too.
    """
    keep = list(dict.fromkeys([*row_key, "season_year", *order]))
    rows = to_participants(df, ["team", "goals", "points", "yellow", "red"], keep)
    teams = to_participants(df, ["team"], ["season_year"])
    check = oversized_groups(teams, ["team", "season_year"], max_rows) is not None
    return _with_features(rows, row_key, order, window_length, red_weight, yellow_weight, side_window_length, max_rows, teams, check)


def _with_features(
    rows: DataFrame,
    row_key: Sequence[str],
    order: Sequence[str],
    window_length: int,
    red_weight: float,
    yellow_weight: float,
    side_window_length: int | None,
    max_rows: int,
    teams: DataFrame | None,
    check: bool,
) -> DataFrame:
    """:func:`participant_features` of rows that already are one per participant."""
    rows = rows.withColumn("card_score", card_score("yellow", "red", red_weight, yellow_weight))
    total_order = [*order, "side_ord", *[key for key in row_key if key not in order]]
    group = ["team", "season_year"]
    both = {
        "form": LookBackSum("points", window_length),
        "total_goals": SumBefore("goals"),
        "discipline": LookBackSum("card_score", window_length),
    }
    rows = with_ordered(rows, group, total_order, both, max_rows, teams, check)
    if side_window_length is not None:
        one = {"side_form": LookBackSum("points", side_window_length), "side_goals": SumBefore("goals")}
        rows = with_ordered(rows, [*group, "side"], total_order, one, max_rows, teams, check)
    return rows


def team_season_features(df: DataFrame, row_key: Sequence[str], **options) -> DataFrame:
    """``home_`` and ``away_`` form, total goals and discipline, one row per contest."""
    rows = participant_features(df, row_key, **options)
    return to_contests(rows, row_key, ["form", "total_goals", "discipline"])


def contest_features(
    df: DataFrame, row_key: Sequence[str], window_length: int = 5, side_window_length: int = 3, **options
) -> DataFrame:
    """``df`` with all ten features.

    All of them come from one pass over participant rows: one shuffle by team and season, one back to contests
    and the join with ``df``.
    """
    rows = participant_features(
        df, row_key, window_length=window_length, side_window_length=side_window_length, **options
    )
    wide = to_contests(rows, row_key, MEASURED)
    return attach(df, wide.withColumnsRenamed(RENAMED), row_key)


MEASURED = ["form", "total_goals", "discipline", "side_form", "side_goals"]
RENAMED = {f"{s}_side_form": f"{s}_team_{s}_form" for s in SIDES} | {f"{s}_side_goals": f"{s}_team_{s}_total_goals" for s in SIDES}


def features_of_rows(
    cleaned: CleanedRows, order: Sequence[str] = ("match_round",), window_length: int = 5, side_window_length: int = 3,
    red_weight: float = 1.0, yellow_weight: float = 0.2, max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """:func:`contest_features` of cleaned contests, from the participant rows that the fills along histories leave.

    Rows partitioned by team serve the finer grouping by team and season, so features need no shuffle of their own; the rows
    have ``goals`` and ``points`` too. ``row_key`` is unique; contests that lack a part of it get neither fills nor features.
    """
    known = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in cleaned.row_key])
    rows = _with_features(
        cleaned.rows.withColumns({name: F.when(known, F.col(name)) for name in ("yellow", "red")}), cleaned.row_key, order, window_length, red_weight, yellow_weight, side_window_length, max_rows, None, cleaned.large)
    return replace(cleaned, rows=rows, measures=[*cleaned.measures, *MEASURED]).contests().withColumnsRenamed(RENAMED)


def difference_features(df: DataFrame, pairs: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Replace each pair of columns by its home-minus-away difference."""
    pairs = DIFFERENCES if pairs is None else pairs
    used = {name for pair in pairs.values() for name in pair}
    kept = [name for name in df.columns if name not in used]
    return df.select(*kept, *[(F.col(home) - F.col(away)).alias(name) for name, (home, away) in pairs.items()])
