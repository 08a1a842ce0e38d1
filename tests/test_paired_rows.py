"""Contests put together from rows partitioned by team, against the way by shuffles of both sides."""

import random

import pytest

from twosided.operators.features import contest_features, features_of_rows
from twosided.operators.impute import clean, cleaned_rows
from twosided.operators.sides import attach, by_team, pair, to_contests, to_participants
from twosided.session import co_partitioned

KEY = ["home_team", "away_team", "season_year"]
SCHEMA = (
    "home_team long, away_team long, season_year int, league int, match_round int, result string, home_goals int, away_goals int, "
    "home_points int, away_points int, home_yellow double, home_red double, away_yellow double, away_red double, "
    "capacity double, home_elo double, away_elo double"
)


def contests(spark, seed=1):
    """Every pair of eight teams in three seasons and, with its keys unique, some without a season."""
    draw = random.Random(seed)
    rows = []
    for season in (2000, 2001, 2002, None):
        for home in range(8):
            for away in range(8):
                if home != away and draw.random() < 0.8:
                    some = lambda top: None if draw.random() < 0.4 or (season, home % 2) == (2001, 1) else float(draw.randrange(top))
                    cards = [None] * 4 if season == 2002 and home < 2 else [some(6), some(2), some(6), some(2)]
                    rows.append((home, away, season, home % 2, draw.randrange(5), "draw", draw.randrange(4), draw.randrange(4), draw.randrange(4), draw.randrange(4),
                                 *cards, some(9), some(50), some(50)))
    return spark.createDataFrame(rows, SCHEMA)


def in_order(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_fills_and_features_in_one_pass_equal_both_one_after_the_other(spark, max_rows):
    df = contests(spark)
    want = contest_features(clean(df, KEY, max_rows=max_rows), KEY, max_rows=max_rows)
    with co_partitioned(spark):
        got = features_of_rows(cleaned_rows(df, KEY, max_rows=max_rows, also=("goals", "points"), paired=True), max_rows=max_rows)
        assert sorted(got.dtypes) == sorted(want.dtypes)
        found = in_order(got)
        assert in_order(clean(df, KEY, max_rows=max_rows, paired=True)) == in_order(clean(df, KEY, max_rows=max_rows))
    assert found == in_order(want)
    assert got.filter("season_year IS NULL AND home_form IS NULL").count() == df.filter("season_year IS NULL").count() > 0


def test_only_away_rows_are_shuffled_back(spark):
    with co_partitioned(spark):
        df = features_of_rows(cleaned_rows(contests(spark), KEY, also=("goals", "points"), paired=True))
        plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    by_key = [line for line in dealt if line.startswith("home_team") and "away_team" in line]
    assert not by_key and sum(line.startswith("home_team") for line in dealt) == 1


def test_pairs_with_repeated_and_null_keys(spark):
    rows = [(1, 2, 2000, 5, 1.0, 2.0), (1, 2, 2000, 6, 3.0, None), (2, 1, 2000, 7, None, 4.0), (None, 2, 2000, 8, 5.0, 6.0), (2, None, None, 9, 7.0, 8.0)]
    df = spark.createDataFrame(rows, "home_team long, away_team long, season_year int, note int, home_elo double, away_elo double")
    want = attach(df, to_contests(to_participants(df, ["team", "elo"], KEY), KEY, ["elo"]), KEY)
    got = pair(by_team(to_participants(df, ["team", "elo"], KEY, ["note"])), KEY, ["elo"], [*KEY, "note"])
    assert in_order(got) == in_order(want) and got.columns == want.columns
