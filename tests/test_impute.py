"""The cleaning cascade against a brute-force pandas version on small random contests."""

import numpy as np
import pandas as pd
import pytest

from twosided.operators import impute
from twosided.operators.sides import to_contests, to_participants

KEY = ["row_id"]
CARDS, ELO = impute.CARDS, impute.ELO
SCHEMA = (
    "row_id int, home_team string, away_team string, season_year int, league string, match_round int, "
    "date string, referee string, home_yellow double, home_red double, away_yellow double, away_red double, "
    "capacity double, home_elo double, away_elo double"
)


def contests(seed, rows=240):
    rng = np.random.default_rng(seed)
    teams = np.array(list("abcdefgh"))
    home = rng.integers(0, 8, rows)
    away = (home + rng.integers(1, 8, rows)) % 8
    df = pd.DataFrame({"row_id": np.arange(rows), "home_team": teams[home], "away_team": teams[away]})
    df["season_year"] = rng.integers(2000, 2004, rows)
    df["league"] = np.where(rng.random(rows) < 0.8, np.where(home < 4, "one", "two"), "cup")
    df["match_round"] = rng.integers(1, 6, rows)
    df["date"], df["referee"] = "2000-01-01", "x"
    gone = (rng.random(rows) < 0.25) | ((df.season_year == 2001) & (df.league == "one"))
    lost = (df.season_year == 2002) & (df.league == "two")
    for side in ("home", "away"):
        off = gone | (lost & df[f"{side}_team"].isin(["e", "f"]))
        df[f"{side}_yellow"] = np.where(off, np.nan, rng.integers(0, 6, rows))
        df[f"{side}_red"] = np.where(off, np.nan, rng.integers(0, 3, rows))
        no_elo = ((df.season_year == 2003) & (df.league == "cup")) | (rng.random(rows) < 0.2)
        df[f"{side}_elo"] = np.where(no_elo, np.nan, rng.integers(40, 90, rows))
    df["capacity"] = np.where(rng.random(rows) < 0.3, np.nan, rng.integers(1, 9, rows) * 1000.0)
    return df[[c.split()[0] for c in SCHEMA.split(", ")]]


def brute_force(df):
    df = df.assign(missing_cards=df.home_yellow.isna(), missing_elo=df.home_elo.isna())

    def whole(frame, column):
        return [key for key, part in frame.groupby(["season_year", "league"]) if part[column].isna().all()]

    start = df.copy()
    for year, league in whole(start, "home_yellow"):
        at = (df.season_year == year) & (df.league == league)
        df.loc[at, CARDS] = df.loc[at, CARDS].fillna(start[start.season_year == year][CARDS].median())
    start = df.copy()
    for team in "abcdefgh":
        for (year, league), part in start.groupby(["season_year", "league"]):
            home, away = part[part.home_team == team], part[part.away_team == team]
            yellow = pd.concat([home.home_yellow, away.away_yellow])
            if len(yellow) and yellow.isna().all():
                medians = part[CARDS].median()
                df.loc[home.index, CARDS[:2]] = df.loc[home.index, CARDS[:2]].fillna(medians[CARDS[:2]])
                df.loc[away.index, CARDS[2:]] = df.loc[away.index, CARDS[2:]].fillna(medians[CARDS[2:]])
    df["capacity"] = df.capacity.fillna(df.groupby(["season_year", "league"]).capacity.transform("median"))
    start = df.copy()
    for year, league in whole(start, "home_elo"):
        at = (df.season_year == year) & (df.league == league)
        df.loc[at, ELO] = df.loc[at, ELO].fillna(start[start.season_year == year][ELO].median())

    sides = []
    for number, side in enumerate(("home", "away")):
        part = df[["row_id", "season_year", "league", "match_round"]].assign(side=side, side_ord=number)
        for name in ("team", "yellow", "red", "elo"):
            part[name] = df[f"{side}_{name}"]
        sides.append(part)
    long = pd.concat(sides).sort_values(["season_year", "match_round", "side_ord", "row_id"])
    for name in ("yellow", "red", "elo"):
        long[name] = long.groupby("team")[name].ffill()
    for name in ("yellow", "red"):
        long[name] = long.groupby(["season_year", "league", "team", "side"])[name].bfill()
        long[name] = long.groupby(["league", "team", "side"])[name].bfill()
    for side in ("home", "away"):
        part = long[long.side == side].set_index("row_id")
        for name in ("yellow", "red", "elo"):
            df[f"{side}_{name}"] = df.row_id.map(part[name])
    return df.drop(columns=["date", "referee"])


def to_spark(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), SCHEMA)


@pytest.mark.parametrize("seed,max_rows", [(1, 10**6), (2, 10**6), (3, 20)])
def test_cleaning_matches_brute_force(spark, seed, max_rows):
    pdf = contests(seed)
    want = brute_force(pdf.copy())
    got = impute.clean(to_spark(spark, pdf), KEY, max_rows=max_rows).toPandas().sort_values("row_id").reset_index()
    assert len(got) == len(want)
    for name in want.columns:
        if want[name].dtype.kind == "f":
            assert np.allclose(got[name].astype(float), want[name], equal_nan=True), name
        else:
            assert got[name].tolist() == want[name].tolist(), name
    # Cards and capacity have no gap where the league and team have any value to take.
    assert got.capacity.notna().all()


def test_reshaping_there_and_back_is_the_identity(spark):
    df = to_spark(spark, contests(5))
    rows = to_participants(df, ["team", "yellow", "elo"], KEY)
    assert rows.count() == 2 * df.count()
    columns = ["row_id", "home_team", "home_yellow", "home_elo", "away_team", "away_yellow", "away_elo"]
    back = to_contests(rows, KEY, ["team", "yellow", "elo"]).select(*columns)
    assert back.exceptAll(df.select(*columns)).isEmpty() and back.count() == df.count()


def test_blocks_without_any_source_stay_null(spark):
    pdf = contests(6)
    pdf[CARDS] = np.nan
    got = impute.fill_team_block_median(impute.fill_cards_by_season(to_spark(spark, pdf)))
    assert got.filter("home_yellow IS NOT NULL").isEmpty() and got.count() == len(pdf)


def test_null_group_keys_form_no_block(spark):
    df = spark.createDataFrame([(2000, None, None), (2000, "a", 1.0)], "season_year int, league string, home_yellow double")
    assert [r.league for r in impute.block_missing(df, "home_yellow").collect()] == ["a"]
