"""Missing values: reports and fills."""

from pyspark.sql import functions as F

from twosided.catalog.contest_sql import CONTESTS, participants
from twosided.catalog.feature_queries import CONTEST_FEATURES
from twosided.operators import impute
from twosided.operators.ordered import FillBackward, FillForward, with_ordered
from twosided.operators.sides import to_participants
from twosided.plans.contest_view import ROW_KEY, cleaned_table, contest_table, feature_table, table
from twosided.session import co_partitioned, materialise

HISTORY = ["season_year", "match_round", "side_ord", "home_team", "away_team"]
MEASURES = ["yellow", "red", "elo"]


def _round(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


def missing_flags(spark, sf_dir):
    return impute.flag_missing(contest_table(spark, sf_dir)).select(*ROW_KEY, "missing_cards", "missing_elo")


def missing_blocks(spark, sf_dir):
    blocks = impute.block_missing(contest_table(spark, sf_dir), "home_yellow")
    kind = F.when(F.col("missing") == F.col("total"), "whole").when(F.col("missing") > 0, "part").otherwise("none")
    return blocks.withColumn("kind", kind)


def wholly_missing_blocks(spark, sf_dir):
    return impute.wholly_missing(impute.block_missing(contest_table(spark, sf_dir), "home_yellow"))


def partly_missing_blocks(spark, sf_dir):
    return impute.partly_missing(impute.block_missing(contest_table(spark, sf_dir), "capacity"))


def full_missing_teams(spark, sf_dir):
    return impute.wholly_missing(impute.participants_missing(contest_table(spark, sf_dir)))


def season_card_medians(spark, sf_dir):
    return impute.block_medians(contest_table(spark, sf_dir), impute.CARDS, wholly=True)


def team_block_medians(spark, sf_dir):
    return impute.team_block_medians(contest_table(spark, sf_dir))


def capacity_medians(spark, sf_dir):
    return impute.block_medians(contest_table(spark, sf_dir), ["capacity"], wholly=False)


def elo_season_medians(spark, sf_dir):
    return _round(impute.block_medians(contest_table(spark, sf_dir), impute.ELO, wholly=True), *impute.ELO)


def fill_block_season_median(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", *impute.CARDS)
    return impute.fill_cards_by_season(df)


def fill_team_block_median(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", *impute.CARDS)
    return impute.fill_team_block_median(df)


def fill_partial_block_median(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", "capacity")
    return impute.fill_block_median(df, ["capacity"])


def fill_elo_season_median(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", *impute.ELO)
    return _round(impute.fill_block_median(df, impute.ELO, wholly=True), *impute.ELO)


def _rows(spark, sf_dir):
    df = contest_table(spark, sf_dir)
    return to_participants(df, ["team", *MEASURES], [*ROW_KEY, "match_round", "league"])


def ffill_by_entity(spark, sf_dir):
    return with_ordered(_rows(spark, sf_dir), ["team"], HISTORY, {m: FillForward(m) for m in MEASURES})


def bfill_by_group(spark, sf_dir):
    keys = ["season_year", "league", "team", "side"]
    return with_ordered(_rows(spark, sf_dir), keys, HISTORY, {m: FillBackward(m) for m in MEASURES})


def bfill_across_seasons(spark, sf_dir):
    keys = ["league", "team", "side"]
    return with_ordered(_rows(spark, sf_dir), keys, HISTORY, {m: FillBackward(m) for m in MEASURES})


def _gappy_events(spark, sf_dir):
    value = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", value.alias("value"))


def event_ffill(spark, sf_dir):
    scan = {"value": FillForward("value")}
    return with_ordered(_gappy_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], scan).drop("ts")


def event_bfill(spark, sf_dir):
    scan = {"value": FillBackward("value")}
    return with_ordered(_gappy_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], scan).drop("ts")


def fill_history(spark, sf_dir):
    # Written, so that home rows stay where the fills left them and their shuffles go when that is done.
    with co_partitioned(spark):
        return materialise(impute.fill_along_history(contest_table(spark, sf_dir).drop("date"), ROW_KEY, drop=(), paired=True), "history")


def fill_history_forward_only(spark, sf_dir):
    df = contest_table(spark, sf_dir).drop("date")
    return impute.fill_along_history(df, ROW_KEY, backward=(), order=("league", "season_year", "match_round"))


def clean_contests(spark, sf_dir):
    return _round(impute.clean(contest_table(spark, sf_dir), ROW_KEY), *impute.ELO)


def cleaned_features(spark, sf_dir):
    df = feature_table(spark, sf_dir)
    return _round(df, *impute.ELO, "home_discipline", "away_discipline")


def residual_nulls(spark, sf_dir):
    columns = [*impute.CARDS, "capacity", *impute.ELO]
    counts = [F.count_if(F.col(name).isNull()).alias(name) for name in columns]
    return cleaned_table(spark, sf_dir).agg(*counts)


QUERIES = {
    "missing_flags": missing_flags,
    "missing_blocks": missing_blocks,
    "wholly_missing_blocks": wholly_missing_blocks,
    "partly_missing_blocks": partly_missing_blocks,
    "full_missing_teams": full_missing_teams,
    "season_card_medians": season_card_medians,
    "team_block_medians": team_block_medians,
    "capacity_medians": capacity_medians,
    "elo_season_medians": elo_season_medians,
    "fill_block_season_median": fill_block_season_median,
    "fill_team_block_median": fill_team_block_median,
    "fill_partial_block_median": fill_partial_block_median,
    "fill_elo_season_median": fill_elo_season_median,
    "ffill_by_entity": ffill_by_entity,
    "bfill_by_group": bfill_by_group,
    "bfill_across_seasons": bfill_across_seasons,
    "event_ffill": event_ffill,
    "event_bfill": event_bfill,
    "fill_history": fill_history,
    "fill_history_forward_only": fill_history_forward_only,
    "clean_contests": clean_contests,
    "cleaned_features": cleaned_features,
    "residual_nulls": residual_nulls,
}

KEY = "home_team, away_team, season_year"
CARDS, ELO = impute.CARDS, impute.ELO


def _medians(columns):
    return ", ".join(f"median({c}) AS {c}" for c in columns)


def _whole_blocks(source, columns):
    """Blocks of ``source`` without any value in the first column, with the medians of their season."""
    return f"""SELECT b.season_year, b.league, {", ".join(f"m.{c}" for c in columns)}
    FROM (SELECT season_year, league FROM {source} GROUP BY ALL HAVING count({columns[0]}) = 0) b
    JOIN (SELECT season_year, {_medians(columns)} FROM {source} GROUP BY season_year) m USING (season_year)"""


def _filled(source, fill, on, columns):
    replaced = ", ".join(f"coalesce(s.{c}, f.{c}) AS {c}" for c in columns)
    return f"SELECT s.* REPLACE ({replaced}) FROM {source} s LEFT JOIN ({fill}) f ON {on}"


SAME_BLOCK = "s.season_year = f.season_year AND s.league = f.league"


def _team_medians(source):
    return f"""SELECT t.season_year, t.league, t.team, {", ".join(f"m.{c}" for c in CARDS)}
    FROM (SELECT season_year, league, team FROM (
            SELECT season_year, league, home_team AS team, home_yellow AS yellow FROM {source}
            UNION ALL SELECT season_year, league, away_team, away_yellow FROM {source})
          GROUP BY ALL HAVING count(yellow) = 0) t
    JOIN (SELECT season_year, league, {_medians(CARDS)} FROM {source} GROUP BY ALL) m USING (season_year, league)"""


def _team_filled(source):
    home = _filled(source, _team_medians(source), f"{SAME_BLOCK} AND s.home_team = f.team", CARDS[:2])
    return _filled(f"({home})", _team_medians(source), f"{SAME_BLOCK} AND s.away_team = f.team", CARDS[2:])


def _capacity_filled(source):
    return f"""SELECT * REPLACE (coalesce(capacity, median(capacity) OVER (PARTITION BY season_year, league))
    AS capacity) FROM {source}"""


ORDER_SQL = "season_year, match_round, side_ord, home_team, away_team"
UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
ONWARD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def _ahead(keys, columns=MEASURES, order=ORDER_SQL):
    return ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY {order} {UPTO}) AS {c}" for c in columns
    )


def _behind(keys, columns=MEASURES, order=ORDER_SQL):
    return ", ".join(
        f"first_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY {order} {ONWARD}) AS {c}" for c in columns
    )


def _history(source, order=ORDER_SQL, backward=True):
    """Forward fill per team, then the two backward fills one after the other, then back to contests."""
    rows = f"SELECT * REPLACE ({_ahead('team', order=order)}) FROM {source}_rows"
    if backward:
        rows = f"SELECT * REPLACE ({_behind('season_year, league, team, side', ['yellow', 'red'])}) FROM ({rows})"
        rows = f"SELECT * REPLACE ({_behind('league, team, side', ['yellow', 'red'])}) FROM ({rows})"
    wide = ", ".join(f"max(CASE WHEN side = '{s}' THEN {m} END) AS {s}_{m}" for s in ("home", "away") for m in MEASURES)
    kept = ", ".join([*CARDS, *ELO])
    return f"""SELECT c.* EXCLUDE ({kept}, date), h.* EXCLUDE (home_team, away_team, season_year)
    FROM {source} c JOIN (SELECT {KEY}, {wide} FROM ({rows}) GROUP BY {KEY}) h USING (home_team, away_team, season_year)"""


CLEANED = f"""WITH {CONTESTS},
flagged AS (SELECT *, home_yellow IS NULL AS missing_cards, home_elo IS NULL AS missing_elo FROM contests),
by_season AS ({_filled("flagged", _whole_blocks("flagged", CARDS), SAME_BLOCK, CARDS)}),
by_team AS ({_team_filled("by_season")}),
by_capacity AS ({_capacity_filled("by_team")}),
by_elo AS ({_filled("by_capacity", _whole_blocks("by_capacity", ELO), SAME_BLOCK, ELO)}),
{participants("by_elo", "by_elo_rows")},
cleaned AS ({_history("by_elo")})"""
ROUND_ELO = "round(home_elo, 6) AS home_elo, round(away_elo, 6) AS away_elo"
CARD_COLUMNS = f"{KEY}, league, {', '.join(CARDS)}"
LONG = f"WITH {CONTESTS}, {participants('contests')}"
LONG_COLUMNS = f"{KEY}, match_round, league, side, side_ord, team"
EVENTS = "(SELECT event_id, user_id, ts, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)"

ORACLE = {
    "missing_flags": f"""WITH {CONTESTS} SELECT {KEY}, home_yellow IS NULL AS missing_cards,
        home_elo IS NULL AS missing_elo FROM contests""",
    "missing_blocks": f"""WITH {CONTESTS} SELECT season_year, league, count(*) - count(home_yellow) AS missing,
        count(*) AS total, CASE WHEN count(home_yellow) = 0 THEN 'whole' WHEN count(home_yellow) < count(*)
        THEN 'part' ELSE 'none' END AS kind FROM contests GROUP BY season_year, league""",
    "wholly_missing_blocks": f"""WITH {CONTESTS} SELECT season_year, league, count(*) AS missing, count(*) AS total
        FROM contests GROUP BY season_year, league HAVING count(home_yellow) = 0""",
    "partly_missing_blocks": f"""WITH {CONTESTS} SELECT season_year, league, count(*) - count(capacity) AS missing,
        count(*) AS total FROM contests GROUP BY season_year, league
        HAVING count(capacity) > 0 AND count(capacity) < count(*)""",
    "full_missing_teams": f"""{LONG} SELECT season_year, league, team, count(*) AS missing, count(*) AS total
        FROM participants GROUP BY season_year, league, team HAVING count(yellow) = 0""",
    "season_card_medians": f"WITH {CONTESTS} {_whole_blocks('contests', CARDS)}",
    "team_block_medians": f"WITH {CONTESTS} {_team_medians('contests')}",
    "capacity_medians": f"""WITH {CONTESTS} SELECT season_year, league, median(capacity) AS capacity FROM contests
        GROUP BY season_year, league HAVING count(capacity) < count(*)""",
    "elo_season_medians": f"""WITH {CONTESTS} SELECT * REPLACE ({ROUND_ELO})
        FROM ({_whole_blocks("contests", ELO)})""",
    "fill_block_season_median": f"""WITH {CONTESTS} SELECT {CARD_COLUMNS}
        FROM ({_filled("contests", _whole_blocks("contests", CARDS), SAME_BLOCK, CARDS)})""",
    "fill_team_block_median": f"WITH {CONTESTS} SELECT {CARD_COLUMNS} FROM ({_team_filled('contests')})",
    "fill_partial_block_median": f"WITH {CONTESTS} SELECT {KEY}, league, capacity FROM ({_capacity_filled('contests')})",
    "fill_elo_season_median": f"""WITH {CONTESTS} SELECT {KEY}, league, {ROUND_ELO}
        FROM ({_filled("contests", _whole_blocks("contests", ELO), SAME_BLOCK, ELO)})""",
    "ffill_by_entity": f"{LONG} SELECT {LONG_COLUMNS}, {_ahead('team')} FROM participants",
    "bfill_by_group": f"{LONG} SELECT {LONG_COLUMNS}, {_behind('season_year, league, team, side')} FROM participants",
    "bfill_across_seasons": f"{LONG} SELECT {LONG_COLUMNS}, {_behind('league, team, side')} FROM participants",
    "event_ffill": f"SELECT event_id, user_id, {_ahead('user_id', ['value'], 'ts, event_id')} FROM {EVENTS}",
    "event_bfill": f"SELECT event_id, user_id, {_behind('user_id', ['value'], 'ts, event_id')} FROM {EVENTS}",
    "fill_history": f"WITH {CONTESTS}, {participants('contests', 'contests_rows')} {_history('contests')}",
    "fill_history_forward_only": f"""WITH {CONTESTS}, {participants("contests", "contests_rows")}
        {_history("contests", "league, " + ORDER_SQL, backward=False)}""",
    "clean_contests": f"{CLEANED} SELECT * REPLACE ({ROUND_ELO}) FROM cleaned",
    "cleaned_features": f"""{CLEANED}, {participants("cleaned")}
        SELECT * REPLACE ({ROUND_ELO}) FROM ({CONTEST_FEATURES.replace("c.* EXCLUDE (date)", "c.*").replace("FROM contests c", "FROM cleaned c")})""",
    "residual_nulls": f"""{CLEANED} SELECT
        {", ".join(f"count(*) - count({c}) AS {c}" for c in [*CARDS, "capacity", *ELO])} FROM cleaned""",
}
