"""Profiles, duplicates, gaps, row numbers and samples."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from twosided.catalog.contest_sql import CONTESTS, RAW
from twosided.catalog.impute_queries import CLEANED
from twosided.catalog.parse_queries import KEY, LEAGUE_SQL
from twosided.functions.text import league_labels
from twosided.operators import dedupe, numbering, profile
from twosided.operators.impute import ELO
from twosided.operators.ordered import LookBackSum, SumBefore, with_ordered
from twosided.operators.quantiles import grouped_median, grouped_quantiles
from twosided.plans.contest_view import ROW_KEY, SOURCE_ORDER, cleaned_table, contest_table, raw_contests, table
from twosided.session import materialise
from twosided.sources.schemas import LEAGUE_LABELS, LEAGUES

RESULTS = ["home_win", "draw", "away_win"]
MEASURES = ["match_round", "home_goals", "away_goals", "home_points", "away_points", "home_yellow", "home_red", "away_yellow",
            "away_red", "capacity", "home_elo", "away_elo"]


def _goals():
    return F.col("home_goals") + F.col("away_goals")


def _named(spark, sf_dir):
    """Contests with the name of their league."""
    names = F.array(*[F.lit(name) for name in LEAGUES])
    return contest_table(spark, sf_dir).withColumn("league", names[F.col("league")])


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


def keep_first(spark, sf_dir):
    df = dedupe.keep_first(raw_contests(spark, sf_dir), ROW_KEY, SOURCE_ORDER)
    return df.select(*ROW_KEY, "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def flag_repeats(spark, sf_dir):
    df = dedupe.flag_duplicates(raw_contests(spark, sf_dir), ROW_KEY, SOURCE_ORDER, name="repeated")
    return df.select(*SOURCE_ORDER[:6], "repeated")


def flag_shared(spark, sf_dir):
    df = dedupe.flag_duplicates(raw_contests(spark, sf_dir), ROW_KEY, SOURCE_ORDER, keep=None, name="shared")
    return df.agg(F.count_if("shared").alias("shared"), F.count_if(~F.col("shared")).alias("alone"))


def _orders_with_gaps(spark, sf_dir):
    """Orders whose status, a key or class here, is null where it was ``P``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))


def flag_null_keys(spark, sf_dir):
    df = _orders_with_gaps(spark, sf_dir)
    return dedupe.flag_duplicates(df, ["o_custkey", "o_orderstatus"], ["o_orderkey"], name="repeated")


def under_sampled_null_class(spark, sf_dir):
    return numbering.under_sample(_orders_with_gaps(spark, sf_dir), "o_orderstatus", {"O": 500, "F": 10**9}, ["o_orderkey"])


def place_null_class(spark, sf_dir):
    """How many rows of each class, a null one too, are numbered, and up to which place."""
    df = numbering.with_random_place(_orders_with_gaps(spark, sf_dir), ["o_orderstatus"], ["o_orderkey"], 42, "place")
    return df.groupBy("o_orderstatus").agg(F.count_distinct("place").alias("places"), F.max("place").alias("last"))


def row_ids_sliced(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*SOURCE_ORDER)
    return numbering.with_row_ids(lines, SOURCE_ORDER, slices=37).select(*SOURCE_ORDER[:6], "row_id")


def quantiles_by_rank(spark, sf_dir):
    """Quantiles by the way that many distinct values take."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    fractions = {"q00": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    df = grouped_quantiles(lines, ["l_returnflag"], ["l_extendedprice", "l_quantity"], fractions, max_rows=5_000)
    return _rounded(df, *fractions)


def split_running_sum(spark, sf_dir):
    """Running and look-back sums of prices, and the last known price, along groups that are cut into slices."""
    lines = table(spark, sf_dir, "lineitem").select(*SOURCE_ORDER)
    scans = {"before": SumBefore("l_extendedprice"), "last3": LookBackSum("l_extendedprice", 3)}
    df = with_ordered(lines, ["l_returnflag"], [c for c in SOURCE_ORDER if c != "l_returnflag"], scans, max_rows=4_000)
    return _rounded(df, "before", "last3").select(*SOURCE_ORDER[:6], "before", "last3")


def duplicate_groups(spark, sf_dir):
    raw = raw_contests(spark, sf_dir)
    return dedupe.duplicates_per_block(
        raw, ROW_KEY, SOURCE_ORDER, ["league", "season_year"], "home_goals", "num_duplicates"
    )


def teams_per_block(spark, sf_dir):
    return profile.distinct_per_block(contest_table(spark, sf_dir), ["league", "season_year"], "home_team", "num_teams")


def teams_per_block_wide(spark, sf_dir):
    counts = profile.distinct_per_block(_named(spark, sf_dir), ["league", "season_year"], "home_team", "num_teams")
    return profile.pivot_block(counts, "season_year", "league", None, F.first("num_teams")).na.fill(0)


def matches_per_block(spark, sf_dir):
    return profile.rows_per_block(contest_table(spark, sf_dir), ["league", "season_year"], "num_matches")


def rate_per_block(spark, sf_dir):
    df = profile.rate_per_block(contest_table(spark, sf_dir), ["league", "season_year"], {"goals_per_game": _goals()})
    return _rounded(df, "goals_per_game")


def rate_per_league(spark, sf_dir):
    rates = {"goals_per_game": _goals(), "home": F.col("home_goals"), "away": F.col("away_goals")}
    return _rounded(profile.rate_per_block(_named(spark, sf_dir), ["league"], rates), *rates)


def rate_by_country(spark, sf_dir):
    df = profile.rate_per_block(_named(spark, sf_dir), ["league"], {"goals_per_game": _goals()})
    df = league_labels(_rounded(df, "goals_per_game"), LEAGUE_LABELS)
    return profile.pivot_block(df, "country", "division", ["first", "second"], F.max("goals_per_game"))


def mix_percent(spark, sf_dir):
    df = profile.mix_percent(contest_table(spark, sf_dir), ["season_year"], "result", RESULTS)
    return _rounded(df, *RESULTS)


def absent_blocks(spark, sf_dir):
    rated = contest_table(spark, sf_dir).filter(F.col("home_elo").isNotNull())
    return profile.absent_pairs(rated, "season_year", "league")


def null_report(spark, sf_dir):
    return profile.null_report(contest_table(spark, sf_dir))


def total_nulls(spark, sf_dir):
    return profile.total_nulls(contest_table(spark, sf_dir))


def schema_report(spark, sf_dir):
    return profile.schema_report(contest_table(spark, sf_dir).select(*ROW_KEY, "result", *MEASURES))


def describe_measures(spark, sf_dir):
    df = profile.describe(contest_table(spark, sf_dir), MEASURES)
    return _rounded(df, "mean", "std", "q25", "q50", "q75")


def season_elo(spark, sf_dir):
    df = contest_table(spark, sf_dir)
    means = df.groupBy("season_year").agg(*[F.avg(name).alias(f"{name}_mean") for name in ELO])
    medians = grouped_median(df, ["season_year"], ELO).withColumnsRenamed({n: f"{n}_median" for n in ELO})
    return _rounded(means.join(medians, "season_year"), *[f"{n}_{k}" for n in ELO for k in ("mean", "median")])


def missing_sides(spark, sf_dir):
    home, away = F.col("home_yellow").isNull(), F.col("away_yellow").isNull()
    df = contest_table(spark, sf_dir).groupBy("season_year", "league")
    counts = df.agg(
        F.count_if(home & away).alias("both_missing"),
        F.count_if(home).alias("home_missing"),
        F.count_if(away).alias("away_missing"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.filter("both_missing > 0")


def value_frequencies(spark, sf_dir):
    return profile.value_frequencies(contest_table(spark, sf_dir), "result")


def majority_share(spark, sf_dir):
    return _rounded(profile.share_of(contest_table(spark, sf_dir), F.col("result") == "home_win", "share"), "share")


def distinct_teams(spark, sf_dir):
    return contest_table(spark, sf_dir).filter(F.col("capacity").isNull()).select("home_team").distinct()


def distinct_keys(spark, sf_dir):
    return contest_table(spark, sf_dir).agg(
        F.count_distinct("home_team").alias("home_teams"), F.count_distinct(*ROW_KEY).alias("contests")
    )


def season_league_pairs(spark, sf_dir):
    return contest_table(spark, sf_dir).select("season_year", "league").distinct()


def cumulative_share(spark, sf_dir):
    df = profile.cumulative_share(contest_table(spark, sf_dir), "season_year", 1997)
    return _rounded(df, "percent", "cumulative")


def histogram(spark, sf_dir):
    return _rounded(profile.histogram(contest_table(spark, sf_dir), ["capacity"], 22), "low", "high")


def feature_histograms(spark, sf_dir):
    return _rounded(profile.histogram(contest_table(spark, sf_dir), ["league", "season_year", *MEASURES], 20), "low", "high")


def quantiles_by_class(spark, sf_dir):
    df = contest_table(spark, sf_dir).withColumn("elo_diff", F.round(F.col("home_elo") - F.col("away_elo"), 2))
    df = profile.quantiles_by_class(df, "result", ["home_elo", "elo_diff"])
    return _rounded(df, "q00", "q25", "q50", "q75", "q100")


def line_price_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    df = profile.quantiles_by_class(lines, "l_returnflag", ["l_extendedprice", "l_quantity"])
    return _rounded(df, "q00", "q25", "q50", "q75", "q100")


def ordinal_codes(spark, sf_dir):
    return profile.ordinal_codes(_named(spark, sf_dir).select(*ROW_KEY, "league"), "league")


def row_ids(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*SOURCE_ORDER)
    return numbering.with_row_ids(lines, SOURCE_ORDER).select(*SOURCE_ORDER[:6], "row_id")


def first_rows(spark, sf_dir):
    return profile.first_rows(contest_table(spark, sf_dir).select(*ROW_KEY, "result"), ROW_KEY)


def last_rows(spark, sf_dir):
    return profile.last_rows(contest_table(spark, sf_dir).select(*ROW_KEY, "result"), ROW_KEY)


def sample_rows(spark, sf_dir):
    return numbering.sample_rows(contest_table(spark, sf_dir).select(*ROW_KEY, "result"), 5, ROW_KEY)


def best_season(spark, sf_dir):
    rates = profile.rate_per_block(contest_table(spark, sf_dir), ["season_year"], {"goals_per_game": _goals()})
    best = rates.agg(F.max_by("season_year", F.struct("goals_per_game", "season_year")).alias("season_year"),
                     F.max("goals_per_game").alias("goals_per_game"))
    return _rounded(best, "goals_per_game")


def under_sampled(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "result")
    return numbering.under_sample(df, "result", {"home_win": 200, "draw": 150}, ROW_KEY)


def over_sampled(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "result")
    return numbering.over_sample(df, "result", {"home_win": 0, "draw": 10**6, "away_win": 10**6}, ROW_KEY).groupBy(
        *ROW_KEY, "result"
    ).agg(F.count(F.lit(1)).alias("copies"))


def sort_by_rounds(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", "match_round")
    ordered = df.orderBy("league", "season_year", "home_team", "match_round", "away_team")
    # The place of a row in the sorted table: within its partition, shifted by the partitions before it.
    numbered = materialise(ordered.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return numbered.join(shifts, "part").select(*df.columns, (F.col("at") - F.col("first") + F.col("shift")).alias("place"))


def cleaned_nulls(spark, sf_dir):
    return profile.null_report(cleaned_table(spark, sf_dir), ["home_yellow", "away_red", "capacity", "home_elo"])


QUERIES = {
    "keep_first": keep_first,
    "flag_repeats": flag_repeats,
    "flag_shared": flag_shared,
    "flag_null_keys": flag_null_keys,
    "under_sampled_null_class": under_sampled_null_class,
    "place_null_class": place_null_class,
    "row_ids_sliced": row_ids_sliced,
    "quantiles_by_rank": quantiles_by_rank,
    "split_running_sum": split_running_sum,
    "duplicate_groups": duplicate_groups,
    "teams_per_block": teams_per_block,
    "teams_per_block_wide": teams_per_block_wide,
    "matches_per_block": matches_per_block,
    "rate_per_block": rate_per_block,
    "rate_per_league": rate_per_league,
    "rate_by_country": rate_by_country,
    "mix_percent": mix_percent,
    "absent_blocks": absent_blocks,
    "null_report": null_report,
    "total_nulls": total_nulls,
    "schema_report": schema_report,
    "describe_measures": describe_measures,
    "season_elo": season_elo,
    "missing_sides": missing_sides,
    "value_frequencies": value_frequencies,
    "majority_share": majority_share,
    "distinct_teams": distinct_teams,
    "distinct_keys": distinct_keys,
    "season_league_pairs": season_league_pairs,
    "cumulative_share": cumulative_share,
    "histogram": histogram,
    "feature_histograms": feature_histograms,
    "quantiles_by_class": quantiles_by_class,
    "line_price_quantiles": line_price_quantiles,
    "ordinal_codes": ordinal_codes,
    "row_ids": row_ids,
    "first_rows": first_rows,
    "last_rows": last_rows,
    "sample_rows": sample_rows,
    "best_season": best_season,
    "under_sampled": under_sampled,
    "over_sampled": over_sampled,
    "sort_by_rounds": sort_by_rounds,
    "cleaned_nulls": cleaned_nulls,
}

C = f"WITH {CONTESTS}"
NAMED = f"{C}, named AS (SELECT * REPLACE ({LEAGUE_SQL} AS league) FROM contests)"
STATUS = "nullif(o_orderstatus, 'P') AS o_orderstatus"
RAW_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
RATE = "round(CAST(sum(home_goals + away_goals) AS DOUBLE) / count(*), 6)"
DRAW = "md5(concat_ws('|', '42', home_team, away_team, season_year))"


def _column_nulls(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {source}" for c in columns
    )


CONTEST_COLUMNS = [
    *ROW_KEY, "league", "match_round", "home_goals", "away_goals", "result", "home_points", "away_points", "date",
    "home_yellow", "home_red", "away_yellow", "away_red", "capacity", "home_elo", "away_elo",
]
TYPES = {
    "match_round": "int",
    "home_points": "int",
    "away_points": "int",
    "home_team": "bigint", "away_team": "bigint", "season_year": "int", "result": "string", "home_goals": "int",
    "away_goals": "int",
}


def _histogram(column, bins):
    """Bins of one column between its own minimum and maximum; equal-width edges decide."""
    return f"""SELECT '{column}' AS "column", CAST(bin AS INTEGER) AS bin, round(low + (bin - 1) * width, 6) AS low,
      round(low + (bin - 1) * width + width, 6) AS high, count(*) AS "rows"
    FROM (SELECT low, width, CASE WHEN x < low + (near - 1) * width THEN near - 1
            WHEN x >= low + near * width AND near < {bins} THEN near + 1 ELSE near END AS bin
          FROM (SELECT CAST({column} AS DOUBLE) AS x, low, (high - low) / {bins} AS width,
                  least(CAST(floor(({column} - low) / (high - low) * {bins}) AS BIGINT) + 1, {bins}) AS near
                FROM contests, (SELECT CAST(min({column}) AS DOUBLE) AS low, CAST(max({column}) AS DOUBLE) AS high
                                FROM contests)
                WHERE {column} IS NOT NULL)) GROUP BY bin, low, width"""


def _quantiles(column, label, source):
    parts = ", ".join(f"round(quantile_cont({column}, {q / 100}), 6) AS q{q:02d}" for q in (0, 25, 50, 75, 100))
    return f"SELECT {label}, '{column}' AS measure, {parts} FROM {source} WHERE {column} IS NOT NULL GROUP BY {label}"


def _described(column):
    x = f"CAST({column} AS DOUBLE)"
    quartiles = ", ".join(f"round(quantile_cont({x}, {q / 100}), 6) AS q{q}" for q in (25, 50, 75))
    return f"""SELECT '{column}' AS measure, count({column}) AS count, round(avg({x}), 6) AS mean,
      round(stddev_samp({x}), 6) AS std, min({x}) AS min, max({x}) AS max, {quartiles} FROM contests"""


ORACLE = {
    "keep_first": f"{C} SELECT {KEY}, l_orderkey, l_linenumber, l_partkey, l_quantity FROM first_contests",
    "flag_repeats": f"""WITH {RAW} SELECT {RAW_COLUMNS},
        row_number() OVER (PARTITION BY {KEY} ORDER BY source_row) > 1 AS repeated FROM raw_contests""",
    "flag_shared": f"""WITH {RAW} SELECT count(*) FILTER (n > 1) AS shared, count(*) FILTER (n = 1) AS alone
        FROM (SELECT count(*) OVER (PARTITION BY {KEY}) AS n FROM raw_contests)""",
    "duplicate_groups": f"""WITH {RAW} SELECT league, season_year, count(home_goals) AS num_duplicates FROM (
        SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY source_row) AS n FROM raw_contests)
        WHERE n > 1 GROUP BY league, season_year""",
    "teams_per_block": f"""{C} SELECT league, season_year, count(DISTINCT home_team) AS num_teams FROM contests
        GROUP BY league, season_year""",
    "teams_per_block_wide": f"""{NAMED} SELECT season_year, {
        ", ".join(f"count(DISTINCT home_team) FILTER (league = '{x}') AS {x}" for x in LEAGUES[:5])
    } FROM named GROUP BY season_year""",
    "matches_per_block": f"{C} SELECT league, season_year, count(*) AS num_matches FROM contests GROUP BY ALL",
    "rate_per_block": f"{C} SELECT league, season_year, {RATE} AS goals_per_game FROM contests GROUP BY ALL",
    "rate_per_league": f"""{NAMED} SELECT league, {RATE} AS goals_per_game, round(avg(home_goals), 6) AS home,
        round(avg(away_goals), 6) AS away FROM named GROUP BY league""",
    "rate_by_country": f"""{NAMED}, rates AS (SELECT league, {RATE} AS rate FROM named GROUP BY league)
        SELECT CASE WHEN league IN ('premier_league', 'championship') THEN 'england'
                    WHEN league = 'bundesliga' THEN 'germany' ELSE 'spain' END AS country,
          max(rate) FILTER (league IN ('premier_league', 'primera_division', 'bundesliga')) AS "first",
          max(rate) FILTER (league IN ('championship', 'segunda_division')) AS "second"
        FROM rates GROUP BY country""",
    "mix_percent": f"""{C} SELECT season_year, {
        ", ".join(f"round(100.0 * count(*) FILTER (result = '{r}') / count(*), 6) AS {r}" for r in RESULTS)
    } FROM contests GROUP BY season_year""",
    "absent_blocks": f"""{C}, kept AS (SELECT season_year, league FROM contests WHERE home_elo IS NOT NULL)
        SELECT s.season_year, l.league FROM (SELECT DISTINCT season_year FROM kept) s
        CROSS JOIN (SELECT DISTINCT league FROM kept) l
        WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.season_year = s.season_year AND k.league = l.league)""",
    "null_report": f"{C} {_column_nulls(CONTEST_COLUMNS, 'contests')}",
    "total_nulls": f"{C} SELECT CAST(sum(nulls) AS BIGINT) AS nulls FROM ({_column_nulls(CONTEST_COLUMNS, 'contests')})",
    "schema_report": f"{C} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{TYPES.get(c, "double")}' AS "type", count({c}) AS present,
        count(*) AS "rows" FROM contests"""
        for c in [*ROW_KEY, "result", *MEASURES]
    ),
    "describe_measures": f"{C} " + " UNION ALL ".join(_described(c) for c in MEASURES),
    "season_elo": f"""{C} SELECT season_year, {
        ", ".join(f"round(avg({n}), 6) AS {n}_mean, round(median({n}), 6) AS {n}_median" for n in ELO)
    } FROM contests GROUP BY season_year""",
    "missing_sides": f"""{C} SELECT season_year, league,
        count(*) FILTER (home_yellow IS NULL AND away_yellow IS NULL) AS both_missing,
        count(*) FILTER (home_yellow IS NULL) AS home_missing, count(*) FILTER (away_yellow IS NULL) AS away_missing,
        count(*) AS total FROM contests GROUP BY season_year, league HAVING both_missing > 0""",
    "value_frequencies": f'{C} SELECT result, count(*) AS "rows" FROM contests GROUP BY result ORDER BY 2 DESC, 1',
    "majority_share": f"""{C} SELECT round(avg(CASE WHEN result = 'home_win' THEN 1.0 ELSE 0.0 END), 6) AS share
        FROM contests""",
    "distinct_teams": f"{C} SELECT DISTINCT home_team FROM contests WHERE capacity IS NULL",
    "distinct_keys": f"""{C} SELECT count(DISTINCT home_team) AS home_teams,
        count(DISTINCT (home_team, away_team, season_year)) AS contests FROM contests""",
    "season_league_pairs": f"{C} SELECT DISTINCT season_year, league FROM contests",
    "cumulative_share": f"""{C} SELECT * FROM (SELECT season_year, n AS "rows", round(100.0 * n / sum(n) OVER (), 6) AS percent,
          round(100.0 * sum(n) OVER (ORDER BY season_year) / sum(n) OVER (), 6) AS cumulative
        FROM (SELECT season_year, count(*) AS n FROM contests GROUP BY season_year)) WHERE season_year >= 1997""",
    "histogram": f"{C} {_histogram('capacity', 22)}",
    "feature_histograms": f"{C} "
    + " UNION ALL ".join(_histogram(c, 20) for c in ["league", "season_year", *MEASURES]),
    "quantiles_by_class": f"""{C}, diffs AS (SELECT result, home_elo, round(home_elo - away_elo, 2) AS elo_diff
        FROM contests) {_quantiles("home_elo", "result", "diffs")}
        UNION ALL {_quantiles("elo_diff", "result", "diffs")}""",
    "line_price_quantiles": f"""{_quantiles("l_extendedprice", "l_returnflag", "lineitem")}
        UNION ALL {_quantiles("l_quantity", "l_returnflag", "lineitem")}""",
    "ordinal_codes": f"{NAMED} SELECT {KEY}, league, dense_rank() OVER (ORDER BY league) - 1 AS code FROM named",
    "row_ids": f"""SELECT {RAW_COLUMNS}, row_number() OVER (ORDER BY {", ".join(SOURCE_ORDER)}) - 1 AS row_id
        FROM lineitem""",
    "first_rows": f"{C} SELECT {KEY}, result FROM contests ORDER BY {KEY} LIMIT 5",
    "last_rows": f"""{C} SELECT {KEY}, result FROM contests
        ORDER BY home_team DESC, away_team DESC, season_year DESC LIMIT 5""",
    "sample_rows": f"{C} SELECT {KEY}, result FROM contests ORDER BY {DRAW}, {KEY} LIMIT 5",
    "best_season": f"""{C} SELECT season_year, {RATE} AS goals_per_game FROM contests GROUP BY season_year
        ORDER BY CAST(sum(home_goals + away_goals) AS DOUBLE) / count(*) DESC, season_year DESC LIMIT 1""",
    "under_sampled": f"""{C} SELECT {KEY}, result FROM contests
        QUALIFY row_number() OVER (PARTITION BY result ORDER BY {DRAW}, {KEY})
          <= CASE result WHEN 'home_win' THEN 200 WHEN 'draw' THEN 150 ELSE 1000000000000 END""",
    "over_sampled": f"""{C}, classed AS (SELECT {KEY}, result, count(*) OVER (PARTITION BY result) AS size,
          row_number() OVER (PARTITION BY result ORDER BY {DRAW}, {KEY}) - 1 AS place
        FROM contests),
        sizes AS (SELECT DISTINCT result, size FROM classed WHERE result <> 'home_win'),
        draws AS (SELECT result, CAST('0x' || substr(md5(concat_ws('|', '42', result, i)), 1, 15) AS BIGINT) % size
            AS place, count(*) AS times
          FROM sizes CROSS JOIN range(1000000) r(i) WHERE i < 1000000 - size GROUP BY ALL)
        SELECT {KEY}, result, 1 + coalesce(times, 0) AS copies FROM classed LEFT JOIN draws USING (result, place)""",
    "sort_by_rounds": f"""{C} SELECT {KEY}, league, match_round, row_number() OVER (
        ORDER BY league, season_year, home_team, match_round, away_team) - 1 AS place FROM contests""",
    "flag_null_keys": f"""SELECT o_orderkey, o_custkey, {STATUS}, row_number() OVER (
        PARTITION BY o_custkey, nullif(o_orderstatus, 'P') ORDER BY o_orderkey) > 1 AS repeated FROM orders""",
    "under_sampled_null_class": f"""SELECT o_orderkey, o_custkey, {STATUS} FROM orders
        QUALIFY o_orderstatus <> 'O' OR row_number() OVER (
          PARTITION BY o_orderstatus ORDER BY md5(concat_ws('|', '42', o_orderkey)), o_orderkey) <= 500""",
    "place_null_class": f"SELECT {STATUS}, count(*) AS places, count(*) - 1 AS last FROM orders GROUP BY 1",
    "row_ids_sliced": f"""SELECT {RAW_COLUMNS}, row_number() OVER (ORDER BY {", ".join(SOURCE_ORDER)}) - 1 AS row_id
        FROM lineitem""",
    "quantiles_by_rank": f"""{_quantiles("l_extendedprice", "l_returnflag", "lineitem")}
        UNION ALL {_quantiles("l_quantity", "l_returnflag", "lineitem")}""",
    "split_running_sum": f"""SELECT {RAW_COLUMNS},
        round(CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(28, 12))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE), 6)
          AS before,
        round(coalesce(sum(l_extendedprice) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0), 6) AS last3 FROM lineitem
        WINDOW w AS (PARTITION BY l_returnflag ORDER BY {", ".join(c for c in SOURCE_ORDER if c != "l_returnflag")})""",
    "cleaned_nulls": f"""{CLEANED} {
        _column_nulls(["home_yellow", "away_red", "capacity", "home_elo"], "cleaned")
    }""",
}
