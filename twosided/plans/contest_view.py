"""A contests table derived from the driver's order tables (see FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twosided.operators.dedupe import keep_first
from twosided.operators.features import features_of_rows
from twosided.operators.impute import clean, cleaned_rows
from twosided.session import co_partitioned, materialise, shared_folder, spread_shuffles

ROW_KEY = ["home_team", "away_team", "season_year"]
# Full line rows are unique, so their columns give every raw contest a place in a total order.
SOURCE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

_views: dict[tuple[str, str, str, str], DataFrame] = {}
_line_rows: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str) -> None:
    """Shuffles of contests begin with partitions by the number of lines, which is read from the files' footers."""
    key = (spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _line_rows:
        _line_rows[key] = table(spark, sf_dir, "lineitem").count()
    spread_shuffles(spark, _line_rows[key])


def _keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines with the key of their contest; what else a contest has is told by these columns (:func:`_with_fields`)."""
    _spread(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier")
    teams = suppliers.count()
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    home = (F.col("o_custkey") % teams).alias("home_team")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(F.col("o_custkey") % teams != F.col("l_suppkey"))
        .select(*lines.columns, "o_custkey", home, F.col("l_suppkey").alias("away_team"), F.year("l_shipdate").alias("season_year"))
    )


def _with_fields(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {
            "league": (F.col("home_team") % 5).cast("int"),
            "match_round": F.month("l_shipdate"),
            "home_goals": F.col("l_quantity").cast("int") % 5,
            "away_goals": F.col("l_linenumber") % 4,
        }
    )


def raw_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contest per order line, duplicates included, with the line columns as its source order."""
    return _with_fields(_keyed_lines(spark, sf_dir))


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value.cast("double"))


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first raw contest per (home, away, season) with its measures; lazy, see :func:`contest_table`."""
    # Only the key and the order are shuffled; l_suppkey is the away team, one of the key.
    lines = _keyed_lines(spark, sf_dir).drop("l_suppkey")
    first = _with_fields(keep_first(lines, ROW_KEY, [name for name in SOURCE_ORDER if name != "l_suppkey"]))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    joined = first.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        suppliers, F.col("away_team") == F.col("s_suppkey"), "left"
    )
    season, league, part = F.col("season_year"), F.col("league"), F.col("l_partkey")
    block_gone = ((season == 1996) & (league == 2)) | (part % 11 == 0)
    home_gone = block_gone | ((season == 1998) & (F.col("home_team") % 10 == 3))
    away_gone = block_gone | ((season == 1998) & (F.col("away_team") % 10 == 3))
    elo_gone = ((season == 1997) & (league == 4)) | (part % 7 == 0)
    home, away = F.col("home_goals"), F.col("away_goals")
    return joined.select(
        *ROW_KEY,
        "league",
        "match_round",
        "home_goals",
        "away_goals",
        F.when(home > away, "home_win").when(home == away, "draw").otherwise("away_win").alias("result"),
        F.when(home > away, 3).when(home == away, 1).otherwise(0).alias("home_points"),
        F.when(home > away, 0).when(home == away, 1).otherwise(3).alias("away_points"),
        F.col("l_shipdate").alias("date"),
        _null_when(home_gone, part % 6).alias("home_yellow"),
        _null_when(home_gone, (part % 13 == 0).cast("int")).alias("home_red"),
        _null_when(away_gone, F.floor(part / 6) % 6).alias("away_yellow"),
        _null_when(away_gone, (part % 17 == 0).cast("int")).alias("away_red"),
        _null_when(F.col("home_team") % 9 == 0, 1000 * (F.col("home_team") % 50 + 1)).alias("capacity"),
        _null_when(elo_gone, F.col("c_acctbal")).alias("home_elo"),
        _null_when(elo_gone, F.col("s_acctbal")).alias("away_elo"),
    )


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`raw_contests`, written once for all sources that are spelled out from it."""
    return _written_once(spark, sf_dir, "raw_contests", lambda: raw_contests(spark, sf_dir))


def contest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`contests`, written once per session so that later queries read only the columns they need."""
    return _written_once(spark, sf_dir, "contests", lambda: contests(spark, sf_dir))


def _written_once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    _spread(spark, sf_dir)
    key = (spark.conf.get("spark.app.id", ""), shared_folder(spark), sf_dir, name)
    if key not in _views:
        df = build()
        with co_partitioned(spark):
            _views[key] = materialise(df, name)
    return _views[key]


def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contests after every fill, written so that features start from a table instead of the whole cascade."""
    return _written_once(
        spark, sf_dir, "cleaned", lambda: clean(contest_table(spark, sf_dir), ROW_KEY, drop=("date",), paired=True)
    )


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned contests with their ten features, written once: the input of every model.

    Fills and features share the participant rows, so this is no more shuffles than :func:`cleaned_table` alone.
    """
    return _written_once(
        spark, sf_dir, "features",
        lambda: features_of_rows(cleaned_rows(contest_table(spark, sf_dir), ROW_KEY, drop=("date",), also=("goals", "points"), paired=True)),
    )
