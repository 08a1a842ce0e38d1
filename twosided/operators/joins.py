"""Left lookups of contests in their dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """``df`` with the columns of ``other`` whose text key matches; a null key matches nothing.

    A shuffle would send all rows without a key to one task, so they get a key of their own that spreads them and
    that no real key equals. Which side is broadcast, if any, is left to Spark's size threshold.
    """
    nobody = F.concat(F.lit("\u0000"), F.xxhash64(*[c for c in df.columns]).cast("string"))
    right = other.withColumnRenamed(other_key or key, "__key")
    joined = df.withColumn("__spread", F.coalesce(F.col(key), nobody))
    return joined.join(right, F.col("__spread") == F.col("__key"), "left").drop("__spread", "__key")


def merge_sources(scores: DataFrame, match_info: DataFrame, teams: DataFrame, ratings: DataFrame) -> DataFrame:
    """Scores with their match details by ``match_id``, the home team's capacity and the ratings by ``link``.

    Every lookup table holds a key at most once, so the number of rows stays that of ``scores``.
    """
    merged = left_lookup(scores, match_info, "match_id")
    merged = left_lookup(merged, teams.select("team", "capacity"), "home_team", "team")
    return left_lookup(merged, ratings, "link")


def unmatched(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` without a match, those with a null key included."""
    right = other.select(F.col(other_key or key).alias("__key"))
    return df.join(right, F.col(key) == F.col("__key"), "left_anti")
