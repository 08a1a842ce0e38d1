"""Duplicate rows: keep the first, flag the others, count them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twosided.session import materialise


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per ``keys`` along ``order``.

    The filter on a row number of 1 lets Spark keep one row per group and task before the shuffle (the plan shows
    WindowGroupLimit Partial), so a group with very many copies shrinks before it meets in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str | None = "first", name: str = "duplicated"
) -> DataFrame:
    """Flag each row that repeats an earlier one (``keep='first'``) or shares its keys at all (``keep=None``).

    The groups with several rows are found by an aggregate, counted before the shuffle, and joined back from a
    written table: it is broadcast if its files are small, and otherwise adaptive execution can split a skewed join,
    which it cannot when one side is an aggregate. A null key equals a null key, as in :func:`keep_first`.
    """
    place = F.struct(*order)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"), F.min(place).alias("__first"))
    groups = materialise(groups.filter(F.col("__copies") > 1), "copies")
    renamed = groups.withColumnsRenamed({key: f"__key_{i}" for i, key in enumerate(keys)})
    match = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__key_{i}")) for i, key in enumerate(keys)])
    joined = df.join(renamed, match, "left").drop(*[f"__key_{i}" for i in range(len(keys))])
    repeated = F.col("__copies").isNotNull()
    if keep == "first":
        repeated = repeated & (place > F.col("__first"))
    return joined.withColumn(name, F.coalesce(repeated, F.lit(False))).drop("__copies", "__first")


def duplicates_per_block(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Sequence[str], counted: str, name: str
) -> DataFrame:
    """Per ``block``: how many rows repeat an earlier row of the same ``keys``, counting non-null ``counted``.

    Rows are first reduced to one per (keys, block); the first row of each key is then taken out of its count.
    """
    extra = [column for column in block if column not in keys]
    place = F.struct(*order)
    reduced = df.groupBy(*keys, *extra).agg(
        F.count(counted).alias("__n"),
        F.count(F.lit(1)).alias("__rows"),
        F.min(F.struct(place.alias("at"), F.col(counted).isNotNull().cast("int").alias("has"))).alias("__first"),
    )
    # One row per (keys, block) is left, so this window sees at most as many rows as a key has blocks.
    earliest = F.min("__first").over(Window.partitionBy(*keys))
    repeats = F.col("__n") - F.when(F.col("__first") == earliest, F.col("__first")["has"]).otherwise(0)
    rows = F.col("__rows") - F.when(F.col("__first") == earliest, 1).otherwise(0)
    return (
        reduced.withColumns({"__repeats": repeats, "__later": rows})
        .filter(F.col("__later") > 0)
        .groupBy(*block)
        .agg(F.sum("__repeats").alias(name))
    )
