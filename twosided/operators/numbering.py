"""Row numbers, random order and samples that do not pass through one task.

Random order comes from a hash of a seed and the row's key, so a row keeps its place when a task runs again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twosided.session import materialise

_SLICE = "__slice"


def with_row_ids(df: DataFrame, order: Sequence[str], name: str = "row_id", slices: int | None = None) -> DataFrame:
    """``df`` numbered 0..n-1 along ``order`` (a total order).

    Rows are cut into consecutive slices, as many as shuffles have partitions unless given; slices are numbered alone
    and shifted by the rows before.
    """
    dealt = df.repartitionByRange(*order) if slices is None else df.repartitionByRange(slices, *order)
    sliced = materialise(dealt.withColumn(_SLICE, F.spark_partition_id()), "slices")
    # One row per slice, so this window and the broadcast are as small as the number of slices.
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(_SLICE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    place = F.row_number().over(Window.partitionBy(_SLICE).orderBy(*order)) - 1
    joined = sliced.withColumn("__place", place).join(F.broadcast(offsets), _SLICE)
    return joined.withColumn(name, F.col("__offset") + F.col("__place")).drop(_SLICE, "__offset", "__place")


def random_text(seed: int, *parts: Column | str) -> Column:
    """32 hexadecimal digits from the seed and the parts; their text order is a random order of the rows."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def random_number(seed: int, below: Column, *parts: Column | str) -> Column:
    """A number in [0, below) from the seed and the parts."""
    digits = F.substring(random_text(seed, *parts), 1, 15)
    return F.conv(digits, 16, 10).cast("long") % below


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows drawn without replacement; each task keeps its own first ``n`` before they meet."""
    return df.withColumn("__u", random_text(seed, *key)).orderBy("__u", *key).limit(n).drop("__u")


def _bucketed(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    # The first four digits cut each group into up to 65,536 ranges of the random order.
    df = df.withColumn("__u", random_text(seed, *key))
    return df.withColumn("__bucket", F.substring("__u", 1, 4))


def _offsets(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows before each random range of a group: at most 65,536 rows per group.

    Written, so that it brings no partitioning by group along, which a join would then impose on all rows.
    """
    counts = df.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return materialise(offsets, "offsets")


def _with_offsets(df: DataFrame, offsets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``df`` with its ranges' offsets; a null group is a group like others."""
    names = [*groups, "__bucket"]
    right = offsets.select(*[F.col(name).alias(f"__of_{i}") for i, name in enumerate(names)], "__offset")
    match = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__of_{i}")) for i, name in enumerate(names)])
    return df.join(right, match).drop(*[f"__of_{i}" for i in range(len(names))])


def with_random_place(df: DataFrame, groups: Sequence[str], key: Sequence[str], seed: int, name: str) -> DataFrame:
    """``df`` numbered 0..n-1 in random order within each group.

    Rows are ranked within a random range, which holds 1/65,536 of a group, and shifted by the ranges before it.
    """
    numbered = _bucketed(df, key, seed)
    offsets = _offsets(numbered, groups)
    within = Window.partitionBy(*groups, "__bucket").orderBy("__u", *key)
    numbered = numbered.withColumn("__place", F.row_number().over(within) - 1)
    joined = _with_offsets(numbered, offsets, groups)
    return joined.withColumn(name, F.col("__offset") + F.col("__place")).drop("__u", "__bucket", "__place", "__offset")


def under_sample(df: DataFrame, label: str, targets: Mapping[str, int], key: Sequence[str], seed: int = 42) -> DataFrame:
    """Per class a random choice of the target number of rows without replacement; other classes stay whole.

    Rows of other classes, a null one too, are neither ranked nor shuffled. Whole random ranges beyond a class's target
    are dropped before anything is ranked.
    """
    chosen = F.coalesce(F.col(label).isin(list(targets)), F.lit(False))
    whole = df.filter(~chosen)
    wanted = F.create_map(*[F.lit(item) for pair in targets.items() for item in pair])
    numbered = _bucketed(df.filter(chosen), key, seed)
    target = F.try_element_at(wanted, F.col(label)).cast("long")
    offsets = _offsets(numbered, [label])
    kept = _with_offsets(numbered, offsets, [label]).filter(F.col("__offset") < target)
    within = Window.partitionBy(label, "__bucket").orderBy("__u", *key)
    place = F.col("__offset") + F.row_number().over(within) - 1
    sampled = kept.withColumn("__place", place).filter(F.col("__place") < target).select(*df.columns)
    return sampled.unionByName(whole)


def over_sample(
    df: DataFrame, label: str, targets: Mapping[str, int], key: Sequence[str], seed: int = 42, copy: str = "copy"
) -> DataFrame:
    """All rows, plus rows drawn with replacement until each class has its target; ``copy`` is 0 on the originals.

    Each draw picks a random place of its class. Draws are first counted per place, so that the join sees every
    place once, and only drawn rows are repeated.
    """
    spark = df.sparkSession
    # One row per class reaches the driver.
    sizes = {row[label]: row["n"] for row in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    short = {value: targets[value] - n for value, n in sizes.items() if targets.get(value, 0) > n}
    originals = df.withColumn(copy, F.lit(0))
    if not short:
        return originals
    draws = None
    for value, missing in short.items():
        place = random_number(seed, F.lit(sizes[value]), F.lit(value), F.col("id").cast("string"))
        drawn = spark.range(missing).select(F.lit(value).alias(label), place.alias("__at"))
        draws = drawn if draws is None else draws.unionByName(drawn)
    times = draws.groupBy(label, "__at").agg(F.count(F.lit(1)).cast("int").alias("__times"))
    placed = with_random_place(df.filter(F.col(label).isin(list(short))), [label], key, seed, "__at")
    repeated = placed.join(times, [label, "__at"])
    repeated = repeated.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("__times"))).alias(copy))
    return originals.unionByName(repeated)
