"""Exact medians and quantiles per group, from counts of distinct values.

Rows are counted per (group, column, value) before the shuffle, so a group that holds a large share of the table
becomes as small as its number of distinct values. A group whose values fit one aggregate is finished at once. In larger
ones the values at the wanted ranks are selected by radix: numbers have 64-bit codes of the same order, counts of the upper sixteen bits tell in
which range a rank lies, and only that range is counted by the next sixteen bits. Nothing is sorted but these counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twosided.operators.ordered import MAX_GROUP_ROWS
from twosided.session import materialise, materialise_counted

# Distinct values that one aggregate may hold in memory.
MAX_VALUES = 500_000


def value_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, int]:
    """``keys``, ``measure``, ``value`` (double, never null) and ``n`` as a written table, and its number of rows."""
    doubles = df.select(*keys, *[F.col(name).cast("double").alias(name) for name in columns])
    return count_values(doubles.unpivot(list(keys), list(columns), "measure", "value"), keys)


def count_values(long: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """:func:`value_counts` of rows that already are ``keys``, ``measure``, ``value``."""
    counted = long.filter(F.col("value").isNotNull()).groupBy(*keys, "measure", "value")
    return materialise_counted(counted.agg(F.count(F.lit(1)).alias("n")), "counts")


def quantiles_from_counts(
    counts: DataFrame,
    rows: int,
    keys: Sequence[str],
    fractions: Mapping[str, float],
    max_values: int = MAX_VALUES,
) -> DataFrame:
    """``keys``, ``measure`` and one column per named fraction, interpolated linearly between ranks.

    ``rows`` is the number of counts. No group has more values than there are counts, so groups are sized only beyond
    ``max_values``. Both ways interpolate by the same formula.
    """
    group = [*keys, "measure"]
    max_values = min(max_values, MAX_VALUES)
    if rows <= max_values:
        return _quantiles_at_once(counts, group, fractions)
    sizes = counts.groupBy(*group).agg(F.sum("n").alias("__rows"), F.count(F.lit(1)).alias("__values"))
    large = materialise(sizes.filter(F.col("__values") > max_values).drop("__values"), "large_groups")
    renamed = large.withColumnsRenamed({key: f"__{key}" for key in group})
    match = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in group])
    inside = counts.join(renamed, match).select(*group, "value", "n")
    rest = counts.join(renamed, match, "left_anti")
    return _quantiles_at_once(rest, group, fractions).unionByName(_quantiles_by_radix(inside, large, group, fractions))


def _quantiles_at_once(counts, group, fractions) -> DataFrame:
    wanted = F.array(*[F.lit(float(fraction)) for fraction in fractions.values()])
    found = counts.groupBy(*group).agg(F.percentile("value", wanted, F.col("n")).alias("__found"))
    return found.select(*group, *[F.col("__found")[i].alias(name) for i, name in enumerate(fractions)])


def ordered_code(value: Column) -> Column:
    """A 64-bit number for each double, in the same order; both zeros have one code, and NaN comes last."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1)))


def _quantiles_by_radix(counts, large, group, fractions) -> DataFrame:
    """Quantiles of the groups in ``large``, which has the number of their rows."""
    def same(names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in names])

    coded = materialise(counts.withColumn("code", ordered_code(F.col("value"))), "coded_values")
    ranks = []
    for name, fraction in fractions.items():
        rank = F.lit(float(fraction)) * (F.col("__rows") - 1)
        ranks += [F.struct(F.lit(f"{part}_{name}").alias("which"), at.cast("long").alias("at")) for part, at in (("low", F.floor(rank)), ("high", F.ceil(rank)))]
    wanted = large.select(*group, F.explode(F.array(*ranks)).alias("__r")).select(*group, "__r.which", "__r.at", F.lit(0).cast("long").alias("range"))
    for shift in (48, 32, 16, 0):
        # A row for each wanted rank and level; each range holds 65,536 counts at most.
        outer = F.shiftright("code", shift + 16) if shift < 48 else F.lit(0).cast("long")
        open_ranges = wanted.select(*[F.col(name).alias(f"__{name}") for name in [*group, "range"]]).distinct()
        met = coded.withColumn("range", outer).join(open_ranges, same([*group, "range"]))
        inner = met.groupBy(*group, "range", F.shiftright("code", shift).alias("within")).agg(F.sum("n").alias("n"), F.min("value").alias("value"))
        along = Window.partitionBy(*group, "range").orderBy("within").rowsBetween(Window.unboundedPreceding, -1)
        placed = inner.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
        asked = wanted.select(*[F.col(name).alias(f"__{name}") for name in [*group, "range"]], "which", "at")
        hit = placed.join(asked, same([*group, "range"]) & (F.col("before") <= F.col("at")) & (F.col("at") < F.col("before") + F.col("n")))
        wanted = materialise(hit.select(*group, "which", (F.col("at") - F.col("before")).alias("at"), F.col("within").alias("range"), "value"), "ranks")
    picked = wanted.groupBy(*group).agg(*[
        F.max(F.when(F.col("which") == f"{part}_{name}", F.col("value"))).alias(f"__{part}_{name}") for name in fractions for part in ("low", "high")])
    rows = large.select(*[F.col(name).alias(f"__{name}") for name in group], "__rows")
    picked = picked.join(rows, same(group))
    result = []
    for name, fraction in fractions.items():
        rank = F.lit(float(fraction)) * (F.col("__rows") - 1)
        low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
        # The formula of Spark's percentile, so that both ways give the same doubles.
        between = (F.ceil(rank) - rank) * low + (rank - F.floor(rank)) * high
        result.append(F.when(low == high, low).otherwise(between).alias(name))
    return picked.select(*group, *result)


def one_column_each(long: DataFrame, keys: Sequence[str], columns: Sequence[str], value: str) -> DataFrame:
    """One row per ``keys`` with each measure's ``value`` under the measure's name; null where there is none."""
    wide = [F.max(F.when(F.col("measure") == name, F.col(value))).alias(name) for name in columns]
    return long.groupBy(*keys).agg(*wide)


def grouped_median(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """``keys`` with the exact median of each column, nulls skipped."""
    long = grouped_quantiles(df, keys, columns, {"median": 0.5}, max_rows)
    return one_column_each(long, keys, columns, "median")


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    fractions: Mapping[str, float],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``keys``, ``measure`` and the named exact quantiles, nulls skipped."""
    return quantiles_from_counts(*value_counts(df, keys, columns), keys, fractions, max_rows)
