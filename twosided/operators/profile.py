"""Profiles of a table: counts, rates, mixes, shares, distributions, gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosided.operators.numbering import with_row_ids
from twosided.operators.ordered import MAX_GROUP_ROWS, SumBefore, with_ordered
from twosided.operators.quantiles import grouped_quantiles
from twosided.session import materialise, materialise_counted


def distinct_per_block(df: DataFrame, block: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*block).agg(F.count_distinct(column).alias(name))


def rows_per_block(df: DataFrame, block: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*block).agg(F.count(F.lit(1)).alias(name))


def rate_per_block(df: DataFrame, block: Sequence[str], rates: Mapping[str, Column]) -> DataFrame:
    """Per block the sum of each expression divided by the number of rows."""
    return df.groupBy(*block).agg(*[(F.sum(value) / F.count(F.lit(1))).alias(name) for name, value in rates.items()])


def pivot_block(df: DataFrame, index: str, column: str, values: Sequence[object] | None, cell: Column, max_columns: int = 1000) -> DataFrame:
    """One row per ``index`` and one column per value of ``column``: the listed ones, or all that there are, in order.

    Values are looked for first if none are listed; more than ``max_columns`` of them are an error, for a table has no such width.
    """
    if values is None:
        values = column_values(df, column, max_columns)
    if not values:
        return df.select(index).distinct()
    return df.groupBy(index).pivot(column, list(values)).agg(cell)


def column_values(df: DataFrame, column: str, most: int = 1000) -> list:
    """The different values of a column in ascending order; more than ``most`` are an error. Null is no value."""
    found = [r[0] for r in df.select(column).na.drop().distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values, too many for columns")
    return sorted(found)


def mix_percent(df: DataFrame, block: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Per block the share of each value of ``column`` among the listed ones, in percent."""
    counts = [F.count_if(F.col(column) == value).alias(value) for value in values]
    total = sum((F.col(value) for value in values[1:]), F.col(values[0]))
    return df.groupBy(*block).agg(*counts).select(*block, *[(F.col(v) / total * 100).alias(v) for v in values])


def absent_pairs(df: DataFrame, index: str, column: str, bucket_values: int = 10_000) -> DataFrame:
    """Pairs of an existing ``index`` and an existing ``column`` value that no row has; null is no value.

    Values are dealt into buckets of about ``bucket_values`` by their hash. An index is compared with a bucket by two counts, and
    only where it lacks some of the bucket's values it meets these as an array; the pairs that rows have are then taken
    out. No task holds all values, and the result is as large as the number of absent pairs.
    """
    present = materialise(df.select(index, column).na.drop().distinct(), "pairs")
    # An index or value that stands only beside nulls exists too.
    values, n = materialise_counted(df.select(column).na.drop().distinct(), "values")
    buckets = max(1, -(-n // bucket_values))
    place = F.pmod(F.xxhash64(column), F.lit(buckets)).alias("__bucket")
    held = values.groupBy(place).agg(F.collect_list(column).alias("__values"), F.count(F.lit(1)).alias("__n"))
    held = materialise(held, "value_buckets")
    indexes = df.select(index).na.drop().distinct()
    has = present.groupBy(F.col(index).alias("__index"), place).agg(F.count(F.lit(1)).alias("__has"))
    # Every index by the numbers of the buckets, at most one for every ``bucket_values`` values; the arrays come after the comparison.
    every = indexes.withColumn("__bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))
    known = every.join(has.withColumnRenamed("__bucket", "__of"), (F.col(index) == F.col("__index")) & (F.col("__bucket") == F.col("__of")), "left")
    lacking = known.select(index, "__bucket", F.coalesce("__has", F.lit(0)).alias("__has")).join(held.select("__bucket", "__n"), "__bucket").filter(
        F.col("__has") < F.col("__n")).select(index, "__bucket")
    met = lacking.join(held.select("__bucket", "__values"), "__bucket")
    return met.select(index, F.explode("__values").alias(column)).join(present, [index, column], "left_anti")


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column`` and ``nulls``, one row per column, from a single aggregate."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return counts.unpivot([], names, "column", "nulls")


def total_nulls(df: DataFrame) -> DataFrame:
    return null_report(df).agg(F.sum("nulls").alias("nulls"))


def schema_report(df: DataFrame) -> DataFrame:
    """``column``, ``type`` and the number of ``present`` values of each column, and the ``rows``."""
    counts = [F.count(name).alias(name) for name in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *counts)
    types = F.create_map(*[F.lit(item) for pair in df.dtypes for item in pair])
    long = row.unpivot("__rows", df.columns, "column", "present")
    return long.select("column", F.element_at(types, F.col("column")).alias("type"), "present", F.col("__rows").alias("rows"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample deviation, minimum, exact quartiles, maximum."""
    doubles = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    # One pass over the columns; the single row is then turned.
    row = doubles.agg(*[F.struct(*[f(name).alias(kind) for kind, f in kinds.items()]).alias(name) for name in columns])
    basic = row.unpivot([], list(columns), "measure", "found").select("measure", "found.*")
    quartiles = grouped_quantiles(doubles, [], columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return basic.join(quartiles, "measure", "left")


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), column)


def share_of(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """The share of rows that meet the condition."""
    return df.agg(F.avg(F.when(condition, 1.0).otherwise(0.0)).alias(name))


def cumulative_share(df: DataFrame, column: str, start: object = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Percent of all rows per value of ``column`` and cumulative along it, from ``start`` on; null comes first.

    Rows are counted per value first; values beyond ``max_rows`` are summed in slices of their order (see :mod:`ordered`).
    """
    counts = materialise(df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")), "counts")
    total = F.lit(counts.agg(F.sum("rows")).first()[0])
    group, before = f"{column}_group", f"{column}_before"
    placed = with_ordered(counts.withColumn(group, F.lit(1)), [group], [column], {before: SumBefore("rows")}, max_rows)
    shares = placed.select(column, "rows", (F.col("rows") / total * 100).alias("percent"),
                           ((F.col(before) + F.col("rows")) / total * 100).alias("cumulative"))
    return shares if start is None else shares.filter(F.col(column) >= start)


def histogram(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins per column: ``column``, ``bin`` (from 1), ``low``, ``high`` and ``rows``; empty bins absent."""
    edges = [f(name).cast("double") for name in columns for f in (F.min, F.max)]
    found = df.agg(*[edge.alias(f"e{i}") for i, edge in enumerate(edges)]).first()
    parts = []
    for i, name in enumerate(columns):
        low, high = found[2 * i], found[2 * i + 1]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        value, width = F.col(name).cast("double"), (high - low) / bins
        # The last bin is closed on the right, so the maximum belongs to it.
        near = F.least(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
        # Rounding may put a value next to an edge into the neighbouring bin; the edges decide.
        above = (value >= low + near * width) & (near < bins)
        place = F.when(value < low + (near - 1) * width, near - 1).when(above, near + 1).otherwise(near)
        place = F.when(value.isNotNull(), place)
        parts.append(F.struct(F.lit(name).alias("column"), place.cast("int").alias("bin"), F.lit(low).alias("__low"),
                              F.lit(width).alias("__width")))
    long = df.select(F.explode(F.array(*parts)).alias("h")).select("h.*").filter(F.col("bin").isNotNull())
    counted = long.groupBy("column", "bin", "__low", "__width").agg(F.count(F.lit(1)).alias("rows"))
    low = F.col("__low") + (F.col("bin") - 1) * F.col("__width")
    return counted.select("column", "bin", low.alias("low"), (low + F.col("__width")).alias("high"), "rows")


def quantiles_by_class(
    df: DataFrame, label: str, columns: Sequence[str], fractions: Mapping[str, float] | None = None
) -> DataFrame:
    """Exact quantiles of each column per class, with ``measure`` naming the column."""
    fractions = fractions or {"q00": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    return grouped_quantiles(df, [label], columns, fractions)


def ordinal_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """``df`` with the place of the value among the sorted distinct values, from 0."""
    values = df.select(column).distinct().filter(F.col(column).isNotNull())
    return df.join(materialise(with_row_ids(values, [column], name), "codes"), column, "left")


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.desc(name) for name in order]).limit(n)
