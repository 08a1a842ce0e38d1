"""Look-back, running and fill columns over ordered groups.

A group is normally one window partition. A group above ``max_rows`` would make one task sort a large share of
the table, so such groups are cut into ordered slices: each slice is computed alone and then corrected by what the
earlier slices of its group carry in. Both ways give the same values: a look-back adds the same rows in the same order,
and running sums of floating-point columns are taken as decimals, whose sum does not depend on the order of addition.
"""

from __future__ import annotations

import math
from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from twosided.session import materialise

MAX_GROUP_ROWS = 5_000_000

#: Slices that large groups are cut into at most, unless one would then have more than ``MAX_GROUP_ROWS`` rows.
MAX_SLICES = 1_024

#: What floating-point columns are summed as: 12 places, values below 10^16 in amount; larger ones fail.
EXACT = "decimal(28,12)"

_SLICE = "__slice"
_BEFORE = "__rows_before"


class Scan(ABC):
    """One output column computed along an ordered group."""

    column: str

    @abstractmethod
    def over(self, group: WindowSpec, reverse: WindowSpec) -> Column:
        """The value inside one window partition; ``reverse`` is the same partition in descending order."""

    @abstractmethod
    def summary(self, position: Column) -> Column:
        """What one slice passes on; ``position`` orders its rows."""

    @abstractmethod
    def carry(self, earlier: WindowSpec, later: WindowSpec, summary: Column) -> Column:
        """What a slice receives from the other slices of its group."""

    @abstractmethod
    def combine(self, local: Column, carried: Column) -> Column:
        """The final value from the slice's own value and the carried one."""

    def within(self, group: WindowSpec, reverse: WindowSpec) -> Column:
        """The value inside one slice; by default that of a window partition."""
        return self.over(group, reverse)


@dataclass(frozen=True)
class SumBefore(Scan):
    """Sum of all earlier rows, 0 on the first."""

    column: str

    def over(self, group, reverse):
        total = F.sum(self.column).over(group.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(total, F.lit(0))

    def summary(self, position):
        return F.sum(self.column)

    def carry(self, earlier, later, summary):
        return F.coalesce(F.sum(summary).over(earlier), F.lit(0))

    def combine(self, local, carried):
        return local + carried


class _ExactSumBefore(SumBefore):
    """:class:`SumBefore` of a column of type ``EXACT``."""

    def combine(self, local, carried):
        # The sum of two decimals of 38 digits would lose the last place.
        return local.cast("decimal(37,12)") + carried.cast("decimal(37,12)")


@dataclass(frozen=True)
class LookBackSum(Scan):
    """Sum of the previous ``rows`` rows, the current one excluded; 0 when there are none."""

    column: str
    rows: int

    def over(self, group, reverse):
        return F.coalesce(F.sum(self.column).over(group.rowsBetween(-self.rows, -1)), F.lit(0))

    def summary(self, position):
        # Only a slice's last rows are kept (see _slice_summaries), so this array holds at most ``rows`` items.
        tail = F.sort_array(F.collect_list(F.struct(position.alias("at"), F.col(self.column).alias("value"))))
        return F.transform(tail, lambda item: item["value"])

    def within(self, group, reverse):
        # The first rows of a slice look back into earlier ones, so they keep their own previous rows one by one.
        own = F.transform(
            F.collect_list(F.struct(F.col(self.column).alias("value"))).over(group.rowsBetween(-self.rows, -1)), lambda item: item["value"]
        )
        first = F.row_number().over(group) <= self.rows
        return F.struct(self.over(group, reverse).alias("total"), F.when(first, own).alias("own"))

    def carry(self, earlier, later, summary):
        # Every slice holds at least one row of its group, so this many earlier slices are enough.
        return F.flatten(F.collect_list(summary).over(earlier.rowsBetween(-self.rows, -1)))

    def combine(self, local, carried):
        carried = F.coalesce(carried, F.slice(local["own"], F.lit(1), F.lit(0)))
        taken = F.least(F.lit(self.rows) - F.col(_BEFORE), F.size(carried))
        rows = F.concat(F.slice(carried, F.size(carried) - taken + 1, taken), local["own"])
        zero = local["total"] * 0
        added = F.aggregate(F.filter(rows, lambda item: item.isNotNull()), zero, lambda total, item: total + item)
        return F.when(F.col(_BEFORE) < self.rows, added).otherwise(local["total"])


@dataclass(frozen=True)
class FillForward(Scan):
    """The value itself or, when null, the last earlier one that is not."""

    column: str

    def over(self, group, reverse):
        return F.last(self.column, ignorenulls=True).over(group.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, position):
        return F.max_by(F.col(self.column), F.when(F.col(self.column).isNotNull(), position))

    def carry(self, earlier, later, summary):
        return F.last(summary, ignorenulls=True).over(earlier)

    def combine(self, local, carried):
        return F.coalesce(local, carried)


@dataclass(frozen=True)
class FillBackward(Scan):
    """The value itself or, when null, the next later one that is not."""

    column: str

    def over(self, group, reverse):
        # Walking the reversed order stays linear; a frame up to the partition's end is rescanned for every row.
        return F.last(self.column, ignorenulls=True).over(reverse.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, position):
        return F.min_by(F.col(self.column), F.when(F.col(self.column).isNotNull(), position))

    def carry(self, earlier, later, summary):
        return F.last(summary, ignorenulls=True).over(later)

    def combine(self, local, carried):
        return F.coalesce(local, carried)


def oversized_groups(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame | None:
    """Groups of more than ``max_rows`` rows with their ``rows``, or None when there is none.

    Reads the key columns only and counts before shuffling. At most ``rows / max_rows`` groups can qualify, which
    bounds what reaches the driver here and what is broadcast later.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > max_rows)
    found = counts.collect()
    if not found:
        return None
    return df.sparkSession.createDataFrame(found, counts.schema)


def _same_group(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in keys])


def with_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Scan],
    max_rows: int = MAX_GROUP_ROWS,
    counted_on: DataFrame | None = None,
    check: bool = True,
) -> DataFrame:
    """``df`` with one column per scan, computed per group of ``keys`` along ``order`` (a total order per group).

    A scan may overwrite its own input column. ``counted_on`` names a cheaper frame with the same keys on which
    to look for oversized groups; ``check=False`` skips the look where a coarser grouping is known to have none.
    """
    order = list(order)
    floating = {
        scan.column: f"exact__{scan.column}" for scan in columns.values()
        if isinstance(scan, SumBefore) and dict(df.dtypes)[scan.column] in ("double", "float")
    }
    if floating:
        exact = {
            name: _ExactSumBefore(floating[scan.column]) if isinstance(scan, SumBefore) and scan.column in floating else scan
            for name, scan in columns.items()
        }
        sums = [name for name, scan in exact.items() if scan is not columns[name]]
        cast = df.withColumns({exact_name: F.col(name).cast(EXACT) for name, exact_name in floating.items()})
        done = with_ordered(cast, keys, order, exact, max_rows, df if counted_on is None else counted_on, check)
        return done.withColumns({name: F.col(name).cast("double") for name in sums}).drop(*floating.values())
    oversized = oversized_groups(df if counted_on is None else counted_on, keys, max_rows) if check else None
    if oversized is None:
        return _one_partition_per_group(df, keys, order, columns)
    split = F.broadcast(oversized.select(*keys))
    usual = df.join(split, _same_group(df, split, keys), "left_anti")
    large = df.join(split, _same_group(df, split, keys), "left_semi")
    total = oversized.agg(F.sum("rows")).first()[0]
    sliced = _by_slices(large, keys, order, columns, number_of_slices(total, max_rows))
    usual = _one_partition_per_group(usual, keys, order, columns)
    return usual.unionByName(sliced.select(usual.columns))


def number_of_slices(rows: int, max_rows: int) -> int:
    """Slices of ``max_rows`` rows, but no more than ``MAX_SLICES`` of them where fewer rows than ``MAX_GROUP_ROWS`` lie in each.

    Every slice is a task and a part of the driver's sample of the order; without a bound, both would grow with the rows.
    """
    return max(min(math.ceil(rows / max_rows), MAX_SLICES), math.ceil(rows / max(max_rows, MAX_GROUP_ROWS)))


def _windows(keys: Sequence[str], order: Sequence[str]) -> tuple[WindowSpec, WindowSpec]:
    group = Window.partitionBy(*keys)
    return group.orderBy(*order), group.orderBy(*[F.desc(name) for name in order])


def _one_partition_per_group(df, keys, order, columns) -> DataFrame:
    group, reverse = _windows(keys, order)
    return df.withColumns({name: scan.over(group, reverse) for name, scan in columns.items()})


def _by_slices(rows, keys, order, columns, slices: int) -> DataFrame:
    # Range partitioning on the group and the order cuts one group into consecutive slices. The table is written
    # so that the slice numbers are data, the same in each branch below and after a lost executor.
    numbered = rows.repartitionByRange(max(slices, 2), *keys, *order).withColumn(_SLICE, F.spark_partition_id())
    numbered = materialise(numbered, "slices")
    slice_keys = [_SLICE, *keys]
    group, reverse = _windows(slice_keys, order)
    local = {f"__local_{name}": scan.within(group, reverse) for name, scan in columns.items()}
    local[_BEFORE] = F.row_number().over(group) - 1
    placed = numbered.withColumns(local)

    carried = _carried(numbered, keys, order, columns, slice_keys)
    # Written, so that its partitioning by group is not imposed on the slices by the join. Keys may be null.
    carried = materialise(carried, "carried")
    carried = carried.select(*[F.col(key).alias(f"__{key}") for key in slice_keys], *[f"__carry_{n}" for n in columns])
    match = reduce(lambda a, b: a & b, [placed[key].eqNullSafe(carried[f"__{key}"]) for key in slice_keys])
    joined = placed.join(carried, match, "left")
    values = {n: s.combine(F.col(f"__local_{n}"), F.col(f"__carry_{n}")) for n, s in columns.items()}
    extra = [c for c in joined.columns if c.startswith("__")]
    return joined.withColumns(values).drop(*extra)


def _carried(numbered, keys, order, columns, slice_keys) -> DataFrame:
    """One row per group and slice with what the slice receives: at most slices + groups rows."""
    position = F.struct(*order)
    summaries = numbered.select(*slice_keys).distinct()
    for name, scan in columns.items():
        source = numbered
        if isinstance(scan, LookBackSum):
            _, reverse = _windows(slice_keys, order)
            source = numbered.withColumn("__rank", F.row_number().over(reverse)).filter(F.col("__rank") <= scan.rows)
        part = source.groupBy(*slice_keys).agg(scan.summary(position).alias(f"__summary_{name}"))
        part = part.select(*[F.col(key).alias(f"__{key}") for key in slice_keys], f"__summary_{name}")
        match = reduce(lambda a, b: a & b, [summaries[key].eqNullSafe(part[f"__{key}"]) for key in slice_keys])
        summaries = summaries.join(part, match, "left").drop(*[f"__{key}" for key in slice_keys])
    along = Window.partitionBy(*keys).orderBy(_SLICE)
    back = Window.partitionBy(*keys).orderBy(F.desc(_SLICE))
    return summaries.withColumns(
        {
            f"__carry_{name}": scan.carry(
                along.rowsBetween(Window.unboundedPreceding, -1),
                back.rowsBetween(Window.unboundedPreceding, -1),
                F.col(f"__summary_{name}"),
            )
            for name, scan in columns.items()
        }
    )
