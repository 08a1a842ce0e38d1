"""Contiguous shards of nearly equal bytes, by prefix sums over the whole table, in DataFrame expressions.

Rows have one global order: the MD5 of the text, then a salt and the id. Equal texts thus lie side by side. The rows of one text and one
salt make a cell; a text that very many rows share becomes as many cells as there are salts. Cells are dealt
into fixed ranges of the order, summed within each, and the totals of the ranges give every range, cell and row its place in
the prefix sums. The axis of bytes is cut at equal targets: a row belongs to the shard that holds its middle.

Rows of equal text stay in one shard while together they are small beside a shard; larger groups are cut row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from twosided.llm.common import col, fresh, text_of
from twosided.session import materialise

#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Hexadecimal digits of a text's MD5 that name its range of the order, and of an id's MD5 that are its salt.
RANGE_DIGITS, SALT_DIGITS = 3, 2
#: Rows of equal text stay together if they have at most one of so many parts of a shard's bytes.
WHOLE_PARTS = 8


def _wide(value: Column) -> Column:
    """A number with room for products of bytes and shards."""
    return value.cast("decimal(38,0)")


def _cells(rows: DataFrame, group: str, salt: str, size: str, shards: int) -> DataFrame:
    """A row for each text and salt: its first row's number ``r`` and byte ``b`` in the order, and its text's bytes."""
    cells = rows.groupBy(F.col(group).alias("g"), F.col(salt).alias("s")).agg(F.count("*").alias("n"), F.max(size).alias("z"))
    cells = materialise(cells.withColumn("range", F.substring("g", 1, RANGE_DIGITS)), "cells")
    # At most 16 ** RANGE_DIGITS rows, whatever the table: one task can order them.
    totals = cells.groupBy("range").agg(F.sum("n").alias("rn"), F.sum(F.col("n") * F.col("z")).alias("rb"))
    order = Window.orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.select("range", F.coalesce(F.sum("rn").over(before), F.lit(0)).alias("r0"),
                           F.coalesce(F.sum("rb").over(before), F.lit(0)).alias("b0"),
                           F.sum("rb").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"))
    inside = Window.partitionBy("range").orderBy("g", "s").rowsBetween(Window.unboundedPreceding, -1)
    text = Window.partitionBy("range", "g")
    placed = cells.withColumns({
        "r": F.coalesce(F.sum("n").over(inside), F.lit(0)),
        "b": F.coalesce(F.sum(F.col("n") * F.col("z")).over(inside), F.lit(0)),
    }).withColumns({"gb": F.sum(F.col("n") * F.col("z")).over(text), "g0": F.min("b").over(text)})
    placed = placed.join(F.broadcast(materialise(ranges, "ranges")), "range")
    whole = _wide(F.col("gb")) * (WHOLE_PARTS * shards) <= _wide(F.col("all"))
    return placed.select("g", "s", "n", "z", "all", (F.col("r") + F.col("r0")).alias("r"), (F.col("b") + F.col("b0")).alias("b"),
                         F.when(whole, 2 * (F.col("g0") + F.col("b0")) + F.col("gb")).alias("middle"))


def _shard(middle: Column, shards: int) -> Column:
    """The shard that holds a place, given as twice its bytes from the start of the order."""
    return F.call_function("div", _wide(middle) * shards, _wide(2 * F.col("all"))).cast("int")


def _firsts(cells: DataFrame, shards: int) -> DataFrame:
    """``(shard, first)``: the number in the order of each shard's first row.

    Rows of a cell are equally large, so the first of them whose middle lies in a shard follows by division.
    """
    own = 2 * F.col("b") + F.col("z")
    low, high = _shard(own, shards), _shard(own + 2 * (F.col("n") - 1) * F.col("z"), shards)
    met = cells.withColumn("shard", F.explode(F.when(F.col("middle").isNotNull(), F.array(_shard(F.col("middle"), shards)))
                                              .otherwise(F.sequence(low, high))))
    step = _wide(2 * F.col("z")) * shards
    lacking = _wide(2 * F.col("all")) * F.col("shard") - _wide(own) * shards
    at = F.call_function("div", F.greatest(lacking, F.lit(0)) + step - 1, step)
    return met.groupBy("shard").agg(F.min(F.col("r") + F.when(F.col("middle").isNotNull(), 0).otherwise(at)).alias("first"))


def assign(df: DataFrame, id_col: str, text_col: str, shards: int, keep_text: bool = True) -> DataFrame:
    """``df`` with ``size``, ``text_crc32``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    ``size`` is the text's bytes in UTF-8 and ``ROW_BYTES``; a null text has none and counts as the empty text. Columns of
    ``df`` that have one of these names are replaced, the others stay, the text only with ``keep_text``. No row is lost: repeated rows
    each have a slot, and rows of one id and text are told apart by their other columns. A null id counts as an empty one. A
    shard's bytes differ from the target by at most the larger of one row and a part of ``WHOLE_PARTS`` of it; a row larger than that
    may leave shards beside it empty. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    kept = [f.name for f in df.schema if f.name.lower() not in ("size", "text_crc32", "shard", "slot") and (keep_text or f.name != text_col)]
    others = [col(f.name) for f in df.schema if f.name in kept and f.name != text_col and not isinstance(f.dataType, MapType | VariantType)]
    group, salt, size, crc, tie = fresh(df.select(*(col(c) for c in {*kept, id_col, text_col})), "g", "s", "z", "crc", "tie")
    key = F.coalesce(col(id_col).cast("string"), F.lit(""))
    text = text_of(text_col).cast("binary")
    rows = df.select(
        *(col(c) for c in kept), F.md5(text).alias(group), F.substring(F.md5(key.cast("binary")), 1, SALT_DIGITS).alias(salt),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias(size), F.crc32(text).alias(crc), (F.xxhash64(*others) if others else F.lit(0)).alias(tie))
    cells = materialise(_cells(rows, group, salt, size, shards), "placed_cells")
    firsts = materialise(_firsts(cells, shards), "shard_firsts")
    names = ["g", "s", "n", "z", "all", "r", "b", "middle"]
    found = dict(zip(names, fresh(rows, *(f"cell_{n}" for n in names)), strict=True))
    placed = rows.join(cells.select(*(F.col(n).alias(found[n]) for n in names)), (F.col(group) == F.col(found["g"])) & (F.col(salt) == F.col(found["s"])))
    within = Window.partitionBy(group, salt).orderBy(col(id_col) if id_col in kept else F.lit(0), tie)
    (number,) = fresh(placed, "number")
    placed = placed.withColumn(number, F.row_number().over(within).cast("long") - 1)
    middle = F.coalesce(F.col(found["middle"]), 2 * (F.col(found["b"]) + F.col(number) * F.col(size)) + F.col(size))
    shard = F.call_function("div", _wide(middle) * shards, _wide(2 * F.col(found["all"]))).cast("int")
    result = placed.select(*(col(c) for c in kept), F.col(size).alias("size"), F.col(crc).alias("text_crc32"), shard.alias("shard"),
                           (F.col(found["r"]) + F.col(number)).alias("slot"))
    # A row for each shard at most.
    mine, first = fresh(result, "of_shard", "first")
    joined = result.join(F.broadcast(firsts.toDF(mine, first)), F.col("shard") == F.col(mine))
    return joined.withColumn("slot", F.col("slot") - F.col(first)).drop(mine, first)


def write(df: DataFrame, id_col: str, text_col: str, shards: int, path: str, file_rows: int = 1_000_000) -> None:
    """Write ``df`` as Parquet, a folder ``shard=i`` for each shard, its rows in the order of their slots.

    A shard larger than a task should hold becomes several files, each a stretch of slots.
    """
    placed = assign(df, id_col, text_col, shards)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").option(
        "maxRecordsPerFile", file_rows).parquet(path)
