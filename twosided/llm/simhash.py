"""Near-duplicates by SimHash, searched with a hierarchical index in Gray order.

Equal fingerprints are collapsed first. Two fingerprints that differ in at most ``d`` bits agree in one of ``d + 1``
blocks of bits, so each fingerprint is dealt out once for each block, keyed by the block's bits; a key that more than
``HOT_KEY`` fingerprints share is dealt out again by blocks of the remaining bits, which loses no link. Within a
partition the fingerprints are sorted by key and by rank in the Gray order. Consecutive ones share most bits: those
that a run of nodes has in common are factored out as a masked pattern of the node above, and each node keeps
only the bits that its parent has not got. A query walks down from the top and adds up the differences to these
patterns; a group is left as soon as they exceed the limit or its keys are others.

Links found in a partition are reduced to a spanning forest there, since only components are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twosided.llm.common import col, fresh, text_of
from twosided.llm.components import connected_components
from twosided.session import materialise

SHINGLE, MAX_BITS = 3, 2
#: Fingerprints with one key above which the key is dealt out again.
HOT_KEY = 4096
#: Nodes under one node of the index.
FAN_OUT = 16
#: Rows of one index, cut where the key changes, and queries that walk down together.
INDEX_ROWS, QUERY_ROWS = 262_144, 8_192

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text: A-Z lower-cased, ASCII blanks split words, shingles count as often as they
    occur; fewer words give one shingle, none give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    total, ones = len(words) - size + 1, np.zeros(64, np.int64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    for start in range(0, total, 65_536):
        hashes = np.fromiter(map(_hash, shingles), np.uint64, min(65_536, total - start))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return fingerprints(text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code word in the Gray order."""
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


def _build(codes: np.ndarray, keys: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels from the leaves up: pattern, own bits, smallest and largest key, last leaf of each node."""
    leaves = np.arange(len(codes))
    levels = [(codes, np.full(len(codes), ~np.uint64(0)), keys, keys, leaves)]
    while len(levels[-1][0]) > FAN_OUT:
        code, mask, low, high, last = levels[-1]
        starts = np.arange(0, len(code), FAN_OUT)
        same = np.bitwise_and.reduceat(mask, starts)
        same &= ~(np.bitwise_or.reduceat(code, starts) ^ np.bitwise_and.reduceat(code, starts))
        own = mask & ~np.repeat(same, FAN_OUT)[: len(code)]
        levels[-1] = (code, own, low, high, last)
        ends = np.minimum(starts + FAN_OUT, len(code)) - 1
        levels.append((code[starts], same, low[starts], high[ends], last[ends]))
    return levels


def search(codes: np.ndarray, keys: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places, the smaller first, whose codes differ in at most ``max_bits`` bits and whose keys are equal.

    ``codes`` must be sorted by key, and by Gray rank within a key.
    """
    levels = _build(codes, keys)
    for start in range(0, len(codes), QUERY_ROWS):
        query = np.arange(start, min(start + QUERY_ROWS, len(codes)))
        top = np.arange(len(levels[-1][0]))
        asked, node = np.repeat(query, len(top)), np.tile(top, len(query))
        bits = np.zeros(len(asked), np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            code, own, low, high, last = levels[depth]
            near = (last[node] > asked) & (low[node] <= keys[asked]) & (high[node] >= keys[asked])
            asked, node, bits = asked[near], node[near], bits[near]
            bits = bits + np.bitwise_count((codes[asked] ^ code[node]) & own[node])
            near = bits <= max_bits
            asked, node, bits = asked[near], node[near], bits[near]
            if depth:
                under = len(levels[depth - 1][0])
                asked, bits = np.repeat(asked, FAN_OUT), np.repeat(bits, FAN_OUT)
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                asked, node, bits = asked[node < under], node[node < under], bits[node < under]
        if len(asked):
            yield asked, node


def _forest(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest place linked to each place, directly or through others."""
    root = np.arange(size)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (root != root[root]).any():
                root = root[root]
    return root


def _search_batches(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    def links(keys: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(codes), keys))
        keys, codes = keys[order], codes[order]
        root = _forest(len(codes), search(codes, keys, max_bits))
        linked = root != np.arange(len(codes))
        ends = (codes[linked].view(np.int64), codes[root[linked]].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        keys, codes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        held.append((keys, codes.view(np.uint64)))
        if sum(len(x) for x, _ in held) >= INDEX_ROWS:
            keys, codes = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = np.searchsorted(keys, keys[-1])
            if cut:
                yield links(keys[:cut], codes[:cut])
            held = [(keys[cut:], codes[cut:])]
    if held:
        yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _parts(code: Column, bits: list[int], pieces: int) -> list[tuple[Column, list[int]]]:
    """The given bits of ``code`` in so many blocks: each block's value, and the bits outside it."""
    found = []
    for i in range(pieces):
        chosen = bits[len(bits) * i // pieces : len(bits) * (i + 1) // pieces]
        mask = sum(1 << b for b in chosen)
        mask -= (mask >> 63) << 64
        found.append((code.bitwiseAND(F.lit(mask).cast("long")), [b for b in bits if b not in chosen]))
    return found


def links(fingerprints: DataFrame, fp: str, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """``(a, b)``: links between different fingerprints that differ in at most ``max_bits`` bits.

    Every linked pair is joined by a path of the links returned. ``fingerprints`` holds each fingerprint once.
    """
    code, every = F.col("fp"), list(range(64))
    rows = fingerprints.select(col(fp).alias("fp"))
    first = _parts(code, every, max_bits + 1)
    dealt = rows.select("fp", F.explode(F.array(*(
        F.struct(F.lit(i).alias("block"), F.xxhash64(F.lit(i), part).alias("key")) for i, (part, _) in enumerate(first)
    ))).alias("d")).select("fp", "d.block", "d.key")
    crowded = dealt.groupBy("key").count().filter(F.col("count") > hot_key).select("key", F.lit(True).alias("crowded"))
    again = F.array()
    for i, (_, rest) in reversed(list(enumerate(first))):
        keys = F.array(*(F.xxhash64("key", F.lit(j), part) for j, (part, _) in enumerate(_parts(code, rest, max_bits + 1))))
        again = F.when(F.col("block") == i, keys).otherwise(again)
    keyed = dealt.join(crowded, "key", "left").select(
        F.explode(F.when(F.col("crowded"), again).otherwise(F.array("key"))).alias("key"), "fp"
    )
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda batches: _search_batches(batches, max_bits), schema
    )


def near_duplicates(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """``(id, text_hash, fingerprint, root, component)``: one row for each row of ``df``.

    The component is the smallest id that is reachable through fingerprints at most ``max_bits`` bits apart.
    A null text counts as empty; texts without words have fingerprint zero and are linked like others. A row
    without an id takes part but gives its component no id; a component of such rows only is null. Repeated rows are
    kept, an empty table gives no rows, and other columns are not looked at. ``root`` names the component by its smallest
    fingerprint, which tells components apart even where ids repeat; ``text_hash`` is Spark's xxhash64.
    """
    text = text_of(text_col)
    rows = materialise(df.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                                 fingerprint_column(text, shingle).alias("fingerprint")), "fingerprints")
    distinct = rows.groupBy("fingerprint").agg(F.min("id").alias("least"))
    found = connected_components(links(distinct, "fingerprint", max_bits, hot_key))
    rooted = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of = materialise(rooted.join(least, "root").select("fingerprint", "root", "component"), "components")
    return rows.join(of, "fingerprint").select("id", "text_hash", "fingerprint", "root", "component")


def keep_first(df: DataFrame, id_col: str, text_col: str, **settings) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with the smallest id.

    Of rows with that id, one with the smallest text hash stays, and of wholly equal ones any. A null id counts as
    the largest.
    """
    found = near_duplicates(df, id_col, text_col, **settings)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    kept = found.groupBy("root").agg(F.min(order).alias("first"))
    wanted_id, wanted_hash, place = fresh(df, "wanted_id", "wanted_hash", "place")
    # The list of survivors is written, so that Spark knows its size when it chooses the join.
    survivors = materialise(kept.select(F.col("first.id").alias(wanted_id), F.col("first.text_hash").alias(wanted_hash)), "survivors")
    same = Window.partitionBy(wanted_hash, wanted_id).orderBy(F.lit(0))
    return (
        df.join(survivors, (F.xxhash64(text_of(text_col)) == F.col(wanted_hash)) & col(id_col).eqNullSafe(F.col(wanted_id)))
        .withColumn(place, F.row_number().over(same)).filter(F.col(place) == 1).select(*(col(c) for c in df.columns))
    )
