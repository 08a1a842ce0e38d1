"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``MIN_MATCH`` words. The benchmark's seeds fill a bit filter of a fixed size, which thins out the
documents' seeds where they are read; what passes goes on as stretches of words, so that a document without benchmark
text costs one scan. The stretches' seeds are joined with the benchmark's, which gives the pairs of a document and an
item that share a seed. Each pair is tiled: the longest match of unmarked words is marked again and again, with match
lengths searched from long to short by rolling Karp-Rabin hashes, until no match of ``MIN_MATCH`` words is left. The
share of an item's words that are marked is its coverage, so reordered passages count in full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosided.llm.common import col, text_of
from twosided.session import materialise

#: Words of a seed, which is the shortest match, and the coverage from which a document is contaminated.
MIN_MATCH, MIN_COVERAGE = 5, 0.8
#: Bits of the filter, which is broadcast (2 MB); a benchmark with more seeds than bits only lets more stretches pass.
FILTER_BITS = 1 << 24
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII blanks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def seed_hashes(words: list[bytes], size: int = MIN_MATCH) -> np.ndarray:
    """A rolling hash of each run of ``size`` words."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = (total + codes[i : len(total) + i]) * _STEP
        total ^= total >> np.uint64(29)
    return total


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(FILTER_BITS)).astype(np.int64)


def tile(a: list[bytes], b: list[bytes], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiles ``(place in a, place in b, length)``: no word is in two tiles.

    Longest matches are marked first; of equally long ones the first in ``a``, then in ``b``. Lengths go down from a
    bound that halves while nothing matches, and a match longer than the length searched for restarts the search there.
    """
    free_a, free_b = [True] * len(a), [True] * len(b)
    tiles: list[tuple[int, int, int]] = []
    codes_a, codes_b = ([zlib.crc32(w) for w in x] for x in (a, b))

    def starts(codes: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
        """Place and Karp-Rabin hash of each run of ``size`` unmarked words."""
        top, run, value = pow(1_000_003, size, 2**61 - 1), 0, 0
        for i, code in enumerate(codes):
            if not free[i]:
                run = value = 0
                continue
            run += 1
            value = (value * 1_000_003 + code) % (2**61 - 1)
            if run > size:
                value = (value - codes[i - size] * top) % (2**61 - 1)
            if run >= size:
                yield i - size + 1, value

    size = max(min_match, min(len(a), len(b)) // 2)
    while True:
        table: dict[int, list[int]] = {}
        for place, value in starts(codes_b, free_b, size):
            table.setdefault(value, []).append(place)
        found = []
        for i, value in starts(codes_a, free_a, size) if table else ():
            for j in table.get(value, ()):
                if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                    continue  # the end of a match already found
                length = 0
                while (i + length < len(a) and j + length < len(b) and free_a[i + length] and free_b[j + length]
                       and a[i + length] == b[j + length]):
                    length += 1
                if length >= size:
                    found.append((length, i, j))
        longest = max(found, default=(0,))[0]
        if longest >= 2 * size:
            size = longest
            continue
        for length, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_a[i : i + length]) and all(free_b[j : j + length]):
                tiles.append((i, j, length))
                free_a[i : i + length] = free_b[j : j + length] = [False] * length
            elif length > size:
                found = None  # the rest of a match that was cut into may still be long enough
                break
        if found is None:
            continue
        if size == min_match:
            return tiles
        size = max(min_match, size // 2 if size > 2 * min_match else size - 1)


def _stretches(words: list[bytes], shared: np.ndarray, size: int) -> Iterator[tuple[int, bytes]]:
    """Place and words of each stretch all of whose seeds pass the filter."""
    hit = np.flatnonzero(shared)
    for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1) if len(hit) else ():
        yield int(run[0]), b" ".join(words[run[0] : run[-1] + size])


def coverage(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str,
             min_match: int = MIN_MATCH) -> DataFrame:
    """``(id, text_hash, item, coverage, tiles)``: a row for each text and item that share a seed.

    ``tiles`` holds ``(stretch, place, item_place, length)``: the place of a stretch among the text's words, and a
    tile's place in the stretch and in the item. Coverage is the share of the item's words in tiles. Rows of equal id and text give
    one result, likewise items of equal number and text. Null texts count as empty; texts and items of fewer words than a seed
    share none. Null ids are kept. Other columns are not looked at; empty tables give no rows.
    """
    spark = docs.sparkSession

    @F.pandas_udf("array<long>")
    def seeds_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: np.unique(seed_hashes(words_of(x), min_match)).view(np.int64))

    items = materialise(benchmark.select(col(item_col).alias("item"), text_of(item_text).alias("item_text")).distinct()
                        .withColumn("seeds", seeds_of("item_text")), "benchmark_seeds")
    # Places in the filter: distinct, so at most FILTER_BITS, however large the benchmark is.
    bits = items.select(F.explode("seeds").alias("seed")).select(
        F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("bit")).distinct().toArrow()
    filled = np.zeros(FILTER_BITS, bool)
    filled[bits.column("bit").to_numpy()] = True
    shared = spark.sparkContext.broadcast(np.packbits(filled, bitorder="little"))
    schema = "array<struct<place:int,words:string,seeds:array<long>>>"

    @F.pandas_udf(schema)
    def passing(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text)
                hashes = seed_hashes(words, min_match)
                at = _bits(hashes)
                rows.append([
                    {"place": place, "words": stretch.decode("utf-8", "surrogatepass"),
                     "seeds": hashes[place : place + stretch.count(b" ") + 2 - min_match].view(np.int64).tolist()}
                    for place, stretch in _stretches(words, (table[at >> 3] >> (at & 7) & 1).astype(bool), min_match)
                ])
            yield pd.Series(rows)

    stretches = materialise(
        docs.select(col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                    passing(text_of(text_col)).alias("found")).filter(F.size("found") > 0)
        .dropDuplicates(["id", "text_hash"])
        .select("id", "text_hash", "found"), "stretches")
    by_seed = stretches.select("id", "text_hash", F.explode(F.array_distinct(F.flatten("found.seeds"))).alias("seed"))
    pairs = by_seed.join(items.select("item", "item_text", F.explode("seeds").alias("seed")), "seed").select(
        "id", "text_hash", "item", "item_text").distinct()
    mine = stretches.select("id", "text_hash", F.transform("found", lambda x: F.struct(x.place, x.words)).alias("found"))
    both = pairs.join(mine, pairs["id"].eqNullSafe(mine["id"]) & (pairs["text_hash"] == mine["text_hash"])).select(
        pairs["id"], pairs["text_hash"], "item", "item_text", "found")

    @F.pandas_udf("struct<coverage:double,tiles:array<struct<stretch:int,place:int,item_place:int,length:int>>>")
    def tiled(found: pd.Series, item: pd.Series) -> pd.DataFrame:
        rows = [_tile_pair(x, words_of(y), min_match) for x, y in zip(found, item, strict=True)]
        return pd.DataFrame(rows, columns=["coverage", "tiles"])

    return both.withColumn("tiled", tiled("found", "item_text")).select(
        "id", "text_hash", "item", "tiled.coverage", "tiled.tiles")


def _tile_pair(stretches, item: list[bytes], min_match: int) -> tuple[float, list[dict]]:
    """Coverage and tiles of an item by a text's stretches; an impossible word keeps matches from crossing stretches."""
    words: list[bytes] = []
    origin: list[tuple[int, int]] = []
    for x in stretches:
        own = x["words"].encode("utf-8", "surrogatepass").split()
        words += [*own, b" "]
        origin += [(x["place"], i) for i in range(len(own) + 1)]
    tiles = tile(words, item, min_match)
    covered = sum(length for _, _, length in tiles) / len(item)
    return covered, [dict(stretch=origin[i][0], place=origin[i][1], item_place=j, length=n) for i, j, n in tiles]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH,
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The rows of :func:`coverage` with at least ``min_coverage``."""
    return coverage(docs, benchmark, id_col, text_col, item_col, item_text, min_match).filter(
        F.col("coverage") >= min_coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item; clean rows, repeated ones too, stay as they are."""
    bad = materialise(contaminated(docs, benchmark, id_col, text_col, **settings).select(
        F.col("id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "contaminated")
    return docs.join(bad, (F.xxhash64(text_of(text_col)) == bad["_bad_hash"]) & col(id_col).eqNullSafe(bad["_bad_id"]), "left_anti")
