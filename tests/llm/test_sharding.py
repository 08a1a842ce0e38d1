"""Shards against a plain version, with hot groups, odd rows and files."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from twosided.llm import sharding
from twosided.session import new_path


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(rows, shards):
    """``(id, size, crc, shard, slot)`` of rows ``(id, text)``."""
    made = []
    for i, text in rows:
        text = text or ""
        made.append((md5(text), md5("" if i is None else str(i))[:2], (i is not None, i or 0), len(text.encode()) + 16, zlib.crc32(text.encode()), i))
    made.sort()
    total, groups, at = sum(r[3] for r in made), {}, 0
    for r in made:
        first, size = groups.get(r[0], (at, 0))
        groups[r[0]] = first, size + r[3]
        at += r[3]
    found, slots, at = [], {}, 0
    for g, _, _, size, crc, i in made:
        start, of_text = groups[g]
        middle = 2 * start + of_text if of_text * sharding.WHOLE_PARTS * shards <= total else 2 * at + size
        shard = middle * shards // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        found.append((i, size, crc, shard, slots[shard]))
        at += size
    return found


def told(df):
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()), key=str)


@pytest.mark.parametrize("shards", [1, 7, 40, 1000])
def test_shards_are_those_of_the_plain_version(spark, shards):
    rng = random.Random(shards)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 3, 50]))) for _ in range(300)]
    rows = [(i, rng.choice(texts) if i % 3 else "a text that a third of all rows have") for i in range(3000)] + [(9999, "x" * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = told(sharding.assign(df, "doc_id", "text", shards))
    assert found == sorted(plain(rows, shards), key=str)
    sizes = [sum(r[1] for r in found if r[3] == s) for s in range(shards)]
    target = sum(sizes) / shards
    assert max(abs(s - target) for s in sizes) <= max(40_016, target / sharding.WHOLE_PARTS) + target / sharding.WHOLE_PARTS
    if shards == 7:  # small groups are never cut
        where = {}
        for (i, text), row in zip(sorted(rows, key=str), sorted(found, key=str), strict=True):
            where.setdefault(text, set()).add(row[3])
        assert sum(len(x) > 1 for x in where.values()) <= 1


def test_odd_rows_keep_their_columns(spark, odd, none):
    df = odd.withColumns({"size": F.lit("own"), "slot": F.lit(0), "g": F.lit(1), "number": F.lit(2), "of_shard": F.lit(3), "pairs": F.create_map(F.lit(1), F.lit(2))})
    found = sharding.assign(df, "doc_id", "text", 3)
    assert found.count() == len(ODD) and set(found.columns) == {*df.columns, "text_crc32", "shard"}
    assert {(r.g, r.number, r.of_shard, r.key) for r in found.collect()} == {(1, 2, 3, "own")}
    slim = sharding.assign(odd, "doc_id", "text", 3, keep_text=False)
    assert "text" not in slim.columns
    rows = [(r.shard, r.slot) for r in slim.collect()]
    for shard in {s for s, _ in rows}:
        assert sorted(x for s, x in rows if s == shard) == list(range(sum(s == shard for s, _ in rows)))
    assert sharding.assign(none, "doc_id", "text", 3).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(odd, "doc_id", "text", 0)


def test_written_shards_hold_their_rows_in_order(spark, small):
    docs, texts = small
    path = new_path(spark, "shards")
    sharding.write(docs, "doc_id", "text", 4, path, file_rows=20)
    rows = spark.read.parquet(path)
    assert {r.doc_id: r.text for r in rows.collect()} == texts
    assert sorted((r.shard, r.slot) for r in rows.collect()) == sorted((s, n) for *_, s, n in plain(texts.items(), 4))
    files = rows.groupBy("shard", F.input_file_name().alias("f")).agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b - r.a + 1 == r.n for r in files) and len(files) > 4
