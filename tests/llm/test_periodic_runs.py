"""Periodic runs against plain loops, on random words and on the whole query."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import ODD
from twosided.llm import periodic_runs
from twosided.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """All ``(start, length, period)``: for each period the stretches where a word equals the one a period on."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if (length := i - start + q) >= max(24, 3 * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def sequence(rng, kinds, n):
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, n // 3 + 1)
        for i in range(a, rng.randint(a, n)):
            words[i] = words[a + (i - a) % p]
    return words


def test_the_cover_meets_every_difference():
    cover = periodic_runs.COVER
    assert {(b - a) % periodic_runs.MODULUS for a in cover for b in cover} == set(range(periodic_runs.MODULUS))


@pytest.mark.parametrize("kinds", [1, 2, 5, 60])
def test_extensions_of_all_pairs(kinds):
    rng = random.Random(kinds)
    words = np.array([*sequence(rng, kinds, 150), kinds])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(151), np.arange(151)))
    i, j = i[i != j], j[i != j]
    wanted = []
    for a, b in zip(i, j, strict=True):
        n = 0
        while max(a, b) + n < 151 and words[a + n] == words[b + n]:
            n += 1
        wanted.append(n)
    assert periodic_runs.Extensions(words).forward(i, j).tolist() == wanted


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_plain_loops(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(periodic_runs, "BATCH_PAIRS", rng.choice([10, 1 << 20]))
    docs = [sequence(rng, rng.choice([1, 2, 3, 20]), rng.choice([0, 1, 5, 23, 24, 30, 100, 300])) for _ in range(rng.randint(0, 8))]
    found = periodic_runs.runs_of(np.array([w for d in docs for w in d], np.int64), np.array([len(d) for d in docs], np.int64))
    assert [[tuple(r) for r in x.tolist()] for x in found] == [plain_runs(d) for d in docs]


def described(i, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(i).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (j - a) % p] for j in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {j for s, length, q in runs for j in range(s + q, s + length)}
    stays = b" ".join(w for j, w in enumerate(words) if j not in gone)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    return (len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(told).hexdigest(), hashlib.sha256(stays).hexdigest())


def test_the_query_against_plain_loops(spark, small):
    rows = QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {i: described(i, text) for i, text in small[1].items()}
    assert sum(r.n_runs for r in rows) > 10


def test_odd_rows(spark, odd, none):
    df = odd.withColumnRenamed("key", "found").withColumnRenamed("score", "runs")
    rows = periodic_runs.find_runs(df, "text", "spotted").collect()
    assert len(rows) == len(ODD) and {r.found for r in rows} == {"own"} and {r.runs for r in rows} == {"own"}
    for r in rows:
        if r.doc_id == 5:
            assert [tuple(x) for x in r.spotted.runs] == plain_runs(r.text.split())
        elif not (r.text or "").strip(" \n\t"):
            assert r.spotted.runs == [] and r.spotted.strongest is None and r.spotted.collapsed == ""
    assert periodic_runs.find_runs(none, "text").count() == 0
    repeated = spark.createDataFrame([("a b " * 50000,), ("a b " * 50000,), ("x " * 23,), ("x " * 24,)], "text string")
    rows = periodic_runs.find_runs(repeated, "text").collect()
    assert [[tuple(x) for x in r.found.runs] for r in rows] == [[(0, 100000, 2)], [(0, 100000, 2)], [], [(0, 24, 1)]]
    assert [r.found.collapsed for r in rows] == ["a b", "a b", " ".join("x" * 23), "x"]
