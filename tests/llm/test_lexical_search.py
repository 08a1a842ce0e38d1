"""Ranked lexical search against a plain version: ties, hot terms, odd rows, small slices and several passes."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from twosided.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, best=10):
    held = [(i, Counter(terms(text))) for i, text in docs]
    n_docs, all_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // max(all_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        found += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scores)[:best], 1)]
    return sorted(found, key=str)


def told(found):
    return sorted(map(tuple, found.select("item", "rank", "id", "score").collect()), key=str)


@pytest.mark.parametrize("slice_docs, pass_bytes", [(4096, 4_000_000), (7, 120)])
def test_ranks_are_those_of_the_plain_version(spark, monkeypatch, slice_docs, pass_bytes):
    monkeypatch.setattr(lexical_search, "SLICE_DOCS", slice_docs)
    monkeypatch.setattr(lexical_search, "PASS_BYTES", pass_bytes)
    rng, words = random.Random(5), ["the", *"abcdefghij", "Äb", "äb", "x1", "数字", "it's"]
    weights = [60, *[10 / (n + 1) for n in range(len(words) - 1)]]

    def text():
        return " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40])))

    docs = [(i, text()) for i in range(200)] + [(1000 + i, "the same text of very many") for i in range(150)] + [(None, "a b"), (None, None), (7, "a b"), (7, "a b")]
    items = [(i, text()) for i in range(12)] + [(100, "THE same text"), (100, "another text of it"), (100, "THE same text"), (None, "a the"), (200, None), (201, "nowhere")]
    # Equal ids and scores of different texts are told apart by nothing, so the plain version agrees whatever their order.
    found = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"),
                                  "doc_id", "text", "item_id", "text")
    assert told(found) == plain(docs, items)


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([("a", "a text without an id"), ("b", "of the text"), ("c", "ΣΣ σς 😀"), ("d", "x" * 20000)], "item string, text string").withColumns(
        {c: F.lit("own") for c in ("term", "id", "slice", "score", "rank")})
    wanted = plain([(r.doc_id, r.text) for r in odd.collect()], [(r.item, r.text) for r in items.collect()])
    assert told(lexical_search.search(odd, items, "doc_id", "text", "item", "text")) == wanted and wanted
    assert lexical_search.search(none, items, "doc_id", "text", "item", "text").count() == 0
    nothing = lexical_search.search(odd, items.limit(0), "doc_id", "text", "item", "text")
    assert nothing.count() == 0 and nothing.columns == ["item", "rank", "id", "score"]


def test_terms_are_dealt_evenly():
    rng = random.Random(1)
    held = {t: rng.choice([1, 1, 1, 5, 80]) for t in range(500)}
    dealt = lexical_search._owners(held, 4)
    assert sorted(t for part in dealt for t in part) == sorted(held)
    sums = [sum(held[t] for t in part) for part in dealt]
    assert max(sums) - min(sums) <= 2 * 80
    assert all(held[a] <= held[b] for x, y in zip(dealt, dealt[1:]) for a in x for b in y)


def test_dampings_beyond_64_bits():
    import numpy as np

    ns = np.array([5, 3_000_000], np.int64)
    assert lexical_search._dampings(ns, 10**12, 10**15).tolist() == [25 + 75 * int(n) * 10**12 // 10**15 for n in ns]
