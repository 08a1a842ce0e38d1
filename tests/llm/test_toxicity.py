"""The factorization machine: scores against plain loops, forms of a stem, calibration, ties."""

import math
import random

import numpy as np
import pytest

from twosided.llm import toxicity


def test_scores_are_those_of_all_pairs():
    rng = np.random.default_rng(0)
    known = np.sort(rng.choice(1000, 60, replace=False)).astype(np.int32)
    machine = toxicity.Machine(-0.4, known, rng.normal(0, 0.3, (60, toxicity.FACTORS + 1)), 1.7, 0.2)
    for size in (0, 1, 2, 9, 40):
        places = np.sort(rng.choice(1000, size, replace=False)).astype(np.int32)
        rows = [machine.rows[i] for i, place in enumerate(known.tolist()) if place in places.tolist()]
        scale = 1 / math.sqrt(1 + len(rows) / toxicity.SHORT)
        margin = -0.4 + sum(r[0] for r in rows) * scale
        for i, a in enumerate(rows):
            for b in rows[:i]:
                margin += scale * scale * sum(x * y for x, y in zip(a[1:], b[1:]))
        assert machine.score(places) == pytest.approx(1 / (1 + math.exp(-1.7 * margin - 0.2)))


def test_a_filtered_hasher_gives_the_wanted_places():
    rng = random.Random(0)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 8))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 30, 200]))) for _ in range(50)]
    every = toxicity.Hasher()
    wanted = {p for text in texts for p in every.places(text).tolist() if p % 3 == 0}
    some = toxicity.Hasher(wanted)
    for text in texts:
        assert some.places(text).tolist() == [p for p in every.places(text).tolist() if p in wanted]


def test_forms_of_a_stem_count_up_to_a_bound():
    hasher = toxicity.Hasher()
    sizes = [len(hasher.places(" ".join(f"stem{x}" for x in "abcde"[:n]))) for n in range(6)]
    assert sizes == [0, 2, 4, 6, 7, 8]
    assert hasher.places("Stema, STEMA stema!").tolist() == hasher.places("stema").tolist()


def test_calibration_finds_the_curve_of_the_margins():
    rng = np.random.default_rng(1)
    margins = rng.normal(0, 2, 20_000)
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-2 * margins - 1))).astype(int)
    slope, offset = toxicity._calibrated(margins, labels)
    assert slope == pytest.approx(2, rel=0.1) and offset == pytest.approx(1, rel=0.15)
    flat = (rng.random(20_000) < 0.1).astype(int)
    assert toxicity._calibrated(margins, flat)[0] == 1
    assert toxicity._calibrated(np.zeros(0), np.zeros(0, int))[0] == 1


def test_a_score_of_one_half_is_predicted_as_toxic(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word")], "doc_id long, text string")
    rows = toxicity.score(docs, "text", toxicity.fit([], np.array([], int))).select("score", (F.col("score") >= 0.5).cast("int").alias("p")).collect()
    assert {(r.score, r.p) for r in rows} == {(0.5, 1)}
