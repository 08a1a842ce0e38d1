"""The certified fit against Spark's own regression and against gradients by plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from twosided.ml import newton, training


def frame(spark, n, seed, spread=1.0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b = rng.gauss(0, spread), rng.choice([0.0, 1.0, 5.0])
        label = max(range(3), key=lambda k: (0.8 * a, 0.3 * b, 0.4)[k] + rng.gauss(0, 1))
        rows.append((label, a, b))
    df = spark.createDataFrame(rows, "label int, a double, b double").repartition(5)
    return rows, VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@pytest.mark.parametrize("c", [1.0, 0.01, 100.0])
def test_the_gradient_is_zero_by_plain_loops(spark, c):
    rows, df = frame(spark, 400, 1, 3.0)
    found = newton.fit(df, 3, c)
    slope = np.zeros((3, 3))
    for label, *x in rows:
        margins = [sum(w * v for w, v in zip(found.coefficients[k], x)) + found.intercepts[k] for k in range(3)]
        total = sum(math.exp(m) for m in margins)
        for k in range(3):
            slope[k] += (math.exp(margins[k]) / total - (label == k)) * np.array([*x, 1.0])
    slope[:, :2] += found.coefficients / c
    assert np.abs(slope).max() < 1e-6 and found.gradient < 1e-6 and found.steps < 20
    natively = {(r["place"], r["class"]): r["slope"] for r in newton.gradient(df, found, c).collect()}
    assert len(natively) == 9
    for (i, k), value in natively.items():
        assert value == pytest.approx(slope[k, i], abs=1e-6)


def test_coefficients_are_those_of_spark(spark):
    rows, df = frame(spark, 600, 2)
    found = newton.fit(df, 3)
    theirs = training.logistic(len(rows), max_iter=500).setTol(1e-12).fit(df.withColumn("label", df["label"].cast("double")))
    assert found.coefficients == pytest.approx(theirs.coefficientMatrix.toArray(), abs=1e-4)


def test_no_rows_and_one_class(spark):
    _, df = frame(spark, 30, 3)
    assert newton.fit(df.limit(0), 3).coefficients.shape == (3, 0)
    alone = newton.fit(df.filter("label = 0"), 3, tolerance=1e-4)
    assert alone.intercepts[0] > alone.intercepts[1] + 3
