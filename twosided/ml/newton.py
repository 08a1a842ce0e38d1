"""Multinomial logistic regression by Newton steps to a certified optimum.

Each step is one pass: tasks sum the loss, its gradient and the blocks X'WX of its second derivatives over their rows, Spark adds the
sums of the tasks, and the driver solves one system of as many unknowns as the model has. The penalised loss is convex, so a
gradient near 0 proves the optimum, whatever way led there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosided.ml.training import CLASSES
from twosided.operators.features import FEATURES
from twosided.session import materialise


@dataclass(frozen=True)
class Fitted:
    """Coefficients ``[class][feature]``, intercepts, the length of the penalised gradient and the steps taken."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    gradient: float
    steps: int

    def table(self, spark, features: Sequence[str] = FEATURES, classes: Sequence[str] = CLASSES) -> DataFrame:
        """One row per feature and one coefficient column per class, sorted by the first class."""
        rows = [(name, *map(float, self.coefficients[:, i])) for i, name in enumerate(features)]
        return spark.createDataFrame(rows, "feature string, " + ", ".join(f"{name} double" for name in classes)).orderBy(classes[0], "feature")

    def margins(self, features: Column) -> Column:
        """The margins of the classes as an array, from an array column of features, in expressions."""
        return F.array(*[F.aggregate(F.zip_with(features, F.array(*[F.lit(float(w)) for w in row]), lambda x, w: x * w), F.lit(float(b)), lambda a, x: a + x)
                         for row, b in zip(self.coefficients, self.intercepts, strict=True)])


def _sums(rows: DataFrame, at: np.ndarray) -> np.ndarray:
    """The loss, the gradient and the second derivatives of the unpenalised loss at ``at``, in one array."""
    classes, width = at.shape

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(1 + classes * width + (classes * width) ** 2), False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            label = batch.column("label").to_numpy().astype(int)
            x = np.ones((batch.num_rows, width))
            x[:, :-1] = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            margin = x @ at.T
            top = margin.max(axis=1, keepdims=True)
            share = np.exp(margin - top)
            total[0] += (np.log(share.sum(axis=1)) + top[:, 0] - margin[np.arange(len(label)), label]).sum()
            share /= share.sum(axis=1, keepdims=True)
            off = share.copy()
            off[np.arange(len(label)), label] -= 1
            total[1 : 1 + classes * width] += (off.T @ x).ravel()
            curve = np.empty((classes, width, classes, width))
            for a in range(classes):
                for b in range(a + 1):
                    curve[a, :, b] = curve[b, :, a] = (x * (share[:, a] * ((a == b) - share[:, b]))[:, None]).T @ x
            total[1 + classes * width :] += curve.ravel()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    # A row for each number of the model's system, whatever the number of tasks.
    added = rows.mapInArrow(part, "sums array<double>").select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    found = np.zeros(1 + classes * width + (classes * width) ** 2)
    for i, v in added.collect():
        found[i] = v
    return found


def fit(df: DataFrame, classes: int = len(CLASSES), c: float = 1.0, tolerance: float = 1e-7, most: int = 200) -> Fitted:
    """The optimum of the summed log loss and an L2 penalty of 1 / (2 * c) on coefficients, of rows ``label`` and vector ``features``.

    Intercepts are free. A step that does not lower the loss is halved. Fitting ends when the gradient is no longer than ``tolerance``
    times the root of the number of unknowns or no step lowers the loss any more; ``most`` passes without either are an error. No rows give zeros.
    """
    rows = materialise(df.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x")), "fitted_rows")
    head = rows.select(F.size("x").alias("n")).head()
    width = (head["n"] if head else 0) + 1
    at, penalty = np.zeros((classes, width)), np.ones((classes, width)) / c
    penalty[:, -1] = 0
    best, step, scale = None, np.zeros_like(at), 1.0
    for passes in range(1, most + 1):
        trial = at + scale * step
        sums = _sums(rows, trial)
        loss = sums[0] + 0.5 * (penalty * trial**2).sum()
        if best is not None and loss > best[0] + 1e-12 * abs(best[0]) and scale > 1e-6:
            scale /= 2
            continue
        at, slope = trial, sums[1 : 1 + at.size] + (penalty * trial).ravel()
        length = float(np.linalg.norm(slope))
        if length <= tolerance * at.size**0.5 or best is not None and scale <= 1e-6:
            return Fitted(at[:, :-1], at[:, -1], length, passes)
        best = (loss,)
        # Equal shifts of all intercepts change nothing; the least step is taken.
        step = np.linalg.lstsq(sums[1 + at.size :].reshape(at.size, at.size) + np.diag(penalty.ravel()), -slope, rcond=1e-13)[0].reshape(at.shape)
        scale = 1.0
    raise RuntimeError(f"no optimum within {most} passes")


def gradient(df: DataFrame, fitted: Fitted, c: float = 1.0) -> DataFrame:
    """``(place, class, slope)``: the penalised gradient at the fitted coefficients, computed in expressions and not by the fit's own code.

    ``place`` numbers the features; the last one is the intercept.
    """
    width, classes = fitted.coefficients.shape[1] + 1, len(fitted.intercepts)
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    rows = df.select(F.col("label").cast("int").alias("label"), x.alias("x"), fitted.margins(vector_to_array("features")).alias("margin"))
    rows = rows.withColumn("top", F.array_max("margin")).withColumn("power", F.transform("margin", lambda m: F.exp(m - F.col("top"))))
    rows = rows.withColumn("all", F.aggregate("power", F.lit(0.0), lambda a, p: a + p))
    off = [F.get("power", F.lit(k)) / F.col("all") - (F.col("label") == k).cast("double") for k in range(classes)]
    sums = rows.agg(*[F.sum(F.get("x", F.lit(i)) * off[k]).alias(f"s_{i}_{k}") for i in range(width) for k in range(classes)])
    parts = [F.struct(F.lit(i).alias("place"), F.lit(k).alias("class"), (F.coalesce(F.col(f"s_{i}_{k}"), F.lit(0.0)) + F.lit(
        float(fitted.coefficients[k, i]) / c if i < width - 1 else 0.0)).alias("slope")) for i in range(width) for k in range(classes)]
    return sums.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
