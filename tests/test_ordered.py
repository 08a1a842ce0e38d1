"""Ordered scans, with and without splitting large groups, against plain pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from twosided.operators import ordered
from twosided.operators.ordered import (
    FillBackward,
    FillForward,
    LookBackSum,
    SumBefore,
    oversized_groups,
    with_ordered,
)

SCANS = {
    "last3": LookBackSum("x", 3),
    "last7": LookBackSum("x", 7),
    "total": SumBefore("x"),
    "ahead": FillForward("x"),
    "behind": FillBackward("x"),
}


def frame(seed, rows=600):
    rng = np.random.default_rng(seed)
    keys = rng.choice(["hot", "warm", "a", "b", "c"], size=rows, p=[0.5, 0.3, 0.1, 0.08, 0.02])
    values = pd.Series(rng.integers(0, 9, rows)).astype("float64")
    values[rng.random(rows) < 0.4] = np.nan
    return pd.DataFrame({"k": keys, "t": rng.integers(0, 20, rows), "id": rng.permutation(rows), "x": values})


def expected(pdf):
    pdf = pdf.sort_values(["k", "t", "id"])
    x = pdf.groupby("k").x
    zeros = pdf.assign(x=pdf.x.fillna(0)).groupby("k").x
    return pdf.assign(
        last3=x.transform(lambda s: s.rolling(3, min_periods=1).sum().shift(1).fillna(0)),
        last7=x.transform(lambda s: s.rolling(7, min_periods=1).sum().shift(1).fillna(0)),
        total=zeros.transform(lambda s: s.cumsum().shift(1).fillna(0)),
        ahead=x.ffill(),
        behind=x.bfill(),
    ).sort_values("id")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("max_rows", [7, 60, 10**6])
def test_scans_match_pandas(spark, seed, max_rows):
    pdf = frame(seed)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, t int, id int, x double")
    got = with_ordered(df, ["k"], ["t", "id"], SCANS, max_rows=max_rows).toPandas().sort_values("id")
    want = expected(pdf)
    assert len(got) == len(want)
    for name in ["k", "x", *SCANS]:
        left, right = got[name].to_numpy(), want[name].to_numpy()
        assert pd.Series(left).equals(pd.Series(right)) or np.allclose(left, right, equal_nan=True), name


def test_a_large_group_without_a_key_is_split_too(spark):
    df = spark.range(200).select(F.lit(None).cast("string").alias("k"), "id")
    got = with_ordered(df, ["k"], ["id"], {"n": SumBefore("id")}, max_rows=20)
    assert got.filter("n = id * (id - 1) / 2").count() == 200


def test_oversized_groups(spark):
    df = spark.range(100).select((F.col("id") < 70).alias("k"))
    assert oversized_groups(df, ["k"], 70) is None
    assert [tuple(r) for r in oversized_groups(df, ["k"], 69).collect()] == [(True, 70)]


def test_input_column_may_be_overwritten(spark):
    df = spark.createDataFrame([("a", i, None if i % 2 else float(i)) for i in range(50)], "k string, i int, x double")
    for max_rows in (10, 100):
        got = with_ordered(df, ["k"], ["i"], {"x": FillForward("x")}, max_rows).orderBy("i").toPandas()
        assert got.x.tolist() == [float(i - i % 2) for i in range(50)]


def test_no_group_is_one_partition_when_split(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    got = with_ordered(df, ["k"], ["id"], {"n": SumBefore("id")}, max_rows=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "__before" not in line]
    assert any("__slice" in line for line in windows)


def test_values_never_look_ahead(spark):
    pdf = frame(9, 200)
    changed = pdf.copy()
    at = changed.sort_values(["k", "t", "id"]).query("k == 'hot'").iloc[40]
    changed.loc[changed.id == at.id, "x"] = 1000.0

    def run(source):
        df = spark.createDataFrame(source.astype(object).where(source.notna(), None), "k string, t int, id int, x double")
        scans = {"last5": LookBackSum("x", 5), "total": SumBefore("x")}
        return with_ordered(df, ["k"], ["t", "id"], scans).toPandas().sort_values(["k", "t", "id"])

    before, after = run(pdf), run(changed)
    upto = (before.k != "hot") | (before[["t", "id"]].apply(tuple, axis=1) <= (at.t, at.id))
    assert before[upto][["last5", "total"]].equals(after[upto][["last5", "total"]])
    assert not before[~upto][["last5", "total"]].equals(after[~upto][["last5", "total"]])


def test_slices_are_bounded_but_never_too_large():
    most = ordered.MAX_SLICES
    assert ordered.number_of_slices(600_000, 4_000) == 150
    assert ordered.number_of_slices(216_000_000, 4_000) == most
    assert ordered.number_of_slices(12_000_000, ordered.MAX_GROUP_ROWS) == 3
    assert ordered.number_of_slices(3 * most * ordered.MAX_GROUP_ROWS, 4_000) == 3 * most
