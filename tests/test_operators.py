"""Quantiles, numbering, samples, duplicates, lookups and corrections on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from twosided.functions import text
from twosided.operators import corrections, dedupe, numbering, ordered, profile
from twosided.operators.joins import left_lookup, unmatched
from twosided.operators.quantiles import grouped_median, grouped_quantiles


def values(spark, seed=0, rows=500):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], rows, p=[0.7, 0.29, 0.01]), "x": rng.normal(size=rows).round(2)})
    pdf.loc[rng.random(rows) < 0.3, "x"] = np.nan
    pdf["y"] = rng.integers(0, 4, rows)
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, x double, y int")


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_medians_and_quantiles_are_exact(spark, max_rows):
    pdf, df = values(spark)
    got = grouped_median(df, ["k"], ["x", "y"], max_rows).toPandas().set_index("k").sort_index()
    assert np.allclose(got[["x", "y"]], pdf.groupby("k")[["x", "y"]].median())
    wanted = {"low": 0.1, "high": 0.93}
    found = grouped_quantiles(df, ["k"], ["x"], wanted, max_rows).toPandas().set_index("k").sort_index()
    for name, fraction in wanted.items():
        assert np.allclose(found[name], pdf.groupby("k").x.quantile(fraction))


@pytest.mark.parametrize("slices", [None, 1, 13])
def test_row_ids_are_dense_and_ordered(spark, slices):
    df = spark.range(300).select((F.col("id") * 7919 % 300).alias("v"))
    got = numbering.with_row_ids(df, ["v"], slices=slices)
    assert got.filter("v <> row_id").isEmpty() and got.count() == 300


def test_random_places_are_a_permutation_per_group(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    got = numbering.with_random_place(df, ["k"], ["id"], 1, "place").toPandas()
    for _, part in got.groupby("k"):
        assert sorted(part.place) == list(range(len(part)))
        assert part.sort_values("id").place.tolist() != sorted(part.place)


def test_resampling_reaches_the_targets(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") < 700, "many").otherwise("few"))
    under = numbering.under_sample(df, "y", {"many": 123}, ["id"])
    assert {r.y: r["count"] for r in under.groupBy("y").count().collect()} == {"many": 123, "few": 300}
    assert under.distinct().count() == 423
    over = numbering.over_sample(df, "y", {"few": 900, "many": 10}, ["id"])
    assert {r.y: r["count"] for r in over.groupBy("y").count().collect()} == {"many": 700, "few": 900}
    assert over.select("id", "y").distinct().count() == 1000
    assert over.distinct().count() == 1600
    again = numbering.over_sample(df.repartition(7), "y", {"few": 900}, ["id"])
    assert again.exceptAll(over).isEmpty()


def test_sample_is_repeatable_and_has_no_repeats(spark):
    df = spark.range(500)
    one = {r.id for r in numbering.sample_rows(df, 20, ["id"]).collect()}
    two = {r.id for r in numbering.sample_rows(df.repartition(5), 20, ["id"]).collect()}
    assert one == two and len(one) == 20
    assert one != {r.id for r in numbering.sample_rows(df, 20, ["id"], seed=7).collect()}


def test_first_of_duplicates_is_kept_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, i int, v string")
    kept = dedupe.keep_first(df, ["k"], ["i"])
    assert sorted(r.v for r in kept.collect()) == ["y", "z"]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_duplicate_flags_and_counts(spark):
    rows = [("a", 1, "p", 1), ("a", 2, "p", None), ("a", 3, "q", 5), ("b", 4, "q", 2), ("c", 5, "p", 1), ("c", 6, "p", 2)]
    df = spark.createDataFrame(rows, "k string, i int, block string, v int")
    later = {r.i: r.duplicated for r in dedupe.flag_duplicates(df, ["k"], ["i"]).collect()}
    assert later == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True}
    shared = dedupe.flag_duplicates(df, ["k"], ["i"], keep=None)
    assert {r.i for r in shared.collect() if r.duplicated} == {1, 2, 3, 5, 6}
    counts = dedupe.duplicates_per_block(df, ["k"], ["i"], ["block"], "v", "n")
    assert {r.block: r.n for r in counts.collect()} == {"p": 1, "q": 1}


def test_lookup_keeps_rows_with_null_keys_apart(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, None)], "i int, k string")
    right = spark.createDataFrame([("a", 10), (None, 99)], "k string, v int")
    got = {r.i: r.v for r in left_lookup(left, right, "k").collect()}
    assert got == {1: 10, 2: None, 3: None, 4: None}
    assert {r.i for r in unmatched(left, right, "k").collect()} == {2, 3, 4}


def test_corrections_by_key_and_by_position(spark):
    bad = ["x", "1-0", "y", "z", "2-2", "w", "v", "u"]
    df = spark.createDataFrame(list(enumerate(bad)), "i int, score string")
    fixes = corrections.corrections_by_position(
        df, ~F.col("score").rlike(r"^\d+-\d+$"), ["i"], ["i"], {1: "0-0", 2: "3-2", 3: "0-1", 5: "0-0"}, [4]
    )
    got = corrections.apply_corrections(df, fixes, ["i"], "score").orderBy("i").collect()
    assert [tuple(r) for r in got] == [
        (0, "0-0"), (1, "1-0"), (2, "3-2"), (3, "0-1"), (4, "2-2"), (6, "0-0"), (7, "u"),
    ]


def test_absent_pairs(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "a"), (3, None)], "s int, l string")
    assert {tuple(r) for r in profile.absent_pairs(df, "s", "l").collect()} == {(1, "b"), (3, "a"), (3, "b")}


def test_histogram_matches_numpy(spark):
    pdf, df = values(spark, 3)
    got = profile.histogram(df, ["x", "y"], 10).toPandas()
    for name in ("x", "y"):
        counts, edges = np.histogram(pdf[name].dropna(), bins=10)
        part = got[got["column"] == name].set_index("bin")
        assert {b: n for b, n in zip(range(1, 11), counts) if n} == part.rows.to_dict()
        assert np.allclose(part.low, [edges[b - 1] for b in part.index])


def test_describe_matches_pandas(spark):
    pdf, df = values(spark, 4)
    got = profile.describe(df, ["x", "y"]).toPandas().set_index("measure")
    want = pdf[["x", "y"]].describe().T
    assert np.allclose(got.loc[["x", "y"], ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]], want)


def test_reports_on_columns(spark):
    _, df = values(spark, 5)
    nulls = {r["column"]: r.nulls for r in profile.null_report(df).collect()}
    assert nulls["k"] == 0 and nulls["x"] > 0
    assert profile.total_nulls(df).first().nulls == nulls["x"]
    shape = {r["column"]: (r.type, r.present, r["rows"]) for r in profile.schema_report(df).collect()}
    assert shape["y"] == ("int", 500, 500) and shape["x"] == ("double", 500 - nulls["x"], 500)
    codes = {r.k: r.code for r in profile.ordinal_codes(df, "k").select("k", "code").distinct().collect()}
    assert codes == {"a": 0, "b": 1, "c": 2}


def test_null_keys_and_classes_keep_their_rows(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "a").alias("k"), F.lit(None).cast("string").alias("none"))
    flags = dedupe.flag_duplicates(df.limit(3), ["none"], ["id"]).orderBy("id").collect()
    assert [r.duplicated for r in flags] == [False, True, True]
    assert numbering.with_random_place(df, ["k"], ["id"], 1, "place").groupBy("k").agg(F.max("place")).collect() is not None
    assert numbering.with_random_place(df, ["k"], ["id"], 1, "place").count() == 100
    assert numbering.under_sample(df, "k", {"a": 10}, ["id"]).count() == 60


@pytest.mark.parametrize("max_rows", [1, 7, 50, 10**6])
def test_sums_and_quantiles_do_not_depend_on_the_slices(spark, max_rows):
    rng = np.random.default_rng(3)
    rows = [(int(i % 3), int(i), None if i % 11 == 0 else float(x)) for i, x in enumerate(rng.normal(0, 1000, 400))]
    df = spark.createDataFrame(rows, "k int, i int, x double")
    scans = {"before": ordered.SumBefore("x"), "last5": ordered.LookBackSum("x", 5)}
    sums = [sorted(map(tuple, ordered.with_ordered(df, ["k"], ["i"], scans, n).collect())) for n in (max_rows, 10**7)]
    assert sums[0] == sums[1]
    fractions = {"a": 0.1, "b": 1 / 3, "c": 0.5, "d": 0.93}
    found = [sorted(map(tuple, grouped_quantiles(df, ["k"], ["x"], fractions, n).collect())) for n in (max_rows, 10**7)]
    assert found[0] == found[1]


def test_dates_in_several_layouts(spark):
    df = spark.createDataFrame([(x,) for x in ("2023-08-13", "13-08-2023", "13/08/2023", "2020-09-12 15:00:00", "05/04/2021", "N/A", None, "odd")], "d string")
    for day_first, fifth in ((True, "2021-04-05"), (False, "2021-05-04")):
        got = [str(r.d) for r in df.select(text.parse_date("d", day_first).alias("d")).collect()]
        assert got == ["2023-08-13", "2023-08-13", "2023-08-13", "2020-09-12", fifth, "None", "None", "None"]
    assert text.unparsed_dates(df, "d").first().unparsed == 1


@pytest.mark.parametrize("max_values", [10**7, 5])
def test_quantiles_by_radix_are_those_of_sorting(spark, max_values):
    from twosided.operators.quantiles import quantiles_from_counts, value_counts

    rng = np.random.default_rng(3)
    parts = {"a": np.concatenate([rng.normal(0, 1, 800), -(10.0 ** rng.uniform(-300, 300, 200)), [0.0, -0.0, -0.0, 5e-324, -5e-324, 1.7e308]]),
             None: np.repeat(rng.integers(-3, 3, 40).astype(float), 7), "few": np.array([2.0, -1.0])}
    df = spark.createDataFrame([(k, float(v)) for k, x in parts.items() for v in x], "k string, x double").repartition(5)
    fractions = {"q0": 0.0, "q1": 0.013, "q5": 0.5, "q9": 0.97, "q10": 1.0}
    rows = quantiles_from_counts(*value_counts(df, ["k"], ["x"]), ["k"], fractions, max_values).collect()
    assert len(rows) == 3
    for r in rows:
        wanted = np.quantile(parts[r.k], list(fractions.values()))
        assert np.allclose([r[name] for name in fractions], wanted, rtol=1e-12)


def test_quantiles_of_a_million_doubles(spark):
    from twosided.operators.quantiles import quantiles_from_counts, value_counts

    df = spark.range(1_000_000).select(F.lit(1).alias("k"), ((F.col("id") * 7919) % 1_000_003 / 7.0 - 50_000).alias("x"))
    found = quantiles_from_counts(*value_counts(df, ["k"], ["x"]), ["k"], {"a": 0.25, "b": 0.5}, 1000).first()
    values = np.sort((np.arange(1_000_000) * 7919) % 1_000_003 / 7.0 - 50_000)
    assert [found.a, found.b] == pytest.approx(np.quantile(values, [0.25, 0.5]).tolist(), rel=1e-12)


@pytest.mark.parametrize("bucket_values", [10_000, 3, 1])
def test_absent_pairs_by_buckets(spark, bucket_values):
    import random

    from twosided.operators.profile import absent_pairs

    rng = random.Random(bucket_values)
    rows = {(i, v) for i in range(12) for v in range(30) if rng.random() < (0.97 if i < 6 else 0.2)} | {(3, v) for v in range(30)}
    df = spark.createDataFrame([*rows, *rows, (99, None), (None, 77), (None, None)], "i int, v int")
    found = {tuple(r) for r in absent_pairs(df, "i", "v", bucket_values).collect()}
    assert found == {(i, v) for i in [*range(12), 99] for v in [*range(30), 77] if (i, v) not in rows}
    assert absent_pairs(df.filter("i is null"), "i", "v", bucket_values).count() == 0


def test_pivot_finds_its_columns(spark):
    from twosided.operators.profile import pivot_block

    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 4), (2, None, 9), (2, "c", 5)], "i int, c string, x int")
    found = pivot_block(df, "i", "c", None, F.sum("x")).orderBy("i")
    assert found.columns == ["i", "a", "b", "c"] and [tuple(r) for r in found.collect()] == [(1, 3, 2, None), (2, None, None, 9)]
    with pytest.raises(ValueError, match="more than 2 values"):
        pivot_block(df, "i", "c", None, F.sum("x"), max_columns=2)
    assert pivot_block(df.filter("c is null"), "i", "c", None, F.sum("x")).columns == ["i"]


def test_cumulative_shares_of_many_values(spark):
    from twosided.operators.profile import cumulative_share

    values = [None] * 3 + [i * i % 37 for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for max_rows in (10, 10**6):
        found = {r.v: (r.rows, round(r.cumulative, 9)) for r in cumulative_share(df, "v", max_rows=max_rows).collect()}
        assert found == {v: (values.count(v), round(100 * sum(x is None or v is not None and x <= v for x in values) / 403, 9)) for v in set(values)}
    assert cumulative_share(df.limit(0), "v").count() == 0
