"""Models on a separable fixture: better than the majority, reproducible, and saved and loaded alike."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from twosided.ml import search, training
from twosided.operators.features import difference_features
from twosided.plans.prepare import score_contests

FEATURES = ["season_year", "home_elo", "away_elo", "noise", "flag"]


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(3)
    n = 900
    home, away = rng.normal(60, 10, n), rng.normal(60, 10, n)
    gap = home - away
    pdf = pd.DataFrame({"row_id": np.arange(n), "season_year": rng.integers(2000, 2004, n), "home_elo": home,
                        "away_elo": away, "noise": rng.normal(size=n), "flag": rng.random(n) < 0.5})
    pdf["result"] = np.where(gap > 4, "home_win", np.where(gap < -4, "away_win", "draw"))
    df = spark.createDataFrame(pdf)
    df = df.withColumn("home_elo", F.when(F.col("row_id") % 40 != 0, F.col("home_elo"))).persist()
    return training.split_by_season(df, 2001, 2002)


def majority(df):
    counts = df.groupBy("result").count().toPandas()["count"]
    return counts.max() / counts.sum()


def test_split_is_by_season(frames):
    seasons = [{r.season_year for r in df.select("season_year").distinct().collect()} for df in frames]
    assert seasons == [{2000, 2001}, {2002}, {2003}]


@pytest.mark.parametrize("scaler", [None, "standard", "minmax"])
def test_logistic_regression_beats_the_majority(frames, scaler):
    train, valid, _ = frames
    done = training.train_and_score(training.logistic(train.count()), train, valid, FEATURES, scaler)
    assert done.valid_accuracy > majority(valid) + 0.2
    table = {r.feature: r for r in training.coefficients(done.model, FEATURES).collect()}
    assert table["home_elo"].home_win > 0 > table["home_elo"].away_win


def test_trees_importances_and_confusion(frames):
    train, valid, _ = frames
    for model in (training.random_forest(10, 6), training.boosted_trees(4, 3)):
        done = training.train_and_score(model, train, valid, FEATURES)
        assert done.valid_accuracy > majority(valid) + 0.15
        ranked = [r.feature for r in training.importances(done.model.stages[-1], FEATURES).collect()]
        assert set(ranked[-2:]) == {"home_elo", "away_elo"}
    scored = training.mark_correct(training.with_prediction(done.model, valid))
    table = training.confusion(scored).collect()
    assert [r.result for r in table] == training.REPORT_ORDER
    assert sum(r[name] for r in table for name in training.REPORT_ORDER) == valid.count()
    right = sum(r[r.result] for r in table)
    assert right == scored.filter("correct").count()
    assert np.isclose(right / valid.count(), training.accuracy(scored).first().accuracy)


def test_saved_model_scores_alike(frames, tmp_path):
    train, valid, test = frames
    done = training.train_and_score(training.random_forest(5, 5), train, valid, FEATURES)
    training.save_model(done.model, str(tmp_path / "model"))
    again = training.load_model(str(tmp_path / "model"))
    one = training.with_prediction(done.model, test).select("row_id", "prediction")
    two = training.with_prediction(again, test).select("row_id", "prediction")
    assert one.exceptAll(two).isEmpty()
    scored = score_contests(test, str(tmp_path / "model"))
    assert scored.filter("correct").count() > majority(test) * test.count()


def test_searches(frames):
    train, valid, _ = frames
    with search.prepared(train, valid, FEATURES, keep=["season_year", "row_id"]) as (fit_on, check_on):
        grid = search.grid_search(training.random_forest(5), {"maxDepth": [1, 6]}, fit_on, check_on).collect()
        assert [r.best for r in grid] == [False, True]
        values = {"maxDepth": range(2, 6), "numTrees": [2, 4]}
        one, two = (search.random_grid(training.random_forest(), values, 5, seed=1) for _ in range(2))
        assert [list(g.values()) for g in one] == [list(g.values()) for g in two] and len(one) == 5
        model = training.random_forest(8, 6)
        losses = {r.feature: r.loss for r in search.leave_one_feature_out(model, fit_on, check_on, FEATURES).collect()}
        assert set(losses) == set(FEATURES) and losses["home_elo"] > 0.1
        seasons = search.leave_early_seasons_out(model, fit_on, check_on, [1990, 2000]).collect()
        assert {r.season_year: r.loss for r in seasons}[1990] == 0.0
        fitted = model.fit(fit_on)
        ranked = search.permutation_importance(fitted, check_on, ["row_id"], FEATURES, repeats=2).collect()
        assert {r.feature for r in ranked[-2:]} == {"home_elo", "away_elo"}
        assert abs({r.feature: r.importance for r in ranked}["noise"]) < 0.05


def test_variants_and_resampling(frames):
    train, valid, _ = frames
    report = search.subset_variants(
        training.random_forest(4, 5), train, valid,
        {"all": (None, []), "flagged": (F.col("flag"), ["flag"])}, FEATURES,
    ).collect()
    assert [(r.variant, r.features) for r in report] == [("all", 5), ("flagged", 4)]
    even = training.resample(train, {"draw": 400}, {"home_win": 50, "draw": 300, "away_win": 50}, ["row_id"])
    assert {r.result: r["count"] for r in even.groupBy("result").count().collect()} == {
        "home_win": 50, "draw": 300, "away_win": 50,
    }


def test_differences_replace_their_columns(frames):
    got = difference_features(frames[0], {"elo_diff": ("home_elo", "away_elo")})
    assert "home_elo" not in got.columns and "elo_diff" in got.columns


def test_residual_gaps_and_missing_seasons(spark, frames):
    train, valid, _ = frames
    gaps = [df.withColumns({"capacity": F.lit(None).cast("double"), "flag": F.when(F.col("row_id") % 7 != 0, F.col("flag")),
                            "noise": F.when(F.col("row_id") % 5 != 0, F.col("noise"))}) for df in (train, valid)]
    done = training.train_and_score(training.logistic(train.count()), *gaps, [*FEATURES, "capacity"], "standard")
    assert done.valid_accuracy > majority(valid) + 0.2
    rows = spark.createDataFrame([(2000,), (2002,), (2003,), (None,)], "season_year int")
    assert [df.count() for df in training.split_by_season(rows, 2001, 2002)] == [1, 1, 2]


def test_nodes_of_a_saved_forest_give_its_importances(spark):
    import random

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rng, names = random.Random(4), ["a", "b", "c"]
    rows = [(rng.random(), rng.random(), rng.random()) for _ in range(500)]
    df = spark.createDataFrame([(float(a + 0.3 * b + 0.2 * rng.random() > 0.7), a, b, c) for a, b, c in rows], ["label", *names])
    df = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    for classifier in (training.random_forest(5, 4), DecisionTreeClassifier(maxDepth=3, seed=1)):
        fitted = classifier.fit(df)
        nodes = training.tree_nodes(fitted, names)
        found = {r.feature: (r.importance, r.splits) for r in training.split_importances(nodes, names).collect()}
        theirs = fitted.featureImportances.toArray()
        walked = dict.fromkeys(names, 0)
        held = {(r.tree, r.node): r for r in nodes.collect()}
        stack = [key for key in held if key[1] == 0]
        seen = 0
        while stack:
            r = held[stack.pop()]
            seen += 1
            if r.feature is not None:
                walked[r.feature] += 1
                stack += [(r.tree, r.left), (r.tree, r.right)]
        assert seen == len(held) and sum(walked.values()) > 3
        for i, name in enumerate(names):
            assert abs(found[name][0] - theirs[i]) < 0.03 and found[name][1] == walked[name]


def test_the_forest_of_the_importances_is_whole(spark):
    from twosided.catalog.model_queries import forest_importances

    splits = sum(r.splits for r in forest_importances(spark, "/root/testdata/sf0.001").collect())
    assert splits > 100 * 31  # what a hundred trees of depth 5 have at most


def test_depths_of_one_tree_are_read_off_the_deepest(frames, monkeypatch):
    train, valid, _ = frames
    with search.prepared(train, valid, FEATURES) as (fit_on, check_on):
        fits, plain_fit = [], training.RandomForestClassifier.fit

        def counted(self, *args):
            fits.append(self.getMaxDepth())
            return plain_fit(self, *args)

        monkeypatch.setattr(training.RandomForestClassifier, "fit", counted)
        for classifier, values, count in ((training.random_forest(1), {"maxDepth": [1, 4, 2], "minInstancesPerNode": [1, 40]}, 2),
                                          (training.random_forest(3), {"maxDepth": [1, 3]}, 2)):
            fits.clear()
            grid = search.grid_of(classifier, values)
            found = search.evaluate_params(classifier, grid, fit_on, check_on)
            assert len(fits) == count
            models = [classifier.copy(params).fit(fit_on) for params in grid]
            assert found == [(search.score(m, fit_on), search.score(m, check_on)) for m in models]


def test_large_frames_are_fitted_one_at_a_time(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [search._at_once(spark.range(0, 100, 1, n), 4) for n in (1, cores, cores + 1)] == [4, 4, 1]
