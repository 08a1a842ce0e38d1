"""Splits, scaling, models, searches and scoring on the feature table."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from twosided.catalog.contest_sql import CONTESTS, participants
from twosided.catalog.feature_queries import CONTEST_FEATURES
from twosided.catalog.impute_queries import CLEANED
from twosided.catalog.parse_queries import KEY
from twosided.ml import boosting, newton, parzen, refits, search, training
from twosided.operators.features import DIFFERENCES, FEATURES, difference_features
from twosided.plans.contest_view import ROW_KEY, contest_table, feature_table
from twosided.session import new_path

LAST_TRAIN, LAST_VALID = 1999, 2000
SCALED = [name for name in FEATURES if not name.startswith("missing")]


def _variants():
    """Variant -> (rows that are learned from, features left out)."""
    has_elo, has_cards = ~F.col("missing_elo"), ~F.col("missing_cards")
    return {
        "all": (None, []),
        "rated": (has_elo, ["missing_elo"]),
        "rated, carded": (has_elo & has_cards, ["missing_elo", "missing_cards"]),
        "carded": (has_cards, ["missing_cards"]),
    }


def _splits(spark, sf_dir):
    return training.split_by_season(feature_table(spark, sf_dir), LAST_TRAIN, LAST_VALID)


def season_split(spark, sf_dir):
    parts = zip(("train", "valid", "test"), training.split_by_season(contest_table(spark, sf_dir), LAST_TRAIN, LAST_VALID))
    first, *others = [df.select(*ROW_KEY, F.lit(name).alias("part")) for name, df in parts]
    for other in others:
        first = first.unionByName(other)
    return first


def difference_frame(spark, sf_dir):
    columns = [*ROW_KEY, "capacity", *dict.fromkeys(name for pair in DIFFERENCES.values() for name in pair)]
    df = difference_features(feature_table(spark, sf_dir).select(*columns))
    return df.withColumns({name: F.round(name, 4) for name in ["elo_diff", "discipline_diff"]})


def _scaled(spark, sf_dir, scaler):
    train, valid, _ = _splits(spark, sf_dir)
    model = training.preparation(SCALED, scaler).fit(train)
    values = vector_to_array("features")
    columns = [F.round(values[i], 5).alias(f"scaled_{name}") for i, name in enumerate(SCALED)]
    return model.transform(valid).select(*ROW_KEY, *columns)


def standard_scaled(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


def minmax_scaled(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


def _ruled(spark, sf_dir):
    """Predictions by a fixed rule, to check reports of predictions."""
    home, away = F.col("home_points"), F.col("match_round") % 4
    rule = F.when(home > away, "home_win").when(home == away, "draw").otherwise("away_win")
    return contest_table(spark, sf_dir).withColumn("prediction", rule)


def rule_accuracy(spark, sf_dir):
    df = training.accuracy(_ruled(spark, sf_dir), ["season_year", "league"])
    return df.withColumn("accuracy", F.round("accuracy", 6))


def rule_confusion(spark, sf_dir):
    return training.confusion(_ruled(spark, sf_dir))


def marked_predictions(spark, sf_dir):
    return training.mark_correct(_ruled(spark, sf_dir)).select(*ROW_KEY, "result", "prediction", "correct")


def _scores(spark, rows):
    return spark.createDataFrame(rows, "model string, train_accuracy double, valid_accuracy double")


def train_score(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    rows = train.count()
    found = []
    for scaler in ("standard", "minmax"):
        done = training.train_and_score(training.logistic(rows, max_iter=20), train, valid, scaler=scaler)
        found.append((f"logistic, {scaler}", done.train_accuracy, done.valid_accuracy))
    return _scores(spark, found)


DIFFERENCE_MODEL = ["season_year", "match_round", "capacity", "missing_cards", "missing_elo", *DIFFERENCES]


def _optimum(train, features, scaler):
    """The certified regression on scaled features with the usual penalty (C = 1), and the rows that it is fitted to."""
    steps = training.preparation(features, scaler, empty=training.empty_features(train, features)).fit(train)
    ready = steps.transform(training.with_label(train)).select("label", "features")
    return newton.fit(ready), ready


def difference_model(spark, sf_dir):
    """Coefficients on the differences of both sides, scaled to their ranges, at the optimum: no limit of iterations is needed."""
    train = difference_features(_splits(spark, sf_dir)[0])
    return _optimum(train, DIFFERENCE_MODEL, "minmax")[0].table(spark, DIFFERENCE_MODEL)


def coefficients(spark, sf_dir):
    """Coefficients on all standardised features at the optimum."""
    return _optimum(_splits(spark, sf_dir)[0], FEATURES, "standard")[0].table(spark)


def coefficients_certified(spark, sf_dir):
    """Whether the penalised gradient, computed anew in expressions, is below 1e-6 for every coefficient and intercept."""
    fitted, ready = _optimum(_splits(spark, sf_dir)[0], FEATURES, "standard")
    names = [F.array(*[F.lit(x) for x in names]) for names in ([*FEATURES, "intercept"], training.CLASSES)]
    return newton.gradient(ready, fitted).select(
        F.get(names[0], "place").alias("feature"), F.get(names[1], "class").alias("class"), (F.abs("slope") < 1e-6).alias("stationary"))


def confusion(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    done = training.train_and_score(training.random_forest(10, 5), train, valid)
    return training.confusion(training.with_prediction(done.model, valid))


def forest_importances(spark, sf_dir):
    """Each feature's share of the gains of a forest, and how many nodes it splits.

    100 trees, as in the study, that grow as deep as Spark's trees can (30 levels).
    """
    train, _, _ = _splits(spark, sf_dir)
    with search.prepared(train, train.limit(0)) as (fit_on, _):
        return training.split_importances(training.tree_nodes(training.random_forest(depth=training.MAX_DEPTH).fit(fit_on)))


def boosted_importances(spark, sf_dir):
    """How often each feature splits a node of boosted trees, and the gain of its splits.

    Leaves, step and bins are the usual defaults of such trainers (31 leaves, 0.1, 255 bins). Two rounds instead of 100: every round is
    six or more passes, which are minutes on a small machine; ``boosting.boost`` takes 100 by default.
    """
    train, _, _ = _splits(spark, sf_dir)
    return boosting.importances(boosting.boost(train, rounds=2), spark).drop("fit")


def boosted_stumps(spark, sf_dir):
    """The first round of boosted trees of two leaves: each class's split, its gain, and the rows and values of both sides.

    Features are rounded to four places, for running sums of cards end in other digits wherever they are added in another order.
    """
    train, _, _ = _splits(spark, sf_dir)
    train = train.withColumns({name: F.round(F.col(name).cast("double"), 4) for name in FEATURES if name != "season_year"})
    nodes = boosting.boost(train, [boosting.Spec(leaves=2)], 1).node_table(spark)
    sides = [F.max(F.when(F.col("node") == node, F.round(F.col(c), 9) if c == "value" else F.col(c))).alias(f"{side}_{c}")
             for node, side in ((1, "left"), (2, "right")) for c in ("rows", "value")]
    return nodes.groupBy("class").agg(F.max("feature").alias("feature"), F.max("threshold").alias("threshold"), F.round(F.max("gain"), 6).alias("gain"), *sides)


def boosted_grid(spark, sf_dir):
    """All 7 x 7 pairs of leaves and depth, grown together. One round instead of 100, for the same reason as above."""
    train, valid, _ = _splits(spark, sf_dir)
    return refits.grid(train, valid, rounds=1)


def boosted_grid_candidates(spark, sf_dir):
    """The pairs of :func:`boosted_grid`, how many are best, and whether the best has the highest accuracy."""
    found = boosted_grid(spark, sf_dir)
    top = found.agg(F.max("valid_accuracy").alias("top"), F.count_if("best").alias("bests"))
    best = found.filter("best").select(F.col("valid_accuracy").alias("of_best"))
    return found.select("leaves", "depth").join(top).join(best).select("leaves", "depth", "bests", (F.col("top") == F.col("of_best")).alias("highest"))


def grid_search(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    values = {"maxDepth": [2, 4], "minInstancesPerNode": [1, 50]}
    with search.prepared(train, valid) as frames:
        return search.grid_search(training.random_forest(5), values, *frames)


def random_search(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    values = {"numTrees": range(3, 8), "maxDepth": range(2, 6), "minInstancesPerNode": range(1, 11)}
    with search.prepared(train, valid) as frames:
        return search.random_search(training.random_forest(), values, *frames, trials=4)


def sequential_search(spark, sf_dir):
    """24 trials, as in the study, each proposed from the scores of the earlier ones.

    Forests of 2 to 6 trees of depth 2 to 5 instead of 100 to 500 trees of depth 5 to 20, for the trials are made one after the other
    and are minutes each at the larger sizes on a small machine; the options are arguments of ``parzen.sequential_search``.
    """
    train, valid, _ = _splits(spark, sf_dir)
    values = {"numTrees": range(2, 7), "maxDepth": range(2, 6), "minInstancesPerNode": range(1, 11)}
    with search.prepared(train, valid) as frames:
        return parzen.sequential_search(training.random_forest(), values, *frames)


def sequential_trials(spark, sf_dir):
    """How many trials :func:`sequential_search` makes, how many differ and are best, and whether the best has the highest accuracy."""
    found = sequential_search(spark, sf_dir)
    return found.agg(F.count("*").alias("trials"), F.count_distinct("params").alias("different"), F.count_if("best").alias("bests"),
                     (F.max("valid_accuracy") == F.max(F.when(F.col("best"), F.col("valid_accuracy")))).alias("highest"))


def lofo(spark, sf_dir):
    """Accuracy lost without each feature, by boosted trees grown together. One round instead of 100: see :func:`boosted_importances`."""
    train, valid, _ = _splits(spark, sf_dir)
    return refits.without_each_feature(train, valid, rounds=1)


def early_seasons_out(spark, sf_dir):
    """Accuracy lost without the seasons up to each threshold, by boosted trees grown together, without ``home_form`` as in the study.

    All thresholds of these tables (1990 to the last season of training). One round instead of 100: see :func:`boosted_importances`.
    """
    train, valid, _ = _splits(spark, sf_dir)
    return refits.without_early_seasons(train, valid, range(1990, LAST_TRAIN), rounds=1, base=boosting.Spec(without=("home_form",)))


def early_seasons_left(spark, sf_dir):
    """The rows that the fits of :func:`early_seasons_out` are trained on, as their trees count them."""
    return early_seasons_out(spark, sf_dir).select("season_year", "rows")


def permutation_importance(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    with search.prepared(train, valid, keep=ROW_KEY) as (fit_on, check_on):
        model = training.random_forest(5, 5).fit(fit_on)
        report = search.permutation_importance(model, check_on, ROW_KEY, repeats=2)
        return spark.createDataFrame(report.collect(), report.schema)


def subset_variants(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    return search.subset_variants(training.random_forest(3, 4), train, valid, _variants())


def resample_classes(spark, sf_dir):
    train, _, _ = training.split_by_season(contest_table(spark, sf_dir), LAST_TRAIN, LAST_VALID)
    over = {"home_win": 0, "draw": 500_000, "away_win": 0}
    df = training.resample(train.select(*ROW_KEY, "result"), over, {"home_win": 100, "draw": 400_000}, ROW_KEY)
    return df.groupBy("result").agg(F.count(F.lit(1)).alias("rows"))


def resampled_model(spark, sf_dir):
    train, valid, _ = _splits(spark, sf_dir)
    smallest = min(row["count"] for row in train.groupBy("result").count().collect())
    even = training.resample(train, {}, {name: smallest for name in training.CLASSES}, ROW_KEY)
    done = training.train_and_score(training.logistic(3 * smallest, max_iter=20), even, valid, scaler="minmax")
    return _scores(spark, [("logistic on even classes", done.train_accuracy, done.valid_accuracy)])


def score_saved_model(spark, sf_dir):
    train, valid, test = _splits(spark, sf_dir)
    final = train.unionByName(valid).filter("season_year > 1995")
    features = [name for name in FEATURES if name != "home_form"]
    done = training.train_and_score(training.random_forest(5, 5), final, test, features)
    path = new_path(spark, "model")
    training.save_model(done.model, path)
    scored = training.with_prediction(training.load_model(path), test)
    return training.mark_correct(scored).select(*ROW_KEY, "league", "match_round", "result", "prediction", "correct")


def scored_slices(spark, sf_dir):
    return training.accuracy(score_saved_model(spark, sf_dir), ["season_year", "league"])


def fitted_frequencies(spark, sf_dir):
    """A hardly regularised fit on one column per league gives each league's frequencies of the classes."""
    leagues = [f"league_{i}" for i in range(5)]
    train, valid, _ = training.split_by_season(contest_table(spark, sf_dir).select(*ROW_KEY, "league", "result"), LAST_TRAIN, LAST_VALID)
    train, valid = (df.withColumns({name: (F.col("league") == i).cast("double") for i, name in enumerate(leagues)}) for df in (train, valid))
    model = training.logistic(train.count(), c=1e6, max_iter=300).setTol(1e-9)
    fitted = training.train_and_score(model, train, valid, leagues).model
    share = vector_to_array("probability")
    scored = fitted.transform(training.with_label(valid)).select("league", *[share[i].alias(n) for i, n in enumerate(training.CLASSES)])
    return scored.groupBy("league").agg(*[F.round(F.max(name), 3).alias(name) for name in training.CLASSES])


def _one_split(spark, sf_dir, name, condition):
    columns = contest_table(spark, sf_dir).select(*ROW_KEY, "result", condition.cast("double").alias(name))
    train, valid, _ = training.split_by_season(columns, LAST_TRAIN, LAST_VALID)
    tree = training.random_forest(1, 1).setBootstrap(False).setFeatureSubsetStrategy("all").setMinInfoGain(0.0)
    return training.train_and_score(tree, train, valid, [name]).model, valid


def majority_tree(spark, sf_dir):
    """A tree of depth 1 on one binary column predicts the majority of each side."""
    fitted, valid = _one_split(spark, sf_dir, "late", F.col("match_round") > 6)
    return training.with_prediction(fitted, valid).select(*ROW_KEY, "prediction")


def majority_tree_nodes(spark, sf_dir):
    """The nodes of such a tree on a column that tells the majority: their rows, the gain of the split and the class that each predicts."""
    nodes = training.tree_nodes(_one_split(spark, sf_dir, "won", F.col("home_points") == 3)[0].stages[-1], ["won"])
    names = F.array(*[F.lit(name) for name in training.CLASSES])
    return nodes.select("node", "feature", "rows", F.round("gain", 9).alias("gain"), F.get(names, F.col("prediction").cast("int")).alias("prediction"))


def grid_candidates(spark, sf_dir):
    """The 7 x 7 candidates of a grid search, how many of them are best, and whether that one has the highest accuracy."""
    train, valid, _ = _splits(spark, sf_dir)
    values = {"maxDepth": range(1, 8), "minInstancesPerNode": range(1, 14, 2)}
    with search.prepared(train, valid, ["home_form", "away_form"]) as frames:
        report = search.grid_search(training.random_forest(1), values, *frames)
        found = spark.createDataFrame(report.collect(), report.schema)
    top = found.agg(F.max("valid_accuracy").alias("top"), F.sum(F.col("best").cast("long")).alias("bests"))
    best = found.filter("best").select(F.col("valid_accuracy").alias("of_best"))
    return found.select("params").join(top).join(best).select("params", "bests", (F.col("top") == F.col("of_best")).alias("highest"))


def early_season_rows(spark, sf_dir):
    """Rows that are learned from when seasons up to each threshold are left out."""
    train, valid, _ = _splits(spark, sf_dir)
    with search.prepared(train, valid, ["home_form"], keep=["season_year"]) as frames:
        seasons = range(1990, LAST_TRAIN)
        return search.leave_early_seasons_out(training.random_forest(1, 1), *frames, seasons=seasons).select("season_year", "rows")


def variant_rows(spark, sf_dir):
    """Features and rows that each variant is learned from."""
    train, valid, _ = _splits(spark, sf_dir)
    return search.subset_variants(training.random_forest(1, 1), train, valid, _variants()).select("variant", "features", "rows")


def saved_model_agreement(spark, sf_dir):
    """Rows per slice, and on how many of them a saved and loaded model and the model itself disagree."""
    train, valid, test = _splits(spark, sf_dir)
    done = training.train_and_score(training.random_forest(5, 5), train, valid)
    path = new_path(spark, "model")
    training.save_model(done.model, path)
    own = training.with_prediction(done.model, test).select(*ROW_KEY, "league", F.col("prediction").alias("own"))
    loaded = training.with_prediction(training.load_model(path), test).select(*ROW_KEY, "prediction")
    both = own.join(loaded, ROW_KEY)
    return both.groupBy("season_year", "league").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("own") != F.col("prediction")).alias("disagree"))


QUERIES = {
    "fitted_frequencies": fitted_frequencies,
    "majority_tree": majority_tree,
    "majority_tree_nodes": majority_tree_nodes,
    "grid_candidates": grid_candidates,
    "early_season_rows": early_season_rows,
    "variant_rows": variant_rows,
    "saved_model_agreement": saved_model_agreement,
    "season_split": season_split,
    "difference_features": difference_frame,
    "standard_scaled": standard_scaled,
    "minmax_scaled": minmax_scaled,
    "rule_accuracy": rule_accuracy,
    "rule_confusion": rule_confusion,
    "marked_predictions": marked_predictions,
    "train_score": train_score,
    "difference_model": difference_model,
    "coefficients": coefficients,
    "confusion": confusion,
    "forest_importances": forest_importances,
    "boosted_importances": boosted_importances,
    "sequential_search": sequential_search,
    "sequential_trials": sequential_trials,
    "coefficients_certified": coefficients_certified,
    "boosted_stumps": boosted_stumps,
    "boosted_grid": boosted_grid,
    "boosted_grid_candidates": boosted_grid_candidates,
    "early_seasons_left": early_seasons_left,
    "grid_search": grid_search,
    "random_search": random_search,
    "lofo": lofo,
    "early_seasons_out": early_seasons_out,
    "permutation_importance": permutation_importance,
    "subset_variants": subset_variants,
    "resample_classes": resample_classes,
    "resampled_model": resampled_model,
    "score_saved_model": score_saved_model,
    "scored_slices": scored_slices,
}

FEATURED = f"""{CLEANED}, {participants("cleaned")}, featured AS ({
    CONTEST_FEATURES.replace("c.* EXCLUDE (date)", "c.*").replace("FROM contests c", "FROM cleaned c")
})"""
RULE = """CASE WHEN home_points > match_round % 4 THEN 'home_win' WHEN home_points = match_round % 4 THEN 'draw'
    ELSE 'away_win' END"""
RULED = f"WITH {CONTESTS}, ruled AS (SELECT *, {RULE} AS prediction FROM contests)"


def _scaled_sql(formula):
    train = f"FROM featured WHERE season_year <= {LAST_TRAIN}"
    means = ", ".join(f"avg({n}) AS avg_{n}" for n in SCALED)
    known = ", ".join(f"CAST(coalesce({n}, avg_{n}) AS DOUBLE) AS {n}" for n in SCALED if n != "season_year")
    bounds = ", ".join(f"{f}({n}) AS {f}_{n}" for n in SCALED for f in ("avg", "stddev_samp", "min", "max"))
    columns = ", ".join(f"round({formula.format(x=n)}, 5) AS scaled_{n}" for n in SCALED)
    return f"""{FEATURED}, means AS (SELECT {means} {train}),
        known AS (SELECT home_team, away_team, season_year, {known} FROM featured, means),
        bounds AS (SELECT {bounds} FROM known WHERE season_year <= {LAST_TRAIN})
        SELECT {KEY}, {columns} FROM known, bounds WHERE season_year = {LAST_VALID}"""


def _difference(name, home, away):
    value = f"{home} - {away}"
    return f"round({value}, 4) AS {name}" if name in ("elo_diff", "discipline_diff") else f"{value} AS {name}"


_TRAIN = f"FROM featured WHERE season_year <= {LAST_TRAIN}"


def _stumps_sql():
    """The best split of all rows for each class: gradients of the class shares, rounded and summed along every feature's values."""
    parts, unit, classes = boosting.MAX_BINS - 1, f"{boosting.UNIT!r}::DOUBLE", training.CLASSES
    values = ", ".join(f"round(CAST({n} AS DOUBLE), 4) AS {n}" for n in FEATURES)
    order = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(FEATURES))
    per_class = " UNION ALL ".join(f"SELECT *, '{c}' AS class, n_{c} AS mine, k_{c}::DOUBLE / total AS share, k_{c} AS all_mine FROM cuts, sizes" for c in classes)
    return f"""{FEATURED}, train AS (SELECT result, {values} {_TRAIN}),
        sizes AS (SELECT count(*) AS total, {", ".join(f"count(*) FILTER (result = '{c}') AS k_{c}" for c in classes)} FROM train),
        long AS (UNPIVOT train ON {", ".join(FEATURES)} INTO NAME feature VALUE x),
        counts AS (SELECT feature, x, count(*) AS n, {", ".join(f"count(*) FILTER (result = '{c}') AS n_{c}" for c in classes)} FROM long GROUP BY ALL),
        known AS (SELECT feature, sum(n) AS known, count(*) AS different, {", ".join(f"sum(n_{c}) AS known_{c}" for c in classes)} FROM counts GROUP BY feature),
        placed AS (SELECT counts.feature, x, n, known, different, total - known + sum(n) OVER w AS left_rows, sum(n) OVER w AS upto,
              {", ".join(f"k_{c} - known_{c} + sum(n_{c}) OVER w AS n_{c}" for c in classes)}
            FROM counts JOIN known USING (feature), sizes WINDOW w AS (PARTITION BY counts.feature ORDER BY x)),
        cuts AS (SELECT * FROM placed WHERE (different <= {parts} OR upto * {parts} // known > (upto - n) * {parts} // known)
            UNION ALL SELECT feature, NULL, 0, known, different, total - known, 0, {", ".join(f"k_{c} - known_{c}" for c in classes)} FROM known, sizes),
        sided AS ({per_class}),
        sums AS (SELECT *, mine * round((share - 1) / {unit}) + (left_rows - mine) * round(share / {unit}) AS gl,
              all_mine * round((share - 1) / {unit}) + (total - all_mine) * round(share / {unit}) AS g,
              left_rows * round(1.5::DOUBLE * share * (1 - share) / {unit}) AS hl, total * round(1.5::DOUBLE * share * (1 - share) / {unit}) AS h
            FROM sided),
        gains AS (SELECT *, (gl * {unit}) * (gl * {unit}) / (hl * {unit}) + ((g - gl) * {unit}) * ((g - gl) * {unit}) / ((h - hl) * {unit})
              - (g * {unit}) * (g * {unit}) / (h * {unit}) AS gain FROM sums WHERE left_rows >= 20 AND total - left_rows >= 20),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY round(gain, 9) DESC, CASE feature {order} END, x NULLS FIRST) AS place FROM gains)
        SELECT class, feature, x AS threshold, round(gain, 6) AS gain, left_rows::BIGINT AS left_rows, round(-0.1::DOUBLE * (gl / hl), 9) AS left_value,
          (total - left_rows)::BIGINT AS right_rows, round(-0.1::DOUBLE * ((g - gl) / (h - hl)), 9) AS right_value FROM ranked WHERE place = 1"""


ORACLE = {
    "fitted_frequencies": f"""WITH {CONTESTS} SELECT league, {
        ", ".join(f"round(avg(CASE WHEN result = '{name}' THEN 1.0 ELSE 0.0 END), 3) AS {name}" for name in training.CLASSES)
    } FROM contests WHERE season_year <= {LAST_TRAIN} GROUP BY league""",
    "majority_tree": f"""WITH {CONTESTS}, most AS (SELECT match_round > 6 AS late, mode(result) AS prediction FROM contests
        WHERE season_year <= {LAST_TRAIN} GROUP BY late)
        SELECT {KEY}, prediction FROM contests JOIN most ON late = (match_round > 6) WHERE season_year = {LAST_VALID}""",
    "majority_tree_nodes": f"""WITH {CONTESTS}, train AS (SELECT home_points = 3 AS won, result FROM contests WHERE season_year <= {LAST_TRAIN}),
        sides AS (SELECT 0 AS node, result FROM train UNION ALL SELECT CASE WHEN won THEN 2 ELSE 1 END, result FROM train),
        counts AS (SELECT node, result, count(*) AS n FROM sides GROUP BY ALL),
        nodes AS (SELECT node, sum(n)::BIGINT AS "rows", 1 - sum(n * n)::DOUBLE / (sum(n)::DOUBLE * sum(n)::DOUBLE) AS impurity, arg_max(result, n) AS prediction
            FROM counts GROUP BY node),
        below AS (SELECT sum("rows" * impurity) / sum("rows") AS impurity FROM nodes WHERE node > 0)
        SELECT node::INTEGER AS node, CASE WHEN node = 0 THEN 'won' END AS feature, "rows",
          CASE WHEN node = 0 THEN round(nodes.impurity - below.impurity, 9) END AS gain, prediction FROM nodes, below""",
    "grid_candidates": """SELECT 'maxDepth=' || d || ', minInstancesPerNode=' || m AS params, CAST(1 AS BIGINT) AS bests,
        true AS highest FROM range(1, 8) a(d), range(1, 14, 2) b(m)""",
    "boosted_stumps": _stumps_sql(),
    "sequential_trials": "SELECT 24::BIGINT AS trials, 24::BIGINT AS different, 1::BIGINT AS bests, true AS highest",
    "coefficients_certified": f"""SELECT f AS feature, c AS class, true AS stationary
        FROM (VALUES {", ".join(f"('{n}')" for n in [*FEATURES, "intercept"])}) a(f), (VALUES {", ".join(f"('{c}')" for c in training.CLASSES)}) b(c)""",
    "boosted_grid_candidates": """SELECT n::INTEGER AS leaves, d::INTEGER AS depth, CAST(1 AS BIGINT) AS bests, true AS highest
        FROM (VALUES (10), (12), (14), (15), (16), (18), (20)) a(n), range(1, 8) b(d)""",
    "early_seasons_left": f"""{FEATURED} SELECT CAST(s AS INTEGER) AS season_year, count(*) AS "rows"
        FROM range(1990, {LAST_TRAIN}) t(s) JOIN featured ON season_year > s AND season_year <= {LAST_TRAIN} GROUP BY s""",
    "early_season_rows": f"""{FEATURED} SELECT CAST(s AS INTEGER) AS season_year, count(*) AS "rows"
        FROM range(1990, {LAST_TRAIN}) t(s) JOIN featured ON season_year > s AND season_year <= {LAST_TRAIN} GROUP BY s""",
    "variant_rows": f"""{FEATURED} SELECT 'all' AS variant, {len(FEATURES)}::INTEGER AS features, count(*) AS "rows" {_TRAIN}
        UNION ALL SELECT 'rated', {len(FEATURES) - 1}, count(*) {_TRAIN} AND NOT missing_elo
        UNION ALL SELECT 'rated, carded', {len(FEATURES) - 2}, count(*) {_TRAIN} AND NOT missing_elo AND NOT missing_cards
        UNION ALL SELECT 'carded', {len(FEATURES) - 1}, count(*) {_TRAIN} AND NOT missing_cards""",
    "saved_model_agreement": f"""WITH {CONTESTS} SELECT season_year, league, count(*) AS "rows", CAST(0 AS BIGINT) AS disagree
        FROM contests WHERE season_year > {LAST_VALID} GROUP BY ALL""",
    "season_split": f"""WITH {CONTESTS} SELECT {KEY}, CASE WHEN season_year <= {LAST_TRAIN} THEN 'train'
        WHEN season_year <= {LAST_VALID} THEN 'valid' ELSE 'test' END AS part FROM contests""",
    "difference_features": f"""{FEATURED} SELECT {KEY}, capacity, {
        ", ".join(_difference(name, *pair) for name, pair in DIFFERENCES.items())
    } FROM featured""",
    "standard_scaled": _scaled_sql("({x} - avg_{x}) / stddev_samp_{x}"),
    "minmax_scaled": _scaled_sql("CAST({x} - min_{x} AS DOUBLE) / (max_{x} - min_{x})"),
    "rule_accuracy": f"""{RULED} SELECT season_year, league, count(*) AS "rows",
        round(avg(CASE WHEN result = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ruled GROUP BY ALL""",
    "rule_confusion": f"""{RULED} SELECT result, {
        ", ".join(f"count(*) FILTER (prediction = '{name}') AS {name}" for name in training.REPORT_ORDER)
    } FROM ruled GROUP BY result""",
    "marked_predictions": f"{RULED} SELECT {KEY}, result, prediction, result = prediction AS correct FROM ruled",
    "resample_classes": f"""WITH {CONTESTS} SELECT result, CASE result
          WHEN 'home_win' THEN least(count(*), 100) WHEN 'draw' THEN 400000 ELSE count(*) END AS "rows"
        FROM contests WHERE season_year <= {LAST_TRAIN} GROUP BY result""",
}
