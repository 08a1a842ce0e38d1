"""Train, score and report classifiers of the result on season-ordered splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer,
    MinMaxScaler,
    SQLTransformer,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twosided.operators.features import FEATURES
from twosided.operators.numbering import over_sample, under_sample
from twosided.session import new_path, small_splits

# Classes in label order (alphabetical) and in report order: fixed values.
CLASSES = ["away_win", "draw", "home_win"]
REPORT_ORDER = ["home_win", "draw", "away_win"]
#: The greatest depth that Spark's trees can have.
MAX_DEPTH = 30


def split_by_season(
    df: DataFrame, last_train: int = 2008, last_valid: int = 2014, season: str = "season_year"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test seasons in time order; train and validation together are the final train set.

    Rows without a season are in the test part: nothing is learned from them, and none is lost.
    """
    year = F.col(season)
    late = year.isNull() | (year > last_valid)
    return df.filter(year <= last_train), df.filter((year > last_train) & (year <= last_valid)), df.filter(late)


def with_label(df: DataFrame, target: str = "result", classes: Sequence[str] = CLASSES) -> DataFrame:
    """``label`` as the place of the target among ``classes``; a value outside them fails."""
    indexer = StringIndexerModel.from_labels(list(classes), inputCol=target, outputCol="label", handleInvalid="error")
    return indexer.transform(df)


def preparation(
    features: Sequence[str] = FEATURES, scaler: str | None = None, gaps: Sequence[str] | None = None, empty: Sequence[str] = ()
) -> Pipeline:
    """Feature columns to the ``features`` vector: gaps filled with training means, optionally scaled.

    ``gaps`` names the features that may have gaps, all by default.

    ``scaler`` is ``'standard'``, ``'minmax'`` or None. Ratings, which are never filled backward, and a measure that a whole
    block lacks may still be missing after cleaning; trees and regressions need a number there. ``empty`` names
    features that are missing in all training rows (see :func:`empty_features`); they are 0, for want of a mean.
    """
    stages: list = []
    known = [name for name in (features if gaps is None else gaps) if name in features and name not in empty]
    casts = [f"CAST({name} AS DOUBLE) AS {name}_number" for name in known]
    zeros = [f"coalesce(CAST({name} AS DOUBLE), 0D) AS {name}_known" for name in empty if name in features]
    stages.append(SQLTransformer(statement=f"SELECT {', '.join(['*', *casts, *zeros])} FROM __THIS__"))
    if known:
        stages.append(Imputer(inputCols=[f"{n}_number" for n in known], outputCols=[f"{n}_known" for n in known], strategy="mean"))
    inputs = [f"{name}_known" if name in known or name in empty else name for name in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features" if scaler is None else "unscaled"))
    if scaler == "standard":
        stages.append(StandardScaler(inputCol="unscaled", outputCol="features", withMean=True, withStd=True))
    elif scaler == "minmax":
        stages.append(MinMaxScaler(inputCol="unscaled", outputCol="features"))
    elif scaler is not None:
        raise ValueError(f"unknown scaler {scaler!r}")
    return Pipeline(stages=stages)


def empty_features(df: DataFrame, features: Sequence[str] = FEATURES) -> list[str]:
    """The features that no row of ``df`` has a value of; one row of counts reaches the driver."""
    counts = df.agg(*[F.count(name).alias(name) for name in features]).first()
    return [name for name in features if not counts[name]]


def logistic(rows: int, c: float = 1.0, max_iter: int = 100) -> LogisticRegression:
    """Multinomial logistic regression with an L2 penalty of ``1 / (c * rows)`` on unscaled coefficients."""
    return LogisticRegression(
        family="multinomial",
        elasticNetParam=0.0,
        regParam=1.0 / (c * rows),
        standardization=False,
        maxIter=max_iter,
        tol=1e-4,
    )


def random_forest(trees: int = 100, depth: int = 10, min_leaf: int = 1, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)


def boosted_trees(rounds: int = 20, depth: int = 5, min_leaf: int = 1, seed: int = 42, parallelism: int = 3) -> OneVsRest:
    """Boosted trees for several classes: one binary model per class."""
    binary = GBTClassifier(maxIter=rounds, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)
    return OneVsRest(classifier=binary, parallelism=parallelism)


def with_prediction(model, df: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``prediction`` as a class name."""
    scored = model.transform(df)
    names = F.array(*[F.lit(name) for name in classes])
    return scored.withColumn("prediction", names[F.col("prediction").cast("int")])


def mark_correct(df: DataFrame, target: str = "result", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("correct", F.col(target) == F.col(prediction))


def hit(target: str = "result", prediction: str = "prediction") -> Column:
    return F.avg(F.when(F.col(target) == F.col(prediction), 1.0).otherwise(0.0))


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``accuracy`` and ``rows`` of scored rows, per slice if ``by`` names columns."""
    return df.groupBy(*by).agg(hit().alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def confusion(
    df: DataFrame, target: str = "result", prediction: str = "prediction", classes: Sequence[str] = REPORT_ORDER
) -> DataFrame:
    """One row per actual class, one column per predicted class, 0 where there is none."""
    counts = df.groupBy(target).pivot(prediction, list(classes)).agg(F.count(F.lit(1))).na.fill(0)
    place = {name: i for i, name in enumerate(classes)}
    order = F.create_map(*[F.lit(item) for pair in place.items() for item in pair])
    return counts.orderBy(F.try_element_at(order, F.col(target)))


@dataclass
class Trained:
    """A fitted preparation and classifier, and how often they are right."""

    model: PipelineModel
    train_accuracy: float
    valid_accuracy: float


def train_and_score(
    classifier,
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str] = FEATURES,
    scaler: str | None = None,
) -> Trained:
    """Fit the preparation and the classifier on ``train`` and score both frames, which carry ``result``."""
    target = "result"
    with small_splits(train.sparkSession):
        steps = preparation(features, scaler, empty=empty_features(train, features)).fit(train)
        ready, check = (steps.transform(with_label(df)).select(target, "label", "features").persist() for df in (train, valid))
        try:
            fitted = classifier.fit(ready)
            scores = [accuracy(with_prediction(fitted, part)).first()["accuracy"] for part in (ready, check)]
        finally:
            ready.unpersist()
            check.unpersist()
    return Trained(PipelineModel(stages=[*steps.stages, fitted]), *scores)


def coefficients(model: PipelineModel, features: Sequence[str] = FEATURES, classes: Sequence[str] = CLASSES) -> DataFrame:
    """One row per feature and one coefficient column per class, sorted by the first class."""
    fitted = model.stages[-1]
    matrix = fitted.coefficientMatrix.toArray()
    rows = [(name, *map(float, matrix[:, i])) for i, name in enumerate(features)]
    schema = "feature string, " + ", ".join(f"{name} double" for name in classes)
    return SparkSession.active().createDataFrame(rows, schema).orderBy(classes[0])


def importances(fitted, features: Sequence[str] = FEATURES) -> DataFrame:
    """``feature`` and ``importance``, averaged over the binary models of a one-versus-rest classifier."""
    models = getattr(fitted, "models", [fitted])
    mean = sum(model.featureImportances.toArray() for model in models) / len(models)
    rows = [(name, float(value)) for name, value in zip(features, mean)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy("importance")


def tree_nodes(fitted, features: Sequence[str] = FEATURES) -> DataFrame:
    """``(tree, node, feature, rows, gain, impurity, prediction, left, right)``: every node of a fitted tree or forest.

    The nodes are those that Spark saves, read as a table, so no tree passes through the driver. A leaf has no feature, gain or
    children. ``rows`` counts repeated draws of a row as often as they were drawn.
    """
    spark = SparkSession.active()
    path = new_path(spark, "trees")
    fitted.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    saved = saved if "treeID" in saved.columns else saved.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    split = F.col("nodeData.split.featureIndex") >= 0
    names = F.array(*[F.lit(name) for name in features])
    return saved.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.when(split, F.get(names, F.col("nodeData.split.featureIndex"))).alias("feature"),
        F.col("nodeData.rawCount").alias("rows"), F.when(split, F.col("nodeData.gain")).alias("gain"),
        F.col("nodeData.impurity").alias("impurity"), F.col("nodeData.prediction").alias("prediction"),
        F.when(split, F.col("nodeData.leftChild")).alias("left"), F.when(split, F.col("nodeData.rightChild")).alias("right"))


def split_importances(nodes: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``(feature, importance, splits)`` of a table of :func:`tree_nodes`: shares of gain, and how many nodes a feature splits.

    A node's gain counts by its rows; every tree's gains are scaled to add up to 1 before trees are added.
    """
    used = nodes.filter("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"), F.count("*").alias("splits"))
    trees = used.groupBy("tree").agg(F.sum("gain").alias("all"))
    each = used.join(trees, "tree").groupBy("feature").agg(F.sum(F.try_divide("gain", "all")).alias("gain"), F.sum("splits").alias("splits"))
    names = nodes.sparkSession.createDataFrame([(i, f) for i, f in enumerate(features)], "place int, feature string")
    total = F.sum("gain").over(Window.partitionBy())  # a row for each feature
    found = names.join(each, "feature", "left")
    return found.select("feature", F.coalesce(F.try_divide("gain", total), F.lit(0.0)).alias("importance"), F.coalesce("splits", F.lit(0)).alias("splits"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def resample(
    df: DataFrame, over: Mapping[str, int], under: Mapping[str, int], key: Sequence[str], target: str = "result", seed: int = 42
) -> DataFrame:
    """Over-sample classes to ``over`` rows with replacement, then under-sample to ``under`` without."""
    grown = over_sample(df, target, over, key, seed)
    return under_sample(grown, target, under, [*key, "copy"], seed).drop("copy")
