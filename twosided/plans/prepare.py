"""From text sources to a published table and the model's features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from twosided.ml.training import load_model, mark_correct, with_prediction
from twosided.operators.features import contest_features
from twosided.operators.impute import clean
from twosided.plans.merge import CONTEST, read_and_merge
from twosided.session import materialise
from twosided.sources.sinks import replace_table


def prepare(
    spark: SparkSession,
    results: str | Sequence[str],
    match_info: str | Sequence[str],
    team_info: str | Sequence[str],
    ratings: str | Sequence[str],
    corrections: DataFrame | None = None,
    day_first: bool = False,
    table: str | None = None,
    table_path: str | None = None,
) -> DataFrame:
    """Merge and clean the sources, publish the cleaned contests as ``table`` if named, and add the features.

    The merged and the cleaned contests are written before the next step reads them several times.
    """
    merged = read_and_merge(spark, results, match_info, team_info, ratings, corrections, day_first)
    cleaned = materialise(clean(materialise(merged, "merged"), CONTEST), "cleaned")
    if table:
        replace_table(cleaned, table, path=table_path)
    return contest_features(cleaned, CONTEST)


def score_contests(features: DataFrame, model_path: str) -> DataFrame:
    """Every contest with the saved model's ``prediction`` and whether it is ``correct``; slice by a filter."""
    return mark_correct(with_prediction(load_model(model_path), features))
