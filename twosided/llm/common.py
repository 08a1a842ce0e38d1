"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space inside a text, as a character class: fixed values.
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with the empty text for null."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes the shuffle files of each write when it has ended, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once although the body names it several times or inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(name: str) -> Column:
    """The fold of a row, crc32 of its id as text modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col(name).cast("string"), F.lit("")).cast("binary")) % 5


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever its case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
