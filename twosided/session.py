"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of a table for which a shuffle begins with one more partition, and bytes of a split of files whose rows are cached as vectors.
ROWS_A_PARTITION, CACHED_SPLIT = 200_000, 16 << 20

_local_root: str | None = None


def build_session(app_name: str = "twosided", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for; ``conf`` adds or overrides entries."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join even where that costs an extra shuffle afterwards.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master without it."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="twosided-")
    return _local_root


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage, outlives lost executors and, unlike a checkpointed RDD, still lets
    later plans prune columns and push filters into the scan.
    """
    return materialise_counted(df, label)[0]


def materialise_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """:func:`materialise`, and the number of rows as observed while they were written."""
    spark = df.sparkSession
    path = new_path(spark, label)
    seen = Observation()
    with shuffles_removed(spark):
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]


def spread_shuffles(spark: SparkSession, rows: int) -> None:
    """Let adaptive execution begin shuffles with a partition for every ``ROWS_A_PARTITION`` of ``rows``, if that is more than is set.

    With a fixed number, partitions grow with the table until their sorts spill. Small partitions are coalesced as ever. The
    setting stays in the session, because a query's result is computed after it was built.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    begun = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if rows > begun * ROWS_A_PARTITION:
        spark.conf.set(key, str(-(-rows // ROWS_A_PARTITION)))


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


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Within, a join may leave a side where it is if that is partitioned by some of the join's keys."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _in_bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Within, files are read in splits of ``CACHED_SPLIT`` bytes at most: rows cached as vectors take ten times the room of their files."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(CACHED_SPLIT, _in_bytes(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
