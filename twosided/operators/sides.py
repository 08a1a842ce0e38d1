"""Between one row per contest and one row per participant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOME, AWAY = "home", "away"
SIDES = (HOME, AWAY)

#: What a home row carries of its contest; null in away rows.
OWN = "__own"


def to_participants(df: DataFrame, measures: Sequence[str], keep: Sequence[str], own: Sequence[str] = ()) -> DataFrame:
    """One row per contest and side: ``keep``, ``side``, ``side_ord`` (home 0, away 1) and the measures unprefixed.

    ``measures`` are names without their side prefix, such as ``team`` for ``home_team`` and ``away_team``. Both
    rows come from one scan, and only the named columns are read. Columns named by ``own`` go with the home row, as one struct.
    """
    carried = F.struct(*own)
    rows = [
        F.struct(
            F.lit(side).alias("side"),
            F.lit(number).alias("side_ord"),
            *[F.col(f"{side}_{name}").alias(name) for name in measures],
            *([(carried if side == HOME else F.when(F.lit(False), carried)).alias(OWN)] if own else []),
        )
        for number, side in enumerate(SIDES)
    ]
    return df.select(*keep, F.explode(F.array(*rows)).alias("__row")).select(*keep, "__row.*")


def to_contests(df: DataFrame, row_key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per ``row_key`` with each measure of the two sides under its side prefix."""
    wide = [
        F.max(F.when(F.col("side") == side, F.col(name))).alias(f"{side}_{name}")
        for side in SIDES
        for name in measures
    ]
    return df.groupBy(*row_key).agg(*wide)


def attach(df: DataFrame, wide: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``wide`` in place of its own columns of the same name.

    Both have a row per contest, so neither is a side to broadcast; ``wide`` is already partitioned by its key.
    """
    replaced = [name for name in wide.columns if name in df.columns and name not in row_key]
    return df.drop(*replaced).join(wide.hint("merge"), list(row_key), "left")


def by_team(rows: DataFrame) -> DataFrame:
    """Participant rows partitioned by team, without the name of the side on the way: its number tells it."""
    side = F.when(F.col("side_ord") == 0, HOME).otherwise(AWAY)
    return rows.drop("side").repartition("team").withColumn("side", side)


def pair(rows: DataFrame, row_key: Sequence[str], measures: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` and both sides' ``measures`` of rows of :func:`by_team` whose home rows carry the contest (:data:`OWN`).

    Gives what :func:`to_contests` and :func:`attach` give, but only away rows are shuffled, to the partition of their home
    team, where the home rows already are (within ``session.co_partitioned``); ``row_key`` has both teams. Both kinds of rows use the same columns, so that they
    read one shuffle by team. A column that is neither carried nor in the rows is the home side's measure.
    """
    carried = rows.schema[OWN].dataType.names
    known = F.lit(True)
    for key in row_key:
        known = known & F.col(key).isNotNull()
    home = rows.filter(F.col(OWN).isNotNull()).withColumn("home_team", F.col("team"))
    group = Window.partitionBy(*row_key)
    home = home.withColumns({f"{HOME}_{name}": F.when(known, F.max(name).over(group)) for name in measures})
    home = home.select(
        *row_key,
        *[
            F.col(f"{OWN}.{name}" if name in carried else name if name in rows.columns else name.removeprefix(f"{HOME}_")).alias(name)
            for name in columns if name not in row_key
        ],
        *[f"{HOME}_{name}" for name in measures],
    )
    away = rows.filter(F.col(OWN).isNull()).select(*row_key, *measures).repartition("home_team")
    away = away.groupBy(*row_key).agg(*[F.max(name).alias(f"{AWAY}_{name}") for name in measures])
    return home.join(away.hint("merge"), list(row_key), "left").select(*columns, *[f"{side}_{name}" for side in SIDES for name in measures])
