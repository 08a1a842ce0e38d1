"""Column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def rename_with(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``."""
    return df.toDF(*[rule(name) for name in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return rename_with(df, str.lower)


def without_side(side: str) -> Callable[[str], str]:
    """A rule that strips the ``side`` prefix, for :func:`rename_with`."""
    return lambda name: name.removeprefix(f"{side}_")


def with_side(side: str, keep: tuple[str, ...] = ()) -> Callable[[str], str]:
    """A rule that adds the ``side`` prefix to all names but ``keep``."""
    return lambda name: name if name in keep else f"{side}_{name}"
