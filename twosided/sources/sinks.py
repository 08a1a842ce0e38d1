"""Where results go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV files with a header and no row index; blanks and line ends around values are kept."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **kept).partitionBy(*partition_by).csv(path)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Replace a catalog table with any frame, features included; ``path`` places its files."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replace_jdbc_table(df: DataFrame, url: str, name: str, properties: Mapping[str, str]) -> None:
    """Replace a database table; ``properties`` carry the credentials and the driver class."""
    df.write.jdbc(url, name, mode="overwrite", properties=dict(properties))
