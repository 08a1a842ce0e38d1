"""Scans of the text sources."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twosided.functions import text
from twosided.sources import schemas

_CSV = {"header": True, "multiLine": False, "escape": '"'}


def result_paths(root: str, leagues: Sequence[str] = schemas.LEAGUES, years: Sequence[int] = range(1990, 2022)):
    """One file per league and year, so that other leagues and years are never listed or read."""
    return [f"{root}/{league}/Results_{year}_{league}.csv" for league in leagues for year in years]


def _named_results(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(schemas.RESULT_NAMES).filter(~F.col("score").contains("N/A"))


def _by_name(spark: SparkSession, paths: str | Sequence[str], schema: str, **options) -> DataFrame:
    """CSV files with the columns of ``schema`` taken by their names in the header, whatever their order.

    Files whose headers differ from each other, a column that is absent and a number that is none are errors.
    """
    df = spark.read.options(**{**_CSV, **options, "enforceSchema": False}).csv(paths)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])


def scan_results(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All result files as one table, unplayed contests left out."""
    return _named_results(_by_name(spark, paths, schemas.RESULTS))


def _open(path: str):
    """A file of any store that pyarrow knows, open for random access."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return system.open_input_file(place)


def scan_zipped_results(spark: SparkSession, paths: str | Sequence[str], member: str = r".*Results_.*\.csv") -> DataFrame:
    """Results inside zip archives, read by the names in each member's header; quoted line ends are kept.

    Archives are only listed at first. Their members are then dealt out to tasks, and each is read as a stream from its place
    in the archive, so neither an archive nor a member is held whole.
    """
    fields = T.StructType.fromDDL(schemas.RESULTS)
    names = [f.name for f in fields]

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with _open(path) as file, zipfile.ZipFile(file) as archive:
                    yield pd.DataFrame([(path, x) for x in archive.namelist() if re.fullmatch(member, x)], columns=["path", "member"])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name in batch.itertuples(index=False, name=None):
                with _open(path) as file, zipfile.ZipFile(file) as archive, archive.open(name) as data:
                    lines = csv.reader(io.TextIOWrapper(data, "utf-8", newline=""))
                    places = {x.strip().lower(): i for i, x in enumerate(next(lines, []))}
                    wanted = [places[x] for x in names] if places else []
                    found = ([line[i] or None for i in wanted] for line in lines if line)
                    while part := list(islice(found, 10_000)):
                        yield pd.DataFrame(part, columns=names)

    archives = spark.read.format("binaryFile").load(paths).select("path")
    listed = archives.mapInPandas(members, "path string, member string").repartition("path", "member")
    text_rows = listed.mapInPandas(rows, ", ".join(f"{name} string" for name in names))
    return _named_results(text_rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]))


def scan_match_info(spark: SparkSession, paths: str | Sequence[str], day_first: bool = False) -> DataFrame:
    """Match details with a parsed date; the referee text may run over several lines.

    With ``day_first`` (newer files) dates are day first and the referee field is already a plain name.
    """
    df = _by_name(spark, paths, schemas.MATCH_INFO, multiLine=True)
    return parse_match_info(df, day_first)


def parse_match_info(df: DataFrame, day_first: bool = False) -> DataFrame:
    df = text.without_tokens(df, ["date_new", "referee"])
    df = df.withColumn("date", text.parse_date("date_new", day_first)).drop("date_new")
    return df if day_first else df.withColumn("referee", text.referee_name())


def scan_team_info(spark: SparkSession, paths: str | Sequence[str], dropped_country: str = "Portugal") -> DataFrame:
    """The teams with a numeric capacity, one country left out and teams of unknown country kept."""
    return parse_team_info(_by_name(spark, paths, schemas.TEAM_INFO), dropped_country)


def parse_team_info(df: DataFrame, dropped_country: str = "Portugal") -> DataFrame:
    return df.filter(~F.col("country").eqNullSafe(dropped_country)).withColumn("capacity", text.whole_number("capacity"))


def scan_ratings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``link``, ``home_elo``, ``away_elo`` from JSON lines that each hold a map of links to ratings.

    Spark's parser keeps every field name of a file in a table that it copies for each new one, and here a name is a link. So
    lines are parsed in Python; those that its stricter parser refuses go to Spark's.
    """
    fields = T.StructType.fromDDL(schemas.RATINGS)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    lines = spark.read.text(paths).select("value").mapInArrow(_rating_maps, f"{kept}, refused string")
    spelled = F.from_json("refused", fields)["ratings"]
    return flatten_ratings(lines.select(F.when(F.col("refused").isNull(), F.col("ratings")).otherwise(spelled).alias("ratings")))


def _rating_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The map ``ratings`` of each line, entries without a rating included, or the line itself if it is ``refused``."""
    decode = json.JSONDecoder(object_pairs_hook=tuple, parse_int=str, parse_float=str, parse_constant=str).raw_decode
    schema = pa.schema([("ratings", pa.map_(pa.string(), pa.struct([("Elo_home", pa.string()), ("Elo_away", pa.string())]))), ("refused", pa.string())])
    for batch in batches:
        column = batch.column(0)
        start = 0
        while start < len(column):
            rows, found = [], 0
            while start < len(column) and found < 50_000:
                line = column[start].as_py()
                start += 1
                try:
                    for ratings in _ratings_of(decode(line, len(line) - len(line.lstrip(" \t\r")))[0]):
                        rows.append((ratings, None))
                        found += len(ratings)
                except (ValueError, RecursionError):
                    rows.append(([], line))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def _ratings_of(record) -> Iterator[tuple]:
    """The entries of ``ratings`` of a line's record, or of each record of a line that is a list of them; objects are tuples of pairs."""
    records = record if isinstance(record, list) else [record]
    for fields in records if all(isinstance(x, tuple) for x in records) else []:
        ratings = dict(fields).get("ratings")
        if isinstance(ratings, tuple):
            yield [(_encoded(link), _rating(value)) for link, value in ratings]


def _rating(value) -> dict | None:
    if not isinstance(value, tuple | None):
        raise ValueError("a rating that is no object")
    fields = None if value is None else dict(value)
    return fields and {name: _encoded(text) if isinstance(text := fields.get(name), str) else None for name in ("Elo_home", "Elo_away")}


def _encoded(text: str) -> str:
    """The text itself; half of a surrogate pair is an error, as it cannot be encoded."""
    text.encode()
    return text


def flatten_ratings(df: DataFrame, column: str = "ratings") -> DataFrame:
    entries = df.select(F.explode(column).alias("link", "rating"))
    numbers = {"home_elo": "rating.Elo_home", "away_elo": "rating.Elo_away"}
    return entries.select(
        "link", *[F.nullif(F.col(path), F.lit("N/A")).try_cast("double").alias(name) for name, path in numbers.items()]
    )


def concatenate(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same column names."""
    return reduce(DataFrame.unionByName, frames)


def merge_maps(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per key over all sources; the last source that has the key wins."""
    numbered = [df.withColumn("__source", F.lit(i)) for i, df in enumerate(sources)]
    values = [name for name in sources[0].columns if name != key]
    latest = concatenate(numbered).groupBy(key).agg(F.max_by(F.struct(*values), "__source").alias("__last"))
    return latest.select(key, "__last.*")
