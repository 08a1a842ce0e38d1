"""Compare a Spark result with DuckDB's on the same parquet tables."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark_df, sql: str, con) -> list[str]:
    """What differs in columns, types, number of rows and values; row order is ignored."""
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    ours_types = {name: TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    problems = [
        f"type of {name}: {ours_types.get(name)} != {theirs_types.get(name)}"
        for name in sorted(ours_types.keys() | theirs_types.keys())
        if ours_types.get(name) != theirs_types.get(name)
    ]
    theirs = result.fetchall()
    table = spark_df.toArrow()
    if len(theirs) != table.num_rows:
        problems.append(f"rows {table.num_rows} != {len(theirs)}")
    if problems:
        return problems
    names = sorted(ours_types)
    places = [list(theirs_types).index(name) for name in names]
    ours = _sorted(zip(*[table.column(name).to_pylist() for name in names]))
    wrong = [(a, b) for a, b in zip(ours, _sorted(tuple(row[i] for i in places) for row in theirs)) if a != b]
    return [f"{len(wrong)} of {len(theirs)} rows differ in {names}: {wrong[:3]}"] if wrong else []
