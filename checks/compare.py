"""Compare a Spark result with the result of its SQL in DuckDB, without tolerance."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

# Names of the test tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


# Spark and DuckDB names of the same type.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty where schema and all rows agree."""
    names = sorted(result.columns)
    wanted_names = sorted(d[0] for d in connection.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
    if names != wanted_names:
        return [f"columns {names} <> {wanted_names}"]
    expected = connection.execute(f"SELECT {', '.join(_quoted(n) for n in names)} FROM ({sql})")
    types = {d[0]: str(d[1]) for d in expected.description}
    found = {f.name: TYPE_NAMES.get(f.dataType.simpleString()) for f in result.schema}
    notes = [f"{n}: {found[n]} <> {types[n]}" for n in names if found[n] != types[n]]
    wanted = Counter(repr(tuple(row)) for row in expected.fetchall())
    got = Counter(repr(tuple(row)) for row in result.select(*names).collect())
    missing, extra = wanted - got, got - wanted
    if missing or extra:
        notes.append(f"{missing.total()} missing of {wanted.total()}, {extra.total()} extra")
        notes.extend(f"missing {r}" for r in list(missing)[:3])
        notes.extend(f"extra   {r}" for r in list(extra)[:3])
    return notes


def _quoted(name: str) -> str:
    return f'"{name}"'
