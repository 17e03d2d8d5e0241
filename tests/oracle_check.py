"""Compare a Spark result with its SQL counterpart run by DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# DuckDB type -> Spark types it may stand for.
SAME_TYPE = {
    "BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"}, "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"}, "DATE": {"date"}, "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return 0.0 if value == 0 and isinstance(value, float) else value


def _bag(rows, names: list[str]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Reasons why the two results differ; empty when they agree."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    problems = [
        f"type of {name}: spark {kind}, sql {types[name]}"
        for name, kind in df.dtypes
        if kind not in SAME_TYPE.get(types[name], {kind})
    ]
    expected = _bag(cursor.fetchall(), names)
    found = _bag(df.collect(), df.columns)
    if sum(expected.values()) != sum(found.values()):
        problems.append(f"rows: spark {sum(found.values())}, sql {sum(expected.values())}")
    extra, lacking = found - expected, expected - found
    if extra or lacking:
        problems.append(
            f"{sum(extra.values())} rows differ, spark {list(extra)[:2]} sql {list(lacking)[:2]}"
        )
    return problems
