"""Compare a registered query with its SQL twin on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf) / name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int):
        return value
    return str(value)


_FAMILY = {"BIGINT": "int", "INTEGER": "int", "long": "int", "int": "int", "bigint": "int", "DOUBLE": "double",
           "double": "double", "VARCHAR": "string", "string": "string", "BOOLEAN": "boolean", "boolean": "boolean"}


def differences(spark_df, con, sql: str) -> list[str]:
    """Human-readable differences in columns, column types, row count and values."""
    relation = con.sql(sql)
    problems = []
    names = sorted(spark_df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    ours = dict(spark_df.dtypes)
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for name in names:
        if _FAMILY.get(ours[name], ours[name]) != _FAMILY.get(theirs[name], theirs[name]):
            problems.append(f"type of {name}: {ours[name]} != {theirs[name]}")
    left = Counter(tuple(_plain(row[n]) for n in names) for row in spark_df.collect())
    order = [relation.columns.index(n) for n in names]
    right = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    if left != right:
        problems.append(f"rows {sum(left.values())} != {sum(right.values())}" if sum(left.values()) != sum(right.values())
                        else "values differ")
        problems.append(f"only spark {list((left - right).items())[:3]}")
        problems.append(f"only sql {list((right - left).items())[:3]}")
    return problems
