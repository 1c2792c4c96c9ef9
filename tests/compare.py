"""Run a registered query on Spark and its SQL on DuckDB and report the first difference."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((plain(k), plain(v)) for k, v in value.items()))
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = multiset(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns: spark {sorted(spark_df.columns)} sql {sorted(names)}"
    got = multiset(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == expected:
        return None
    only_spark, only_sql = got - expected, expected - got
    return (f"{sum(only_spark.values())} of {sum(got.values())} rows only in spark, {sum(only_sql.values())} of "
            f"{sum(expected.values())} only in sql\n  columns {sorted(names)}\n  spark {sorted(only_spark, key=str)[:3]}\n"
            f"  sql   {sorted(only_sql, key=str)[:3]}")
