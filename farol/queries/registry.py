"""Registration of queries: a Spark callable and, where SQL can express the result, a DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farol.functions.columns import col

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return register


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, whole numbers as bigint: a form both engines print the same way."""
    def cell(f: T.StructField):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(col(f.name).cast("double"), places).alias(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return col(f.name).cast("bigint").alias(f.name)
        return col(f.name)
    return df.select(*[cell(f) for f in df.schema.fields])
