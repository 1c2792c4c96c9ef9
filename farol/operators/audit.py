"""Data-quality audit of a case table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farol import vocabulary as words
from farol.functions.columns import col, numeric_columns, structs_to_rows


def is_missing(df: DataFrame, name: str) -> Column:
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return (col(name).isNull() | F.isnan(col(name))) if floating else col(name).isNull()


def shape(df: DataFrame) -> DataFrame:
    """Q1: rows, columns, numeric and categorical columns with names. One count."""
    numeric = numeric_columns(df)
    other = [c for c in df.columns if c not in numeric]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.lit(len(numeric)).cast("bigint").alias("n_numeric"),
        F.lit(len(other)).cast("bigint").alias("n_categorical"),
        F.array(*[F.lit(c) for c in numeric]).cast("array<string>").alias("numeric_columns"),
        F.array(*[F.lit(c) for c in other]).cast("array<string>").alias("categorical_columns"))


def missing(df: DataFrame) -> DataFrame:
    """Q3: missing cells per column, only columns that have some."""
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(df.columns)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"__m{i}").alias("missing")) for i, c in enumerate(df.columns)]
    return structs_to_rows(row, cells).where("missing > 0")


def missing_total(df: DataFrame) -> DataFrame:
    """Q3: all missing cells of the table, 0 if none."""
    return missing(df).agg(F.coalesce(F.sum("missing"), F.lit(0)).cast("bigint").alias("missing_total"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q4: rows beyond the first copy; NULLs are equal. Copies collapse before the shuffle."""
    copies = df.groupBy(*[col(c) for c in (columns or df.columns)]).agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicated_rows"))


def duplicate_ids(df: DataFrame, id_col: str = words.ID_COLUMN) -> DataFrame:
    """Q5: rows whose id was seen before, NULL if the table has no id column."""
    if id_col not in df.columns:
        return df.agg(F.lit(None).cast("bigint").alias("duplicated_ids"))
    return duplicate_rows(df, [id_col]).withColumnRenamed("duplicated_rows", "duplicated_ids")


def constant_columns(df: DataFrame) -> DataFrame:
    """Q6: numeric columns with at most one distinct value, by min and max in one pass."""
    names = numeric_columns(df)
    row = df.agg(*[F.min(col(c)).eqNullSafe(F.max(col(c))).alias(f"__c{i}") for i, c in enumerate(names)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"__c{i}").alias("constant")) for i, c in enumerate(names)]
    return structs_to_rows(row, cells).where("constant").select("feature")


def impossible_zeros(df: DataFrame, prefixes: Sequence[str] = words.NEVER_ZERO_PREFIXES) -> DataFrame:
    """Q7: zeros in columns that cannot be zero, chosen by name prefix; only columns that have some."""
    names = [c for c in numeric_columns(df) if c.startswith(tuple(prefixes))]
    if not names:
        return df.sparkSession.createDataFrame([], "feature string, zeros bigint")
    row = df.agg(*[F.count_if(col(c) == 0).alias(f"__z{i}") for i, c in enumerate(names)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"__z{i}").alias("zeros")) for i, c in enumerate(names)]
    return structs_to_rows(row, cells).where("zeros > 0")


def class_counts(df: DataFrame, label: str = words.LABEL_COLUMN) -> DataFrame:
    """Q8: rows and per cent per class, most frequent first."""
    counts = df.groupBy(col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("class", "n", F.round(F.lit(100.0) * F.col("n") / total, 2).alias("pct")).orderBy(F.desc("n"), "class")


def imbalance(df: DataFrame, label: str = words.LABEL_COLUMN) -> DataFrame:
    """Q9: largest class over smallest class."""
    counts = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.round(F.max("n") / F.min("n"), 3).alias("imbalance_ratio"))


def audit(df: DataFrame, id_col: str = words.ID_COLUMN, label: str = words.LABEL_COLUMN,
          prefixes: Sequence[str] = words.NEVER_ZERO_PREFIXES) -> DataFrame:
    """All findings as one row: counts, and maps or lists keyed by column or class.

    Everything that needs no grouping comes from one scan; rows, ids and classes are grouped once each.
    """
    numeric = numeric_columns(df)
    zero_columns = [c for c in numeric if c.startswith(tuple(prefixes))]

    def texts(names: Sequence[str]) -> Column:
        return F.array(*[F.lit(c) for c in names]).cast("array<string>")

    def found(names: Sequence[str], counts: list[Column]) -> Column:
        entries = F.map_from_arrays(texts(names), F.array(*counts).cast("array<bigint>"))
        return F.map_filter(entries, lambda _, n: n > 0)

    missing_counts = [F.count_if(is_missing(df, c)) for c in df.columns]
    still = [F.when(F.min(col(c)).eqNullSafe(F.max(col(c))), F.lit(c)) for c in numeric]
    profile = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.lit(len(numeric)).cast("bigint").alias("n_numeric"),
        F.lit(len(df.columns) - len(numeric)).cast("bigint").alias("n_categorical"),
        texts([c for c in df.columns if c not in numeric]).alias("categorical_columns"),
        found(df.columns, missing_counts).alias("missing_by_column"),
        F.array_compact(F.array(*still).cast("array<string>")).alias("constant_columns"),
        found(zero_columns, [F.count_if(col(c) == 0) for c in zero_columns]).alias("impossible_zeros"))
    out = profile.withColumns({
        "missing_total": F.aggregate(F.map_values("missing_by_column"), F.lit(0).cast("bigint"), lambda a, n: a + n),
        "duplicated_rows": duplicate_rows(df).scalar(),
        "duplicated_ids": duplicate_ids(df, id_col).scalar()})
    if label in df.columns:
        counts = class_counts(df, label)
        entries = F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("class"), F.col("pct"))), asc=False)
        ranked = counts.agg(entries).scalar()
        out = out.withColumn("__classes", ranked).withColumns({
            "class_counts": F.map_from_arrays(F.col("__classes")["class"], F.col("__classes")["n"]),
            "class_balance_pct": F.map_from_arrays(F.col("__classes")["class"], F.col("__classes")["pct"]),
            "imbalance_ratio": imbalance(df, label).scalar()}).drop("__classes")
    return out
