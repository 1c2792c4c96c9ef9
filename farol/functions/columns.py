"""Small column expressions used by every operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    """A column by its literal name (names with dots or blanks included) or as given."""
    return F.col(f"`{c.replace('`', '``')}`") if isinstance(c, str) else c


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den in double, `default` where the denominator is not positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(default).cast("double"))


def half_even(c: Column, places: int) -> Column:
    """Round half to even in double arithmetic: scale, rint, unscale."""
    scale = F.lit(float(10**places))
    return F.rint(c * scale) / scale


def nan_to_null(c: Column) -> Column:
    """NaN means missing; NULL is the only missing value the operators know."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def unusable_rows(label: str = "label", score: str = "score") -> Column:
    """Aggregate: how many rows have no label or no score. Ask for it in a group-by, then call `checked`."""
    return F.count_if(col(label).isNull() | col(score).isNull() | F.isnan(col(score))).alias("__bad")


def checked(groups: DataFrame, column: str) -> DataFrame:
    """Fail the job if a group had unusable rows.

    The test sits on the aggregate, not on the rows: raising inside a row expression is unsafe, as a
    shared subexpression may be evaluated before a filter that would have removed the row.
    """
    stop = F.raise_error(F.lit("label and score must not be missing")).cast(groups.schema[column].dataType)
    return groups.withColumn(column, F.when(F.col("__bad") == 0, col(column)).otherwise(stop)).drop("__bad")


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Names of the numeric columns in schema order; booleans are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def missing_to_null(df: DataFrame) -> DataFrame:
    """The table with every NaN of a floating point column turned into NULL."""
    floating = {f.name: F.when(~F.isnan(col(f.name)), col(f.name))
                for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(floating) if floating else df


def long_form(df: DataFrame, columns: list[str], ids: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """One row per (row, column) with the value as double."""
    wide = df.select(*[col(i) for i in ids], *[col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([col(i) for i in ids], [col(c) for c in columns], name, value)


def structs_to_rows(row: DataFrame, cells: list[Column]) -> DataFrame:
    """Turn a one-row (or one-row-per-group) aggregate into rows, one per struct in `cells`."""
    kept = [c for c in row.columns if not c.startswith("__")]
    return row.select(*[col(c) for c in kept], F.explode(F.array(*cells)).alias("__cell")).select(
        *[col(c) for c in kept], "__cell.*")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
