"""Descriptive statistics, one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import col, numeric_columns, ratio, structs_to_rows
from farol.functions.quantiles import quantile_rows


def adjusted_skewness(n: Column, g1: Column) -> Column:
    """Bias-corrected skewness; NULL below three values, 0 for a constant column."""
    return F.when(n >= 3, F.coalesce(g1 * F.sqrt(n * (n - 1.0)) / (n - 2.0), F.lit(0.0)))


def adjusted_kurtosis(n: Column, g2: Column) -> Column:
    """Bias-corrected excess kurtosis; NULL below four values, 0 for a constant column."""
    corrected = (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * g2 + 6.0)
    return F.when(n >= 4, F.coalesce(corrected, F.lit(0.0)))


def moment_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, max, skewness, kurtosis, cv and missing per feature, all from one scan."""
    aggs, cells = [], []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        aggs += [F.count(x).alias(f"__n{i}"), F.avg(x).alias(f"__a{i}"), F.stddev_samp(x).alias(f"__s{i}"),
                 F.min(x).alias(f"__l{i}"), F.max(x).alias(f"__h{i}"), F.count_if(x.isNull()).alias(f"__m{i}"),
                 F.when(F.min(x) < F.max(x), F.skewness(x)).alias(f"__g{i}"),
                 F.when(F.min(x) < F.max(x), F.kurtosis(x)).alias(f"__k{i}")]
        n, mean, std = F.col(f"__n{i}"), F.col(f"__a{i}"), F.col(f"__s{i}")
        cells.append(F.struct(
            F.lit(c).alias("feature"), n.alias("count"), mean.alias("mean"), std.alias("std"),
            F.col(f"__l{i}").alias("min"), F.col(f"__h{i}").alias("max"),
            adjusted_skewness(n.cast("double"), F.col(f"__g{i}")).alias("skew"),
            adjusted_kurtosis(n.cast("double"), F.col(f"__k{i}")).alias("kurtosis"),
            F.try_divide(std, mean).alias("cv"), F.col(f"__m{i}").alias("missing")))
    return structs_to_rows(df.agg(*aggs), cells)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, id_col: str = words.ID_COLUMN,
                     places: int = 4) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max, skewness, kurtosis, cv, missing; rounded."""
    columns = list(columns or numeric_columns(df, [id_col]))
    moments = moment_rows(df, columns)
    quartiles = quantile_rows(df, columns, [0.25, 0.5, 0.75])
    joined = moments.join(F.broadcast(quartiles), "feature")
    rounded = [F.round(c, places).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max", "skew", "kurtosis", "cv")]
    return joined.select("feature", "count", *rounded, "missing")


def scale_and_skew(df: DataFrame, columns: Sequence[str] | None = None, id_col: str = words.ID_COLUMN) -> DataFrame:
    """Mean, spread and skewness per feature, by mean; `skewed` marks |skew| > 1."""
    columns = list(columns or numeric_columns(df, [id_col]))
    return moment_rows(df, columns).select(
        "feature", "mean", "std", "skew", (F.abs("skew") > 1).alias("skewed")).orderBy("mean", "feature")


def class_balance(df: DataFrame, label: str = words.LABEL_COLUMN, classes: Sequence[str] = ("B", "M")) -> DataFrame:
    """Counts in a fixed class order, share of all rows, and the imbalance ratio."""
    counts = df.groupBy(col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    listed = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(classes)], "place int, class string")
    ordered = listed.join(counts, "class", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    total, spread = counts.agg(F.sum("n")).scalar(), counts.agg(F.max("n") / F.min("n")).scalar()
    return ordered.select("place", "class", "n", (F.lit(100.0) * ratio(F.col("n"), total)).alias("pct"),
                          spread.alias("imbalance_ratio")).orderBy("place")
