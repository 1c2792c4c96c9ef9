"""Pairwise-complete second moments of many columns in one pass.

Hundreds of `corr` expressions in one aggregate are slow to plan and to run. Each task instead
adds up p x p blocks with numpy on Arrow batches and emits one row per column pair; Spark sums them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.functions.columns import col

SUMS = ("n", "sx", "sy", "sxy", "sxx", "syy")


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxy, sxx, syy) for i <= j over rows where both columns are present.

    Values are shifted by the column means first (one small job) so that large offsets do not cancel;
    a constant column is shifted by its value, so its variance is exactly zero.
    """
    columns = list(columns)
    wide = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    centre = [F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c)).alias(c) for c in wide.columns]
    means = wide.agg(*centre).first()
    shift = np.array([means[c] if means[c] is not None else 0.0 for c in wide.columns])
    p = len(columns)
    upper_i, upper_j = np.triu_indices(p)

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = np.zeros((6, p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - shift
            seen = (~np.isnan(x)).astype(float)
            x = np.where(seen > 0, x, 0.0)
            squares = x * x
            blocks[0] += seen.T @ seen
            blocks[1] += x.T @ seen
            blocks[2] += seen.T @ x
            blocks[3] += x.T @ x
            blocks[4] += squares.T @ seen
            blocks[5] += seen.T @ squares
        cells = {name: blocks[k][upper_i, upper_j] for k, name in enumerate(SUMS)}
        yield pd.DataFrame({"i": upper_i.astype("int32"), "j": upper_j.astype("int32"), **cells})

    schema = "i int, j int, " + ", ".join(f"{s} double" for s in SUMS)
    parts = wide.mapInPandas(accumulate, schema)
    return parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def correlation_of(moments: DataFrame) -> DataFrame:
    """(i, j, n, r); r is NULL where a column does not vary."""
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    scale = F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))
    r = F.when((F.col("n") >= 2) & (scale > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / scale)))
    return moments.select("i", "j", F.col("n").cast("bigint").alias("n"), r.alias("r"))
