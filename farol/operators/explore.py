"""The tables behind the exploratory figures: histograms, densities, boxes, components and scatter pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from farol import vocabulary as words
from farol.functions.columns import col, long_form
from farol.functions.quantiles import quantile_rows

CURVE_POINTS = 200
NODES = 2048


def _ranges(long: DataFrame) -> DataFrame:
    """low, high, n and spread per (feature, class); a constant feature gets half a unit on both sides."""
    span = long.groupBy("feature", "class").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"), F.stddev_samp("value").alias("spread"))
    flat = F.col("low") == F.col("high")
    return span.select("feature", "class", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
                       F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"), "n", "spread")


def _long(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return long_form(df.withColumn("class", col(label)), list(features), ["class"]).where("value IS NOT NULL")


def density_histogram(df: DataFrame, features: Sequence[str], label: str = words.LABEL_COLUMN, bins: int = 28) -> DataFrame:
    """Per feature and class, counts and density in equal bins over that class's own range; the last bin is closed."""
    long = _long(df, features, label)
    span = _ranges(long)
    place = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1)).cast("int")
    counts = long.join(F.broadcast(span), ["feature", "class"]).groupBy("feature", "class", place.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.max("low").alias("low"), F.max("high").alias("high"), F.max("n").alias("n"))
    width = (F.col("high") - F.col("low")) / bins
    return counts.select("feature", "class", "bin", (F.col("low") + F.col("bin") * width).alias("left"), "count",
                         (F.col("count") / (F.col("n") * width)).alias("density"))


def density_curve(df: DataFrame, features: Sequence[str], label: str = words.LABEL_COLUMN, points: int = CURVE_POINTS,
                  nodes: int = NODES) -> DataFrame:
    """Gaussian density per feature and class at equal steps over its range, Scott bandwidth.

    Each value is shared between its two neighbouring nodes of a fine grid, so the smoothing works on
    `nodes` weights per curve whatever the number of rows.
    """
    long = _long(df, features, label)
    span = _ranges(long)
    keys = ["feature", "class"]
    position = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * (nodes - 1)
    left = F.least(F.floor(position), F.lit(nodes - 2))
    shares = F.explode(F.array(F.struct(left.alias("node"), (left + 1 - position).alias("w")),
                               F.struct((left + 1).alias("node"), (position - left).alias("w")))).alias("s")
    weights = long.join(F.broadcast(span), keys).select(*keys, shares).groupBy(*keys, F.col("s.node").alias("node")).agg(
        F.sum("s.w").alias("w")).where("w > 0")
    bandwidth = F.col("spread") * F.pow(F.col("n"), -0.2)
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    placed = weights.join(F.broadcast(span.select(*keys, "low", "high", "n", bandwidth.alias("h"))), keys).select("*", step)
    x = F.col("low") + F.col("point") * (F.col("high") - F.col("low")) / (points - 1)
    at = F.col("low") + F.col("node") * (F.col("high") - F.col("low")) / (nodes - 1)
    kernel = F.col("w") * F.exp(-0.5 * F.pow((x - at) / F.col("h"), 2)) / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return placed.where("h > 0").groupBy(*keys, "point").agg(F.max(x).alias("x"), F.sum(kernel).alias("density"))


def _fences(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    labelled = df.withColumn("class", col(label))
    box = quantile_rows(labelled, list(features), [0.25, 0.5, 0.75], by="class")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    return box.select("class", "feature", F.col("q25").alias("q1"), F.col("q50").alias("median"), F.col("q75").alias("q3"),
                      (F.col("q25") - reach).alias("low_fence"), (F.col("q75") + reach).alias("high_fence"))


def box_table(df: DataFrame, features: Sequence[str], label: str = words.LABEL_COLUMN) -> DataFrame:
    """Quartiles, whiskers (the farthest values inside 1.5 IQR) and number of outliers per feature and class."""
    joined = _long(df, features, label).join(F.broadcast(_fences(df, features, label)), ["feature", "class"])
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    box = joined.groupBy("feature", "class").agg(
        *[F.max(c).alias(c) for c in ("q1", "median", "q3")], F.min(F.when(inside, F.col("value"))).alias("lowest"),
        F.max(F.when(inside, F.col("value"))).alias("highest"), F.count_if(~inside).alias("outliers"))
    return box.select("feature", "class", "q1", "median", "q3", F.least("lowest", "q1").alias("low_whisker"),
                      F.greatest("highest", "q3").alias("high_whisker"), "outliers")


def outlier_rows(df: DataFrame, features: Sequence[str], label: str = words.LABEL_COLUMN, id_col: str = words.ID_COLUMN) -> DataFrame:
    """The rows outside the fences, one per (feature, row)."""
    long = long_form(df.withColumn("class", col(label)), list(features), [id_col, "class"]).where("value IS NOT NULL")
    joined = long.join(F.broadcast(_fences(df, features, label)), ["feature", "class"])
    return joined.where(~F.col("value").between(F.col("low_fence"), F.col("high_fence"))).select("feature", "class", col(id_col), "value")


def fit_components(df: DataFrame, features: Sequence[str], k: int = 10):
    """Principal components of z-scored features. Returns (z-scored table with a vector column, model, signs).

    Rows must be complete: impute first. Each component is signed so that its largest loading is positive.
    """
    features = list(features)
    stats = df.agg(*[F.avg(col(c)).alias(f"a{i}") for i, c in enumerate(features)],
                   *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(features)]).first()
    z = {f"__z{i}": (col(c).cast("double") - F.lit(stats[f"a{i}"])) / F.lit(stats[f"s{i}"] or 1.0) for i, c in enumerate(features)}
    table = VectorAssembler(inputCols=list(z), outputCol="__x").transform(df.withColumns(z)).drop(*z)
    model = PCA(k=min(k, len(features)), inputCol="__x", outputCol="__pc").fit(table)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(loadings.shape[1])]
    return table, model, signs


def component_variance(df: DataFrame, features: Sequence[str], k: int = 10) -> DataFrame:
    """Explained and cumulated share of variance per component."""
    _, model, _ = fit_components(df, features, k)
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    table = df.sparkSession.createDataFrame(rows, "component int, variance_ratio double")
    return table.withColumn("cumulative_ratio", F.sum("variance_ratio").over(Window.orderBy("component")))


def component_loadings(df: DataFrame, features: Sequence[str], k: int = 10) -> DataFrame:
    """The weight of every feature in every component."""
    _, model, signs = fit_components(df, features, k)
    loadings = model.pc.toArray()
    rows = [(j + 1, f, float(loadings[i, j] * signs[j])) for i, f in enumerate(features) for j in range(loadings.shape[1])]
    return df.sparkSession.createDataFrame(rows, "component int, feature string, loading double")


def projected_points(df: DataFrame, features: Sequence[str], label: str = words.LABEL_COLUMN, id_col: str = words.ID_COLUMN) -> DataFrame:
    """E5: every row on the first two components."""
    table, model, signs = fit_components(df, features, 2)
    pc = vector_to_array("__pc")
    return model.transform(table).select(col(id_col), col(label).alias("class"), (pc[0] * signs[0]).alias("pc1"),
                                         (pc[1] * signs[1]).alias("pc2"))


def scatter_pairs(df: DataFrame, features: Sequence[str], label: str = words.LABEL_COLUMN, id_col: str = words.ID_COLUMN) -> DataFrame:
    """(x, y) of every row for each pair of features below the diagonal."""
    cells = [F.struct(F.lit(features[j]).alias("feature_x"), F.lit(features[i]).alias("feature_y"),
                      col(features[j]).cast("double").alias("x"), col(features[i]).cast("double").alias("y"))
             for i in range(len(features)) for j in range(i)]
    return df.select(col(id_col), col(label).alias("class"), F.explode(F.array(*cells)).alias("p")).select(id_col, "class", "p.*")
