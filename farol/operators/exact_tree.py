"""Decision tree with exact splits: every border between neighbouring distinct values of every feature is tried.

Cells collapse to (node, feature, value) with their class counts before anything is sorted, and running counts per range of values
give both sides of every border, so neither rows nor values meet in one task. A level takes one pass over the rows for all its nodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.functions.columns import col
from farol.functions.running import balanced_edges_of, next_in_order, running_sums, with_range

#: Gains are compared after rounding to so many places, so that ties do not hang on the order of additions.
PLACES = 9


def impurity(positives: Column, n: Column, criterion: str) -> Column:
    """Gini or entropy (in bits) of a node with two classes; NULL for an empty one."""
    p = F.try_divide(positives.cast("double"), n.cast("double"))
    if criterion == "gini":
        return F.lit(1.0) - p * p - (1.0 - p) * (1.0 - p)
    if criterion != "entropy":
        raise ValueError("criterion must be gini or entropy")
    bits = lambda q: F.when(q > 0, -q * F.log2(q)).otherwise(0.0)
    return bits(p) + bits(1.0 - p)


def split_candidates(rows: DataFrame, features: Sequence[str], edges: dict[str, list[float]], criterion: str = "gini") -> DataFrame:
    """(node, k, feature, threshold, gain, n, positives, n_left, positives_left) of every border; the threshold is the middle of two neighbours.

    `rows` has node, label and the features. A missing value takes no part in its feature's borders.
    """
    names = [f"__c{i}" for i in range(len(features))]
    wide = rows.select("node", F.col("label").cast("bigint").alias("label"), *[col(c).cast("double").alias(n) for c, n in zip(features, names)])
    for c, n in zip(features, names):
        wide = with_range(wide, n, edges[c], f"{n}_range") if edges[c] else wide.withColumn(f"{n}_range", F.lit(0))
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(n).alias("value"), F.col(f"{n}_range").alias("range")) for i, n in enumerate(names)]))
    points = wide.select("node", "label", cells.alias("cell")).where("cell.value IS NOT NULL").groupBy(
        "node", "cell.k", "cell.range", "cell.value").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    counted = running_sums(points, ["node", "k"], "value", ["n", "pos"], range_col="range", descending=False)
    borders = next_in_order(counted, ["node", "k"], "value", ["value"], range_col="range", descending=False).where("next_value IS NOT NULL")
    left, right = F.col("run_n"), F.col("all_n") - F.col("run_n")
    below = (left * impurity(F.col("run_pos"), left, criterion) + right * impurity(F.col("all_pos") - F.col("run_pos"), right, criterion)) / F.col("all_n")
    gain = F.round(impurity(F.col("all_pos"), F.col("all_n"), criterion) - below, PLACES)
    return borders.select(
        "node", "k", F.array(*[F.lit(c) for c in features])[F.col("k")].alias("feature"), ((F.col("value") + F.col("next_value")) / 2.0).alias("threshold"),
        gain.alias("gain"), F.col("all_n").alias("n"), F.col("all_pos").alias("positives"), left.alias("n_left"), F.col("run_pos").alias("positives_left"))


def best_splits(candidates: DataFrame, min_leaf: int = 1) -> DataFrame:
    """The candidate of highest gain per node that leaves `min_leaf` rows on both sides; ties to the first feature, then to the lowest threshold."""
    fits = (F.col("gain") > 0) & (F.col("n_left") >= min_leaf) & (F.col("n") - F.col("n_left") >= min_leaf)
    row = F.struct("k", "feature", "threshold", "gain", "n", "positives", "n_left", "positives_left")
    order = F.struct("gain", -F.col("k"), -F.col("threshold"))
    return candidates.where(fits).groupBy("node").agg(F.max_by(row, order).alias("b")).select("node", "b.*").drop("k")


def fit_exact_tree(df: DataFrame, features: Sequence[str], label: str = "label", depth: int = 2, min_leaf: int = 1, criterion: str = "gini") -> DataFrame:
    """(node, feature, threshold, gain, n, positives, n_left, positives_left) of the inner nodes; node 1 is the root, node i has 2i and 2i + 1 below it.

    Rows at or under the threshold go left; a row without the value goes right. A level's splits, 2**level rows at most, come to the driver.
    """
    rows = df.select(col(label).alias("label"), *[col(c) for c in features]).withColumn("node", F.lit(1))
    doubles = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(features)])
    found = balanced_edges_of(doubles, doubles.columns)
    edges = {c: found[f"c{i}"] for i, c in enumerate(features)}
    splits: list[tuple] = []
    schema = "node int, feature string, threshold double, gain double, n bigint, positives bigint, n_left bigint, positives_left bigint"
    for _ in range(depth):
        level = [tuple(r) for r in best_splits(split_candidates(rows, features, edges, criterion), min_leaf).collect()]
        if not level:
            break
        splits += level
        side = F.lit(0)
        for node, feature, threshold, *_ in level:
            goes_left = F.coalesce(col(feature).cast("double") <= F.lit(threshold), F.lit(False))
            side = F.when(F.col("node") == node, F.when(goes_left, 2 * node).otherwise(2 * node + 1)).otherwise(side)
        rows = rows.withColumn("node", side).where("node > 0")
    return df.sparkSession.createDataFrame(splits, schema)
