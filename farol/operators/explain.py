"""Importances, permutation importance, Shapley values and single-case explanations."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from farol import vocabulary as words
from farol.functions.columns import col
from farol.functions.running import balanced_edges, range_count
from farol.functions.storage import fresh_path, job_by_job, written
from farol.operators.metrics import PACK, packed_auc
from farol.operators.normalize import sample_rows

ROWS_PER_BUCKET = 2000
#: Rows times repeats that a job of the permutation importance shuffles (one repeat at least), and rows that one of its tasks sorts.
PERMUTED_ROWS, SORTED_ROWS = 16_000_000, 250_000
WALK_CELLS = 2_000_000
MASKED = 5_000_000
#: Trees up to so many leaves, and features on the way to one, are walked by leaf.
LEAVES, PATH_FEATURES = 256, 8
#: Model classes that have a numpy form, see `scorer_of`.
TASK_SIDE = ("LogisticRegressionModel", "GBTClassificationModel", "RandomForestClassificationModel", "DecisionTreeClassificationModel")


# ---- native importance -------------------------------------------------------------------------------

def coefficient_table(spark: SparkSession, names: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Coefficient, odds ratio per standard deviation and size of every feature, largest first."""
    rows = spark.createDataFrame(list(zip(names, map(float, coefficients))), "feature string, coeficiente double")
    return rows.withColumns({"odds_ratio_por_dp": F.exp("coeficiente"), "importancia": F.abs("coeficiente")}).orderBy(
        F.desc("importancia"), "feature")


def importance_table(spark: SparkSession, names: Sequence[str], importances: Sequence[float]) -> DataFrame:
    """Impurity importance, largest first."""
    return spark.createDataFrame(list(zip(names, map(float, importances))), "feature string, importancia double").orderBy(
        F.desc("importancia"), "feature")


def native_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame | None:
    """I1 or I2 for a fitted Spark model; None where it has neither coefficients nor importances."""
    if model.__class__.__name__ == "LogisticRegressionModel":
        return coefficient_table(spark, names, model.coefficients.toArray())
    if hasattr(model, "featureImportances"):
        return importance_table(spark, names, model.featureImportances.toArray())
    return None


# ---- permutation importance --------------------------------------------------------------------------

def permutation_buckets(rows: int) -> int:
    return max(1, rows // ROWS_PER_BUCKET)


def with_donors(df: DataFrame, features: Sequence[str], repeat: int | Column, buckets: int, id_col: str = words.ID_COLUMN,
                seed: int = words.SEED, name: str = "donor", parts: int | None = None) -> DataFrame:
    """Give every row the features of another row: the next one in hash order inside a random bucket, the last takes the first.

    This is a permutation of the rows, done by one window for all features together. Buckets are drawn
    by hash, so they have the same size whatever the data look like. With a column as `repeat` each of its values is a permutation of its own.
    Buckets are dealt to `parts` tasks, or as many as the session has it.
    """
    number = F.lit(repeat) if isinstance(repeat, int) else repeat
    drawn = lambda salt: F.md5(F.concat(F.lit(f"{salt}{seed}|"), number.cast("string"), F.lit("|"), col(id_col).cast("string")).cast("binary"))
    bucket = F.pmod(F.conv(F.substring(drawn("bucket"), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
    window = Window.partitionBy("__bucket", "__turn").orderBy("__order", col(id_col))  # a sort compares the first key without reading the row
    values = F.struct(*[col(c) for c in features])
    placed = df.withColumn("__turn", number).withColumn("__bucket", bucket)
    placed = placed.repartition(*([parts] if parts else []), "__turn", "__bucket")
    placed = placed.withColumn("__order", drawn("permute"))  # behind the shuffle, which moves the ids only
    whole = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_row = F.coalesce(F.lead(values).over(window), F.first(values).over(whole))
    return placed.withColumn(name, next_row).drop("__bucket", "__turn", "__order")


def permutation_importance(df: DataFrame, features: Sequence[str], score: Callable[[DataFrame], DataFrame], label: str = "label",
                           id_col: str = words.ID_COLUMN, repeats: int = 30, seed: int = words.SEED) -> DataFrame:
    """I4: mean and population deviation of the AUC lost when one original feature is permuted, largest first.

    `score` adds a `score` column. The table is written once. A job takes as many repeats as make PERMUTED_ROWS rows: a window per repeat and bucket
    shuffles the rows, then every row is emitted once per feature with that feature swapped, and in the first repeat once as it is; all are scored and
    reduced to an AUC per repeat and feature. A job's shuffle files go when it ends, so the disk it takes does not grow with the repeats.
    The copies keep the id of their row, whatever its type. A count and a sketch of the scores, which only spread the work, run before.
    """
    features, keys, aucs = list(features), ["__repeat", "__feature"], {}
    with job_by_job(df.sparkSession):
        rows = written(df, "permuted")
        n = rows.count()
        edges = balanced_edges(score(rows).select("score"), "score", max(range_count(rows), n // PACK))
        at_once = max(1, PERMUTED_ROWS // max(1, n))
        for first in range(0, repeats, at_once):
            last = min(first + at_once, repeats) - 1
            parts = n * (last - first + 1) // SORTED_ROWS
            parts = parts if parts >= df.sparkSession.sparkContext.defaultParallelism else None
            many = rows.withColumn("__repeat", F.explode(F.sequence(F.lit(first), F.lit(last))))
            donors = with_donors(many, features, F.col("__repeat"), permutation_buckets(n), id_col, seed, "__donor", parts)
            every = lambda m: F.array(*[F.lit(i) for i in range(m)])  # noqa: E731  # the last number of the first repeat stands for no feature
            turns = F.when(F.col("__repeat") == 0, every(len(features) + 1)).otherwise(every(len(features)))
            swapped = donors.withColumn("__feature", F.explode(turns))
            swapped = swapped.withColumns({c: F.when(F.col("__feature") == i, F.col("__donor")[c]).otherwise(col(c)) for i, c in enumerate(features)})
            scored = score(swapped.drop("__donor")).select(*keys, col(label).cast("bigint").alias("label"), "score")
            aucs |= {(r["__repeat"], r["__feature"]): r["roc_auc"] for r in packed_auc(scored, keys, edges).collect()}
    base = aucs[0, len(features)]
    drops = {c: [base - aucs[r, i] for r in range(repeats)] for i, c in enumerate(features)}
    rows = [(c, float(np.mean(d)), float(np.std(d))) for c, d in drops.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, queda_media double, desvio double").orderBy(F.desc("queda_media"), "feature")


# ---- scorers that run inside Python tasks ------------------------------------------------------------

def linear_scorer(coefficients: np.ndarray, intercept: float) -> Callable[[np.ndarray], np.ndarray]:
    """P(class 1) of a logistic model for the rows of a matrix."""
    weights = np.asarray(coefficients, dtype=float)

    def score(x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(x @ weights + intercept)))

    score.linear = weights, float(intercept)  # a walk only adds a term to the margin at each step, see `shapley_walks`
    return score


def tree_tables(model) -> list[dict[str, np.ndarray]]:
    """Node arrays of every tree of a fitted Spark tree model, read from its saved form (model-sized)."""
    spark = SparkSession.getActiveSession()
    path = fresh_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" not in nodes.columns:
        nodes = nodes.select(F.lit(0).alias("treeID"), F.struct(*[col(c) for c in nodes.columns]).alias("nodeData"))
    trees: dict[int, list] = {}
    for r in nodes.select("treeID", "nodeData.*").collect():
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for tree_id in sorted(trees):
        rows = sorted(trees[tree_id], key=lambda r: r["id"])
        place = {r["id"]: i for i, r in enumerate(rows)}
        stats = [list(r["impurityStats"]) for r in rows]
        cut = [r["split"]["leftCategoriesOrThreshold"] for r in rows]
        by_category = [r["leftChild"] >= 0 and r["split"]["numCategories"] >= 0 for r in rows]
        categories = max([r["split"]["numCategories"] for r in rows] + [1])
        goes_left = np.zeros((len(rows), categories), dtype=bool)
        for i, c in enumerate(cut):
            if by_category[i]:
                goes_left[i, np.asarray(c, dtype=int)] = True
        out.append({
            "by_category": np.array(by_category), "goes_left": goes_left,
            "feature": np.array([r["split"]["featureIndex"] if r["leftChild"] >= 0 else -1 for r in rows]),
            "threshold": np.array([c[0] if r["leftChild"] >= 0 and c else 0.0 for r, c in zip(rows, cut)]),
            "left": np.array([place.get(r["leftChild"], -1) for r in rows]),
            "right": np.array([place.get(r["rightChild"], -1) for r in rows]),
            "prediction": np.array([r["prediction"] for r in rows], dtype=float),
            "share": np.array([s[1] / sum(s) if len(s) == 2 and sum(s) > 0 else 0.0 for s in stats])})
    return out


def leaf_places(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The leaf of every row of a matrix."""
    at = np.zeros(len(x), dtype=int)
    while True:
        inner = tree["feature"][at] >= 0
        if not inner.any():
            return at
        rows = np.nonzero(inner)[0]
        node = at[rows]
        value = x[rows, tree["feature"][node]]
        category = np.clip(value, 0, tree["goes_left"].shape[1] - 1).astype(int)
        goes_left = np.where(tree["by_category"][node], tree["goes_left"][node, category], value <= tree["threshold"][node])
        at[rows] = np.where(goes_left, tree["left"][node], tree["right"][node])


def leaf_paths(tree: dict[str, np.ndarray]) -> list[tuple[float, dict[int, list[tuple[int, bool]]]]]:
    """(share, {feature: [(node, whether the way goes left)]}) of every leaf."""
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        feature = int(tree["feature"][node])
        if feature < 0:
            out.append((float(tree["share"][node]), path))
            continue
        for child, left in ((tree["left"][node], True), (tree["right"][node], False)):
            stack.append((int(child), path | {feature: [*path.get(feature, []), (node, left)]}))
    return out


def walked_by_leaf(trees: Sequence[dict[str, np.ndarray]]) -> bool:
    """Whether the leaves and the features on their ways are few enough for `leaf_walks`."""
    return all((t["feature"] < 0).sum() <= LEAVES for t in trees) and all(len(path) <= PATH_FEATURES for t in trees for _, path in leaf_paths(t))


def leaf_walks(trees: Sequence[dict[str, np.ndarray]], x: np.ndarray, background: np.ndarray, switched: np.ndarray) -> np.ndarray:
    """Mean over the background of the mean leaf share, for each row and step of `switched`, by leaf instead of by masked row.

    A masked row comes to a leaf if its row meets the leaf's conditions on the features that are switched on, and the background row
    those on the others; how many background rows do so is counted once for every set of features.
    """
    values = np.zeros(switched.shape[:2])
    for tree in trees:

        def met(rows: np.ndarray, path: dict[int, list[tuple[int, bool]]]) -> np.ndarray:
            bits = np.zeros(len(rows), dtype=np.int64)
            for bit, (feature, conditions) in enumerate(path.items()):
                fits, value = np.ones(len(rows), dtype=bool), rows[:, feature]
                for node, left in conditions:
                    if tree["by_category"][node]:
                        goes = tree["goes_left"][node, np.clip(value, 0, tree["goes_left"].shape[1] - 1).astype(int)]
                    else:
                        goes = value <= tree["threshold"][node]
                    fits &= goes == left
                bits |= fits.astype(np.int64) << bit
            return bits

        for share, path in leaf_paths(tree):
            if share == 0.0:
                continue
            sets = np.arange(1 << len(path))
            part = ((met(background, path)[None, :] & sets[:, None]) == sets[:, None]).mean(axis=1)
            on = np.zeros(switched.shape[:2], dtype=np.int64)
            for bit, feature in enumerate(path):
                on |= switched[:, :, feature].astype(np.int64) << bit
            values += np.where(on & ~met(x, path)[:, None], 0.0, share * part[sets[-1] ^ on])
    return values / len(trees)


def tree_scorer(trees: list[dict[str, np.ndarray]], weights: Sequence[float] | None = None, boosted: bool = False) -> Callable[[np.ndarray], np.ndarray]:
    """P(class 1) of a tree, a forest (mean of leaf shares) or boosted trees (logistic of twice the weighted sum)."""
    weights = list(weights) if weights is not None else [1.0] * len(trees)

    def score(x: np.ndarray) -> np.ndarray:
        if boosted:
            margin = sum(w * t["prediction"][leaf_places(t, x)] for w, t in zip(weights, trees))
            return 1.0 / (1.0 + np.exp(-2.0 * margin))
        return sum(t["share"][leaf_places(t, x)] for t in trees) / len(trees)

    if not boosted and walked_by_leaf(trees):
        score.trees = trees
    return score


def staged_scores(prepared: DataFrame, model, features: str = "features", label: str = "label") -> DataFrame:
    """(epoch, label, score) of every row after each round of boosting, from the saved trees. One pass over the rows for all rounds."""
    trees, weights = tree_tables(model), list(model.treeWeights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, margin = np.array([np.asarray(v, dtype=float) for v in pdf["x"]]).reshape(len(pdf), -1), np.zeros(len(pdf))
            for epoch, (weight, tree) in enumerate(zip(weights, trees), 1):
                margin = margin + weight * tree["prediction"][leaf_places(tree, x)]
                yield pd.DataFrame({"epoch": epoch, "label": pdf["label"], "score": 1.0 / (1.0 + np.exp(-2.0 * margin))})

    rows = prepared.select(col(label).cast("int").alias("label"), vector_to_array(col(features)).alias("x"))
    return rows.mapInPandas(run, "epoch int, label int, score double")


def scorer_of(model) -> Callable[[np.ndarray], np.ndarray]:
    """The numpy form of a fitted logistic, tree, forest or boosted model."""
    kind = model.__class__.__name__
    if kind == "LogisticRegressionModel":
        return linear_scorer(model.coefficients.toArray(), model.intercept)
    if kind == "GBTClassificationModel":
        return tree_scorer(tree_tables(model), model.treeWeights, boosted=True)
    if kind in ("RandomForestClassificationModel", "DecisionTreeClassificationModel"):
        return tree_scorer(tree_tables(model))
    raise ValueError(f"no task-side scorer for {kind}")


# ---- Shapley values ----------------------------------------------------------------------------------

def background_rows(df: DataFrame, n: int = 100, id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> DataFrame:
    """At most n rows in hash order."""
    return sample_rows(df, n, id_col, seed)


def background_matrix(prepared: DataFrame, n: int = 100, features: str = "features", id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> np.ndarray:
    rows = background_rows(prepared, n, id_col, seed).select(vector_to_array(col(features)).alias("x")).collect()
    return np.array([r["x"] for r in rows], dtype=float)


def shapley_walks(x: np.ndarray, background: np.ndarray, score: Callable[[np.ndarray], np.ndarray], orders: np.ndarray) -> np.ndarray:
    """Contributions of a few rows by one walk each: switch features from background to row in the row's order, then back.

    A feature is switched on from its step until its step on the way back, so a walk is 2p + 1 masks.
    """
    rows, p = x.shape
    step_of = np.empty_like(orders)
    np.put_along_axis(step_of, orders, np.arange(1, p + 1)[None, :].repeat(rows, axis=0), axis=1)
    if hasattr(score, "linear"):
        weights, intercept = score.linear
        terms = weights[orders][:, :, None] * (np.take_along_axis(x, orders, axis=1)[:, :, None] - background.T[orders])
        margins = np.empty((rows, 2 * p + 1, len(background)))
        margins[:, 0] = background @ weights + intercept
        np.cumsum(terms, axis=1, out=margins[:, 1:p + 1])
        margins[:, p + 1:] = margins[:, p:p + 1] - margins[:, 1:p + 1]
        margins[:, 1:] += margins[:, :1]
        values = (1.0 / (1.0 + np.exp(-margins))).mean(axis=2)
        gained, lost = np.diff(values[:, :p + 1], axis=1), -np.diff(values[:, p:], axis=1)
        return np.take_along_axis((gained + lost) / 2.0, step_of - 1, axis=1)
    steps = np.arange(2 * p + 1)[None, :, None]
    switched = (steps >= step_of[:, None, :]) & (steps < p + step_of[:, None, :])
    if hasattr(score, "trees"):
        values = leaf_walks(score.trees, x, background, switched)
    else:
        blocks = np.where(switched[:, :, None, :], x[:, None, None, :], background[None, None, :, :])
        values = score(blocks.reshape(-1, p)).reshape(rows, 2 * p + 1, len(background)).mean(axis=2)
    gained, lost = np.diff(values[:, :p + 1], axis=1), -np.diff(values[:, p:], axis=1)
    return np.take_along_axis((gained + lost) / 2.0, step_of - 1, axis=1)


def shapley_values(prepared: DataFrame, score: Callable[[np.ndarray], np.ndarray], background: np.ndarray, names: Sequence[str],
                   features: str = "features", id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> DataFrame:
    """(id, feature, value, shap) on P(class 1); base value plus the row's values is its score.

    Rows stay where they are. A task works through a few rows' masks at a time, so its memory depends
    on the number of features and the background (at most a hundred rows), not on the number of rows.
    """
    names = np.array(list(names), dtype=object)
    id_type = prepared.schema[id_col].dataType.simpleString()
    p = len(names)
    at_once = max(1, WALK_CELLS // ((2 * p + 1) * p * (1 if hasattr(score, "trees") else len(background))))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, x = pdf["id"].to_numpy(), np.array([np.asarray(v, dtype=float) for v in pdf["x"]]).reshape(-1, p)
            for at in range(0, len(ids), at_once):
                some, part = ids[at:at + at_once], x[at:at + at_once]
                orders = np.array([np.random.default_rng(zlib.crc32(f"{seed}|{i}".encode())).permutation(p) for i in some])
                shap = shapley_walks(part, background, score, orders)
                yield pd.DataFrame({"id": some.repeat(p), "feature": np.tile(names, len(some)), "value": part.ravel(), "shap": shap.ravel()})

    rows = prepared.select(col(id_col).alias("id"), vector_to_array(col(features)).alias("x"))
    return rows.mapInPandas(explain, f"id {id_type}, feature string, value double, shap double")


def shapley_by_transform(prepared: DataFrame, score: Callable[[DataFrame], DataFrame], background: np.ndarray, names: Sequence[str], features: str = "features",
                         id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> tuple[DataFrame, float]:
    """I5 for a model that only scores tables: the same walks as `shapley_values`, as a table of masked rows; `score` adds a score column to a table with the features.

    A masked row is a row's features switched on over one background row, at one step of its walk; scores are averaged over the background
    by an aggregate and the steps of a row meet in one group of 2p + 1 numbers. Rows are taken in chunks by a hash of their id, so that at most
    MASKED rows or so exist at a time, and each chunk's result is written. Ids must be unique. Returns the values and the mean score of the background.
    """
    names, p, spark = np.array(list(names), dtype=object), len(names), prepared.sparkSession
    id_type = prepared.schema[id_col].dataType.simpleString()
    rows = prepared.select(col(id_col).alias("id"), vector_to_array(col(features)).alias("x"))

    def order_of(i) -> np.ndarray:
        return np.random.default_rng(zlib.crc32(f"{seed}|{i}".encode())).permutation(p)

    def masked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = np.arange(2 * p + 1)[:, None]
        for pdf in batches:
            for i, x in zip(pdf["id"], pdf["x"]):
                step_of = np.empty(p, dtype=int)
                step_of[order_of(i)] = np.arange(1, p + 1)
                switched = (steps >= step_of) & (steps < p + step_of)
                blocks = np.where(switched[:, None, :], np.asarray(x, dtype=float), background).reshape(-1, p)
                yield pd.DataFrame({"id": [i] * len(blocks), "step": np.repeat(np.arange(2 * p + 1), len(background)), "x": list(blocks)})

    def scored(table: DataFrame) -> DataFrame:
        return score(table.select("id", "step", array_to_vector("x").alias(features))).groupBy("id", "step").agg(F.avg("score").alias("score"))

    def differences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, x, values in zip(pdf["id"], pdf["x"], pdf["scores"]):
                v, step_of = np.asarray(values, dtype=float), np.empty(p, dtype=int)
                step_of[order_of(i)] = np.arange(1, p + 1)
                gained, lost = np.diff(v[:p + 1]), -np.diff(v[p:])
                yield pd.DataFrame({"id": [i] * p, "feature": names, "value": np.asarray(x, dtype=float), "shap": ((gained + lost) / 2.0)[step_of - 1]})

    chunks = max(1, -(-rows.count() * (2 * p + 1) * len(background) // MASKED))
    out = None
    for chunk in range(chunks):
        own = rows.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == chunk)
        steps = scored(own.mapInPandas(masked, f"id {id_type}, step int, x array<double>"))
        walks = steps.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "score"))), lambda s: s["score"]).alias("scores"))
        found = own.join(walks, "id").mapInPandas(differences, f"id {id_type}, feature string, value double, shap double")
        found = written(found, "shapley-chunk")
        out = found if out is None else out.unionByName(found)
    base_rows = spark.createDataFrame([(i, 0, b.tolist()) for i, b in enumerate(background)], "id bigint, step int, x array<double>")
    return out, float(scored(base_rows).agg(F.avg("score")).first()[0])


def base_value(score: Callable[[np.ndarray], np.ndarray], background: np.ndarray) -> float:
    """Mean score of the background."""
    return float(score(background).mean())


def linear_shapley(prepared: DataFrame, coefficients: Sequence[float], background_means: Sequence[float], names: Sequence[str],
                   features: str = "features", id_col: str = words.ID_COLUMN) -> DataFrame:
    """Exact contributions to the log-odds of a linear model: coefficient times distance from the background mean."""
    x = vector_to_array(col(features)) if not isinstance(prepared.schema[features].dataType, T.ArrayType) else col(features)
    cells = [F.struct(F.lit(n).alias("feature"), F.col("__x")[i].alias("value"),
                      (F.lit(float(c)) * (F.col("__x")[i] - F.lit(float(b)))).alias("shap"))
             for i, (n, c, b) in enumerate(zip(names, coefficients, background_means))]
    return prepared.select(col(id_col).alias("id"), x.alias("__x")).select("id", F.explode(F.array(*cells)).alias("c")).select("id", "c.*")


def global_importance(shap: DataFrame) -> DataFrame:
    """I8: mean absolute contribution per feature, largest first."""
    return shap.groupBy("feature").agg(F.avg(F.abs("shap")).alias("shap_medio_abs")).orderBy(F.desc("shap_medio_abs"), "feature")


def single_case(shap: DataFrame, case_id, base: float, shown: int = 12) -> DataFrame:
    """One row's contributions from the base value up to its score; features beyond `shown` are pooled in the last place.

    Place 1 is the largest contribution and ends at the score; the last place starts at the base value.
    """
    row = shap.where(F.col("id") == F.lit(case_id))
    size = Window.orderBy(F.abs("shap").desc(), "feature")
    whole = Window.partitionBy()
    kept = F.when(F.count(F.lit(1)).over(whole) > shown, F.lit(shown - 1)).otherwise(F.lit(shown))
    placed = row.select("feature", "value", "shap", F.row_number().over(size).alias("place"), kept.alias("kept"))
    pooled = placed.withColumn("place", F.least("place", F.col("kept") + 1)).groupBy("place").agg(
        F.when(F.count(F.lit(1)) == 1, F.first("feature")).otherwise(F.concat(F.count(F.lit(1)).cast("string"), F.lit(" other features"))).alias("feature"),
        F.when(F.count(F.lit(1)) == 1, F.first("value")).alias("value"), F.sum("shap").alias("shap"))
    upto = F.sum("shap").over(Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0))
    return pooled.select("place", "feature", "value", "shap", (F.lit(float(base)) + upto - F.col("shap")).alias("start"),
                         (F.lit(float(base)) + upto).alias("end")).orderBy("place")


def beeswarm(shap: DataFrame, top: int = 15) -> DataFrame:
    """Every row's (value, contribution) for the features of highest importance."""
    leaders = global_importance(shap).limit(top)
    return shap.join(F.broadcast(leaders.select("feature")), "feature").select("feature", "id", "value", "shap")


def representative_cases(scores: DataFrame, threshold: float, by: Sequence[str] = ("model",), id_col: str = words.ID_COLUMN) -> DataFrame:
    """Worst miss, worst false alarm, surest hit and the case closest to the threshold, in one pass; ties to the first id."""
    i, s = col(id_col), F.col("score")
    alarm, positive = s >= F.lit(float(threshold)), F.col("label") == 1
    low, high, near = F.struct(s, i), F.struct(-s, i), F.struct(F.abs(s - F.lit(float(threshold))), i)
    chosen = [(~alarm & positive, low), (alarm & ~positive, high), (alarm & positive, high), (F.lit(True), near)]
    picks = [F.min_by(F.struct(i.alias("id"), s.alias("score")), F.when(cond, key)).alias(f"__p{k}") for k, (cond, key) in enumerate(chosen)]
    row = scores.groupBy(*by).agg(*picks)
    cells = [F.struct(F.lit(n).alias("case"), F.col(f"__p{k}").alias("pick")) for k, n in enumerate(words.CASE_NAMES)]
    return row.select(*by, F.explode(F.array(*cells)).alias("c")).where("c.pick IS NOT NULL").select(
        *by, "c.case", "c.pick.id", "c.pick.score")
