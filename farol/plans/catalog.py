"""The six model families, their parameter grids, and how each is fit on prepared rows.

Prepared rows have `id`, `label` (0/1) and a vector column `features`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from itertools import product

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.functions.storage import written
from farol.operators.fourier import FourierFeatures
from farol.operators.machines import Machine, MachineMargin, blocks, fit_machines, fold_sums, held_margins
from farol.operators.neighbors import nearest_neighbours, neighbour_scores
from farol.operators.split import stratified_folds

MAX_BINS = 128
DEEPEST = 30
CALIBRATION_FOLDS = 5
ROWS_PER_TASK = 20_000


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def class_weights(counts: Mapping[int, int]) -> dict[int, float]:
    """M8: n / (classes x rows of the class)."""
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """M8 as a table: class, rows and weight."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.select("class", "n", (total / (classes * F.col("n"))).alias("weight"))


def packed(df: DataFrame, rows: int) -> DataFrame:
    """No more partitions than there are blocks of rows: an iterative fit pays for every task in every step.

    `coalesce` never adds partitions, so a large table keeps its own.
    """
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def with_weights(df: DataFrame, counts: Mapping[int, int], balanced: bool) -> DataFrame:
    if not balanced:
        return df.withColumn("weight", F.lit(1.0))
    weight = F.lit(1.0)
    for c, w in class_weights(counts).items():
        weight = F.when(F.col("label") == c, F.lit(w)).otherwise(weight)
    return df.withColumn("weight", weight)


class NeighboursModel(Model):
    """M3: keeps the prepared training rows as a table; scoring is the nearest-neighbour join.

    Each distinct vector is looked up once and its score joined back by the vector, so the rows' ids are not used and may repeat.
    """

    def __init__(self, reference: DataFrame, k: int, weights: str, p: int):
        super().__init__()
        self.reference, self.k, self.weights, self.p = reference, k, weights, p

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keyed = dataset.withColumn("__x", vector_to_array("features"))
        vectors = keyed.select(F.col("__x").alias("x")).distinct().withColumn("id", F.monotonically_increasing_id())
        queries = written(vectors, "vectors")  # the numbers must not change when a task runs again
        scored = neighbour_scores(nearest_neighbours(queries, self.reference, self.k, self.p), self.weights)
        return keyed.join(queries.join(scored, "id").select(F.col("x").alias("__x"), "score"), "__x").drop("__x")


def fit_logistic(df: DataFrame, params: Mapping, counts: Mapping[int, int], seed: int) -> Model:
    """M1: the weights sum to the number of rows, so an inverse strength C over summed losses is 1 / (C n) over mean losses."""
    regularisation = 1.0 / (params.get("C", 1.0) * sum(counts.values()))
    return LogisticRegression(regParam=regularisation, elasticNetParam=0.0, standardization=False, weightCol="weight", maxIter=500,
                              tol=1e-7).fit(with_weights(df, counts, params.get("class_weight") == "balanced"))


def fit_tree(df: DataFrame, params: Mapping, counts: Mapping[int, int], seed: int) -> Model:
    """M2: splits are searched over binned values."""
    return DecisionTreeClassifier(maxDepth=params.get("max_depth") or DEEPEST, minInstancesPerNode=params.get("min_samples_leaf", 1),
                                  impurity=params.get("criterion", "gini"), weightCol="weight", maxBins=MAX_BINS, seed=seed,
                                  maxMemoryInMB=512).fit(with_weights(df, counts, params.get("class_weight") == "balanced"))


def fit_neighbours(df: DataFrame, params: Mapping, counts: Mapping[int, int], seed: int) -> Model:
    reference = df.select("id", vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"))
    return NeighboursModel(reference, params.get("n_neighbors", 5), params.get("weights", "uniform"), params.get("p", 2))


def fit_forest(df: DataFrame, params: Mapping, counts: Mapping[int, int], seed: int) -> Model:
    """M4."""
    return RandomForestClassifier(numTrees=params.get("n_estimators", 100), maxDepth=params.get("max_depth") or DEEPEST,
                                  minInstancesPerNode=params.get("min_samples_leaf", 1), featureSubsetStrategy=str(params.get("max_features", "sqrt")),
                                  weightCol="weight", maxBins=MAX_BINS, seed=seed, maxMemoryInMB=512).fit(
        with_weights(df, counts, params.get("class_weight") == "balanced"))


def fit_boosting(df: DataFrame, params: Mapping, counts: Mapping[int, int], seed: int) -> Model:
    """M5."""
    return GBTClassifier(maxIter=params.get("n_estimators", 100), stepSize=params.get("learning_rate", 0.1), maxDepth=params.get("max_depth", 3),
                         subsamplingRate=params.get("subsample", 1.0), maxBins=MAX_BINS, seed=seed, maxMemoryInMB=512).fit(df)


def scale_gamma(df: DataFrame) -> float:
    """1 / (features x variance of all cells), from per-column means and squared norms in one pass."""
    row = df.select(Summarizer.metrics("mean", "normL2", "count").summary(F.col("features")).alias("s")).first()["s"]
    means, squares = row["mean"].toArray(), row["normL2"].toArray() ** 2 / row["count"]
    variance = squares.mean() - means.mean() ** 2
    return float(1.0 / (len(means) * variance)) if variance > 0 else 1.0


def fourier_features(df: DataFrame, params: Mapping, seed: int) -> FourierFeatures:
    """M6: the feature map for the kernel width of the parameters; `scale` is measured on the rows."""
    gamma = params.get("gamma", "scale")
    gamma = scale_gamma(df) if gamma == "scale" else float(gamma)
    return FourierFeatures(inputCol="features", outputCol="fourier", gamma=gamma, inputSize=len(df.select("features").first()[0]), seed=seed)


def platt_rows(margins: DataFrame, counts: Mapping[int, int]) -> DataFrame:
    """M7: every case twice, as positive and negative, weighted with Platt's smoothed targets."""
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    target = F.when(F.col("label") == 1, F.lit((n_pos + 1.0) / (n_pos + 2.0))).otherwise(F.lit(1.0 / (n_neg + 2.0)))
    both = F.explode(F.array(F.struct(F.lit(1).alias("label"), target.alias("weight")), F.struct(F.lit(0).alias("label"), (1.0 - target).alias("weight"))))
    return margins.select("margin", both.alias("t")).select("margin", "t.label", "t.weight")


def svm_weights(sums, left_out: int, balanced: bool) -> tuple[float, float]:
    """The weights of class 0 and 1 in a machine that leaves a fold out, from rows by fold and class."""
    n = sum(sums[f, :, 0] for f in range(len(sums)) if f != left_out)
    weights = class_weights({c: n[c] for c in (0, 1) if n[c]}) if balanced else {}
    return weights.get(0, 1.0), weights.get(1, 1.0)


def fit_svm(df: DataFrame, params: Mapping, counts: Mapping[int, int], seed: int) -> PipelineModel:
    """M6 and M7: margins of rows held out in five folds calibrate one final machine; all six are linear ones on Fourier features and learn together.

    An inverse strength C over summed losses is 1 / (C n) over mean losses.
    """
    df = written(df, "prepared")
    fourier = fourier_features(df, params, seed)
    table = blocks(stratified_folds(df, "label", k=CALIBRATION_FOLDS, seed=seed, name="inner_fold"), "inner_fold")
    sums = fold_sums(table, fourier, CALIBRATION_FOLDS)
    rows = sums[:, :, 0].sum(axis=1)
    balanced = params.get("class_weight") == "balanced"
    machines = [Machine(f, 1.0 / (params.get("C", 1.0) * float(rows.sum() - (rows[f] if f >= 0 else 0))), svm_weights(sums, f, balanced))
                for f in (*range(CALIBRATION_FOLDS), -1)]
    (*held, (coefficients, intercept)), _ = fit_machines(table, fourier, machines, sums)
    margins = written(held_margins(table, fourier, dict(enumerate(held))), "margins")
    platt = LogisticRegression(featuresCol="margin", weightCol="weight", regParam=0.0, standardization=False, maxIter=200)
    calibrated = platt.fit(packed(platt_rows(margins, counts), sum(counts.values())))
    final = MachineMargin(inputCol="features", outputCol="margin", gamma=fourier.getOrDefault(fourier.gamma), inputSize=fourier.getOrDefault(fourier.inputSize),
                          seed=seed, coefficients=[float(c) for c in coefficients], intercept=float(intercept))
    return PipelineModel([final, calibrated])


@dataclass(frozen=True)
class Family:
    """A model family: how to fit it, the parameters to try, and the scaling its features need."""

    key: str
    label: str
    fit: Callable[[DataFrame, Mapping, Mapping[int, int], int], Model]
    grid: Mapping[str, list]
    scaler: str = "standard"

    def candidates(self) -> list[dict]:
        """All combinations, the last parameter varying fastest."""
        names = sorted(self.grid)
        return [dict(zip(names, values)) for values in product(*[self.grid[n] for n in names])]

    def quick(self) -> Family:
        """Only the first value of every parameter."""
        return replace(self, grid={k: v[:1] for k, v in self.grid.items()})


# Keys, names and parameter grids of the families.
FAMILIES = (
    Family("logistic_regression", "Regressao Logistica", fit_logistic, {
        "C": [0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 10.0, 100.0], "class_weight": [None, "balanced"]}),
    Family("decision_tree", "Arvore de Decisao", fit_tree, {
        "max_depth": [3, 4, 5, 7, None], "min_samples_leaf": [1, 3, 5, 10], "criterion": ["gini", "entropy"],
        "class_weight": [None, "balanced"]}),
    Family("knn", "KNN (k-vizinhos mais proximos)", fit_neighbours, {
        "n_neighbors": [3, 5, 7, 9, 11, 15], "weights": ["uniform", "distance"], "p": [1, 2]}),
    Family("random_forest", "Random Forest", fit_forest, {
        "n_estimators": [300, 600], "max_depth": [None, 6, 10], "min_samples_leaf": [1, 2, 4], "max_features": ["sqrt", 0.5],
        "class_weight": [None, "balanced"]}),
    Family("gradient_boosting", "Gradient Boosting", fit_boosting, {
        "n_estimators": [150, 300], "learning_rate": [0.05, 0.1], "max_depth": [2, 3], "subsample": [0.8, 1.0]}),
    Family("svm_rbf", "SVM (kernel RBF)", fit_svm, {
        "C": [0.1, 1.0, 10.0, 100.0], "gamma": ["scale", 0.01, 0.1], "class_weight": [None, "balanced"]}),
)


def family(key: str) -> Family:
    return next(f for f in FAMILIES if f.key == key)


def sigmoid(margin: Column) -> Column:
    """M15 for models without probabilities."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def with_score(scored: DataFrame) -> DataFrame:
    """`score` as the probability of class 1, or the logistic of the margin where there is no probability."""
    if "score" in scored.columns:
        return scored
    if "probability" in scored.columns:
        return scored.withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("score", sigmoid(vector_to_array("rawPrediction")[1]))
