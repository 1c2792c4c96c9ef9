"""Cross-validated search, selection, calibration and final evaluation."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import col
from farol.functions.running import balanced_edges
from farol.functions.storage import written
from farol.operators.metrics import compute_metrics, packed_metrics
from farol.operators.newton import Setting, fit_many, score_many
from farol.operators.prep import Preprocessor, feature_names_out, inject_missing
from farol.operators.split import learning_shares, learning_subsets, stratified_folds, train_and_validation
from farol.plans.catalog import FAMILIES, Family, class_counts, class_weights, packed, with_score

CV_METRICS = ("roc_auc", "pr_auc", "recall", "precision", "f1", "accuracy")


@dataclass
class Scorer:
    """M9: preprocessing and model as one object; adds `score` and keeps the columns of its input."""

    prep: PipelineModel
    model: Model

    def score(self, df: DataFrame) -> DataFrame:
        scored = with_score(self.model.transform(self.prep.transform(df)))
        return scored.select(*[col(c) for c in df.columns], "score")

    def names(self) -> list[str]:
        return feature_names_out(self.prep)


@dataclass(frozen=True)
class Roles:
    numeric: Sequence[str]
    categorical: Sequence[str] = ()

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def prep(self, scaler: str) -> Preprocessor:
        return Preprocessor(numericCols=list(self.numeric), categoricalCols=list(self.categorical), scaler=scaler)


def fit_scorer(df: DataFrame, roles: Roles, family: Family, params: Mapping, seed: int = words.SEED, prep: PipelineModel | None = None) -> Scorer:
    """Fit preprocessing and model on the same rows. `df` has id, label and the features."""
    prep = prep or roles.prep(family.scaler).fit(df)
    counts = class_counts(df)
    rows = packed(prep.transform(df).select("id", "label", "features"), sum(counts.values()))
    return Scorer(prep, family.fit(rows, params, counts, seed))


def part_metrics(scored: DataFrame, part: str = "part", edges: Sequence[float] | None = None) -> dict[str, dict]:
    """The six cross-validation metrics per part, at threshold 0.5."""
    rows = compute_metrics(scored.select(part, "label", "score"), by=[part], edges=edges).collect()
    return {r[part]: {m: r[m] for m in CV_METRICS} for r in rows}


def stacked_designs(train: DataFrame, roles: Roles, scaler: str, folds: Sequence, preps: Mapping, fold: str = "fold") -> DataFrame:
    """(fold, label, one array per fold): the features as each fold's preprocessing makes them, written once for all passes."""
    table = train.select("label", F.col(fold).alias("__fold"), *[col(c) for c in roles.features])
    for i, f in enumerate(folds):
        table = preps[(scaler, f)].transform(table).withColumn(f"__x{i}", vector_to_array("features")).drop("features")
    designs = [f"__x{i}" for i in range(len(folds))]
    return written(table.select(F.col("__fold").cast("int").alias("fold"), F.col("label").cast("int").alias("label"), *designs), "designs")


def logistic_search(train: DataFrame, roles: Roles, family: Family, folds: Sequence, preps: Mapping, fold: str = "fold") -> dict[tuple, dict]:
    """M10 for logistic regression: (candidate, fold, part) -> metrics. All candidates and folds take each Newton step in one job,
    and one more job scores and measures them."""
    rows = stacked_designs(train, roles, family.scaler, folds, preps, fold)
    counts: dict = {f: {} for f in folds}
    for r in rows.groupBy("fold", "label").count().collect():
        for f in folds:
            if r["fold"] != f:
                counts[f][r["label"]] = counts[f].get(r["label"], 0) + r["count"]
    settings, names = [], []
    for i, params in enumerate(family.candidates()):
        for f in folds:
            weights = class_weights(counts[f]) if params.get("class_weight") == "balanced" else {}
            settings.append(Setting(int(f), params.get("C", 1.0), (weights.get(0, 1.0), weights.get(1, 1.0))))
            names.append((i, f))
    fitted, _ = fit_many(rows, [int(f) for f in folds], settings)
    edges = balanced_edges(score_many(rows, [int(f) for f in folds], settings[:1], fitted[:1]), "score")
    scored = score_many(rows, [int(f) for f in folds], settings, fitted)
    found = packed_metrics(scored, ["model", "part"], edges).collect()
    return {(*names[r["model"]], r["part"]): {m: r[m] for m in CV_METRICS} for r in found}


def cross_validate(train: DataFrame, roles: Roles, family: Family, fold: str = "fold", seed: int = words.SEED, parallelism: int = 4,
                   preps: dict | None = None) -> tuple[DataFrame, float]:
    """(family, candidate, params, fold, part, metrics...) for every candidate and fold, and the seconds taken.

    Preprocessing is fit once per fold on that fold's training rows and shared by all candidates, as
    its result does not depend on them. Logistic regressions learn all at once, see `logistic_search`; the other fits run
    from a few driver threads, each a distributed job. Range edges are sketched on the scores of the first fit and kept: they only spread the work.
    """
    spark = train.sparkSession
    started = time.perf_counter()
    folds = sorted(r[0] for r in train.select(fold).distinct().collect())
    preps = {} if preps is None else preps
    for f in folds:
        if (family.scaler, f) not in preps:
            preps[(family.scaler, f)] = roles.prep(family.scaler).fit(train.where(F.col(fold) != f))
    candidates = family.candidates()
    schema = "family string, candidate int, params string, fold int, part string, " + ", ".join(f"{m} double" for m in CV_METRICS)
    if family.key == "logistic_regression":
        rows = [(family.key, i, json.dumps(candidates[i], sort_keys=True), int(f), part, *[m[c] for c in CV_METRICS])
                for (i, f, part), m in logistic_search(train, roles, family, folds, preps, fold).items()]
        return spark.createDataFrame(rows, schema), time.perf_counter() - started

    kept: dict[str, list[float]] = {}

    def run(task: tuple[int, object]) -> list[tuple]:
        index, f = task
        scorer = fit_scorer(train.where(F.col(fold) != f), roles, family, candidates[index], seed, preps[(family.scaler, f)])
        part = F.when(F.col(fold) == f, "cv").otherwise("train")
        scored = scorer.score(train).withColumn("part", part)
        if "edges" not in kept:
            kept["edges"] = balanced_edges(scored, "score")
        metrics = part_metrics(scored, edges=kept["edges"])
        return [(family.key, index, json.dumps(candidates[index], sort_keys=True), int(f), p, *[m[c] for c in CV_METRICS])
                for p, m in metrics.items()]

    tasks = [(i, f) for i in range(len(candidates)) for f in folds]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        rows = [r for rs in pool.map(inheritable_thread_target(spark)(run), tasks) for r in rs]
    return spark.createDataFrame(rows, schema), time.perf_counter() - started


def candidate_summary(fold_metrics: DataFrame, keys: Sequence[str] = ("family", "candidate", "params")) -> DataFrame:
    """Mean of every metric over folds, population deviation of the AUC, and training AUC minus CV AUC."""
    held, seen = F.col("part") == "cv", F.col("part") == "train"
    return fold_metrics.groupBy(*keys).agg(
        *[F.avg(F.when(held, F.col(m))).alias(m) for m in CV_METRICS], F.stddev_pop(F.when(held, F.col("roc_auc"))).alias("roc_auc_std"),
        (F.avg(F.when(seen, F.col("roc_auc"))) - F.avg(F.when(held, F.col("roc_auc")))).alias("overfit_gap_roc_auc"))


def best_candidates(summary: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The candidate of highest mean per family; the first one wins a tie."""
    row = F.struct(*[col(c) for c in summary.columns if c != "family"])
    return summary.groupBy("family").agg(F.max_by(row, F.struct(col(metric), -F.col("candidate"))).alias("b")).select("family", "b.*")


def cv_table(best: DataFrame) -> DataFrame:
    """Four decimals, best family first."""
    shown = [*CV_METRICS, "roc_auc_std", "overfit_gap_roc_auc"]
    rounded = [F.round(c, 4).alias(c) if c in shown else col(c) for c in best.columns]
    return best.select(*rounded).orderBy(F.desc("roc_auc"), "family")


def selection_ranking(best: DataFrame, validation: DataFrame) -> DataFrame:
    """Families by the mean of cross-validated and validation AUC; `validation` has (family, roc_auc, recall)."""
    v = validation.select("family", F.col("roc_auc").alias("v_auc"), F.col("recall").alias("v_recall"))
    return best.join(v, "family").select(
        F.col("family").alias("chave"), F.round("roc_auc", 4).alias("roc_auc_cv_treino"), F.round("roc_auc_std", 4).alias("desvio_cv"),
        F.round("v_auc", 4).alias("roc_auc_validacao"), F.round("v_recall", 4).alias("recall_validacao"),
        F.round(0.5 * F.col("roc_auc") + 0.5 * F.col("v_auc"), 5).alias("score_selecao")).orderBy(F.desc("score_selecao"), "chave")


@dataclass
class Trained:
    family: Family
    params: dict
    scorer: Scorer
    summary: DataFrame
    seconds: float
    fold_metrics: DataFrame = field(repr=False)


def train_family(train: DataFrame, roles: Roles, family: Family, seed: int = words.SEED, parallelism: int = 4, preps: dict | None = None,
                 whole_prep: PipelineModel | None = None) -> Trained:
    """Search, pick by AUC, refit on all training rows."""
    metrics, seconds = cross_validate(train, roles, family, seed=seed, parallelism=parallelism, preps=preps)
    best = best_candidates(candidate_summary(metrics))
    params = json.loads(best.first()["params"])
    return Trained(family, params, fit_scorer(train, roles, family, params, seed, whole_prep), best, seconds, metrics)


def train_all(train: DataFrame, roles: Roles, families: Sequence[Family] = FAMILIES, k: int = words.FOLDS, seed: int = words.SEED,
              quick: bool = False, parallelism: int = 4) -> dict[str, Trained]:
    """Every family on the same folds. `train` has id, label and features; it is written once with its folds."""
    folded = written(stratified_folds(train.select("id", "label", *[col(c) for c in roles.features]), "label", k=k, seed=seed), "folds")
    preps: dict = {}
    whole = {s: roles.prep(s).fit(folded) for s in {f.scaler for f in families}}
    return {f.key: train_family(folded, roles, f.quick() if quick else f, seed, parallelism, preps, whole[f.scaler]) for f in families}


def score_table(scorers: Mapping[str, Scorer], df: DataFrame) -> DataFrame:
    """(model, id, label, score) of several models on the same rows."""
    out = None
    for name, scorer in scorers.items():
        part = scorer.score(df).select(F.lit(name).alias("model"), "id", "label", "score")
        out = part if out is None else out.unionByName(part)
    return out


def learning_curve(df: DataFrame, roles: Roles, family: Family, params: Mapping, k: int = words.FOLDS, seed: int = words.SEED,
                   shares: Sequence[float] | None = None, parallelism: int = 4) -> DataFrame:
    """AUC mean and population deviation over folds, on the training subset and on the held-out fold, per subset size."""
    spark = df.sparkSession
    shares = list(shares or learning_shares())
    folded = written(stratified_folds(df.select("id", "label", *[col(c) for c in roles.features]), "label", k=k, seed=seed), "folds")
    subsets = written(learning_subsets(folded, seed=seed, shares=shares), "subsets")
    kept: dict[str, list[float]] = {}

    def run(task: tuple[int, int]) -> list[tuple]:
        step, f = task
        subset = subsets.where((F.col("held_out") == f) & (F.col("step") <= step))
        held = folded.where(F.col("fold") == f)
        scorer = fit_scorer(subset, roles, family, params, seed)
        both = subset.select("id", "label", *roles.features, F.lit("train").alias("part")).unionByName(
            held.select("id", "label", *roles.features, F.lit("cv").alias("part")))
        scored = scorer.score(both).select("part", "label", "score")
        if "edges" not in kept:  # of the first fit: they only spread the work
            kept["edges"] = balanced_edges(scored, "score")
        aucs = compute_metrics(scored, by=["part"], edges=kept["edges"]).select("part", "roc_auc", "n").collect()
        size = sum(r["n"] for r in aucs if r["part"] == "train")
        return [(step, size, f, r["part"], r["roc_auc"]) for r in aucs]

    tasks = [(s, f) for s in range(len(shares)) for f in range(k)]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        rows = [r for rs in pool.map(inheritable_thread_target(spark)(run), tasks) for r in rs]
    scores = spark.createDataFrame(rows, "step int, size bigint, fold int, part string, roc_auc double")
    return scores.groupBy("step", "part").agg(F.max("size").alias("size"), F.avg("roc_auc").alias("roc_auc_mean"),
                                              F.stddev_pop("roc_auc").alias("roc_auc_std")).orderBy("step", "part")


def missing_robustness(scorer: Scorer, test: DataFrame, roles: Roles, threshold: float, fractions: Sequence[float] = (0.0, 0.05, 0.10, 0.20),
                       seed: int = words.SEED) -> DataFrame:
    """Metrics at the frozen threshold with a growing share of empty cells. All variants are scored in one pass, with the rows' own ids."""
    variants = None
    for f in fractions:
        part = inject_missing(test.select("id", "label", *[col(c) for c in roles.features]), roles.features, f, salt=f"mcar{seed}")
        part = part.withColumn("fraction", F.lit(float(f)))
        variants = part if variants is None else variants.unionByName(part)
    metrics = compute_metrics(scorer.score(variants).select("fraction", "label", "score"), [threshold], by=["fraction"])
    return metrics.select(
        F.concat(F.round(F.col("fraction") * 100).cast("int").cast("string"), F.lit("%")).alias("pct_celulas_ausentes"),
        F.round("recall", 4).alias("recall"), F.round("precision", 4).alias("precisao"), F.round("f1", 4).alias("f1"),
        F.round("roc_auc", 4).alias("roc_auc"), F.col("fn").alias("falsos_negativos")).orderBy(F.col("fraction"))


def refit(parts: DataFrame, roles: Roles, trained: Trained, seed: int = words.SEED) -> Scorer:
    """The chosen family and parameters on train and validation together."""
    return fit_scorer(train_and_validation(parts), roles, trained.family, trained.params, seed)


def reference_logistic(parts: DataFrame, roles: Roles, seed: int = words.SEED) -> Scorer:
    """A logistic regression with C = 1, whatever model was chosen."""
    family = next(f for f in FAMILIES if f.key == "logistic_regression")
    return fit_scorer(train_and_validation(parts), roles, family, {"C": 1.0, "class_weight": None}, seed)
