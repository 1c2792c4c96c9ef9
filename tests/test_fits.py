"""Newton fits of many models at once and exact tree splits against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farol.operators.exact_tree import fit_exact_tree
from farol.operators.newton import Setting, fit_many, score_many
from farol.operators.split import stratified_folds
from farol.plans import catalog as K
from farol.plans import training as P


def newton(x, y, c, weights=(1.0, 1.0)):
    """One model, until nothing moves."""
    x, b = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    held = np.append(np.full(len(b) - 1, 1 / c if c else 0.0), 0.0)
    w = np.where(y > 0, weights[1], weights[0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ b))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(held), x.T @ (w * (p - y)) + held * b)
        b = b - (step if np.abs(step).max() < 1 else step / np.abs(step).max())
    return b


def rows_of(rng, n=900, folds=3, p=5):
    x = rng.standard_normal((n, p)) * rng.uniform(0.5, 3, p)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ rng.standard_normal(p) + 0.4)))).astype(int)
    return x, y, np.arange(n) % folds


def table(spark, x, y, fold, folds):
    """Fold i's preprocessing shifts the features by i."""
    rows = [(int(f), int(b), *[(a + i).tolist() for i in range(folds)]) for a, b, f in zip(x, y, fold)]
    return spark.createDataFrame(rows, "fold int, label int, " + ", ".join(f"x{i} array<double>" for i in range(folds))).repartition(5)


def test_all_models_at_once_are_the_single_ones(spark):
    x, y, fold = rows_of(np.random.default_rng(1))
    df = table(spark, x, y, fold, 3)
    settings = [Setting(f, c, w) for c in (0.01, 1.0, 100.0, None) for w in ((1.0, 1.0), (0.7, 1.6)) for f in range(3)]
    fitted, jobs = fit_many(df, [0, 1, 2], settings)
    assert jobs <= 15
    for s, b in zip(settings, fitted):
        assert np.allclose(b, newton(x[fold != s.fold] + s.fold, y[fold != s.fold], s.c, s.weights), atol=1e-7)
    alone = [fit_many(df, [0, 1, 2], [s])[0][0] for s in settings[:2]]
    assert np.allclose(alone, fitted[:2], atol=1e-7)
    scored = score_many(df, [0, 1, 2], settings[:2], fitted[:2]).toPandas()
    assert len(scored) == 2 * len(x) and (scored[scored.part == "cv"].groupby("model").size() == 300).all()


def test_separable_rows_settle_with_a_penalty(spark):
    x = np.r_[np.random.default_rng(2).normal(-4, 0.5, (200, 2)), np.random.default_rng(3).normal(4, 0.5, (200, 2))]
    y = np.repeat([0, 1], 200)
    (b,), jobs = fit_many(table(spark, x, y, np.arange(400) % 2, 1).withColumn("fold", F.lit(-1)), [0], [Setting(0, 1000.0)])
    assert jobs < 60 and np.isfinite(b).all()
    held = np.append(b[:2], 0) / 1000.0
    full = np.hstack([x, np.ones((400, 1))])
    assert np.abs(full.T @ (1 / (1 + np.exp(-full @ b)) - y) + held).max() < 1e-6


def test_search_of_all_logistic_candidates(spark):
    """Every candidate and fold of the whole grid, in as many jobs as steps, with the metrics of fits one by one."""
    x, y, _ = rows_of(np.random.default_rng(4), 400)
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(5)]).assign(id=range(400), label=y, kind=np.where(x[:, 0] > 0, "a", "b"))
    pdf.loc[::17, "f1"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("f1", F.nanvl("f1", F.lit(None).cast("double")))
    roles = P.Roles([f"f{i}" for i in range(5)], ["kind"])
    folded = stratified_folds(df, "label", k=3)
    logistic = K.family("logistic_regression")
    metrics, _ = P.cross_validate(folded, roles, logistic)
    rows = {(r["candidate"], r["fold"], r["part"]): r for r in metrics.collect()}
    assert len(rows) == 16 * 3 * 2
    params = logistic.candidates()
    for i in (0, 9, 13):
        scorer = P.fit_scorer(folded.where("fold <> 1"), roles, logistic, params[i])
        alone = P.part_metrics(scorer.score(folded.where("fold = 1")).withColumn("part", F.lit("cv")))["cv"]
        assert alone["roc_auc"] == pytest.approx(rows[i, 1, "cv"]["roc_auc"], abs=2e-3)


def plain_tree(x, y, depth, min_leaf, node=1):
    """Best border by gain, then feature, then threshold; {node: (feature, threshold, gain, n)}."""
    gini = lambda v: 1 - v.mean() ** 2 - (1 - v.mean()) ** 2
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k][~np.isnan(x[:, k])])
        known = ~np.isnan(x[:, k])
        for t in (values[1:] + values[:-1]) / 2:
            left = y[known & (x[:, k] <= t)]
            right = y[known & (x[:, k] > t)]
            if min(len(left), len(right)) >= min_leaf:
                gain = round(gini(y[known]) - (len(left) * gini(left) + len(right) * gini(right)) / known.sum(), 9)
                if gain > 0 and (best is None or (gain, -k, -t) > best):
                    best = (gain, -k, -t)
    if best is None:
        return {}
    gain, k, t = best[0], -best[1], -best[2]
    out, left = {node: (k, t, gain, int((~np.isnan(x[:, k])).sum()))}, x[:, k] <= t
    if depth > 1:
        out |= plain_tree(x[left], y[left], depth - 1, min_leaf, 2 * node) | plain_tree(x[~left], y[~left], depth - 1, min_leaf, 2 * node + 1)
    return out


@pytest.mark.parametrize("min_leaf", [1, 7])
def test_exact_splits_are_brute_force(spark, min_leaf):
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 6, 300), rng.random(300).round(2), rng.random(300), np.full(300, 2.0)].astype(float)
    x[::9, 1] = np.nan
    y = ((x[:, 0] > 2) ^ (x[:, 2] > 0.6)).astype(int)
    y[::11] = 1 - y[::11]
    df = spark.createDataFrame([(int(b), *[None if np.isnan(v) else float(v) for v in a]) for a, b in zip(x, y)], "label int, f0 double, `f.1` double, f2 double, f3 double")
    got = {r["node"]: r for r in fit_exact_tree(df, df.columns[1:], depth=3, min_leaf=min_leaf).collect()}
    want = plain_tree(x, y, 3, min_leaf)
    assert got.keys() == want.keys()
    for node, (k, t, gain, n) in want.items():
        assert (got[node]["feature"], got[node]["n"]) == (df.columns[1 + k], n)
        assert got[node]["threshold"] == pytest.approx(t) and got[node]["gain"] == pytest.approx(gain, abs=2e-9)


def test_no_split_without_gain(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, x double")
    assert fit_exact_tree(df, ["x"]).count() == 0
    assert fit_exact_tree(df.where("x < 0"), ["x"]).count() == 0
