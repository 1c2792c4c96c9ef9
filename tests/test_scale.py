"""Steps that were rewritten for larger tables give what the plain forms give."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from farol.functions import storage
from farol.operators import explain as I
from farol.operators import metrics as M
from farol.operators import split as T
from farol.operators.prep import _yeo_johnson_logs, _yeo_johnson_numpy


def scored(spark, n=600):
    rng = np.random.default_rng(3)
    rows = [(m, i, int(rng.random() < 0.4), float(round(rng.random(), d)), int(rng.integers(0, 3)) if i % 50 else None)
            for m, d in (("fine", 9), ("ties", 1)) for i in range(n)]
    return spark.createDataFrame(rows, "model string, id bigint, label int, score double, fold int")


@pytest.mark.parametrize("edges", [[], [0.25, 0.5, 0.75]])
def test_folds_at_once_are_each_fold_alone(spark, edges):
    table = scored(spark)
    both = F.explode(F.array(*[F.struct(F.lit(f).alias("held"), F.when(F.col("fold") == f, "cv").otherwise("train").alias("part")) for f in range(4)])).alias("h")
    keys = ["model", "held", "part"]
    wanted = M.compute_metrics(table.select("model", "label", "score", both).select("model", "h.*", "label", "score"), by=keys, edges=edges).toPandas()
    found = M.fold_metrics(table, range(4), edges=edges).toPandas()[wanted.columns]
    wanted, found = (x.sort_values(keys).reset_index(drop=True) for x in (wanted, found))
    assert wanted[keys].equals(found[keys]) and (wanted["part"] == "cv").sum() == 6  # nothing is in fold 3
    assert np.allclose(wanted.drop(columns=keys), found.drop(columns=keys), equal_nan=True)


def test_folds_at_once_read_a_row_once(spark):
    """The rows that are shuffled do not multiply with the folds."""
    plan = M.fold_metrics(scored(spark), range(5), edges=[0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Window")  # printed from the top: the points are dealt above the ranking


@pytest.mark.parametrize("lam", [-1.3, 0.0, 0.7, 2.0, 3.1])
def test_transform_from_logs(lam):
    x = np.array([-40.0, -1.0, -1e-9, 0.0, 1e-9, 2.5, 900.0])
    assert np.allclose(_yeo_johnson_logs(np.sign(x) * np.log1p(np.abs(x)), lam), _yeo_johnson_numpy(x, lam), rtol=1e-13)


def test_view_is_joined_once(spark, small, monkeypatch):
    """Splits, folds and subsets of the planted cases read a written table, not the view, in each of their jobs."""
    from farol.queries import tables, training, views
    calls = []
    whole = views.labelled
    monkeypatch.setattr(views, "labelled", lambda *a: calls.append(1) or whole(*a))
    assert training.m16(spark, small).count() == 3 and len(calls) == 1
    parts = tables.fold_cases(spark, small)
    assert "SortMergeJoin" not in (plan := parts._jdf.queryExecution().executedPlan().toString()) and "HashJoin" not in plan


def test_slices_with_a_ready_digest(spark):
    table = spark.range(400).select("id", (F.col("id") % 3).cast("int").alias("fold"))
    steps = T.learning_subsets(table)
    assert "__digest" not in steps.columns
    sizes = {(r[0], r[1]): r[2] for r in steps.groupBy("held_out", "step").count().collect()}
    n = {f: 400 - len(range(f, 400, 3)) for f in range(3)}
    for f in range(3):
        ends = T.learning_sizes(n[f], T.learning_shares())
        assert [sizes[f, s] for s in range(8)] == [b - a for a, b in zip([0, *ends[:-1]], ends)]


@pytest.mark.parametrize("edges", [[], [0.25, 0.5, 0.75]])
def test_packed_metrics_are_the_ranked_ones(spark, edges, monkeypatch):
    monkeypatch.setattr(M, "PACK", 64)
    table = scored(spark).repartition(3)
    keys = ["model", "fold"]
    wanted = M.compute_metrics(table.where("fold IS NOT NULL"), by=keys, edges=edges).toPandas()
    found = M.packed_metrics(table, keys, edges).toPandas()
    assert list(found.columns) == list(wanted.columns)
    wanted, found = (x.sort_values(keys).reset_index(drop=True) for x in (wanted, found))
    assert wanted[keys].equals(found[keys]) and np.allclose(wanted.drop(columns=keys), found.drop(columns=keys), equal_nan=True)
    aucs = M.packed_auc(table, ["model"], edges).toPandas().set_index("model")["roc_auc"]
    whole = M.roc_auc(table).toPandas().set_index("model")["roc_auc"]
    assert np.allclose(aucs[whole.index], whole)


def test_packed_scores_collapse_ties_and_refuse_missing(spark):
    many = spark.range(5000, numPartitions=1).selectExpr("'m' AS model", "CAST(id % 2 AS INT) AS label", "0.5D AS score")
    rows = M.packed_scores(many, ["model"], [0.5]).collect()
    assert [(r["label"], len(r["scores"]), len(r["counts"])) for r in rows] == [(0, 8, 4), (1, 8, 4)]
    assert M.packed_auc(many, ["model"], [0.5]).first()["roc_auc"] == 0.5
    with pytest.raises(Exception, match="must not be missing"):
        M.packed_auc(many.withColumn("score", F.expr("CASE WHEN id % 7 > 0 THEN score END") if "id" in many.columns else F.lit(None).cast("double")), ["model"], []).collect()


@pytest.mark.parametrize("p", [1, 2])
def test_nearest_rows_are_brute_force(p, monkeypatch):
    from farol.operators import neighbors as K
    rng = np.random.default_rng(5)
    whole, measured = K.distances, []
    monkeypatch.setattr(K, "distances", lambda a, b, p: measured.append(1) or whole(a, b, p))
    far = rng.normal(size=(500, 8)) + 1e6  # estimates cancel here: all rows may have to be measured
    grid = rng.integers(0, 3, size=(400, 4)).astype(float)  # many ties
    for a, b in ((rng.normal(size=(70, 64)), rng.normal(size=(5000, 64))), (far[:50], far), (grid[:40], grid), (grid[:3], grid[:5])):
        d = whole(a, b, p)
        order = np.argsort(d, axis=1, kind="stable")[:, :5]
        at, found = K.nearest_rows(a, b, 5, p)
        assert np.array_equal(at, order) and np.array_equal(found, np.take_along_axis(d, order, axis=1))
        assert not measured or b is not None and len(b) != 5000  # random rows: few pairs are measured


def test_walks_of_a_linear_model_need_no_masks():
    from farol.operators import explain as I
    rng = np.random.default_rng(2)
    x, background, orders = rng.normal(size=(9, 6)), rng.normal(size=(20, 6)), np.array([rng.permutation(6) for _ in range(9)])
    score, scored = I.linear_scorer(rng.normal(size=6), 0.3), []

    def masked(m):
        scored.append(len(m))
        return score(m)

    wanted = I.shapley_walks(x, background, masked, orders)
    masked.linear = score.linear
    assert np.allclose(I.shapley_walks(x, background, masked, orders), wanted, atol=1e-13) and scored == [9 * 13 * 20]


def test_walks_of_a_forest_by_leaf():
    from farol.operators import explain as I
    rng = np.random.default_rng(4)
    tree = {"by_category": np.array([False, True, False, False, False, False, False]), "goes_left": np.zeros((7, 3), dtype=bool),
            "feature": np.array([0, 1, 0, -1, -1, -1, -1]), "threshold": np.array([0.1, 0.0, 0.8, 0, 0, 0, 0]), "left": np.array([1, 3, 5, -1, -1, -1, -1]),
            "right": np.array([2, 4, 6, -1, -1, -1, -1]), "prediction": np.zeros(7), "share": np.array([0, 0, 0, 0.2, 0.9, 0.0, 0.6])}
    tree["goes_left"][1, 1] = True
    other = tree | {"feature": np.array([2, 1, 0, -1, -1, -1, -1]), "share": tree["share"][::-1].copy()}
    draw = lambda n: np.c_[rng.normal(size=n), rng.integers(0, 3, size=n), rng.normal(size=n)]
    x, background, orders = draw(40), draw(25), np.array([rng.permutation(3) for _ in range(40)])
    score, scored = I.tree_scorer([tree, other]), []

    def masked(m):
        scored.append(len(m))
        return score(m)

    wanted = I.shapley_walks(x, background, masked, orders)
    masked.trees = score.trees
    assert np.allclose(I.shapley_walks(x, background, masked, orders), wanted, atol=1e-13) and scored == [40 * 7 * 25]
    assert not hasattr(I.tree_scorer([tree], [1.0], boosted=True), "trees")


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("whole", [60, 3])
def test_nearest_rows_with_gaps(p, whole):
    from farol.operators import neighbors as K
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(30, 5)), rng.normal(size=(80, 5))
    a[::4, 2] = np.nan
    b[rng.permutation(80)[whole:], 1] = np.nan
    d = K.distances(a, b, p)
    order = np.argsort(d, axis=1, kind="stable")[:, :5]
    at, found = K.nearest_rows(a, b, 5, p)
    assert np.array_equal(at, order) and np.array_equal(found, np.take_along_axis(d, order, axis=1), equal_nan=True)


def planted_signal(spark, n=3000):
    """Ids with a label that `x` carries, and a missing id."""
    rng = np.random.default_rng(5)
    rows = [(None if i == 7 else i, int(rng.random() < 0.5), float(rng.random()), float(rng.random())) for i in range(n)]
    return spark.createDataFrame([(i, y, x + 0.5 * y, z) for i, y, x, z in rows], "id bigint, label int, x double, z double")


def test_permutation_in_many_jobs_is_permutation_in_one(spark, monkeypatch):
    table, calls = planted_signal(spark), []

    def score(df):
        calls.append(1)
        return df.withColumn("score", F.col("x") + F.col("z") / 4.0)

    found = {}
    for rows in (10**9, 9000, 1):
        monkeypatch.setattr(I, "PERMUTED_ROWS", rows)
        calls.clear()
        found[rows] = [tuple(r) for r in I.permutation_importance(table, ["x", "z"], score, repeats=7).collect()], len(calls) - 1
    assert [jobs for _, jobs in found.values()] == [1, 3, 7]
    whole = found[10**9][0]
    assert [r[0] for r in whole] == ["x", "z"] and whole[0][1] > 0.2 > abs(whole[1][1]) and whole[0][2] > 0
    for rows, _ in found.values():
        assert [r[0] for r in rows] == ["x", "z"] and np.allclose([r[1:] for r in rows], [r[1:] for r in whole], atol=1e-12)


def test_permutation_keeps_the_shuffle_files_of_one_job(spark, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}
    table, old, seen = planted_signal(spark), files(), []

    def left():
        until = time.monotonic() + 20.0  # files are deleted behind the query
        while (new := files() - old) and time.monotonic() < until:
            time.sleep(0.1)
        return len(new)

    def score(df):
        seen.append(left())
        return df.withColumn("score", F.col("x"))

    settings = {k: spark.conf.get(k, None) for k in storage.JOB_BY_JOB}
    monkeypatch.setattr(I, "PERMUTED_ROWS", 1)
    found = I.permutation_importance(table, ["x", "z"], score, repeats=3)
    assert seen == [0, 0, 0, 0] and left() == 0
    assert found.count() == 2
    assert {k: spark.conf.get(k, None) for k in storage.JOB_BY_JOB} == settings


def test_a_large_job_is_dealt_to_more_tasks(spark, monkeypatch):
    plans = []

    def score(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.withColumn("score", F.col("x"))

    monkeypatch.setattr(I, "SORTED_ROWS", 100)
    I.permutation_importance(planted_signal(spark), ["x"], score, repeats=2)
    assert "RepartitionByExpression" in plans[1] and ", 60" in plans[1].split("RepartitionByExpression")[1].split("\n")[0]


def test_packed_auc_of_very_many_groups(spark):
    """More groups, ranges and labels than two bytes number, with ties inside and across ranges."""
    rng = np.random.default_rng(8)
    rows = [(int(g), int(y), float(s)) for g in range(400) for y, s in zip(rng.integers(0, 2, 12), rng.integers(0, 30, 12) / 30.0)]
    table = spark.createDataFrame(rows, "model int, label int, score double")
    edges = [i / 120 for i in range(1, 120)]
    found = {r[0]: r[1] for r in M.packed_auc(table, ["model"], edges).collect()}
    for g in range(400):
        own = [(y, s) for m, y, s in rows if m == g]
        pairs = [(s > t) + (s == t) / 2 for y, s in own if y for x, t in own if not x]
        assert found[g] is None if not pairs else abs(found[g] - np.mean(pairs)) < 1e-12
