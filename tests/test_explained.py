"""Shapley values of models that only score tables, histories of boosted trees, and reading under a contract."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_models import ROLES, part, planted  # noqa: F401

from farol.operators import arrays as G
from farol.operators import explain as I
from farol.plans import catalog, run
from farol.plans import training
from farol.sources import tables as S


@pytest.mark.parametrize("key, params", [("knn", {"n_neighbors": 5, "weights": "distance"}), ("svm_rbf", {"C": 1.0})])
def test_contributions_add_up_for_models_that_score_tables(spark, planted, monkeypatch, key, params):  # noqa: F811
    scorer = training.fit_scorer(part(planted, "train"), ROLES, catalog.family(key), params)
    few = part(planted, "test").where("id % 30 = 0")
    prepared, p = scorer.prep.transform(few), len(scorer.names())
    background = I.background_matrix(scorer.prep.transform(part(planted, "train")), 4)
    monkeypatch.setattr(I, "MASKED", 2 * (2 * p + 1) * len(background))  # several chunks
    shap, base = I.shapley_by_transform(prepared, lambda t: catalog.with_score(scorer.model.transform(t)), background, scorer.names())
    want = dict(scorer.score(few).select("id", "score").collect())
    sums = dict(shap.groupBy("id").agg(F.sum("shap")).collect())
    assert sums.keys() == want.keys() and shap.count() == len(want) * p
    assert max(abs(base + s - want[i]) for i, s in sums.items()) < 1e-6


def test_walks_of_a_table_equal_walks_in_tasks(spark, planted):  # noqa: F811
    scorer = training.fit_scorer(part(planted, "train"), ROLES, catalog.family("logistic_regression"), {"C": 1.0})
    few = scorer.prep.transform(part(planted, "test").where("id % 20 = 0"))
    background = I.background_matrix(scorer.prep.transform(part(planted, "train")), 5)
    own, base = I.shapley_by_transform(few, lambda t: catalog.with_score(scorer.model.transform(t)), background, scorer.names())
    score = I.scorer_of(scorer.model)
    want = {(r["id"], r["feature"]): r["shap"] for r in I.shapley_values(few, score, background, scorer.names()).collect()}
    got = {(r["id"], r["feature"]): r["shap"] for r in own.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    assert base == pytest.approx(I.base_value(score, background), abs=1e-9)


def test_stages_of_boosting_end_with_the_model(spark, planted):  # noqa: F811
    scorer = training.fit_scorer(part(planted, "train"), ROLES, catalog.family("gradient_boosting"), {"n_estimators": 5, "max_depth": 2})
    held = part(planted, "val")
    stages = I.staged_scores(scorer.prep.transform(held), scorer.model)
    assert stages.count() == 5 * held.count()
    last = sorted(r["score"] for r in stages.where("epoch = 5").collect())
    assert np.allclose(last, sorted(r["score"] for r in scorer.score(held).collect()), atol=1e-12)
    history = G.training_history(stages)
    assert sorted(r["epoch"] for r in history.collect()) == [1, 2, 3, 4, 5]
    losses = [r["val_loss"] for r in history.orderBy("epoch").collect()]
    assert losses[-1] < losses[0]


def test_permutation_of_all_repeats_at_once_equals_one_by_one(spark):
    df = spark.range(3000).select("id", F.col("id").alias("v"))
    both = I.with_donors(df.withColumn("r", F.explode(F.array(F.lit(0), F.lit(1)))), ["v"], F.col("r"), 3)
    for repeat in (0, 1):
        alone = {r["id"]: r["donor"]["v"] for r in I.with_donors(df, ["v"], repeat, 3).collect()}
        assert {r["id"]: r["donor"]["v"] for r in both.where(F.col("r") == repeat).collect()} == alone


CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("concave_points_mean", T.DoubleType()), T.StructField("n", T.IntegerType())])


def test_contract(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text('id, "concave points_mean" ,extra,n,diagnosis\n1,2.5,x,3,M\n2,,x,4,B\n\n3,abc,x,4,B\n4,1.5,x\n')
    (path / "b.csv").write_text('id, "concave points_mean" ,extra,n,diagnosis\n5,NaN,"a b",7,m\n6,1.5,x,2.5,B\n,1.0,x,1,B\n7,1,x,1,B,more\n')
    checked = S.read_contract(spark, str(path), CONTRACT)
    good = {r["id"]: (r["concave_points_mean"], r["n"], r["diagnosis"]) for r in S.accepted_rows(checked).collect()}
    assert good == {1: (2.5, 3, "M"), 2: (None, 4, "B"), 5: (None, 7, "m")}
    bad = {r["_line"].split(",")[0]: r["_reason"] for r in S.rejected_rows(checked).collect()}
    assert bad == {"3": "concave_points_mean is not a double", "4": "wrong number of cells", "6": "n is not a int", "": "id is missing", "7": "wrong number of cells"}


def test_contract_without_ids_and_with_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,concave_points_mean\n1,2\n2,3\n")
    ids = [r["id"] for r in S.accepted_rows(S.read_contract(spark, str(tmp_path / "a.csv"), CONTRACT)).collect()]
    assert len(set(ids)) == 2 and None not in ids
    (tmp_path / "b.csv").write_text("id,concave_points_mean\n1,2\n")
    with pytest.raises(ValueError, match="missing from the input: \\['n'\\]"):
        S.read_contract(spark, str(tmp_path / "b.csv"), CONTRACT)
    (tmp_path / "c.csv").write_text("1,2\n")
    with pytest.raises(ValueError, match="no header"):
        S.read_contract(spark, str(tmp_path / "c.csv"), CONTRACT)


def test_scoring_a_file_sets_bad_lines_aside(spark, planted, tmp_path):  # noqa: F811
    cases = planted.drop("label", "split")
    run.train_triage(cases, str(tmp_path / "out"), [catalog.family("logistic_regression").quick()], 0.9, k=2, repeats=1, learning=False, figures=False)
    (tmp_path / "new.csv").write_text("k,id,a,b,c,diagnosis\nu,1,100,1,0.5,m\nv,2,x,1,0.5,B\nw,3,90,2,0.1,B\n")
    report = run.score_file(spark, str(tmp_path / "out" / "model"), str(tmp_path / "new.csv"), str(tmp_path / "report"))
    assert sorted(r["exame"] for r in report.collect()) == [1, 3] and "acertou" in report.columns
    rejected = spark.read.csv(str(tmp_path / "report-rejected"), header=True).collect()
    assert [(r["_reason"], r["_line"]) for r in rejected] == [("a is not a double", "v,2,x,1,0.5,B")]
