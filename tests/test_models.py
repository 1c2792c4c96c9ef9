"""Preprocessing, model families, selection, artifact, explanations, neighbours and array jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from farol.operators import arrays as G
from farol.operators import explain as I
from farol.operators import metrics as M
from farol.operators import neighbors as K
from farol.operators import prep as P
from farol.operators import split as S
from farol.plans import catalog, run
from farol.plans import training as T
from farol.sources.artifact import load_artifact, save_artifact
from farol.streaming.triage import stream_report

ROLES = T.Roles(["a", "b", "c"], ["k"])


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Two informative numeric columns, one noise column, a weak category, some gaps; written once."""
    rng = np.random.default_rng(0)
    n = 900
    x = rng.normal(size=(n, 3))
    y = (1.5 * x[:, 0] - x[:, 1] + rng.normal(size=n) * 0.7 > 0.3).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "a": x[:, 0] * 40 + 100, "b": np.exp(x[:, 1]), "c": x[:, 2], "k": rng.choice(["u", "v", "w"], n),
                        "label": y, "diagnosis": np.where(y == 1, "M", "B")})
    pdf.loc[::11, "a"] = np.nan
    pdf.loc[::13, "k"] = None
    schema = "id bigint, a double, b double, c double, k string, label int, diagnosis string"
    df = P.imputed(spark.createDataFrame(pdf, schema).replace(float("nan"), None), {})
    path = str(tmp_path_factory.mktemp("planted") / "t")
    S.stratified_split(df, "label").write.parquet(path)
    return spark.read.parquet(path)


def part(df, *names):
    return df.where(F.col("split").isin(*names))


# ---- preprocessing -----------------------------------------------------------------------------------

MIXED = [(45.0, "F", "HC"), (62.0, "F", "HC"), (None, "M", "UPA"), (51.0, None, "UPA"), (70.0, "F", "HC")]
MIXED_SCHEMA = "idade double, sexo string, unidade string"


def test_mixed_and_missing_columns(spark):
    df = spark.createDataFrame(MIXED, MIXED_SCHEMA)
    assert P.infer_roles(df) == (["idade"], ["sexo", "unidade"])
    model = P.Preprocessor(numericCols=["idade"], categoricalCols=["sexo", "unidade"]).fit(df)
    x = np.array([r[0] for r in model.transform(df).select(vector_to_array("features")).collect()])
    assert x.shape == (5, 5) and not np.isnan(x).any()
    assert P.feature_names_out(model) == ["idade", "sexo_F", "sexo_M", "unidade_HC", "unidade_UPA"]
    assert P.fit_medians(df, ["idade"]) == {"idade": 56.5} and P.fit_modes(df, ["sexo"]) == {"sexo": "F"}
    unseen = spark.createDataFrame([(30.0, "X", "Pronto-socorro")], MIXED_SCHEMA)
    probe = model.transform(unseen).select(vector_to_array("features")).first()[0]
    assert len(probe) == 5 and probe[1:] == [0.0, 0.0, 0.0, 0.0]


def test_quotes_and_odd_names_survive(spark):
    df = spark.createDataFrame([(1.0, "it's"), (2.0, "back\\slash"), (None, None)], "`a b.c` double, `k``q` string")
    model = P.Preprocessor(numericCols=["a b.c"], categoricalCols=["k`q"], scaler="none").fit(df)
    assert [list(r[0]) for r in model.transform(df).select(vector_to_array("features")).collect()] == [[1, 0, 1], [2, 1, 0], [1.5, 1, 0]]


def test_scaling_is_learned_on_train_only(spark, planted):
    train, test = part(planted, "train"), part(planted, "test")
    model = P.Preprocessor(numericCols=["b", "c"]).fit(train)
    mean = lambda df: np.array([r[0] for r in model.transform(df).select(vector_to_array("features")).collect()]).mean(axis=0)
    assert np.abs(mean(train)).max() < 1e-9 and np.abs(mean(test)).max() > 1e-6


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None)], "a double, flat double, empty double")
    model = P.Preprocessor(numericCols=["a", "flat", "empty"]).fit(df)
    assert P.feature_names_out(model) == ["a", "flat"]
    assert [list(r[0]) for r in model.transform(df).select(vector_to_array("features")).collect()] == [[-1.0, 0.0], [1.0, 0.0]]


def test_yeo_johnson_lambda_maximises_the_likelihood(spark):
    rng = np.random.default_rng(1)
    x = np.c_[rng.gamma(2.0, size=800), rng.normal(size=800) - 2, -np.exp(rng.normal(size=800))]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))

    def likelihood(v, lam):
        t = P._yeo_johnson_numpy(v, lam)
        return -0.5 * len(v) * np.log(t.var()) + (lam - 1) * (np.sign(v) * np.log1p(np.abs(v))).sum()

    for i, (c, lam) in enumerate(P.fit_lambdas(df, list("abc")).items()):
        best = max(likelihood(x[:, i], g) for g in np.linspace(lam - 0.5, lam + 0.5, 201))
        assert likelihood(x[:, i], lam) >= best - 1e-6
    got = [r[0] for r in df.select(P.yeo_johnson(F.col("b"), 0.4)).collect()]
    assert np.allclose(got, P._yeo_johnson_numpy(x[:, 1], 0.4))


def test_injected_gaps_follow_the_fraction_and_not_the_partitions(spark):
    df = spark.range(4000).select("id", F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    gaps = P.inject_missing(df, ["x", "y"], 0.15)
    row = gaps.agg(F.count_if(F.col("x").isNull()).alias("x"), F.count_if(F.col("y").isNull()).alias("y"),
                   F.count_if(F.col("x").isNull() & F.col("y").isNull()).alias("both")).first()
    assert abs(row["x"] / 4000 - 0.15) < 0.02 and abs(row["y"] / 4000 - 0.15) < 0.02 and row["both"] < 0.04 * 4000
    assert gaps.exceptAll(P.inject_missing(df.repartition(9), ["x", "y"], 0.15)).isEmpty()
    assert P.inject_missing(df, ["x"], 0.0).where("x IS NULL").isEmpty()


# ---- families ----------------------------------------------------------------------------------------

GATES = {"logistic_regression": ({"C": 1.0}, 0.93), "decision_tree": ({"max_depth": 4, "min_samples_leaf": 5, "class_weight": "balanced"}, 0.85),
         "random_forest": ({"n_estimators": 15, "max_depth": 6}, 0.9), "gradient_boosting": ({"n_estimators": 15, "max_depth": 2}, 0.9),
         "knn": ({"n_neighbors": 9, "weights": "distance"}, 0.88), "svm_rbf": ({"C": 1.0}, 0.88)}


@pytest.mark.parametrize("key", sorted(GATES))
def test_family_learns_the_planted_signal(spark, planted, key):
    params, gate = GATES[key]
    scorer = T.fit_scorer(part(planted, "train", "val"), ROLES, catalog.family(key), params)
    scored = scorer.score(P.inject_missing(part(planted, "test"), ["a", "b"], 0.05)).withColumn("model", F.lit(key))
    row = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.count_if(F.col("score").isNull() | F.isnan("score")).alias("bad")).first()
    assert row["bad"] == 0 and 0 <= row["lo"] <= row["hi"] <= 1
    assert scored.count() == part(planted, "test").count()
    assert M.roc_auc(scored).first()["roc_auc"] > gate


def test_catalog_has_the_published_number_of_candidates():
    sizes = {f.key: len(f.candidates()) for f in catalog.FAMILIES}
    assert sizes == {"logistic_regression": 16, "decision_tree": 80, "knn": 24, "random_forest": 72, "gradient_boosting": 16, "svm_rbf": 24}
    assert all(len(f.quick().candidates()) == 1 for f in catalog.FAMILIES)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    assert {r["class"]: r["weight"] for r in catalog.balanced_weights(df).collect()} == pytest.approx({0: 2 / 3, 1: 2.0})


def test_platt_rows_carry_smoothed_targets(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0)], "margin double, label int")
    rows = catalog.platt_rows(df, {1: 8, 0: 3}).collect()
    assert sorted((r["margin"], r["label"], round(r["weight"], 6)) for r in rows) == [(0.0, 0, 0.8), (0.0, 1, 0.2), (1.0, 0, 0.1), (1.0, 1, 0.9)]


def test_search_picks_the_first_of_equal_candidates(spark):
    rows = [("f", c, "{}", fold, p, auc, .5, .5, .5, .5, .5) for c, aucs in enumerate([(.7, .8), (.9, .7), (.8, .8)])
            for fold, auc in enumerate(aucs) for p in ("cv", "train")]
    table = spark.createDataFrame(rows, "family string, candidate int, params string, fold int, part string, " + ", ".join(
        f"{m} double" for m in T.CV_METRICS))
    best = T.best_candidates(T.candidate_summary(table)).first()
    assert best["candidate"] == 1 and best["roc_auc"] == pytest.approx(0.8) and best["roc_auc_std"] == pytest.approx(0.1)


def test_ranking_of_the_published_selection(spark):
    # Published CV and validation AUC of the six families, and the resulting order.
    published = [("logistic_regression", .9944, .9957, .9951), ("svm_rbf", .9941, .9957, .9949), ("gradient_boosting", .9929, .9934, .9932),
                 ("knn", .9859, .9974, .9916), ("random_forest", .9884, .9902, .9893), ("decision_tree", .9814, .9687, .9751)]
    best = spark.createDataFrame([(k, c, 0.0) for k, c, _, _ in published], "family string, roc_auc double, roc_auc_std double")
    validation = spark.createDataFrame([(k, v, 0.0) for k, _, v, _ in published], "family string, roc_auc double, recall double")
    got = T.selection_ranking(best, validation).collect()
    assert [r["chave"] for r in got] == [p[0] for p in published]
    assert [r["score_selecao"] for r in got] == pytest.approx([p[3] for p in published], abs=1.1e-4)


@pytest.mark.parametrize("key", ["decision_tree", "knn", "svm_rbf"])
def test_saved_model_reproduces_its_scores(spark, planted, tmp_path, key):
    scorer = T.fit_scorer(part(planted, "train"), ROLES, catalog.family(key), {"max_depth": 3})
    meta = {"threshold": 0.4, "feature_order": ROLES.features, "model_label": key}
    save_artifact(str(tmp_path / "m"), scorer, meta)
    loaded = load_artifact(spark, str(tmp_path / "m"))
    assert loaded.metadata["threshold"] == 0.4
    test = part(planted, "test")
    before = dict(scorer.score(test).select("id", "score").collect())
    after = dict(loaded.scorer.score(test).select("id", "score").collect())
    assert before == pytest.approx(after, abs=1e-12)
    with pytest.raises(FileNotFoundError, match="train and save"):
        load_artifact(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="missing from the input"):
        loaded.report(test.drop("b"))


def test_whole_run_and_batch_scoring(spark, planted, tmp_path):
    families = [catalog.family("logistic_regression").quick(), catalog.family("decision_tree").quick()]
    cases = planted.drop("label", "split")
    manifest = run.train_triage(cases, str(tmp_path / "out"), families, target_recall=0.9, k=2, repeats=1, learning=False)
    assert manifest["limiar"]["recall_validacao"] >= 0.9
    for name in ("class_balance", "histograms", "boxes", "roc", "calibration"):
        assert spark.read.csv(str(tmp_path / "out" / "figures" / name), header=True).count() > 0
    assert sum(manifest["teste"]["faixas_triagem"].values()) == manifest["teste"]["limiar_clinico"]["n"] == 180
    planted.select("id", "diagnosis", *ROLES.features).write.csv(str(tmp_path / "new"), header=True)
    report = run.score_file(spark, str(tmp_path / "out" / "model"), str(tmp_path / "new"), str(tmp_path / "report"))
    assert spark.read.csv(str(tmp_path / "report"), header=True).count() == 900
    assert "acertou" in report.columns
    demo = run.demo_report(load_artifact(spark, str(tmp_path / "out" / "model")), cases, 10)
    assert demo.count() == 10


def test_report_on_a_stream_equals_the_batch_report(spark, planted, tmp_path):
    scorer = T.fit_scorer(part(planted, "train"), ROLES, catalog.family("logistic_regression"), {"C": 1.0})
    save_artifact(str(tmp_path / "m"), scorer, {"threshold": 0.4, "feature_order": ROLES.features})
    artifact = load_artifact(spark, str(tmp_path / "m"))
    part(planted, "test").drop("split").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream_report(artifact, stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 180 and got.exceptAll(artifact.report(part(planted, "test"))).isEmpty()


def test_learning_curve_grows(spark, planted):
    curve = T.learning_curve(planted, ROLES, catalog.family("logistic_regression"), {"C": 1.0}, k=2, shares=[0.2, 1.0]).collect()
    assert [(r["step"], r["part"]) for r in curve] == [(0, "cv"), (0, "train"), (1, "cv"), (1, "train")]
    assert curve[2]["size"] == 450 and 0.85 < curve[2]["roc_auc_mean"] <= 1


# ---- neighbours --------------------------------------------------------------------------------------

@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("blocks", [(20_000, 20_000), (40, 25)])
def test_neighbours_equal_brute_force_on_clumped_data(spark, p, blocks):
    rng = np.random.default_rng(3)
    reference = np.r_[rng.normal(size=(200, 4)), np.zeros((150, 4)), rng.normal(size=(150, 4)) * 1e-3 + 5]
    queries = np.r_[rng.normal(size=(60, 4)), np.zeros((30, 4)), rng.normal(size=(30, 4)) * 1e-3 + 5]
    label = (reference[:, 0] > 0).astype(float)
    ref = spark.createDataFrame([(i, [float(v) for v in x], float(y)) for i, (x, y) in enumerate(zip(reference, label))], "id bigint, x array<double>, label double")
    qry = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(queries)], "id bigint, x array<double>")
    found = K.nearest_neighbours(qry, ref, 5, p, *blocks).toPandas().sort_values(["id", "rank"])
    d = K.distances(queries, reference, p)
    for i in range(len(queries)):
        want = sorted(range(len(reference)), key=lambda j: (d[i, j], j))[:5]
        assert found.loc[found["id"] == i, "neighbour"].tolist() == want


def test_exact_matches_decide_alone(spark):
    rows = [(1, 10, 0.0, 1.0), (1, 11, 0.0, 0.0), (1, 12, 1.0, 0.0), (2, 10, 1.0, 1.0), (2, 11, 3.0, 0.0)]
    df = spark.createDataFrame(rows, "id bigint, neighbour bigint, distance double, label double")
    assert dict(K.neighbour_scores(df, "distance").collect()) == pytest.approx({1: 0.5, 2: 0.75})
    with pytest.raises(ValueError, match="holds 1 rows"):
        one = spark.createDataFrame([(1, [0.0], 1.0)], "id bigint, x array<double>, label double")
        K.nearest_neighbours(one.drop("label"), one, 3)


# ---- explanations ------------------------------------------------------------------------------------

def test_donors_are_a_permutation(spark):
    df = spark.range(5000).select("id", F.col("id").alias("v"))
    for repeat in range(2):
        rows = I.with_donors(df, ["v"], repeat, 3).select("id", "donor.v").collect()
        assert sorted(r["v"] for r in rows) == list(range(5000))
        assert sum(r["id"] == r["v"] for r in rows) <= 3


def test_permutation_importance_ranks_the_signal(spark, planted):
    scorer = T.fit_scorer(part(planted, "train"), ROLES, catalog.family("logistic_regression"), {"C": 1.0})
    rows = I.permutation_importance(part(planted, "test").select("id", "label", *ROLES.features), ROLES.features, scorer.score, repeats=2).collect()
    assert [r["feature"] for r in rows][0] == "a" and rows[0]["queda_media"] > 0.1
    assert {r["feature"] for r in rows[2:]} == {"c", "k"} and abs(rows[-1]["queda_media"]) < 0.05


@pytest.mark.parametrize("key,params", [("logistic_regression", {"C": 1.0}), ("decision_tree", {"max_depth": 4}),
                                        ("random_forest", {"n_estimators": 4, "max_depth": 4}), ("gradient_boosting", {"n_estimators": 4, "max_depth": 2})])
def test_task_side_scorer_and_shapley_additivity(spark, planted, key, params):
    scorer = T.fit_scorer(part(planted, "train"), ROLES, catalog.family(key), params)
    test = part(planted, "test")
    prepared = scorer.prep.transform(test)
    score = I.scorer_of(scorer.model)
    x = {r["id"]: np.array(r["x"]) for r in prepared.select("id", vector_to_array("features").alias("x")).collect()}
    want = dict(scorer.score(test).select("id", "score").collect())
    assert max(abs(score(v[None, :])[0] - want[i]) for i, v in x.items()) < 1e-9
    shap, base = run.explain(scorer, part(planted, "train"), test)
    sums = dict(shap.groupBy("id").agg(F.sum("shap")).collect())
    assert max(abs(base + s - want[i]) for i, s in sums.items()) < 1e-9
    assert shap.count() == test.count() * len(scorer.names())


def test_shapley_walks_equal_a_plain_walk():
    rng = np.random.default_rng(4)
    x, background, w = rng.normal(size=(3, 4)), rng.normal(size=(7, 4)), rng.normal(size=4)
    score = lambda m: np.tanh(m @ w) + m[:, 0] * m[:, 1]
    orders = np.array([rng.permutation(4) for _ in range(3)])
    got = I.shapley_walks(x, background, score, orders)
    for r in range(3):
        phi = np.zeros(4)
        for sequence in (orders[r], orders[r][::-1]):
            z = background.copy()
            for f in sequence:
                before = score(z).mean()
                z[:, f] = x[r, f]
                phi[f] += (score(z).mean() - before) / 2
        assert np.allclose(got[r], phi)


def test_linear_shapley_adds_up_to_the_margin(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, -1.0])], "id bigint, features array<double>")
    shap = I.linear_shapley(df, [2.0, -1.0], [0.5, 0.5], ["a", "b"])
    assert dict(shap.groupBy("id").agg(F.sum("shap")).collect()) == pytest.approx({1: 1.0 - 1.5, 2: -1.0 + 1.5})


def test_single_case_pools_the_rest(spark):
    rows = [(1, f"f{i:02d}", float(i), 0.01 * i * (-1) ** i) for i in range(14)]
    shap = spark.createDataFrame(rows, "id bigint, feature string, value double, shap double")
    got = I.single_case(shap, 1, 0.4).collect()
    assert len(got) == 12 and got[-1]["feature"] == "3 other features" and got[-1]["start"] == pytest.approx(0.4)
    assert got[0]["end"] == pytest.approx(0.4 + sum(r[3] for r in rows))
    assert all(a["start"] == pytest.approx(b["end"]) for a, b in zip(got, got[1:]))
    assert len(I.single_case(shap.where("feature < 'f12'"), 1, 0.4).collect()) == 12


def test_representative_cases_take_the_first_row_of_a_tie(spark):
    df = spark.createDataFrame([("m", 3, 1, 0.2), ("m", 2, 1, 0.2), ("m", 5, 1, 0.9), ("m", 4, 1, 0.9), ("m", 9, 0, 0.45)],
                               "model string, id bigint, label int, score double")
    got = {r["case"]: r["id"] for r in I.representative_cases(df, 0.5).collect()}
    assert got == {"falso_negativo": 2, "verdadeiro_positivo": 4, "caso_ambiguo": 9}


# ---- array jobs --------------------------------------------------------------------------------------

def test_best_epoch_is_the_first_strict_maximum(spark):
    history = spark.createDataFrame([(1, .8), (2, .9), (3, .9), (4, .7)], "epoch int, val_auc double")
    assert tuple(G.best_epoch(history).first()) == (2, 0.9)
    assert tuple(G.best_epoch(history.withColumn("val_auc", F.lit(0.0))).first()) == (0, 0.0)


def test_pixels_weights_and_review(spark):
    df = spark.createDataFrame([(1, [0.0, 255.0])], "id int, p array<float>")
    assert df.select(G.normalized_pixels(F.col("p"))).first()[0] == [-1.0, 1.0]
    labels = spark.createDataFrame([(0,), (0,), (0,)], "label int")
    assert G.positive_class_weight(labels).first()[0] == 3.0
    scores = spark.createDataFrame([(i, int(i % 5 == 0), 0.9 if i < 3 else 0.1) for i in range(40)], "id bigint, label int, score double")
    review = G.review_sample(scores, 0.5, n=12).collect()
    assert len(review) == 12 and sum(not r["correct"] for r in review) == 6
    few = G.review_sample(scores.where("id < 3 or label = 0"), 0.5, n=12).collect()
    assert sum(not r["correct"] for r in few) == 2 and len(few) == 12


def test_saved_preprocessing_is_a_stock_pipeline(spark, planted, tmp_path):
    model = P.Preprocessor(numericCols=["a", "b"], categoricalCols=["k"], scaler="robust").fit(planted)
    model.write().overwrite().save(str(tmp_path / "p"))
    back = PipelineModel.load(str(tmp_path / "p"))
    assert back.transform(planted).select("features").exceptAll(model.transform(planted).select("features")).isEmpty()


def test_neighbours_cells_are_split_to_the_block(spark):
    """Ten blocks and more in one clump, copies among them: all cells come under the block, neighbours are those of brute force."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1e-3, (3000, 6)), rng.normal(5, 2, (600, 6)), np.repeat(rng.normal(9, 1, (1, 6)), 400, axis=0)])
    ref = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)], "id bigint, label int, x array<double>")
    few = np.concatenate([x[:40], x[3000:3040], x[3600:3610], rng.normal(0, 9, (10, 6))])
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(few)], "id bigint, x array<double>")
    tree, sizes = K._grown(K._first_copies(ref, 4), len(x), 4, 2, 150)
    assert max(sizes.values()) <= 150 and sum(sizes.values()) == 3604 and len(tree.children) > 2
    found = K.nearest_neighbours(asked, ref, 4, 2, 150, 50).toPandas().sort_values(["id", "rank"])
    for i, v in enumerate(few):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        want = sorted(range(len(x)), key=lambda j: (d[j], j))[:4]
        assert found.loc[found["id"] == i, "neighbour"].tolist() == want
    rows, leaves = _with_radii(tree, x, 4).reachable(few, 4)
    assert len(set(zip(rows.tolist(), leaves.tolist()))) == len(rows) < 0.5 * len(few) * len(sizes)


def _with_radii(tree, x, k):
    path, gaps = tree.paths(x)
    tree.near, tree.far, tree.closest = np.full(len(tree.pivots), np.inf), np.zeros(len(tree.pivots)), np.full((len(tree.pivots), k), np.inf)
    for nodes, ds in zip(path, gaps):
        for n, d in zip(nodes, ds):
            tree.near[n], tree.far[n] = min(tree.near[n], d), max(tree.far[n], d)
            tree.closest[n] = np.sort([*tree.closest[n], d])[:k]
    return tree


def test_neighbours_keep_the_type_of_ids_and_repeated_ids(spark):
    x = np.random.default_rng(11).normal(size=(60, 3))
    known = spark.createDataFrame([(f"case-{i}", x[i].tolist(), float(i % 2)) for i in range(60)], "id string, x array<double>, label double")
    found = K.nearest_neighbours(known.select("id", "x"), known, 1).collect()
    assert sorted((r["id"], r["neighbour"], r["distance"]) for r in found) == sorted((f"case-{i}", f"case-{i}", 0.0) for i in range(60))
    repeated = known.select(F.lit("same").alias("id"), array_to_vector("x").alias("features"), "label")
    scored = catalog.NeighboursModel(known, 1, "uniform", 2).transform(repeated).collect()
    assert len(scored) == 60 and all(r["score"] == r["label"] for r in scored)
