"""Names, labels, audit, description, correlation, exploration and splits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.operators import audit as Q
from farol.operators import correlate as C
from farol.operators import describe as D
from farol.operators import explore as E
from farol.operators import normalize as N
from farol.operators import split as T
from farol.sources import tables as S

# Published correlations with the label and redundant pairs, and the columns they lead to.
WITH_TARGET = """concave_points_worst 0.7936 perimeter_worst 0.7829 concave_points_mean 0.7766 radius_worst 0.7765 perimeter_mean 0.7426
area_worst 0.7338 radius_mean 0.73 area_mean 0.709 concavity_mean 0.6964 concavity_worst 0.6596 compactness_mean 0.5965 compactness_worst 0.591
radius_se 0.5671 perimeter_se 0.5561 area_se 0.5482 texture_worst 0.4569 smoothness_worst 0.4215 symmetry_worst 0.4163 texture_mean 0.4152""".split()
PAIRS = """radius_mean perimeter_mean 0.9979 radius_worst perimeter_worst 0.9937 radius_mean area_mean 0.9874 perimeter_mean area_mean 0.9865
radius_worst area_worst 0.984 perimeter_worst area_worst 0.9776 radius_se perimeter_se 0.9728 perimeter_mean perimeter_worst 0.9704
radius_mean radius_worst 0.9695 perimeter_mean radius_worst 0.9695 radius_mean perimeter_worst 0.9651 area_mean radius_worst 0.9627
area_mean area_worst 0.9592 area_mean perimeter_worst 0.9591 radius_se area_se 0.9518 perimeter_mean area_worst 0.9415
radius_mean area_worst 0.9411 perimeter_se area_se 0.9377 concavity_mean concave_points_mean 0.9214 texture_mean texture_worst 0.912
concave_points_mean concave_points_worst 0.9102""".split()
DROPS = ["area_mean", "area_se", "area_worst", "concave_points_mean", "concavity_mean", "perimeter_mean", "perimeter_se", "radius_mean",
         "radius_worst", "texture_mean"]


def dirty(spark):
    pdf = pd.DataFrame({" id ": [1, 2, 3, 3, 4], "diagnosis": [" m ", "B", "b", "b", "M"], "area_mean": [1.0, 0.0, 2.0, 2.0, np.nan],
                        "concave points_mean": [0.1, 0.2, 0.3, 0.3, 0.4], "flat": [7.0] * 5, "Unnamed: 32": [None] * 5})
    return spark.createDataFrame(pdf, "` id ` bigint, diagnosis string, area_mean double, `concave points_mean` double, flat double, `Unnamed: 32` string")


def test_normalize_and_audit_find_the_planted_defects(spark):
    df = N.normalize(dirty(spark))
    assert df.columns == ["id", "diagnosis", "area_mean", "concave_points_mean", "flat"]
    a = Q.audit(df).first().asDict(recursive=True)
    assert (a["n_rows"], a["n_cols"], a["n_numeric"], a["n_categorical"]) == (5, 5, 4, 1)
    assert a["categorical_columns"] == ["diagnosis"]
    assert a["missing_by_column"] == {"area_mean": 1} and a["missing_total"] == 1
    assert (a["duplicated_rows"], a["duplicated_ids"]) == (1, 1)
    assert a["constant_columns"] == ["flat"] and a["impossible_zeros"] == {"area_mean": 1}
    assert a["class_counts"] == {"B": 3, "M": 2} and a["class_balance_pct"] == {"B": 60.0, "M": 40.0}
    assert a["imbalance_ratio"] == 1.5


def test_audit_of_a_clean_table(spark):
    a = Q.audit(spark.createDataFrame([(1.0, "x"), (2.0, "y")], "radius_mean double, t string")).first()
    assert (a["missing_total"], a["duplicated_rows"], a["duplicated_ids"]) == (0, 0, None)
    assert a["constant_columns"] == [] and a["impossible_zeros"] == {}


def test_duplicates_with_nulls_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, None), (2, None)], "a int, b int")
    assert Q.duplicate_rows(df).first()[0] == 3


def test_unknown_and_missing_labels_fail(spark):
    df = spark.createDataFrame([(1, "M"), (2, "X"), (3, None)], "id int, diagnosis string")
    with pytest.raises(ValueError, match="X"):
        N.check_labels(df)
    with pytest.raises(Exception, match="unknown label"):
        N.with_target(df).select("target").collect()
    good = N.with_target(df.where("id = 1")).first()
    assert good["target"] == 1


def test_target_type_and_features(spark):
    df = N.with_target(N.normalize(dirty(spark)))
    assert df.schema["target"].dataType.simpleString() == "tinyint"
    assert N.features_only(df, ["id", "diagnosis", "target"]).columns == ["area_mean", "concave_points_mean", "flat"]


def test_contract_names_the_first_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, b double, a double")
    assert N.enforce_contract(df, ["a", "b"], ["id"]).columns == ["id", "a", "b"]
    with pytest.raises(ValueError, match=r"7 column\(s\).*c5'\]"):
        N.enforce_contract(df, [f"c{i}" for i in range(7)])


def test_feature_labels(spark):
    names = spark.createDataFrame([("concave_points_worst",), ("area_se",), ("radius_mean",), ("plain_name",)], "n string")
    assert [r[0] for r in names.select(N.feature_label(F.col("n"))).collect()] == [
        "concave points (pior)", "area (erro-padrao)", "radius (media)", "plain name"]
    assert len(words.feature_columns()) == 30 and words.feature_columns()[10] == "radius_se"


def test_sample_is_whole_when_n_is_large_and_stable(spark):
    df = spark.range(50)
    assert N.sample_rows(df, 80).count() == 50
    first = [r[0] for r in N.sample_rows(df, 10).collect()]
    assert first == [r[0] for r in N.sample_rows(df.repartition(7), 10).collect()]


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.exponential(size=301), "b": rng.normal(size=301), "c": 5.0})
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(pdf.assign(id=range(301))).replace(float("nan"), None)
    got = D.describe_numeric(df).toPandas().set_index("feature")
    want = pdf.describe().T
    for g, w in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert np.allclose(got.loc[want.index, g], want[w].round(4), atol=1.1e-4)
    assert np.allclose(got.loc[["a", "b", "c"], "skew"], pdf.skew().round(4), atol=1.1e-4)
    assert np.allclose(got.loc[["a", "b", "c"], "kurtosis"], pdf.kurtosis().round(4), atol=1.1e-4)
    assert got.loc["b", "missing"] == 43


def test_spearman_ranks_again_per_pair(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=200).round(1), "b": rng.normal(size=200), "c": rng.integers(0, 4, 200).astype(float)})
    pdf["d"] = pdf["a"] + pdf["b"]
    pdf.loc[::5, "b"] = np.nan
    pdf.loc[::3, "c"] = np.nan
    df = spark.createDataFrame(pdf.assign(id=range(200))).replace(float("nan"), None)
    want = pdf.corr(method="spearman")
    for r in C.correlation_matrix(df, list("abcd"), "spearman").collect():
        assert r["r"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]], abs=1e-9)
    with pytest.raises(ValueError, match="kendall"):
        C.correlation_matrix(df, ["a"], "kendall")


def test_spearman_with_values_that_many_rows_share(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": np.where(rng.random(900) < 0.4, 0.0, rng.normal(size=900)), "b": rng.poisson(1, 900) * 1.0, "c": rng.normal(size=900), "k": 7.0})
    pdf["c"] += pdf["a"]
    pdf.loc[rng.random(900) < 0.3, "b"] = np.nan
    df = spark.createDataFrame(pdf.assign(id=range(900), none=np.nan)).replace(float("nan"), None)
    want = pdf.assign(none=np.nan).corr(method="spearman")
    for r in C.correlation_matrix(df, [*pdf.columns, "none"], "spearman").collect():
        expected = want.loc[r["feature_a"], r["feature_b"]]
        assert r["r"] is None if np.isnan(expected) else r["r"] == pytest.approx(expected, abs=1e-9)


def test_drops_from_published_correlations(spark):
    with_target = spark.createDataFrame([(WITH_TARGET[i], float(WITH_TARGET[i + 1])) for i in range(0, len(WITH_TARGET), 2)],
                                        "feature string, corr_com_alvo double")
    pairs = spark.createDataFrame([(PAIRS[i], PAIRS[i + 1], float(PAIRS[i + 2])) for i in range(0, len(PAIRS), 3)],
                                  "feature_a string, feature_b string, correlacao double")
    assert C.suggested_drops(pairs, with_target) == DROPS


def test_near_copy_is_redundant(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 0] + 0.01 * x[:, 1], "c": x[:, 2]}))
    pairs = C.redundant_pairs(C.correlation_matrix(df, ["a", "b", "c"])).collect()
    assert [(r["feature_a"], r["feature_b"]) for r in pairs] == [("a", "b")]


def test_density_histogram_integrates_to_one_and_keeps_constants(spark):
    df = spark.createDataFrame([(float(i % 17), 3.0, "B" if i % 3 else "M") for i in range(200)], "a double, flat double, diagnosis string")
    h = E.density_histogram(df, ["a", "flat"]).toPandas()
    for _, g in h.groupby(["feature", "class"]):
        lo = g.loc[g["bin"] == 0, "left"]
        assert g["count"].sum() in (133, 67, 66, 134)
        assert len(g) <= 28 and g["bin"].between(0, 27).all() and (lo.empty or lo.iloc[0] <= 3.0)


def test_density_curve_is_close_to_the_exact_one(spark):
    rng = np.random.default_rng(4)
    x = rng.gamma(2.0, size=2000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "diagnosis": "B"}))
    c = E.density_curve(df, ["x"]).orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    exact = np.exp(-0.5 * ((c["x"].to_numpy()[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.abs(c["density"] - exact).max() < 1e-4


def test_box_whiskers_stay_outside_the_box(spark):
    df = spark.createDataFrame([(v, "B") for v in (1.0, 1.0, 1.0, 100.0)], "x double, diagnosis string")
    b = E.box_table(df, ["x"]).first()
    assert (b["q3"], b["high_whisker"], b["outliers"]) == (25.75, 25.75, 1)


def test_components_match_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(id=range(300), diagnosis="B"))
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    got = E.component_variance(df, list("abcd")).toPandas()
    assert np.allclose(got["variance_ratio"], s**2 / (s**2).sum())
    assert got["cumulative_ratio"].iloc[-1] == pytest.approx(1.0)
    v = vt * np.sign(vt[np.arange(4), np.abs(vt).argmax(axis=1)])[:, None]
    points = E.projected_points(df, list("abcd")).orderBy("id").toPandas()
    assert np.allclose(points[["pc1", "pc2"]], z @ v[:2].T)


def test_split_sizes_of_the_published_table(spark):
    df = spark.range(569).withColumn("label", (F.col("id") < 212).cast("int"))
    s = {r["split"]: r for r in T.split_summary(T.stratified_split(df, "label"), "label").collect()}
    assert [(s[k]["n"], s[k]["positives"]) for k in ("train", "val", "test")] == [(341, 127), (114, 43), (114, 42)]
    assert s["train"]["pct_of_total"] == 59.9 and s["train"]["prevalence_pct"] == 37.24


def test_split_is_disjoint_complete_and_balanced(spark):
    df = spark.range(1, 900).withColumn("label", (F.col("id") % 7 == 0).cast("int"))
    parts = T.stratified_split(df, "label")
    checks = T.split_problems(parts, df).first()
    assert (checks["overlapping"], checks["unplaced"], checks["foreign"]) == (0, 0, 0)
    assert T.prevalence_gap(parts, "label").first()[0] < 0.02
    doubled = parts.unionAll(parts.limit(1).withColumn("split", F.lit("elsewhere")))
    assert T.split_problems(doubled, df.where("id > 1")).first().asDict() == {"overlapping": 1, "unplaced": 0, "foreign": 1}
    again = T.stratified_split(df.repartition(13), "label")
    assert parts.exceptAll(again).isEmpty()


def test_folds_are_balanced(spark):
    df = spark.range(1003).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    sizes = T.stratified_folds(df, "label", k=5).groupBy("fold", "label").count().toPandas().pivot(index="fold", columns="label", values="count")
    assert (sizes.max() - sizes.min() <= 1).all()
    assert sizes.sum(axis=1).max() - sizes.sum(axis=1).min() <= 1


def test_learning_subsets_are_nested_prefixes(spark):
    folded = T.stratified_folds(spark.range(500).withColumn("label", (F.col("id") % 3 == 0).cast("int")), "label", k=5)
    got = T.learning_subsets(folded).groupBy("held_out", "step").count().toPandas().sort_values(["held_out", "step"])
    for _, g in got.groupby("held_out"):
        assert g["count"].cumsum().tolist() == T.learning_sizes(400, T.learning_shares())


def test_csv_round_trip_and_missing_paths(spark, tmp_path):
    df = spark.createDataFrame([(1, " m", 0.5), (2, "B ", float("nan")), (3, "B", None)], "id bigint, diagnosis string, radius_mean double")
    df.write.csv(str(tmp_path / "c"), header=True)
    back = S.read_cases(spark, [str(tmp_path / "none"), str(tmp_path / "c")], df.schema)
    assert {tuple(r) for r in back.collect()} == {(1, "M", 0.5), (2, "B", None), (3, "B", None)}
    with pytest.raises(FileNotFoundError):
        S.read_cases(spark, str(tmp_path / "none"))
    (tmp_path / "bad.csv").write_text("id,diagnosis,radius_mean\n1,M,abc\n")
    with pytest.raises(Exception, match="abc|MALFORMED|malformed"):
        S.read_cases(spark, str(tmp_path / "bad.csv"), df.schema).collect()


def test_images_need_an_array_and_known_splits(spark, tmp_path):
    good = spark.createDataFrame([(1, [0.0, 255.0], "train")], "id int, pixels array<float>, split string")
    good.write.parquet(str(tmp_path / "g"))
    assert S.read_images(spark, str(tmp_path / "g")).count() == 1
    good.withColumn("split", F.lit("dev")).write.parquet(str(tmp_path / "b"))
    with pytest.raises(ValueError, match="dev"):
        S.read_images(spark, str(tmp_path / "b"))
    folder = tmp_path / "files" / "train"
    folder.mkdir(parents=True)
    (folder / "1.png").write_bytes(b"abc")
    assert S.read_image_files(spark, str(tmp_path / "files")).first()["split"] == "train"
