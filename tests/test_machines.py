"""Machines that learn together against Spark's own."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from farol.operators import machines as H
from farol.operators.fourier import FourierFeatures
from farol.plans import catalog as K


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 4))
    y = (1.5 * x[:, 0] - x[:, 1] ** 2 + rng.normal(size=len(x)) > 0).astype(int)
    table = spark.createDataFrame([(i, int(b), i % 5, a.tolist()) for i, (a, b) in enumerate(zip(x, y))], "id int, label int, fold int, x array<double>")
    return table.select("id", "label", "fold", array_to_vector("x").alias("features")).repartition(3).cache()


def fourier():
    return FourierFeatures(inputCol="features", outputCol="fourier", gamma=0.2, inputSize=4, seed=42)


def test_machines_together_are_those_of_spark_one_by_one(spark, rows):
    table, machines = H.blocks(rows, "fold"), [H.Machine(0, 1e-3), H.Machine(-1, 1e-3), H.Machine(2, 1e-3, (0.7, 1.6)), H.Machine(3, 1e-5)]
    fitted, passes = H.fit_machines(table, fourier(), machines, H.fold_sums(table, fourier(), 5))
    mapped, slowest = fourier().transform(rows).cache(), 0
    for m, (coefficients, intercept) in zip(machines, fitted):
        weight = F.when(F.col("label") == 1, m.weights[1]).otherwise(m.weights[0])
        alone = LinearSVC(featuresCol="fourier", regParam=m.penalty, standardization=False, maxIter=50, tol=1e-3, weightCol="weight").fit(
            mapped.where(F.col("fold") != m.fold).withColumn("weight", weight))
        assert np.allclose(alone.coefficients.toArray(), coefficients, atol=1e-8) and alone.intercept == pytest.approx(intercept, abs=1e-8)
        slowest = max(slowest, alone.summary().totalIterations)
    assert passes <= slowest + 20


def test_fast_cosines_are_those_of_numpy():
    x = np.random.default_rng(2).normal(size=(64, 32)) * 30
    turns = x / (2 * np.pi)
    assert np.abs(H._cosines(turns, np.empty_like(x), np.empty_like(x)) - np.cos(x)).max() < 1e-13


def test_margins_of_held_rows_and_of_the_saved_machine(spark, rows, tmp_path):
    rng = np.random.default_rng(3)
    coefficients = rng.normal(size=(5, 256))
    by_hand = {r["id"]: (r["label"], r["f"], r["fold"]) for r in fourier().transform(rows).select("id", "label", "fold", vector_to_array("fourier").alias("f")).collect()}
    held = H.held_margins(H.blocks(rows, "fold"), fourier(), {f: (coefficients[f], 0.5 * f) for f in range(5)})
    got = sorted((r[0], r[1]) for r in held.select("label", vector_to_array("margin")[0]).collect())
    assert np.allclose(got, sorted((b, float(np.dot(f, coefficients[k]) + 0.5 * k)) for b, f, k in by_hand.values()))
    made = H.MachineMargin(inputCol="features", outputCol="margin", gamma=0.2, inputSize=4, seed=42, coefficients=coefficients[0].tolist(), intercept=0.25)
    PipelineModel([made]).write().overwrite().save(str(tmp_path / "m"))
    for model in (made, PipelineModel.load(str(tmp_path / "m"))):
        margins = {r[0]: r[1] for r in model.transform(rows).select("id", vector_to_array("margin")[0]).collect()}
        assert np.allclose([margins[i] for i in by_hand], [np.dot(f, coefficients[0]) + 0.25 for _, f, _ in by_hand.values()])


def test_a_calibrated_machine_takes_few_jobs(spark, rows):
    spark.sparkContext.setJobGroup("machine", "one calibrated machine")
    counts = K.class_counts(rows)
    model = K.fit_svm(rows.select("id", "label", "features"), {"C": 1.0}, counts, 42)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("machine"))
    spark.sparkContext.setJobGroup("", "")
    assert 0 < jobs < 150
    scored = K.with_score(model.transform(rows)).select("label", "score").toPandas()
    assert scored.score.between(0, 1).all() and ((scored.score > 0.5) == (scored.label == 1)).mean() > 0.85
