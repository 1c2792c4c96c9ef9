"""The shared kernels against plain numpy and pandas on data with ties, gaps and skew."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farol.functions.columns import half_even
from farol.functions.keys import keyed_int
from farol.functions.moments import correlation_of, pair_moments
from farol.functions.quantiles import quantile_rows, quantile_values
from farol.functions.running import average_ranks, balanced_edges, next_in_order, running_sums, tie_edges_of, with_range
from farol.functions.strata import cut_keys, largest_remainder, with_slices


def table(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def test_keyed_int_is_the_leading_md5_digits(spark):
    got = [r[0] for r in spark.range(5).select(keyed_int("salt", F.col("id"))).collect()]
    assert got == [int(hashlib.md5(f"salt|{i}".encode()).hexdigest()[:8], 16) for i in range(5)]


def test_half_even_equals_numpy(spark):
    x = np.r_[np.random.default_rng(1).random(500), [0.1234565, 0.1234575, 0.0000005, 0.9999995]]
    got = [r[0] for r in table(spark, i=range(len(x)), x=x).orderBy("i").select(half_even(F.col("x"), 6)).collect()]
    assert got == np.round(x, 6).tolist()


def hot(rng, n):
    """A third of the rows share one value, a third lie in a tiny interval, the rest are spread."""
    return np.r_[np.full(n // 3, 0.25), 0.5 + rng.random(n // 3) * 1e-7, rng.random(n - 2 * (n // 3)).round(3)]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("edges", [[], [0.5], "balanced"])
def test_running_sums(spark, descending, edges):
    rng = np.random.default_rng(2)
    x = hot(rng, 600)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], len(x)), "x": x, "v": rng.integers(0, 5, len(x))}).groupby(["g", "x"], as_index=False).sum()
    df = spark.createDataFrame(pdf)
    points = with_range(df, "x", balanced_edges(df, "x", 16) if edges == "balanced" else edges)
    got = running_sums(points, ["g"], "x", ["v"], descending=descending).toPandas().sort_values(["g", "x"]).reset_index(drop=True)
    want = pdf.sort_values(["g", "x"], ascending=[True, not descending])
    want["run_v"] = want.groupby("g")["v"].cumsum()
    want = want.sort_values(["g", "x"]).reset_index(drop=True)
    assert got["run_v"].tolist() == want["run_v"].tolist()
    assert got["all_v"].tolist() == want.groupby("g")["v"].transform("sum").tolist()


@pytest.mark.parametrize("edges", [[], [0.2, 0.21, 0.5, 0.9]])
def test_neighbours_in_order_cross_range_borders(spark, edges):
    x = np.arange(1, 30) / 30
    df = with_range(table(spark, g=["a"] * 29, x=x, v=range(29)), "x", edges)
    got = next_in_order(df, ["g"], "x", ["v"]).orderBy(F.desc("x")).toPandas()
    assert got["next_v"].tolist()[:-1] == list(range(27, -1, -1)) and np.isnan(got["next_v"].tolist()[-1])
    assert got["prev_x"].tolist()[1:] == sorted(x, reverse=True)[:-1]


def test_balanced_edges_bound_every_range(spark):
    x = hot(np.random.default_rng(3), 6000)
    df = table(spark, x=x)
    distinct = with_range(df, "x", balanced_edges(df, "x", 32)).groupBy("__range").agg(F.count_distinct("x").alias("n"))
    assert distinct.agg(F.max("n")).first()[0] < 6000 / 32 * 3


@pytest.mark.parametrize("ranges", [8, 32])
def test_average_ranks(spark, ranges):
    """Clumps, a value that a third of the rows share, its neighbours, both zeros and infinities; two groups in one call."""
    rng = np.random.default_rng(4)
    x = np.concatenate([hot(rng, 3000), np.full(1500, 0.25), [np.nextafter(0.25, 1), np.nextafter(0.25, 0), 0.0, -0.0, np.inf, -np.inf]]) + 0.0
    pdf = pd.DataFrame({"id": range(len(x)), "g": np.arange(len(x)) % 3 == 0, "x": x})
    df = spark.createDataFrame(pdf)
    edges, tied = tie_edges_of(df, ["x"], ranges)["x"]
    assert 0.25 in tied
    cells = with_range(df, "x", edges).withColumn("tied", F.col("x").isin(tied))
    assert cells.where("tied").groupBy("__range").agg(F.count_distinct("x").alias("n")).where("n > 1").count() == 0
    got = average_ranks(cells, "g", "id", "x").toPandas().set_index("id")["rank"].sort_index()
    assert np.array_equal(got.to_numpy(), pdf.groupby("g")["x"].rank().to_numpy())
    assert average_ranks(cells.where("id < 0"), "g", "id", "x").count() == 0


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    ps = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    x, y = hot(rng, 5000), np.exp(rng.normal(size=5000) * 3)
    y[::10] = np.nan
    df = table(spark, x=x, y=y).withColumn("y", F.nanvl("y", F.lit(None))).withColumn("none", F.lit(None).cast("double"))
    got = quantile_values(df, ["x", "y", "none"], ps)
    assert np.allclose(got["x"], np.quantile(x, ps), rtol=0, atol=1e-12)
    assert np.allclose(got["y"], np.nanquantile(y, ps), rtol=1e-12)
    assert got["none"] == [None] * len(ps)


def test_quantiles_of_groups_equal_the_built_in(spark):
    rng = np.random.default_rng(6)
    g = rng.choice(["a", "b", "c", "rare"], 4000, p=[0.6, 0.3, 0.099, 0.001])
    df = table(spark, g=g, x=rng.normal(size=4000), y=np.round(rng.normal(size=4000), 1))
    df = df.withColumn("g", F.when(F.col("g") != "c", F.col("g"))).withColumn("x", F.when(F.col("g").eqNullSafe("rare"), None).otherwise(F.col("x")))
    df = df.withColumn("y", F.when(F.col("y") > 2.5, float("inf")).otherwise(F.col("y")))
    ps = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["g"], r["feature"]): list(r)[2:] for r in quantile_rows(df, ["x", "y"], ps, by="g").collect()}
    want = df.groupBy("g").agg(*[F.percentile(c, F.array(*map(F.lit, ps))).alias(c) for c in ("x", "y")]).collect()
    assert len(got) == 2 * len(want)
    for r in want:
        for c in ("x", "y"):
            assert got[r["g"], c] == (r[c] or [None] * len(ps))


def test_quantiles_of_an_empty_table_and_the_number_of_jobs(spark):
    empty = spark.createDataFrame([], "g string, x double, y double")
    assert quantile_values(empty, ["x", "y"], [0.5]) == {"x": [None], "y": [None]}
    assert quantile_rows(empty, ["x"], [0.5], by="g").collect() == []
    wide = spark.range(2000).select(*[(F.col("id") * i % 97).cast("double").alias(f"c{i}") for i in range(1, 31)])
    spark.sparkContext.setJobGroup("quantiles", "count the actions")
    try:
        rows = quantile_rows(wide, wide.columns, [0.25, 0.5, 0.75])
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert before <= 12 and rows.count() == 30


def test_pair_moments_match_pandas(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 6)) + 1e6
    x[:, 5] = x[:, 0] * 2 + rng.normal(size=500) * 0.01
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 4] = 3.0
    pdf = pd.DataFrame(x, columns=list("abcdef"))
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    want = pdf.corr().to_numpy()
    for r in correlation_of(pair_moments(df, list("abcdef"))).collect():
        w = want[r["i"], r["j"]]
        assert (r["r"] is None) if np.isnan(w) else abs(r["r"] - w) < 1e-9
        assert r["n"] == (pdf.iloc[:, r["i"]].notna() & pdf.iloc[:, r["j"]].notna()).sum()


def test_slices_follow_the_hash_order(spark):
    df = spark.range(1000).withColumn("c", (F.col("id") % 3 == 0).cast("int"))
    order = lambda i: (hashlib.md5(f"s|{i}".encode()).hexdigest(), i)
    got = {r["id"]: r["slot"] for r in with_slices(df, "c", "id", "s", {0: [100, 0, 50], 1: [1]}, "slot").collect()}
    for c, sizes in ((0, [100, 0, 50]), (1, [1])):
        ids = sorted((i for i in range(1000) if (i % 3 == 0) == bool(c)), key=order)
        ends = np.cumsum(sizes)
        assert [got[i] for i in ids] == [int((ends <= place).sum()) for place in range(len(ids))]


def test_cut_keys_of_empty_request(spark):
    assert cut_keys(spark.range(3).withColumn("c", F.lit(1)), "c", "id", "s", {1: [0]}) == {}


def test_largest_remainder_sums_up():
    assert largest_remainder({"B": 357, "M": 212}, 455) == {"B": 285, "M": 170}
    assert sum(largest_remainder({0: 1, 1: 1, 2: 1}, 2).values()) == 2
