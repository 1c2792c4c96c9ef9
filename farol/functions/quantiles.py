"""Exact interpolated quantiles of many columns and groups in two scans, whatever the size of the table.

1. One aggregate of mergeable sketches, per group and column, brackets every wanted rank by two values.
2. One scan counts the values between the brackets and collapses those inside to (value, count); only those are ranked, each
   bracket on its own. They are a thousandth of the values or so per wanted rank.

The brackets are several times as wide as the sketch's error. A rank outside its bracket would fail the job, never return a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from farol.functions.columns import col

#: Size of a sketch; half the width of a bracket in ranks, four times the sketch's error of 0.036 per cent; values up to which a bracket is everything.
SKETCH, MARGIN, FEW = 8192, 0.0015, 8192


def quantile_name(p: float) -> str:
    return f"q{format(p * 100, 'g').replace('.', '_')}"


def _brackets(wide: DataFrame, names: Sequence[str], probabilities: Sequence[float]) -> list[tuple]:
    """(__by, [low, high of each probability] per column) of every group, None for a column without a value. One job."""
    sketched = wide.groupBy("__by").agg(*[a for n in names for a in (
        F.kll_sketch_agg_double(n, F.lit(SKETCH)).alias(n), F.count(n).alias(f"{n}_n"))])

    def ends(n: str) -> Column:
        few, none = F.col(f"{n}_n") <= FEW, F.col(f"{n}_n") == 0
        low = [F.when(few, F.lit(float("-inf"))).otherwise(F.kll_sketch_get_quantile_double(n, F.lit(max(0.0, p - MARGIN)))) for p in probabilities]
        high = [F.when(few, F.lit(float("inf"))).otherwise(F.kll_sketch_get_quantile_double(n, F.lit(min(1.0, p + MARGIN)))) for p in probabilities]
        return F.when(~none, F.array(*[e for both in zip(low, high) for e in both]))

    return [tuple(r) for r in sketched.select("__by", *[ends(n).alias(n) for n in names]).collect()]


def quantile_rows(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: str | None = None) -> DataFrame:
    """(by, feature, q<percent>...) with numpy-style linear interpolation; NULL without a value. NaN counts as missing.

    Runs the sketch job; two numbers per group, column and probability come to the driver.
    """
    spark, columns, names = df.sparkSession, list(columns), [f"__c{i}" for i in range(len(columns))]
    by_column = (col(by) if by else F.lit(0)).alias("__by")
    wide = df.select(by_column, *[F.nanvl(col(c).cast("double"), F.lit(None).cast("double")).alias(n) for c, n in zip(columns, names)])
    sorted_places = sorted(range(len(probabilities)), key=lambda j: probabilities[j])
    wanted = [float(probabilities[j]) for j in sorted_places]
    found = _brackets(wide, names, wanted) or ([] if by else [(0, *[None] * len(names))])
    schema = T.StructType([wide.schema["__by"], *[T.StructField(f"e{i}", T.ArrayType(T.DoubleType())) for i in range(len(names))]])
    brackets = spark.createDataFrame(found, schema)
    if by:
        ranged = wide.alias("w").join(brackets.withColumnRenamed("__by", "__g"), F.col("w.__by").eqNullSafe(F.col("__g")))
        edge = lambda i, j: F.col(f"e{i}")[j]
    else:
        ranged = wide
        edge = lambda i, j: F.lit(found[0][1 + i][j] if found[0][1 + i] else None).cast("double")

    def cell(i: int) -> Column:
        """A value's bracket, the first one that doesn't end below it, and the value itself if it lies inside."""
        x, m = F.col(names[i]), len(wanted)
        slot = reduce(lambda a, b: a + b, [(edge(i, 2 * j + 1) < x).cast("int") for j in range(m)])
        inside = reduce(lambda a, b: a | b, [(x >= edge(i, 2 * j)) & (x <= edge(i, 2 * j + 1)) for j in range(m)])
        return F.struct(F.lit(i).alias("k"), slot.alias("slot"), F.when(inside, x).alias("value"), x.isNotNull().alias("known"))

    cells = ranged.select("__by", F.explode(F.array(*[cell(i) for i in range(len(names))])).alias("cell")).where("cell.known")
    points = cells.groupBy("__by", "cell.k", "cell.slot", "cell.value").agg(F.count(F.lit(1)).alias("n"))
    ranks = _wanted_ranks(points, wanted).alias("w")
    upto = F.sum("n").over(Window.partitionBy("__by", "k", "slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = points.where("value IS NOT NULL").withColumn("upto", upto).alias("v")
    met = (F.col("v.__by").eqNullSafe(F.col("w.__by")) & (F.col("v.k") == F.col("w.k")) & (F.col("v.slot") == F.col("w.slot"))
           & (F.col("w.rank") >= F.col("v.upto") - F.col("v.n")) & (F.col("w.rank") < F.col("v.upto")))
    at = lambda j, side, c: F.max(F.when((F.col("p") == j) & (F.col("side") == side), F.col(c)))
    ends = ranked.join(ranks, met).select("w.__by", "w.k", "w.p", "w.side", "w.place", "v.value").groupBy("__by", "k").agg(
        *[a for j in range(len(wanted)) for a in (at(j, 0, "value").alias(f"a{j}"), at(j, 1, "value").alias(f"b{j}"), at(j, 0, "place").alias(f"t{j}"))]).alias("e")
    every = [(r[0], i, bool(r[1 + i])) for r in found for i in range(len(names))]
    keys = spark.createDataFrame(every, T.StructType([wide.schema["__by"], T.StructField("k", T.IntegerType()), T.StructField("known", T.BooleanType())])).alias("s")
    whole = keys.join(ends, F.col("s.__by").eqNullSafe(F.col("e.__by")) & (F.col("s.k") == F.col("e.k")), "left")
    feature = F.array(*[F.lit(c) for c in columns])[F.col("s.k")].alias("feature")
    missed = F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")

    def value(j: int) -> Column:
        both = F.col(f"a{j}").isNotNull() & F.col(f"b{j}").isNotNull()
        return F.when(both, _between(f"a{j}", f"b{j}", f"t{j}")).when(F.col("s.known"), missed)

    place = {j: i for i, j in enumerate(sorted_places)}
    return whole.select(*([F.col("s.__by").alias(by)] if by else []), feature,
                        *[value(place[j]).alias(quantile_name(p)) for j, p in enumerate(probabilities)])


def _wanted_ranks(points: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(__by, k, slot, p, side, place, rank): each probability's lower and upper 0-based rank, counted from the start of its bracket."""
    group = Window.partitionBy("__by", "k")
    totals = points.groupBy("__by", "k", "slot").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("outside"))
    upto = F.sum("n").over(group.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    placed = totals.withColumns({"start": upto - F.col("n") + F.col("outside"), "end": upto, "all": F.sum("n").over(group)})
    places = F.explode(F.array(*[F.struct(F.lit(j).alias("p"), F.lit(s).alias("side"), ((F.col("all") - 1) * F.lit(p)).alias("place"))
                                 for j, p in enumerate(probabilities) for s in (0, 1)]))
    ranks = placed.select("__by", "k", "slot", "start", "end", places.alias("x")).select("__by", "k", "slot", "start", "end", "x.*")
    at = F.when(F.col("side") == 0, F.floor("place")).otherwise(F.ceil("place"))
    return ranks.where((at >= F.col("start")) & (at < F.col("end"))).select("__by", "k", "slot", "p", "side", "place", (at - F.col("start")).alias("rank"))


def _between(a: str, b: str, place: str):
    low, high, t = F.col(a), F.col(b), F.col(place)
    return F.when(low == high, low).otherwise((F.ceil(t) - t) * low + (t - F.floor(t)) * high)


def quantile_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """The same numbers on the driver: one short list per column, for fitting."""
    return {r["feature"]: [r[quantile_name(p)] for p in probabilities] for r in quantile_rows(df, columns, probabilities).collect()}
