"""Running sums over a whole table without a single-task window.

A window without `partitionBy` sorts everything in one task. Here the order key is cut into
ranges by literal edges, the running sum is taken inside each range, and the totals of the
ranges before it are joined on. The range is a function of the key, so equal keys stay
together and a retried task sees the same ranges. Edges come from an approximate quantile
sketch: they decide only how evenly the work is spread, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


RANGE = "__range"


def range_count(df: DataFrame) -> int:
    """How many ranges to cut: a few per shuffle partition, so it grows with the cluster."""
    return max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def balanced_edges(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """At most `ranges` - 1 literal edges that cut `column` into parts of similar size, whatever the table's size; none for an empty one. Runs one job."""
    return balanced_edges_of(df, [column], ranges)[column]


def balanced_edges_of(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> dict[str, list[float]]:
    """The edges of several columns by one job."""
    ranges = ranges or range_count(df)
    probabilities = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    row = df.agg(*[F.approx_percentile(F.col(c), probabilities, 4 * ranges).alias(c) for c in columns]).first()
    return {c: sorted({e for e in row[c] or [] if math.isfinite(e)}) for c in columns}


def with_range(df: DataFrame, column: str, edges: Sequence[float], name: str = RANGE) -> DataFrame:
    """Number the range of each value; a range is closed on the left, ties fall together. Without edges no number is added."""
    if not edges:
        return df
    splits = [float("-inf"), *edges, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)
    return ranged.withColumn(name, F.col(name).cast("int"))


def running_sums(points: DataFrame, by: Sequence[str], order: str, values: Sequence[str], range_col: str = RANGE,
                 descending: bool = True) -> DataFrame:
    """Add `run_<v>` (inclusive running sum) and `all_<v>` (group total) for each value column.

    `points` holds one row per (by, order) and the range of `order`; without a range column the table
    is small and one window does. The totals are joined on the same keys the window is partitioned by,
    so no side has to be broadcast.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    if range_col not in points.columns:
        upto = Window.partitionBy(*by).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
        return points.withColumns({f"run_{v}": F.sum(v).over(upto) for v in values}
                                  | {f"all_{v}": F.sum(v).over(Window.partitionBy(*by)) for v in values})
    keys = [*by, range_col]
    inside = Window.partitionBy(*keys).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(direction(range_col)).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    totals = points.groupBy(*keys).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in values],
        *[F.sum(f"__t_{v}").over(group).alias(f"all_{v}") for v in values])
    local = points.withColumns({f"__l_{v}": F.sum(v).over(inside) for v in values})
    joined = local.join(offsets, keys)
    out = joined.withColumns({f"run_{v}": F.col(f"__l_{v}") + F.col(f"__o_{v}") for v in values})
    return out.drop(*[f"__l_{v}" for v in values], *[f"__o_{v}" for v in values])


def next_in_order(points: DataFrame, by: Sequence[str], order: str, values: Sequence[str], range_col: str = RANGE,
                  descending: bool = True) -> DataFrame:
    """Add `next_<v>` and `prev_<order>`: the neighbours of a row in the whole order, across range borders."""
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    if range_col not in points.columns:
        whole = Window.partitionBy(*by).orderBy(direction(order))
        return points.withColumns({f"next_{v}": F.lead(v).over(whole) for v in values} | {f"prev_{order}": F.lag(order).over(whole)})
    keys = [*by, range_col]
    inside = Window.partitionBy(*keys).orderBy(direction(order))
    across = Window.partitionBy(*by).orderBy(direction(range_col))
    pick_first, pick_last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    heads = points.groupBy(*keys).agg(
        *[pick_first(v, order).alias(f"__h_{v}") for v in values], pick_last(order, order).alias("__tail"))
    borders = heads.select(
        *keys, *[F.lead(f"__h_{v}").over(across).alias(f"__n_{v}") for v in values],
        F.lag("__tail").over(across).alias("__p"))
    local = points.withColumns({f"__i_{v}": F.lead(v).over(inside) for v in values} | {"__q": F.lag(order).over(inside)})
    joined = local.join(borders, keys)
    out = joined.withColumns({f"next_{v}": F.coalesce(F.col(f"__i_{v}"), F.col(f"__n_{v}")) for v in values}
                             | {f"prev_{order}": F.coalesce(F.col("__q"), F.col("__p"))})
    return out.drop("__q", "__p", *[f"__i_{v}" for v in values], *[f"__n_{v}" for v in values])


def tie_edges_of(df: DataFrame, columns: Sequence[str], ranges: int) -> dict[str, tuple[list[float], list[float]]]:
    """(edges, tied values) of several columns by one job: a value that fills a range of its own lies alone between two edges.

    Such a value is met by two or more of the quantiles; every other value holds less than two ranges' worth of rows.
    """
    probabilities = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    row = df.agg(*[F.approx_percentile(F.col(c), probabilities, 4 * ranges).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        met = [e for e in row[c] or [] if math.isfinite(e)]
        tied = sorted({e for e, after in zip(met, met[1:]) if e == after})
        out[c] = (sorted({*met, *(math.nextafter(e, math.inf) for e in tied)} - {math.inf}), tied)
    return out


def average_ranks(cells: DataFrame, by: str, row: str, value: str) -> DataFrame:
    """Add `rank`, the ascending average rank of every row's `value` among the rows of its `by`, without a join by value.

    `cells` holds RANGE and `tied`, true where a range holds one value only. Ranks inside a range come from one sort; the rows before the
    range are carried over by a broadcast table of a row per (by, range), which the caller bounds. A tied range needs no order, so its rows
    are spread by `row`.
    """
    totals = cells.groupBy(by, RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__o", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    salt = F.when(F.col("tied"), F.pmod(F.xxhash64(row), F.lit(range_count(cells)))).otherwise(F.lit(0))
    inside = Window.partitionBy(by, RANGE, "__salt").orderBy(value)
    ties = F.count(F.lit(1)).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    placed = cells.withColumn("__salt", salt).withColumns({"__first": F.rank().over(inside), "__ties": ties}).join(F.broadcast(offsets), [by, RANGE])
    local = F.when(F.col("tied"), (F.col("__n") + 1) / F.lit(2.0)).otherwise(F.col("__first") + (F.col("__ties") - 1) / F.lit(2.0))
    return placed.withColumn("rank", F.col("__o") + local).drop("__salt", "__first", "__ties", "__o", "__n")
