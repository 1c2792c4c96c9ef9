"""Drift of scores over time: the share of rows per score bin in each window against a baseline, on a stream or a table.

A row belongs to the window of its event time, unless it arrives more than `delay` later: then its window is closed, and it is counted as late in
the window in which it arrives. Either way the time it is placed by is at most `delay` before its arrival, so a watermark of that length never
drops a row of a stream that is in order of arrival; `disorder` is added for streams that are not. State is one row per window and group, whatever
the number of rows, as every bin is a partial sum. A stream and a table give the same rows; the stream leaves out the windows still open.

A row without an event time counts as late, one without an arrival as on time, one with neither is in no window. A missing score is counted in
`unscored` and is in no bin. Repeated rows count as often as they come. An empty table gives no window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farol.functions.columns import col
from farol.functions.quantiles import quantile_values

#: Population stability from which a window counts as shifted and as drifted, and what is added to every bin, so that an empty one has a share.
SHIFTED, DRIFTED, ADDED = 0.10, 0.25, 0.5


@dataclass(frozen=True)
class Baseline:
    """Inner edges of the score bins and the baseline's rows per bin: two short lists."""

    edges: tuple[float, ...]
    rows: tuple[int, ...]

    @property
    def shares(self) -> list[float]:
        return [(n + ADDED) / (sum(self.rows) + ADDED * len(self.rows)) for n in self.rows]


def _known(score: str) -> Column:
    return F.nanvl(col(score).cast("double"), F.lit(None).cast("double"))


def _bins(score: Column, edges: Sequence[float]) -> list[Column]:
    """Rows per bin, a bin being the number of edges strictly below the score."""
    place = reduce(lambda a, b: a + b, [(score > F.lit(e)).cast("int") for e in edges], F.lit(0))
    return [F.count(F.when(score.isNotNull() & (place == i), True)) for i in range(len(edges) + 1)]


def baseline(scored: DataFrame, bins: int = 10, score: str = "score") -> Baseline:
    """Bins of about equal size of the scores a model was accepted with; fewer if scores repeat."""
    table = scored.select(_known(score).alias("score"))
    edges = tuple(sorted({e for e in quantile_values(table, ["score"], [i / bins for i in range(1, bins)])["score"] if e is not None}))
    return Baseline(edges, tuple(table.agg(*_bins(F.col("score"), edges)).first()))


def drift(scored: DataFrame, against: Baseline, threshold: float, width: str = "1 day", delay: int = 7200, disorder: int = 0, time: str = "time",
          arrival: str = "arrival", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """(window_start, window_end, by..., n, late, unscored, mean_score, alarm_rate, stability, distance, state) per window and group.

    `stability` is the population stability index, `distance` the largest gap between the two distributions at an edge; both are NULL, as are
    the rates, in a window without a scored row on time. `delay` and `disorder` are seconds.
    """
    late = col(time).isNull() | F.coalesce(col(arrival) > col(time) + F.make_dt_interval(secs=F.lit(delay)), F.lit(False))
    rows = scored.select(F.when(late, col(arrival)).otherwise(col(time)).alias("_at"), late.alias("_late"), _known(score).alias("_score"), *map(col, by))
    seen = F.when(~F.col("_late"), F.col("_score"))
    per_bin = _bins(seen, against.edges)
    counted = rows.withWatermark("_at", f"{delay + disorder} seconds").groupBy(F.window("_at", width).alias("_window"), *map(col, by)).agg(
        F.count(F.when(~F.col("_late"), True)).alias("n"), F.count(F.when(F.col("_late"), True)).alias("late"),
        F.count(F.when(~F.col("_late") & F.col("_score").isNull(), True)).alias("unscored"), F.avg(seen).alias("mean_score"),
        F.avg((seen >= F.lit(float(threshold))).cast("int")).alias("alarm_rate"), F.array(*per_bin).alias("_rows"))
    scored_rows, k = F.col("n") - F.col("unscored"), len(per_bin)
    shares = [(F.col("_rows")[i] + F.lit(ADDED)) / (scored_rows + F.lit(ADDED * k)) for i in range(k)]
    gaps = [share - F.lit(e) for share, e in zip(shares, against.shares)]
    upto = [reduce(lambda a, b: a + b, gaps[:i]) for i in range(1, k + 1)]
    stability = reduce(lambda a, b: a + b, [gap * F.log(share / F.lit(e)) for gap, share, e in zip(gaps, shares, against.shares)])
    distance = F.greatest(*map(F.abs, upto), F.lit(0.0))
    table = counted.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *map(col, by), "n", "late", "unscored", "mean_score", "alarm_rate",
        F.when(scored_rows > 0, stability).alias("stability"), F.when(scored_rows > 0, distance).alias("distance"))
    return table.withColumn("state", F.when(F.col("stability") >= DRIFTED, "drifted").when(F.col("stability") >= SHIFTED, "shifted").when(F.col("stability").isNotNull(), "stable"))


def stream_drift(table: DataFrame, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append each window of a streaming `drift` table, once, when the watermark closes it."""
    writer = table.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
