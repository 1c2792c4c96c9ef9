"""The decision step: the highest threshold that still guarantees a required recall, and the triage bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import checked, half_even, ratio, unusable_rows
from farol.functions.running import running_sums

PLACES = 6
RANGES = 1024


def candidate_grid(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """H1: the distinct scores rounded half to even to six places, with 0 and 1."""
    rounded = scores.select(*by, half_even(F.col("score"), PLACES).alias("threshold")).distinct()
    ends = scores.select(*by).distinct().select(*by, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("threshold"))
    return rounded.unionByName(ends).distinct()


def threshold_sweep(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """H2: recall, precision, F1, specificity and alarms per cent at every candidate threshold.

    Raw scores are compared with rounded thresholds, so a score rounded up falls below its own
    threshold. Rounding moves a score by half a grid step at most, so a score is at or above every
    lower candidate and its own candidate decides by one comparison: the sweep is a running sum over
    candidates. Candidates lie 1e-6 apart, which bounds a range of 1/1024 to 977 of them.
    """
    clean = scores.select(*by, F.col("label").cast("bigint").alias("label"), F.col("score").cast("double").alias("score"))
    own = half_even(F.col("score"), PLACES)
    reaches = F.col("score") >= own
    positive, negative = F.col("label"), F.lit(1) - F.col("label")
    points = clean.groupBy(*by, own.alias("threshold")).agg(
        unusable_rows(), F.sum(positive).alias("pos"), F.sum(negative).alias("neg"),
        F.sum(F.when(reaches, 0).otherwise(positive)).alias("pos_below"),
        F.sum(F.when(reaches, 0).otherwise(negative)).alias("neg_below"))
    zero = F.lit(0).cast("bigint")
    points = checked(points, "pos")
    ends = clean.select(*by).distinct().select(*by, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("threshold")).select(
        *by, "threshold", zero.alias("pos"), zero.alias("neg"), zero.alias("pos_below"), zero.alias("neg_below"))
    grid = points.unionByName(ends).groupBy(*by, "threshold").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "pos_below", "neg_below")])
    ranged = grid.withColumn("__range", F.floor(F.col("threshold") * RANGES))
    summed = running_sums(ranged, by, "threshold", ["pos", "neg"])
    tp, fp = F.col("run_pos") - F.col("pos_below"), F.col("run_neg") - F.col("neg_below")
    n = F.col("all_pos") + F.col("all_neg")
    return summed.select(
        *by, "threshold", ratio(tp, F.col("all_pos")).alias("recall"), ratio(tp, tp + fp).alias("precision"),
        ratio(2.0 * tp, tp + fp + F.col("all_pos")).alias("f1"),
        ((F.col("all_neg") - fp).cast("double") / F.greatest(F.col("all_neg"), F.lit(1))).alias("specificity"),
        (F.lit(100.0) * (tp + fp) / n).alias("alarmes_%"), tp.alias("tp"), fp.alias("fp"))


def choose_threshold(sweep: DataFrame, target_recall: float = words.TARGET_RECALL, by: Sequence[str] = ("model",)) -> DataFrame:
    """H3: the largest threshold that reaches the recall; if none does, the lowest one of maximum recall."""
    row = F.struct("threshold", "recall", "precision", "f1", "specificity", F.col("`alarmes_%`"), "tp", "fp")
    reached = F.max_by(F.when(F.col("recall") >= target_recall, row), F.when(F.col("recall") >= target_recall, F.col("threshold")))
    fallback = F.max_by(row, F.struct(F.col("recall"), -F.col("threshold")))
    best = sweep.groupBy(*by).agg(reached.alias("__hit"), fallback.alias("__most"))
    return best.select(*by, F.lit(float(target_recall)).alias("target_recall"), F.col("__hit").isNotNull().alias("reached"),
                       F.coalesce("__hit", "__most").alias("__best")).select(*by, "target_recall", "reached", "__best.*")


def tune_threshold(scores: DataFrame, target_recall: float = words.TARGET_RECALL, by: Sequence[str] = ("model",)) -> DataFrame:
    """H1 to H3 on a score table."""
    return choose_threshold(threshold_sweep(scores, by), target_recall, by)


def band(score: Column, low: float | Column, high: float | Column = words.HIGH_RISK, upper: bool = False) -> Column:
    """H4: red at or above `high`, amber at or above `low`, else green; NULL for a missing score."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    names = {k: (v.upper() if upper else v) for k, v in words.BANDS.items()}
    known = score.isNotNull() & ~F.isnan(score)
    return F.when(known & (score >= high), names["red"]).when(known & (score >= low), names["amber"]).when(known, names["green"])


def with_band(scores: DataFrame, low: float | Column, high: float | Column = words.HIGH_RISK, name: str = "faixa_triagem") -> DataFrame:
    return scores.withColumn(name, band(F.col("score"), low, high))


def band_counts(banded: DataFrame, name: str = "faixa_triagem", by: Sequence[str] = ()) -> DataFrame:
    """H5: rows per band, most frequent first."""
    return banded.groupBy(*by, name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)
