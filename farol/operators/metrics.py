"""Metrics and curves of scores against a 0/1 label.

Input is the long score table (model, id, label, score); every operator is grouped by `by`, so one
job evaluates all models. A row is predicted positive when `score >= threshold`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from farol import vocabulary as words
from farol.functions.columns import checked, col, ratio, structs_to_rows, unusable_rows
from farol.functions.quantiles import quantile_name, quantile_rows
from farol.functions.running import RANGE, balanced_edges, next_in_order, running_sums, with_range

MODEL = ("model",)
LOG_LOSS_CLIP = 1e-15
#: Scores that a task sorts and packs at a time.
PACK = 1 << 20

# Order and names of the columns of the metrics table.
TABLE_COLUMNS = ("recall", "f1", "precision", "specificity", "accuracy", "balanced_accuracy", "roc_auc", "pr_auc", "mcc",
                 "brier", "threshold", "tp", "fn", "fp", "tn")
COUNT_COLUMNS = ("tp", "fn", "fp", "tn", "n")


def _typed(scores: DataFrame) -> DataFrame:
    return scores.withColumns({"label": F.col("label").cast("bigint"), "score": F.col("score").cast("double")})


def confusion_counts(scores: DataFrame, thresholds: Sequence[float] = (words.DEFAULT_THRESHOLD,),
                     by: Sequence[str] = MODEL) -> DataFrame:
    """V1: tn, fp, fn, tp and n per model and threshold, from one pass with map-side sums."""
    alarm = [F.col("score") >= F.lit(float(t)) for t in thresholds]
    positive = F.col("label") == 1
    counts = [unusable_rows(), F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("__pos")]
    for i, a in enumerate(alarm):
        counts += [F.count_if(a & positive).alias(f"__tp{i}"), F.count_if(a & ~positive).alias(f"__fp{i}")]
    row = checked(_typed(scores).groupBy(*by).agg(*counts), "n")
    cells = [F.struct(F.lit(float(t)).alias("threshold"),
                      (F.col("n") - F.col("__pos") - F.col(f"__fp{i}")).alias("tn"), F.col(f"__fp{i}").alias("fp"),
                      (F.col("__pos") - F.col(f"__tp{i}")).alias("fn"), F.col(f"__tp{i}").alias("tp"))
             for i, t in enumerate(thresholds)]
    return structs_to_rows(row, cells)


def with_rates(counts: DataFrame) -> DataFrame:
    """V2 to V8: rates from the four counts. Products are taken in double: they overflow a bigint at scale."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    recall, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    one_class = F.when((tp + fn) == 0, specificity).when((tn + fp) == 0, recall)
    margins = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return counts.withColumns({
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "balanced_accuracy": F.coalesce(one_class, (recall + specificity) / 2.0),
        "precision": ratio(tp, tp + fp), "recall": recall, "specificity": specificity,
        "f1": ratio(2.0 * tp, 2.0 * tp + fp + fn),
        "mcc": ratio(tp * tn - fp * fn, margins)})


def threshold_metrics(scores: DataFrame, thresholds: Sequence[float] = (words.DEFAULT_THRESHOLD,),
                      by: Sequence[str] = MODEL) -> DataFrame:
    """V1 to V8 per model and threshold."""
    return with_rates(confusion_counts(scores, thresholds, by))


def score_points(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """One row per distinct score with its positives and negatives: ties collapse before the shuffle."""
    points = _typed(scores).groupBy(*by, "score").agg(
        unusable_rows(), F.sum("label").alias("pos"), F.sum(F.lit(1) - F.col("label")).alias("neg"))
    return checked(points, "pos")


def ranked_points(scores: DataFrame, by: Sequence[str] = MODEL, edges: Sequence[float] | None = None) -> DataFrame:
    """Score points with `tp`, `fp` at or above the score and class totals.

    Runs one sketch job for the range edges unless they are given: edges of similar scores do as well, as they only spread the work.
    """
    points = with_range(score_points(scores, by), "score", balanced_edges(scores, "score") if edges is None else edges)
    summed = running_sums(points, by, "score", ["pos", "neg"])
    return summed.withColumnsRenamed({"run_pos": "tp", "run_neg": "fp", "all_pos": "positives", "all_neg": "negatives"})


def _auc_term() -> Column:
    return F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0)


def _precision_step() -> Column:
    return F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")).cast("double"))


def ranking_metrics(points: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """V9 and V10 from ranked points: ROC AUC (ties count half), NULL with one class only, and average precision, NULL without positives."""
    sums = points.groupBy(*by).agg(F.sum(_auc_term()).alias("area"), F.sum(_precision_step()).alias("steps"),
                                   F.max("positives").alias("p"), F.max("negatives").alias("q"))
    both = (F.col("p") > 0) & (F.col("q") > 0)
    pairs = F.col("p").cast("double") * F.col("q").cast("double")
    return sums.select(*by, F.when(both, F.col("area") / pairs).alias("roc_auc"),
                       F.when(F.col("p") > 0, F.col("steps") / F.col("p")).alias("pr_auc"))


def roc_auc(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """V9."""
    return ranking_metrics(ranked_points(scores, by), by).select(*by, "roc_auc")


def average_precision(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """The step sum, not the trapezoid area."""
    return ranking_metrics(ranked_points(scores, by), by).select(*by, "pr_auc")


def brier(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """Mean squared distance of score and label."""
    squares = F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier")
    return checked(_typed(scores).groupBy(*by).agg(unusable_rows(), squares), "brier")


def log_loss(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """Mean cross entropy; scores are kept off 0 and 1."""
    p = F.greatest(F.lit(LOG_LOSS_CLIP), F.least(F.lit(1.0 - LOG_LOSS_CLIP), F.col("score")))
    loss = F.when(F.col("label") == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))
    return checked(_typed(scores).groupBy(*by).agg(unusable_rows(), F.avg(loss).alias("log_loss")), "log_loss")


def compute_metrics(scores: DataFrame, thresholds: Sequence[float] = (words.DEFAULT_THRESHOLD,),
                    by: Sequence[str] = MODEL, edges: Sequence[float] | None = None) -> DataFrame:
    """V1 to V11 per model and threshold: everything is a sum over the ranked score points, so the rows are read once."""
    return _metrics_of(ranked_points(scores, by, edges), thresholds, by)


def fold_metrics(scores: DataFrame, folds: Sequence[int], thresholds: Sequence[float] = (words.DEFAULT_THRESHOLD,),
                 by: Sequence[str] = MODEL, edges: Sequence[float] | None = None, fold: str = "fold") -> DataFrame:
    """`compute_metrics` by (held, part) too: for each of `folds`, the rows of that fold as part `cv` and all others as `train`.

    A score point carries the counts of every fold, so that a row is shuffled and ranked once, not once per fold held out;
    points are dealt to the held-out folds behind the ranking, where they only add to sums.
    """
    by, folds = list(by), [int(f) for f in folds]
    edges = balanced_edges(scores, "score") if edges is None else edges
    counted = [F.sum(c).alias(f"{n}{f}") for f in folds for n, c in (
        ("pos", F.when(col(fold) == f, F.col("label")).otherwise(0)), ("neg", F.when(col(fold) == f, F.lit(1) - F.col("label")).otherwise(0)))]
    points = checked(_typed(scores).groupBy(*by, "score").agg(
        unusable_rows(), F.sum("label").alias("pos"), F.sum(F.lit(1) - F.col("label")).alias("neg"), *counted), "pos")
    values = ["pos", "neg", *[f"{n}{f}" for f in folds for n in ("pos", "neg")]]
    summed = running_sums(with_range(points, "score", edges), by, "score", values)
    names = {"pos": "pos", "neg": "neg", "run_pos": "tp", "run_neg": "fp", "all_pos": "positives", "all_neg": "negatives"}
    cells = [F.struct(F.lit(f).alias("held"), F.lit(part).alias("part"), *[
        (F.col(f"{c}{f}") if part == "cv" else F.col(c) - F.col(f"{c}{f}")).alias(n) for c, n in names.items()]) for f in folds for part in ("cv", "train")]
    dealt = summed.select(*by, "score", F.explode(F.array(*cells)).alias("__c")).select(*by, "score", "__c.*")
    return _metrics_of(dealt.where(F.col("pos") + F.col("neg") > 0), thresholds, [*by, "held", "part"])


def _metrics_of(points: DataFrame, thresholds: Sequence[float], by: Sequence[str]) -> DataFrame:
    """The metrics of ranked points."""
    s = F.col("score")
    sums = [F.sum(_auc_term()).alias("__area"), F.sum(_precision_step()).alias("__steps"),
            F.sum(F.col("pos") * F.pow(1.0 - s, 2) + F.col("neg") * F.pow(s, 2)).alias("__squares"),
            F.max("positives").alias("__p"), F.max("negatives").alias("__q")]
    for i, t in enumerate(thresholds):
        sums += [F.sum(F.when(s >= float(t), F.col("pos")).otherwise(0)).alias(f"__tp{i}"),
                 F.sum(F.when(s >= float(t), F.col("neg")).otherwise(0)).alias(f"__fp{i}")]
    return _metrics_row(points.groupBy(*by).agg(*sums), thresholds, by)


def _metrics_row(row: DataFrame, thresholds: Sequence[float], by: Sequence[str]) -> DataFrame:
    """The metrics from one row of sums per group."""
    p, q = F.col("__p"), F.col("__q")
    both = (p > 0) & (q > 0)
    shared = [F.when(both, F.col("__area") / (p.cast("double") * q.cast("double"))).alias("roc_auc"),
              F.when(p > 0, F.col("__steps") / p).alias("pr_auc"), (F.col("__squares") / (p + q)).alias("brier"), (p + q).alias("n")]
    cells = [F.struct(F.lit(float(t)).alias("threshold"), (q - F.col(f"__fp{i}")).alias("tn"), F.col(f"__fp{i}").alias("fp"),
                      (p - F.col(f"__tp{i}")).alias("fn"), F.col(f"__tp{i}").alias("tp"), *shared) for i, t in enumerate(thresholds)]
    return with_rates(structs_to_rows(row, cells)).select(
        *by, "threshold", "accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "mcc", "roc_auc", "pr_auc",
        "brier", "tn", "fp", "fn", "tp", "n")


# ---- many groups of scores ---------------------------------------------------------------------------

def packed_scores(scores: DataFrame, by: Sequence[str], edges: Sequence[float]) -> DataFrame:
    """(by, RANGE, label, scores, counts): a task's scores as sorted distinct doubles and how often each comes, a row per group, range and label.

    A million rows at a time are sorted and packed, so that a score is shuffled once, as eight bytes or so, and a score that comes
    very often is shuffled once for each of these. `counts` is empty where every score comes once.
    """
    by, cuts = list(by), np.asarray(edges, dtype=float)
    typed = _typed(scores).select(*map(col, by), "label", "score")

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        if table["label"].null_count or table["score"].null_count or np.isnan(score := table["score"].to_numpy()).any():
            raise ValueError("label and score must not be missing")
        group = np.zeros(len(score), dtype=np.int64)
        for c in by:
            coded = pc.dictionary_encode(table[c].combine_chunks(), null_encoding="encode")
            coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
            group = group * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
        place = np.searchsorted(cuts, score, side="right")
        group = (group * (len(cuts) + 1) + place) * 2 + (table["label"].to_numpy() == 1)
        order = np.argsort(group.astype(np.uint16) if group.max() < 1 << 16 else group, kind="stable")
        group, score = group[order], score[order]
        ends = np.r_[np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)]
        for a, b in zip(np.r_[0, ends[:-1]], ends):
            score[a:b].sort()
        first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (score[1:] != score[:-1])])
        counts, group, score = np.diff(np.r_[first, len(score)]).astype("<i4"), group[first], score[first].astype("<f8")
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        ends, rows = np.r_[starts[1:], len(group)], order[first[starts]]
        bits = [b"" if (c := counts[a:b]).max() == 1 else c.tobytes() for a, b in zip(starts, ends)]
        arrays = [table[c].take(pa.array(rows)).combine_chunks() for c in by]
        arrays += [pa.array(place[rows].astype(np.int32)), pa.array((group[starts] & 1).astype(np.int32)),
                   pa.array([score[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()), pa.array(bits, pa.binary())]
        return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays],
                                          names=[*by, RANGE, "label", "scores", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PACK:
                yield pack(held)
                held, n = [], 0
        if held:
            yield pack(held)

    schema = T.StructType([*[typed.schema[c] for c in by], T.StructField(RANGE, T.IntegerType()), T.StructField("label", T.IntegerType()),
                           T.StructField("scores", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    return typed.mapInArrow(run, schema)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct scores ascending, positives, negatives) of the packed rows of a group."""
    scores, counts = [], {0: [], 1: []}
    for label, s, c in zip(*(table[n].to_pylist() for n in ("label", "scores", "counts"))):
        scores.append(np.frombuffer(s, "<f8"))
        n = np.frombuffer(c, "<i4") if c else np.ones(len(scores[-1]))
        counts[label].append(n)
        counts[1 - label].append(np.zeros(len(n)))
    found, place = np.unique(np.concatenate(scores), return_inverse=True)
    return found, *(np.bincount(place, weights=np.concatenate(counts[k]), minlength=len(found)) for k in (1, 0))


def _range_sums(packed: DataFrame, by: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """The sums of the metrics of each group and range, given the positives and negatives (`__a`, `__b`) in the ranges above it."""
    by, marks = list(by), [float(t) for t in thresholds]
    names = ["__area", "__steps", "__squares", "__p", "__q", *[f"__{k}{i}" for i in range(len(marks)) for k in ("tp", "fp")]]
    schema = T.StructType([*[packed.schema[c] for c in by], packed.schema[RANGE], *[T.StructField(n, T.DoubleType()) for n in names]])

    def sums(table: pa.Table) -> pa.Table:
        s, pos, neg = _unpacked(table)
        a, b = (float(table[n][0].as_py()) for n in ("__a", "__b"))
        tp, fp = a + np.cumsum(pos[::-1])[::-1], b + np.cumsum(neg[::-1])[::-1]
        out = [neg @ (tp - pos / 2.0), (pos * (tp / (tp + fp))).sum(), pos @ (1.0 - s) ** 2 + neg @ s ** 2, pos.sum(), neg.sum()]
        for t in marks:
            out += [pos[s >= t].sum(), neg[s >= t].sum()]
        return pa.table({c: table[c].slice(0, 1) for c in (*by, RANGE)} | {n: pa.array([float(x)]) for n, x in zip(names, out)})

    return packed.groupBy(*map(col, by), RANGE).applyInArrow(sums, schema)


def packed_auc(scores: DataFrame, by: Sequence[str], edges: Sequence[float]) -> DataFrame:
    """V9 for many groups: the scores are shuffled once, packed; a range needs only the number of positives above it, which is added behind the sums."""
    zero = F.lit(0.0)
    sums = _range_sums(packed_scores(scores, by, edges).withColumns({"__a": zero, "__b": zero}), by, ())
    above = F.sum("__p").over(Window.partitionBy(*by).orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1))
    whole = sums.withColumn("__above", F.coalesce(above, zero)).groupBy(*by).agg(
        F.sum(F.col("__area") + F.col("__q") * F.col("__above")).alias("area"), F.sum("__p").alias("p"), F.sum("__q").alias("q"))
    return whole.select(*by, F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("area") / (F.col("p") * F.col("q"))).alias("roc_auc"))


def packed_metrics(scores: DataFrame, by: Sequence[str], edges: Sequence[float], thresholds: Sequence[float] = (words.DEFAULT_THRESHOLD,)) -> DataFrame:
    """`compute_metrics` for many groups: one pass counts the classes of each group and range, one packs, shuffles and ranks the scores."""
    by, zero = list(by), F.lit(0).cast("bigint")
    ranged = with_range(_typed(scores), "score", edges)
    ranged = ranged if RANGE in ranged.columns else ranged.withColumn(RANGE, F.lit(0))
    totals = ranged.groupBy(*by, RANGE).agg(F.sum("label").alias("__p"), F.sum(F.lit(1) - F.col("label")).alias("__q"))
    above = Window.partitionBy(*by).orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, RANGE, F.coalesce(F.sum("__p").over(above), zero).alias("__a"), F.coalesce(F.sum("__q").over(above), zero).alias("__b"))
    packed = packed_scores(scores, by, edges).join(F.broadcast(offsets), [*by, RANGE])
    sums = _range_sums(packed, by, thresholds)
    names = [n for n in sums.columns if n not in (*by, RANGE)]
    whole = {n: F.sum(n) if n in ("__area", "__steps", "__squares") else F.sum(n).cast("bigint") for n in names}
    return _metrics_row(sums.groupBy(*by).agg(*[c.alias(n) for n, c in whole.items()]), thresholds, by)


def metrics_table(metrics: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """Fixed column order, four decimals, ordered by recall then F1."""
    present = [c for c in TABLE_COLUMNS if c in metrics.columns]
    shown = [F.col(c).cast("bigint").alias(c) if c in COUNT_COLUMNS else F.round(c, 4).alias(c) for c in present]
    return metrics.select(*by, *shown).orderBy(F.desc("recall"), F.desc("f1"), *by)


def confusion_matrix(scores: DataFrame, threshold: float = words.DEFAULT_THRESHOLD, by: Sequence[str] = MODEL) -> DataFrame:
    """Four cells per model with the per cent of the true class."""
    counts = confusion_counts(scores, [threshold], by)
    cell = lambda actual, predicted, n, other: F.struct(
        F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"), F.col(n).alias("n"),
        (100.0 * ratio(F.col(n), F.col(n) + F.col(other))).alias("pct_of_actual"))
    cells = [cell(0, 0, "tn", "fp"), cell(0, 1, "fp", "tn"), cell(1, 0, "fn", "tp"), cell(1, 1, "tp", "fn")]
    return counts.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")


def roc_curve(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """(fpr, tpr, threshold) from (0, 0); points inside a straight run are dropped, first and last stay."""
    points = next_in_order(ranked_points(scores, by), by, "score", ["pos", "neg"])
    straight = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
    corner = F.col("prev_score").isNull() | F.col("next_pos").isNull() | ~straight
    curve = points.where(corner).select(
        *by, ratio(F.col("fp"), F.col("negatives"), None).alias("fpr"), ratio(F.col("tp"), F.col("positives"), None).alias("tpr"),
        F.col("score").alias("threshold"))
    start = _typed(scores).groupBy(*by).agg(F.max("label").alias("__any"), F.min("label").alias("__all")).select(
        *by, F.when(F.col("__all") == 0, F.lit(0.0)).alias("fpr"), F.when(F.col("__any") == 1, F.lit(0.0)).alias("tpr"),
        F.lit(float("inf")).alias("threshold"))
    return start.unionByName(curve)


def pr_curve(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """(recall, precision, threshold) per distinct score, and the closing point (0, 1). Recall is 1 without positives."""
    points = ranked_points(scores, by)
    recall = ratio(F.col("tp"), F.col("positives"), 1.0)
    curve = points.select(*by, recall.alias("recall"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                          F.col("score").alias("threshold"))
    end = scores.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).select(
        *by, F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"), F.lit(None).cast("double").alias("threshold"))
    return curve.unionByName(end)


def prevalence(scores: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """Share of positives, the base line of the precision-recall curve."""
    return _typed(scores).groupBy(*by).agg(F.avg("label").alias("prevalence"))


def model_comparison(table: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """Recall, F1, precision and AUC in long form, models by recall."""
    names = ["recall", "f1", "precision", "roc_auc"]
    place = F.dense_rank().over(Window.orderBy("recall", *by))
    return table.select(place.alias("place"), *by, *names).unpivot(["place", *by], names, "metric", "value").orderBy("place", "metric")


def calibration_bins(n: int) -> int:
    return min(10, max(3, n // 12))


def calibration_curve(scores: DataFrame, n_bins: int | None = None, by: Sequence[str] = MODEL) -> DataFrame:
    """Mean score and share of positives per quantile bin of the score. Runs the quantile jobs first.

    A row's bin is the number of inner edges strictly below its score. Edges are one short list per model.
    """
    key = by[0]
    clean = _typed(scores).select(*by, "label", "score")
    sizes = {r[0]: r[1] for r in clean.groupBy(key).count().collect()}
    bins = {model: n_bins or calibration_bins(n) for model, n in sizes.items()}
    inner = {b: [i / b for i in range(1, b)] for b in set(bins.values())}
    every = sorted({p for ps in inner.values() for p in ps})
    of = F.coalesce(*[F.when(F.col(key).isin([m for m, b in bins.items() if b == k]), F.array(*[quantile_name(p) for p in ps]))
                      for k, ps in inner.items()], F.lit(None))
    edges = quantile_rows(clean, ["score"], every, by=key).select(key, of.alias("edges"))
    placed = clean.join(F.broadcast(edges), key).withColumn(
        "bin", F.size(F.filter("edges", lambda e: e < F.col("score"))))
    return placed.groupBy(*by, "bin").agg(F.avg("score").alias("mean_score"), F.avg("label").alias("share_positive"),
                                          F.count(F.lit(1)).alias("n"))


def score_histogram(scores: DataFrame, bins: int = 40, by: Sequence[str] = MODEL) -> DataFrame:
    """Rows per true class and equal bin of [0, 1]; the last bin is closed. Scores outside are not drawn."""
    place = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    inside = _typed(scores).where(F.col("score").between(0.0, 1.0))
    return inside.groupBy(*by, "label", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def score_range_histogram(scores: DataFrame, bins: int = 25, by: Sequence[str] = MODEL) -> DataFrame:
    """Rows per equal bin over each model's own score range."""
    clean = _typed(scores)
    span = clean.groupBy(*by).agg(F.min("score").alias("low"), F.max("score").alias("high"))
    joined = clean.join(F.broadcast(span), list(by))
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("score") - F.col("low")) / width), F.lit(bins - 1))).otherwise(0)
    return joined.groupBy(*by, place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def error_list(scores: DataFrame, threshold: float, features: DataFrame | None = None, top_features: Sequence[str] = (),
               by: Sequence[str] = MODEL, id_col: str = words.ID_COLUMN) -> DataFrame:
    """Wrong rows, most suspicious first, with the first five of `top_features` that are there.

    They are columns of `scores`, or of `features`, which is looked up by id.
    """
    predicted = F.col("score") >= F.lit(float(threshold))
    wrong = _typed(scores).where(predicted != (F.col("label") == 1))
    known = (scores if features is None else features).columns
    shown = [c for c in top_features if c in known][:5]
    if features is not None:
        wrong = wrong.join(features.select(col(id_col), *map(col, shown)), id_col)
    negative, positive = (F.lit(c) for c in words.CLASS_NAMES)
    is_floating = {c: isinstance(wrong.schema[c].dataType, (T.DoubleType, T.FloatType)) for c in shown}
    return wrong.select(
        *by, col(id_col).alias("indice_original"),
        F.when(F.col("label") == 1, positive).otherwise(negative).alias("classe_real"),
        F.when(predicted, positive).otherwise(negative).alias("classe_prevista"),
        F.round("score", 4).alias("prob_malignidade"),
        F.when(F.col("label") == 1, words.ERROR_MISSED).otherwise(words.ERROR_ALARM).alias("tipo_erro"),
        *[(F.round(col(c), 3) if is_floating[c] else col(c)).alias(c) for c in shown]
    ).orderBy(F.desc("prob_malignidade"), "indice_original")
