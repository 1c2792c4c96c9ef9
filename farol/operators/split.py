"""Stratified splits, folds and subsamples that depend only on the seed and the ids."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import col
from farol.functions.keys import digest, keyed_unit
from farol.functions.strata import largest_remainder, stratum_counts, with_slices


def split_quotas(counts: Mapping, test_share: float = words.TEST_SHARE, validation_share: float = words.VALIDATION_SHARE) -> dict:
    """{class: (test, validation, train)}: the test part is cut first, validation from the rest."""
    total = sum(counts.values())
    n_test = math.ceil(test_share * total)
    rest = largest_remainder(counts, total - n_test)
    n_validation = math.ceil(validation_share / (1.0 - test_share) * sum(rest.values()))
    train = largest_remainder(rest, sum(rest.values()) - n_validation)
    return {c: (counts[c] - rest[c], rest[c] - train[c], train[c]) for c in counts}


def stratified_split(df: DataFrame, label: str, id_col: str = words.ID_COLUMN, seed: int = words.SEED,
                     test_share: float = words.TEST_SHARE, validation_share: float = words.VALIDATION_SHARE,
                     name: str = "split") -> DataFrame:
    """Add `train`, `val` or `test` with exact sizes per class. Two small jobs find the cut keys; rows do not move."""
    quotas = split_quotas(stratum_counts(df, label), test_share, validation_share)
    sliced = with_slices(df, label, id_col, f"split{seed}", {c: q[:2] for c, q in quotas.items()}, name)
    return sliced.withColumn(name, F.element_at(F.array(F.lit("test"), F.lit("val"), F.lit("train")), col(name) + 1))


def hashed_split(df: DataFrame, id_col: str = words.ID_COLUMN, seed: int = words.SEED, test_share: float = words.TEST_SHARE,
                 validation_share: float = words.VALIDATION_SHARE, name: str = "split") -> DataFrame:
    """The same shares up to chance, by a hash threshold: one narrow pass and no job before it."""
    u = keyed_unit(f"split{seed}", col(id_col))
    return df.withColumn(name, F.when(u < test_share, "test").when(u < test_share + validation_share, "val").otherwise("train"))


def train_and_validation(df: DataFrame, name: str = "split") -> DataFrame:
    """The rows the final model is fit on."""
    return df.where(col(name).isin("train", "val"))


def split_summary(df: DataFrame, label: str, name: str = "split") -> DataFrame:
    """Size, share, class counts and prevalence of each part; `label` is 0 or 1."""
    parts = df.groupBy(col(name).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(col(label) == 0).alias("negatives"),
        F.count_if(col(label) == 1).alias("positives"))
    total = parts.agg(F.sum("n")).scalar()
    return parts.select(
        "split", "n", F.round(F.lit(100.0) * F.col("n") / total, 1).alias("pct_of_total"), "negatives", "positives",
        F.round(F.lit(100.0) * F.col("positives") / F.col("n"), 2).alias("prevalence_pct"))


def fold_quotas(counts: Mapping, k: int = words.FOLDS) -> dict:
    """{class: sizes of its k folds}: classes are dealt out one after the other, so fold totals differ by at most one."""
    out, dealt = {}, 0
    for c in sorted(counts):
        n = counts[c]
        out[c] = [(dealt + n - f + k - 1) // k - (dealt - f + k - 1) // k for f in range(k)]
        dealt += n
    return out


def stratified_folds(df: DataFrame, label: str, id_col: str = words.ID_COLUMN, k: int = words.FOLDS, seed: int = words.SEED,
                     name: str = "fold") -> DataFrame:
    """T4: add a fold number 0..k-1, shuffled and stratified, as `CrossValidator(foldCol=...)` wants it."""
    quotas = fold_quotas(stratum_counts(df, label), k)
    return with_slices(df, label, id_col, f"fold{seed}", {c: q[:-1] for c, q in quotas.items()}, name)


def learning_sizes(n: int, shares: Sequence[float]) -> list[int]:
    return [int(n * s) for s in shares]


def learning_shares(steps: int = 8, first: float = 0.15) -> list[float]:
    return [first + (1.0 - first) * i / (steps - 1) for i in range(steps - 1)] + [1.0]


def learning_subsets(df: DataFrame, fold: str = "fold", id_col: str = words.ID_COLUMN, seed: int = words.SEED,
                     shares: Sequence[float] | None = None, name: str = "step") -> DataFrame:
    """T5: for each held-out fold, every training row with the first `step` (0-based) whose nested subset contains it.

    The subset of step s are the rows with `step <= s`; each training row appears once per held-out fold.
    """
    shares = list(shares or learning_shares())
    folds = stratum_counts(df, fold)
    held = F.explode(F.array(*[F.lit(f) for f in sorted(folds)])).alias("held_out")
    training = df.withColumn("__digest", digest(f"learn{seed}", col(id_col))).select("*", held).where(col(fold) != F.col("held_out"))
    total = sum(folds.values())
    sizes = {}
    for f, n in folds.items():
        ends = learning_sizes(total - n, shares)
        sizes[f] = [b - a for a, b in zip([0, *ends[:-1]], ends)]
    return with_slices(training, "held_out", id_col, f"learn{seed}", {f: s[:-1] for f, s in sizes.items()}, name, "__digest")


def split_problems(parts: DataFrame, whole: DataFrame, id_col: str = words.ID_COLUMN, name: str = "split") -> DataFrame:
    """Ids in more than one part, ids in no part and ids from elsewhere, as three counts in one row."""
    placed = parts.groupBy(col(id_col)).agg(F.count_distinct(col(name)).alias("parts"))
    known = whole.select(col(id_col)).distinct().withColumn("known", F.lit(True))
    both = placed.join(known, id_col, "full_outer")
    return both.agg(F.count_if(F.col("parts") > 1).alias("overlapping"), F.count_if(F.col("parts").isNull()).alias("unplaced"),
                    F.count_if(F.col("known").isNull()).alias("foreign"))


def prevalence_gap(df: DataFrame, label: str, name: str = "split") -> DataFrame:
    """Largest distance between the prevalence of a part and that of the whole table."""
    parts = df.groupBy(col(name)).agg(F.sum(col(label)).alias("p"), F.count(F.lit(1)).alias("n"))
    whole = parts.agg(F.sum("p") / F.sum("n")).scalar()
    return parts.select(F.abs(F.col("p") / F.col("n") - whole).alias("gap")).agg(F.max("gap").alias("largest_gap"))
