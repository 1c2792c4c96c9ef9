"""Table jobs around an image model: pixels in an array column, epochs and scores in tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from farol import vocabulary as words
from farol.functions.columns import col
from farol.functions.keys import digest
from farol.functions.running import balanced_edges
from farol.operators.metrics import compute_metrics, log_loss, metrics_table, packed_auc
from farol.operators.threshold import tune_threshold


def normalized_pixels(pixels: Column) -> Column:
    """G1: 0..255 to -1..1."""
    return F.transform(pixels, lambda x: (x.cast("double") / 255.0 - 0.5) / 0.5)


def positive_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive."""
    return df.agg((F.count_if(col(label) == 0) / F.greatest(F.count_if(col(label) == 1), F.lit(1))).alias("pos_weight"))


def training_history(scored: DataFrame) -> DataFrame:
    """(epoch, val_auc, val_loss) of the held-out rows' scores after each step of a fit."""
    auc = packed_auc(scored, ["epoch"], balanced_edges(scored, "score")).withColumnRenamed("roc_auc", "val_auc")
    return auc.join(log_loss(scored, ["epoch"]).withColumnRenamed("log_loss", "val_loss"), "epoch")


def best_epoch(history: DataFrame) -> DataFrame:
    """The first epoch of the highest validation AUC above 0; epoch 0 if there is none."""
    above = F.col("val_auc") > 0
    key = F.when(above, F.struct(F.col("val_auc"), -F.col("epoch")))
    return history.agg(F.coalesce(F.max_by("epoch", key), F.lit(0)).alias("best_epoch"),
                       F.coalesce(F.max(F.when(above, F.col("val_auc"))), F.lit(0.0)).alias("best_val_auc"))


def samples_per_class(df: DataFrame, n: int = 12, label: str = "label", id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> DataFrame:
    """n/2 rows of each class in hash order. Only the first ranks of a class leave a task."""
    place = F.row_number().over(Window.partitionBy(col(label)).orderBy(digest(f"sample{seed}", col(id_col)), col(id_col)))
    return df.withColumn("__place", place).where(F.col("__place") <= n // 2).drop("__place")


def review_sample(scores: DataFrame, threshold: float, n: int = 12, id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> DataFrame:
    """Up to n/2 errors, most confident first, filled up with correct rows in hash order."""
    wrong = (F.col("score") >= F.lit(float(threshold))) != (F.col("label") == 1)
    distance = F.abs(F.col("score") - F.lit(float(threshold)))
    errors = scores.where(wrong).orderBy(distance.desc(), col(id_col)).limit(n // 2)
    right = scores.where(~wrong).orderBy(digest(f"review{seed}", col(id_col)), col(id_col)).limit(n)
    numbered = right.withColumn("__place", F.row_number().over(Window.orderBy(digest(f"review{seed}", col(id_col)), col(id_col))))
    room = F.lit(n) - errors.agg(F.count(F.lit(1))).scalar()
    fill = numbered.where(F.col("__place") <= room).drop("__place")
    return errors.withColumn("correct", F.lit(False)).unionByName(fill.withColumn("correct", F.lit(True)))


def inspection_picks(scores: DataFrame, threshold: float, id_col: str = words.ID_COLUMN) -> DataFrame:
    """The two rows farthest from 0.5 and the first two errors; a row may be picked for both reasons."""
    wrong = (F.col("score") >= F.lit(float(threshold))) != (F.col("label") == 1)
    confident = scores.orderBy(F.abs(F.col("score") - 0.5).desc(), col(id_col)).limit(2).withColumn("reason", F.lit("confident"))
    errors = scores.where(wrong).orderBy(col(id_col)).limit(2).withColumn("reason", F.lit("error"))
    return confident.unionByName(errors)


def official_test(scores: DataFrame, target_recall: float = 0.98, split: str = "split") -> DataFrame:
    """Threshold from the `val` rows at the required recall, metrics on the `test` rows at 0.50 and at that threshold."""
    choice = tune_threshold(scores.where(col(split) == "val"), target_recall).collect()
    tables = []
    for row in choice:
        test = scores.where((col(split) == "test") & (F.col("model") == row["model"]))
        tables.append(metrics_table(compute_metrics(test, [words.DEFAULT_THRESHOLD, row["threshold"]])))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def batch_scores(df: DataFrame, make_predictor: Callable[[], Callable[[np.ndarray], np.ndarray]], array_col: str, length: int,
                 batch_size: int = 1024, name: str = "score") -> DataFrame:
    """Score an array column in batches with a predictor built once per Python worker."""
    score = predict_batch_udf(make_predictor, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[length]])
    return df.withColumn(name, score(col(array_col)))
