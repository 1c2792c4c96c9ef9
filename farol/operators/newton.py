"""Logistic regressions of many settings and folds at once, by Newton steps on sums that one pass over the rows adds up.

A pass gives loss, gradient and curvature of every model that hasn't settled: a task multiplies its blocks of rows with the
coefficients of all models and returns one row of sums per number, which Spark adds up. Equations with one unknown per
feature are solved on the driver. So a search takes as many jobs as its slowest model takes steps, whatever the number of candidates and folds.

The objective of a model is the sum of its weighted losses and |coefficients|^2 / (2 C); the intercept is free.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps at most; a model has settled when its next step moves no coefficient by more than this.
STEPS, SETTLED = 60, 1e-9
#: Rows of a block.
ROWS = 4096


@dataclass(frozen=True)
class Setting:
    """One model: the fold it leaves out, the inverse strength of its penalty (None: no penalty), and the weights of class 0 and 1."""

    fold: int
    c: float | None
    weights: tuple[float, float] = (1.0, 1.0)


def _design(lists: pa.Array) -> np.ndarray:
    """Rows of an array column with a one behind them."""
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    return np.hstack([x, np.ones((len(x), 1))])


def _blocks(batch: pa.RecordBatch, folds: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]]:
    """(fold, label, design per fold) of a batch's rows, a block at a time."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        yield (part.column(0).to_numpy(), part.column(1).to_numpy().astype(float),
               {f: _design(part.column(2 + i)) for i, f in enumerate(folds)})


def _probabilities(margins: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margins, -700, 700)))


def _sums(rows: DataFrame, folds: Sequence[int], settings: Mapping[int, Setting], now: Mapping[int, np.ndarray]) -> dict[int, tuple]:
    """(loss, gradient, curvature) of every given model; models x (features + 1)^2 numbers reach the driver."""
    by_fold = {f: [m for m, s in settings.items() if s.fold == f] for f in folds}
    widths = {m: len(now[m]) for m in settings}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {m: np.zeros(1 + w + w * w) for m, w in widths.items()}
        for batch in batches:
            for fold, y, designs in _blocks(batch, folds):
                for f, models in by_fold.items():
                    seen = fold != f
                    if not models or not seen.any():
                        continue
                    x, label, width = designs[f][seen], y[seen], widths[models[0]]
                    margins = x @ np.stack([now[m] for m in models], axis=1)
                    p = _probabilities(margins)
                    for i, m in enumerate(models):
                        weight = np.where(label > 0, settings[m].weights[1], settings[m].weights[0])
                        total[m][0] += float((weight * (np.logaddexp(0.0, margins[:, i]) - label * margins[:, i])).sum())
                        total[m][1:1 + width] += x.T @ (weight * (p[:, i] - label))
                        total[m][1 + width:] += ((x * (weight * p[:, i] * (1.0 - p[:, i]))[:, None]).T @ x).ravel()
        for m, numbers in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(numbers), m, np.int32)), pa.array(np.arange(len(numbers), dtype=np.int32)),
                                              pa.array(numbers)], names=["model", "place", "value"])

    added = rows.mapInArrow(add_up, "model int, place int, value double").groupBy("model", "place").agg(F.sum("value").alias("value"))
    out = {m: np.zeros(1 + w + w * w) for m, w in widths.items()}
    for r in added.collect():
        out[r["model"]][r["place"]] = r["value"]
    return {m: (v[0], v[1:1 + widths[m]], v[1 + widths[m]:].reshape(widths[m], widths[m])) for m, v in out.items()}


def _direction(gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    try:
        return -np.linalg.solve(curvature, gradient)
    except np.linalg.LinAlgError:
        return -np.linalg.lstsq(curvature, gradient, rcond=None)[0]


def fit_many(rows: DataFrame, folds: Sequence[int], settings: Sequence[Setting], trace: list | None = None) -> tuple[list[np.ndarray], int]:
    """(fold, label, one array<double> column per fold of `folds`) -> coefficients of each setting, the intercept last, and the jobs taken.

    The column of a fold holds the features as that fold's preprocessing makes them; a model learns from the rows of the other folds.
    A step that does not lower the objective is halved, in the same pass as the other models' next steps. Rows must be complete.
    `trace` is given the coefficients that each job started from.
    """
    first = rows.select(*[F.size(c) for c in rows.columns[2:]]).first()
    if first is None:
        raise ValueError("no rows to learn from")
    width_of = {f: n + 1 for f, n in zip(folds, first)}
    best = {m: np.zeros(width_of[s.fold]) for m, s in enumerate(settings)}
    step = {m: np.zeros(len(b)) for m, b in best.items()}
    lowest: dict[int, float] = {}
    open_models, jobs = dict(enumerate(settings)), 0
    while open_models and jobs < STEPS:
        now = {m: best[m] + step[m] for m in open_models}
        jobs += 1
        if trace is not None:
            trace.append(dict(now))
        for m, (loss, gradient, curvature) in _sums(rows, folds, open_models, now).items():
            held = np.append(np.full(len(gradient) - 1, 1.0 / settings[m].c if settings[m].c else 0.0), 0.0)
            objective = loss + 0.5 * float(held @ (now[m] ** 2))
            slack = 1e-12 * max(1.0, abs(objective))
            if m in lowest and not objective <= lowest[m] + slack:
                step[m] = step[m] / 2.0
            else:
                lowest[m], best[m] = objective, now[m]
                step[m] = _direction(gradient + held * now[m], curvature + np.diag(held))
            if np.abs(step[m]).max() < SETTLED:
                best[m] = best[m] + step[m] if objective <= lowest[m] + slack else best[m]
                del open_models[m]
    return [best[m] for m in range(len(settings))], jobs


def score_many(rows: DataFrame, folds: Sequence[int], settings: Sequence[Setting], fitted: Sequence[np.ndarray]) -> DataFrame:
    """(model, part, label, score) of every row under every model, part being `cv` for the fold that a model left out and `train` else."""
    by_fold = {f: [m for m, s in enumerate(settings) if s.fold == f] for f in folds}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fold, y, designs in _blocks(batch, folds):
                for f, models in by_fold.items():
                    if not models:
                        continue
                    p = _probabilities(designs[f] @ np.stack([fitted[m] for m in models], axis=1))
                    part = pa.array(np.where(fold == f, "cv", "train"))
                    for i, m in enumerate(models):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), m, np.int32)), part, pa.array(y.astype(np.int32)),
                                                          pa.array(np.ascontiguousarray(p[:, i]))], names=["model", "part", "label", "score"])

    return rows.mapInArrow(run, "model int, part string, label int, score double")
