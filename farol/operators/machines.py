"""Linear support vector machines on Fourier features, several at once, by quasi-Newton steps on sums that one pass over the rows adds up.

The rows are kept as blocks of prepared features. Their Fourier features, many times as many numbers, are made again in every pass and never stored:
a pass makes those of a block once and gives loss and gradient of every machine that hasn't settled. So the passes are those of the slowest
machine, whatever the number of machines.

Steps, penalty, scaling of features and the rule to stop are those of `pyspark.ml.classification.LinearSVC`, and so are the coefficients.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from farol.functions.storage import written
from farol.operators.fourier import FourierFeatures

#: Steps at most, the change of the mean loss that counts as none, values it is compared with, steps remembered, and lengths tried of a step.
STEPS, TOLERANCE, COMPARED, MEMORY, TRIALS = 50, 1e-3, 20, 10, 20
#: Rows of a stored block, and rows whose features are made at a time: so few that they stay in a core's cache.
BLOCK, AT_ONCE = 4096, 256
#: sin(2 pi t) / t as a polynomial in t^2 for |t| up to a quarter.
SINE = np.polynomial.Chebyshev.interpolate(lambda s: np.sin(2.0 * np.pi * np.sqrt(s)) / np.sqrt(s), 7, domain=[0.0, 0.0625]).convert(
    kind=np.polynomial.Polynomial).coef.tolist()

Point = np.ndarray
Value = tuple[float, np.ndarray]


@dataclass(frozen=True)
class Machine:
    """One machine: the fold it leaves out (-1: none), the strength of its penalty on mean losses, and the weights of class 0 and 1."""

    fold: int
    penalty: float
    weights: tuple[float, float] = (1.0, 1.0)


def _cosines(turns: np.ndarray, squares: np.ndarray, out: np.ndarray) -> np.ndarray:
    """cos(2 pi turns), to 1e-14 of what numpy gives and in a fraction of its time; overwrites its arguments."""
    np.subtract(turns, np.rint(turns, out=out), out=turns)
    np.subtract(0.25, np.abs(turns, out=turns), out=turns)
    np.multiply(turns, turns, out=squares)
    out.fill(SINE[-1])
    for c in SINE[-2::-1]:
        np.multiply(out, squares, out=out)
        np.add(out, c, out=out)
    return np.multiply(out, turns, out=out)


class _Map:
    """The cosines of the feature map for a few rows at a time, in arrays that are used again."""

    def __init__(self, weights: np.ndarray, phase: np.ndarray):
        self.turned = np.vstack([weights, phase[None, :]]) / (2.0 * np.pi)
        self.room = [np.empty((AT_ONCE, len(phase))) for _ in range(3)]

    def parts(self, x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        for at in range(0, len(x), AT_ONCE):
            n = min(AT_ONCE, len(x) - at)
            turns, squares, out = (r[:n] for r in self.room)
            np.matmul(np.hstack([x[at:at + n], np.ones((n, 1))]), self.turned, out=turns)
            yield slice(at, at + n), _cosines(turns, squares, out)


def blocks(df: DataFrame, fold: str) -> DataFrame:
    """(rows, fold, label, x) of rows with a fold, a label and a vector `features`: up to 4,096 of them in one row, as bytes; written once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column(2).flatten().to_numpy(zero_copy_only=False)
                small = [part.column(i).to_numpy(zero_copy_only=False).astype(np.int8).tobytes() for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), *[pa.array([b], pa.binary()) for b in (*small, x.tobytes())]],
                                                 names=["rows", "fold", "label", "x"])

    rows = df.select(F.col(fold).cast("int").alias("fold"), F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
    return written(rows.mapInArrow(pack, "rows int, fold binary, label binary, x binary"), "blocks")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fold, label, features) of one block after the other."""
    for batch in batches:
        for i in range(batch.num_rows):
            n, fold, label, x = (batch.column(k)[i].as_py() for k in range(4))
            yield np.frombuffer(fold, np.int8), np.frombuffer(label, np.int8), np.frombuffer(x, float).reshape(n, -1)


def _added(table: DataFrame, add_up, size: int) -> np.ndarray:
    """The sum of the numbers that `add_up` returns for each task; as many rows as tasks reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(add_up(_unpacked(batches))).tobytes()], pa.binary())], names=["sums"])

    return sum((np.frombuffer(r[0], float) for r in table.mapInArrow(run, "sums binary").collect()), np.zeros(size))


def fold_sums(table: DataFrame, fourier: FourierFeatures, folds: int) -> np.ndarray:
    """Rows, sums of cosines and sums of their squares by fold and class."""
    weights, phase = fourier.matrices()
    width = len(phase)

    def add_up(parts) -> np.ndarray:
        made, total = _Map(weights, phase), np.zeros((folds, 2, 1 + 2 * width))
        for fold, label, x in parts:
            for at, cosines in made.parts(x):
                member = ((fold[at, None, None] == np.arange(folds)[:, None]) & (label[at, None, None] == np.arange(2))).reshape(len(cosines), -1).astype(float)
                sums = np.hstack([member.sum(axis=0)[:, None], member.T @ cosines, member.T @ (cosines * cosines)])
                total += sums.reshape(total.shape)
        return total

    return _added(table, add_up, folds * 2 * (1 + 2 * width)).reshape(folds, 2, -1)


def _losses(table: DataFrame, fourier: FourierFeatures, points: Sequence[tuple[Machine, np.ndarray, float]]) -> list[tuple[float, np.ndarray, float]]:
    """(sum of weighted hinge losses, its derivative by the coefficients of the cosines, and by the intercept) at each point, on the rows of its machine."""
    weights, phase = fourier.matrices()
    width, left_out = len(phase), np.array([m.fold for m, _, _ in points], np.int8)
    by_class, slopes = np.array([m.weights for m, _, _ in points]).T, np.stack([c for _, c, _ in points], axis=1)
    offsets = np.array([b for _, _, b in points])

    def add_up(parts) -> np.ndarray:
        made, loss, towards, ahead = _Map(weights, phase), np.zeros(len(points)), np.zeros((width, len(points))), np.zeros(len(points))
        for fold, label, x in parts:
            for at, cosines in made.parts(x):
                side = np.where(label[at] > 0, 1.0, -1.0)[:, None]
                missing = 1.0 - side * (cosines @ slopes + offsets)
                weight = by_class[label[at].astype(int)] * ((missing > 0.0) & (fold[at, None] != left_out))
                loss += (weight * missing).sum(axis=0)
                turn = -side * weight
                towards += cosines.T @ turn
                ahead += turn.sum(axis=0)
        return np.vstack([loss, towards, ahead])

    sums = _added(table, add_up, (width + 2) * len(points)).reshape(width + 2, -1)
    return [(float(s[0]), s[1:-1], float(s[-1])) for s in sums.T]


class _Stuck(Exception):
    """No step along a direction, or no direction, lowers the objective."""


def _direction(gradient: Point, memory: Sequence[tuple[Point, Point]]) -> Point:
    """Against the gradient, bent by the steps and changes of the gradient remembered, the last first; no component may go uphill."""
    d, passed = gradient.copy(), []
    for step, change in memory:
        curved = step @ change
        share = (step @ d) / curved
        if not np.isfinite(share):
            raise _Stuck
        passed.append((step, change, curved, share))
        d -= share * change
    if memory:
        step, change = memory[0]
        if not step @ change >= 0.0:
            raise _Stuck
        d *= (step @ change) / (change @ change)
    for step, change, curved, share in reversed(passed):
        d += (share - (change @ d) / curved) * step
    return np.where(-d * gradient < 0.0, -d, 0.0)


def _moved(x: Point, gradient: Point, direction: Point, length: float) -> Point:
    """The point after a step; a component stops at zero where it would change its sign."""
    v = x + direction * length
    return np.where(np.sign(v) == np.where(x != 0.0, np.sign(x), np.sign(-gradient)), v, 0.0)


def _search(x: Point, value: float, gradient: Point, direction: Point, first: bool) -> Generator[Point, Value, tuple[Point, float, Point]]:
    """A step that lowers the objective enough and levels its slope, from half a step on (a tenth, in the first): halved or lengthened until it does."""
    shrink, length = (0.1, 0.5 / np.linalg.norm(gradient)) if first else (0.5, 1.0)
    fall, factor = gradient @ direction, shrink
    for _ in range(TRIALS):
        length *= factor
        if not 1e-10 <= length <= 1e10:
            break
        there = _moved(x, gradient, direction, length)
        reached, turned = yield there
        slope = turned @ direction
        if reached > value + length * fall * 1e-4 or (slope >= 0.9 * fall and slope > -0.9 * fall):
            factor = shrink
        elif slope < 0.9 * fall:
            factor = 2.1
        else:
            return there, reached, turned
    raise _Stuck


def descent(size: int) -> Generator[Point, Value, Point]:
    """Asks for objective and gradient at one point after the other, from zero on, and returns the point where it stops."""
    x = np.zeros(size)
    value, gradient = yield x
    start, values, memory, taken, stuck = abs(value), [np.inf], [], 0, False
    while taken < STEPS and np.linalg.norm(gradient) > max(TOLERANCE * value, 1e-8) and not (
            len(values) > 1 and abs(value - max(values)) <= TOLERANCE * start):
        try:
            direction = _direction(gradient, memory)
            there, lower, turned = yield from _search(x, value, gradient, direction, taken < 1)
        except _Stuck:
            if stuck:
                break
            stuck, memory = True, []
            continue
        stuck, taken = False, taken + 1
        memory = [(there - x, turned - gradient), *memory][:MEMORY]
        x, value, gradient = there, lower, turned
        values = [*values, value][-COMPARED:]
    return x


class _Scaled:
    """A machine's objective in coefficients of standardised features: what to ask the rows for, and what their sums mean."""

    def __init__(self, machine: Machine, sums: np.ndarray, scale: float):
        kept = np.array([f != machine.fold for f in range(len(sums))])
        by_class = sums[kept].sum(axis=0)
        w = np.array(machine.weights)
        total, width = float(w @ by_class[:, 0]), (sums.shape[2] - 1) // 2
        added, squared = w @ by_class[:, 1:1 + width], w @ by_class[:, 1 + width:]
        free = total - float((w * w) @ by_class[:, 0]) / total
        variance = np.maximum(squared - added * added / total, 0.0) / free if free > 0 else np.zeros(width)
        deviation = scale * np.sqrt(variance)
        self.machine, self.total, self.width, self.scale = machine, total, width, scale
        self.inverse = np.divide(1.0, deviation, out=np.zeros(width), where=deviation > 0)
        self.centre = self.inverse * scale * added / total

    def point(self, x: Point) -> tuple[Machine, np.ndarray, float]:
        return self.machine, self.scale * self.inverse * x[:-1], float(x[-1] - self.centre @ x[:-1])

    def value(self, x: Point, loss: float, towards: np.ndarray, ahead: float) -> Value:
        held = self.machine.penalty * x[:-1] * self.inverse ** 2
        slope = (self.scale * self.inverse * towards - self.centre * ahead) / self.total + held
        return loss / self.total + 0.5 * float(x[:-1] @ held), np.append(slope, ahead / self.total)


def fit_machines(table: DataFrame, fourier: FourierFeatures, machines: Sequence[Machine], sums: np.ndarray) -> tuple[list[tuple[np.ndarray, float]], int]:
    """Coefficients of the Fourier features and intercept of each machine, and the passes taken. `table` is `blocks`, `sums` is `fold_sums` of it."""
    scale = float(np.sqrt(2.0 / fourier.getOrDefault(fourier.dimensions)))
    scaled = [_Scaled(m, sums, scale) for m in machines]
    walks = {i: descent(s.width + 1) for i, s in enumerate(scaled)}
    asked: dict[int, Point] = {i: next(w) for i, w in walks.items()}
    found: dict[int, Point] = {}
    passes = 0
    while asked:
        told = _losses(table, fourier, [scaled[i].point(x) for i, x in asked.items()])
        passes += 1
        for (i, x), sums_at in zip(list(asked.items()), told):
            try:
                asked[i] = walks[i].send(scaled[i].value(x, *sums_at))
            except StopIteration as e:
                found[i] = e.value
                del asked[i]
    return [(scaled[i].inverse * found[i][:-1], scaled[i].point(found[i])[2]) for i in range(len(machines))], passes


def held_margins(table: DataFrame, fourier: FourierFeatures, fitted: Mapping[int, tuple[np.ndarray, float]]) -> DataFrame:
    """(label, margin) of every row under the machine that left its fold out."""
    weights, phase = fourier.matrices()
    scale = np.sqrt(2.0 / len(phase))
    slopes = np.stack([scale * fitted[f][0] for f in sorted(fitted)], axis=1)
    offsets, order = np.array([fitted[f][1] for f in sorted(fitted)]), np.array(sorted(fitted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Map(weights, phase)
        for fold, label, x in _unpacked(batches):
            margins = np.concatenate([(cosines @ slopes + offsets)[np.arange(len(cosines)), np.searchsorted(order, fold[at])] for at, cosines in made.parts(x)])
            yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(margins)], names=["label", "value"])

    return table.mapInArrow(run, "label int, value double").select("label", array_to_vector(F.array("value")).alias("margin"))


class MachineMargin(FourierFeatures):
    """M6: the margin of a machine on the Fourier features of the input, as a vector of one number."""

    coefficients = Param(Params._dummy(), "coefficients", "one per Fourier feature", typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "added to the sum", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=None, inputSize=None, dimensions=None, seed=None, coefficients=None, intercept=None):
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        super().__init__()
        self._setDefault(outputCol="margin", coefficients=[], intercept=0.0)
        self._set(**given)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, phase = self.matrices()
        slopes = np.sqrt(2.0 / len(phase)) * np.array(self.getOrDefault(self.coefficients))
        intercept = self.getOrDefault(self.intercept)

        @pandas_udf("array<double>")
        def margin(x: pd.Series) -> pd.Series:
            made = _Map(weights, phase)
            rows = np.stack(x.to_numpy()) if len(x) else np.empty((0, len(weights)))
            return pd.Series([np.array([v]) for _, cosines in made.parts(rows) for v in cosines @ slopes + intercept])

        return dataset.withColumn(self.getOutputCol(), array_to_vector(margin(vector_to_array(F.col(self.getInputCol())))))
