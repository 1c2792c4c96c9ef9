"""Preprocessing fit on some rows and applied to others: impute, scale, one-hot, assemble.

Fitting collects a few numbers per column. The fitted object is a stock `PipelineModel` (a SQL
projection, the indexer, the encoder and the assembler), so it saves, loads, streams and runs inside
whole-stage code like any other Spark pipeline.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol import vocabulary as words
from farol.functions.columns import col, numeric_columns
from farol.functions.keys import keyed_unit
from farol.functions.quantiles import quantile_values

SCALERS = ("standard", "robust", "power", "none")
LAMBDA_STEPS = 33
LAMBDA_PASSES = 5


def infer_roles(df: DataFrame, drop: Sequence[str] = (words.ID_COLUMN, words.LABEL_COLUMN)) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns by type; booleans and texts are categorical."""
    numeric = numeric_columns(df, list(drop))
    return numeric, [c for c in df.columns if c not in numeric and c not in drop]


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of every column; None where a column has no value."""
    return {c: v[0] for c, v in quantile_values(df, list(columns), [0.5]).items()} if columns else {}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent text, ties to the smallest; counted by value so that no task holds all values."""
    if not columns:
        return {}
    texts = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot([], [col(c) for c in columns], "feature", "value")
    counts = texts.where("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()
    return {c: None for c in columns} | {r["feature"]: r["mode"] for r in best}


def imputed(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Missing cells replaced by the fitted value of their column."""
    return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in fills.items() if v is not None})


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation, 1 where the column does not vary."""
    if not columns:
        return {}
    x = {c: col(c).cast("double") for c in columns}
    row = df.agg(*[F.avg(x[c]).alias(f"a{i}") for i, c in enumerate(columns)],
                 *[F.when(F.min(x[c]) < F.max(x[c]), F.stddev_pop(x[c])).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"a{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def fit_robust(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Median and interquartile range, 1 where the range is zero."""
    if not columns:
        return {}
    quartiles = quantile_values(df, list(columns), [0.25, 0.5, 0.75])
    return {c: (q[1], (q[2] - q[0]) or 1.0) for c, q in quartiles.items()}


def yeo_johnson(x: Column, lam: float) -> Column:
    """The transform at a given lambda."""
    up = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1.0, F.lit(lam)) - 1.0) / lam
    down = -F.log1p(-x) if abs(lam - 2.0) < 1e-12 else -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / (2.0 - lam)
    return F.when(x >= 0, up).otherwise(down)


def _yeo_johnson_numpy(x: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(x)
    up = x >= 0
    out[up] = np.log1p(x[up]) if abs(lam) < 1e-12 else np.expm1(lam * np.log1p(x[up])) / lam
    down = ~up
    out[down] = -np.log1p(-x[down]) if abs(lam - 2.0) < 1e-12 else -np.expm1((2.0 - lam) * np.log1p(-x[down])) / (2.0 - lam)
    return out


def _yeo_johnson_logs(logs: np.ndarray, lam: float) -> np.ndarray:
    """The transform of every x from sign(x) log(1 + |x|), which does not depend on lambda."""
    out = np.empty_like(logs)
    up = logs >= 0
    for side, turn in ((slice(None), lam),) if up.all() else ((up, lam), (~up, lam - 2.0)):
        out[side] = logs[side] if abs(turn) < 1e-12 else np.expm1(turn * logs[side]) / turn
    return out


def _likelihoods(df: DataFrame, columns: Sequence[str], grids: Mapping[str, np.ndarray], means: Mapping[str, float]) -> dict[str, np.ndarray]:
    """Profile log-likelihood of every column at its own grid of lambdas: sums per partition, one row per (column, lambda)."""
    wide = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    lambdas = [grids[c] for c in columns]
    centres = [np.array([_yeo_johnson_numpy(np.array([means[c]]), lam)[0] for lam in grids[c]]) for c in columns]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {(i, k): np.zeros(4) for i in range(len(lambdas)) for k in range(len(lambdas[i]))}
        for pdf in batches:
            for i in range(len(lambdas)):
                x = pdf[f"c{i}"].to_numpy(dtype=float)
                x = x[~np.isnan(x)]
                logs = np.sign(x) * np.log1p(np.abs(x))
                total = float(logs.sum())
                for k, lam in enumerate(lambdas[i]):
                    t = _yeo_johnson_logs(logs, lam) - centres[i][k]
                    sums[(i, k)] += (len(x), t.sum(), t @ t, total)
        yield pd.DataFrame([(i, k, *map(float, s)) for (i, k), s in sums.items()], columns=["i", "k", "n", "s", "ss", "logs"])

    parts = wide.mapInPandas(add_up, "i int, k int, n double, s double, ss double, logs double")
    out = {c: np.full(len(grids[c]), -np.inf) for c in columns}
    for r in parts.groupBy("i", "k").agg(*[F.sum(x).alias(x) for x in ("n", "s", "ss", "logs")]).collect():
        variance = r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2 if r["n"] else 0.0
        if variance > 0 and np.isfinite(variance):
            lam = grids[columns[r["i"]]][r["k"]]
            out[columns[r["i"]]][r["k"]] = -0.5 * r["n"] * np.log(variance) + (lam - 1.0) * r["logs"]
    return out


def fit_lambdas(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Lambda of maximum likelihood for all columns together, by a grid that narrows around the best point each pass."""
    columns = list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.avg(col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    means = {c: row[f"c{i}"] for i, c in enumerate(columns)}
    grids = {c: np.linspace(-5.0, 5.0, LAMBDA_STEPS) for c in columns}
    best: dict[str, float] = {}
    for _ in range(LAMBDA_PASSES):
        likelihood = _likelihoods(df, columns, grids, means)
        for c in columns:
            at, step = int(np.argmax(likelihood[c])), grids[c][1] - grids[c][0]
            best[c] = float(grids[c][at]) if np.isfinite(likelihood[c][at]) else 1.0
            grids[c] = np.linspace(best[c] - step, best[c] + step, LAMBDA_STEPS)
    return best


def inject_missing(df: DataFrame, columns: Sequence[str], fraction: float, id_col: str = words.ID_COLUMN, salt: str = "mcar") -> DataFrame:
    """P10: empty a fraction of the cells completely at random; which ones depends on salt, column and id only."""
    gaps = {c: F.when(keyed_unit(f"{salt}|{c}", col(id_col)) >= fraction, col(c)) for c in columns}
    return df.withColumns(gaps) if fraction > 0 else df


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _stage_names(columns: Sequence[str]) -> dict[str, str]:
    """Names the stages can work with: they do not quote, so dots and backticks become underscores with the position."""
    return {c: c if not set(".`") & set(c) else c.replace(".", "_").replace("`", "_") + f"_{i}" for i, c in enumerate(columns)}


def _yeo_johnson_sql(x: str, lam: float) -> str:
    up = f"log1p({x})" if abs(lam) < 1e-12 else f"((power({x} + 1D, {_number(lam)}) - 1D) / {_number(lam)})"
    down = f"(-log1p(-({x})))" if abs(lam - 2.0) < 1e-12 else f"(-(power(1D - {x}, {_number(2.0 - lam)}) - 1D) / {_number(2.0 - lam)})"
    return f"CASE WHEN {x} >= 0 THEN {up} ELSE {down} END"


class Preprocessor(Estimator, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """P1 to P9 as one estimator: median and scale for numbers, mode and one-hot for categories, then a vector.

    Columns not named are kept untouched next to the vector. Columns without any value are left out.
    """

    numericCols = Param(Params._dummy(), "numericCols", "numeric features, in order", typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical features, in order", typeConverter=TypeConverters.toListString)
    scaler = Param(Params._dummy(), "scaler", "standard, robust, power or none", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, scaler="standard", outputCol="features"):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], scaler="standard", outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault(self.scaler) not in SCALERS:
            raise ValueError(f"scaler must be one of {SCALERS}")

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric, categorical = self.getOrDefault(self.numericCols), self.getOrDefault(self.categoricalCols)
        medians = {c: m for c, m in fit_medians(dataset, numeric).items() if m is not None}
        numeric = [c for c in numeric if c in medians]
        modes = {c: m for c, m in fit_modes(dataset, categorical).items() if m is not None}
        categorical = [c for c in categorical if c in modes]
        filled = dataset.select(*[F.coalesce(col(c).cast("double"), F.lit(medians[c])).alias(c) for c in numeric])
        named = _stage_names([*numeric, *categorical])
        nums, cats = [named[c] for c in numeric], [named[c] for c in categorical]
        cells = self._numeric_sql(filled, numeric, medians, named)
        cells += [f"coalesce(CAST({_name(c)} AS STRING), {_text(modes[c])}) AS {_name('cat__' + named[c])}" for c in categorical]
        projection = SQLTransformer(statement="SELECT *, " + ", ".join(cells) + " FROM __THIS__")
        stages, inputs = [projection], [f"num__{c}" for c in nums]
        scratch = [f"num__{c}" for c in nums] + [f"cat__{c}" for c in cats]
        if categorical:
            indexer = StringIndexer(inputCols=[f"cat__{c}" for c in cats], outputCols=[f"idx__{c}" for c in cats],
                                    stringOrderType="alphabetAsc", handleInvalid="keep")
            texts = dataset.select(*[F.coalesce(col(c).cast("string"), F.lit(modes[c])).alias(f"cat__{named[c]}") for c in categorical])
            indexed = indexer.fit(texts)
            encoder = OneHotEncoder(inputCols=[f"idx__{c}" for c in cats], outputCols=[f"hot__{c}" for c in cats], dropLast=True)
            stages += [indexed, encoder.fit(indexed.transform(texts))]
            inputs += [f"hot__{c}" for c in cats]
            scratch += [f"idx__{c}" for c in cats] + [f"hot__{c}" for c in cats]
        output = self.getOutputCol()
        kept = f"SELECT * EXCEPT ({', '.join(_name(s) for s in scratch)}) FROM __THIS__"
        stages += [VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"), SQLTransformer(statement=kept)]
        return PipelineModel(stages)

    def _numeric_sql(self, filled: DataFrame, numeric: list[str], medians: Mapping[str, float], named: Mapping[str, str]) -> list[str]:
        kind = self.getOrDefault(self.scaler)
        lambdas = fit_lambdas(filled, numeric) if kind == "power" else {}
        if kind == "standard":
            scales = fit_standard(filled, numeric)
        elif kind == "robust":
            scales = fit_robust(filled, numeric)
        elif kind == "power":
            scales = fit_standard(filled.select(*[yeo_johnson(col(c), lambdas[c]).alias(c) for c in numeric]), numeric)
        else:
            scales = {}
        cells = []
        for c in numeric:
            x = f"coalesce(CAST({_name(c)} AS DOUBLE), {_number(medians[c])})"
            if c in lambdas:
                x = _yeo_johnson_sql(x, lambdas[c])
            if c in scales:
                centre, spread = scales[c]
                x = f"(({x}) - {_number(centre)}) / {_number(spread)}"
            cells.append(f"{x} AS {_name('num__' + named[c])}")
        return cells


def feature_names_out(model: PipelineModel) -> list[str]:
    """Names of the vector's positions: numeric columns, then `<column>_<category>`."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    indexer = next((s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"), None)
    labels = dict(zip((c.removeprefix("cat__") for c in indexer.getInputCols()), indexer.labelsArray)) if indexer else {}
    out = []
    for c in assembler.getInputCols():
        kind, name = c.split("__", 1)
        out += [name] if kind == "num" else [f"{name}_{value}" for value in labels[name]]
    return out
