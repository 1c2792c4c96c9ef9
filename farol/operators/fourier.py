"""Random Fourier features: a linear model on them approximates an RBF-kernel machine and trains in passes over the data."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

DIMENSIONS = 256


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """M6: sqrt(2/D) cos(Wx + b) with W ~ N(0, 2 gamma), b ~ U(0, 2 pi), drawn again from the seed when needed."""

    gamma = Param(Params._dummy(), "gamma", "kernel width: exp(-gamma |x - y|^2)", typeConverter=TypeConverters.toFloat)
    inputSize = Param(Params._dummy(), "inputSize", "length of the input vector", typeConverter=TypeConverters.toInt)
    dimensions = Param(Params._dummy(), "dimensions", "length of the output vector", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=None, inputSize=None, dimensions=None, seed=None):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier", gamma=1.0, inputSize=1, dimensions=DIMENSIONS, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def matrices(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.getSeed())
        size, out = self.getOrDefault(self.inputSize), self.getOrDefault(self.dimensions)
        weights = rng.normal(0.0, np.sqrt(2.0 * self.getOrDefault(self.gamma)), (size, out))
        return weights, rng.uniform(0.0, 2.0 * np.pi, out)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, phase = self.matrices()
        scale = np.sqrt(2.0 / len(phase))

        @pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            return pd.Series(list(scale * np.cos(np.stack(x.to_numpy()) @ weights + phase)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(vector_to_array(F.col(self.getInputCol())))))
