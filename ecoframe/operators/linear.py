"""Least squares from one pass over the rows, for dependent columns too.

A task adds up the products of its rows (features and label, taken off a first row so that large
values cost no digits); Spark merges them to one (columns + 1)^2 matrix, whose size does not depend on
the rows.  The driver solves it by eigenvalues: directions without variance are left out, and of all
solutions with the least squared error the coefficients of smallest norm are taken, as a
library solver on centred columns does.  A full set of one-hot flags beside an intercept is such a case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK = 1e-10   # directions of standardised columns with a smaller share of the largest variance carry none
ROWS = 8192    # rows whose products are made at a time


def moments(rows: DataFrame, values: str, shift: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, sums of products) of the array column ``values`` less ``shift``."""
    width = len(shift)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - shift
            for at in range(0, len(x), ROWS):
                part = np.column_stack([np.ones(len(x[at:at + ROWS])), x[at:at + ROWS]])
                total += part.T @ part
        i, j = np.triu_indices(width + 1)
        if total[0, 0]:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    out = np.zeros((width + 1, width + 1))
    merged = rows.select(values).mapInArrow(add, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    for r in merged.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return int(out[0, 0]), out[0, 1:], out[1:, 1:]


def least_norm(n: int, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(coefficients of smallest norm, means, rank) of the last column on the others."""
    means = sums / n
    centred = products - n * np.outer(means, means)
    xx, xy = centred[:-1, :-1], centred[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(xx), 0.0))
    # a constant column: what is left of its squares after centring is rounding
    live = scale > 1e-12 * np.sqrt(np.maximum(np.diag(products)[:-1], 0.0))
    scale = np.where(live & (scale > 0), scale, 1.0)
    standard = np.where(np.outer(live, live), xx / np.outer(scale, scale), 0.0)
    values, vectors = np.linalg.eigh(standard)
    keep = values > RANK * max(float(values.max(initial=0.0)), 0.0)
    inverse = vectors[:, keep] / values[keep] @ vectors[:, keep].T
    found = inverse @ np.where(live, xy / scale, 0.0) / scale
    # solutions differ by the directions without variance; taking those off leaves the shortest one
    idle = vectors[:, ~keep] / scale[:, None]
    if idle.size:
        basis, _ = np.linalg.qr(idle)
        found = found - basis @ (basis.T @ found)
    return found, means, int(keep.sum())


class LeastSquares(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Ordinary least squares with an intercept; of equally good coefficients those of smallest norm.

    Rows with a null label or a null or NaN feature take no part; without any row there is no model: an error."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "LeastSquaresModel":
        values = F.concat(vector_to_array(F.col(self.getFeaturesCol())), F.array(F.col(self.getLabelCol()).cast("double")))
        rows = dataset.select(values.alias("v")).filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))
        first = rows.first()
        if first is None:
            raise ValueError("no complete row to fit")
        shift = np.array(first["v"], dtype=float)
        found, means, rank = least_norm(*moments(rows, "v", shift))
        means = means + shift
        model = LeastSquaresModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
                                  coefficients=[float(c) for c in found], intercept=float(means[-1] - found @ means[:-1]), rank=rank)
        return model._resetUid(self.uid)


class LeastSquaresModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted coefficients; predicts in the JVM and is saved inside a pipeline."""

    coefficients = Param(Params._dummy(), "coefficients", "one per feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "value where all features are zero", TypeConverters.toFloat)
    rank = Param(Params._dummy(), "rank", "independent directions of the features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", predictionCol: str = "prediction", coefficients: list | None = None,
                 intercept: float = 0.0, rank: int = 0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(c) for c in self.getOrDefault(self.coefficients)]).cast("array<double>")
        products = F.zip_with(vector_to_array(F.col(self.getFeaturesCol())), weights, lambda x, w: x * w)
        value = F.aggregate(products, F.lit(self.getOrDefault(self.intercept)), lambda total, x: total + x)
        return dataset.withColumn(self.getPredictionCol(), value)
