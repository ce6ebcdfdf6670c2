"""Whitening of embeddings by their leading principal components.

Every component becomes the long x = floor(64 * c) + 1,000,000.  The fit list is each distinct
x vector once (a Spark aggregate that combines copies before the shuffle).  Three passes of
tasks over it give, each as d or d x d sums that Spark merges: the exact column sums S; the
covariance of x - S/n, centred before multiplying (the whole part of S/n is taken off as an
integer and the fraction after it, so the offset costs no digits); and, with the components known, the
covariance of the whitened rows.  The eigenpairs of the d x d covariance come from
`eigen` on the driver; means and components (16 x d numbers) go to the tasks, which project all rows.

Defined cases: rows whose vector is null or holds a null or non-finite entry are left out; all
vectors must have one length: that of most rows (the longer of equals) unless ``width`` is given, and
rows of another length, empty ones too, are left out; components whose eigenvalue is not above 1e-12
of the largest one cannot be whitened and are left out, so equal vectors alone, or one vector, give an
empty result, as does an empty table; repeated rows count once in the fit and each get
their result; a null id is carried; a deviation beyond a long is null; an entry beyond 2^62 is
an error; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoframe.llm.eigen import leading_eigenpairs
from ecoframe.llm.stages import Stages
from ecoframe.llm.vectors import SUMS, GroupSums, is_finite, matrix, merged_sums, whole_numbers

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
LEAST_SHARE = 1e-12   # of the largest eigenvalue
ROWS = 16_384         # rows whose products are held at a time
PRODUCTS = "i int, j int, s double"


@dataclass
class Whitening:
    """A fitted whitening: rows, column sums, components (rows) and their eigenvalues."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centre(self, rows: np.ndarray) -> np.ndarray:
        """x - S/n: exact but for one rounding."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (rows - whole).astype(float) - part

    def project(self, rows: np.ndarray) -> np.ndarray:
        return (self.centre(rows) @ self.components.T) / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; null beyond a long."""
        if not len(rows):
            return []
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        gap = rows - whole
        if float(np.abs(gap).max() + 1) * self.n < 2.0 ** 31 / max(1.0, len(self.sums) ** 0.5):
            gap = gap * self.n - np.array([s % self.n for s in self.sums], dtype=np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = gap.astype(object) * self.n - np.array([s % self.n for s in self.sums], dtype=object)
        return [s if s < 1 << 63 else None for s in (gap * gap).sum(axis=1).tolist()]


def kept_vectors(embeddings: DataFrame, id_col: str, vector_col: str, width: int | None) -> tuple[DataFrame, int]:
    """(vec_id and x of the rows that are whitened, the length of x)."""
    rows = embeddings.select(embeddings[id_col].alias("vec_id"), embeddings[vector_col].cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & is_finite(F.col("v")))
    if width is None:
        most = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
        width = most["width"] if most else 0
    return rows.filter(F.size("v") == width).select("vec_id", whole_numbers(F.col("v"), SCALE, OFFSET).alias("x")), width


def products(model: Whitening, whiten: bool):
    """Tasks: sums of the products of the centred (or whitened) rows, upper triangle."""
    width = len(model.values) if whiten else len(model.sums)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            rows = matrix(batch.column("x"), len(model.sums))
            for start in range(0, len(rows), ROWS):
                part = rows[start:start + ROWS]
                values = model.project(part) if whiten else model.centre(part)
                total += values.T @ values
                seen = True
        if seen:
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    return sums


def covariance(fit: DataFrame, model: Whitening, whiten: bool = False) -> np.ndarray:
    """Covariance over the fit list, divisor n: width x width sums reach the driver."""
    width = len(model.values) if whiten else len(model.sums)
    out = np.zeros((width, width))
    for r in fit.select("x").mapInArrow(products(model, whiten), PRODUCTS).groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / model.n
    return out


def column_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """(rows, exact sum of every dimension)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = GroupSums(1, width)
        for batch in batches:
            rows = matrix(batch.column("x"), width)
            total.add(np.zeros(len(rows), dtype=int), rows)
        yield from total.batches()

    return merged_sums(fit.select("x").mapInArrow(sums, SUMS), width).get(0, (0, [0] * width))


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The leading components of the distinct rows ``fit``."""
    n, sums = column_sums(fit, width) if width else (0, [])
    model = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)
    if not n:
        return model
    matrix_ = covariance(fit, model)
    model.trace = float(np.trace(matrix_))
    values, vectors = leading_eigenpairs(matrix_, components)
    keep = (values > LEAST_SHARE * max(float(values[0]), 0.0)) & (values > 0)
    model.values, model.components = values[keep], vectors[keep]
    return model


def project(kept: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened components (array) of every row."""
    schema = T.StructType([kept.schema["vec_id"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    width, many = len(model.sums), len(model.values)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("x"), width)
            values = pa.array(model.project(rows).ravel())
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * many)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(model.deviations(rows), pa.int64()), pa.ListArray.from_arrays(ends, values)],
                names=["vec_id", "deviation", "whitened"])

    return kept.mapInArrow(place, schema)


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int | None = None,
           components: int = COMPONENTS) -> tuple[DataFrame, Whitening, float]:
    """(vec_id, deviation, whitened of every row; the fitted whitening; its identity error)."""
    stages = Stages(embeddings.sparkSession, "whitening")
    kept, width = kept_vectors(embeddings, id_col, vector_col, width)
    fit = stages.write(kept.select("x").distinct(), "fit")
    model = fit_whitening(fit, width, components)
    many = len(model.values)
    error = float(np.abs(covariance(fit, model, whiten=True) - np.eye(many)).max()) if many else 0.0
    stages.remove("fit")
    return project(kept if many else kept.limit(0), model), model, error


def whiten_report(embeddings: DataFrame, **options) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    rows, model, error = whiten(embeddings, **options)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    out = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      F.col("value").alias("whitened"), F.try_element_at(explained, F.col("at") + 1).alias("explained"),
                      F.lit(error).alias("identity_error"))
