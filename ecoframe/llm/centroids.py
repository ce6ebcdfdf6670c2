"""Clustering of embeddings by Lloyd rounds with a progressive Walsh-Hadamard search.

Every component becomes the integer floor(64 * x).  The Walsh-Hadamard transform H is exact on
integers and keeps distances up to a factor (|Hx - Hc|^2 = 64 |x - c|^2 for 64 components), and
its coefficients in order of sign changes go from coarse to fine.  `nearest` accumulates squared
coefficient differences in blocks that double: the centroid that leads after the first block is
finished at once and its distance bounds the others; a centroid whose partial sum is strictly
larger is strictly worse and is eliminated; those that remain finish all coefficients, so the
result is the exact nearest centroid and ties keep the smaller number.

Spark deals the vectors; a task holds one block of them, the k centroids and k sums.  Rounds bring
k x 64 exact sums to the driver and send k x 64 integers to the tasks, whatever the number of vectors;
a vector that very many rows share adds to the sums of its task and forms no group of rows.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component
are left out; with fewer kept vectors than k there are as many centroids as vectors; an empty
table gives an empty result; repeated rows are vectors of their own (equal start hashes are
ordered by the vector); a null vec_id is clustered but starts no centroid while others can;
empty centroids stay; an entry or a distance beyond a long is an error; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoframe.llm.stages import Stages
from ecoframe.llm.vectors import SUMS, GroupSums, is_finite, matrix, merged_sums, whole_numbers

WIDTH, CENTROIDS, ROUNDS = 64, 16, 3
PAIRS = 65_536           # (vector, centroid) pairs held at a time
FIRST_BLOCK = 4          # coefficients seen before the first elimination
EXACT_LONG = 1 << 24     # up to here 64 |x - c|^2 fits a long; beyond it Python integers are used


def coarse_to_fine(width: int) -> np.ndarray:
    """Positions of the natural-order coefficients by their number of sign changes."""
    i, j = np.arange(width)[:, None], np.arange(width)[None, :]
    ones = sum(((i & j) >> b) & 1 for b in range(width.bit_length()))
    signs = 1 - 2 * (ones & 1)
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row by butterflies, in natural order; whole numbers stay exact."""
    n, width = rows.shape
    if width & (width - 1):
        raise ValueError(f"{width} components: the transform needs a power of two")
    half = 1
    while half < width:
        pair = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return rows


def spectrum(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Coefficients coarse to fine, as longs where every sum of squares fits one, else as Python integers."""
    if rows.size and int(np.abs(rows).max()) > EXACT_LONG:
        rows = rows.astype(object)
    return hadamard(rows)[:, order]


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, width * squared distance) of every row of coefficients."""
    n, width = rows.shape
    index = np.arange(n)
    head = rows[:, None, :FIRST_BLOCK] - centres[None, :, :FIRST_BLOCK]
    partial = (head * head).sum(axis=2)
    leader = partial.argmin(axis=1)
    rest = rows[:, FIRST_BLOCK:] - centres[leader, FIRST_BLOCK:]
    bound = partial[index, leader] + (rest * rest).sum(axis=1)
    alive = np.asarray(partial <= bound[:, None], dtype=bool)
    done, step = FIRST_BLOCK, FIRST_BLOCK
    while done < width:
        r, c = np.nonzero(alive)
        gap = rows[r, done:done + step] - centres[c, done:done + step]
        partial[r, c] += (gap * gap).sum(axis=1)
        alive[r, c] = np.asarray(partial[r, c] <= bound[r], dtype=bool)
        done, step = done + step, step * 2
    whole = np.where(alive, partial, (bound + 1)[:, None])
    best = whole.argmin(axis=1)  # the first of equal ones
    return best, whole[index, best]


def blocks(rows: np.ndarray, centres: np.ndarray, order: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, their nearest centres, squared distances), a bounded block at a time."""
    size = max(1, PAIRS // len(centres))
    targets = spectrum(centres, order)
    for start in range(0, len(rows), size):
        part = slice(start, min(start + size, len(rows)))
        coefficients = spectrum(rows[part], order)
        if object in (coefficients.dtype, targets.dtype):
            found, scaled = nearest(coefficients.astype(object), targets.astype(object))
        else:
            found, scaled = nearest(coefficients, targets)
        yield part, found, scaled // rows.shape[1]


def kept_vectors(embeddings: DataFrame, id_col: str, vector_col: str, width: int) -> DataFrame:
    """vec_id and x, the whole-number vector, of the rows that are clustered."""
    vector = embeddings[vector_col].cast("array<double>")
    rows = embeddings.select(embeddings[id_col].alias("vec_id"), vector.alias("v"))
    rows = rows.filter((F.size("v") == width) & is_finite(F.col("v")))
    return rows.select("vec_id", whole_numbers(F.col("v")).alias("x"))


def start_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest hashes of their ids, in ascending order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(key.alias("key"), "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    return [list(r["x"]) for r in first]


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: centroids at the floored means of their vectors; empty ones stay."""
    width = len(centroids[0])
    centres, order = np.array(centroids, dtype=np.int64), coarse_to_fine(width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = GroupSums(len(centres), width)
        for batch in batches:
            rows = matrix(batch.column("x"), width)
            for part, found, _ in blocks(rows, centres, order):
                total.add(found, rows[part])
        yield from total.batches()

    found = merged_sums(kept.select("x").mapInArrow(sums, SUMS), width)
    return [[s // found[c][0] for s in found[c][1]] if c in found else old for c, old in enumerate(centroids)]


def assign(kept: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster and distance (squared) of every kept vector."""
    width = len(centroids[0])
    centres, order = np.array(centroids, dtype=np.int64), coarse_to_fine(width)
    schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = [], []
            for _, found, squared in blocks(matrix(batch.column("x"), width), centres, order):
                cluster.append(pa.array(found, pa.int32()))
                distance.append(pa.array(squared.tolist(), pa.int64()))  # one beyond a long is an error here
            if cluster:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.concat_arrays(cluster), pa.concat_arrays(distance)], names=["vec_id", "cluster", "distance"])

    return kept.mapInArrow(place, schema)


def centroid_hash(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH,
            k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 1) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every kept vector; the final centroids)."""
    spark = embeddings.sparkSession
    stages = Stages(spark, "centroids")
    kept = stages.write(kept_vectors(embeddings, id_col, vector_col, width), "kept")
    centroids = start_centroids(kept, k, seed)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    placed = stages.write(assign(kept, centroids), "placed")
    stages.remove("kept")
    return placed, centroids


def cluster_report(embeddings: DataFrame, **options) -> DataFrame:
    """`cluster`, with the inertia of every cluster and of all, and a hash of the centroid."""
    placed, centroids = cluster(embeddings, **options)
    spark = embeddings.sparkSession
    # k rows
    inertia = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), centroid_hash(x)) for c, x in enumerate(centroids)]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(table), "cluster").select(  # k rows are sent
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round_sql(n: int) -> str:
    """Assignment to the centroids c{n} and the centroids c{n + 1} that follow."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT rid, vec_id, x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT k.rid, k.vec_id, k.x, c.c, list_sum(list_transform(k.x, lambda v, i: (v - c.x[i]) * (v - c.x[i])))::BIGINT AS d
    FROM kept k, c{n} c) GROUP BY rid, vec_id, x),
s{n} AS (
  SELECT c, i, sum(x[i]) AS s, count(*)::HUGEINT AS n FROM a{n}, range(1, {WIDTH + 1}) AS r(i) GROUP BY c, i),
m{n} AS (
  SELECT c, list((((s - (((s % n) + n) % n)) // n))::BIGINT ORDER BY i) AS x FROM s{n} GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c{n}.c, coalesce(m{n}.x, c{n}.x) AS x FROM c{n} LEFT JOIN m{n} USING (c))"""


ORACLE_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {WIDTH}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS c, x FROM kept
  QUALIFY c < {CENTROIDS}),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN (SELECT c, x FROM c{ROUNDS}) f USING (c)
"""
