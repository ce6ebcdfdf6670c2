"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Positives are documents confirmed as toxic; everything else is a sample of
unlabelled text.  Features are the presence of hashed lower-cased words and word
beginnings, once, twice and three times; a screen keeps those that are much more
frequent among the positives.  Linear numpy classifiers are trained by
full-batch gradient steps on the class-prior-corrected risk

    prior * R+(positives)  +  max(0, R-(unlabelled) - prior * R-(positives)),

stepping back along the second term whenever it falls below zero, and their
mean margin is the score.

The positive rows and the unlabelled rows of the gradient steps are bounded by parameters and chosen by a hash of the id;
held-out rows are in neither.  The shares of the screen are counted over all rows that are not held out.  Only the numbers of the screened features come to the driver.
Labels, language, source and id are never inputs of a score.

Defined cases: null and empty texts have no features and get a score;
without positives or unlabelled rows every score is the prior (0 at least);
equal texts count once in the gradient steps (each in the counted shares); repeated rows are scored each; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.llm.quality import held_out, training_ids

POSITIVE_ROWS = 4_000
UNLABELLED_ROWS = 12_000
BUCKET_BITS = 22
FEATURES = 1_024
LONGEST = 12   # bytes of the longest beginning; words are hashed whole, whatever their length
STEPS = 48     # bytes of words that are hashed together

_NO_LETTERS = re.compile(r"[\W\d_]+")
_MIX, _WHOLE, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def feature_buckets(text: str | None, bits: int = BUCKET_BITS) -> np.ndarray:
    """The different features of a text: each whole word, each of its beginnings of 3 to
    12 bytes that is shorter than the word, and either again where it occurs
    twice and three times."""
    plain = f" {_NO_LETTERS.sub(' ', (text or '').lower())} ".encode()
    raw = np.frombuffer(plain, np.uint8)
    blank = raw == 32
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    hashed, keys = np.full(len(starts), _SEED), []
    length = 0
    while len(starts) and length < STEPS:
        length += 1
        hashed = (hashed ^ raw[starts + length - 1]) * _MIX
        hashed ^= hashed >> np.uint64(29)
        ends = blank[starts + length]
        keys.append(hashed[ends] * _WHOLE)
        starts, hashed = starts[~ends], hashed[~ends]
        if 3 <= length <= LONGEST:
            keys.append(hashed)
    # the few words beyond that, one by one
    keys.append(np.array([xxhash.xxh64_intdigest(plain[at:plain.index(b" ", at)]) for at in starts.tolist()], np.uint64))
    found, times = np.unique(np.concatenate(keys) * _MIX >> np.uint64(64 - bits), return_counts=True)
    again = [found] + [(found[times >= n] + np.uint64(n)) * _MIX >> np.uint64(64 - bits) for n in (2, 3)]
    return np.unique(np.concatenate(again)).astype(np.int64)


def bucket_counts(rows: DataFrame) -> DataFrame:
    """bucket, p: the rows (text) that have each feature; a task sends one row for every bucket that it met."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BUCKET_BITS, np.int32)
        for batch in batches:
            for text in batch.column("text"):
                seen[feature_buckets(text.as_py())] += 1
        met = np.flatnonzero(seen)
        for i in range(0, len(met), 100_000):
            part = met[i:i + 100_000]
            yield pa.record_batch([pa.array(part, pa.int64()), pa.array(seen[part], pa.int64())], names=["bucket", "p"])

    # The positive rows are bounded, so a few tasks hold them.
    return rows.select("text").coalesce(4).mapInArrow(counts, "bucket long, p long").groupBy("bucket").agg(F.sum("p").alias("p"))


def screen(positive: DataFrame, unlabelled: DataFrame, positives: int, unlabelleds: int, features: int, min_rows: int = 3) -> DataFrame:
    """The buckets whose share of positive rows stands out most against all unlabelled rows, with the z value of the
    difference.  Only buckets that enough positive rows have can be chosen; the others are not carried further."""
    chosen = bucket_counts(positive).filter(F.col("p") >= min_rows).select("bucket", "p")
    wanted = np.sort(np.array([r["bucket"] for r in chosen.select("bucket").collect()], np.int64))  # met by the bounded positive rows

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << BUCKET_BITS, bool)
        known[wanted] = True
        seen = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for text in batch.column("text"):
                met = feature_buckets(text.as_py())
                seen[np.searchsorted(wanted, met[known[met]])] += 1
        if len(wanted):
            yield pa.record_batch([pa.array(wanted), pa.array(seen)], names=["bucket", "u"])

    total = unlabelled.select("text").mapInArrow(counts, "bucket long, u long").groupBy("bucket").agg(F.sum("u").alias("u"))
    both = chosen.join(total, "bucket", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    share = (F.col("p") + F.col("u")) / (positives + unlabelleds)
    z = ((F.col("p") / positives - F.col("u") / unlabelleds)
         / F.sqrt(share * (1 - share + 1e-9) * (1 / positives + 1 / unlabelleds)))
    return (both.select("bucket", z.alias("z")).filter("z > 3").orderBy(F.desc("z"), "bucket").limit(features))


class Presence:
    """Binary features of rows as (row, column) pairs, in the order of the rows."""

    def __init__(self, hits: list[list[int]], width: int):
        self.row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
        self.column = np.array([c for h in hits for c in h], np.int64)
        self.height, self.width = len(hits), width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.height)

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, v[self.row], self.width)


def nnpu_risk_gradient(x: Presence, positive: np.ndarray, w: np.ndarray, b: float,
                       prior: float) -> tuple[np.ndarray, float]:
    """Gradient of the non-negative risk with the sigmoid loss."""
    s = 1 / (1 + np.exp(-np.clip(x.times(w) + b, -30, 30)))
    slope = s * (1 - s)
    p, u = positive, ~positive
    n_p, n_u = p.sum(), u.sum()
    plus, minus_p, minus_u = -slope * p * (prior / n_p), slope * p * (prior / n_p), slope * u / n_u
    negative_risk = s[u].mean() - prior * s[p].mean()
    pull = plus + (minus_u - minus_p) if negative_risk >= 0 else -(minus_u - minus_p)
    return x.back(pull), float(pull.sum())


def train_nnpu(x: Presence, positive: np.ndarray, prior: float, seed: int, rounds: int = 500,
               rate: float = 0.05, decay: float = 2e-5) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk, started from the log ratio of shares."""
    rng = np.random.default_rng(seed)
    share_p = x.back(positive.astype(float)) / positive.sum()
    share_u = x.back((~positive).astype(float)) / (~positive).sum()
    w = np.log((share_p + 0.01) / (share_u + 0.01)) + rng.normal(0, 0.05, x.width)
    w /= max(1.0, float(np.quantile(x.times(w)[positive], 0.5)) / 4)
    b = -2.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        gw, gb = nnpu_risk_gradient(x, positive, w, b, prior)
        g = np.append(gw + decay * w, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", prior: float | None = None, positive_rows: int = POSITIVE_ROWS,
          unlabelled_rows: int = UNLABELLED_ROWS, features: int = FEATURES, classifiers: int = 3) -> dict:
    """Model: buckets, weights, bias, prior.  ``prior`` None: the share of confirmed rows among the labelled ones."""
    confirmed = labels.filter(labels[label_col] > 0)
    if prior is None:
        seen = (labels.filter(labels[label_col].isNotNull() & ~held_out(labels[id_col]))
                .agg(F.avg(F.when(labels[label_col] > 0, 1.0).otherwise(0.0)).alias("p")).first())
        prior = float(seen["p"] or 0.0)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter(F.col("id").isNotNull())
    chosen_p = training_ids(confirmed, label_col, id_col, positive_rows).select("id", F.lit(1).alias("positive"))
    chosen_u = (texts.select("id").filter(~held_out(F.col("id")))
                .orderBy(F.xxhash64("id", F.lit("unlabelled")), "id").limit(unlabelled_rows)
                .select("id", F.lit(0).alias("positive")))
    # Bounded: positive_rows + unlabelled_rows ids.
    chosen = F.broadcast(chosen_p.unionByName(chosen_u))
    sample = (texts.join(chosen, "id").select("positive", "text")
              .dropDuplicates(["positive", "text"]).persist())
    try:
        sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
        empty = {"buckets": np.zeros(0, np.int64), "weights": np.zeros(0), "bias": 0.0, "prior": prior, "features": 0}
        if not sizes.get(1) or not sizes.get(0):
            return empty
        unlabelled = texts.filter(~held_out(F.col("id")))
        chosen_buckets = screen(sample.filter("positive = 1"), unlabelled, sizes[1], unlabelled.count(), features)
        buckets = np.sort(np.array([r["bucket"] for r in chosen_buckets.collect()], np.int64))
        if not len(buckets):
            return empty

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [np.flatnonzero(np.isin(buckets, feature_buckets(t.as_py()))).tolist() for t in batch.column("text")]
                yield pa.record_batch([batch.column("positive"), pa.array(hits, pa.list_(pa.int32()))],
                                      names=["positive", "hits"])

        rows = sample.mapInArrow(found, "positive int, hits array<int>").toPandas()
    finally:
        sample.unpersist()
    order = sorted(range(len(rows)), key=lambda i: (rows["positive"][i], tuple(rows["hits"][i])))
    x = Presence([list(rows["hits"][i]) for i in order], len(buckets))
    positive = rows["positive"].to_numpy()[order] == 1
    fitted = [train_nnpu(x, positive, max(prior, 1e-3), seed) for seed in range(classifiers)]
    return {"buckets": buckets, "weights": np.mean([w for w, _ in fitted], 0),
            "bias": float(np.mean([b for _, b in fitted])), "prior": prior, "features": len(buckets)}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """id, held_out, score, predicted of every row."""
    buckets, weights, bias, prior = model["buckets"], model["weights"], model["bias"], model["prior"]

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = np.zeros(1 << BUCKET_BITS, bool)
        known[buckets] = True
        for batch in texts:
            out = np.empty(len(batch))
            for i, text in enumerate(batch):
                met = feature_buckets(text)
                hit = np.searchsorted(buckets, met[known[met]])
                out[i] = 1 / (1 + np.exp(-np.clip(weights[hit].sum() + bias, -30, 30)))
            yield pd.Series(out)

    value = scores(docs[text_col]) if len(buckets) else F.lit(float(prior))
    return (docs.select(docs[id_col], held_out(docs[id_col]).alias("held_out"), value.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))
