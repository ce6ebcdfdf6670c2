"""Quality classifier: a sparse ensemble of tree rules over text statistics.

`text_statistics` computes about a dozen statistics of the whole text.  On a
bounded sample of labelled rows, shallow trees grown on bootstrap samples give
paths; every path is a conjunctive rule over statistics.  A logistic model with
an L1 penalty (proximal gradient) weighs the rules, most get weight zero, and
the rest are compiled into one Spark column expression: the score is the
sigmoid of a sum of ``CASE WHEN a <= x AND b > y THEN w``.

The sample is the ``sample_rows`` labelled rows with the smallest hash of their id;
its statistics, and nothing else, come to the driver.  Labels, language,
source and id are never inputs of a score.

Defined cases: null and empty texts have all statistics 0 and get a
score; rows without a label or id don't train; a document labelled twice trains
twice; without both classes in the training rows every score is the (smoothed) share of
label 1; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("words", "word_length", "distinct_words", "repeated_neighbours", "upper_letters", "symbols", "digits",
              "odd_word_ends", "lone_symbols", "repeated_lines", "line_words", "top_word")
SAMPLE_ROWS = 20_000

_UPPER = re.compile(r"[^\W\d_a-zà-öø-ÿ]")
_SYMBOL = re.compile(r"[^\w\s.,;:'\"?()-]")
_ODD_END = re.compile(r"[^\w\s.,;:'\")?](?=\s|$)")
_LONE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")


def statistics_of(text: str | None) -> tuple[float, ...]:
    words = (text or "").split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, chars = len(words), sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return (float(np.log1p(n)), chars / n, len(counts) / n, sum(map(str.__eq__, words, words[1:])) / n,
            len(_UPPER.findall(text)) / chars, len(_SYMBOL.findall(text)) / chars,
            sum(map(text.count, "0123456789")) / chars, len(_ODD_END.findall(text)) / n, len(_LONE.findall(text)) / n,
            1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), max(counts.values()) / n)


def text_statistics(text: Column) -> Column:
    """Struct of the statistics, as doubles."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def compute(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([statistics_of(t) for t in batch], columns=list(STATISTICS), dtype=float)

    return compute(text)


# A condition is (statistic number, threshold, above); a rule is a tuple of conditions.
Condition = tuple[int, float, bool]
Rule = tuple[Condition, ...]


def grow_paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, min_leaf: int) -> list[Rule]:
    """Paths to every node of one Gini tree that sees a random half of the statistics at each split."""
    paths: list[Rule] = []

    def split(rows: np.ndarray, path: Rule) -> None:
        if path:
            paths.append(path)
        label = y[rows]
        if len(path) >= depth or len(rows) < 2 * min_leaf or label.min() == label.max():
            return
        best = (1e-9, -1, 0.0)
        base = label.mean() * (1 - label.mean())
        for j in rng.permutation(x.shape[1])[: (x.shape[1] + 1) // 2]:
            order = np.argsort(x[rows, j], kind="stable")
            v, positive = x[rows[order], j], np.cumsum(label[order])
            left = np.arange(1, len(rows))
            ok = (v[1:] > v[:-1]) & (left >= min_leaf) & (len(rows) - left >= min_leaf)
            if not ok.any():
                continue
            p, q = positive[:-1] / left, (positive[-1] - positive[:-1]) / (len(rows) - left)
            gain = np.where(ok, base - (left * p * (1 - p) + (len(rows) - left) * q * (1 - q)) / len(rows), 0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), int(j), float((v[i] + v[i + 1]) / 2))
        if best[1] >= 0:
            _, j, at = best
            above = x[rows, j] > at
            split(rows[~above], (*path, (j, at, False)))
            split(rows[above], (*path, (j, at, True)))

    split(np.arange(len(y)), ())
    return paths


def fires(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for j, at, above in rule:
        hit &= (x[:, j] > at) == above
    return hit


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[np.ndarray, float]:
    """L1-penalised logistic weights by accelerated proximal gradient; the intercept is free."""
    n, m = z.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, b, v, c, t = np.zeros(m), float(np.log(share / (1 - share))), np.zeros(m), 0.0, 1.0
    c = b
    step = 4.0 / (1 + float(np.linalg.eigvalsh(z.T @ z / n)[-1] if m else 0))
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ v + c, -35, 35))) - y
        moved = v - step * (z.T @ error) / n
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = c - step * float(error.mean())
        new_t = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b


TREE_ROWS = 2_000  # rows of each class that one tree is grown on, at most, drawn from the bounded labelled rows


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-3,
              seed: int = 7, tree_rows: int = TREE_ROWS) -> tuple[list[tuple[Rule, float]], float]:
    """(rules with non-zero weight, intercept)."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
    if len(y) == 0 or y.min() == y.max():
        return [], prior
    rng = np.random.default_rng(seed)
    classes = [np.flatnonzero(y == k) for k in (0, 1)]
    size = min(tree_rows, max(len(c) for c in classes))
    found: dict[bytes, Rule] = {}
    for _ in range(trees):  # both classes weigh the same in a tree
        rows = np.concatenate([rng.choice(c, size) for c in classes])
        for rule in grow_paths(x[rows], y[rows], rng, depth, max(2, size // 100)):
            hit = fires(rule, x)
            if 0 < hit.sum() < len(y):
                found.setdefault(np.packbits(hit).tobytes(), rule)
    rules = list(found.values())
    z = np.column_stack([fires(r, x) for r in rules]).astype(float) if rules else np.zeros((len(y), 0))
    w, b = lasso_logistic(z, y.astype(float), penalty)
    return [(r, float(a)) for r, a in zip(rules, w, strict=True) if abs(a) > 1e-6], float(b)


def compile_score(rules: list[tuple[Rule, float]], intercept: float, statistics: Column) -> Column:
    """The ensemble as one Spark column: sigmoid of the weights of the rules that hold."""
    total = F.lit(intercept)
    for rule, weight in rules:
        held = F.lit(True)
        for j, at, above in rule:
            value = statistics[STATISTICS[j]]
            held = held & (value > at if above else value <= at)
        total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, label_col: str, id_col: str, sample_rows: int) -> DataFrame:
    """(id, label) of at most ``sample_rows`` labelled rows that aren't held out, chosen by a hash of the id."""
    key = labels[id_col]
    return (labels.filter(key.isNotNull() & labels[label_col].isNotNull() & ~held_out(key))
            .select(key.alias("id"), labels[label_col].cast("int").alias("label"))
            .orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> tuple[list[tuple[Rule, float]], float]:
    chosen = F.broadcast(training_ids(labels, label_col, id_col, sample_rows))  # at most sample_rows of (id, label)
    sample = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(chosen, "id")
              .select("id", "label", text_statistics(F.col("text")).alias("s")).select("id", "label", "s.*")
              .toPandas().sort_values(["id", "label"]))
    return fit_rules(sample[list(STATISTICS)].to_numpy(float), (sample["label"].to_numpy() > 0).astype(int))


def score(docs: DataFrame, model: tuple[list[tuple[Rule, float]], float], id_col: str = "doc_id",
          text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted of every row."""
    return (docs.select(docs[id_col], text_statistics(docs[text_col]).alias("_statistics"))
            .select(id_col, held_out(F.col(id_col)).alias("held_out"),
                    compile_score(*model, F.col("_statistics")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def keep_good(docs: DataFrame, model: tuple[list[tuple[Rule, float]], float], text_col: str = "text",
              threshold: float = 0.3) -> DataFrame:
    """The rows that the model accepts, with their columns."""
    kept = docs.select(F.struct("*").alias("_row"), text_statistics(docs[text_col]).alias("_statistics"))
    return kept.filter(compile_score(*model, F.col("_statistics")) >= threshold).select("_row.*")
