"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic).  One aggregation gives
documents and tokens per cell; raking scales the cells' token weights until every
marginal has its target share; a document's probability is its cell's weight
divided by its tokens, scaled so that the largest is 1 (or to a token budget).
With exact targets the scarcest target value bounds the whole sample; ``min_share`` keeps at least that share of the
tokens instead: probabilities rise together and stop at 1, and targets that are then not met are logged (`unmet`).
Whether a document stays is decided by a hash of its id, so the sample is
repeatable and needs no shuffle.

The cell table is bounded by the targets: values that a target
doesn't list share one cell name (``other``), so it has at most the product of
the targets' lengths (plus one each) rows, whatever the input.

Defined cases: null or empty categories count as ``other``; a target value that
no document has is left out and the others are scaled up; ``other``, where no target
names it, keeps its own share; null and empty texts have 0 tokens, and are judged
like any document of their cell; rows that repeat an id share its decision; a null id
is hashed as empty text; an empty table gives an empty sample.  Columns of the input
are carried unchanged, the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import logging
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoframe.llm import shingles

_LOG = logging.getLogger(__name__)
OTHER = "other"
ADDED = ("topic", "tokens", "cell_weight", "keep_probability", "sampled")

# Shares of tokens asked for by the registered query and the pipeline.
TARGETS: dict[str, dict[str, float]] = {
    "source": {f"src{i}": 1.0 for i in range(20)},
    "lang": {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1},
    "topic": {"note": 0.05, "article": 0.45, "report": 0.5},
}


def count_tokens(text: Column) -> Column:
    """Words between ASCII white space, counted on the bytes of many texts at once."""

    def count(texts: pa.Array) -> pa.Array:
        raw = shingles.as_bytes(texts)
        parts = [shingles.word_counts(raw[a:b]) for a, b in shingles.chunks(raw)]
        return pa.array(np.concatenate(parts) if parts else [], pa.int64())

    return F.arrow_udf(count, "long")(text.cast("string"))


def length_topic(tokens: Column) -> Column:
    """The topic classes of the registered query: by the size of the document, a stand-in, for documents carries no topic."""
    return F.when(tokens < 100, "note").when(tokens < 1000, "article").otherwise("report")


def _category(column: Column, target: dict[str, float]) -> Column:
    return F.when(column.cast("string").isin(*target), column.cast("string")).otherwise(F.lit(OTHER))


def rake(mass: np.ndarray, wanted: list[np.ndarray], rounds: int = 1_000, tolerance: float = 1e-10) -> np.ndarray:
    """Scales a cell array until its marginals have the wanted shares, as far as they can be met."""
    weight = mass.astype(float).copy()
    if weight.sum() == 0:
        return weight
    for _ in range(rounds):
        worst = 0.0
        for axis, want in enumerate(wanted):
            have = weight.sum(axis=tuple(a for a in range(weight.ndim) if a != axis))
            want = np.where(have > 0, want, 0)
            want = want / want.sum() * weight.sum() if want.sum() else have
            scale = np.divide(want, have, out=np.ones_like(have), where=have > 0)
            worst = max(worst, float(np.abs(scale[have > 0] - 1).max()))
            weight *= scale.reshape([-1 if a == axis else 1 for a in range(weight.ndim)])
        if worst < tolerance:
            return weight
    _LOG.warning("raking ended after %d rounds, still moving by %.2g: the targets contradict each other", rounds, worst)
    return weight


def raised_scale(mass: np.ndarray, ratio: np.ndarray, goal: float) -> float:
    """Least factor of the ratios with which the tokens kept, probabilities capped at 1, reach the goal, as far as they can."""
    some = ratio > 0
    order = np.argsort(-ratio[some])
    mass, ratio = mass[some][order], ratio[some][order]  # cells reach 1 in this order
    full = np.append(0.0, np.cumsum(mass))
    rest = np.append(np.cumsum((mass * ratio)[::-1])[::-1], 0.0)
    for k, r in enumerate(ratio):
        if full[k] + rest[k] / r >= goal:  # before cell k reaches 1
            return float((goal - full[k]) / rest[k])
    return float(1 / ratio[-1]) if len(ratio) else 0.0


def target_shares(have: dict[str, float], target: dict[str, float], total: float) -> dict[str, float]:
    """Wanted share of every value: the targets of values that have tokens; values without a target keep theirs."""
    free = 0.0 if OTHER in target or not total else have.get(OTHER, 0.0) / total
    some = {v: float(target.get(v, 0.0)) for v in have if have[v] > 0 and (v != OTHER or OTHER in target)}
    asked = sum(some.values())
    out = {v: share / asked * (1 - free) for v, share in some.items()} if asked else {}
    return out | ({OTHER: free} if OTHER not in target else {})


def unmet(cells: list[dict], targets: dict[str, dict[str, float]], tolerance: float = 1e-3) -> list[dict]:
    """name, value, wanted, kept: the target shares that the probabilities of the fitted cells miss.  Wanted are the targets
    themselves (over the values that have tokens), whether or not raking could reach them."""
    total = sum(c["tokens"] * c["keep_probability"] for c in cells)
    whole = sum(c["tokens"] for c in cells)
    out = []
    for name, target in targets.items():
        have = {v: sum(c["tokens"] for c in cells if c[name] == v) for v in dict.fromkeys([*target, OTHER])}
        shares = target_shares(have, target, whole)
        for value in have:
            mine = [c for c in cells if c[name] == value]
            wanted = shares.get(value, 0.0)
            kept = sum(c["tokens"] * c["keep_probability"] for c in mine) / total if total else 0.0
            if abs(wanted - kept) > tolerance:
                out.append({"name": name, "value": value, "wanted": wanted, "kept": kept})
    return out


def fit_cells(cells: list[dict], targets: dict[str, dict[str, float]], token_budget: float | None = None,
              min_share: float | None = None) -> list[dict]:
    """Adds weight (share of tokens after raking) and probability to cell rows of categories, docs, tokens.

    ``min_share``: of the tokens at least this share (no more than the budget) stays, if need be off the targets."""
    names = list(targets)
    values = [[*t, *([] if OTHER in t else [OTHER])] for t in targets.values()]
    mass = np.zeros([len(v) for v in values])
    at = {combo: i for combo, i in zip(product(*values), np.ndindex(*mass.shape), strict=True)}
    for c in cells:
        mass[at[tuple(c[n] for n in names)]] = c["tokens"]
    total = mass.sum()
    wanted = []
    for axis, (t, v) in enumerate(zip(targets.values(), values, strict=True)):
        have = mass.sum(axis=tuple(a for a in range(mass.ndim) if a != axis))
        shares = target_shares(dict(zip(v, have.tolist(), strict=True)), t, total)
        wanted.append(np.array([shares.get(x, 0.0) for x in v]))
    weight = rake(mass, wanted)
    ratio = np.divide(weight, mass, out=np.zeros_like(weight), where=mass > 0)
    scale = 1 / ratio.max() if ratio.max() > 0 else 0.0
    if token_budget is not None and total:
        scale = min(scale, token_budget / weight.sum()) if weight.sum() else scale
    if min_share is not None and total:
        goal = min_share * total if token_budget is None else min(min_share * total, token_budget)
        scale = max(scale, raised_scale(mass.ravel(), ratio.ravel(), goal))
    out = []
    for c in cells:
        i = at[tuple(c[n] for n in names)]
        # A cell without tokens has no weight to rake; its documents cost nothing and stay.
        chance = 1.0 if c["tokens"] == 0 else min(1.0, float(ratio[i] * scale))
        out.append(c | {"cell_weight": float(weight[i] / weight.sum()) if weight.sum() else 0.0,
                        "keep_probability": chance})
    return out


def chance_of(id_column: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id",
        text_col: str = "text", topic: str | None = None, token_budget: float | None = None,
        seed: str = "mix", min_share: float | None = None) -> DataFrame:
    """All rows with topic, tokens, cell_weight, keep_probability and sampled.

    ``topic`` names a column to use as topic; None: `length_topic`.  Every other
    key of ``targets`` names a column of the input."""
    targets = targets or TARGETS
    carried = [c for c in docs.columns if c not in ADDED or c == topic]
    counted = docs.select(F.struct(*[docs[c] for c in carried]).alias("_row"), count_tokens(docs[text_col]).alias("_tokens"),
                          chance_of(docs[id_col], seed).alias("_chance"), *[docs[n].alias(f"_from_{n}") for n in targets if n != "topic"],
                          *([docs[topic].cast("string").alias("_topic")] if topic else []))
    value = F.col("_topic") if topic else length_topic(F.col("_tokens"))
    cell = [_category(value if n == "topic" else F.col(f"_from_{n}"), targets[n]).alias(f"_{n}_cell") for n in targets]
    keys = [f"_{n}_cell" for n in targets]
    cells = (counted.select(*cell, "_tokens").groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("docs"), F.sum("_tokens").alias("tokens")).collect())  # bounded by the targets
    fitted = fit_cells([{n: r[f"_{n}_cell"] for n in targets} | {"docs": r["docs"], "tokens": r["tokens"]} for r in cells], targets,
                       token_budget, min_share)
    whole = sum(c["tokens"] for c in fitted)
    _LOG.info("the mix keeps %.2f %% of %d words", 100 * sum(c["tokens"] * c["keep_probability"] for c in fitted) / max(whole, 1), whole)
    for miss in unmet(fitted, targets):
        _LOG.warning("share of %(name)s %(value)s: %(wanted).4f wanted, %(kept).4f kept", miss)
    spark = docs.sparkSession
    schema = ", ".join(f"`{k}` string" for k in keys) + ", cell_weight double, keep_probability double"
    table = spark.createDataFrame([(*[c[n] for n in targets], c["cell_weight"], c["keep_probability"]) for c in fitted], schema)
    joined = counted.select("*", *cell, value.alias("_value")).join(F.broadcast(table), keys)
    own = {"topic": F.col("_value"), "tokens": F.col("_tokens"), "cell_weight": F.col("cell_weight"),
           "keep_probability": F.col("keep_probability"), "sampled": F.col("_chance") < F.col("keep_probability")}
    return joined.select("_row.*", *[v.alias(k) for k, v in own.items() if k not in carried])
