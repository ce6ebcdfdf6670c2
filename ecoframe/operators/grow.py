"""Regression forests of large tables, grown tree by tree from the candidate splits' numbers.

MLlib deals the rows to tasks and sends tables of all open nodes of all trees in every pass; its cost goes with rows x flags.
Here every task holds all training rows as one byte a column (the number of the candidate interval, or of the category)
and grows some of the trees whole.  The columns lie in unlinked files that are mapped: masks and, with many open nodes, an order
(up to 12 bytes a row) are what a task holds in memory.  All flags of a categorical column are counted at once, by category.

What a tree is grown from and when it stops are MLlib's: candidate splits from a sample of 65,536 rows, the best reduction of
variance among a node's features, Poisson draws, no split without gain, sibling leaves of equal value are one.
Equal training rows come as one with a weight; a bootstrap of n equal rows is one draw from Poisson(n).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.functions.expressions import col_of
from ecoframe.operators.forest import LEAF, copy_parts, save_forest
from ecoframe.session import scratch_path

SAMPLE = 65_536  # rows that candidate splits are learned from, as in MLlib with 256 bins
PIECE = 2_048  # rows of a sent piece
CHUNK = 1 << 18  # rows counted at once
BLOCK = 2_048  # open nodes whose tables are held at once
MAPPED = 1 << 24  # bytes from which an array is a mapped file
NOISE = 1e-12  # share of a node's squares below which a difference is rounding

NODES = "tree int, id int, prediction double, impurity double, stats array<double>, raw bigint, gain double, " \
        "l int, r int, feature int, categories array<double>, n_categories int"


def candidates(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between the sampled values: all, or those that cut the weight into about ``bins`` equal parts."""
    v, at = np.unique(values, return_inverse=True)
    if len(v) <= bins:
        return (v[:-1] + v[1:]) / 2
    count = np.bincount(at, weights=weights)
    stride, out, so_far = count.sum() / bins, [], count[0]
    target = stride
    for i in range(1, len(v)):
        before, so_far = so_far, so_far + count[i]
        if abs(before - target) < abs(so_far - target):
            out.append((v[i - 1] + v[i]) / 2)
            target += stride
    return np.array(out[:bins - 1])


def _array(shape: tuple, dtype: type) -> np.ndarray:
    """An empty array; a large one lies in a file without a name, which goes with it."""
    if int(np.prod(shape)) * np.dtype(dtype).itemsize < MAPPED:
        return np.empty(shape, dtype)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, dtype, "w+", shape=shape)


def _chunks(n: int, first: int = 0) -> Iterator[slice]:
    for a in range(first, n, CHUNK):
        yield slice(a, min(a + CHUNK, n))


class Rows:
    """Training rows: interval or category numbers (columns x rows), label less ``centre``, weight."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray):
        self.x, self.y, self.w, self.n = x, y, w, len(y)

    def kept(self, keep, w=None, slot=None) -> tuple[Rows, np.ndarray | None]:
        """The rows (and their ``slot``) that ``keep`` marks, a mask of all rows; ``w`` are other weights."""
        w, n = self.w if w is None else w, int(np.count_nonzero(keep))
        out = Rows(_array((len(self.x), n), np.uint8), _array((n,), np.float64), _array((n,), np.float32))
        slots, to = None if slot is None else _array((n,), np.int32), 0
        for c in _chunks(self.n):
            k = keep[c]
            m = int(np.count_nonzero(k))
            for i, column in enumerate(self.x):
                out.x[i, to:to + m] = column[c][k]
            out.y[to:to + m], out.w[to:to + m] = self.y[c][k], w[c][k]
            if slot is not None:
                slots[to:to + m] = slot[c][k]
            to += m
        return out, slots

    def ordered(self, order: np.ndarray) -> Rows:
        out = Rows(_array(self.x.shape, np.uint8), _array((self.n,), np.float64), _array((self.n,), np.float32))
        for c in _chunks(self.n):
            o = order[c]
            for i, column in enumerate(self.x):
                out.x[i, c] = column[o]
            out.y[c], out.w[c] = self.y[o], self.w[o]
        return out


def _counted(keys, rows: Rows, slot: np.ndarray, span: slice, size: int, powers: tuple) -> list[np.ndarray]:
    """Sums of weight x label^p by ``keys(chunk, slots)`` over the rows of ``span``."""
    out = [np.zeros(size) for _ in powers]
    for c in _chunks(span.stop, span.start):
        key, w, y = keys(c, slot[c]), rows.w[c].astype(np.float64), rows.y[c]
        for total, p in zip(out, powers, strict=True):
            total += np.bincount(key, w if p == 0 else w * y if p == 1 else w * y * y, minlength=size)
    return out


def _score(n, s, n_all, s_all, least: float) -> np.ndarray:
    """What a split explains: squared sums over weights of both sides; -inf where a side has less than ``least``."""
    m, t = n_all - n, s_all - s
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n >= least) & (m >= least), s * s / n + t * t / m, -np.inf)


class Layout:
    """Columns of the rows: the numbers with their thresholds, then the categorical ones as (first feature, categories)."""

    def __init__(self, thresholds: list, categorical: list, features: int):
        self.thresholds, self.categorical, self.features = thresholds, categorical, features
        self.bins = [len(t) + 1 for t in thresholds] + [k for _, k in categorical]


def _best(rows: Rows, slot: np.ndarray, span: slice, first: int, n: np.ndarray, s: np.ndarray, allowed: np.ndarray, layout: Layout,
          least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best split of nodes ``first``...: score, feature, interval (0 for a flag), is category 1 the left one?"""
    k = len(n)
    best, feature, at, one_left = np.full(k, -np.inf), np.zeros(k, int), np.zeros(k, int), np.zeros(k, bool)

    def take(score, f, where=0, left=False):
        nonlocal best, feature, at, one_left
        won = allowed[:, f] & (score > best)
        best, feature, at, one_left = np.where(won, score, best), np.where(won, f, feature), np.where(won, where, at), np.where(won, left, one_left)

    for i, b in enumerate(layout.bins):
        if b < 2:
            continue
        number = i < len(layout.thresholds)
        flags = range(0) if number else range(layout.categorical[i - len(layout.thresholds)][0], layout.categorical[i - len(layout.thresholds)][0] + b)
        if not (allowed[:, i] if number else allowed[:, flags.start:flags.stop]).any():
            continue
        column = rows.x[i]
        hn, hs = (h.reshape(k, b) for h in _counted(lambda c, t: (t - np.int32(first)) * np.int32(b) + column[c], rows, slot, span, k * b, (0, 1)))
        if number:
            score = _score(np.cumsum(hn, 1)[:, :-1], np.cumsum(hs, 1)[:, :-1], n[:, None], s[:, None], least)
            where = score.argmax(1)
            take(score[np.arange(k), where], i, where)
        else:
            score = _score(hn, hs, n[:, None], s[:, None], least)
            with np.errstate(divide="ignore", invalid="ignore"):
                lower = hs / hn < (s[:, None] - hs) / (n[:, None] - hn)
            for j, f in enumerate(flags):
                take(score[:, j], f, 0, lower[:, j])
    return best, feature, at, one_left


def _children(rows: Rows, slot: np.ndarray, layout: Layout, split: np.ndarray, feature: np.ndarray, at: np.ndarray,
              one_left: np.ndarray) -> np.ndarray:
    """The next level's slot of every row, -1 below a leaf: left and right of the i-th split are 2i and 2i + 1."""
    numbers = len(layout.thresholds)
    column, left = np.zeros(len(split), np.int64), np.zeros((len(split), 256), bool)
    for j in np.flatnonzero(split):
        f = feature[j]
        if f < numbers:
            column[j], left[j, :at[j] + 1] = f, True
        else:
            i = next(i for i, (start, b) in enumerate(layout.categorical) if start <= f < start + b)
            column[j], left[j] = numbers + i, not one_left[j]
            left[j, f - layout.categorical[i][0]] = one_left[j]
    child = np.where(split, 2 * (np.cumsum(split) - 1), -1)
    flat, out = left.ravel(), _array((rows.n,), np.int32)
    for c in _chunks(rows.n):
        t = slot[c]
        value = rows.x[:, c][column[t], np.arange(len(t))]
        out[c] = np.where(split[t], child[t] + ~flat[t.astype(np.int64) * 256 + value], -1) if len(t) else t
    return out


def grow(rows: Rows, layout: Layout, rng: np.random.Generator, subset: int, depth: int, least: float, min_split: float) -> list[dict]:
    """Levels of a tree: per node weight, sums, rows, and for splits feature, interval, side and gain."""
    slot, levels, k = _array((rows.n,), np.int32), [], 1
    slot[:] = 0
    while k:
        whole = slice(0, rows.n)
        if k > BLOCK and (slot[1:] < slot[:-1]).any():  # nodes are counted in blocks, each from its own stretch of rows
            order = np.argsort(slot, kind="stable")
            rows, slot = rows.ordered(order), slot[order]
        n, s, q = _counted(lambda c, t: t, rows, slot, whole, k, (0, 1, 2))
        raw = np.bincount(slot, minlength=k)
        open_ = (n >= min_split) & (q - s * s / n > NOISE * q) & (len(levels) < depth)
        feature, at, one_left, gain = np.zeros(k, int), np.zeros(k, int), np.zeros(k, bool), np.full(k, -1.0)
        for a in range(0, k, BLOCK):
            b = min(k, a + BLOCK)
            if not open_[a:b].any():
                continue
            span = whole if k <= BLOCK else slice(*np.searchsorted(slot, [a, b]).tolist())
            allowed = np.ones((b - a, layout.features), bool)
            if subset < layout.features:
                allowed = np.argsort(np.argsort(rng.random((b - a, layout.features)), 1), 1) < subset
            score, feature[a:b], at[a:b], one_left[a:b] = _best(rows, slot, span, a, n[a:b], s[a:b], allowed, layout, least)
            gain[a:b] = np.maximum(score - s[a:b] ** 2 / n[a:b], -1)
        split = open_ & (gain > NOISE * q)
        levels.append(dict(n=n, s=s, q=q, raw=raw, split=split, feature=feature, at=at, one_left=one_left, gain=gain / n))
        k = 2 * int(split.sum())
        if k:
            slot = _children(rows, slot, layout, split, feature, at, one_left)
            alive = slot >= 0
            if not alive.all():
                rows, slot = rows.kept(alive, slot=slot)
    return levels


def node_rows(levels: list[dict], layout: Layout, tree: int, centre: float) -> pa.RecordBatch:
    """The levels as rows of `NODES`: sibling leaves of equal value are one, ids go down the left side first."""
    size = [np.ones(len(v["n"]), int) for v in levels]
    for d in reversed(range(len(levels))):
        v = levels[d]
        v["value"] = v["s"] / v["n"] + centre
        v["first"] = 2 * (np.cumsum(v["split"]) - 1)  # the left child's place in the next level
        places = np.flatnonzero(v["split"])
        if len(places):
            at, lower = v["first"][places], levels[d + 1]
            same = ~lower["split"][at] & ~lower["split"][at + 1] & (lower["value"][at] == lower["value"][at + 1])
            size[d][places] += np.where(same, 0, size[d + 1][at] + size[d + 1][at + 1])
            v["split"][places[same]] = False
    out: dict[str, list] = {name: [] for name in ("id", "level", "place", "left", "right")}
    ids, present = np.zeros(1, int), np.ones(1, bool)
    for d, v in enumerate(levels):
        left, right = np.full(len(ids), LEAF), np.full(len(ids), LEAF)
        places = np.flatnonzero(v["split"] & present)
        if d + 1 < len(levels):
            next_ids, next_present = np.zeros(len(levels[d + 1]["n"]), int), np.zeros(len(levels[d + 1]["n"]), bool)
            at = v["first"][places]
            left[places] = ids[places] + 1
            right[places] = left[places] + size[d + 1][at]
            next_ids[at], next_ids[at + 1], next_present[at], next_present[at + 1] = left[places], right[places], True, True
        held = np.flatnonzero(present)
        for name, values in (("id", ids[held]), ("level", np.full(len(held), d)), ("place", held), ("left", left[held]), ("right", right[held])):
            out[name].append(values)
        if d + 1 < len(levels):
            ids, present = next_ids, next_present
    flat = {name: np.concatenate(values) for name, values in out.items()}
    of = lambda name: np.concatenate([levels[d][name][out["place"][d]] for d in range(len(levels))])
    n, s, q, split = of("n"), of("s"), of("q"), flat["left"] != LEAF
    feature, at, one_left = of("feature"), of("at"), of("one_left")
    sides = [[] if not cut else [float(layout.thresholds[f][a])] if f < len(layout.thresholds) else [float(o)]
             for cut, f, a, o in zip(split, feature, at, one_left, strict=True)]
    total, squares = s + n * centre, q + 2 * centre * s + n * centre * centre
    columns = [np.full(len(n), tree, np.int32), flat["id"].astype(np.int32), total / n, np.maximum(q / n - (s / n) ** 2, 0.0),
               pa.array(list(np.stack([n, total, squares], 1))), of("raw").astype(np.int64), np.where(split, of("gain"), -1.0),
               flat["left"].astype(np.int32), flat["right"].astype(np.int32), np.where(split, feature, -1).astype(np.int32), pa.array(sides, pa.list_(pa.float64())),
               np.where(split & (feature >= len(layout.thresholds)), 2, -1).astype(np.int32)]
    names = [c.split()[0] for c in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names)


def _packed(layout: Layout, centre: float):
    """Batches of (numbers..., category numbers..., label, weight, _piece) as pieces of columns, one byte a number."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if any(c.null_count for c in batch.columns) or any(np.isnan(c).any() for c in columns):
                raise ValueError("a training row has a null or NaN")
            *values, label, weight, piece = columns
            x = [np.searchsorted(t, v, "left") for t, v in zip(layout.thresholds, values, strict=False)] + list(values[len(layout.thresholds):])
            for a in range(0, batch.num_rows, PIECE):
                part, m = slice(a, a + PIECE), len(label[a:a + PIECE])
                body = b"".join(c[part].astype(np.uint8).tobytes() for c in x) + (label[part] - centre).astype(np.float64).tobytes() \
                    + weight[part].astype(np.float32).tobytes()
                yield pa.RecordBatch.from_pydict({"piece": pa.array([int(piece[0])], pa.int64()), "seq": pa.array([seq], pa.int64()),
                                                  "n": pa.array([m], pa.int32()), "body": pa.array([body], pa.binary())})
                seq += 1

    return pack


def _received(batches: Iterator[pa.RecordBatch], columns: int) -> tuple[Rows, list, list]:
    """Rows of the pieces that came, (piece, seq, n) in their order, and the groups of trees asked for."""
    files, pieces, groups = [tempfile.TemporaryFile() for _ in range(columns + 2)], [], {}
    for batch in batches:
        for g, piece, seq, n, body in zip(*(batch.column(c) for c in ("g", "piece", "seq", "n", "body")), strict=True):
            groups[g.as_py()] = True
            if g.as_py() != next(iter(groups)):  # another group's copy of the same rows
                continue
            m, view = n.as_py(), memoryview(body.as_buffer())
            for i, f in enumerate(files):
                size = m if i < columns else 8 * m if i == columns else 4 * m
                f.write(view[:size])
                view = view[size:]
            pieces.append((piece.as_py(), seq.as_py(), m))
    total = sum(p[2] for p in pieces)
    if not total:
        return Rows(np.empty((columns, 0), np.uint8), np.empty(0), np.empty(0, np.float32)), [], list(groups)
    for f in files:
        f.flush()
    x = _array((columns, total), np.uint8)
    for i in range(columns):
        x[i] = np.memmap(files[i], np.uint8, "r", shape=(total,))
    rows = Rows(x, np.memmap(files[-2], np.float64, "r", shape=(total,)), np.memmap(files[-1], np.float32, "r", shape=(total,)))
    for f in files:
        f.close()
    return rows, pieces, list(groups)


def _grown(layout: Layout, trees: dict, centre: float, seed: int, bootstrap: bool, **how):
    """Trees of the groups whose pieces a task gets (group -> its trees)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, pieces, groups = _received(batches, len(layout.bins))
        for tree in (t for g in groups for t in trees[g]):
            mine = rows
            if bootstrap:
                w, to = _array((rows.n,), np.float32), 0
                for piece, seq, n in pieces:  # drawn by piece, so it does not matter in which order the pieces came
                    w[to:to + n] = np.random.default_rng([seed, tree, piece, seq]).poisson(rows.w[to:to + n])
                    to += n
                mine, _ = rows.kept(w > 0, w)
            yield node_rows(grow(mine, layout, np.random.default_rng([seed, tree]), **how), layout, tree, centre)

    return run


def fit_forest(rows: DataFrame, features: PipelineModel, estimator: RandomForestRegressor, numeric: list, categorical: list,
               weight: str, min_split: float = 0) -> RandomForestRegressionModel:
    """The forest of ``estimator`` over written ``rows`` (``label``, the columns and ``weight``), whose feature stages are fitted."""
    spark = rows.sparkSession
    placed = features.transform(rows)
    # the saved form of a forest over two rows is the frame: parameters, number of features, names
    few = placed.limit(2).cache()
    frame = estimator.fit(few.unionAll(few))
    first = few.first()
    few.unpersist()
    slots, at = [], len(numeric)
    for c in categorical:
        slots.append((at, first[f"{c}_vec"].size))
        at += first[f"{c}_vec"].size
    if at != frame.numFeatures or any(k > 256 for _, k in slots):
        raise ValueError("the features are not the numbers and flags of at most 256 categories")

    count = rows.count()
    numbers = [col_of(c).cast("double").alias(f"_{i}") for i, c in enumerate(numeric)]
    sample = rows.select(*numbers, "label", weight).sample(min(1.0, SAMPLE / count), estimator.getSeed() & 0x7FFFFFFF).collect()
    sampled = np.array([list(r) for r in (sample or [rows.select(*numbers, "label", weight).first()])], dtype=float)
    layout = Layout([candidates(sampled[:, i], sampled[:, -1], estimator.getMaxBins()) for i in range(len(numeric))], slots, frame.numFeatures)
    centre = float(np.round(np.average(sampled[:, -2], weights=sampled[:, -1])))

    n_trees, parts = estimator.getNumTrees(), min(estimator.getNumTrees(), spark.sparkContext.defaultParallelism)
    places = spark.range(64 * parts).selectExpr("id", f"pmod(hash(id), {parts}) AS p").groupBy("p").agg(F.min("id").alias("id")).collect()
    groups = [r["id"] for r in sorted(places, key=lambda r: r["p"])]  # ids that hash to different partitions
    trees = {g: list(range(i, n_trees, len(groups))) for i, g in enumerate(groups)}
    codes = [F.col(f"{c}_idx").cast("double").alias(f"_c{i}") for i, c in enumerate(categorical)]
    packed = placed.select(*numbers, *codes, col_of("label").alias("_label"), col_of(weight).cast("double").alias("_w"), F.spark_partition_id().cast("double").alias("_piece")) \
        .mapInArrow(_packed(layout, centre), "piece long, seq long, n int, body binary")
    dealt = packed.withColumn("g", F.explode(F.array(*[F.lit(g).cast("long") for g in groups]))).repartition(parts, "g")
    share = estimator.getFeatureSubsetStrategy()
    nodes = dealt.mapInArrow(_grown(layout, trees, centre, estimator.getSeed(), estimator.getOrDefault("bootstrap"),
                                    subset=layout.features if share == "all" else int(np.ceil(float(share) * layout.features)),
                                    depth=estimator.getMaxDepth(), least=float(estimator.getMinInstancesPerNode()), min_split=min_split), NODES)
    path, target = save_forest(frame, scratch_path(spark, "forest-frame")), scratch_path(spark, "forest-grown")
    split = F.struct(F.col("feature").alias("featureIndex"), F.col("categories").alias("leftCategoriesOrThreshold"), F.col("n_categories").alias("numCategories"))
    nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain", F.col("l").alias("leftChild"),
        F.col("r").alias("rightChild"), split.alias("split")).alias("nodeData")).write.parquet(f"{target}/data")
    copy_parts(spark, path, target)
    return RandomForestRegressionModel.load(target)
