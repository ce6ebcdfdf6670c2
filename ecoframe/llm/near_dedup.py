"""Near-duplicate documents by an LSH forest over MinHash signatures.

Every document's shingle set gets ``trees`` signatures of ``depth`` 16-bit MinHash
labels.  Documents with equal sets are one class; from here on only the smallest id of
each class takes part.  Per tree the signatures are sorted over the whole corpus
(range partitions, so no key holds a task up), and a document's neighbours in
that order, which share its longest prefix, are its candidates: the depth thus adapts to
the region, deep where documents crowd, down to ``min_depth`` labels where few are.
Candidate pairs are confirmed on the full sets and give first components.

A sorted neighbour is one candidate, while a crowded region may hide a further link.
So every region (documents that share ``min_depth`` labels of a tree) that still holds
several components is finished exactly: its members outside the region's largest component
are compared with all members, in blocks, on their signatures, and every pair whose
agreement is not more than four standard errors below the threshold is confirmed
on the full sets in the same task, which returns links only, one for each pair of a member and another
component.  Links inside one component can't change it, so none that matters is left
out.  A pair at the threshold shares no region in any tree with probability
``(1 - threshold ** min_depth) ** trees``, 7e-5 for the defaults.

Defined cases: null, empty and blank texts have an empty set, are linked with
nothing and stay; a text of fewer words than ``width`` has one shingle; a row
without an id is linked with nothing and stays; rows that repeat an id are one document,
linked through any of their sets; an empty table gives an empty result; columns other than id
and text are not read by `link_documents` and carried by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.llm import shingles
from ecoframe.llm.components import components
from ecoframe.llm.stages import Stages, partitions, salted_join

TREES, DEPTH, MIN_DEPTH = 24, 8, 5
BLOCK = 1024

_RNG = np.random.default_rng(7)
_XOR = _RNG.integers(0, 2**63, TREES * DEPTH * 4, dtype=np.uint64) << np.uint64(1)
_ODD = _RNG.integers(0, 2**63, TREES * DEPTH * 4, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def signatures(hashes: np.ndarray, sizes: np.ndarray, labels: int) -> np.ndarray:
    """MinHash labels (rows: the non-empty sets; 16 bits each, big-endian)."""
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), labels), ">u2")
    for j in range(labels if len(sizes) else 0):
        least = np.minimum.reduceat((hashes ^ _XOR[j]) * _ODD[j], starts)
        out[:, j] = shingles.mix(least) >> np.uint64(48)
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int, trees: int, depth: int) -> DataFrame:
    """id, n_shingles, digest (of the set) and signature of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = shingles.as_bytes(batch.column(1))
            for a, b in shingles.chunks(texts):
                hashes, sizes = shingles.shingle_sets(texts[a:b], width)
                full = sizes > 0
                starts = (np.cumsum(sizes) - sizes)[full]
                digest = np.zeros((b - a, 2), np.uint64)
                if len(starts):
                    digest[full, 0] = np.add.reduceat(hashes, starts)
                    digest[full, 1] = np.add.reduceat(shingles.mix(hashes + np.uint64(1)), starts)
                labels = iter([x.tobytes() for x in signatures(hashes, sizes, trees * depth)])
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()),
                     pa.array([x.tobytes() for x in digest], pa.binary()),
                     pa.array([next(labels) if f else None for f in full], pa.binary())],
                    names=["id", "n_shingles", "digest", "signature"])

    return (docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
            .mapInArrow(compute, "id long, n_shingles long, digest binary, signature binary"))


def tree_rows(heads: DataFrame, trees: int, depth: int) -> DataFrame:
    """tree, key (its labels) and all other columns but the signature, for each tree."""
    size = depth * 2
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    rest = [c for c in heads.columns if c != "signature"]
    return (heads.select(*rest, "signature", tree)
            .select(*rest, "tree", F.expr(f"substring(signature, tree * {size} + 1, {size})").alias("key")))


def neighbours(heads: DataFrame, stages: Stages, trees: int, depth: int, min_depth: int) -> DataFrame:
    """Pairs (a < b) of neighbours in a tree's sorted order that share ``min_depth`` labels."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, tree=None, key=None):
            n = len(a)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                    pa.array([tree] * n, pa.int32()), pa.array([key] * n, pa.binary())],
                                   names=["a", "b", "tree", "key"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column("tree").to_numpy()
            ids = batch.column("id").to_numpy()
            keys = batch.column("key").to_pylist()
            prefix = np.array([k[:2 * min_depth] for k in keys], f"V{2 * min_depth}")
            if last is None:  # the ends of a partition meet their neighbours in `ends`
                yield out([int(ids[0])], [None], int(tree[0]), keys[0])
            else:
                tree, ids, prefix = (np.concatenate([x, y]) for x, y in zip(last, (tree, ids, prefix), strict=True))
            near = (tree[1:] == tree[:-1]) & (prefix[1:] == prefix[:-1])
            yield out(ids[:-1][near], ids[1:][near])
            last, end = (tree[-1:], ids[-1:], prefix[-1:]), keys[-1]
        if last is not None:
            yield out([int(last[1][0])], [None], int(last[0][0]), end)

    n = partitions(heads.sparkSession)
    found = stages.write(
        tree_rows(heads.select("id", "signature"), trees, depth).repartitionByRange(n, "tree", "key", "id")
        .sortWithinPartitions("tree", "key", "id").select("tree", "key", "id")
        .mapInArrow(scan, "a long, b long, tree int, key binary"), "neighbours")
    # Two rows a partition; as (tree, key, id) sorts them, an end is followed by the next partition's beginning.
    ends = found.filter("b IS NULL").select("tree", "key", F.col("a").alias("id"))
    spot = ends.repartition(1).sortWithinPartitions("tree", "key", "id").mapInArrow(scan, "a long, b long, tree int, key binary")
    pairs = found.select("a", "b").filter("b IS NOT NULL").union(spot.select("a", "b").filter("b IS NOT NULL"))
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = shingles.as_bytes(batch.column("text_a")), shingles.as_bytes(batch.column("text_b"))
            texts = [t for both in zip(left, right, strict=True) for t in both]
            begin, size = 0, 0
            for end in range(2, len(texts) + 2, 2):
                size += len(texts[end - 2]) + len(texts[end - 1])
                if size >= shingles.CHUNK_BYTES or end == len(texts):
                    hashes, sizes = shingles.shingle_sets(texts[begin:end], width)
                    pair = np.repeat(np.arange(len(sizes)), sizes) // 2
                    order = np.lexsort((hashes, pair))
                    h, p = hashes[order], pair[order]
                    common = np.bincount(p[1:][(h[1:] == h[:-1]) & (p[1:] == p[:-1])], minlength=len(sizes) // 2)
                    union = sizes[::2] + sizes[1::2] - common
                    good = np.flatnonzero((common * 100 >= percent * union) & (union > 0))
                    if len(good):
                        at = pa.array(good + begin // 2)
                        yield pa.record_batch([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])
                    begin, size = end, 0

    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")).hint("merge")
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long").distinct()


def texts_of(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text of the documents in ``pairs``.  A merge join at every size: the documents are the
    large side, and a plan that changed with the candidates' number would hide how it grows."""
    nodes = pairs.select("a").union(pairs.select("b")).distinct().select(F.col("a").alias("id"))
    return (docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
            .join(nodes.hint("merge"), "id", "left_semi"))


def rest_of_regions(heads: DataFrame, parts: DataFrame, texts: DataFrame, stages: Stages, width: int, trees: int,
                    depth: int, min_depth: int, percent: int) -> DataFrame:
    """Links between two components of one region, at least one for every two that are linked."""
    share = percent / 100
    least = share - 4 * (share * (1 - share) / (trees * depth)) ** 0.5
    labelled = stages.write(
        heads.join(texts.select("id"), "id", "left_semi").join(parts, "id", "left")
        .select("id", "signature", F.coalesce("component", "id").alias("component")), "labelled")
    members = tree_rows(labelled, trees, depth).withColumn("region", F.expr(f"substring(key, 1, {2 * min_depth})"))
    by_part = members.groupBy("tree", "region", "component").agg(F.count(F.lit(1)).alias("n"))
    regions = (by_part.groupBy("tree", "region")
               .agg(F.sum("n").alias("n"), F.max("n").alias("top_n"), F.count(F.lit(1)).alias("parts"),
                    F.max_by("component", F.struct("n", "component")).alias("top"))
               .filter("parts > 1 AND n > 2")
               .select("tree", "region", "top", F.ceil(F.col("n") / BLOCK).alias("blocks"),
                       F.ceil((F.col("n") - F.col("top_n")) / BLOCK).alias("strays")))
    placed = (salted_join(members.drop("key"), regions, ["tree", "region"], "id")
              .join(labelled.select("id", "signature"), "id").join(texts, "id"))
    every = placed.select(
        "tree", "region", "id", "component", "signature", "text", F.lit(False).alias("stray"),
        F.pmod(F.xxhash64("id"), "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("strays") - 1)).alias("against"))
    stray = placed.filter("component <> top").select(
        "tree", "region", "id", "component", "signature", "text", F.lit(True).alias("stray"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id"), "strays").alias("against"))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        labels = np.frombuffer(b"".join(rows["signature"]), ">u2").reshape(len(rows), trees * depth).astype(np.uint16)
        ids, part, strays = rows["id"].to_numpy(), rows["component"].to_numpy(), rows["stray"].to_numpy()
        all_at, found = np.flatnonzero(~strays), []
        inner = labels[all_at].reshape(len(all_at), trees, depth)[:, :, :min_depth]
        sets: dict[int, np.ndarray] = {}

        def shingles_of(at: int) -> np.ndarray:
            if at not in sets:
                sets[at] = shingles.shingle_sets([(rows["text"].iat[at] or "").encode()], width)[0]
            return sets[at]

        for i in np.flatnonzero(strays):
            same = (labels[all_at] == labels[i]).mean(1)
            # A pair is tested in the first tree whose region both share.
            met = (inner == labels[i].reshape(trees, depth)[:, :min_depth]).all(2).argmax(1)
            near = all_at[(same >= least) & (part[all_at] != part[i]) & (met == key[0])]
            near, linked = near[np.argsort(-same[np.searchsorted(all_at, near)], kind="stable")], set()
            mine = shingles_of(i)
            for j in near:  # the likeliest first; one link to a component is enough
                if part[j] not in linked:
                    other = shingles_of(j)
                    at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                    common = int((mine[at] == other).sum())
                    if common * 100 >= percent * (len(mine) + len(other) - common):
                        linked.add(part[j])
                        found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (every.unionByName(stray).groupBy("tree", "region", "block", "against")
            .applyInPandas(compare, "a long, b long").distinct())


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
                   trees: int = TREES, depth: int = DEPTH, min_depth: int = MIN_DEPTH) -> DataFrame:
    """id, n_shingles, component_id, kept of every row."""
    stages = Stages(docs.sparkSession, "near-dedup")
    sketches = stages.write(sketch(docs, id_col, text_col, width, trees, depth), "sketches")
    linkable = sketches.filter("n_shingles > 0 AND id IS NOT NULL")
    heads = stages.write(linkable.groupBy("digest", "n_shingles")
                         .agg(F.min("id").alias("id"), F.min_by("signature", "id").alias("signature")), "heads")
    pairs = stages.write(neighbours(heads, stages, trees, depth, min_depth), "pairs")
    texts = stages.write(texts_of(pairs, docs, id_col, text_col), "texts")
    links = confirm(pairs, texts, width, percent)
    ids = linkable.select("id", "digest", "n_shingles").distinct()
    several = ids.join(ids.groupBy("id").count().filter("count > 1"), "id", "left_semi")
    repeated = (several.join(heads.select("digest", "n_shingles", F.col("id").alias("b")), ["digest", "n_shingles"])
                .select(F.col("id").alias("a"), "b"))
    links = stages.write(links.union(repeated), "links")
    parts = components(links, stages, "parts")
    more = stages.write(rest_of_regions(heads, parts, texts, stages, width, trees, depth, min_depth, percent), "more-links")
    if more.take(1):
        # Found components stand for the links inside them.
        parts = components(parts.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more), stages, "all-parts")
    stages.remove("neighbours", "pairs", "texts", "links", "labelled", "more-links")
    classes = (heads.select("digest", "n_shingles", "id").join(parts, "id", "left")
               .select("digest", "n_shingles", F.coalesce("component", "id").alias("component")))
    rows = salted_join(sketches.select("id", "n_shingles", "digest"), classes, ["digest", "n_shingles"], "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of one document (the smallest id) of each group, with their columns."""
    gone = link_documents(docs, id_col, text_col, **options).filter("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("_gone"), "left_anti")
