"""Repeated substrings by the common-prefix interval tree of a sparse suffix array.

Every byte that a ``length``-byte string covers which also starts anywhere else (in
any document, overlaps included) is found, and can be removed.

*Anchors* make the corpus sparse and deal it out: of every window of
``length`` bytes the leftmost smallest hash among its ``GRAM``-byte grams is an anchor, so
two equal windows have an anchor at the same place.  Only the suffixes at anchors are
sorted, and only anchors whose gram occurs twice take part.  What surrounds an anchor
(``length - GRAM`` bytes before it, ``length`` from it on) is its content; every window
over the anchor lies in it.

1. A gram with one content is a repeat group of that whole content; its occurrences are counted.
2. Different contents round one gram are fetched (one occurrence each; contents that occur more
   often stand there twice) and put through the enhanced suffix array: right contexts sorted,
   their common-prefix lengths scanned with a stack into the interval tree, and inside every
   interval the left contexts likewise.  An interval pair whose left extensions differ is a
   maximal repeat (`maximal_repeats`), written with all contents that hold it, one row each.
3. A gram with more than ``MAX_CONTENTS`` different contents (a boundary of a very
   common passage) is done by aggregates (`crowded_members`): prefixes of the contexts that branch
   are counted on both sides, and of their pairs those that branch on both sides are the same maximal
   repeats.  Nothing is capped.

Only a repeat with a window whose anchor this is counts (`anchored`): every occurrence of it has the
anchor, so the group is complete.  `repeat_groups` gives the groups with one row per occurrence,
`remove_repeats` the bytes that they cover.  A group reaches at most ``length - GRAM`` bytes before its anchor
and ``length`` from it on; of a longer repeat every anchor has its own group, cut there.

Defined cases: null is empty text; documents shorter than ``length`` keep all bytes; rows
that repeat id and text repeat each other; rows that repeat an id are told apart
by their text; a null id is allowed; an empty table gives an empty result; columns other than
id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.llm import shingles
from ecoframe.llm.stages import Stages, partitions

LENGTH = 200
GRAM = 64
MAX_CONTENTS = 16_384
PIECE = 8 << 20
_PLACE = (1 << 40) - 1

_RNG = np.random.default_rng(11)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_P = np.uint64(0xD6E8FEB86659FD93)
_P_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0][0]) < n:
        up = np.full((2, max(n, 1 << 20)), 1, np.uint64)
        up[0, 1:], up[1, 1:] = _P, _P_INVERSE
        _POWERS[0] = tuple(np.multiply.accumulate(up, axis=1))
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring can be taken."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(len(raw))[0], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of [start, end): equal for equal strings, wherever they lie."""
    return shingles.mix((sums[ends] - sums[starts]) * _powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every run of ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def gram_order(sums: np.ndarray, gram: int) -> np.ndarray:
    """Order of the grams, by which anchors are chosen; the lowest 24 bits are free for the place."""
    order = ((sums[gram:] - sums[:-gram]) * _powers(len(sums))[1][:len(sums) - gram]) * np.uint64(0x9E3779B97F4A7C15)
    order ^= order >> np.uint64(32)
    order *= np.uint64(0xBF58476D1CE4E5B9)
    return order & np.uint64(~((1 << 24) - 1) & (2**64 - 1))


def anchors(raw: np.ndarray, limits: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in it, gram hash, content hash) of the anchors of documents that lie one after another."""
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    if len(raw) < length:
        return none
    sums = prefix_sums(raw)
    order = gram_order(sums, gram)
    order |= np.arange(len(order), dtype=np.uint64)
    least = window_minima(order, length - gram + 1)
    begins = np.append(0, limits[:-1])
    rooms = limits - begins
    usable = np.zeros(len(raw) + 1, np.int32)  # windows that lie in one document
    long = rooms >= length
    np.add.at(usable, begins[long], 1)
    np.add.at(usable, limits[long] - length + 1, -1)
    inside = np.cumsum(usable)[:len(least)] > 0
    at = np.unique(least[inside] & np.uint64((1 << 24) - 1)).astype(np.int64)
    doc = np.searchsorted(limits, at, side="right")
    lo, hi = np.maximum(at - (length - gram), begins[doc]), np.minimum(at + length, limits[doc])
    content = substring_hashes(sums, lo, hi) ^ shingles.mix((at - lo).astype(np.uint64) + np.uint64(1))
    return doc, at - begins[doc], substring_hashes(sums, at, at + gram), content


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """gram, content, id, place, after: one row per anchor.  ``place`` holds bits of the text's hash above the offset,
    ``after`` is the number of the content's bytes from the anchor on."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = shingles.as_bytes(batch.column("text"))
            ids, marks = batch.column("id").to_numpy(), batch.column("mark").to_numpy()
            for a, b in shingles.chunks(texts):
                found = []
                if len(texts[a]) > PIECE:  # one very long text: pieces that overlap, so no window is lost
                    raw = np.frombuffer(texts[a], np.uint8)
                    seen = np.zeros(0, np.int64)
                    for start in range(0, len(raw) - length + 1, PIECE - 4 * length):
                        # Contents need their whole surroundings: anchors near a cut are taken from the piece that holds them.
                        piece = raw[start:start + PIECE]
                        doc, place, g, c = anchors(piece, np.array([len(piece)]), length, gram)
                        first, last = start == 0, start + PIECE >= len(raw)
                        whole = ((place >= length) | first) & ((place + length <= len(piece)) | last) & ~np.isin(place + start, seen)
                        found.append((doc[whole], place[whole] + start, g[whole], c[whole]))
                        seen = place[whole] + start
                        if last:
                            break
                else:
                    sizes = [len(t) for t in texts[a:b]]
                    found.append(anchors(np.frombuffer(b"".join(texts[a:b]), np.uint8), np.cumsum(sizes), length, gram))
                for doc, place, g, c in found:
                    if len(doc):
                        after = np.minimum(length, np.array([len(t) for t in texts[a:b]])[doc] - place)
                        yield pa.record_batch(
                            [pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(ids[a + doc]),
                             pa.array(marks[a + doc] << 40 | place), pa.array(after.astype(np.int32))],
                            names=["gram", "content", "id", "place", "after"])

    return docs.select("id", "mark", "text").mapInArrow(scan, "gram long, content long, id long, place long, after int")


def _common(matrix: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbouring rows."""
    differ = matrix[1:] != matrix[:-1]
    first = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
    return np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)


def lcp_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, common prefix) of the intervals of a suffix array, by one scan with a stack."""
    stack = [(0, 0)]  # (common prefix, first)
    values = lcp.tolist()
    for i, value in enumerate([*values, 0]):
        first = i
        while stack[-1][0] > value:
            depth, first = stack.pop()
            yield first, i, depth
        if value > stack[-1][0]:
            stack.append((value, first))


def maximal_repeats(left: list[bytes], right: list[bytes], length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Maximal repeats of at least ``length`` bytes over one anchor: (bytes before it, bytes from it on, occurrences).

    ``left``: the bytes before each occurrence, reversed; ``right``: those from it on."""
    n = len(left)
    order = sorted(range(n), key=right.__getitem__)
    spot = np.empty(n, np.int64)  # place of an occurrence in the suffix array
    spot[order] = np.arange(n)
    lcp = _common(_matrix([right[i] for i in order], max(map(len, right))), np.array([len(right[i]) for i in order]))
    rank = np.empty(n, np.int64)
    rank[sorted(range(n), key=left.__getitem__)] = np.arange(n)
    lefts, sizes, order = _matrix(left, max(max(map(len, left)), 1)), np.array([len(x) for x in left]), np.array(order)
    for first, last, depth in lcp_intervals(lcp):
        members = order[first:last + 1]
        members = members[np.argsort(rank[members])]
        lcs, need = _common(lefts[members], sizes[members]), length - depth
        if need <= 0 and lcs.min() == 0:  # the right context alone is long enough, and nothing precedes all of them
            yield 0, depth, members
        if lcs.max() >= max(need, 1):
            for a, b, before in lcp_intervals(lcs):
                if before >= need:
                    group = members[a:b + 1]
                    at = spot[group]
                    if lcp[at.min():at.max()].min() == depth:  # else they share more, and belong to an inner interval
                        yield before, depth, group


def anchored(texts: list[bytes], befores: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contents with the anchor after ``befores`` bytes: their hashes, and the least and most bytes before
    the anchor of the windows whose anchor it is."""
    reach = length - gram
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes) - sizes
    sums = prefix_sums(np.frombuffer(b"".join(texts), np.uint8))
    order = gram_order(sums, gram)
    at = begins + befores
    steps = np.arange(1, reach + 1)
    own = order[at][:, None]
    back, ahead = at[:, None] - steps, at[:, None] + steps
    stop = (back < begins[:, None]) | (order[np.maximum(back, 0)] <= own)
    most = np.where(stop.any(1), stop.argmax(1), reach)
    stop = (ahead > (begins + sizes)[:, None] - gram) | (order[np.minimum(ahead, len(order) - 1)] < own)
    hashes = substring_hashes(sums, begins, begins + sizes) ^ shingles.mix(befores.astype(np.uint64) + np.uint64(1))
    return hashes.view(np.int64), reach - np.where(stop.any(1), stop.argmax(1), reach), most


_MEMBERS = "group long, before int, after int, gram long, content long"


def scan_groups(segments: DataFrame, length: int) -> DataFrame:
    """group, before, after, gram, content: one row per maximal repeat and content that holds it.

    ``group`` is the hash of its bytes.  The contents of one gram are few; rows leave as they are found."""

    def repeats_of(rows: list[tuple]) -> Iterator[tuple[int, int, int, np.ndarray]]:
        twice = [r for r in rows for _ in range(2 if r[1] > 1 else 1)]
        contents = np.array([r[0] for r in twice], np.int64)
        for before, after, members in maximal_repeats([r[2] for r in twice], [r[3] for r in twice], length):
            one = twice[members[0]]
            if max(length - after, one[4]) <= min(before, one[5]):
                text = np.frombuffer(one[2][:before][::-1] + one[3][:after], np.uint8)
                name = substring_hashes(prefix_sums(text), np.array([0]), np.array([len(text)])).view(np.int64)[0]
                yield name, before, after, np.unique(contents[members])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0

        def flush():
            counts = [len(o[4]) for o in out]
            columns = [np.repeat(np.array([o[i] for o in out], np.int64), counts) for i in range(4)]
            columns.append(np.concatenate([o[4] for o in out]))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(c).cast(t) for c, t in zip(columns, types, strict=True)],
                                   names=["group", "before", "after", "gram", "content"])

        for key, rows in by_gram(batches):
            for name, before, after, members in repeats_of(list(rows.values())):
                out.append((name, before, after, key, members))
                n += len(members)
                if n > 20_000:
                    yield flush()
                    out, n = [], 0
        if out:
            yield flush()

    def by_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, tuple]]]:
        key, rows = None, {}
        for batch in batches:
            for k, *row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)], strict=True):
                if k != key:
                    if rows:
                        yield key, rows
                    key, rows = k, {}
                rows[row[0]] = row
        if rows:
            yield key, rows

    n = partitions(segments.sparkSession)
    return (segments.select("gram", "content", "n", "left", "right", "low", "high").repartition(n, "gram")
            .sortWithinPartitions("gram").mapInArrow(run, _MEMBERS))


def crowded_members(segments: DataFrame, stages: Stages, length: int, gram: int) -> DataFrame:
    """The rows of `scan_groups` for grams whose contents need not fit a task, by aggregates."""

    def hashes(text: bytes) -> np.ndarray:
        sums = prefix_sums(np.frombuffer(text, np.uint8))
        ends = np.arange(len(text) + 1)
        return substring_hashes(sums, np.zeros_like(ends), ends).view(np.int64)

    def following(text: bytes) -> np.ndarray:
        """The byte after each prefix; -1: none, for the context ends."""
        return np.append(np.frombuffer(text, np.uint8).astype(np.int32), -1)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            found = []
            for r in batch.to_pylist():
                for right, text, least in ((0, r["left"], 0), (1, r["right"], gram)):
                    depth = np.arange(least, len(text) + 1)
                    found.append((np.full(len(depth), r["gram"]), np.full(len(depth), r["content"]), np.full(len(depth), r["n"]),
                                  np.full(len(depth), right), depth, hashes(text)[least:], following(text)[least:]))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)],
                                      names=["gram", "content", "n", "right", "depth", "hash", "next"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            found = []
            for r in batch.to_pylist():
                left, right = r["left"], r["right"]
                b = np.array([d["depth"] for d in r["depths"] if not d["right"]], np.int64)
                a = np.array([d["depth"] for d in r["depths"] if d["right"]], np.int64)
                b, a = (x.ravel() for x in np.meshgrid(b, a))
                good = (a + b >= length) & (np.maximum(length - a, r["low"]) <= np.minimum(b, r["high"]))
                a, b = a[good], b[good]
                sums = prefix_sums(np.frombuffer(left[::-1] + right, np.uint8))
                name = substring_hashes(sums, len(left) - b, len(left) + a).view(np.int64)
                found.append((name, b, a, np.full(len(a), r["gram"]), np.full(len(a), r["content"]), np.full(len(a), r["n"]),
                              following(left)[b], following(right)[a]))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)],
                                      names=["group", "before", "after", "gram", "content", "n", "back", "ahead"])

    def branches(column: str):
        return (F.min(column) != F.max(column)) | (F.min(column) < 0)

    node = ["gram", "right", "depth", "hash"]
    rows = segments.select("gram", "content", "n", "left", "right").mapInArrow(
        prefixes, "gram long, content long, n long, right long, depth long, hash long, next long")
    often = stages.write(rows.groupBy(*node).agg(F.sum("n").alias("n"), branches("next").alias("parts"))
                         .filter("n > 1 AND parts").select(*node), "branches")
    depths = (rows.select(*node, "content").join(often, node, "left_semi").groupBy("gram", "content")
              .agg(F.collect_list(F.struct("right", "depth")).alias("depths")))
    found = stages.write(segments.join(depths, ["gram", "content"]).select(
        "gram", "content", "n", "left", "right", "low", "high", "depths").mapInArrow(
            pairs, "group long, before long, after long, gram long, content long, n long, back long, ahead long"), "pairs")
    key = ["group", "before", "after", "gram"]
    groups = found.groupBy(*key).agg(F.sum("n").alias("n"), (branches("back") & branches("ahead")).alias("parts")).filter("n > 1 AND parts")
    return found.join(groups.select(*key), key, "left_semi").select(
        "group", F.col("before").cast("int").alias("before"), F.col("after").cast("int").alias("after"), "gram", "content")


def repeat_members(docs: DataFrame, stages: Stages, length: int, gram: int, max_contents: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The repeat groups of grams with several contents (group, before, after, gram, content: one row per content that
    holds it), the grams and contents that are a group by themselves, and the anchors (gram, content, id, place, after).

    ``docs``: id, mark, text, packed."""
    reach = length - gram
    found = anchor_rows(docs, length, gram)
    often = stages.write(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "grams")
    shared = stages.write(found.join(often, "gram", "left_semi"), "anchors")
    stages.remove("grams")
    contents = stages.write(shared.groupBy("gram", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "place")).alias("one")), "contents")
    kinds = stages.write(contents.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")), "kinds")
    alone = kinds.filter("kinds = 1").select("gram")
    wanted = (contents.join(kinds.filter("kinds > 1"), "gram").select("gram", "content", "n", "kinds", "one.id", "one.place")
              .groupBy("id", F.shiftrightunsigned("place", 40).alias("mark"))
              .agg(F.collect_list(F.struct("gram", "content", "n", "kinds", "place")).alias("places")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for docs in batches:
            for packed, found in zip(docs.column("packed").to_pylist(), docs.column("places").to_pylist(), strict=True):
                text = unpack.decompress(packed)
                backward, size = text[::-1], len(text)
                for places in (found[i:i + 1024] for i in range(0, len(found), 1024)):
                    places = [p for p in places if p["place"] & _PLACE <= size - gram]
                    at = [p["place"] & _PLACE for p in places]
                    if not at:
                        continue
                    here, low, high = anchored([text[max(0, p - reach):p + length] for p in at],
                                               np.minimum(np.array(at), reach), length, gram)
                    batch = pa.record_batch(
                        [*[pa.array([p[c] for p in places], pa.int64()) for c in ("gram", "content", "n", "kinds")],
                         pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                         pa.array([backward[size - p:size - p + reach] for p in at], pa.binary()),
                         pa.array([text[p:p + length] for p in at], pa.binary())],
                        names=["gram", "content", "n", "kinds", "low", "high", "left", "right"])
                    yield batch.filter(pa.array(here == batch.column("content").to_numpy()))  # else another text of this id and mark

    schema = "gram long, content long, n long, kinds long, low int, high int, left binary, right binary"
    # An id and text that occur twice are fetched twice; they stand for one content.
    segments = stages.write(docs.select("id", "mark", "packed").join(wanted, ["id", "mark"])
                            .select("packed", "places").mapInArrow(cut, schema), "segments")
    members = scan_groups(segments.filter(F.col("kinds") <= max_contents), length)
    crowd = segments.filter(F.col("kinds") > max_contents).dropDuplicates(["gram", "content"])
    if crowd.take(1):
        members = members.unionByName(crowded_members(crowd, stages, length, gram))
    return stages.write(members, "members"), contents.join(alone, "gram", "left_semi").select("gram", "content"), shared


def covered(members: DataFrame, alone: DataFrame, shared: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans (id, place of the anchor, begin, end relative to it) that the repeat groups cover.

    All groups over an anchor hold it, so their union is one stretch."""
    furthest = members.groupBy("gram", "content").agg(F.max("before").alias("before"), F.max("after").alias("end"))
    whole = alone.select("gram", "content", F.lit(length - gram).alias("before"), F.lit(length).alias("end"))
    return (shared.select("gram", "content", "id", "place").join(furthest.unionByName(whole), ["gram", "content"])
            .select("id", "place", (-F.col("before")).alias("begin"), "end"))


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  gram: int = GRAM, max_contents: int = MAX_CONTENTS) -> DataFrame:
    """The maximal repeat groups: group (hash of the repeated bytes), length, id, mark (24 bits of the text's hash), begin;
    one row per occurrence.  Rows that repeat id and text have their occurrences once."""
    stages = Stages(docs.sparkSession, "repeats")
    plain = prepare(docs, id_col, text_col)
    members, alone, shared = repeat_members(_packed(plain), stages, length, gram, max_contents)
    offset = F.col("place").bitwiseAND(_PLACE)
    before = F.least(offset, F.lit(length - gram))

    @F.arrow_udf("long")
    def name(content: pa.Array, before: pa.Array) -> pa.Array:
        """A content's hash without the place of the anchor."""
        return pa.array((content.to_numpy().view(np.uint64) ^ shingles.mix(before.to_numpy().astype(np.uint64) + np.uint64(1))).view(np.int64))

    whole = shared.join(alone, ["gram", "content"], "left_semi").select(
        name("content", before).alias("group"), (before + F.col("after")).cast("int").alias("length"), "id", "place", (offset - before).alias("begin"))
    parts = shared.drop("after").join(members, ["gram", "content"]).select(
        "group", (F.col("before") + F.col("after")).alias("length"), "id", "place", (offset - F.col("before")).alias("begin"))
    return (whole.unionByName(parts).select("group", "length", F.col("id").alias(id_col),
                                            F.shiftrightunsigned("place", 40).alias("mark"), "begin").distinct())


def prepare(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, mark (24 bits of the text's hash), text, given (whether the id is); null ids and texts have stand-ins."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(0)).alias("id"),
                       F.shiftrightunsigned(F.xxhash64(text), 40).alias("mark"), text.alias("text"),
                       docs[id_col].isNotNull().alias("given"))


def _packed(docs: DataFrame) -> DataFrame:
    """id, mark and the text compressed, for joins that ship it."""

    def pack(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=3, write_content_size=True)
        return pa.array([press.compress(t) for t in shingles.as_bytes(texts)], pa.binary())

    return docs.select("*", F.arrow_udf(pack, "binary")("text").alias("packed"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, max_contents: int = MAX_CONTENTS, with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with_text: also the kept bytes and the spans."""
    stages = Stages(docs.sparkSession, "repeats")
    plain = prepare(docs, id_col, text_col)
    spans = covered(*repeat_members(_packed(plain), stages, length, gram, max_contents), length, gram)
    by_doc = (spans.groupBy("id", F.shiftrightunsigned("place", 40).alias("mark"))
              .agg(F.collect_set(F.struct(F.col("place").bitwiseAND(_PLACE).alias("place"), "begin", "end")).alias("spans")))
    rows = _packed(plain).drop("text").join(by_doc, ["id", "mark"], "left")
    extra = ", kept binary, spans array<struct<begin: bigint, end: bigint>>" if with_text else ""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for doc, given, packed, found in zip(*[batch.column(c).to_pylist() for c in ("id", "given", "packed", "spans")],
                                                 strict=True):
                text = unpack.decompress(packed) if len(packed) else b""
                step = np.zeros(len(text) + 1, np.int32)
                for s in found or ():
                    step[max(0, s["place"] + s["begin"])] += 1
                    step[min(len(text), s["place"] + s["end"])] -= 1
                gone = np.cumsum(step)[:-1] > 0
                edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(edge) else text
                row = {id_col: doc if given else None, "n_bytes": len(text), "n_removed": len(text) - len(kept),
                       "n_spans": len(edge) // 2, "kept_sha256": hashlib.sha256(kept).hexdigest()}
                if with_text:
                    row |= {"kept": kept, "spans": [{"begin": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]}
                out.append(row)
            if out:
                types = [pa.int64()] * 4 + [pa.string()]
                if with_text:
                    types += [pa.binary(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
                names = list(out[0])
                yield pa.record_batch([pa.array([r[c] for r in out], t) for c, t in zip(names, types, strict=True)], names=names)

    return rows.mapInArrow(finish, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}")
