"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters that lies in a text with at most e edits shares at
least ``m - q + 1 - q * e`` of its q-grams with the text, and all of them lie on
``e + 1`` neighbouring diagonals (text position minus item position).  Per
text, shared q-grams are counted in diagonal bands that are ``2 * (e + 1)`` wide and
overlap by half, so one band holds all of them; bands that reach the bound are kept, and
verified by a banded alignment of the whole item (edit distance, free ends in the
text).  e is ``edit_rate`` of the item's length.  Characters are compared lower-cased, all
white space as a blank; positions are those of the original text.

Shared q-grams are counted a bounded number at a time; a text and an item that repeat the same q-grams over and over are aligned whole
instead, which finds the same.  Every text is filtered whole, where it lies.  The benchmark's q-gram table is
broadcast in blocks of about ``block_chars`` characters (items are dealt by a hash of id and text, so an id with many
texts is dealt too; one item stays whole).  A benchmark of one block needs no shuffle.  Of a larger one, one block
at a time is broadcast, sees all texts, writes the matches by the digest of the text, and is dropped before the next; the
matches are then joined to the documents.  So memory does not grow with the benchmark, and the documents are read once a
block and once more: give them as a table, not as a long plan.

Defined cases: null and empty texts have no matches; items of fewer than ``min_item_chars``
characters match without edits and between word boundaries only; items that are null, have no id, or
have fewer than q characters are no evidence and are ignored; equal items are reported each under their own id; an id
with several texts is matched by each of them (places of one text do not overlap, those of two may; equal places of an id are one); an empty
benchmark marks nothing; repeated rows are judged each; columns of the documents are
carried by `clean_rows` and may have any names.
"""

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoframe.llm.stages import Stages

Q = 10
EDIT_RATE = 0.08
BLOCK_CHARS = 4_000_000
MIN_ITEM_CHARS = 30
MATCHES = "array<struct<item_id: bigint, start: int, end: int, edits: int>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))

POSTINGS = 1 << 20           # shared q-grams that are held at a time
DENSE_POSTINGS = 1 << 20     # a text and an item that share more,
DENSE_SHARE = 0.05           # on this share of all their pairs of places, are aligned whole
WINDOW = 1 << 20             # characters of a text that are aligned at a time

_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(r"\s")


def normalise(text: str | None) -> str:
    """Lower case and blanks, one character for one character."""
    text = _SPACE.sub(" ", text or "")
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters at every position, joined from halves (q in binary)."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, out, done = chars.astype(np.uint64), 1, None, 0
    while True:
        if q & size:
            part = power[done:done + n]
            out = part.copy() if out is None else _join(out, part)
            done += size
        if size * 2 > q:
            return out * _MIX
        power, size = _join(power[:-size], power[size:]), size * 2


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * _MIX
    h ^= h >> np.uint64(29)
    h += right
    return h


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, anchor: int | None = None) -> tuple[int, int]:
    """(edits, end) of the best alignment of the whole item whose diagonals lie in [low, low + width).

    The text's ends are free, unless ``anchor`` fixes the position where it begins."""
    m = len(item)
    at = np.arange(low, low + width)
    window = np.full(m + width, 0xFFFFFFFF, np.uint32)
    a, b = max(0, low), min(len(text), low + len(window))
    if a < b:
        window[a - low:b - low] = text[a:b]
    steps = np.arange(width)
    row = np.zeros(width, np.int64) if anchor is None else np.where(at >= anchor, at - anchor, 1 << 20)
    for i in range(m):
        moved = row + (window[i:i + width] != item[i])
        moved[:-1] = np.minimum(moved[:-1], row[1:] + 1)
        row = np.minimum.accumulate(moved - steps) + steps
    k = int(row.argmin())
    return int(row[k]), low + k + m


def joined(text: str, at: int) -> bool:
    """Whether a place lies inside a word."""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


def stretches(sizes: np.ndarray, limit: int | None = None) -> Iterator[slice]:
    """Slices of consecutive entries whose sizes add up to about ``limit``."""
    total, begin = np.cumsum(sizes), 0
    limit = limit or POSTINGS
    while begin < len(sizes):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield slice(begin, end)
        begin = end


def spread(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (as often as ``times`` says) of every entry, one after another."""
    return np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())


class Tally:
    """Sums by key, merged whenever a bounded number has come together."""

    def __init__(self) -> None:
        self.keys, self.sums, self.held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
        found, inverse = np.unique(keys, return_inverse=True)
        self.keys.append(found)
        self.sums.append(np.bincount(inverse, weights, len(found)).astype(np.int64))
        self.held += len(found)
        if self.held > 4 * POSTINGS:
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        found, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate(self.sums), len(found)).astype(np.int64)
        self.keys, self.sums, self.held = [found], [sums], 0
        return found, sums


class Index:
    """The q-gram table of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, edit_rate: float = EDIT_RATE,
                 min_chars: int = MIN_ITEM_CHARS):
        self.q = q
        kept = list(dict.fromkeys((i, t) for i, t in ((i, normalise(t).strip()) for i, t in items if i is not None)
                                  if len(t) >= q))
        self.ids, self.texts = [i for i, _ in kept], [t for _, t in kept]
        self.chars = [codes(t) for t in self.texts]
        size = np.array([len(c) for c in self.chars], np.int64)
        # At most as many edits as leave one q-gram whole.
        self.short = size < min_chars
        self.edits = np.where(self.short, 0, np.minimum((size * edit_rate).astype(np.int64), (size - q) // q))
        self.bound = size - q + 1 - q * self.edits
        hashes = [gram_hashes(c, q) for c in self.chars]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]) if hashes else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place, flat = item[order], place[order], flat[order]
        # a pair is a gram and an item that has it: the first of its places, and how many
        fresh = np.ones(len(flat), bool)
        fresh[1:] = (flat[1:] != flat[:-1]) | (self.item[1:] != self.item[:-1])
        self.pair = np.flatnonzero(fresh)
        self.places = np.diff(np.append(self.pair, len(flat)))
        self.keys, self.first, self.pairs = np.unique(flat[self.pair], return_index=True, return_counts=True)
        self.sizes = size
        self.known = np.zeros(1 << _BITS, bool)
        self.known[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def bands(self, chars: np.ndarray, limits: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
        """((text number, item number, band) of bands with enough shared q-grams; (text, item) pairs that are not counted).

        ``chars``: several texts one after another; ``limits``: where each ends.  Shared q-grams are counted a bounded
        stretch at a time.  A text and an item that repeat the same q-grams over and over share them on most diagonals,
        where counting rules nothing out and takes longer than aligning them whole (`scan`): those are left to that."""
        h = gram_hashes(chars, self.q)
        at = np.flatnonzero(self.known[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return [], []
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[k] == h[at]
        at, k = at[same], k[same]
        text = np.searchsorted(limits, at, side="right")
        whole = at + self.q <= limits[np.minimum(text, len(limits) - 1)]  # no q-gram spans two texts
        at, k, text = at[whole], k[whole], text[whole]
        many = len(self.ids)

        def pairs(part: slice) -> tuple[np.ndarray, np.ndarray]:
            """(hit, pair) of the hits of a stretch."""
            times = self.pairs[k[part]]
            return np.repeat(np.arange(part.start, part.stop), times), spread(self.first[k[part]], times)

        totals = Tally()
        for part in stretches(self.pairs[k]):
            hit, pair = pairs(part)
            totals.add(text[hit] * many + self.item[self.pair[pair]], self.places[pair])
        shared, postings = totals.result()
        area = np.diff(np.append(0, limits))[shared // many] * self.sizes[shared % many]
        dense = shared[(postings > DENSE_POSTINGS) & (postings > DENSE_SHARE * area)]
        counts = Tally()
        low, span = -int(self.sizes.max()) - 1, len(chars) + int(self.sizes.max()) + 3
        for part in stretches(self.pairs[k]):
            hit, pair = pairs(part)
            if len(dense):
                keep = ~np.isin(text[hit] * many + self.item[self.pair[pair]], dense)
                hit, pair = hit[keep], pair[keep]
            for some in stretches(self.places[pair]):
                times = self.places[pair[some]]
                owner, posting = np.repeat(hit[some], times), spread(self.pair[pair[some]], times)
                item = self.item[posting]
                band = (at[owner] - self.place[posting]) // (self.edits[item] + 1)
                key = (text[owner] * many + item) * span - low
                counts.add(np.concatenate([key + band, key + band - 1]))
        keys, count = counts.result()
        enough = count >= self.bound[keys // span % many]
        return ([(int(x // span // many), int(x // span % many), int(x % span + low)) for x in keys[enough]],
                [(int(x // many), int(x % many)) for x in dense])

    def scan(self, chars: np.ndarray, item: int) -> list[tuple[int, int, int]]:
        """(start, end, edits) of places of an item anywhere in a text, the best first, by the whole edit-distance table, a
        window of the text at a time; no two overlap."""
        e, wanted = int(self.edits[item]), self.chars[item]
        m, ends = len(wanted), []
        reach = m + e
        for begin in range(0, max(1, len(chars)), WINDOW):
            first = max(0, begin - reach)
            window = chars[first:begin + WINDOW]
            steps = np.arange(len(window) + 1, dtype=np.int32)
            row = np.zeros(len(window) + 1, np.int32)
            for c in wanted:
                moved = row + 1
                np.minimum(moved[1:], row[:-1] + (window != c), out=moved[1:])
                row = np.minimum.accumulate(moved - steps) + steps
            good = np.flatnonzero(row <= e)
            good = good[(good + first > begin) | (begin == 0)]  # others belong to the window before
            ends += [(int(row[j]), int(j + first)) for j in good]
        out: list[tuple[int, int, int]] = []
        taken = np.zeros(len(chars) + 1, bool)
        for edits, end in sorted(ends):
            if taken[max(0, end - m + e):end].any():  # no place is shorter
                continue
            length = m if not edits else align(wanted[::-1], chars[:end][::-1][:reach + 1], -e - 1, 2 * e + 3, anchor=0)[1]
            start = max(0, end - length)
            if not taken[start:end].any():
                taken[start:end] = True
                out.append((start, end, edits))
        return out

    def verify(self, text: str, chars: np.ndarray, item: int, low: int) -> tuple[int, int, int] | None:
        """(start, end, edits) of the item in a text, on the diagonals of a band that begins at ``low``."""
        e, m = int(self.edits[item]), len(self.chars[item])
        if self.short[item]:
            for at in range(max(0, low), low + 2):  # the diagonals of its band
                if text.startswith(self.texts[item], at) and not joined(text, at) and not joined(text, at + m):
                    return at, at + m, 0
            return None
        found = text.find(self.texts[item], max(0, low), max(0, low + 2 * (e + 1) + m))
        if found >= 0:
            return found, found + m, 0
        edits, end = align(self.chars[item], chars, low - e, 2 * (e + 1) + 2 * e)
        if edits > e:
            return None
        end = min(end, len(chars))
        back, length = align(self.chars[item][::-1], chars[:end][::-1], -e - 1, 2 * e + 3, anchor=0)
        return max(0, end - length), end, edits

    def matches(self, texts: list[str | None]) -> list[list[dict]]:
        """Of each text, the items that lie in it within their edit budget."""
        plain = [normalise(t) for t in texts]
        found: list[dict[int, list]] = [defaultdict(list) for _ in texts]
        begin = 0
        while begin < len(plain):
            end, size = begin + 1, len(plain[begin])
            while end < len(plain) and size + len(plain[end]) <= 500_000:
                size += len(plain[end])
                end += 1
            chars = codes("".join(plain[begin:end]))
            limits = np.cumsum([len(t) for t in plain[begin:end]])
            bands, dense = self.bands(chars, limits)
            for t, item in dense:
                start = int(limits[t] - len(plain[begin + t]))
                places = self.scan(chars[start:limits[t]], item)
                if self.short[item]:
                    text, end = plain[begin + t], len(self.chars[item])
                    places = [p for p in places if not joined(text, p[0]) and not joined(text, p[0] + end)]
                found[begin + t][item] += places
            for t, item, band in bands:
                start = int(limits[t] - len(plain[begin + t]))
                place = self.verify(plain[begin + t], chars[start:limits[t]], item,
                                    band * (int(self.edits[item]) + 1) - start)
                if place:
                    found[begin + t][item].append(place)
            begin = end
        out = []
        for by_item in found:
            rows = set()
            for item, places in by_item.items():
                taken: list[tuple[int, int]] = []
                for start, end, edits in sorted(places, key=lambda p: (p[2], p[0])):
                    if not any(start < e and s < end for s, e in taken):
                        taken.append((start, end))
                        rows.add((start, self.ids[item], end, edits))
            out.append([{"item_id": i, "start": start, "end": end, "edits": edits} for start, i, end, edits in sorted(rows)])
        return out


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(benchmark[id_col].cast("long").alias("id"), benchmark[text_col].alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL").distinct()


def _block(items: DataFrame, number: int, blocks: int) -> list[tuple[int, str]]:
    """One of ``blocks`` shares of the items, of about equal size."""
    part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number)
    return [(r["id"], r["text"]) for r in part.collect()]


def _search(shared: Broadcast) -> Callable[[Column], Column]:
    def search(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.matches(texts.to_pylist()), _ARROW)

    return F.arrow_udf(search, MATCHES)


def _search_rows(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = shared.value.matches(batch.column(1).to_pylist())
            hits = [k for k, found in enumerate(matches) if found]
            if hits:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(hits)), pa.array([matches[k] for k in hits], _ARROW)],
                                                 ["digest", "matches"])

    return search


def _by_digest(rows: DataFrame, items: DataFrame, blocks: int, index: Callable[[list], Index]) -> DataFrame:
    """digest and matches of the texts that have some, of the blocks one after another: at any time one is broadcast."""
    spark = rows.sparkSession
    stages = Stages(spark, "decontaminate")
    items, texts = stages.write(items, "items"), rows.select(F.sha2("_text", 256).alias("digest"), "_text").filter("_text IS NOT NULL")
    found = None
    for number in range(blocks):
        shared = spark.sparkContext.broadcast(index(_block(items, number, blocks)))
        hits = texts.mapInArrow(_search_rows(shared), f"digest string, matches {MATCHES}")
        # copies of a text have the same matches
        part = stages.write(hits.groupBy("digest").agg(F.first("matches").alias("matches")), f"block-{number}")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    by_place = F.array_sort(F.transform(F.flatten(F.collect_list("matches")), lambda m: F.struct(
        m["start"].alias("start"), m["item_id"].alias("item_id"), m["end"].alias("end"), m["edits"].alias("edits"))))
    matches = F.transform(F.array_distinct(by_place), lambda m: F.struct(
        m["item_id"].alias("item_id"), m["start"].alias("start"), m["end"].alias("end"), m["edits"].alias("edits")))
    together = stages.write(found.groupBy("digest").agg(matches.alias("_matches")), "matches")
    stages.remove("items", *[f"block-{number}" for number in range(blocks)])
    return together


def find_items(docs: DataFrame, benchmark: DataFrame, carry: Column, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", q: int = Q, edit_rate: float = EDIT_RATE,
               block_chars: int = BLOCK_CHARS, min_item_chars: int = MIN_ITEM_CHARS) -> DataFrame:
    """``_row`` (``carry`` of a document) and ``_matches``: the places of benchmark items in its text (an empty array if none)."""
    items = _items(benchmark, item_id_col, item_text_col)
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-size // block_chars)
    rows = docs.select(carry.alias("_row"), docs[text_col].alias("_text"))

    def index(part: list[tuple[int, str]]) -> Index:
        return Index(part, q, edit_rate, min_item_chars)

    none = F.array().cast(MATCHES)
    if not blocks:
        return rows.select("_row", none.alias("_matches"))
    if blocks == 1:
        shared = docs.sparkSession.sparkContext.broadcast(index(_block(items, 0, 1)))
        return rows.select("_row", _search(shared)(F.col("_text")).alias("_matches"))
    found = _by_digest(rows, items, blocks, index)
    # few texts have matches: Spark broadcasts a small table of them by its size on disk, and splits hot digests of a large one
    joined_rows = rows.select("_row", F.sha2("_text", 256).alias("digest")).join(found, "digest", "left")
    return joined_rows.select("_row", F.coalesce("_matches", none).alias("_matches"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, contaminated, n_items, matches (item, place in the text, edits)."""
    rows = find_items(docs, benchmark, docs[id_col], text_col, **options)
    return rows.select(F.col("_row").alias(id_col), (F.size("_matches") > 0).alias("contaminated"),
                       F.size(F.array_distinct(F.col("_matches.item_id"))).alias("n_items"), F.col("_matches").alias("matches"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows without any match, with their columns."""
    return find_items(docs, benchmark, F.struct("*"), text_col, **options).filter(F.size("_matches") == 0).select("_row.*")
