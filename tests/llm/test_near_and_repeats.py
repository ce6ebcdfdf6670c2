import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ecoframe.llm import near_dedup, repeats, shingles
from ecoframe.llm.components import components
from ecoframe.llm.stages import Stages, salted_join
from tests_llm_paths import SF


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def set_of(text, width):
    w = words_of(text)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute_components(texts, width, percent=80):
    sets, union = {i: set_of(t, width) for i, t in texts.items()}, Union()
    ids = [i for i in sets if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                union.join(i, j)
    return {i: union.find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingles_equal_the_plain_sets(width):
    rnd = random.Random(width)
    texts = ["", "  ", "One", "one ONE one", "a b", "Ä ä a\tb\nc\x0bd\re\x0cf", "x" * 3000 + " y"]
    texts += [" ".join(rnd.choice(["a", "B", "cé", "dd", "E."]) for _ in range(rnd.randint(0, 60))) for _ in range(40)]
    hashes, sizes = shingles.shingle_sets([t.encode() for t in texts], width)
    assert sizes.tolist() == [len(set_of(t, width)) for t in texts]
    parts = [set(x.tolist()) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert len(parts[i] & parts[j]) == len(set_of(texts[i], width) & set_of(texts[j], width))
    assert shingles.word_counts([t.encode() for t in texts]).tolist() == [len(words_of(t)) for t in texts]


def near_copies(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = rnd.choice("pqrstuvw") * rnd.randint(1, 3)
        out.append(" ".join(w))
    return out


def test_components_equal_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rnd.randint(0, 40))) for _ in range(80)]
    texts += near_copies(rnd, " ".join(word() for _ in range(60)), 120, 6)  # a crowded region with links at the threshold
    texts += [None, "", " \n", "one", "ONE", "one two", "One  TWO", "w " * 30_000, "w " * 30_001]
    data = {i * 3 + 1: t for i, t in enumerate(texts)}
    docs = spark.createDataFrame([(t, i, "x", 1) for i, t in data.items()], "text string, doc_id long, signature string, component int")
    got = near_dedup.link_documents(docs, width=2).collect()
    want, sizes = brute_components(data, 2)
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(data)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = near_dedup.keep_one(docs, width=2)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_repeated_and_missing_ids_and_empty_table(spark):
    a, b = " ".join(map(str, range(30))), " ".join(map(str, range(100, 130)))
    rows = [(1, a), (1, a), (2, a), (2, b), (3, b), (None, a), (None, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.link_documents(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (None, None, True),
                          (None, None, True), (9, 9, True)], key=str)
    assert near_dedup.link_documents(docs.limit(0)).count() == 0 and near_dedup.keep_one(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7), (3, 900), (900, 3)]
    links += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(60)]
    union = Union()
    for a, b in links:
        union.join(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"), Stages(spark, "test"), "parts").collect()
    assert {r["id"]: r["component"] for r in got} == {i: union.find(i) for a, b in links if a != b for i in (a, b)}
    assert len(got) == len({r["id"] for r in got})


def test_salted_join_is_a_join(spark):
    rows = spark.range(1000).selectExpr("id", "IF(id % 2 = 0, 0, id % 7) AS k")
    groups = spark.createDataFrame([(0, "zero"), (1, "one"), (99, "none")], "k long, name string")
    assert sorted(salted_join(rows, groups, ["k"], "id").collect()) == sorted(rows.join(groups, "k").collect())
    assert salted_join(rows, groups, ["k"], "id", "left").count() == 1000


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), int(gone.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeat_corpus():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(60), prose(9)
    texts = [prose(rnd.randint(0, 120)) for _ in range(20)]
    texts += [prose(rnd.randint(0, 30)) + passage[rnd.randint(0, 60):] + prose(rnd.randint(0, 30)) for _ in range(40)]
    texts += [prose(10) + line + prose(10) for _ in range(20)]
    texts += [(passage[:150] + "#" + passage[151:]), passage[:199], passage[:200], passage[1:201], "ab " * 200, "xyz" * 67,
              None, "", texts[0], texts[0], "\n".join([prose(40)] * 3)]
    return texts


@pytest.mark.parametrize("most", [repeats.MAX_CONTENTS, 3])
def test_repeats_equal_brute_force(spark, most):
    texts = repeat_corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, gram string, place int").repartition(3)
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs, max_contents=most, with_text=True).collect()}
    for i, (n, removed, spans, sha, kept) in enumerate(brute_repeats(texts, 200)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) == (n, removed, spans, sha, kept), i
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == removed


def test_repeats_of_repeated_ids_and_empty_table(spark):
    a, b = "".join(map(str, range(200))), "".join(map(str, range(900, 700, -1)))
    rows = [(1, a), (1, a), (2, b), (None, b[:300]), (2, a[:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(docs).collect()), key=str)
    assert got == sorted([(1, 490, 490), (1, 490, 490), (2, 600, 300), (None, 300, 300), (2, 150, 0)], key=str)
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    """Anchors of a text in overlapping pieces are those of the whole text."""
    rnd = random.Random(1)
    raw = bytes(rnd.choice(b"abcdefgh ") for _ in range(30_000)) + b"pq" * 2_000
    whole = repeats.anchors(np.frombuffer(raw, np.uint8), np.array([len(raw)]), 200, 64)
    found = {}

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, scan, schema):
            import pyarrow as pa
            batch = pa.record_batch([pa.array([5]), pa.array([0]), pa.array([raw.decode()])], names=["id", "mark", "text"])
            for out in scan(iter([batch])):
                for r in out.to_pylist():
                    assert r["place"] not in found
                    found[r["place"]] = (r["gram"], r["content"])

    monkeypatch.setattr(repeats, "PIECE", 4_000)
    repeats.anchor_rows(Frame(), 200, 64)
    want = {int(p): (int(g), int(c)) for p, g, c in zip(whole[1], whole[2].view(np.int64), whole[3].view(np.int64), strict=True)}
    assert found == want


def test_maximal_repeats_list_all_occurrences():
    rnd = random.Random(6)
    for _ in range(60):
        texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(6, 14))) for _ in range(rnd.randint(2, 6))]
        places = [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 2) if t[p:p + 2] == "ab"]
        if len(places) < 2:
            continue
        left = [texts[i][:p][::-1].encode() for i, p in places]
        right = [texts[i][p:].encode() for i, p in places]
        got = {(frozenset(m.tolist()), a, b) for a, b, m in repeats.maximal_repeats(left, right, 4)}
        groups = defaultdict(set)
        for a in range(14):
            for b in range(1, 15):
                if a + b >= 4:
                    by = defaultdict(set)
                    for k, (x, y) in enumerate(zip(left, right, strict=True)):
                        if len(x) >= a and len(y) >= b:
                            by[x[:a], y[:b]].add(k)
                    for members in by.values():
                        if len(members) > 1:
                            groups[frozenset(members)].add((a, b))
        want = {(m, max(a for a, _ in ab), max(b for _, b in ab)) for m, ab in groups.items()}
        assert got == want


@pytest.mark.parametrize("most", [repeats.MAX_CONTENTS, 3])
def test_repeat_groups_equal_brute_force(spark, most):
    """Every repeat that ends or branches on both sides (within its anchor's reach), with every occurrence."""
    length, gram, rnd = 12, 4, random.Random(3)
    reach = length - gram
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90))) for _ in range(25)]
    texts += [texts[3][:40] + "cc" + texts[4][:30], texts[5], texts[5], "a" * 30, "", None, "x" + texts[6], texts[6][4:]]
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t or "")):
            for size in range(length, length + reach + 1):
                if p + size <= len(t):
                    places[t[p:p + size]].append((i, p))

    def offsets(text):
        order = repeats.gram_order(repeats.prefix_sums(np.frombuffer(text.encode(), np.uint8)), gram).tolist()
        return {min(range(w, w + reach + 1), key=lambda k: (order[k], k)) for w in range(len(text) - length + 1)}

    def ends(text, found, step):
        beyond = [texts[i][p - 1:p] if step < 0 else texts[i][p + len(text):p + len(text) + 1] for i, p in found]
        return "" in beyond or len(set(beyond)) > 1

    want = set()
    for text, found in places.items():
        if len(found) > 1 and any(
                o <= reach and len(text) - o <= length and (o == reach or ends(text, found, -1))
                and (len(text) - o == length or ends(text, found, 1)) for o in offsets(text)):
            want.add((len(text), frozenset(found)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = defaultdict(set)
    for r in repeats.repeat_groups(docs, length=length, gram=gram, max_contents=most).collect():
        assert (r["doc_id"], r["begin"]) not in got[r["group"], r["length"]]
        got[r["group"], r["length"]].add((r["doc_id"], r["begin"]))
    assert len(want) > 50 and len(got) == len(want)
    assert {(size, frozenset(found)) for (_, size), found in got.items()} == want
