"""Centroid clustering, whitening and language identification against brute force."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ecoframe.llm import centroids as C
from ecoframe.llm import eigen
from ecoframe.llm import language as L
from ecoframe.llm import whitening as W
from ecoframe.llm.queries import QUERIES
from tests_llm_paths import SF

VEC = "vec_id long, embedding array<float>, label int"


# --- op11 -------------------------------------------------------------------------------

def lloyd(rows, k=16, rounds=3):
    """Plain Lloyd rounds with Python integers: [(vec_id, cluster, distance)], centroids."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(x) for _, x in start[:k]]

    def place(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[place(x)[1]].append(x)
        for n, xs in members.items():
            centres[n] = [sum(col) // len(xs) for col in zip(*xs)]
    return [(i, place(x)[1], place(x)[0]) for i, x in kept], centres


def clusters(df):
    return sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in df.collect()), key=repr)


def test_hadamard_is_exact_and_keeps_distances():
    rng = np.random.default_rng(0)
    x, c = rng.integers(-500, 500, (50, 64)), rng.integers(-500, 500, (7, 64))
    order = C.coarse_to_fine(64)
    assert sorted(order) == list(range(64))
    assert np.array_equal(C.hadamard(C.hadamard(x)), 64 * x)
    best, scaled = C.nearest(C.spectrum(x, order), C.spectrum(c, order))
    exact = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert np.array_equal(best, exact.argmin(axis=1)) and np.array_equal(scaled, 64 * exact.min(axis=1))
    changes = [int((np.diff(row) != 0).sum()) for row in C.hadamard(np.eye(64, dtype=int))[:, order].T]
    assert changes == list(range(64))  # coarse to fine
    with pytest.raises(ValueError):
        C.hadamard(np.zeros((1, 12)))


def test_nearest_keeps_ties_and_large_numbers():
    x = np.zeros((1, 64), dtype=np.int64)
    c = np.zeros((3, 64), dtype=np.int64)
    c[0, 5], c[1, 9], c[2, 0] = 2, -2, 2
    order = C.coarse_to_fine(64)
    assert C.nearest(C.spectrum(x, order), C.spectrum(c, order))[0].tolist() == [0]
    big = np.full((1, 64), 1 << 40, dtype=np.int64)
    centres = np.stack([big[0] - 3, big[0] + 2])
    found = list(C.blocks(big, centres, order))
    assert found[0][1].tolist() == [1] and found[0][2].tolist() == [64 * 4]
    far = np.array([[1 << 61] + [0] * 63], dtype=np.int64)  # beyond what longs can square
    assert list(C.blocks(far, np.zeros((1, 64), dtype=np.int64), order))[0][2].tolist() == [1 << 122]


def test_clusters_equal_plain_lloyd(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 64).astype(np.float32).tolist()) for i in range(90)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]           # a large group of copies
    rows += [(5, rows[5][1]), (7, rows[8][1]), (None, rows[9][1])]  # repeated rows, ids and no id
    bad = [(200, None), (201, []), (202, [0.0] * 63), (203, [0.0] * 63 + [None]), (204, [float("nan")] * 64), (205, [float("inf")] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], VEC).withColumn("cluster", F.lit("x")).withColumn("x", F.lit(1))
    want, centres = lloyd(rows + bad)
    placed, got = C.cluster(df)
    assert got == centres
    assert clusters(placed) == sorted(want, key=repr)
    report = C.cluster_report(df).collect()
    total = sum(d for _, _, d in want)
    for r in report:
        assert r["inertia"] == total and r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_clusters_of_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], VEC)
    assert C.cluster_report(empty).collect() == []
    assert C.cluster_report(empty).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    few = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.3] * 64)]  # equal start centroids: one stays empty
    want, centres = lloyd(few)
    placed, got = C.cluster(spark.createDataFrame([(i, v, 0) for i, v in few], VEC))
    assert got == centres and clusters(placed) == sorted(want, key=repr)


def test_cluster_query_covers_the_table(spark):
    out = QUERIES["op11_centroids"](spark, SF)
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    want, _ = lloyd([(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert clusters(out) == sorted(want, key=repr)


# --- op12 -------------------------------------------------------------------------------

@pytest.mark.parametrize("make", ["spread", "equal", "blocks", "rank", "tiny", "ones"])
def test_eigenpairs(make):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    a = {"spread": lambda: np.cov(rng.standard_normal((300, 40)).T), "equal": lambda: q @ np.diag([3.0] * 15 + [1.0] * 25) @ q.T,
         "blocks": lambda: np.diag([5.0, 5, 5, 2, 2, 0]), "rank": lambda: np.cov(rng.standard_normal((5, 40)).T),
         "tiny": lambda: 1e-30 * np.cov(rng.standard_normal((300, 40)).T), "ones": lambda: np.array([[2.0, 1.0], [1.0, 2.0]])}[make]()
    values, vectors = eigen.leading_eigenpairs(a, 16)
    want = np.linalg.eigvalsh(a)[::-1][:16]
    top = np.abs(want).max()
    assert np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-12 * top
    counts = eigen.sturm_counts(*eigen.tridiagonal(a)[:2], np.array([want[0] * 1.01, want[0] * 0.99]))
    assert counts[0] == len(a) and counts[1] < len(a)


def check_whitening(df, rows):
    """The result against numpy on the distinct rows, all columns."""
    x = {i: np.floor(64 * np.array(v, dtype=float)).astype(int) + 1_000_000 for i, v in rows}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - fit.mean(axis=0)
    v = centred.T @ centred / n
    values = np.linalg.eigvalsh(v)[::-1]
    got = df.collect()
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    by_id = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["vec_id"], r["component"])):
        by_id[r["vec_id"]].append(r)
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(v)) < 1e-12
        assert r["deviation"] == int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r["vec_id"]], sums)))
    ids = list(by_id)
    white = np.array([[r["whitened"] for r in by_id[i]] for i in ids])
    centre = np.array([x[i] for i in ids]) - fit.mean(axis=0)
    # the components that the result implies: unit eigenvectors, whatever their sign
    parts = np.linalg.lstsq(centre, white * np.sqrt(values[:white.shape[1]]), rcond=None)[0]
    assert np.abs(v @ parts - parts * values[:white.shape[1]]).max() < 1e-7 * values[0]
    return white


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(7)
    mix = rng.normal(0, 0.4, (20, 20))
    rows = [(i, (rng.standard_normal(20) @ mix).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[4][1]) for i in range(200)]  # copies count once
    bad = [(1, None), (2, []), (3, [None] * 20), (4, [float("inf")] * 20), (5, [float("nan")] + [0.0] * 19), (6, [0.0] * 19)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows] + [(i + 5000, v, 0) for i, v in bad], VEC).withColumn("x", F.lit("x"))
    out = W.whiten_report(df)
    assert out.count() == 500 * 16
    assert check_whitening(out, rows).shape == (500, 16)
    assert W.whiten_report(df, components=3).count() == 1500


def test_whitening_of_low_rank_and_empty_tables(spark):
    assert W.whiten_report(spark.createDataFrame([], VEC)).collect() == []
    same = spark.createDataFrame([(i, [0.5] * 8, 0) for i in range(4)], VEC)
    assert W.whiten_report(same).collect() == []  # no direction to whiten
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(6)]
    out = W.whiten_report(spark.createDataFrame([(i, v, 0) for i, v in line], VEC))
    assert out.count() == 6  # one component has all the variance
    assert {round(r["explained"], 9) for r in out.collect()} == {1.0}
    repeated = spark.createDataFrame([(1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.0], 0), (None, [1.0, 1.0], 0)], VEC)
    assert W.whiten_report(repeated).count() == 8


def test_deviation_beyond_a_long_is_null():
    model = W.Whitening(1 << 40, [(1 << 40) * 1_000_000 + 5], np.ones((1, 1)), np.ones(1), 1.0)
    assert model.deviations(np.array([[1_000_000], [1_000_001], [1_000_000_000]])) == [25, None, None]
    small = W.Whitening(10, [25], np.ones((1, 1)), np.ones(1), 1.0)
    assert small.deviations(np.array([[3], [2]])) == [25, 25]


def test_whitening_query(spark):
    out = QUERIES["op12_whitening"](spark, SF)
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    white = check_whitening(out, [(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert white.shape == (table.count(), 16)


# --- op13 -------------------------------------------------------------------------------

def all_segmentations(lattice, word):
    """Every list of piece numbers that spells ``word``."""
    ways = defaultdict(list)
    for start, end, ids in lattice.matches(word):
        ways[start].append((end, list(ids)))

    def rest(at):
        if at == len(word):
            yield []
        for end, ids in ways[at]:
            for tail in rest(end):
                yield ids + tail

    return list(rest(0))


PIECES = ["<unk>", "▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba", "é"] + [f"<0x{b:02X}>" for b in range(256)]


def small_lattice():
    return L.Lattice(*L.letter_pieces(PIECES))


def probabilities(columns=3):
    p = np.random.default_rng(3).random((len(PIECES), columns)) ** 3 + 1e-4
    return p / p.sum(axis=0)


def test_forward_sums_all_segmentations():
    lattice, p = small_lattice(), probabilities()
    words = ["▁", "▁a", "▁abab", "▁bab", "▁aé", "▁aбb", "▁ababababab"]
    want = [np.log(sum(p[ids].prod(axis=0) for ids in all_segmentations(lattice, w))) for w in words]
    assert np.allclose(L.log_probabilities(lattice, words, p), want, rtol=1e-12)
    assert np.allclose([L.forward(lattice, w, p) for w in words], want, rtol=1e-12)


def test_expected_counts_are_posterior_means():
    lattice, p = small_lattice(), probabilities()
    words, column, times = ["▁abab", "▁aбb", "▁a", "▁abab"], np.array([0, 1, 2, 2]), np.array([1.0, 2.0, 3.0, 5.0])
    want = np.zeros(p.shape)
    for w, c, n in zip(words, column, times):
        ways = all_segmentations(lattice, w)
        weight = np.array([p[ids, c].prod() for ids in ways])
        for ids, share in zip(ways, weight / weight.sum()):
            np.add.at(want[:, c], ids, n * share)
    got = np.zeros(p.shape)
    L.add_expected(lattice, words, column, times, p, got)
    assert np.allclose(got, want, rtol=1e-10)
    alone = np.zeros(p.shape)
    for w, c, n in zip(words, column, times):
        L.expected_counts(lattice, w, p[:, c], n, alone[:, c])
    assert np.allclose(alone, want, rtol=1e-10)


def test_long_words_and_small_probabilities():
    lattice, p = small_lattice(), probabilities()
    word = "▁" + "ab" * 6_000  # longer than a stretch
    whole = L.forward(lattice, word, p)
    assert np.all(np.isfinite(whole)) and np.allclose(L.log_probabilities(lattice, [word], p), [whole])
    total = np.zeros(p.shape)
    L.expected_counts(lattice, word, p[:, 0], 1.0, total[:, 0])
    letters = np.array([len(x) if not x.startswith("<") else 0 for x in PIECES])
    assert abs(total[:, 0] @ letters - len(word)) < 1e-6 * len(word)  # the pieces cover the word once
    tiny = np.full(p.shape, 1e-40)  # products of ten are below the smallest double
    lone = L.Lattice(*L.letter_pieces(["a", "▁"]))
    got = L.log_probabilities(lone, ["▁" + "a" * 20], tiny[:2])
    assert np.allclose(got, 21 * math.log(1e-40))


DOCS = "doc_id long, text string, lang string, source string"


def corpus():
    words = {"xx": "kato belo mira tonu", "yy": "schrum pfalk gritz strond", "zz": "ñandóíé çéàù ôîêû èéèà"}
    return [(i, " ".join(words[lang].split()[(i + k) % 4] for k in range(5)) + f" {i}.", lang, "s")
            for i, lang in enumerate(["xx", "yy", "zz"] * 20)]


def test_languages_equal_brute_force(spark):
    """Prediction and score from explicit segmentations and probabilities."""
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS)
    model = L.train(df, rounds=1)
    assert model.languages == ["xx", "yy", "zz"] and np.allclose(model.probability.sum(axis=0), 1.0)
    import zlib
    learned = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2]
    assert np.allclose(np.exp(model.prior), [sum(d[2] == g for d in learned) / len(learned) for g in model.languages])
    lattice = L.Lattice(*L.letter_pieces(model.pieces))
    got = {r["doc_id"]: r for r in L.identify(df, model).collect()}
    for i, text, lang, _ in docs[:6]:
        total = model.prior.copy()
        for w in text.lower().split()[:5]:
            ways = all_segmentations(lattice, "▁" + w)
            total += np.log(sum(model.probability[ids].prod(axis=0) for ids in ways))
        share = np.exp(total - total.max())
        assert got[i]["lang_pred"] == model.languages[int(total.argmax())] == lang
        assert abs(got[i]["score"] - share.max() / share.sum()) < 1e-9
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_counts_of_one_round_equal_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS)
    pieces = [p for p, _ in L.read_vocabulary(L.default_model())[0]]
    counted = L.word_counts(df.select(F.when(F.col("lang") == "xx", 0).otherwise(1).alias("lang_no"), "text"))
    got = L.piece_counts(counted, pieces, None, 2)
    lattice, want = L.Lattice(*L.letter_pieces(pieces)), np.zeros((len(pieces), 2))
    for _, text, lang, _ in docs:
        for w in text.lower().split()[:5]:
            ways = all_segmentations(lattice, "▁" + w)
            weight = np.array([float(len(pieces)) ** -len(ids) for ids in ways])
            for ids, share in zip(ways, weight / weight.sum()):
                np.add.at(want[:, 0 if lang == "xx" else 1], ids, share)
    assert np.allclose(got, want, rtol=1e-9)


def test_language_edge_cases(spark):
    rows = corpus() + [(100, None, "xx", "s"), (101, "", "xx", "s"), (102, "12 :-) 34", None, "s"), (None, "kato belo", "xx", None),
                       (103, "kato " * 30_000, None, "s"), (104, "kato", None, "s"), (104, "kato", None, "s"), (105, "k" * 5_000, "xx", "s")]
    df = spark.createDataFrame(rows, DOCS).withColumn("lang_pred", F.lit("q")).withColumn("score", F.lit(9)).withColumn("word", F.lit("w"))
    model = L.train(df)
    out = L.identify(df, model)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == len(rows)
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"]))
        assert 0.0 <= r["score"] <= 1.0
    assert got[100] == got[101] == got[102] == [("und", 0.0)]
    assert got[103][0][0] == got[104][0][0] == got[None][0][0] == "xx" and got[104][0] == got[104][1]
    nobody = L.train(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in L.identify(df, nobody).collect()} == {"und"}
    none = spark.createDataFrame([], DOCS)
    assert L.identify(none, L.train(none)).collect() == []


def test_too_many_languages_are_an_error(spark):
    rows = [(i, "kato", f"l{i}", "s") for i in range(2 * L.MAX_LANGUAGES)]
    with pytest.raises(ValueError):
        L.train(spark.createDataFrame(rows, DOCS))


def test_small_memory_changes_nothing():
    p = probabilities()
    model = L.Model(PIECES, ["a", "b", "c"], np.log(np.array([0.2, 0.3, 0.5])), p)
    texts = ["abab ba b aba", "a b", None, "éa бa ab" * 50, "ba " * 2000]
    assert L.Scorer(model, memory=2).predict(texts) == L.Scorer(model).predict(texts)


def test_language_query_held_out_accuracy(spark):
    out = QUERIES["op13_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    assert out.count() == truth.count()
    rows = out.join(truth, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows) > 0
