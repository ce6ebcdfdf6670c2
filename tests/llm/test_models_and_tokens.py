import random

import numpy as np
import pytest

from ecoframe.llm import quality, token_counts, toxicity
from tests_llm_paths import SF


def test_rules_fit_and_compile_to_the_same_score(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.5) & (x[:, 5] <= 0.4)).astype(int)
    rules, intercept = quality.fit_rules(x, y)
    total = intercept + sum(w * quality.fires(r, x) for r, w in rules)
    assert ((total > 0) == (y == 1)).mean() > 0.97
    assert len(rules) < 80  # sparse
    table = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], ", ".join(f"{s} double" for s in quality.STATISTICS))
    from pyspark.sql import functions as F
    got = table.select(quality.compile_score(rules, intercept, F.struct("*")).alias("p")).toPandas().p.to_numpy()
    assert np.allclose(got, 1 / (1 + np.exp(-total[:50])))


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(3)
    z, y = rng.integers(0, 2, (300, 12)).astype(float), rng.integers(0, 2, 300).astype(float)
    y[z[:, 0] == 1] = 1
    w, b = quality.lasso_logistic(z, y, 0.02, rounds=4000)
    gradient = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - y) / len(y)
    assert np.all(np.abs(gradient[w == 0]) <= 0.02 + 1e-4)
    assert np.allclose(gradient[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-4) and (w == 0).any()


@pytest.mark.parametrize("op, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, op, label):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = op.score(docs, op.train(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    assert len(got) and got.score.between(0, 1).all()
    assert (got[got.held_out].predicted == got[got.held_out][label]).mean() >= 0.95
    # Labels of held-out rows don't matter.
    turned = labels.withColumn(label, (1 - labels[label]) * quality.held_out(labels["doc_id"]).cast("int")
                               + labels[label] * (~quality.held_out(labels["doc_id"])).cast("int"))
    again = op.score(docs, op.train(docs, turned)).toPandas().merge(labels.toPandas(), on="doc_id")
    assert np.allclose(got.sort_values("doc_id").score, again.sort_values("doc_id").score)


@pytest.mark.parametrize("op, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_missing_classes(spark, op, label):
    schema = "doc_id long, text string, score string, held_out int, label int, statistics string"
    docs = spark.createDataFrame([(1, None, "s", 1, 0, ""), (2, "", "s", 1, 0, ""), (None, "some words", "s", 1, 0, ""),
                                  (3, "w " * 50_000, "s", 1, 0, ""), (3, "w " * 50_000, "s", 1, 0, "")], schema)
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0), (77, 0)], f"doc_id long, {label} int")
    for frame, given in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        got = op.score(frame, op.train(frame, given)).collect()
        assert len(got) == frame.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)


def test_keep_good_carries_columns(spark):
    schema = "doc_id long, text string, _row int, words double"
    docs = spark.createDataFrame([(1, "fine words here", 3, 1.0), (2, "*** ### ***", 4, 2.0)], schema)
    rule = (((quality.STATISTICS.index("lone_symbols"), 0.5, True),), -9.0)
    got = quality.keep_good(docs, ([rule], 2.0))
    assert got.columns == docs.columns and [r["doc_id"] for r in got.collect()] == [1]


def test_nnpu_gradient_and_separation():
    rng = np.random.default_rng(5)
    hits = [[0] * bool(p) + [int(rng.integers(1, 6))] for p in [1] * 80 + [0] * 400]
    hidden = np.r_[np.zeros(80, bool), rng.random(400) < 0.15]
    hits = [sorted({*h, 0}) if d else h for h, d in zip(hits, hidden, strict=True)]
    x, positive = toxicity.Presence(hits, 6), np.r_[np.ones(80, bool), np.zeros(400, bool)]
    w, b = rng.normal(size=6), 0.1

    def risk(w):
        s = 1 / (1 + np.exp(-(x.times(w) + b)))
        return 0.15 * (1 - s[positive]).mean() + s[~positive].mean() - 0.15 * s[positive].mean()

    gradient, _ = toxicity.nnpu_risk_gradient(x, positive, w, b, 0.15)
    near = np.array([(risk(w + e) - risk(w - e)) / 2e-5 for e in np.eye(6) * 1e-5])
    assert np.allclose(gradient, near, atol=1e-6)
    w, b = toxicity.train_nnpu(x, positive, 0.15, seed=1)
    score = x.times(w) + b
    assert (score[80:][hidden[80:]] > 0).all() and (score[80:][~hidden[80:]] < 0).all()


def reference(vocabulary, unknown, byte_fallback=True):
    from tokenizers import Tokenizer, models, pre_tokenizers
    t = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_token_counts_equal_the_tokenizer(spark):
    vocabulary, unknown = token_counts.read_vocabulary(token_counts.default_model())
    exact = reference(vocabulary, unknown)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs).collect()}
    assert got == {r["doc_id"]: exact(r["text"]) for r in docs.collect()}
    odd = ["", None, " ", "  a  b ", "▁x", "x▁▁y", "日本語\n\n\ttab", "😀😀 a😀", "a\x00b", "<unk> <0x41>", " \n ", "é" * 500, "ab" * 20_000]
    frame = spark.createDataFrame([(i, t, 0) for i, t in enumerate(odd)] + [(1, None, 0)], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts.count_tokens(frame).collect()))
    assert got == sorted([(i, exact(t or "")) for i, t in enumerate(odd)] + [(1, 0)])
    assert token_counts.count_tokens(frame.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_ties_follow_the_tokenizer(seed):
    rnd = random.Random(seed)
    for _ in range(30):
        single = {c for c in "abcé" if rnd.random() < 0.7}
        pieces = single | {"".join(rnd.choice("▁abcé") for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        vocabulary = [("<unk>", 0.0)] + [(p, -float(rnd.randint(1, 6))) for p in sorted(pieces)]
        fallback = rnd.random() < 0.5
        if fallback:
            vocabulary += [(f"<0x{i:02X}>", 0.0) for i in range(256)]
        exact, mine = reference(vocabulary, 0, fallback), token_counts.Counter(vocabulary, memory=5)
        for _ in range(20):
            text = "".join(rnd.choice("abcé \nz") for _ in range(rnd.randint(0, 15)))
            assert mine.count(text) == exact(text), (text, vocabulary)


def test_words_are_features_whole():
    long, other = toxicity.feature_buckets("internationalization"), toxicity.feature_buckets("internationalist")
    assert not np.array_equal(long, other)
    stem = "ж" * 40  # 80 bytes: beyond the words that are hashed together
    assert not np.array_equal(toxicity.feature_buckets(stem + "а"), toxicity.feature_buckets(stem + "б"))
    assert np.array_equal(toxicity.feature_buckets(f"{stem} {stem}"), toxicity.feature_buckets(f"{stem}! {stem}."))
    assert len(toxicity.feature_buckets(None)) == len(toxicity.feature_buckets("12 !")) == 0
    assert len(toxicity.feature_buckets("k" * 1_000_000)) > 0


def test_screen_counts_all_unlabelled_rows(spark):
    """z values from plain sets of features over every row."""
    positive = ["bad word here", "bad word there", "bad word", "bad things"]
    other = ["good word here", "a word", "nothing", None, "", "bad"] * 7
    p = spark.createDataFrame([(1, t) for t in positive], "positive int, text string")
    u = spark.createDataFrame([(t,) for t in other], "text string")
    got = {r["bucket"]: r["z"] for r in toxicity.screen(p, u, len(positive), len(other), 100).collect()}
    counts = {}
    for side, texts in enumerate((positive, other)):
        for t in texts:
            for b in toxicity.feature_buckets(t).tolist():
                counts.setdefault(b, [0, 0])[side] += 1
    want = {}
    for b, (a, c) in counts.items():
        if a >= 3:
            share = (a + c) / (len(positive) + len(other))
            z = (a / len(positive) - c / len(other)) / (share * (1 - share + 1e-9) * (1 / len(positive) + 1 / len(other))) ** 0.5
            if z > 3:
                want[b] = z
    assert want and got.keys() == want.keys() and all(abs(got[b] - want[b]) < 1e-9 for b in want)
