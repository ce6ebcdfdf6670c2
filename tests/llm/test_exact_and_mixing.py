import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ecoframe.llm import exact_dedup, mixing, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(spark, data, schema=DOCS):
    return spark.createDataFrame(data, schema).repartition(3)


def test_equal_texts_keep_the_largest_id(spark):
    data = [(1, "a", "en", "s", 1), (5, "a", "de", "t", 1), (3, "a ", "en", "s", 2), (7, None, "en", None, None),
            (2, "", None, "s", 0), (None, "x", "en", "s", 1), (9, "b", "en", "s", 1), (9, "b", "en", "s", 1)]
    got = sorted(map(tuple, exact_dedup.assign(rows(spark, data)).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(1, 5, 2, False, sha("a")), (5, 5, 2, True, sha("a")), (3, 3, 1, True, sha("a ")),
                          (7, 7, 2, True, sha("")), (2, 7, 2, False, sha("")), (None, None, 1, True, sha("x")),
                          (9, 9, 2, True, sha("b")), (9, 9, 2, False, sha("b"))], key=str)


def test_kept_rows_have_all_columns(spark):
    schema = "text string, digest string, salt int, doc_id long, row string, content array<int>, more map<string,int>"
    data = [("a", "d1", 1, 1, "r1", [1], {"k": 1}), ("a", "d2", 2, 2, "r2", [2], {"k": 2}), (None, "d3", 3, 3, None, None, None)]
    kept = exact_dedup.dedup_rows(rows(spark, data, schema))
    assert kept.columns == ["text", "digest", "salt", "doc_id", "row", "content", "more"]
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[3]) == [data[1], data[2]]


def test_hot_group_and_empty_table(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', CAST(id AS string)) AS text")
    got = exact_dedup.assign(docs).filter("group_size > 1")
    assert got.count() == 1000 and got.filter("kept").collect()[0]["doc_id"] == 2997
    empty = docs.limit(0)
    assert exact_dedup.assign(empty).count() == 0 and exact_dedup.dedup_rows(empty).columns == ["doc_id", "text"]


def test_raking_meets_the_marginals():
    rng = np.random.default_rng(1)
    mass = rng.integers(1, 100, (4, 3, 2)).astype(float)
    wanted = [np.array([.1, .2, .3, .4]), np.array([.5, .25, .25]), np.array([.6, .4])]
    got = mixing.rake(mass, wanted)
    for axis, want in enumerate(wanted):
        have = got.sum(axis=tuple(a for a in range(3) if a != axis))
        assert np.allclose(have / got.sum(), want, atol=1e-8)
    # Interactions of the start stay: odds ratios don't change under raking.
    odds = lambda m: m[0, 0, 0] * m[1, 1, 0] / (m[0, 1, 0] * m[1, 0, 0])
    assert odds(got) == pytest.approx(odds(mass))


def test_missing_values_and_unnamed_categories():
    cells = [{"a": "x", "b": "u", "docs": 2, "tokens": 20}, {"a": "other", "b": "u", "docs": 1, "tokens": 10},
             {"a": "x", "b": "other", "docs": 1, "tokens": 0}]
    got = mixing.fit_cells(cells, {"a": {"x": 1.0, "y": 3.0}, "b": {"u": 1.0}})
    assert [round(c["cell_weight"], 6) for c in got] == [round(2 / 3, 6), round(1 / 3, 6), 0.0]
    assert got[2]["keep_probability"] == 1.0


def test_a_scarce_value_does_not_empty_the_mix(caplog, spark):
    cells = [{"a": "rare", "docs": 1, "tokens": 300}] + [{"a": f"s{i}", "docs": 1000, "tokens": 1_000_000} for i in range(3)]
    targets = {"a": {"rare": 1.0, "s0": 1.0, "s1": 1.0, "s2": 1.0}}
    kept = lambda got: sum(c["tokens"] * c["keep_probability"] for c in got)
    exact = mixing.fit_cells(cells, targets)
    assert kept(exact) == pytest.approx(1200) and not mixing.unmet(exact, targets)
    for share, budget, want in ((0.5, None, 0.5 * 3_000_300), (0.5, 1e6, 1e6), (1.0, None, 3_000_300), (1e-5, None, 1200)):
        got = mixing.fit_cells(cells, targets, budget, share)
        assert kept(got) == pytest.approx(want) and got[0]["keep_probability"] == 1.0
        assert got[1]["keep_probability"] == pytest.approx(got[3]["keep_probability"])
    miss = {m["value"]: m for m in mixing.unmet(mixing.fit_cells(cells, targets, None, 0.5), targets)}
    assert miss["rare"]["wanted"] == pytest.approx(0.25) and miss["rare"]["kept"] == pytest.approx(300 / 1_500_150)
    docs = rows(spark, [(1, "w " * 10, "en", "rare", 1)] + [(i, "w " * 100, "en", "much", 1) for i in range(2, 200)],
                "doc_id long, text string, lang string, source string, n int")
    out = mixing.mix(docs, {"source": {"rare": 1.0, "much": 1.0}}, min_share=0.5)
    assert out.selectExpr("sum(tokens * keep_probability) / sum(tokens)").first()[0] == pytest.approx(0.5)
    assert "share of source rare" in caplog.text


def test_mix_is_repeatable_and_carries_columns(spark):
    schema = DOCS + ", tokens string, _chance int, topic string"
    data = [(i, "w " * (i % 300) if i % 50 else None, ["en", "de", None][i % 3], f"src{i % 4}", 1, "t", 7, "old") for i in range(600)]
    docs = rows(spark, data, schema)
    targets = {"source": {f"src{i}": 1.0 for i in range(4)}, "lang": {"en": .8, "de": .2}, "topic": {"note": .3, "article": .7}}
    got = mixing.mix(docs, targets).toPandas()
    again = mixing.mix(docs.repartition(2), targets).toPandas()
    assert set(got[got.sampled].doc_id) == set(again[again.sampled].doc_id) and len(got) == 600
    assert set(docs.columns) <= set(got.columns) and got.columns.is_unique
    got["mass"] = got.tokens * got.keep_probability
    by = got.groupby(["lang"]).mass.sum()
    assert by["en"] / by["de"] == pytest.approx(4, rel=1e-6)
    assert mixing.mix(docs.limit(0), targets).count() == 0


def test_held_out_rows_follow_the_crc(spark):
    import zlib
    ids = spark.range(200).selectExpr("id AS doc_id")
    got = {r[0]: r[1] for r in ids.select("doc_id", quality.held_out(ids["doc_id"])).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def test_targets_that_contradict_each_other_are_reported(caplog):
    cells = [{"a": "x", "b": "en", "docs": 5, "tokens": 100}, {"a": "y", "b": "de", "docs": 5, "tokens": 100}]
    targets = {"a": {"x": 0.5, "y": 0.5}, "b": {"en": 0.8, "de": 0.2}}
    fitted = mixing.fit_cells(cells, targets)
    assert "contradict" in caplog.text
    missed = {(m["name"], m["value"]): (round(m["wanted"], 3), round(m["kept"], 3)) for m in mixing.unmet(fitted, targets)}
    assert missed == {("a", "x"): (0.5, 0.8), ("a", "y"): (0.5, 0.2)}


def test_rows_repeated_beyond_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "STRETCH", 4)
    docs = spark.createDataFrame([(7, "same")] * 11 + [(3, "same"), (None, None), (None, "")], "doc_id long, text string")
    out = exact_dedup.assign(docs).collect()
    assert len(out) == 14 and sum(r.kept for r in out if r.doc_id == 7) == 1
    assert {(r.keep_id, r.group_size) for r in out if r.doc_id in (3, 7)} == {(7, 12)}


def test_very_long_texts(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, long + "x")], "doc_id long, text string")
    kept = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.assign(docs).collect()}
    assert kept == {1: (2, False), 2: (2, True), 3: (3, True)}
    whole = docs.withColumn("source", F.lit("src0")).withColumn("lang", F.lit("en"))
    assert [r.tokens for r in mixing.mix(whole).orderBy("doc_id").collect()] == [400_000, 400_000, 400_001]
