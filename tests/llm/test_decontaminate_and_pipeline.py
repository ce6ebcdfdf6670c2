import os
import random
import time
from pathlib import Path

import pytest

from ecoframe.llm import decontaminate, stages
from ecoframe.session import work_dir
from tests_llm_paths import SF


def edits_within(item, text):
    """Smallest edit distance of the whole item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(rnd, text, n):
    out = list(text)
    for _ in range(n):
        k = rnd.randrange(len(out))
        kind = rnd.random()
        if kind < 0.4:
            out[k] = rnd.choice("xyz ")
        elif kind < 0.7:
            out.insert(k, rnd.choice("xyz "))
        else:
            del out[k]
    return "".join(out)


@pytest.mark.parametrize("seed", range(4))
def test_matches_equal_brute_force(seed):
    rnd = random.Random(seed)
    prose = lambda n: "".join(rnd.choice("abcde  ") for _ in range(n))
    items = [(i, prose(rnd.randint(30, 120))) for i in range(8)]
    index = decontaminate.Index(items)
    texts = []
    for _ in range(25):
        item = rnd.choice(items)[1]
        texts.append(prose(rnd.randint(0, 80)) + edited(rnd, item, rnd.randint(0, len(item) // 8)).upper() + prose(rnd.randint(0, 80)))
    texts += ["", None, prose(5), items[0][1] + items[1][1]]
    for text, found in zip(texts, index.matches(texts), strict=True):
        plain, got = decontaminate.normalise(text), {r["item_id"]: r for r in found}
        for number, item in zip(index.ids, index.texts, strict=True):
            distance = edits_within(item, plain)
            assert (number in got) == (distance <= index.edits[index.ids.index(number)])
            if number in got:
                r = got[number]
                assert r["edits"] == distance == edits_within(item, plain[r["start"]:r["end"]])


def test_short_items_match_whole_words_exactly():
    index = decontaminate.Index([(1, "Who wrote Hamlet?"), (2, "capital of france"), (3, "too short")])
    texts = ["so: who WROTE\nhamlet? me", "who wrote hamlet", "the capital of france.", "capital of frances, but capital of france",
             "xcapital of france", "capital of franca", "too short", "who wrote hamlet?"]
    got = [[(r["item_id"], r["start"], r["end"], r["edits"]) for r in found] for found in index.matches(texts)]
    assert got == [[(1, 4, 21, 0)], [], [(2, 4, 21, 0)], [(2, 24, 41, 0)], [], [], [], [(1, 0, 17, 0)]]


def test_report_and_clean_rows(spark):
    item = "The quick brown fox jumps over the lazy dog while the cat looks on."
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (None, item), (4, "short")], "item_id long, text string")
    schema = "doc_id long, text string, item_id string, matches int, _row int"
    docs = spark.createDataFrame([(1, "x " + item.upper().replace(" ", "\n") + " y", "c", 1, 1), (2, "clean", "c", 1, 1),
                                  (3, None, None, None, None), (4, "", "c", 1, 1), (None, item, "c", 1, 1),
                                  (5, "z " * 200_000 + item, "c", 1, 1), (2, "clean", "c", 1, 1)], schema)
    got = decontaminate.report(docs, bench).collect()
    assert sorted([(r["doc_id"], r["contaminated"], r["n_items"]) for r in got], key=str) == sorted(
        [(1, True, 2), (2, False, 0), (2, False, 0), (3, False, 0), (4, False, 0), (None, True, 2), (5, True, 2)], key=str)
    place = next(r for r in got if r["doc_id"] == 1)["matches"][0]
    assert (place["start"], place["end"], place["edits"]) == (2, 2 + len(item), 0)
    kept = decontaminate.clean_rows(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 2, 3, 4]
    blocks = decontaminate.report(docs, bench, block_chars=80).collect()  # several blocks of items
    assert [r["n_items"] for r in sorted(blocks, key=str)] == [r["n_items"] for r in sorted(got, key=str)]
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.report(docs.limit(0), bench).count() == 0


def test_blocks_find_what_one_block_finds(spark):
    """Places, edits and kept rows are those of one block, with an id that holds many texts, repeated rows and copies."""
    rnd = random.Random(5)
    prose = lambda n: "".join(rnd.choice("abcde  ") for _ in range(n))
    items = [(1 if i % 3 == 0 else i, prose(rnd.randint(20, 120))) for i in range(30)]
    items += [items[0], (1, items[3][1].upper()), (None, prose(50)), (7, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [prose(40) + edited(rnd, rnd.choice(items[:30])[1], rnd.randint(0, 3)) + prose(40) for _ in range(20)]
    texts += [items[0][1] + items[1][1] + items[0][1], texts[0], texts[0], prose(200), "", None]
    rows = [(i, t, "d", 0, "r") for i, t in enumerate(texts)] + [(3, texts[3], "d", 0, "r")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, _matches int, _row string")
    key = lambda r: (r["doc_id"], r["contaminated"], r["n_items"], tuple(tuple(m) for m in r["matches"]))
    whole = sorted(map(key, decontaminate.report(docs, bench).collect()))
    some = sorted(map(key, decontaminate.report(docs, bench, block_chars=300).collect()))
    assert whole == some and len(some) == len(rows) and any(len(r[3]) > 1 for r in some)
    kept = decontaminate.clean_rows(docs, bench, block_chars=300)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in whole if not r[1])
    assert sorted(kept.collect(), key=str) == sorted(decontaminate.clean_rows(docs, bench).collect(), key=str)


def test_blocks_are_dealt_by_text_and_dropped_one_by_one(spark, monkeypatch):
    """An id with all texts is dealt over the blocks, and a block is dropped before the next is broadcast."""
    bench = spark.range(400).selectExpr("7L AS item_id", "concat(repeat(concat('w', id, ' '), 8), 'end') AS text")
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('so ', repeat(concat('w', id * 10, ' '), 8), 'end') AS text")
    sizes, alive, most = [], set(), []
    make, destroy = decontaminate.Index.__init__, decontaminate.Broadcast.destroy

    def made(self, items, *options):
        sizes.append(sum(len(t) for _, t in items))
        alive.add(len(sizes))
        most.append(len(alive))
        make(self, items, *options)

    def destroyed(self, *options):
        alive.clear()
        destroy(self, *options)

    monkeypatch.setattr(decontaminate.Index, "__init__", made)
    monkeypatch.setattr(decontaminate.Broadcast, "destroy", destroyed)
    got = decontaminate.report(docs, bench, block_chars=2_000).collect()
    assert all(r["contaminated"] for r in got if r["doc_id"] < 40) and not any(r["contaminated"] for r in got if r["doc_id"] >= 40)
    assert len(sizes) > 5 and max(sizes) < 2 * 2_000 and max(most) == 1


def test_sample_documents_with_whole_items_are_found(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [decontaminate.normalise(r["text"]) for r in bench.collect()]
    want = {r["doc_id"] for r in docs.collect() if any(i in decontaminate.normalise(r["text"]) for i in items)}
    got = {r["doc_id"] for r in decontaminate.report(docs, bench).filter("contaminated").collect()}
    assert want and want <= got


def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    docs, steps = spark.read.parquet(f"{SF}/documents.parquet"), []
    start = docs
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, SF)
        rows = out.collect()
        if name != "mix":
            assert out.columns == docs.columns
        before = {r["doc_id"]: tuple(r) for r in docs.collect()}
        assert all(tuple(r)[:len(docs.columns)] == before[r["doc_id"]] for r in rows)
        steps.append(len(rows))
        docs = spark.createDataFrame([tuple(r) for r in rows], out.schema)
    assert start.count() > steps[0] > steps[1] > steps[2] >= steps[3] > steps[4] > 0
    folder = Path(work_dir(spark).removeprefix("file:"))
    old = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, SF)
    (left,) = set(os.listdir(folder)) - old  # no operator leaves a table
    assert os.listdir(folder / left) == ["mix"]
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in docs.collect())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, start, SF).collect()}
    assert all((i in good) == bool(q) for i, q in labels.items())


def test_owned_tables_go_at_the_end(spark):
    outer = stages.Stages(spark, "outer")
    kept = outer.write(spark.range(3), "kept")
    with stages.owned():
        inner = stages.Stages(spark, "inner")
        rows = inner.write(spark.range(5), "rows")
        with stages.owned():
            deeper = stages.Stages(spark, "deeper")
            deeper.write(spark.range(1), "rows")
        assert rows.count() == 5 and not os.path.exists(deeper.base.removeprefix("file:"))
    assert not os.path.exists(inner.base.removeprefix("file:")) and kept.count() == 3
    with pytest.raises(KeyError), stages.owned():
        lost = stages.Stages(spark, "lost")
        lost.write(spark.range(1), "rows")
        raise KeyError
    assert not os.path.exists(lost.base.removeprefix("file:"))
    assert stages.Stages(spark, "free").write(spark.range(2), "rows").count() == 2  # without an owner nothing goes


@pytest.mark.parametrize("seed", range(3))
def test_repetitive_texts_are_aligned_whole(seed, monkeypatch):
    """Items and texts that repeat a few q-grams: the same items as by brute force, whichever way is taken."""
    rnd = random.Random(seed)
    items = [(i, (u * 40)[:rnd.randint(40, 90)]) for i, u in enumerate(["ab ", "abc", "x y z ", "aab "])]
    texts = [edited(rnd, (u * 200)[:300], rnd.randint(0, 40)) for u in ["ab ", "abc", "x y z ", "aab ", "q"]] + [items[0][1] + "end"]
    monkeypatch.setattr(decontaminate, "POSTINGS", 500)  # many stretches
    counted = decontaminate.Index(items).matches(texts)
    monkeypatch.setattr(decontaminate, "DENSE_POSTINGS", 100)
    monkeypatch.setattr(decontaminate, "WINDOW", 120)
    index = decontaminate.Index(items)
    aligned = index.matches(texts)
    for text, found, other in zip(texts, aligned, counted, strict=True):
        plain, got = decontaminate.normalise(text), {}
        for r in found:
            got[r["item_id"]] = min(r["edits"], got.get(r["item_id"], 99))
        assert set(got) == {r["item_id"] for r in other}
        for number, item in zip(index.ids, index.texts, strict=True):
            distance = edits_within(item, plain)
            assert (number in got) == (distance <= index.edits[index.ids.index(number)])
            assert number not in got or got[number] == distance


def test_repetitive_text_takes_little_time():
    start = time.perf_counter()
    found = decontaminate.Index([(i, "ab " * (100 + i)) for i in range(10)]).matches(["ab " * 33_000])
    assert {r["item_id"] for r in found[0]} == set(range(10)) and time.perf_counter() - start < 30
