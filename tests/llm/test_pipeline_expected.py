"""The documents that every pipeline stage must keep, worked out without the stages' code, and decontamination
of the sample tables against full edit distances."""

import hashlib
import itertools
import re
from collections import defaultdict

import numpy as np
import pytest

from ecoframe.llm import decontaminate, quality
from tests_llm_paths import SF


def plain(text):
    """Lower case, white space as blanks, one character for one."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in re.sub(r"\s", " ", text or ""))


def contaminated(texts, items):
    """Which texts hold an item within 8 % of its characters (full edit distance), short items exactly between word ends."""
    gap = 64  # more than any budget: no alignment reaches from one text into the next
    pieces, starts, at = [], [], 0
    for t in texts:
        starts.append(at)
        codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pieces += [codes, np.full(gap, -1)]
        at += len(codes) + gap
    whole = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
    steps, out = np.arange(len(whole) + 1, dtype=np.int32), np.zeros(len(texts), bool)
    for item in {i for i in items if len(i) >= 10}:
        if len(item) < 30:
            pattern = re.compile(r"(?<!\w)" + re.escape(item) + r"(?!\w)")
            out |= np.array([bool(pattern.search(t)) for t in texts])
            continue
        budget = min(int(len(item) * 0.08), (len(item) - 10) // 10)
        assert budget < gap
        row = np.zeros(len(whole) + 1, np.int32)
        for code in np.frombuffer(item.encode("utf-32-le"), np.uint32).astype(np.int64):
            new = row + 1
            np.minimum(new[1:], row[:-1] + (whole != code), out=new[1:])
            row = np.minimum.accumulate(new - steps) + steps
        ends = np.append(starts[1:], len(whole) + 1)
        out |= np.array([row[a + 1:b].min(initial=budget + 1) <= budget for a, b in zip(starts, ends)])
    return out


def near_groups(texts):
    """id -> smallest id of its component under five-word sets with similarity 0.8 or more: all pairs."""
    sets = {}
    for i, text in texts.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
            common = len(x & y)
            if 100 * common >= 80 * (len(x) + len(y) - common):
                first, second = sorted((root(a), root(b)))
                parent[second] = first
    return {i: root(i) for i in sets}


def raked_sample(docs):
    """Ids that the mix keeps: cells raked to the targets in plain Python, a document kept if its hash is below its cell's chance."""
    targets = [{f"src{i}": 0.05 for i in range(20)}, {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1}, {"note": 0.05, "article": 0.45, "report": 0.5}]
    cell, size, mass = {}, {}, defaultdict(float)
    for i, (text, source, lang) in docs.items():
        size[i] = len([w for w in re.split("[\x20\x09-\x0d]+", text or "") if w])
        topic = "note" if size[i] < 100 else "article" if size[i] < 1000 else "report"
        cell[i] = (source if source in targets[0] else "*", lang if lang in targets[1] else "*", topic)
        mass[cell[i]] += size[i]
    weight, total = dict(mass), sum(mass.values())
    for _ in range(1_000):
        worst = 0.0
        for axis, target in enumerate(targets):
            have, first = defaultdict(float), defaultdict(float)
            for key in weight:
                have[key[axis]] += weight[key]
                first[key[axis]] += mass[key]
            free = first["*"] / total
            asked = sum(v for k, v in target.items() if first[k] > 0)
            now = sum(have.values())
            want = {k: (free if k == "*" else target[k] / asked * (1 - free)) * now for k in have if have[k] > 0}
            spread = sum(want.values())
            scale = {k: w / spread * now / have[k] for k, w in want.items()}
            worst = max(worst, max(abs(s - 1) for s in scale.values()))
            weight = {k: w * scale.get(k[axis], 1.0) for k, w in weight.items()}
        if worst < 1e-10:
            break
    ratio = {k: weight[k] / mass[k] if mass[k] else 0.0 for k in weight}
    top = max(ratio.values())
    chance = {i: int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 16 ** 13 for i in docs}
    return {i for i in docs if chance[i] < (1.0 if mass[cell[i]] == 0 else min(1.0, ratio[cell[i]] / top))}


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    return read("documents"), [plain(r["text"]).strip() for r in read("benchmark").collect() if r["text"]]


def test_decontamination_equals_full_edit_distances(spark, tables):
    docs, items = tables
    rows = docs.select("doc_id", "text").collect()
    want = contaminated([plain(r["text"]) for r in rows], items)
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.report(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert want.any() and not want.all()
    assert {r["doc_id"] for r, hit in zip(rows, want) if hit} == {i for i, hit in got.items() if hit}


def test_every_stage_keeps_the_expected_documents(spark, tables):
    import corpus_pipeline

    docs, items = tables
    rows = {r["doc_id"]: (r["text"], r["source"], r["lang"]) for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r["doc_id"] for r in quality.score(docs, model).collect() if r["score"] >= 0.3}
    expected = [kept]
    last = {}
    for i in sorted(kept):
        last[rows[i][0] or ""] = i
    expected.append(set(last.values()))
    group = near_groups({i: rows[i][0] for i in expected[-1]})
    expected.append({i for i, first in group.items() if i == first})
    order = sorted(expected[-1])
    bad = contaminated([plain(rows[i][0]) for i in order], items)
    expected.append({i for i, hit in zip(order, bad) if not hit})
    expected.append(raked_sample({i: rows[i] for i in expected[-1]}))
    before = docs
    for (name, apply), want in zip(corpus_pipeline.STAGES, expected, strict=True):
        got = apply(spark, before, SF)
        assert {r["doc_id"] for r in got.select("doc_id").collect()} == want, name
        before = docs.filter(docs["doc_id"].isin(sorted(want)))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == expected[-1]
