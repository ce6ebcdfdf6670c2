"""Quantiles, outlier passes, splits, ranks, KNN: checked against pandas/numpy
or brute force on small inputs."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ecoframe.operators import features as FE
from ecoframe.operators import knn as KNN
from ecoframe.operators import outliers as OU
from ecoframe.operators.quantiles import exact_quantiles, quantiles_between, sketch_marks
from ecoframe.operators.windows import rank_within_groups, running_sum


@pytest.mark.parametrize("buckets", [2, 16])
def test_exact_quantiles_match_pandas(spark, buckets):
    rnd = random.Random(7)
    xs = [rnd.choice([rnd.random() * 100, 5.0, 5.0, 0.0]) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.75], buckets=buckets)
    want = pd.Series(xs, dtype="float64").quantile([0.25, 0.5, 0.75]).tolist()
    assert all(math.isclose(a, b, rel_tol=0, abs_tol=1e-12) for a, b in zip(got, want))


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_between_marks_are_exact_whatever_the_marks(spark, seed):
    rnd, inf = random.Random(seed), float("inf")
    xs = [rnd.choice([rnd.gauss(0, 1e3), 5.0, round(rnd.random(), 1), 0.0]) for _ in range(1500)] + [None, float("nan"), None]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    want = exact_quantiles(df, "x", probs)
    assert want == pytest.approx(np.quantile([x for x in xs if x is not None and x == x], probs).tolist(), rel=0, abs=1e-9)
    for marks in (df.agg(sketch_marks("x", probs)).first()[0], None, [5.0], [-1e9, 1e9], [0.05], [inf]):
        assert quantiles_between(df, "x", probs, marks, buckets=16) == want
    ends = df.select("x").union(spark.createDataFrame([(inf,)] * 900 + [(-inf,)] * 900, "x double"))
    marks = ends.agg(sketch_marks("x", [0.1, 0.5, 0.9])).first()[0]
    assert all(abs(m) < inf for m in marks)
    np.testing.assert_array_equal(quantiles_between(ends, "x", [0.1, 0.5, 0.9], marks), exact_quantiles(ends, "x", [0.1, 0.5, 0.9]))
    assert quantiles_between(df.filter("x > 1e12 AND NOT isnan(x)"), "x", [0.5], None) == [None]


def test_chain_of_an_empty_table(spark):
    """No rows, or no group with a mean: nothing is kept and the thresholds are NaN."""
    schema = "cn string, ft string, year int, v double"
    for rows in ([], [(None, "D", 2021, 1.0)]):
        df = spark.createDataFrame(rows, schema)
        out, reports = OU.outlier_chain(df, ["v"], ["cn", "ft", "year"])
        assert out.count() == 0 and math.isnan(reports[0].threshold) and reports[0].rows_after == 0


def test_outlier_pass_matches_pandas(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["D", "E"]), rnd.choice([2021, 2022]),
             float(rnd.randint(0, 40)) * 0.5) for _ in range(400)]
    df = spark.createDataFrame(rows, "cn string, ft string, year int, v double")
    kept, seuil = OU.outlier_pass(df, "v", ["cn", "ft", "year"], keep_helpers=False)
    p = pd.DataFrame(rows, columns=["cn", "ft", "year", "v"])
    stats = p.groupby(["cn", "ft", "year"]).agg(v_mean=("v", "mean")).reset_index()
    m = pd.merge(p, stats, on=["cn", "ft", "year"], how="left")
    m["d"] = (m["v"] - m["v_mean"]).abs()
    q1, q3 = m["d"].quantile(0.25), m["d"].quantile(0.75)
    want = (q3 + 1.5 * (q3 - q1)).round(1)
    assert seuil == want
    assert kept.count() == int((m["d"] <= want).sum())


def test_chain_golden_counts_sf0001(spark):
    from ecoframe.plans import vehicles as V
    sf = "/root/testdata/sf0.001"
    out, reports = V.chain(spark, sf)
    assert [r.rows_after for r in reports] == [5196, 4999, 4908, 4751, 4558, 4234]
    assert [r.threshold for r in reports] == [65.0, 4.3, 634.3, 1318.1, 102.6, 1.0]
    assert [r.at_or_above for r in reports] == [151, 197, 91, 157, 193, 335]
    fin = V.final(spark, sf)
    assert fin.count() == 3390
    assert {r.ft: r["count"] for r in fin.groupBy("ft").count().collect()} == {
        "Essence": 1333, "GPL": 840, "Diesel": 804, "Hydrogene": 413}
    assert fin.select("mk").distinct().count() == 19


def test_stage_counts_sf0001(spark):
    from ecoframe.plans import vehicles as V
    sf = "/root/testdata/sf0.001"
    assert V.src(spark, sf).count() == 5865
    assert V.dedup(spark, sf).count() == 5811
    assert V.brand(spark, sf).count() == 5347


def test_rank_within_groups_equals_row_number(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, t int, id int")
    got = {(r.id, r.rn) for r in rank_within_groups(df, ["g"], ["t", "id"], "rn").collect()}
    p = pd.DataFrame(rows, columns=["g", "t", "id"]).fillna({"g": "~null"})
    p = p.sort_values(["g", "t", "id"])
    p["rn"] = p.groupby("g").cumcount() + 1
    assert got == set(zip(p["id"], p["rn"]))


def test_running_sum(spark):
    rows = [(i, (i * 37) % 11) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, n long")
    got = {r.id: r.running for r in running_sum(df, "id", "n").collect()}
    acc = 0
    for i, n in rows:
        acc += n
        assert got[i] == acc


def test_hash_split_is_stable_and_disjoint(spark):
    df = spark.createDataFrame([(str(i),) for i in range(2000)], "k string")
    a = FE.with_split(df, F.col("k"))
    b = FE.with_split(df.repartition(7), F.col("k"))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    n_test = a.filter("split = 'test'").count()
    assert 300 < n_test < 500


def test_exact_split_size(spark):
    df = spark.createDataFrame([(str(i % 50),) for i in range(1001)], "k string")
    s = FE.exact_split(df, F.col("k"))
    assert s.filter("split = 'test'").count() == math.ceil(0.2 * 1001)


def test_scaler_matches_sklearn_convention(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    st = FE.scaler_stats(df, ["a", "b"])
    assert st["b"] == (5.0, 1.0)
    assert math.isclose(st["a"][1], float(np.std([1.0, 2.0, 4.0])))


def test_knn_matches_brute_force(spark):
    rnd = random.Random(5)
    train = [(f"t{i:04d}", float(rnd.randint(0, 20)), float(rnd.randint(0, 3)), float(rnd.randint(0, 100)))
             for i in range(300)]
    query = [(f"q{i:03d}", float(rnd.randint(0, 20)), float(rnd.randint(0, 3)), 0.0) for i in range(60)]
    tr = spark.createDataFrame(train, "id string, x double, y double, label double")
    te = spark.createDataFrame(query, "id string, x double, y double, label double")
    got = {r.id: r.prediction for r in KNN.knn_regress(tr, te, ["x", "y"], "label", "id", "id", k=5).collect()}
    for qid, qx, qy, _ in query:
        d = sorted((math.hypot(x - qx, y - qy), tid, lab) for tid, x, y, lab in train)[:5]
        assert math.isclose(got[qid], sum(t[2] for t in d) / 5)


def _plans(monkeypatch, module):
    """Optimized and physical plans of what ``module`` writes, by table name."""
    plans, write = {}, module.materialize

    def spied(df, name):
        q = df._jdf.queryExecution()
        plans[name] = (q.optimizedPlan().toString(), q.executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(module, "materialize", spied)
    return plans


def test_fuel_stage_needs_one_aggregate_of_the_raw_rows(spark, tmp_path, monkeypatch):
    from ecoframe.plans import vehicles as V
    spark.createDataFrame([(1, 1, 1, 1, 0.05), (1, 1, 1, 1, 0.05), (2, 2, 12, 1, 0.1), (3, 1, 2, 1, None)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "red", 3), (2, "blue", 4)], "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, TIMESTAMP '1995-01-01' AS o_orderdate FROM range(1, 4)").write.parquet(f"{tmp_path}/orders.parquet")
    plans = _plans(monkeypatch, V)
    assert V.fuel(spark, str(tmp_path)).count() == 1  # the second row's fuel is unknown, the third has a null
    optimized, _ = plans["fuel-v2"]
    assert optimized.count("Aggregate [") == 1 and "CollectMetrics" not in optimized
    assert V.raw_counts(spark, str(tmp_path)) == {"src": 2, "dedup": 2}


def test_chain_shuffles_no_rows_and_keeps_null_keys_out(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(rnd.choice(["x", "y", None]), rnd.choice(["g", "h"]), rnd.choice([2021, 2022, None]), rnd.gauss(100, 9), rnd.gauss(5, 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "cn string, ft string, year int, a double, b double")
    want = df
    for t in ("a", "b"):
        want, _ = OU.outlier_pass(want, t, keep_helpers=False)
    plans = _plans(monkeypatch, OU)
    got, reports = OU.outlier_chain(df, ["a", "b"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == df.columns
    assert reports[-1].rows_after == got.count() > 0
    for t in ("a", "b"):
        assert "Exchange hashpartitioning" not in plans[f"outlier-{t}"][1]
