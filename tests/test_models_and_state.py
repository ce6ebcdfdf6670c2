"""Least squares, neighbours in many columns, forest tables, registered models, releases, published outputs, stream state."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ecoframe.operators import artifacts as AR
from ecoframe.operators import evaluate as EV
from ecoframe.operators import features as FE
from ecoframe.operators import forest as FO
from ecoframe.operators import grow as GR
from ecoframe.operators import knn as KNN
from ecoframe.operators import linear as LS
from ecoframe.operators import models as MD
from ecoframe.operators import monitor as MO
from ecoframe.operators import walk as WK
from ecoframe.session import scratch_path
from ecoframe.sources import files as FS
from ecoframe.streaming import feeds as ST


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


# --- least squares ----------------------------------------------------------------------

def test_least_norm_equals_a_library_solver():
    rng = np.random.default_rng(1)
    flags = np.eye(4)[rng.integers(0, 4, 200)]
    for x in (rng.standard_normal((200, 3)), np.column_stack([flags, rng.standard_normal(200) * 1e3]),
              np.column_stack([flags, flags @ [1, 2, 3, 4], np.full(200, 7.0)]), np.zeros((200, 2))):
        y = x @ np.arange(1, x.shape[1] + 1) + rng.standard_normal(200)
        rows = np.column_stack([x, y])
        got, means, rank = LS.least_norm(len(rows), rows.sum(axis=0), rows.T @ rows)
        centred = x - x.mean(axis=0)
        want, _, full, _ = np.linalg.lstsq(centred, y - y.mean(), rcond=1e-10)
        assert rank == full and np.allclose(got, want, atol=1e-6)
        assert np.allclose(means, rows.mean(axis=0))


def test_least_squares_pipeline_with_dependent_flags(spark):
    rng = np.random.default_rng(3)
    rows = [(float(x), "abc"[i % 3], float(3 * x + 5 * (i % 3) + e)) for i, (x, e) in enumerate(zip(rng.normal(1e4, 10, 90), rng.normal(0, 1, 90)))]
    df = spark.createDataFrame([*rows, (None, "a", 1.0), (1.0, "a", None)], "x double, c string, y double")
    model = MD.fit_model(df.dropna(), "ols", ["x"], ["c"], "y", scale=False)
    again = MD.load_model(MD.save_model(model, scratch_path(spark, "ols")))
    pred = {(r.x, r.c): r.prediction for r in again.transform(df.dropna()).collect()}
    a = np.array([[x, *np.eye(3)["abc".index(c)], 1.0] for x, c, _ in rows])
    want = a @ np.linalg.lstsq(a, np.array([y for _, _, y in rows]), rcond=None)[0]
    assert np.allclose([pred[x, c] for x, c, _ in rows], want, atol=1e-6)
    with pytest.raises(ValueError):
        MD.fit_model(df.limit(0), "ols", ["x"], [], "y", scale=False)


# --- neighbours -------------------------------------------------------------------------

def test_neighbours_in_many_columns(spark):
    rng = np.random.default_rng(5)
    names = [f"f{i}" for i in range(26)]
    x = np.column_stack([rng.normal(0, [1000, 300, 50, 5, 1, 0.1, 10], (700, 7)), np.eye(19)[rng.integers(0, 19, 700)]]).round(3)
    x[100:160] = x[100]  # one vector held by many rows
    y = rng.integers(0, 1000, 700).astype(float)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + ", y double")
    train, query, report = df.filter("id < 600"), df.filter("id >= 600 OR id = 110"), {}
    got = {r.id: r.prediction for r in KNN.knn_regress(train, query, names, "y", "id", "id", k=5, report=report).collect()}
    for i in [110, *range(600, 700)]:
        d = np.sqrt(((x[:600] - x[i]) ** 2).sum(axis=1))
        near = np.lexsort((np.arange(600), d))[:5]
        assert abs(got[i] - y[near].mean()) < 1e-9
    assert report["sites"] == 541 and report["queries"] == 101
    assert 0 < report["pairs"] < 101 * 541  # the bounds spare most of the pairs


def test_neighbours_with_equal_distances_and_one_site(spark):
    train = spark.createDataFrame([(i, 1.0, 2.0, float(i)) for i in range(9)], "id int, a double, b double, y double")
    query = spark.createDataFrame([(1, 1.0, 2.0), (2, 50.0, -3.0), (3, None, 1.0), (4, float("nan"), 1.0)], "id int, a double, b double")
    got = {r.id: r.prediction for r in KNN.knn_regress(train, query, ["a", "b"], "y", "id", "id", k=3).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: None, 4: None}


def _brute(x, y, ids, q, k):
    d = np.zeros(len(x))
    for j in range(x.shape[1]):
        d += (x[:, j] - q[j]) ** 2
    return y[np.lexsort((ids, np.sqrt(d)))[:k]].mean()


def test_neighbours_across_cells(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 12, 900), rng.integers(0, 9, 900) * 0.5, rng.random(900) < 0.1]).astype(float)  # many equal distances
    x[:4] = [[1e6, -1e6, 0], [3e6, 0, 1], [-5e6, 5e6, 0], [1e6, -1e6, 1]]
    y, ids = rng.integers(0, 1000, 900).astype(float), np.array([f"r{i * 7 % 900:04d}" for i in range(900)])
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(str(i), *map(float, v), float(t)) for i, v, t in zip(ids, x, y)], "id string, a double, b double, c double, y double")
    q = np.concatenate([x[:60], rng.normal(5, 4, (60, 3)), [[2e6, 0.0, 0.0]]])
    query = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(q)], "id int, a double, b double, c double")
    report = {}
    got = {r.id: r.prediction for r in KNN.knn_regress(df, query, names, "y", "id", "id", k=5, cell=16, report=report).collect()}
    assert report["cells"] >= 4
    assert all(abs(got[i] - _brute(x, y, ids, v, 5)) < 1e-9 for i, v in enumerate(q))


def test_compared_sites_of_a_query_do_not_grow_with_the_table():
    rng = np.random.default_rng(4)
    compared = []
    for n in (4_000, 64_000):
        cell = KNN._Sites(KNN.pa.table({"_v": KNN.pa.array(list(rng.random((n, 3)))), "_lab": [[{"_tid": i, "_y": 0.0}] for i in range(n)]}), 3, 5)
        queries = rng.random((100, 3))
        compared.append(cell.size[cell.leaves(queries, np.full(100, np.inf))[2]].sum() / 100)
        assert cell.size.max() <= KNN.LEAF
    assert compared[1] < 1.5 * compared[0] < 1000


# --- forest as a table ------------------------------------------------------------------

def test_no_split_of_the_final_forest_is_too_small(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), "xyz"[i % 3], float(a * b + i % 3 + e)) for i, (a, b, e) in enumerate(rng.normal(0, 1, (200, 3)))]
    df = spark.createDataFrame(rows, "a double, b double, c string, y double")
    model = MD.fit_model(df, "rf_final", ["a", "b"], ["c"], "y", scale=False, numTrees=5)
    forest = model.stages[-1]
    nodes = FO.node_table(spark, FO.save_forest(forest, scratch_path(spark, "nodes")))
    table = {(r.tree, r.id): r for r in nodes.collect()}
    splits = [r for r in table.values() if r.left != FO.LEAF]
    assert splits and min(r.n_rows for r in splits) >= 9
    assert all(table[r.tree, r.left].n_rows + table[r.tree, r.right].n_rows == r.n_rows for r in splits)
    # the JVM's predictions are those of the table: walk every tree by hand
    placed = df
    for stage in model.stages[:-1]:
        placed = stage.transform(placed)
    for r in forest.transform(placed).limit(40).collect():
        values = []
        for tree in range(5):
            at = table[tree, 0]
            while at.left != FO.LEAF:
                x = r.features[at.feature]
                goes_left = x in at.left_categories if at.threshold is None else x <= at.threshold
                at = table[tree, at.left if goes_left else at.right]
            values.append(at.value)
        assert abs(r.prediction - np.mean(values)) < 1e-9
    means = FO.leaf_means(forest, placed, "y").join(FO.leaves(nodes), ["tree", "leaf"], "full").collect()
    assert all(m.n == m.n_rows and abs(m.mean - m.value) < 1e-9 for m in means)


def test_training_rows_of_a_task_are_bounded(spark):
    rows = spark.range(1000, numPartitions=2)
    many = MD.spread(rows, 100)
    assert many.rdd.getNumPartitions() == 10 and many.count() == 1000
    assert max(len(p) for p in many.rdd.glom().collect()) < 200
    assert MD.spread(rows, 500).rdd.getNumPartitions() == 2


def test_training_rows_of_a_forest_are_dealt_in_few_tasks(spark, monkeypatch):
    cores, seen = spark.sparkContext.defaultParallelism, []
    monkeypatch.setattr(MD, "TREE_ROWS", 100)
    monkeypatch.setattr(MD.Pipeline, "fit", lambda self, data: seen.append((data.rdd.getNumPartitions(), data.count())))
    for n in (90, 100 * cores, 2000 * cores):
        rows = spark.range(n, numPartitions=1).selectExpr("cast(id as double) a", "cast(id % 7 as double) y")
        MD.fit_model(rows, "rf_default", ["a"], [], "y", scale=False)
    assert seen == [(1, 90), (cores, 100 * cores), (cores, 2000 * cores)]
    monkeypatch.setattr(MD, "FOREST_ROWS", 900)
    MD.fit_model(rows, "rf_default", ["a"], [], "y", scale=False)
    assert seen[-1] == (3 * cores, 2000 * cores)


def test_final_forest_counts_equal_rows_once(spark):
    rows = [(float(i % 50), float(i % 7), "xyz"[i % 3], float(i * i % 11)) for i in range(300)]
    df = spark.createDataFrame([r for i, r in enumerate(rows) for _ in range(1 + i % 5)], "a double, b double, c string, y double")
    model = MD.fit_model(df, "rf_final", ["a", "b"], ["c"], "y", scale=False, numTrees=5)
    path = FO.save_forest(model.stages[-1], scratch_path(spark, "weighted"))
    roots = spark.read.parquet(f"{path}/data").filter("nodeData.id = 0").select("nodeData.rawCount").collect()
    assert {r.rawCount for r in roots} == {300}
    nodes = FO.node_table(spark, path)
    assert {r.n_rows for r in nodes.filter("id = 0").collect()} == {df.count()} == {900}
    assert nodes.filter("left <> -1").agg({"n_rows": "min"}).first()[0] >= 9
    # the forest is the one grown on every row
    stages = MD.feature_pipeline(["a", "b"], ["c"], False) + [MD.estimator("rf_final", numTrees=5)]
    plain = Pipeline(stages=stages).fit(df.withColumn("label", F.col("y")))
    whole = PipelineModel([*plain.stages[:-1], FO.min_split_forest(plain.stages[-1], MD.RF_FINAL_MIN_SPLIT)])
    both = [MD.predict(m, df.dropDuplicates(), ["a", "b", "c", "y"]).collect() for m in (model, whole)]
    one, other = ({r[:4]: r.y_pred for r in side} for side in both)
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-9 for k in one)
    placed = MD.together(df)
    for stage in model.stages[:-1]:
        placed = stage.transform(placed)
    means = FO.leaf_means(model.stages[-1], placed, "y", MD.WEIGHT).join(FO.leaves(nodes), ["tree", "leaf"], "full").collect()
    assert all(m.n == m.n_rows and abs(m.mean - m.value) < 1e-9 for m in means)


def _noisy_rows(spark, n=3000):
    rng = np.random.default_rng(0)
    rows = [(float(a), float(b) / 2, "xyz"[i % 3], float(round(a * b * 3 + i % 3 * 7 + e)) / 8) for i, (a, b, e) in enumerate(rng.integers(0, 60, (n, 3)))]
    return spark.createDataFrame(rows, "a double, b double, c string, y double")


def test_trees_grown_whole_are_those_of_the_library(spark, monkeypatch):
    df, tables, fitted = _noisy_rows(spark), [], []
    fit = MD.estimator("rf_final").__class__.fit
    monkeypatch.setattr(MD.estimator("rf_final").__class__, "fit", lambda self, data: fitted.append(data.count()) or fit(self, data))
    for most in (10**6, 10):
        monkeypatch.setattr(MD, "GROWN_ROWS", most)
        model = MD.fit_model(df, "rf_final", ["a", "b"], ["c"], "y", scale=False, numTrees=2, featureSubsetStrategy="all")
        nodes = FO.node_table(spark, FO.save_forest(model.stages[-1], scratch_path(spark, "grown")))
        tables.append({(r.tree, r.id): r for r in nodes.collect()})
    assert fitted[-1] <= 4  # the library grew none of it
    one, other = tables
    assert one.keys() == other.keys() and len(one) > 1000
    for k, r in one.items():
        s = other[k]
        assert (r.left, r.right, r.n_rows, r.feature, r.threshold, r.left_categories) == (s.left, s.right, s.n_rows, s.feature, s.threshold, s.left_categories)
        assert abs(r.value - s.value) < 1e-9


def test_bootstrap_of_equal_rows_draws_each(spark, monkeypatch):
    rows = _noisy_rows(spark, 500)
    df = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(4)))).drop("k")
    monkeypatch.setattr(MD, "GROWN_ROWS", 10)
    errors = []
    for _ in range(2):
        model = MD.fit_model(df, "rf_default", ["a", "b"], [], "y", scale=False, numTrees=40)
        path = FO.save_forest(model.stages[-1], scratch_path(spark, "drawn"))
        drawn = [r.n_rows for r in FO.node_table(spark, path).filter("id = 0").orderBy("tree").collect()]
        errors.append((drawn, EV.regression_metrics(MD.predict(model, df, [], "y")).first()["r2"]))
    assert len(set(drawn)) > 10 and all(abs(n - 2000) < 6 * 2000 ** 0.5 for n in drawn) and abs(np.mean(drawn) - 2000) < 45
    assert errors[0][0] == errors[1][0] and errors[0][1] > 0.95
    with pytest.raises(Exception):
        MD.fit_model(df.withColumn("a", F.when(F.col("a") > 5, F.col("a"))), "rf_default", ["a", "b"], [], "y", scale=False, numTrees=2)


def test_blocks_of_nodes_and_mapped_columns_change_no_tree(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 40, 4000), rng.integers(0, 9, 4000), rng.integers(0, 3, 4000)]).astype(np.uint8)
    layout = GR.Layout([np.arange(39.0), np.arange(8.0)], [(2, 3)], 5)
    rows = GR.Rows(x, np.round(x[0] * 1.0 * x[1] + rng.integers(0, 5, 4000)), np.ones(4000, np.float32))

    def tree():
        return GR.node_rows(GR.grow(rows, layout, np.random.default_rng(1), 5, 30, 1.0, 2), layout, 0, 0.0).to_pydict()

    whole = tree()
    for name, value in (("BLOCK", 3), ("CHUNK", 97), ("MAPPED", 1)):
        monkeypatch.setattr(GR, name, value)
    assert tree() == whole and len(whole["id"]) > 500
    shallow = GR.grow(rows, layout, np.random.default_rng(1), 2, 4, 1.0, 100)
    assert len(shallow) <= 5 and all((v["n"][v["split"]] >= 100).all() for v in shallow)


def test_candidate_splits_cut_the_weight():
    assert GR.candidates(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 256).tolist() == [1.5, 2.5]
    cut = GR.candidates(np.arange(1000.0), np.ones(1000), 10)
    assert len(cut) == 9 and np.allclose(np.diff(cut), 100, atol=2)


def test_walked_predictions_are_those_of_the_forest(spark):
    df = _noisy_rows(spark, 400)
    model = MD.fit_model(df, "rf_final", ["a", "b"], ["c"], "y", scale=False, numTrees=3)
    more = df.unionByName(spark.createDataFrame([(-5.0, 99.0, "new", 0.0), (99.0, -5.0, None, 0.0)], df.schema)).withColumn("a b", F.lit("kept"))
    want = sorted(map(str, model.transform(more).select("a b", "y", F.col("prediction").alias("y_pred")).collect()))
    got = MD.predict(model, more, ["a b", "y"])
    assert sorted(map(str, got.collect())) == want
    assert "MapInArrow" in got._jdf.queryExecution().toString()
    with pytest.raises(Exception):
        MD.predict(model, df.withColumn("a", F.lit(None).cast("double")), ["y"]).collect()
    scaled = MD.fit_model(df, "rf_final", ["a"], [], "y", numTrees=2)
    assert WK.inputs(scaled) is None and MD.predict(scaled, df, ["a"]).count() == 400


def test_dashboard_forest_is_not_kept(spark, monkeypatch):
    from ecoframe.plans import registry as R
    df = spark.createDataFrame([(f"k{i}", *(float(i % (j + 2)) for j in range(len(R.DASHBOARD_FEATURES))), float(i % 2)) for i in range(40)],
                               ", ".join(["row_key string", *[f"{c} double" for c in R.DASHBOARD_FEATURES], f"{R.TARGET} double"]))
    memo = {}
    monkeypatch.setattr(R.V, "_once", lambda spark, sf, stage, rule, make: memo.setdefault(stage, make()))
    monkeypatch.setattr(R.M, "train_test", lambda spark, sf: (df, df))
    monkeypatch.setitem(MD.RF_DEFAULT, "numTrees", 2)
    assert R.q_rf_default(spark, "none").count() == 40
    assert list(memo) == ["predictions-rf_default-"]


def test_landed_requests_grow_in_files_not_in_file_size():
    from ecoframe.plans import registry as R
    assert R._files_per_batch(0) == R._files_per_batch(1000) == 2
    assert R._files_per_batch(9_000_000) == 9_000_000 / 3 / R.REQUEST_ROWS


def test_category_list_refuses_a_column_without_categories(spark):
    df = spark.range(50).selectExpr("cast(id as string) AS c")
    assert len(FE.category_list(df, "c")) == 50
    with pytest.raises(ValueError):
        FE.category_list(df, "c", most=49)


def test_model_comparison_takes_known_predictions(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(a), "xy"[i % 2], float(2 * a + 3 * (i % 2))) for i, a in enumerate(rng.normal(0, 1, 80))]
    df = spark.createDataFrame(rows, "id long, a double, c string, y double")
    train, test = df.filter("id < 60"), df.filter("id >= 60")
    known = {("ols", "plain"): test.select(F.col("y").alias("y_true"), F.col("y").alias("y_pred"))}
    out = {(r.model, r.features): r for r in MD.compare_models(
        train, test, "y", {"plain": (["a"], []), "flags": (["a"], ["c"])}, "id", ("ols", "knn"), {"c": ["x", "y"]}, known).collect()}
    assert set(out) == {(m, f) for m in ("ols", "knn") for f in ("plain", "flags")}
    assert out["ols", "plain"].mse == 0 and out["ols", "flags"].mse < 1e-12 and all(r.n == 20 for r in out.values())


# --- runs, models, outputs --------------------------------------------------------------

def test_repeated_log_changes_nothing(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "run_id string, run_name string, start_time timestamp, params map<string,string>, metrics map<string,double>, tags map<string,string>"
    runs = spark.createDataFrame([("a", "rf", t, {}, {"r2": 1.0}, {}), ("b", "rf", t, {}, {}, {}), ("a", "rf", t, {}, {"r2": 1.0}, {})], schema)
    path = scratch_path(spark, "log")
    once = sorted((r.run_id, r.version) for r in MO.log_runs(runs, path).collect())
    assert once == [("a", 1), ("b", 2)]
    assert sorted((r.run_id, r.version) for r in MO.log_runs(runs, path).collect()) == once
    more = spark.createDataFrame([("b", "rf", t, {}, {}, {}), ("c", "rf", t, {}, {}, {})], schema)
    assert sorted((r.run_id, r.version) for r in MO.log_runs(more, path).collect()) == [*once, ("c", 3)]


def test_models_are_chosen_by_name_and_refuse_other_rows(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i, 3.0 * i) for i in range(20)], "id long, x double, y double, z double")
    base, log = scratch_path(spark, "models"), scratch_path(spark, "model-log")
    for label in ("y", "z"):
        model = MD.fit_model(df, "ols", ["x"], [], label, scale=False)
        AR.register_model(model, MD.model_signature(model, df, ["x"]), "line", base, log, {"label": label}, {"r2": 1.0})
    newest = {r.id: r.prediction for r in AR.score_by_name(df, log, "line", ["id"]).collect()}
    first = {r.id: r.prediction for r in AR.score_by_name(df, log, "line", ["id"], version=1).collect()}
    assert abs(newest[4] - 12) < 1e-9 and abs(first[4] - 8) < 1e-9
    with pytest.raises(ValueError):
        AR.score_by_name(df.withColumn("x", F.col("x").cast("string")), log, "line", ["id"])
    with pytest.raises(ValueError):
        AR.score_by_name(df.drop("x"), log, "line", ["id"])
    with pytest.raises(LookupError):
        AR.score_by_name(df, log, "other", ["id"])


def test_outputs_are_seen_whole_or_not_at_all(spark):
    base, manifest = scratch_path(spark, "out"), scratch_path(spark, "manifest")
    t = dt.datetime(2024, 1, 1)
    with pytest.raises(LookupError):
        AR.read_published(spark, manifest, "raw")
    AR.publish(spark.range(3), base, "raw", manifest, t)
    spark.range(9).write.parquet(MO.stamped_path(base, "raw", t + dt.timedelta(days=1)))  # a job that was lost before its commit
    assert AR.read_published(spark, manifest, "raw").count() == 3
    AR.publish(spark.range(5), base, "raw", manifest, t + dt.timedelta(days=2))
    assert AR.read_published(spark, manifest, "raw").count() == 5
    assert AR.read_published(spark, manifest, "raw", as_of=t + dt.timedelta(days=1)).count() == 3


def test_final_release_replaces_the_provisional_one(spark):
    path = scratch_path(spark, "releases")
    years = lambda ys, cn: spark.createDataFrame([(y, f"{cn}{y}") for y in ys], "year int, cn string")
    FS.write_release(years([2021, 2022, 2023], "p"), path, "Pv")
    FS.write_release(years([2021, 2022], "f"), path, "Fv")
    FS.write_release(years([2021], "q"), path, "Other")
    rows = lambda df: sorted(r.cn for r in df.collect())
    assert rows(FS.scan_releases(spark, path)) == ["f2021", "f2022", "p2023"]
    assert rows(FS.scan_releases(spark, path, years=[2022, 2023, 2050])) == ["f2022", "p2023"]
    assert rows(FS.scan_releases(spark, path, precedence=["Pv"])) == ["p2021", "p2022", "p2023"]
    plan = FS.scan_releases(spark, path, years=[2022])._jdf.queryExecution().executedPlan().toString()
    assert "release" in plan.split("PartitionFilters: [")[1].split("]")[0]  # other folders are not read
    assert FS.scan_releases(spark, path, years=[]).count() == 0


def test_profile_counts_without_expanding_rows(spark):
    df = spark.createDataFrame([("a", 0.0, 1), ("a", -0.0, None), (None, float("nan"), 1), ("", None, 1)], "s string, x double, n int")
    out = EV.profile(df)
    got = {r.column_name: (r.data_type, r.non_null, r.n_distinct, r.n_rows) for r in out.collect()}
    assert got == {"s": ("string", 3, 2, 4), "x": ("double", 3, 2, 4), "n": ("int", 3, 1, 4)}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.n_rows for r in EV.profile(df.limit(0)).collect()] == [0, 0, 0]


# --- stream state -----------------------------------------------------------------------

SAMPLE = "id long, metric string, ts timestamp, value double"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SAMPLE).coalesce(1).write.mode("append").parquet(folder)


def test_history_replaces_only_the_buckets_it_touches(spark):
    t = dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], SAMPLE).schema
    landing, history, ckpt = (scratch_path(spark, n) for n in ("samples", "history", "ckpt"))
    run = lambda: ST.first_samples(spark, landing, schema, history, ckpt, tie="id", buckets=16)
    first = [(i, "r2", t + dt.timedelta(seconds=i), i / 8) for i in range(1, 200)]
    land(spark, landing, first)
    run()
    files = lambda v: {b for b in os.listdir(f"{local(history)}/buckets-16/version={v}") if b.startswith("bucket=")}
    assert len(files(0)) == 16
    land(spark, landing, [(500, "r2", t - dt.timedelta(days=1), 0.125), (501, "r2", t, 0.0), (502, "r2", t + dt.timedelta(days=1), 0.125)])
    run()
    assert len(files(1)) == 1  # one value, one bucket
    run()  # nothing new
    stored = {r.value: r.id for r in ST.current(spark, history, schema).collect()}
    assert stored == {**{v: i for i, _, _, v in first}, 0.125: 500}
    for i in range(3):  # older versions of a bucket go, all but the one a replay needs
        land(spark, landing, [(600 + i, "r2", t - dt.timedelta(days=2 + i), 0.125)])
        run()
    bucket = files(4).pop()
    kept = [v for v in os.listdir(f"{local(history)}/buckets-16") if os.path.exists(f"{local(history)}/buckets-16/{v}/{bucket}")]
    assert sorted(kept) == ["version=3", "version=4"]
    assert {r.value: r.id for r in ST.current(spark, history, schema).collect()}[0.125] == 602
    with pytest.raises(ValueError):
        ST.first_samples(spark, landing, schema, history, ckpt, tie="id", buckets=8)


def test_latest_sample_survives_a_restart_and_late_rows(spark):
    t = dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], SAMPLE).schema
    landing, latest, ckpt = (scratch_path(spark, n) for n in ("samples", "latest", "ckpt"))
    run = lambda: ST.latest_samples(spark, landing, schema, latest, ckpt, tie="id")
    land(spark, landing, [(1, "r2", t, 0.5), (2, "rmse", t, 3.0)])
    run()
    land(spark, landing, [(3, "r2", t - dt.timedelta(days=9), 0.1), (4, "rmse", t, 4.0), (5, "mse", t, 9.0)])
    run()
    assert {r.metric: r.value for r in ST.current(spark, latest, schema).collect()} == {"r2": 0.5, "rmse": 4.0, "mse": 9.0}
    assert ST.current(spark, scratch_path(spark, "none"), schema).count() == 0


def test_watermark_drops_repeated_and_late_samples(spark):
    t = dt.datetime(2024, 1, 10)
    schema = spark.createDataFrame([], SAMPLE).schema
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("samples", "unique", "ckpt"))
    run = lambda: ST.unique_samples(spark, landing, schema, sink, ckpt, ["id"], delay="1 day")
    land(spark, landing, [(1, "r2", t, 0.5), (1, "r2", t, 0.5), (2, "r2", t + dt.timedelta(hours=2), 0.6)])
    run()
    hour = dt.timedelta(hours=1)
    # delivered again; new; new but out of order within the day; late beyond the day
    land(spark, landing, [(2, "r2", t + 2 * hour, 0.6), (3, "r2", t + 3 * hour, 0.7), (4, "r2", t - 20 * hour, 0.8), (5, "r2", t - 23 * hour - hour * 5, 0.9)])
    run()
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]


def test_requests_are_scored_once_into_two_sinks(spark):
    requests = spark.createDataFrame([(i, float(i)) for i in range(10)], "id long, m double")
    landing, scored, refused, ckpt = (scratch_path(spark, n) for n in ("requests", "scored", "refused", "ckpt"))
    requests.repartition(4, "id").write.parquet(landing)
    check = lambda df: df.withColumn("valid", F.col("m") < 7).withColumn("reasons", F.when(F.col("m") >= 7, "m").otherwise(""))
    score = lambda df: df.select("id", (F.col("m") * 2).alias("prediction"))
    for _ in range(2):
        ST.score_requests(spark, landing, requests.schema, check, score, scored, refused, ckpt, files_per_batch=1)
    assert sorted((r.id, r.prediction) for r in spark.read.parquet(scored).collect()) == [(i, 2.0 * i) for i in range(7)]
    assert sorted((r.id, r.reasons) for r in spark.read.parquet(refused).collect()) == [(7, "m"), (8, "m"), (9, "m")]
