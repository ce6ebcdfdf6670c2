"""Row keys, KNN edges, CSV and page sources on literal values, streams, logs and signatures."""

import datetime as dt
import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from ecoframe.functions.expressions import lossless_key
from ecoframe.operators import knn as KNN
from ecoframe.operators import models as MD
from ecoframe.operators import monitor as MO
from ecoframe.operators import scoring as SC
from ecoframe.operators.quantiles import exact_quantiles, exact_quantiles_of
from ecoframe.schema import RAW_COLUMNS
from ecoframe.session import scratch_path
from ecoframe.sources import files as FS
from ecoframe.streaming import feeds as ST


def local(path):
    return "/" + path.split(":", 1)[-1].lstrip("/")


def test_keys_tell_close_numbers_nulls_and_separators_apart(spark):
    rows = [("a", 1.0001), ("a", 1.0002), ("a", None), (None, 1.0), ("\\N", 1.0), ("a|1.0", 2.0), ("a", 1.0), ("a\\", 1.0)]
    keys = [r[0] for r in spark.createDataFrame(rows, "s string, x double").select(lossless_key(["s", "x"])).collect()]
    assert len(set(keys)) == len(rows)


def test_knn_edges(spark):
    train = spark.createDataFrame([(f"t{i}", float(i), float(i)) for i in range(3)], "id string, x double, y double")
    query = spark.createDataFrame([("q0", 1.0, 0.0), ("q1", None, 0.0)], "id string, x double, y double")
    with pytest.raises(ValueError):
        KNN.knn_regress(train, query, ["x"], "y", "id", "id", k=5)
    got = {r.id: r.prediction for r in KNN.knn_regress(train, query, ["x"], "y", "id", "id", k=3).collect()}
    assert got == {"q0": 1.0, "q1": None}


def test_knn_dense_cluster_and_far_points(spark):
    rnd = random.Random(9)
    points = [(f"t{i:04d}", rnd.random(), rnd.random(), float(i)) for i in range(400)]
    points += [(f"u{i}", 1e6 * (i + 1), -1e6, float(i)) for i in range(4)]
    queries = [("q0", 0.5, 0.5), ("q1", 3e6, 0.0), ("q2", -5e6, 5e6)]
    train = spark.createDataFrame(points, "id string, x double, y double, label double")
    got = {r.id: r.prediction for r in KNN.knn_regress(
        train, spark.createDataFrame(queries, "id string, x double, y double"), ["x", "y"], "label", "id", "id", k=5).collect()}
    for qid, x, y in queries:
        best = sorted((math.hypot(px - x, py - y), t, lab) for t, px, py, lab in points)[:5]
        assert math.isclose(got[qid], sum(b[2] for b in best) / 5)


def test_quantiles_of_extreme_values(spark):
    xs = [float("-inf"), -1e308, -1.0, 5e-324, 0.0, 1.0, 1e308, float("inf"), None, float("nan")]
    df = spark.createDataFrame([(x, 1.0) for x in xs], "x double, one double")
    got = exact_quantiles(df, "x", [i / 7 for i in range(8)], buckets=4)
    assert got == [float("-inf"), -1e308, -1.0, 0.0, 5e-324, 1.0, 1e308, float("inf")]
    assert exact_quantiles_of(df.limit(0), ["x", "one"], [0.5]) == {"x": [None], "one": [None]}


def test_csv_keeps_what_pandas_writes(spark):
    rows = [(" lead", 1), ("trail ", 2), ("", 3), (None, 4), ('a "b", c', 5), ("two\nlines", 6), ("NA", 7), ("\\", 8)]
    df = spark.createDataFrame(rows, "s string, n int")
    path = FS.write_csv(df.coalesce(1), scratch_path(spark, "csv"))
    assert sorted(map(tuple, FS.read_csv(spark, path, schema=df.schema).collect()), key=lambda r: r[1]) == rows
    pandas_file = scratch_path(spark, "pandas-csv")
    os.makedirs(local(pandas_file))
    df.toPandas().to_csv(f"{local(pandas_file)}/part.csv", index=False)
    back = {r.n: r.s for r in FS.read_csv(spark, pandas_file, schema=df.schema).collect()}
    assert back[5] == 'a "b", c' and back[6] == "two\nlines" and back[1] == " lead" and back[8] == "\\"
    with open(f"{local(pandas_file)}/part.csv", "a") as f:
        f.write("x,not a number\n")
    with pytest.raises(Exception):
        FS.read_csv(spark, pandas_file, schema=df.schema).collect()


def land(spark, pages):
    path = scratch_path(spark, "landing")
    for (table, page), text in pages.items():
        folder = f"{local(path)}/tbl={table}/page={page}"
        os.makedirs(folder)
        with open(f"{folder}/part.json", "w") as f:
            f.write(text)
    return path


RECORD = {"Year": 2021, "Mk": "VW", "Cn": "x", "M (kg)": 1500, "Ewltp (g/km)": 100.5, "Ft": "petrol", "Ec (cm3)": 999,
          "Ep (KW)": 50, "Erwltp (g/km)": None, "Fc": 5.1}


def test_pages_with_source_names_many_lines_and_bad_values(spark):
    typed = {**RECORD, "M (kg)": "1500"}
    wrong = {**RECORD, "M (kg)": "heavy"}
    path = land(spark, {("A", 1): json.dumps({"results": [RECORD, typed, wrong]}, indent=2), ("A", 2): json.dumps({"results": [RECORD]}),
                        ("A", 3): "{broken", ("A", 4): json.dumps({"results": [RECORD]}), ("B", 1): "{}", ("C", 2): json.dumps({"results": [RECORD]})})
    pages = FS.read_pages(spark, path)
    rows = FS.flatten_pages(pages).collect()
    assert sorted((r.tbl, r.page) for r in rows) == [("A", 1), ("A", 1), ("A", 2)]
    assert {tuple(r[c] for c in RAW_COLUMNS) for r in rows} == {(2021, "VW", "x", 1500.0, 100.5, "petrol", 999.0, 50.0, None, 5.1)}
    assert [(r.page, r.bad_fields) for r in FS.flatten_pages(pages, with_bad=True).collect()] == [(1, ["mass_kg"])]
    sink, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "sink-ckpt")
    for _ in range(2):
        ST.ingest_pages(spark, path, sink, checkpoint, files_per_batch=2)
    assert sorted((r.tbl, r.page) for r in ST.ingested(spark, sink).collect()) == [("A", 1), ("A", 1), ("A", 2)]


def test_pages_are_joined_one_at_a_time(spark):
    rows = [(2021 + i % 3 if i % 10 else None, f'"m{i}"\n', float(i) if i % 4 else None) for i in range(700)]
    df = spark.createDataFrame(rows, "year int, mk string, fc double")
    path = FS.write_pages(df, scratch_path(spark, "written"), order=["mk"], page_size=64, source_names=True)
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    pages = [json.loads(r.value)["results"] for r in text.collect()]
    assert len(pages) == sum(-(-n // 64) for n in (70, 210, 210, 210)) and max(map(len, pages)) == 64
    assert sorted(str((r.get("Year"), r["Mk"], r.get("Fc"))) for p in pages for r in p) == sorted(map(str, rows))
    assert all([r["Mk"] for r in p] == sorted(r["Mk"] for r in p) for p in pages)
    held = []
    batch = FS.pa.RecordBatch.from_pydict({"tbl": [1] * 6, "page": [1, 1, 2, 2, 3, 3], "_first": [True, False] * 3, "_record": list("abcdef")})

    def watched():
        for i in range(0, 6, 2):
            yield batch.slice(i, 2)
            held.append(i)

    out = FS._join_records(watched())
    assert next(out).to_pylist() == [{"tbl": 1, "page": 1, "value": '{"results":[a,b]}'}] and held == [0]  # not after all were read
    assert [r["value"] for b in out for r in b.to_pylist()] == ['{"results":[c,d]}', '{"results":[e,f]}']


def test_metric_stream_whatever_the_file_order(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, "r2" if i % 2 else "rmse", t0 + dt.timedelta(seconds=i), float(i % 3)) for i in range(24)]
    schema = "id long, metric string, ts timestamp, value double"
    landing = scratch_path(spark, "samples")
    for at, part in enumerate([rows[16:], rows[8:16], rows[:8]]):  # the newest file lands first
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
    hist, latest, checkpoint = (scratch_path(spark, n) for n in ("hist", "latest", "hist-ckpt"))
    types = spark.createDataFrame([], schema).schema
    for _ in range(2):
        ST.metric_history(spark, landing, types, hist, latest, checkpoint, tie="id", files_per_batch=1)
    first = {}
    for r in rows:
        if r[3]:
            first.setdefault((r[1], r[3]), r[0])
    assert {(r.metric, r.value): r.id for r in ST.current(spark, hist, types).collect()} == first
    assert {r.metric: r.id for r in ST.current(spark, latest, types).collect()} == {"r2": 23, "rmse": 22}


def test_run_log_manifest_and_quarantine(spark):
    t0 = dt.datetime(2024, 1, 1)
    schema = "run_id string, run_name string, start_time timestamp, params map<string,string>, metrics map<string,double>, tags map<string,string>"
    run = lambda i, name: (f"r{i}", name, t0 + dt.timedelta(days=i), {"depth": "30"}, {"r2": 0.5}, {"stage": "test"})
    path = scratch_path(spark, "runs")
    MO.log_runs(spark.createDataFrame([run(1, "rf"), run(2, "rf"), run(3, "ols")], schema), path)
    log = MO.log_runs(spark.createDataFrame([run(4, "rf"), run(5, "new")], schema), path)
    assert {r.run_id: r.version for r in log.collect()} == {"r1": 1, "r2": 2, "r3": 1, "r4": 3, "r5": 1}
    assert log.first().params["depth"] == "30"
    manifest = scratch_path(spark, "manifest")
    entry = lambda k, d: (k, MO.stamped_path("/out", k, t0 + dt.timedelta(days=d)), t0 + dt.timedelta(days=d))
    MO.write_manifest(spark.createDataFrame([entry("a", 1), entry("b", 1)], MO.MANIFEST), manifest)
    now = {r.artifact: r.path for r in MO.write_manifest(spark.createDataFrame([entry("a", 2)], MO.MANIFEST), manifest).collect()}
    assert now == {"a": "/out/a_20240103_000000", "b": "/out/b_20240102_000000"}
    req = spark.createDataFrame([(1, 10.0, "x"), (2, 99.0, "y"), (3, None, "x")], "id int, m double, c string")
    checked = SC.check_requests(req, {"m": (0, 50)}, {"c": spark.createDataFrame([("x",)], "c string")})
    valid, refused = SC.write_checked(checked, scratch_path(spark, "checked"))
    assert [r.id for r in valid.collect()] == [1]
    assert {r.id: r.reasons for r in refused.collect()} == {2: ["m", "c"], 3: ["m"]}


def test_model_signature_is_kept_beside_the_model(spark):
    df = spark.createDataFrame([(float(i), "ab"[i % 2], 2.0 * i) for i in range(20)], "x double, c string, y double")
    model = MD.fit_model(df, "ols", ["x"], ["c"], "y")
    path = MD.save_model(model, scratch_path(spark, "signed"), MD.model_signature(model, df, ["x", "c"]))
    signature = MD.load_signature(spark, path)
    assert signature["inputs"] == [{"name": "x", "type": "double"}, {"name": "c", "type": "string"}]
    assert signature["features"][0] == "x" and MD.load_model(path).transform(df).count() == 20
