"""Sources, sinks, run/metric history, models, and the driver contract."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ecoframe.operators import evaluate as EV
from ecoframe.operators import models as MD
from ecoframe.operators import monitor as MO
from ecoframe.schema import VEHICLE_SCHEMA, missing_columns, require_columns
from ecoframe.session import scratch_path
from ecoframe.sources import files as FS


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "year int")
    assert missing_columns(df.columns, ["year", "Mk"]) == ["Mk"]
    with pytest.raises(ValueError):
        require_columns(df, ["Mk"])


def test_csv_sink_refuses_empty(spark):
    empty = spark.createDataFrame([], "a int")
    assert FS.write_csv(empty, scratch_path(spark, "empty")) is None


def test_csv_keeps_na_strings(spark):
    df = spark.createDataFrame([("NA", 1.0), ("null", 2.0)], "cn string, x double")
    path = FS.write_csv(df, scratch_path(spark, "na"))
    back = FS.read_csv(spark, path, schema=df.schema)
    assert sorted(r.cn for r in back.collect()) == ["NA", "null"]


def test_json_pages_stop_rule(spark):
    path = scratch_path(spark, "pages")
    local = path[len("file:"):].replace("//", "/") if path.startswith("file:") else path
    good = '{"results": [{"year": 2021, "mk": "VW", "cn": "x", "mass_kg": 1.0, "ewltp_g_km": 2.0, "ft": "petrol", ' \
           '"ec_cm3": 1.0, "ep_kw": 1.0, "erwltp_g_km": 0.0, "fc": 5.0}]}'
    layout = {("A", 1): good, ("A", 2): "{broken", ("A", 3): good,
              ("B", 1): good, ("B", 2): '{"results": []}', ("C", 1): good, ("C", 3): good}
    for (t, p), text in layout.items():
        d = os.path.join(local, f"tbl={t}", f"page={p}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "part-0.json"), "w") as fh:
            fh.write(text + "\n")
    pages = FS.read_pages(spark, path)
    kept = FS.pages_until_gap(pages, "tbl", "page", FS.page_is_bad())
    got = sorted((r.tbl, r.page) for r in kept.select("tbl", "page").collect())
    # A stops at the broken page 2, B at the empty page 2, C at the missing page 2
    assert got == [("A", 1), ("B", 1), ("C", 1)]
    assert FS.flatten_pages(kept, VEHICLE_SCHEMA).count() == 3


def test_metric_history(spark):
    t = [dt.datetime(2024, 1, 1, 0, 0, s) for s in range(6)]
    hist = spark.createDataFrame([("r2", t[0], 0.5, 0)], "metric string, ts timestamp, value double, id int")
    batch = spark.createDataFrame(
        [("r2", t[1], 0.0, 1), ("r2", t[2], 0.5, 2), ("r2", t[3], 0.7, 3), ("r2", t[4], 0.7, 4),
         ("rmse", t[5], 3.0, 5)], "metric string, ts timestamp, value double, id int")
    new = MO.append_new_values(hist, batch, tie="id")
    assert sorted((r.metric, r.value, r.id) for r in new.collect()) == [("r2", 0.7, 3), ("rmse", 3.0, 5)]
    latest = {r.metric: r.latest_value for r in MO.metric_latest(batch, tie="id").collect()}
    assert latest == {"r2": 0.7, "rmse": 3.0}


def test_runs(spark):
    t = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("a", "rf", t, 1.0), ("b", "rf", t + dt.timedelta(days=1), 2.0), ("c", "ols", t, 3.0)],
        "run_id string, run_name string, start_time timestamp, rmse double")
    assert MO.latest_run(runs).first().run_id == "b"
    per = {r.run_name: r.run_id for r in MO.latest_per_name(runs).collect()}
    assert per == {"rf": "b", "ols": "c"}
    ver = {r.run_id: r.version for r in MO.run_versions(runs).collect()}
    assert ver == {"a": 1, "b": 2, "c": 1}


def test_metrics_and_describe(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (5.0, 5.5)], "y_true double, y_pred double")
    m = EV.regression_metrics(df).first()
    assert abs(m.mse - 0.375) < 1e-12 and abs(m.rmse - 0.375 ** 0.5) < 1e-12
    assert abs(m.r2 - (1 - 1.5 / 10.0)) < 1e-12
    d = {(r.column, r.statistic): r.value for r in EV.describe(df, ["y_true"]).collect()}
    assert d[("y_true", "25%")] == 1.75  # interpolated, as pandas
    path = FS.write_metrics_json(m and EV.regression_metrics(df), scratch_path(spark, "metrics"))
    assert spark.read.json(path).count() == 1


def test_models_beat_mean_and_persist(spark):
    from ecoframe.plans import modeling as M
    from ecoframe.schema import BASE_FEATURES, DASHBOARD_FEATURES, TARGET
    train, test = M.train_test(spark, "/root/testdata/sf0.001")
    ols = MD.fit_model(train, "ols", DASHBOARD_FEATURES, [], TARGET, scale=False)
    r2 = EV.regression_metrics(MD.predict(ols, test, ["row_key"], TARGET)).first().r2
    assert r2 > 0.5
    rf = MD.fit_model(train, "rf_final", BASE_FEATURES, ["ft", "mk"], TARGET, numTrees=10, maxDepth=6)
    path = MD.save_model(rf, scratch_path(spark, "rf"))
    loaded = MD.load_model(path)
    r2rf = EV.regression_metrics(MD.predict(loaded, test, ["row_key"], TARGET)).first().r2
    assert r2rf > 0
    names = MD.feature_names(rf, train)
    assert names[:5] == BASE_FEATURES and any(n.endswith("Diesel") for n in names)


def test_entry_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.columns == ["mk", "ft", "mean_ewltp", "n"]
    assert out.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
