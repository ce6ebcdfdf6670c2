"""Registered queries (one per operator of the inventory) and their oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame``.  Column names are the same in
the Spark result and in the oracle SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ecoframe.operators import artifacts as AR
from ecoframe.operators import clean, outliers
from ecoframe.plans import oracle as O
from ecoframe.plans import vehicles as V
from ecoframe.schema import OUTLIER_GROUP, PROCESSED_COLUMNS, RAW_COLUMNS
from ecoframe.session import materialize, scratch_path

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


RAW = ", ".join(RAW_COLUMNS)
PROC = ", ".join(PROCESSED_COLUMNS)


# --- 2.2 / 2.5: projection, not-null, distinct, dedup --------------------------------

@register("src", O.stage_sql("src", f"SELECT {RAW} FROM src"))
def q_src(spark, sf):
    return V.src(spark, sf)


@register("dedup", O.stage_sql("dedup", f"SELECT {RAW} FROM dedup"))
def q_dedup(spark, sf):
    return V.dedup(spark, sf)


# --- 2.2 / 2.3: fuel and brand normalisation ------------------------------------------

@register("fuel_clean", O.stage_sql("fuel", f"SELECT {RAW} FROM fuel"))
def q_fuel_clean(spark, sf):
    return V.fuel(spark, sf).select(*RAW_COLUMNS)


@register("fuel_clean_v1", O.stage_sql("fuel", f"SELECT {RAW} FROM fuel", rule="v1"))
def q_fuel_clean_v1(spark, sf):
    return V.fuel(spark, sf, "v1").select(*RAW_COLUMNS)


@register("brand_clean", O.stage_sql("brand", f"SELECT {RAW} FROM brand"))
def q_brand_clean(spark, sf):
    return V.brand(spark, sf).select(*RAW_COLUMNS)


@register("brand_clean_v1", O.stage_sql("brand", f"SELECT {RAW} FROM brand", rule="v1"))
def q_brand_clean_v1(spark, sf):
    return V.brand(spark, sf, "v1").select(*RAW_COLUMNS)


@register("brand_counts", O.stage_sql("brand", "SELECT mk, count(*) AS n FROM brand GROUP BY mk"))
def q_brand_counts(spark, sf):
    return clean.value_counts(V.brand(spark, sf), "mk", "n")


@register("rare_brand", O.stage_sql("rare", f"SELECT {RAW} FROM rare"))
def q_rare_brand(spark, sf):
    return V.rare(spark, sf).select(*RAW_COLUMNS)


# --- 2.5 / 2.6: group statistics and outliers -----------------------------------------

_G = ", ".join(OUTLIER_GROUP)


@register("group_mean", O.stage_sql(
    "rare", f"SELECT {_G}, avg(ewltp_g_km) AS ewltp_g_km_mean FROM rare GROUP BY {_G}"))
def q_group_mean(spark, sf):
    return outliers.group_mean(V.cleaned(spark, sf), "ewltp_g_km", OUTLIER_GROUP)


@register("group_mean_join", O.stage_sql(
    "rare", f"SELECT r.*, m.ewltp_g_km_mean FROM rare r LEFT JOIN "
            f"(SELECT {_G}, avg(ewltp_g_km) AS ewltp_g_km_mean FROM rare GROUP BY {_G}) m "
            f"ON r.cn = m.cn AND r.ft = m.ft AND r.year = m.year"))
def q_group_mean_join(spark, sf):
    return outliers.attach_group_mean(V.cleaned(spark, sf), "ewltp_g_km", OUTLIER_GROUP)


def _one_pass_sql():
    pairs = O.ctes("rare") + [
        (n, s) for n, s in O.outlier_pass_ctes("rare", "p1", "ewltp_g_km")[:3]]
    return O.with_ctes(pairs, "SELECT p1_j.* FROM p1_j, p1_s WHERE diff_ewltp_g_km <= seuil")


@register("outlier_pass", _one_pass_sql())
def q_outlier_pass(spark, sf):
    kept, _ = outliers.outlier_pass(V.cleaned(spark, sf), "ewltp_g_km", OUTLIER_GROUP)
    return kept


@register("outlier_chain", O.stage_sql("chain", f"SELECT {RAW} FROM p6"))
def q_outlier_chain(spark, sf):
    out, _ = V.chain(spark, sf)
    return out


@register("outlier_thresholds", O.thresholds_sql())
def q_outlier_thresholds(spark, sf):
    _, reports = V.chain(spark, sf)
    return outliers.reports_frame(spark, reports)


@register("fuel_final", O.stage_sql("final", f"SELECT {PROC} FROM final"))
def q_fuel_final(spark, sf):
    return V.final(spark, sf)


@register("fuel_final_v1", O.stage_sql("final", f"SELECT {PROC} FROM final", rule="v1"))
def q_fuel_final_v1(spark, sf):
    return V.final(spark, sf, "v1")


def _stage_counts_sql():
    names = ["src", "dedup", "fuel", "brand", "rare", "p1", "p2", "p3", "p4", "p5", "p6", "final"]
    sel = "\nUNION ALL\n".join(f"SELECT {O.q(n)} AS stage, count(*) AS n_rows FROM {n}" for n in names)
    return O.stage_sql("final", sel)


@register("stage_counts", _stage_counts_sql())
def q_stage_counts(spark, sf):
    """Counts of the written stages, and of src and dedup, which are not written."""
    _, reports = V.chain(spark, sf)
    counts = {**V.raw_counts(spark, sf), "fuel": V.fuel(spark, sf).count(), "brand": V.brand(spark, sf).count(), "rare": V.cleaned(spark, sf).count()}
    counts |= {f"p{i}": r.rows_after for i, r in enumerate(reports, 1)}
    counts["final"] = V.final(spark, sf).count()
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows long")


@register("mean_co2", O.stage_sql(
    "final", "SELECT mk, ft, avg(ewltp_g_km) AS mean_ewltp, count(*) AS n FROM final GROUP BY mk, ft"))
def q_mean_co2(spark, sf):
    return V.mean_co2_by_brand_fuel(spark, sf)


# =====================================================================================
# 2.4 Encoding, splits, scaling
# =====================================================================================

from pyspark.ml.functions import vector_to_array  # noqa: E402

from ecoframe.operators import evaluate as EV  # noqa: E402
from ecoframe.operators import features as FE  # noqa: E402
from ecoframe.operators import forest as FO  # noqa: E402
from ecoframe.operators import walk as WK  # noqa: E402
from ecoframe.operators import knn as KNN  # noqa: E402
from ecoframe.operators import models as MD  # noqa: E402
from ecoframe.operators import monitor as MO  # noqa: E402
from ecoframe.operators import scoring as SC  # noqa: E402
from ecoframe.plans import modeling as M  # noqa: E402
from ecoframe.schema import (  # noqa: E402
    API_RANGES, BASE_FEATURES, DASHBOARD_FEATURES, DASHBOARD_RANGES, ERROR_REVIEW_THRESHOLD, FUEL_DROP_AFTER_MAP,
    FUEL_DROP_EARLY, KNN_K, NUMERIC_COLUMNS, TARGET, rules,
)
from ecoframe.sources.fixtures import FIXTURE_FUELS, FIXTURE_MAKES  # noqa: E402

KEY_SQL = "concat_ws('|', " + ", ".join(
    rf"coalesce(replace(replace(CAST({c} AS VARCHAR), '\', '\\'), '|', '\|'), '\N')"
    for c in ["mk", "cn", "year", "ft", *NUMERIC_COLUMNS]) + ")"
CUT = 858993459  # floor(0.2 * 2^32)
SPLIT_CTE = (f"SELECT *, {KEY_SQL} AS row_key, CASE WHEN ('0x' || substr(md5('42:' || {KEY_SQL}), 1, 8))::BIGINT "
             f"< {CUT} THEN 'test' ELSE 'train' END AS split FROM final")
FLAGS_SQL = "CAST(ft = 'Diesel' AS DOUBLE) AS Ft_Diesel, CAST(ft = 'Essence' AS DOUBLE) AS Ft_Essence"


def split_sql(select: str, extra: list | None = None) -> str:
    pairs = O.ctes("final") + [("sp", SPLIT_CTE),
                               ("tr", f"SELECT *, {FLAGS_SQL} FROM sp WHERE split = 'train'"),
                               ("te", f"SELECT *, {FLAGS_SQL} FROM sp WHERE split = 'test'")] + (extra or [])
    return O.with_ctes(pairs, select)


@register("categories", O.stage_sql("final", "SELECT DISTINCT mk FROM final WHERE mk IS NOT NULL"))
def q_categories(spark, sf):
    return FE.categories(V.final(spark, sf), "mk")


# Categories that the rules can produce from the fixture's spellings: the columns of the oracle alone.  The queries
# take theirs from the trained table; `feature_names` compares those names with SQL.
FUEL_CATEGORIES = sorted({rules().fuel_map.get(f.lower(), f.lower()) for f in FIXTURE_FUELS}
                         - {*FUEL_DROP_EARLY, *FUEL_DROP_AFTER_MAP, *rules().fuel_drop_final})
BRAND_CATEGORIES = sorted({rules().brand_map.get(m, m) for m in (
    next((b for b in rules().brands if b in make.upper()), make.upper()) for make in FIXTURE_MAKES)} - {*rules().deny})


def _flags_sql(col: str, prefix: str, cats: list) -> str:
    return ", ".join(f'coalesce(CAST({col} = {O.q(c)} AS BIGINT), 0) AS "{prefix}_{c}"' for c in cats)


def _trained(spark, sf, col):
    """The trained category table of a column."""
    return FE.categories(V.final(spark, sf), col)


def _trained_list(spark, sf, col):
    return V._once(spark, sf, f"categories-{col}", "v2", lambda: FE.category_list(_trained(spark, sf, col), col))


@register("onehot_fuel", O.stage_sql(
    "final", f"SELECT {', '.join(c for c in PROCESSED_COLUMNS if c != 'ft')}, {_flags_sql('ft', 'Ft', FUEL_CATEGORIES)} FROM final"))
def q_onehot_fuel(spark, sf):
    return FE.onehot_wide(V.final(spark, sf), "ft", "Ft", _trained_list(spark, sf, "ft"))


def _onehot_sql(more: str = "") -> str:
    return O.stage_sql("final", f"SELECT {', '.join(c for c in PROCESSED_COLUMNS if c not in ('ft', 'mk'))}, "
                                f"{_flags_sql('ft', 'Ft', FUEL_CATEGORIES)}, {_flags_sql('mk', 'Mk', BRAND_CATEGORIES)}{more} FROM final")


@register("onehot_brand", _onehot_sql())
def q_onehot_brand(spark, sf):
    wide = FE.onehot_wide(V.final(spark, sf), "ft", "Ft", _trained_list(spark, sf, "ft"))
    return FE.onehot_wide(wide, "mk", "Mk", _trained_list(spark, sf, "mk"))


@register("onehot_vector", _onehot_sql(", 0.0::DOUBLE AS unseen"))
def q_onehot_vector(spark, sf):
    """The vector encoding with every slot under its name from the feature metadata; ``unseen`` adds up the
    slots that are kept for unknown and null values."""
    f = V.final(spark, sf)
    model = FE.onehot_vector_model(["ft", "mk"], BASE_FEATURES).fit(f)
    names = MD.feature_names(model, f, "features")
    values = model.transform(f).withColumn("_v", vector_to_array("features"))
    prefix = {"ft_vec_": "Ft_", "mk_vec_": "Mk_"}
    flags, unseen = [], F.lit(0.0)
    for slot, name in enumerate(names[len(BASE_FEATURES):], len(BASE_FEATURES)):
        column, category = name[:7], name[7:]
        if category in _trained_list(spark, sf, column[:2]):
            flags.append(F.get("_v", slot).cast("long").alias(prefix[column] + category))
        else:
            unseen = unseen + F.get("_v", slot)
    numbers = [F.get("_v", slot).alias(c) for slot, c in enumerate(BASE_FEATURES)]
    return values.select(*[c for c in PROCESSED_COLUMNS if c not in ("ft", "mk", *BASE_FEATURES)], *numbers, *flags, unseen.alias("unseen"))


@register("feature_names", O.stage_sql(
    "final", "SELECT 'Ft_' || ft AS feature, ft AS category FROM (SELECT DISTINCT ft FROM final WHERE ft IS NOT NULL) "
             "UNION ALL SELECT 'Mk_' || mk, mk FROM (SELECT DISTINCT mk FROM final WHERE mk IS NOT NULL)"))
def q_feature_names(spark, sf):
    f = V.final(spark, sf)
    names = (FE.categories(f, "ft").select(F.concat(F.lit("Ft_"), "ft").alias("feature"))
             .unionByName(FE.categories(f, "mk").select(F.concat(F.lit("Mk_"), "mk").alias("feature"))))
    # categories recovered from the names by stripping the prefix
    return names.withColumn("category", F.regexp_replace("feature", "^(Ft|Mk)_", ""))


@register("split_counts", split_sql("SELECT split, count(*) AS n_rows FROM sp GROUP BY split"))
def q_split_counts(spark, sf):
    return M.split_table(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("split_exact", O.with_ctes(O.ctes("final") + [
    ("k", f"SELECT *, {KEY_SQL} AS row_key, ('0x' || substr(md5('42:' || {KEY_SQL}), 1, 8))::BIGINT AS _b "
          f"FROM final"),
    ("r", "SELECT *, row_number() OVER (ORDER BY _b, row_key) AS _rn, count(*) OVER () AS _n FROM k")],
    f"SELECT {PROC}, row_key, CASE WHEN _rn <= ceil(0.2 * _n) THEN 'test' ELSE 'train' END AS split FROM r"))
def q_split_exact(spark, sf):
    f = V.final(spark, sf).withColumn("row_key", FE.vehicle_key())
    return FE.exact_split(f, F.col("row_key"))


@register("split_random", O.stage_sql("final", f"SELECT {PROC} FROM final"))
def q_split_random(spark, sf):
    """Both parts of an unseeded split together: every row once, whatever its side."""
    train, test = FE.random_split(V.final(spark, sf))
    return train.unionByName(test)


@register("split_random_share", O.stage_sql("final", "SELECT count(*) AS n_rows, 0::BIGINT AS in_both, true AS share_holds FROM final"))
def q_split_random_share(spark, sf):
    """The parts of an unseeded split: together all rows, none in both, the test share within eight standard
    deviations of a fifth."""
    f = V.final(spark, sf).withColumn("_id", F.monotonically_increasing_id())
    train, test = FE.random_split(f)
    sides = train.select("_id", F.lit(0).alias("side")).unionByName(test.select("_id", F.lit(1).alias("side")))
    rows = sides.groupBy("_id").agg(F.count_distinct("side").alias("sides"), F.max("side").alias("side"))
    share, n = F.avg("side"), F.count(F.lit(1))
    return rows.agg(n.alias("n_rows"), F.sum((F.col("sides") > 1).cast("long")).alias("in_both"),
                    (F.abs(share - 0.2) <= 8 * F.sqrt(F.lit(0.16) / n)).alias("share_holds"))


def _scaler_fit_sql():
    parts = [f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, "
             f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS std FROM tr"
             for c in BASE_FEATURES]
    return split_sql(" UNION ALL ".join(parts))


@register("scaler_fit", _scaler_fit_sql())
def q_scaler_fit(spark, sf):
    train, _ = M.train_test(spark, sf)
    aggs = []
    for c in BASE_FEATURES:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"{c}__m"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{c}__s")]
    wide = train.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__m`, `{c}__s`" for c in BASE_FEATURES)
    long = wide.selectExpr(f"stack({len(BASE_FEATURES)}, {stack}) AS (feature, mean, std)")
    return long.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _scaler_apply_sql():
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}"
                      for c in BASE_FEATURES)
    cols = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in BASE_FEATURES)
    return split_sql(f"SELECT row_key, split, {cols} FROM sp, st", [("st", f"SELECT {stats} FROM tr")])


@register("scaler_apply", _scaler_apply_sql())
def q_scaler_apply(spark, sf):
    s = M.split_table(spark, sf)
    stats = FE.scaler_stats(s.filter(F.col("split") == "train"), BASE_FEATURES)
    scaled = FE.scaler_apply(s.select("row_key", "split", *BASE_FEATURES), stats)
    return scaled.select("row_key", "split", *[F.round(c, 6).alias(c) for c in BASE_FEATURES])


# =====================================================================================
# 2.5 / 2.7: univariate least squares, error table, metrics, describe, profile
# =====================================================================================

UNI_X = "erwltp_g_km"
_UNI_CTE = [("co", f"SELECT regr_slope({TARGET}, {UNI_X}) AS slope, regr_intercept({TARGET}, {UNI_X}) AS intercept "
                   f"FROM tr"),
            ("et", f"SELECT row_key, {TARGET} AS y_true, intercept + slope * {UNI_X} AS y_pred, "
                   f"abs({TARGET} - (intercept + slope * {UNI_X})) AS error FROM te, co")]


def _univariate(spark, sf):
    train, test = M.train_test(spark, sf)
    row = train.agg(F.regr_slope(TARGET, UNI_X).alias("slope"), F.regr_intercept(TARGET, UNI_X).alias("b")).first()
    pred = test.withColumn("y_pred", F.lit(row["b"]) + F.lit(row["slope"]) * F.col(UNI_X))
    return row, EV.error_table(pred, TARGET, "y_pred", keep=["row_key"])


def _r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("ols_univariate", split_sql("SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM co",
                                      _UNI_CTE))
def q_ols_univariate(spark, sf):
    train, _ = M.train_test(spark, sf)
    return train.agg(F.round(F.regr_slope(TARGET, UNI_X), 6).alias("slope"),
                     F.round(F.regr_intercept(TARGET, UNI_X), 6).alias("intercept"))


@register("error_table", split_sql("SELECT row_key, y_true, round(y_pred, 6) AS y_pred, round(error, 6) AS error "
                                   "FROM et", _UNI_CTE))
def q_error_table(spark, sf):
    _, et = _univariate(spark, sf)
    return _r6(et, ["y_pred", "error"])


@register("error_outliers", split_sql(
    f"SELECT row_key, y_true, round(y_pred, 6) AS y_pred, round(error, 6) AS error FROM et "
    f"WHERE error > {ERROR_REVIEW_THRESHOLD}", _UNI_CTE))
def q_error_outliers(spark, sf):
    _, et = _univariate(spark, sf)
    return _r6(EV.large_errors(et, ERROR_REVIEW_THRESHOLD), ["y_pred", "error"])


@register("regression_metrics", split_sql(
    "SELECT count(*) AS n, round(avg((y_true - y_pred) * (y_true - y_pred)), 6) AS mse, "
    "round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse, "
    "round(1 - sum((y_true - y_pred) * (y_true - y_pred)) / "
    "sum((y_true - (SELECT avg(y_true) FROM et)) * (y_true - (SELECT avg(y_true) FROM et))), 6) AS r2 FROM et",
    _UNI_CTE))
def q_regression_metrics(spark, sf):
    _, et = _univariate(spark, sf)
    return _r6(EV.regression_metrics(et), ["mse", "rmse", "r2"])


def _describe_sql():
    parts = []
    for c in ("y_true", "y_pred", "error"):
        src = f"(SELECT * FROM et WHERE error > {ERROR_REVIEW_THRESHOLD})"
        for stat, expr in [("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({c})"),
                           ("std", f"stddev_samp({c})"), ("min", f"min({c})"),
                           ("25%", f"quantile_cont({c}, 0.25)"), ("50%", f"quantile_cont({c}, 0.5)"),
                           ("75%", f"quantile_cont({c}, 0.75)"), ("max", f"max({c})")]:
            parts.append(f"SELECT '{c}' AS column, '{stat}' AS statistic, round({expr}, 6) AS value FROM {src}")
    return split_sql(" UNION ALL ".join(parts), _UNI_CTE)


@register("describe", _describe_sql())
def q_describe(spark, sf):
    _, et = _univariate(spark, sf)
    d = EV.describe(EV.large_errors(et, ERROR_REVIEW_THRESHOLD), ["y_true", "y_pred", "error"])
    return d.withColumn("value", F.round("value", 6))


_PROFILE_TYPES = {"mk": "string", "cn": "string", "mass_kg": "double", "ewltp_g_km": "double", "ft": "string",
                  "ec_cm3": "double", "ep_kw": "double", "erwltp_g_km": "double", "year": "int", "fc": "double"}


@register("profile", O.stage_sql("final", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, "
    f"count(*) AS n_rows FROM final" for c, t in _PROFILE_TYPES.items())))
def q_profile(spark, sf):
    return EV.profile(V.final(spark, sf), PROCESSED_COLUMNS)


# =====================================================================================
# 2.7 Models and scoring
# =====================================================================================

def _knn_sql():
    # brute force with a streaming top-k aggregate per query row (min_by with n)
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in DASHBOARD_FEATURES)
    return split_sql(
        f"SELECT row_key, list_avg(min_by(y, (d, tk), 5)) AS prediction FROM (SELECT a._qi, a.row_key, "
        f"b.ewltp_g_km AS y, sqrt({d2}) AS d, b.row_key AS tk FROM (SELECT row_number() OVER () AS _qi, * "
        f"FROM te) a, tr b) GROUP BY _qi, row_key")


@register("knn", _knn_sql())
def q_knn(spark, sf):
    def make():
        train, test = M.train_test(spark, sf)
        return materialize(KNN.knn_regress(train, test, DASHBOARD_FEATURES, TARGET, "row_key", "row_key", k=KNN_K), "knn")

    return V._once(spark, sf, "knn", "v2", make)


def _spread(rows):
    """Rows that walk a forest: dealt over the cores by their number."""
    return MD.spread(rows, cores=rows.sparkSession.sparkContext.defaultParallelism)


def _model(spark, sf, name, features, categorical):
    """One model, fitted once per session and input."""
    def make():
        train, _ = M.train_test(spark, sf)
        return MD.fit_model(train, name, features, categorical, TARGET, scale=False)

    return V._once(spark, sf, f"model-{name}-{len(features)}-{','.join(categorical)}", "v2", make)


def _predictions(spark, sf, name, features, categorical):
    """Test predictions of one model, written once per session and input.  The dashboard forest is used for nothing else, so
    it is not kept: the driver holds one forest of a comparison at a time."""
    def make():
        train, test = M.train_test(spark, sf)
        model = MD.fit_model(train, name, features, categorical, TARGET, scale=False) if name == "rf_default" else \
            _model(spark, sf, name, features, categorical)
        rows = _spread(test) if name.startswith("rf") else test
        return materialize(MD.predict(model, rows, ["row_key"], TARGET), f"predictions-{name}")

    return V._once(spark, sf, f"predictions-{name}-{','.join(categorical)}", "v2", make)


def _bounds(pred):
    """One row: a prediction per test row, and better than the mean."""
    m = EV.regression_metrics(pred)
    return m.select("n", (F.col("r2") > 0).alias("beats_mean"), (F.col("r2") > 0.5).alias("explains_half"))


_BOUNDS_SQL = split_sql("SELECT count(*) AS n, true AS beats_mean, true AS explains_half FROM te")


@register("ols", split_sql("SELECT row_key, ewltp_g_km AS y_true, true AS finite FROM te"))
def q_ols(spark, sf):
    """Least squares on the dashboard features: a finite prediction for every test row."""
    pred = _predictions(spark, sf, "ols", DASHBOARD_FEATURES, [])
    return pred.select("row_key", "y_true", (F.abs("y_pred") < 1e6).alias("finite"))


def _orthogonal(spark, sf, categorical):
    """Per feature of a least-squares model and the intercept: are the training residuals orthogonal to it?"""
    train, _ = M.train_test(spark, sf)
    names = ["intercept", *DASHBOARD_FEATURES]
    res = _model(spark, sf, "ols", DASHBOARD_FEATURES, categorical).transform(train)
    res = res.withColumn("_r", F.col(TARGET) - F.col("prediction")).withColumn("intercept", F.lit(1.0))
    for c in categorical:
        values = _trained_list(spark, sf, c)
        res = res.select("*", *[(F.col(c) == v).cast("double").alias(f"{c}_{v}") for v in values])
        names += [f"{c}_{v}" for v in values]
    product = [F.col("_r") * F.col(f"`{c}`") for c in names]
    row = res.agg(*[(F.abs(F.sum(p)) <= 1e-6 * F.sum(F.abs(p)) + 1e-6).alias(f"f{i}") for i, p in enumerate(product)])
    stack = ", ".join(f"'{c}', f{i}" for i, c in enumerate(names))
    return row.selectExpr(f"stack({len(names)}, {stack}) AS (feature, orthogonal)")


_RESIDUAL_NAMES = ", ".join(O.q(f) for f in ["intercept", *DASHBOARD_FEATURES])


@register("ols_residuals", split_sql(f"SELECT f AS feature, true AS orthogonal FROM (SELECT unnest([{_RESIDUAL_NAMES}]) AS f)"))
def q_ols_residuals(spark, sf):
    """The defining property of least squares: training residuals are orthogonal to every feature."""
    return _orthogonal(spark, sf, [])


@register("ols_brand_residuals", split_sql(
    f"SELECT f AS feature, true AS orthogonal FROM (SELECT unnest([{_RESIDUAL_NAMES}]) AS f UNION ALL SELECT DISTINCT 'mk_' || mk FROM final)"))
def q_ols_brand_residuals(spark, sf):
    """The same with brand flags, which depend on each other and on the intercept."""
    return _orthogonal(spark, sf, ["mk"])


@register("ols_brand", split_sql(f"SELECT mk, count(*) AS n, round(sum({TARGET}), 4) AS fitted FROM tr GROUP BY mk"))
def q_ols_brand(spark, sf):
    """Least squares with brand flags, a full set of dependent columns: the fitted values of a brand's training rows add up
    to their labels."""
    train, _ = M.train_test(spark, sf)
    model = _model(spark, sf, "ols", DASHBOARD_FEATURES, ["mk"])
    return model.transform(train).groupBy("mk").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("prediction"), 4).alias("fitted"))


@register("rf_final")
def q_rf_final(spark, sf):
    return _predictions(spark, sf, "rf_final", BASE_FEATURES, ["ft", "mk"])


@register("rf_final_bounds", _BOUNDS_SQL)
def q_rf_final_bounds(spark, sf):
    return _bounds(q_rf_final(spark, sf))


@register("rf_default")
def q_rf_default(spark, sf):
    return _predictions(spark, sf, "rf_default", DASHBOARD_FEATURES, [])


@register("rf_default_bounds", _BOUNDS_SQL)
def q_rf_default_bounds(spark, sf):
    return _bounds(q_rf_default(spark, sf))


@register("rf_final_nodes", split_sql("SELECT CAST(t AS INTEGER) AS tree, true AS splits_hold, (SELECT count(*) FROM tr) AS root_rows "
                                      "FROM range(0, 100) AS g(t)"))
def q_rf_final_nodes(spark, sf):
    """Per tree of the final forest: no split of fewer than nine rows, and the rows at its root."""
    nodes = FO.node_table(spark, _forest_path(spark, sf))
    split = F.col("left") != FO.LEAF
    return nodes.groupBy("tree").agg((F.min(F.when(split, F.col("n_rows"))) >= MD.RF_FINAL_MIN_SPLIT).alias("splits_hold"),
                                     F.max(F.when(F.col("id") == 0, F.col("n_rows"))).alias("root_rows"))


@register("rf_leaf_means", split_sql("SELECT CAST(t AS INTEGER) AS tree, (SELECT count(*) FROM tr) AS n_rows, 0::BIGINT AS unequal "
                                     "FROM range(0, 100) AS g(t)"))
def q_rf_leaf_means(spark, sf):
    """Per tree of the final forest: the training rows that come to its leaves, and the leaves whose row count or
    prediction differs from those of the rows that come to them."""
    train, _ = M.train_test(spark, sf)
    pipeline = _model(spark, sf, "rf_final", BASE_FEATURES, ["ft", "mk"])
    rows = pipeline.stages[:-1]
    placed = _spread(materialize(MD.together(train.select(*BASE_FEATURES, "ft", "mk", TARGET)), "leaf-rows"))
    for stage in rows:
        placed = stage.transform(placed)
    means = FO.leaf_means(pipeline.stages[-1], placed, TARGET, MD.WEIGHT)
    leaves = FO.leaves(FO.node_table(spark, _forest_path(spark, sf)))
    both = leaves.join(means, ["tree", "leaf"], "full")
    same = (F.col("n") == F.col("n_rows")) & (F.abs(F.col("mean") - F.col("value")) <= 1e-9 * F.abs(F.col("value")))
    return both.groupBy("tree").agg(F.sum("n").alias("n_rows"), F.sum((~F.coalesce(same, F.lit(False))).cast("long")).alias("unequal"))


def _forest_path(spark, sf):
    """The final forest, saved once per session and input."""
    return V._once(spark, sf, "forest-path", "v2", lambda: FO.save_forest(
        _model(spark, sf, "rf_final", BASE_FEATURES, ["ft", "mk"]).stages[-1], scratch_path(spark, "rf-final")))


FEATURE_SETS = {"dashboard": (DASHBOARD_FEATURES, []), "dashboard+brand": (DASHBOARD_FEATURES, ["mk"])}
COMPARED = ("ols", "knn", "rf_default")


def _comparison(spark, sf):
    """(test metrics per model and feature set, log of the runs), made once per session and input.  The models of the
    dashboard set are those of `ols`, `knn` and `rf_default`."""
    def make():
        train, test = M.train_test(spark, sf)
        truth = test.select("row_key", F.col(TARGET).alias("y_true"))
        near = truth.join(q_knn(spark, sf).distinct(), "row_key").withColumnRenamed("prediction", "y_pred")
        known = {("knn", "dashboard"): near, **{(m, "dashboard"): _predictions(spark, sf, m, DASHBOARD_FEATURES, []) for m in ("ols", "rf_default")}}
        known[("ols", "dashboard+brand")] = _predictions(spark, sf, "ols", DASHBOARD_FEATURES, ["mk"])
        metrics = materialize(MD.compare_models(train, test, TARGET, FEATURE_SETS, "row_key", COMPARED,
                                                {"mk": _trained_list(spark, sf, "mk")}, known), "comparison")
        path = scratch_path(spark, "comparison-runs")
        MO.log_metrics(metrics, path, name="model", params=["features"], metrics=["mse", "rmse", "r2"], started=datetime.now())
        return metrics, path

    return V._once(spark, sf, "comparison", "v2", make)


@register("model_compare")
def q_model_compare(spark, sf):
    return _comparison(spark, sf)[0]


_COMPARED_SQL = "(SELECT unnest(['ols', 'knn', 'rf_default']) AS model) m, (SELECT unnest(['dashboard', 'dashboard+brand']) AS features) f"


@register("model_compare_bounds", split_sql(
    f"SELECT model, features, (SELECT count(*) FROM te) AS n, true AS beats_mean FROM {_COMPARED_SQL}"))
def q_model_compare_bounds(spark, sf):
    """A row for every model and feature set: all test rows predicted, better than their mean."""
    return q_model_compare(spark, sf).select("model", "features", "n", (F.col("r2") > 0).alias("beats_mean"))


@register("model_runs", f"SELECT model AS run_name, features, CAST(row_number() OVER (PARTITION BY model ORDER BY features || '-') AS BIGINT) "
                        f"AS version, true AS logged FROM {_COMPARED_SQL}")
def q_model_runs(spark, sf):
    """The log of the comparison: one run for every model and feature set, with its metrics."""
    metrics, path = _comparison(spark, sf)
    log = MO.read_runs(spark, path)
    same = metrics.select(F.col("model").alias("run_name"), "features", F.col("rmse").alias("_rmse"))
    runs = log.withColumn("features", F.col("params")["features"]).join(same, ["run_name", "features"])
    return runs.select("run_name", "features", "version", (F.col("metrics")["rmse"] == F.col("_rmse")).alias("logged"))


def _check_sql(select: str, ranges: dict = API_RANGES) -> str:
    req = ("SELECT request_id, floor(mass_kg)::INTEGER AS M_kg, floor(ec_cm3)::INTEGER AS Ec_cm3, "
           "floor(ep_kw)::INTEGER AS Ep_KW, erwltp_g_km AS Erwltp_g_km, fc AS Fc, ft AS fuel_type, mk AS Mk "
           f"FROM (SELECT *, {KEY_SQL} AS request_id FROM brand)")
    names = {"mass_kg": "M_kg", "ec_cm3": "Ec_cm3", "ep_kw": "Ep_KW", "erwltp_g_km": "Erwltp_g_km", "fc": "Fc"}
    checks = [f"CASE WHEN NOT coalesce({names[c]} BETWEEN {lo} AND {hi}, false) THEN '{names[c]}' END"
              for c, (lo, hi) in ranges.items()]
    checks += ["CASE WHEN fuel_type NOT IN (SELECT ft FROM final WHERE ft IS NOT NULL) OR fuel_type IS NULL "
               "THEN 'fuel_type' END",
               "CASE WHEN Mk NOT IN (SELECT mk FROM final WHERE mk IS NOT NULL) OR Mk IS NULL THEN 'Mk' END"]
    chk = f"SELECT *, concat_ws(',', {', '.join(checks)}) AS reasons FROM rq"
    pairs = O.ctes("final") + [("rq", req), ("ck", f"SELECT *, reasons = '' AS valid FROM ({chk})")]
    return O.with_ctes(pairs, select)


def _checked(spark, sf, limits: dict = API_RANGES):
    return _check(spark, sf, M.requests(spark, sf), limits)


def _check(spark, sf, req, limits: dict = API_RANGES):
    ranges = {shown: limits[name] for shown, name in M.REQUEST_TO_INTERNAL.items() if name in limits}
    cats = {"fuel_type": _trained(spark, sf, "ft"), "Mk": _trained(spark, sf, "mk")}
    return SC.check_requests(req, ranges, cats)


@register("score_input_check", _check_sql("SELECT * FROM ck"))
def q_score_input_check(spark, sf):
    return _checked(spark, sf)


@register("score_check_dashboard", _check_sql("SELECT * FROM ck", DASHBOARD_RANGES))
def q_score_check_dashboard(spark, sf):
    return _checked(spark, sf, DASHBOARD_RANGES)


@register("score_quarantine", _check_sql(
    "SELECT request_id, reasons, CAST(length(reasons) - length(replace(reasons, ',', '')) + 1 AS INTEGER) AS n_reasons "
    "FROM ck WHERE NOT valid"))
def q_score_quarantine(spark, sf):
    """Refused requests, written beside the valid ones and read back, with all their reasons."""
    _, refused = SC.write_checked(_checked(spark, sf), scratch_path(spark, "checked-requests"))
    return refused.select("request_id", F.concat_ws(",", "reasons").alias("reasons"), F.size("reasons").alias("n_reasons"))


@register("score_unknown_brand", _check_sql(
    "SELECT * FROM rq WHERE Mk IS NULL OR Mk NOT IN (SELECT mk FROM final WHERE mk IS NOT NULL)"))
def q_score_unknown_brand(spark, sf):
    return SC.unknown_categories(M.requests(spark, sf), "Mk", _trained(spark, sf, "mk"))


@register("score_features", _check_sql(
    "SELECT request_id, M_kg, Ec_cm3, Ep_KW, Erwltp_g_km, Fc, "
    f"{_flags_sql('fuel_type', 'Ft', FUEL_CATEGORIES)}, {_flags_sql('Mk', 'Mk', BRAND_CATEGORIES)} FROM ck WHERE valid"))
def q_score_features(spark, sf):
    ok = _checked(spark, sf).filter("valid").drop("reasons", "valid")
    wide = FE.onehot_wide(ok, "fuel_type", "Ft", _trained_list(spark, sf, "ft"))
    return FE.onehot_wide(wide, "Mk", "Mk", _trained_list(spark, sf, "mk"))


def _forest_scorer(spark, sf):
    """The final forest, saved and loaded again, as a function of checked requests."""
    def make():
        train, _ = M.train_test(spark, sf)
        model = _model(spark, sf, "rf_final", BASE_FEATURES, ["ft", "mk"])
        return MD.load_model(MD.save_model(model, scratch_path(spark, "model-rf"), MD.model_signature(model, train, [*BASE_FEATURES, "ft", "mk"])))

    walker = V._once(spark, sf, "forest-loaded", "v2", lambda: WK.Walker(spark, make()))

    def score(requests):
        req = requests.select("request_id", *[F.col(k).cast("double").alias(v) for k, v in M.REQUEST_TO_INTERNAL.items()
                                              if v not in ("ft", "mk")], F.col("fuel_type").alias("ft"), F.col("Mk").alias("mk"))
        return walker.predictions(req, ["request_id"])

    return score


@register("rf_score")
def q_rf_score(spark, sf):
    return _forest_scorer(spark, sf)(_spread(_checked(spark, sf).filter("valid")))


REQUEST_ROWS = 50_000  # of a landed file


def _files_per_batch(rows: int) -> int:
    """Files of each of the stream's three batches: they grow in number, not in size, so that a batch is scored by all cores."""
    return max(2, -(-rows // (3 * REQUEST_ROWS)))


def _scored_stream(spark, sf):
    """(scored, refused) requests of the scoring stream, over files that land in three batches."""
    def make():
        landing = scratch_path(spark, "landed-requests")
        requests = M.requests(spark, sf)
        each = _files_per_batch(V.brand(spark, sf).count())
        requests.repartition(3 * each, F.xxhash64("request_id")).write.parquet(landing)
        scored, refused, ckpt = (scratch_path(spark, n) for n in ("scored", "refused", "scored-ckpt"))
        for _ in range(2):  # the rerun adds nothing
            ST.score_requests(spark, landing, requests.schema, lambda batch: _check(spark, sf, batch), _forest_scorer(spark, sf),
                              scored, refused, ckpt, files_per_batch=each)
        return spark.read.parquet(scored).drop("batch"), spark.read.parquet(refused).drop("batch")

    return V._once(spark, sf, "scored-stream", "v2", make)


@register("stream_score")
def q_stream_score(spark, sf):
    return _scored_stream(spark, sf)[0]


@register("stream_score_equal", _check_sql("SELECT count(*) FILTER (WHERE valid) AS scored, count(*) FILTER (WHERE NOT valid) AS refused, "
                                           "0::BIGINT AS unequal FROM ck"))
def q_stream_score_equal(spark, sf):
    """Sizes of the stream's two sinks, and the requests whose predictions differ in number or value from the batch ones."""
    scored, refused = _scored_stream(spark, sf)

    def grouped(df, name):
        return df.groupBy("request_id").agg(F.count(F.lit(1)).alias(f"n_{name}"), F.max("prediction").alias(f"p_{name}"))

    both = grouped(scored, "stream").join(grouped(q_rf_score(spark, sf), "batch"), "request_id", "full")
    same = F.col("n_stream").eqNullSafe(F.col("n_batch")) & F.col("p_stream").eqNullSafe(F.col("p_batch"))
    return both.agg(F.coalesce(F.sum("n_stream"), F.lit(0)).alias("scored"), F.coalesce(F.sum((~same).cast("long")), F.lit(0)).alias("unequal")) \
        .select("scored", F.lit(refused.count()).cast("long").alias("refused"), "unequal")


@register("score_by_run", split_sql("SELECT row_key, round(y_pred, 6) AS prediction FROM et", _UNI_CTE))
def q_score_by_run(spark, sf):
    """Two versions of one model name; scoring by name takes the newest and checks its signature."""
    train, test = M.train_test(spark, sf)
    base, log = scratch_path(spark, "models"), scratch_path(spark, "model-log")
    for feature in ("fc", UNI_X):
        model = MD.fit_model(train, "ols", [feature], [], TARGET, scale=False)
        AR.register_model(model, MD.model_signature(model, train, [feature]), "one-feature", base, log, {"feature": feature})
    scored = AR.score_by_name(test, log, "one-feature", ["row_key"])
    return scored.select("row_key", F.round("prediction", 6).alias("prediction"))


# =====================================================================================
# 2.8 / 2.9: run history (orders as runs), metric history (events as samples)
# =====================================================================================

from ecoframe.sources.fixtures import read_table  # noqa: E402

RUNS_SQL = ("SELECT o_orderkey AS run_id, o_orderpriority AS run_name, o_orderdate AS start_time, "
            "o_totalprice AS rmse, o_orderstatus AS status FROM orders")
SAMPLES_SQL = "SELECT event_id, event_type AS metric, ts, value, props FROM events"


def runs(spark, sf):
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("run_name"),
        F.col("o_orderdate").alias("start_time"), F.col("o_totalprice").alias("rmse"),
        F.col("o_orderstatus").alias("status"))


def samples(spark, sf):
    return read_table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("metric"), "ts", "value", "props")


def runs_sql(select: str) -> str:
    return f"WITH runs AS ({RUNS_SQL}) {select}"


def samples_sql(select: str) -> str:
    return f"WITH samples AS ({SAMPLES_SQL}) {select}"


_VIEW = {"run_id": "Run ID", "rmse": "RMSE", "start_time": "Date", "run_name": "Model name"}


@register("runs_view", runs_sql('SELECT run_id AS "Run ID", rmse AS "RMSE", start_time AS "Date", '
                                'run_name AS "Model name" FROM runs'))
def q_runs_view(spark, sf):
    return MO.runs_view(runs(spark, sf), _VIEW)


@register("runs_sorted", runs_sql("SELECT * FROM runs ORDER BY start_time DESC, run_id DESC"))
def q_runs_sorted(spark, sf):
    return MO.runs_sorted(runs(spark, sf))


@register("runs_latest", runs_sql("SELECT * FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 1"))
def q_runs_latest(spark, sf):
    return MO.latest_run(runs(spark, sf))


@register("runs_latest_per_name", runs_sql(
    "SELECT run_name, run_id, start_time, rmse, status FROM (SELECT *, row_number() OVER (PARTITION BY run_name "
    "ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1"))
def q_runs_latest_per_name(spark, sf):
    return MO.latest_per_name(runs(spark, sf))


@register("run_versions", runs_sql(
    "SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY start_time, run_id) AS version FROM runs"))
def q_run_versions(spark, sf):
    return MO.run_versions(runs(spark, sf))


@register("manifest_latest", runs_sql(
    "SELECT artifact, path, created_at FROM (SELECT run_name AS artifact, 'runs/' || CAST(run_id AS VARCHAR) AS path, "
    "start_time AS created_at, row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, "
    "'runs/' || CAST(run_id AS VARCHAR) DESC) AS rn FROM runs) WHERE rn = 1"))
def q_manifest_latest(spark, sf):
    return MO.latest_artifacts(_artifacts(spark, sf))


def _artifacts(spark, sf):
    return runs(spark, sf).select(F.col("run_name").alias("artifact"),
                                  F.concat(F.lit("runs/"), F.col("run_id").cast("string")).alias("path"),
                                  F.col("start_time").alias("created_at"))


_RUN_CUT = "1995-06-01 00:00:00"


@register("run_log", runs_sql(
    "SELECT run_id, run_name, start_time, rmse, status, row_number() OVER (PARTITION BY run_name ORDER BY start_time, run_id) "
    "AS version FROM runs"))
def q_run_log(spark, sf):
    """Runs logged in two batches with parameters, metrics and tags; versions go on across batches."""
    path = scratch_path(spark, "run-log")
    logged = runs(spark, sf).select(
        F.col("run_id").cast("string").alias("run_id"), "run_name", "start_time",
        F.create_map(F.lit("status"), "status").alias("params"), F.create_map(F.lit("rmse"), "rmse").alias("metrics"),
        F.create_map(F.lit("source"), F.lit("orders")).alias("tags"))
    # versions count by (time, id); ids are numbers here, so they are padded to sort as numbers
    logged = logged.withColumn("run_id", F.lpad("run_id", 20, "0"))
    early = F.col("start_time") < F.lit(_RUN_CUT).cast("timestamp")
    MO.log_runs(logged.filter(early), path)
    log = MO.log_runs(logged.filter(~early), path)
    return log.select(F.col("run_id").cast("long").alias("run_id"), "run_name", "start_time", F.col("metrics")["rmse"].alias("rmse"),
                      F.col("params")["status"].alias("status"), "version")


@register("manifest_roundtrip", ORACLE["manifest_latest"])
def q_manifest_roundtrip(spark, sf):
    """Artifacts entered in two batches: newer paths replace older ones, other keys stay."""
    path = scratch_path(spark, "manifest")
    m = _artifacts(spark, sf)
    early = F.col("created_at") < F.lit(_RUN_CUT).cast("timestamp")
    MO.write_manifest(m.filter(~early), path)
    return MO.write_manifest(m.filter(early), path)


@register("metric_latest", samples_sql(
    "SELECT metric, arg_max(value, (ts, event_id)) AS latest_value, max(ts) AS latest_ts "
    "FROM samples GROUP BY metric"))
def q_metric_latest(spark, sf):
    return MO.metric_latest(samples(spark, sf), tie="event_id")


_CUT_TS = "2024-01-15 00:00:00"


@register("metric_dedup", samples_sql(
    f"SELECT metric, value, ts, event_id, props FROM (SELECT *, row_number() OVER (PARTITION BY metric, value "
    f"ORDER BY ts, event_id) AS rn FROM samples WHERE ts >= TIMESTAMP '{_CUT_TS}' AND value <> 0) b "
    f"WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM samples h WHERE h.ts < TIMESTAMP '{_CUT_TS}' AND h.value <> 0 "
    f"AND h.metric = b.metric AND h.value = b.value)"))
def q_metric_dedup(spark, sf):
    s = samples(spark, sf)
    history = MO.first_per_value(s.filter(F.col("ts") < F.lit(_CUT_TS).cast("timestamp")), tie="event_id")
    batch = s.filter(F.col("ts") >= F.lit(_CUT_TS).cast("timestamp"))
    return MO.append_new_values(history, batch, tie="event_id")


@register("metric_series", samples_sql(
    "SELECT metric, date_trunc('day', ts) AS bucket, count(*) AS n_samples, round(avg(value), 6) AS mean_value, "
    "arg_max(value, (ts, event_id)) AS last_value FROM samples GROUP BY metric, date_trunc('day', ts)"))
def q_metric_series(spark, sf):
    # the mean of non-dyadic values depends on summation order: six decimals
    return MO.metric_series(samples(spark, sf), tie="event_id").withColumn("mean_value", F.round("mean_value", 6))


@register("metric_times", samples_sql(
    "SELECT event_id, epoch_us(ts) / 1000000.0 AS epoch_seconds, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, "
    "make_timestamp(epoch_us(ts)) = ts AS roundtrip_ok FROM samples"))
def q_metric_times(spark, sf):
    """Epoch seconds (fractional), ISO text, and the round trip back to a
    timestamp (session time zone UTC)."""
    s = samples(spark, sf)
    ts = F.col("ts").cast("timestamp")
    epoch = F.unix_micros(ts) / F.lit(1_000_000.0)
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    back = F.timestamp_micros(F.round(epoch * F.lit(1_000_000.0)).cast("long"))
    read = F.to_timestamp(iso, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return s.select("event_id", epoch.alias("epoch_seconds"), iso.alias("iso"), ((back == ts) & (read == ts)).alias("roundtrip_ok"))


@register("metric_parse", samples_sql(
    "SELECT event_id, metric, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM samples"))
def q_metric_parse(spark, sf):
    s = samples(spark, sf)
    return s.select("event_id", "metric", F.get_json_object("props", "$.k").cast("double").alias("k"))


# =====================================================================================
# 2.1 Sources and sinks
# =====================================================================================

from ecoframe.functions.expressions import format_size, progress_percent  # noqa: E402
from ecoframe.operators.windows import running_sum  # noqa: E402
from ecoframe.schema import PAGE_SIZE, TARGET_BRANDS, source_schema  # noqa: E402
from ecoframe.sources import files as FS  # noqa: E402
from ecoframe.streaming import feeds as ST  # noqa: E402


def _years_table(spark, sf):
    path = scratch_path(spark, "vehicles-by-year")
    return FS.write_by_year(V.src(spark, sf), path)


@register("scan_year", O.stage_sql("src", f"SELECT {RAW} FROM src WHERE year = 2022"))
def q_scan_year(spark, sf):
    path = _years_table(spark, sf)
    return FS.scan_years(spark, path, years=[2022]).select(*RAW_COLUMNS)


_SHOWN = ", ".join("cn || ' (provisional)' AS cn" if c == "cn" else c for c in RAW_COLUMNS)


@register("scan_release", O.stage_sql("src", f"SELECT {RAW}, 'Fv' AS release FROM src WHERE year < 2023 "
                                             f"UNION ALL SELECT {_SHOWN}, 'Pv' FROM src WHERE year = 2023"))
def q_scan_release(spark, sf):
    """Provisional tables of all years and final ones of those before 2023: the final release replaces the provisional."""
    path, src = scratch_path(spark, "releases"), V.src(spark, sf)
    FS.write_release(src.withColumn("cn", F.concat("cn", F.lit(" (provisional)"))), path, "Pv")
    FS.write_release(src.filter("year < 2023"), path, "Fv")
    return FS.scan_releases(spark, path).select(*RAW_COLUMNS, "release")


@register("published_stages", O.stage_sql("brand", f"SELECT {RAW} FROM brand"))
def q_published_stages(spark, sf):
    """Raw and processed tables as published outputs: each step finds its input through the manifest, and an output
    written without its manifest row is not read."""
    base, manifest = scratch_path(spark, "published"), scratch_path(spark, "published-manifest")
    AR.publish(V.src(spark, sf), base, "raw_data", manifest)
    V.src(spark, sf).limit(0).write.parquet(MO.stamped_path(base, "raw_data", datetime(2999, 1, 1)))  # not committed
    raw = AR.read_published(spark, manifest, "raw_data")
    AR.publish(clean.clean_brand(clean.clean_fuel(V.dedup_of(raw), "ft"), "mk"), base, "processed_data", manifest)
    return AR.read_published(spark, manifest, "processed_data").select(*RAW_COLUMNS)


@register("union_years", O.stage_sql("src", f"SELECT {RAW} FROM src"))
def q_union_years(spark, sf):
    path = _years_table(spark, sf)
    return FS.union_tables([FS.scan_years(spark, path, [y]).select(*RAW_COLUMNS) for y in FS.years_of(spark, path)])


def _landed_pages(spark, sf):
    path = scratch_path(spark, "landed-pages")
    return FS.write_pages(V.src(spark, sf), path, table="year", page_size=PAGE_SIZE, source_names=True)


@register("json_pages", O.stage_sql("src", f"SELECT {RAW} FROM src"))
def q_json_pages(spark, sf):
    return FS.flatten_pages(FS.read_pages(spark, _landed_pages(spark, sf))).select(*RAW_COLUMNS)


_BAD_PAGE = 95  # a sample with this counter makes its page a bad one


@register("pages_until_gap", samples_sql(
    "SELECT event_id, metric, ts, value, page FROM (SELECT *, event_id // 100 AS page FROM samples) pg "
    "LEFT JOIN (SELECT metric, min(CASE WHEN bad = 1 THEN page WHEN page - coalesce(prev, -1) > 1 "
    "THEN coalesce(prev, -1) + 1 END) AS stop FROM (SELECT *, lag(page) OVER (PARTITION BY metric ORDER BY page) "
    "AS prev FROM (SELECT metric, page, max(CASE WHEN json_extract_string(props, '$.k') IS NULL OR value IS NULL "
    f"OR CAST(json_extract_string(props, '$.k') AS INTEGER) = {_BAD_PAGE} "
    "THEN 1 ELSE 0 END) AS bad FROM (SELECT *, event_id // 100 AS page FROM samples) GROUP BY metric, page)) "
    "GROUP BY metric) st USING (metric) WHERE st.stop IS NULL OR pg.page < st.stop"))
def q_pages_until_gap(spark, sf):
    s = samples(spark, sf).withColumn("page", F.expr("event_id div 100"))
    k = F.get_json_object("props", "$.k")
    bad = k.isNull() | F.col("value").isNull() | F.coalesce(k.cast("int") == _BAD_PAGE, F.lit(False))
    kept = FS.pages_until_gap(s, "metric", "page", bad, first_page=0)
    return kept.select("event_id", "metric", "ts", "value", "page")


_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("export_year_final", "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders "
                               "WHERE o_orderstatus = 'F'")
def q_export_year_final(spark, sf):
    o = read_table(spark, sf, "orders")
    out = o.filter(F.col("o_orderstatus") == "F").withColumn("year", F.year("o_orderdate").cast("int"))
    path = FS.write_csv(out, scratch_path(spark, "orders-final-by-year"), partition_by=["year"])
    back = FS.read_csv(spark, path, schema=o.select(*_ORDERS_COLS).schema)
    return back.select(*_ORDERS_COLS, F.col("year").cast("int").alias("year"))


@register("csv_roundtrip", O.stage_sql("final", f"SELECT {PROC} FROM final"))
def q_csv_roundtrip(spark, sf):
    path = FS.write_csv(V.final(spark, sf), scratch_path(spark, "processed-csv"), source_names=True)
    return FS.read_csv(spark, path, schema=source_schema(PROCESSED_COLUMNS), to_internal=True)


@register("rename_strip", O.stage_sql("final", f"SELECT {PROC} FROM final"))
def q_rename_strip(spark, sf):
    from ecoframe.operators.clean import rename_to_internal, strip_column_names
    f = V.final(spark, sf)
    padded = f.select(*[F.col(c).alias(f" {c} ") for c in f.columns])
    path = FS.write_csv(padded, scratch_path(spark, "padded-csv"))
    back = strip_column_names(FS.read_csv(spark, path, schema=padded.schema))
    return rename_to_internal(back).select(*PROCESSED_COLUMNS)


# =====================================================================================
# 2.3 / 2.9: scalar helpers, previews
# =====================================================================================

@register("format_size", "SELECT doc_id, n_chars, CASE WHEN n_chars < 1024 THEN printf('%.2f B', n_chars::DOUBLE) "
                         "WHEN n_chars < 1048576 THEN printf('%.2f KB', n_chars / 1024.0) "
                         "WHEN n_chars < 1073741824 THEN printf('%.2f MB', n_chars / 1048576.0) "
                         "ELSE printf('%.2f GB', n_chars / 1073741824.0) END AS size_text FROM documents")
def q_format_size(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return d.withColumn("size_text", format_size("n_chars"))


@register("progress_pct", "SELECT doc_id, CAST(sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) "
                          "AS done, CAST(floor(sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) * 100.0 "
                          "/ sum(n_chars) OVER ()) AS INTEGER) AS pct FROM documents")
def q_progress_pct(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    total = d.agg(F.sum("n_chars")).first()[0] or 0
    r = running_sum(d, "doc_id", "n_chars", "done")
    return r.select("doc_id", F.col("done").cast("long").alias("done"),
                    progress_percent(F.col("done"), F.lit(total)).alias("pct"))


_EXTRACT_SQL = O.stage_sql("src", f"SELECT DISTINCT upper(mk) AS make, "
                                  f"{O.first_match_sql('upper(mk)', TARGET_BRANDS)} AS brand FROM src")


@register("brand_extract", _EXTRACT_SQL)
def q_brand_extract(spark, sf):
    from ecoframe.functions.expressions import first_substring_match
    makes = V.src(spark, sf).select(F.upper("mk").alias("make")).distinct()
    return makes.withColumn("brand", first_substring_match("make", TARGET_BRANDS))


@register("brand_extract_join", _EXTRACT_SQL)
def q_brand_extract_join(spark, sf):
    from ecoframe.operators.clean import extract_brand_by_join
    makes = V.src(spark, sf).select(F.upper("mk").alias("make")).distinct()
    brands = spark.createDataFrame([(b, i) for i, b in enumerate(TARGET_BRANDS)], "brand string, pos int")
    return extract_brand_by_join(makes.withColumn("brand", F.col("make")), brands, col="brand")


@register("preview", split_sql(f"SELECT {PROC}, row_key FROM sp ORDER BY row_key LIMIT 10"))
def q_preview(spark, sf):
    return M.split_table(spark, sf).select(*PROCESSED_COLUMNS, "row_key").orderBy("row_key").limit(10)


# =====================================================================================
# 2.10 Streaming
# =====================================================================================

@register("stream_ingest", O.stage_sql("src", f"SELECT {RAW} FROM src"))
def q_stream_ingest(spark, sf):
    landing = _landed_pages(spark, sf)
    sink, ckpt = scratch_path(spark, "stream-vehicles"), scratch_path(spark, "stream-vehicles-ckpt")
    ST.ingest_pages(spark, landing, sink, ckpt)
    ST.ingest_pages(spark, landing, sink, ckpt)  # rerun: the checkpoint makes it add nothing
    return ST.ingested(spark, sink).select(*RAW_COLUMNS)


def _landed_samples(spark, sf):
    """Samples as files that arrive in no order of time."""
    s = samples(spark, sf)
    landing = scratch_path(spark, "landed-samples")
    s.repartition(8, F.xxhash64("event_id")).write.mode("overwrite").parquet(landing)
    return landing, s.schema


@register("stream_metrics", samples_sql(
    "SELECT event_id, metric, ts, value, props FROM (SELECT *, row_number() OVER (PARTITION BY metric, value "
    "ORDER BY ts, event_id) AS rn FROM samples WHERE value <> 0) WHERE rn = 1"))
def q_stream_metrics(spark, sf):
    """The ever-seen history in hash buckets."""
    landing, schema = _landed_samples(spark, sf)
    history, ckpt = scratch_path(spark, "metric-history"), scratch_path(spark, "metric-history-ckpt")
    for _ in range(2):  # the rerun adds nothing
        ST.first_samples(spark, landing, schema, history, ckpt, tie="event_id", files_per_batch=3)
    return ST.current(spark, history, schema)


@register("stream_latest", ORACLE["metric_latest"])
def q_stream_latest(spark, sf):
    """The latest sample per metric from the state store."""
    landing, schema = _landed_samples(spark, sf)
    latest, ckpt = scratch_path(spark, "metric-latest"), scratch_path(spark, "metric-latest-ckpt")
    for _ in range(2):
        ST.latest_samples(spark, landing, schema, latest, ckpt, tie="event_id", files_per_batch=3)
    return ST.current(spark, latest, schema).select("metric", F.col("value").alias("latest_value"), F.col("ts").alias("latest_ts"))


@register("stream_dedup", samples_sql("SELECT event_id, metric, ts, value, props FROM samples"))
def q_stream_dedup(spark, sf):
    """Samples that are delivered in two parts, the second with a redelivery of the first part's last day: the state
    store's keys of that day, kept by the watermark across the restart, drop the repeated ones."""
    s = samples(spark, sf)
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landed-deliveries", "unique-samples", "unique-samples-ckpt"))
    cut = F.lit(_CUT_TS).cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    for part in (ts < cut, ts >= cut - F.expr("INTERVAL 1 DAY")):
        s.filter(part).write.mode("append").parquet(landing)
        ST.unique_samples(spark, landing, s.schema, sink, ckpt, ["event_id"], delay="2 days")
    return spark.read.parquet(sink).drop("batch")
