"""Run history and metric history as tables.

A run table has ``run_id, run_name, start_time`` and metric columns; a metric
table has ``metric, ts, value``.  Appends are ``write.mode('append')``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoframe.functions.expressions import col_of
from ecoframe.operators.windows import rank_within_groups


def runs_view(runs: DataFrame, mapping: dict) -> DataFrame:
    """Select and rename history columns (``{source: shown}``)."""
    return runs.select(*[col_of(s).alias(d) for s, d in mapping.items()])


def runs_sorted(runs: DataFrame, ts: str = "start_time", run_id: str = "run_id") -> DataFrame:
    """Most recent first; run id breaks ties so the order is total."""
    return runs.orderBy(F.col(ts).desc(), F.col(run_id).desc())


def latest_run(runs: DataFrame, ts: str = "start_time", run_id: str = "run_id") -> DataFrame:
    """Top-1 by (start time, run id): a global max_by aggregate (partial per
    task), not a sort."""
    cols = runs.columns
    best = runs.agg(F.max_by(F.struct(*cols), F.struct(col_of(ts), col_of(run_id))).alias("_r"))
    return best.select(*[F.col(f"_r.{c}").alias(c) for c in cols])


def latest_per_name(runs: DataFrame, name: str = "run_name", ts: str = "start_time",
                    run_id: str = "run_id") -> DataFrame:
    """Most recent run of each name: ``max_by`` per group (combines map-side,
    so a name with very many runs costs one small buffer per task)."""
    cols = [c for c in runs.columns if c != name]
    best = runs.groupBy(col_of(name)).agg(
        F.max_by(F.struct(*cols), F.struct(col_of(ts), col_of(run_id))).alias("_r"))
    return best.select(col_of(name), *[F.col(f"_r.{c}").alias(c) for c in cols])


def run_versions(runs: DataFrame, name: str = "run_name", ts: str = "start_time",
                 run_id: str = "run_id") -> DataFrame:
    """Version of each run = its 1-based position among runs of the same
    model name by (start time, run id), as a registry numbers versions."""
    return rank_within_groups(runs, [name], [ts, run_id], "version")


def metric_latest(samples: DataFrame, metric: str = "metric", ts: str = "ts", value: str = "value",
                  tie: str | None = None) -> DataFrame:
    """Latest value per metric (what a gauge reports)."""
    order = F.struct(col_of(ts), col_of(tie)) if tie else col_of(ts)
    return samples.groupBy(col_of(metric)).agg(
        F.max_by(col_of(value), order).alias("latest_value"), F.max(col_of(ts)).alias("latest_ts"))


def first_per_value(batch: DataFrame, metric: str = "metric", ts: str = "ts", value: str = "value",
                    tie: str | None = None) -> DataFrame:
    """Non-zero samples, first occurrence of each (metric, value) in time
    order -- the reference appends samples one at a time, skipping 0 and
    values already stored."""
    order = [col_of(ts)] + ([col_of(tie)] if tie else [])
    others = [c for c in batch.columns if c not in (metric, value, ts, tie)]
    nz = batch.filter(col_of(value) != F.lit(0.0))
    agg = nz.groupBy(col_of(metric), col_of(value)).agg(
        F.min(F.struct(*order, *[col_of(c) for c in others])).alias("_f"))
    keep = [ts] + ([tie] if tie else []) + others
    return agg.select(col_of(metric), col_of(value), *[F.col(f"_f.{c}").alias(c) for c in keep])


def append_new_values(history: DataFrame, batch: DataFrame, metric: str = "metric", value: str = "value",
                      ts: str = "ts", tie: str | None = None) -> DataFrame:
    """Rows of ``batch`` to append: first per (metric, value), value != 0,
    and not already in ``history`` (left-anti join on metric and value)."""
    new = first_per_value(batch, metric, ts, value, tie)
    return new.join(history.select(metric, value), [metric, value], "left_anti")


def metric_series(samples: DataFrame, metric: str = "metric", ts: str = "ts", value: str = "value",
                  unit: str = "day", tie: str | None = None) -> DataFrame:
    """Plot data: per metric and time bucket, sample count, mean and last value
    (of equal times the one with the largest ``tie``)."""
    order = F.struct(col_of(ts), col_of(tie)) if tie else col_of(ts)
    b = F.date_trunc(unit, col_of(ts)).alias("bucket")
    return samples.groupBy(col_of(metric), b).agg(
        F.count(F.lit(1)).alias("n_samples"), F.avg(col_of(value)).alias("mean_value"),
        F.max_by(col_of(value), order).alias("last_value"))


def latest_artifacts(manifest: DataFrame, artifact: str = "artifact", path: str = "path",
                     created: str = "created_at") -> DataFrame:
    """Newest path per artifact kind (append-only manifest)."""
    return manifest.groupBy(col_of(artifact)).agg(
        F.max_by(col_of(path), F.struct(col_of(created), col_of(path))).alias("path"),
        F.max(col_of(created)).alias("created_at"))


# Columns of the run log: parameters, metrics and tags by name.
RUN_LOG = ("run_id string, run_name string, start_time timestamp, params map<string,string>, "
           "metrics map<string,double>, tags map<string,string>, version long")
MANIFEST = "artifact string, path string, created_at timestamp"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; empty where it was not created yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return stored(spark, path, RUN_LOG)


def log_runs(runs: DataFrame, path: str) -> DataFrame:
    """Appends runs (run_id, run_name, start_time, params, metrics, tags) to the log at ``path``
    and returns the log.  A run's version follows the highest one that its name has.

    The run id is the key: a run that the log holds already is not entered again, and of rows with
    one id in a batch the first by (name, time) is, so a repeated append changes nothing."""
    spark = runs.sparkSession
    held, names = read_runs(spark, path), spark.createDataFrame([], RUN_LOG).columns
    given = [c for c in names if c != "version"]
    first = runs.groupBy("run_id").agg(F.min_by(F.struct(*given), F.struct("run_name", "start_time")).alias("_r")).select("_r.*")
    new = first.join(held.select("run_id"), "run_id", "left_anti")
    last = held.groupBy("run_name").agg(F.max("version").alias("_last"))
    new = run_versions(new.select(*given), "run_name", "start_time", "run_id").join(last, "run_name", "left")
    new = new.withColumn("version", F.col("version") + F.coalesce("_last", F.lit(0)))
    new.select(*names).write.mode("append").parquet(path)
    return read_runs(spark, path)


def log_metrics(table: DataFrame, path: str, name: str, params: list, metrics: list, started: datetime,
                tags: dict | None = None) -> DataFrame:
    """Logs every row of a table of results as a run: ``name`` is the column of run names, ``params`` and ``metrics``
    are columns.  The run id is the name, the parameters and the start."""
    def values(cols: list, kind: str) -> Column:
        return F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[col_of(c).cast(kind) for c in cols]))

    stamp = started.strftime("%Y%m%d_%H%M%S_%f")
    extra = F.create_map(*[F.lit(x) for kv in (tags or {}).items() for x in kv]) if tags else F.create_map().cast("map<string,string>")
    return log_runs(table.select(
        F.concat_ws("-", col_of(name), *[col_of(c).cast("string") for c in params], F.lit(stamp)).alias("run_id"), col_of(name).alias("run_name"),
        F.lit(started).alias("start_time"), values(params, "string").alias("params"), values(metrics, "double").alias("metrics"),
        extra.alias("tags")), path)


def stamped_path(base: str, name: str, created: datetime) -> str:
    """Output path that carries its creation time: base/name_YYYYmmdd_HHMMSS."""
    return f"{base.rstrip('/')}/{name}_{created:%Y%m%d_%H%M%S}"


def write_manifest(entries: DataFrame, path: str) -> DataFrame:
    """Appends (artifact, path, created_at) rows and returns the manifest: the newest path of every
    artifact ever entered, so older keys stay."""
    names = entries.sparkSession.createDataFrame([], MANIFEST).columns
    entries.select(*names).write.mode("append").parquet(path)
    return latest_artifacts(stored(entries.sparkSession, path, MANIFEST))
