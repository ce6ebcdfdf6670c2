"""Published outputs and registered models.

An output is written first, to a folder of its own, and then committed by one manifest row.  Readers
resolve the newest committed folder, so they see an output whole or not at all, and an output that a lost job left half
written is never read.  A trained model is such an output whose row is its run in the run log: chosen by run
name, newest version unless one is given, and used only on rows that fit its stored signature.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoframe.operators.models import load_model, load_signature, save_model
from ecoframe.operators.monitor import MANIFEST, log_runs, read_runs, stamped_path, stored, write_manifest


def publish(df: DataFrame, base: str, artifact: str, manifest: str, created: datetime | None = None) -> str:
    """Writes ``df`` and commits it as the newest ``artifact``."""
    created = created or datetime.now()
    path = f"{stamped_path(base, artifact, created)}_{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    write_manifest(df.sparkSession.createDataFrame([(artifact, path, created)], MANIFEST), manifest)
    return path


def published_path(spark: SparkSession, manifest: str, artifact: str, as_of: datetime | None = None) -> str:
    """Folder of the newest committed ``artifact`` (of those committed up to ``as_of``)."""
    rows = stored(spark, manifest, MANIFEST).filter(F.col("artifact") == artifact)
    if as_of is not None:
        rows = rows.filter(F.col("created_at") <= F.lit(as_of))
    newest = rows.agg(F.max_by("path", F.struct("created_at", "path")).alias("path")).first()["path"]
    if newest is None:
        raise LookupError(f"{artifact} was not published")
    return newest


def read_published(spark: SparkSession, manifest: str, artifact: str, as_of: datetime | None = None) -> DataFrame:
    return spark.read.parquet(published_path(spark, manifest, artifact, as_of))


def register_model(model: PipelineModel, signature: dict, name: str, base: str, log: str, params: dict | None = None,
                   metrics: dict | None = None, started: datetime | None = None) -> str:
    """Saves a model with its signature and logs it as the next version of ``name``; returns the run id."""
    spark, started = SparkSession.getActiveSession(), started or datetime.now()
    run_id = f"{name}-{started:%Y%m%d_%H%M%S_%f}-{uuid.uuid4().hex[:8]}"
    path = save_model(model, f"{base.rstrip('/')}/{run_id}", signature)
    row = (run_id, name, started, {k: str(v) for k, v in (params or {}).items()}, {k: float(v) for k, v in (metrics or {}).items()}, {"path": path})
    schema = "run_id string, run_name string, start_time timestamp, params map<string,string>, metrics map<string,double>, tags map<string,string>"
    log_runs(spark.createDataFrame([row], schema), log)
    return run_id


def model_path(spark: SparkSession, log: str, name: str, version: int | None = None) -> str:
    """Folder of a version of ``name``: the newest one unless given."""
    rows = read_runs(spark, log).filter((F.col("run_name") == name) & F.col("tags")["path"].isNotNull())
    if version is not None:
        rows = rows.filter(F.col("version") == version)
    path = rows.agg(F.max_by(F.col("tags")["path"], "version").alias("path")).first()["path"]
    if path is None:
        raise LookupError(f"no model {name}" + (f" with version {version}" if version is not None else ""))
    return path


def signature_faults(signature: dict, rows: DataFrame) -> list[str]:
    """What of the signature's inputs ``rows`` lacks or has with another type."""
    types = dict(rows.dtypes)
    return [f"{i['name']}: {types.get(i['name'], 'missing')} instead of {i['type']}" for i in signature["inputs"] if types.get(i["name"]) != i["type"]]


def score_by_name(rows: DataFrame, log: str, name: str, keep: list, version: int | None = None) -> DataFrame:
    """``keep`` and the prediction of a registered model; rows that do not fit its signature are an error."""
    spark = rows.sparkSession
    path = model_path(spark, log, name, version)
    if faults := signature_faults(load_signature(spark, path), rows):
        raise ValueError("; ".join(faults))
    return load_model(path).transform(rows).select(*keep, "prediction")
