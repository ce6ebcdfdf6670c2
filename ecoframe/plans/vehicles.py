"""Stages of the vehicle-cleaning plan, composed from the operators.

``raw -> src (not null + distinct) -> dedup -> fuel -> brand -> rare ->
six outlier passes -> final (drop hybrid / bio fuels)``.

The fuel, brand and rare stages and the outlier passes are written to the shared work folder;
what was written is remembered per session, input files and rule set, so the raw
tables are read once and later stages (encoding, models, reports) read written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ecoframe.operators import clean, outliers
from ecoframe.schema import OUTLIER_GROUP, OUTLIER_ORDER, PROCESSED_COLUMNS, RAW_COLUMNS, rules
from ecoframe.session import materialize, table_path
from ecoframe.sources.fixtures import vehicles_raw

_MEMO: dict = {}


def clear_memo() -> None:
    _MEMO.clear()


def _version(spark: SparkSession, sf: str) -> tuple:
    """Sizes and modification times of the input files: a stage is written anew when they change."""
    sc, out = spark.sparkContext, []
    for name in ("lineitem", "part", "orders"):
        path = sc._jvm.org.apache.hadoop.fs.Path(table_path(sf, name))
        files = path.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(path)
        out.append(tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)))
    return tuple(out)


def _once(spark: SparkSession, sf: str, stage: str, rule: str, make):
    """What ``make()`` returns, computed once per session, input and rule set."""
    key = (stage, spark.sparkContext.applicationId, sf, rule, _version(spark, sf))
    if key not in _MEMO:
        _MEMO[key] = make()
    return _MEMO[key]


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return vehicles_raw(spark, sf)


def src(spark: SparkSession, sf: str) -> DataFrame:
    return clean.select_source(vehicles_raw(spark, sf, with_ord=False), RAW_COLUMNS)


def dedup_of(source: DataFrame) -> DataFrame:
    return clean.dedup_first(source, exclude=["cn", "year"], order=["year", "cn"])


def dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_of(src(spark, sf))


def raw_counts(spark: SparkSession, sf: str) -> dict:
    """Rows of the src and dedup stages, counted in one job of their own.

    Counting src while the fuel stage is written would keep Spark from seeing that the dedup aggregate ignores the
    repeats which DISTINCT removes, and from dropping fuels before both."""
    def make():
        seen = Observation()
        kept = dedup_of(src(spark, sf).observe(seen, F.count(F.lit(1)).alias("n"))).count()
        return {"src": seen.get["n"], "dedup": kept}

    return _once(spark, sf, "raw-counts", "v2", make)


def fuel(spark: SparkSession, sf: str, rule: str = "v2") -> DataFrame:
    """The raw tables are read once for this stage; every later stage reads written tables."""
    return _once(spark, sf, "fuel", rule, lambda: materialize(
        clean.clean_fuel(dedup(spark, sf), "ft", rule), f"fuel-{rule}"))


def brand(spark: SparkSession, sf: str, rule: str = "v2") -> DataFrame:
    """Brand stage, written once: its dictionary and its rows both come from the written fuel stage."""
    return _once(spark, sf, "brand", rule, lambda: materialize(
        clean.clean_brand(fuel(spark, sf, rule), "mk", rule), f"brand-{rule}"))


def rare(spark: SparkSession, sf: str, rule: str = "v2") -> DataFrame:
    return clean.keep_frequent(brand(spark, sf, rule), "mk", rules(rule).rare_min)


def cleaned(spark: SparkSession, sf: str, rule: str = "v2") -> DataFrame:
    """The ``rare`` stage written once to the work folder."""
    return _once(spark, sf, "cleaned", rule, lambda: materialize(rare(spark, sf, rule), f"cleaned-{rule}"))


def chain(spark: SparkSession, sf: str, rule: str = "v2"):
    """(survivors of the six passes, pass reports), computed once per session."""
    return _once(spark, sf, "chain", rule, lambda: outliers.outlier_chain(
        cleaned(spark, sf, rule), OUTLIER_ORDER, OUTLIER_GROUP))


def final(spark: SparkSession, sf: str, rule: str = "v2") -> DataFrame:
    """Processed table: fixed column order, hybrid (and bio, v2) fuels removed."""
    out, _ = chain(spark, sf, rule)
    out = out.select(*PROCESSED_COLUMNS)
    return clean.drop_values(out, "ft", rules(rule).fuel_drop_final)


def mean_co2_by_brand_fuel(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship report: mean WLTP CO2 and row count per brand and fuel."""
    return (final(spark, sf).groupBy("mk", "ft")
            .agg(F.avg("ewltp_g_km").alias("mean_ewltp"), F.count(F.lit(1)).alias("n")))
