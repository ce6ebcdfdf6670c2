"""Model-side stages: split table, dashboard features, scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoframe.operators import features as FE
from ecoframe.plans import vehicles as V
from ecoframe.schema import BASE_FEATURES, PROCESSED_COLUMNS, TARGET

LABEL = TARGET


def split_table(spark: SparkSession, sf: str) -> DataFrame:
    """Processed table + ``row_key`` + hash ``split`` (test share 0.2, seed 42)."""
    f = V.final(spark, sf).withColumn("row_key", FE.vehicle_key())
    return FE.with_split(f, F.col("row_key"))


def with_fuel_flags(df: DataFrame) -> DataFrame:
    """Dashboard flags ``Ft_Diesel`` and ``Ft_Essence`` (double)."""
    return (df.withColumn("Ft_Diesel", (F.col("ft") == "Diesel").cast("double"))
              .withColumn("Ft_Essence", (F.col("ft") == "Essence").cast("double")))


def train_test(spark: SparkSession, sf: str):
    s = with_fuel_flags(split_table(spark, sf))
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring requests in the API's typed form, one per row of the brand
    stage (so unseen brands and out-of-range values occur)."""
    b = V.brand(spark, sf).withColumn("request_id", FE.vehicle_key())
    return b.select(
        "request_id",
        F.floor("mass_kg").cast("int").alias("M_kg"), F.floor("ec_cm3").cast("int").alias("Ec_cm3"),
        F.floor("ep_kw").cast("int").alias("Ep_KW"), F.col("erwltp_g_km").alias("Erwltp_g_km"),
        F.col("fc").alias("Fc"), F.col("ft").alias("fuel_type"), F.col("mk").alias("Mk"))


REQUEST_TO_INTERNAL = {"M_kg": "mass_kg", "Ec_cm3": "ec_cm3", "Ep_KW": "ep_kw",
                       "Erwltp_g_km": "erwltp_g_km", "Fc": "fc", "fuel_type": "ft", "Mk": "mk"}

__all__ = ["split_table", "with_fuel_flags", "train_test", "requests", "BASE_FEATURES", "PROCESSED_COLUMNS"]
