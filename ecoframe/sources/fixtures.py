"""``vehicles_raw``: a vehicle-registration table derived from the TPC-H-like
test tables (lineitem x part x orders).

The brand and fuel of each row come from short fixed lists indexed by
``p_partkey`` and ``l_suppkey``; they are applied as array lookups inside the
projection, so the only joins are lineitem-orders (on the order key) and
lineitem-part (on the part key).  Catalyst prunes the scans to the eight
columns used; AQE picks broadcast or sort-merge from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoframe.session import table_path

# FIXED VALUES of the test fixture: make and fuel spellings by index.
FIXTURE_MAKES = [
    "Ford", "FORD-CNG-TECHNIK", "VW", "volkswagen", "Škoda", "?KODA",
    "Alfa  Romeo", "LANDROVER", "Jaguar Land Rover Limited", "DS", "Mercedes-AMG",
    "BMW I", "PSA AUTOMOBILES SA", "FCA ITALY", "Tripod", "Panda", "MAN",
    "Tesla", "Fiat Group", "Seat", "hyundai", "Kia", "Renault", "Dacia",
    "D.R. Motor",
]
FIXTURE_FUELS = [
    "petrol", "PETROL", "diesel", "Diesel", "lpg", "ng", "NG-Biomethane",
    "e85", "hydrogen", "petrol/electric", "diesel/electric", "electric", "unknown",
]
RARE_MAKE = "Rarecar"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _pick(values: list, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def vehicles_raw(spark: SparkSession, sf_dir: str, with_ord: bool = True) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")

    # orders first: should both joins be sort-merge, the rows are shuffled by order while they hold numbers alone
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
           .join(pa, li.l_partkey == pa.p_partkey))
    ok, ln, sk, ps = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("p_size")
    pk = F.col("p_partkey")
    make_idx = F.when(pk % 199 == 7, F.lit(24)).otherwise(pk % 24)
    make = F.when((ok % 4999 == 1) & (ln == 1), F.lit(RARE_MAKE)).otherwise(_pick(FIXTURE_MAKES, make_idx))

    def bump(mod, amount):
        return F.when(ok % mod == 0, F.lit(amount)).otherwise(F.lit(0))

    cols = [
        (F.year("o_orderdate") % 3 + 2021).cast("int").alias("year"),
        make.alias("mk"),
        F.col("p_name").alias("cn"),
        F.when(ok % 101 == 0, F.lit(None)).otherwise(
            1000 + ps * 20 + ln * 5 + bump(37, 900)).cast("double").alias("mass_kg"),
        F.when(ok % 103 == 0, F.lit(None)).otherwise(
            80 + ps * 2 + ln + bump(41, 150)).cast("double").alias("ewltp_g_km"),
        _pick(FIXTURE_FUELS, sk % 13).alias("ft"),
        (900 + ps * 40 + (sk % 3) * 100 + bump(43, 4000)).cast("double").alias("ec_cm3"),
        (40 + ps * 3 + (sk % 5) + bump(47, 400)).cast("double").alias("ep_kw"),
        (F.round(F.col("l_discount") * 100) * F.lit(0.125) + bump(53, 8)).cast("double").alias("erwltp_g_km"),
        (F.lit(3.0) + ps * F.lit(0.125) + ln * F.lit(0.25) + bump(59, 20)).cast("double").alias("fc"),
    ]
    if with_ord:
        cols = [(ok * 8 + ln).alias("src_ord")] + cols
    return j.select(*cols)


VEHICLES_RAW_SQL = """
SELECT l.l_orderkey * 8 + l.l_linenumber AS src_ord,
  2021 + (year(o.o_orderdate) % 3) AS year, CASE WHEN l.l_orderkey % 4999 = 1 AND l.l_linenumber = 1 THEN 'Rarecar' ELSE b.mk END AS mk, p.p_name AS cn,
  CAST(CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE 1000 + p.p_size * 20 + l.l_linenumber * 5
       + CASE WHEN l.l_orderkey % 37 = 0 THEN 900 ELSE 0 END END AS DOUBLE) AS mass_kg,
  CAST(CASE WHEN l.l_orderkey % 103 = 0 THEN NULL ELSE 80 + p.p_size * 2 + l.l_linenumber
       + CASE WHEN l.l_orderkey % 41 = 0 THEN 150 ELSE 0 END END AS DOUBLE) AS ewltp_g_km,
  f.ft AS ft,
  CAST(900 + p.p_size * 40 + (l.l_suppkey % 3) * 100
       + CASE WHEN l.l_orderkey % 43 = 0 THEN 4000 ELSE 0 END AS DOUBLE) AS ec_cm3,
  CAST(40 + p.p_size * 3 + (l.l_suppkey % 5)
       + CASE WHEN l.l_orderkey % 47 = 0 THEN 400 ELSE 0 END AS DOUBLE) AS ep_kw,
  CAST(round(l.l_discount * 100) * 0.125 + CASE WHEN l.l_orderkey % 53 = 0 THEN 8 ELSE 0 END AS DOUBLE) AS erwltp_g_km,
  CAST(3 + p.p_size * 0.125 + l.l_linenumber * 0.25
       + CASE WHEN l.l_orderkey % 59 = 0 THEN 20 ELSE 0 END AS DOUBLE) AS fc
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN (VALUES (0,'Ford'),(1,'FORD-CNG-TECHNIK'),(2,'VW'),(3,'volkswagen'),(4,'Škoda'),(5,'?KODA'),
  (6,'Alfa  Romeo'),(7,'LANDROVER'),(8,'Jaguar Land Rover Limited'),(9,'DS'),(10,'Mercedes-AMG'),
  (11,'BMW I'),(12,'PSA AUTOMOBILES SA'),(13,'FCA ITALY'),(14,'Tripod'),(15,'Panda'),(16,'MAN'),
  (17,'Tesla'),(18,'Fiat Group'),(19,'Seat'),(20,'hyundai'),(21,'Kia'),(22,'Renault'),(23,'Dacia'),
  (24,'D.R. Motor')) AS b(k, mk) ON CASE WHEN p.p_partkey % 199 = 7 THEN 24 ELSE p.p_partkey % 24 END = b.k
JOIN (VALUES (0,'petrol'),(1,'PETROL'),(2,'diesel'),(3,'Diesel'),(4,'lpg'),(5,'ng'),(6,'NG-Biomethane'),
  (7,'e85'),(8,'hydrogen'),(9,'petrol/electric'),(10,'diesel/electric'),(11,'electric'),(12,'unknown'))
  AS f(k, ft) ON l.l_suppkey % 13 = f.k
"""
