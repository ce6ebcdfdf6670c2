"""Vehicle schema, source <-> internal column names and the cleaning rule sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Source column names (as published in the yearly registration tables) and
# the snake_case names used inside this package.
SOURCE_TO_INTERNAL = {
    "Year": "year",
    "Mk": "mk",
    "Cn": "cn",
    "M (kg)": "mass_kg",
    "Ewltp (g/km)": "ewltp_g_km",
    "Ft": "ft",
    "Ec (cm3)": "ec_cm3",
    "Ep (KW)": "ep_kw",
    "Erwltp (g/km)": "erwltp_g_km",
    "Fc": "fc",
}
INTERNAL_TO_SOURCE = {v: k for k, v in SOURCE_TO_INTERNAL.items()}

# Column order of the raw extract.
RAW_COLUMNS = ["year", "mk", "cn", "mass_kg", "ewltp_g_km", "ft", "ec_cm3", "ep_kw", "erwltp_g_km", "fc"]
# Column order of the processed table (before one-hot encoding).
PROCESSED_COLUMNS = ["mk", "cn", "mass_kg", "ewltp_g_km", "ft", "ec_cm3", "ep_kw", "erwltp_g_km", "year", "fc"]
NUMERIC_COLUMNS = ["mass_kg", "ewltp_g_km", "ec_cm3", "ep_kw", "erwltp_g_km", "fc"]
TARGET = "ewltp_g_km"
# Group of the outlier statistics and the order of the six outlier passes.
OUTLIER_GROUP = ["cn", "ft", "year"]
OUTLIER_ORDER = ["ewltp_g_km", "fc", "mass_kg", "ec_cm3", "ep_kw", "erwltp_g_km"]
# Model inputs: everything but the target and the identifiers.
BASE_FEATURES = ["mass_kg", "ec_cm3", "ep_kw", "erwltp_g_km", "fc"]
# Dashboard feature set: five numerics and two fuel flags.
DASHBOARD_FEATURES = BASE_FEATURES + ["Ft_Diesel", "Ft_Essence"]

VEHICLE_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("mk", T.StringType()),
    T.StructField("cn", T.StringType()),
    T.StructField("mass_kg", T.DoubleType()),
    T.StructField("ewltp_g_km", T.DoubleType()),
    T.StructField("ft", T.StringType()),
    T.StructField("ec_cm3", T.DoubleType()),
    T.StructField("ep_kw", T.DoubleType()),
    T.StructField("erwltp_g_km", T.DoubleType()),
    T.StructField("fc", T.DoubleType()),
])

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the reference rules for equal results.
# ---------------------------------------------------------------------------

# Fuel names (lower-cased first), whole-value mapping; unmapped values kept.
FUEL_MAP_V2 = {
    "petrol": "Essence",
    "hydrogen": "Hydrogene",
    "e85": "Essence",
    "lpg": "GPL",
    "ng": "GPL",
    "ng-biomethane": "Bio-Carburant",
    "diesel": "Diesel",
    "petrol/electric": "Hybride",
    "diesel/electric": "Hybride",
    "electric": "Electrique",
}
# Earlier rule set: every alternative fuel counts as petrol.
FUEL_MAP_V1 = {
    "petrol": "Essence",
    "hydrogen": "Essence",
    "e85": "Essence",
    "lpg": "Essence",
    "ng": "Essence",
    "ng-biomethane": "Essence",
    "diesel": "Diesel",
    "petrol/electric": "Hybride",
    "diesel/electric": "Hybride",
    "electric": "Electrique",
}
# Brands searched, in this order, as substrings of the upper-cased make; the
# first hit wins.
TARGET_BRANDS = [
    "CITROEN", "FORD", "FIAT", "RENAULT", "MERCEDES", "BMW", "VOLKSWAGEN", "ALPINE",
    "INEOS", "LAMBORGHINI", "TOYOTA", "JAGUAR", "GREAT WALL MOTOR", "CATERHAM", "PEUGEOT",
    "MAN", "OPEL", "ALLIED VEHICLES", "IVECO", "MITSUBISHI", "DS", "MAZDA", "SUZUKI",
    "SUBARU", "HYUNDAI", "AUDI", "NISSAN", "SKODA", "SEAT", "DACIA", "VOLVO", "KIA",
    "LAND ROVER", "MINI", "PORSCHE", "ALFA ROMEO", "SMART", "LANCIA", "JEEP",
]
# Whole-value spelling fixes applied after extraction.
BRAND_MAP_V2 = {
    "VW": "VOLKSWAGEN",
    "?KODA": "SKODA",
    "ŠKODA": "SKODA",
    "PSA AUTOMOBILES SA": "PEUGEOT",
    "FCA ITALY": "FIAT",
    "ALFA  ROMEO": "ALFA ROMEO",
    "LANDROVER": "LAND ROVER",
}
BRAND_MAP_V1 = {"DS": "CITROEN", **BRAND_MAP_V2}
# Makes removed outright.
BRAND_DENY = [
    "TRIPOD", "API CZ", "MOTO STAR", "REMOLQUES RAMIREZ", "AIR-BRAKES",
    "SIN MARCA", "WAVECAMPER", "CASELANI", "PANDA",
]
# Minimum rows per brand.
RARE_BRAND_MIN = 5
# Fuels removed before and after the outlier passes (v2).
FUEL_DROP_EARLY = ["unknown"]
FUEL_DROP_AFTER_MAP = ["Electrique"]
FUEL_DROP_FINAL_V2 = ["Hybride", "Bio-Carburant"]
FUEL_DROP_FINAL_V1 = ["Hybride"]
# Outlier threshold: Q3 + 1.5 * IQR rounded half-even to one decimal.
IQR_FACTOR = 1.5
# Prediction errors listed for review.
ERROR_REVIEW_THRESHOLD = 20.0
# Seed and test share of the train/test split.
SPLIT_SEED = 42
TEST_FRACTION = 0.2
# Input ranges accepted for scoring: (low, high) inclusive.
DASHBOARD_RANGES = {
    "mass_kg": (500, 3000), "ec_cm3": (500, 6000), "ep_kw": (20, 500),
    "erwltp_g_km": (0.0, 5.0), "fc": (2.0, 15.0),
}
API_RANGES = {
    "mass_kg": (500, 5000), "ec_cm3": (500, 8000), "ep_kw": (20, 1000),
    "erwltp_g_km": (0.0, 5.0), "fc": (0.0, 20.0),
}
PAGE_SIZE = 100_000
# Random forest settings of the final model.
RF_FINAL_PARAMS = {"bootstrap": False, "max_features": 0.75, "min_samples_leaf": 1,
                   "min_samples_split": 9, "n_estimators": 100, "random_state": 42}
KNN_K = 5
# Releases of a yearly table, the preferred one first: final, provisional.
RELEASES = ["Fv", "Pv"]
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleSet:
    """One version of the cleaning rules."""
    name: str
    fuel_map: dict
    brand_map: dict
    fuel_drop_final: list
    brands: list = field(default_factory=lambda: list(TARGET_BRANDS))
    deny: list = field(default_factory=lambda: list(BRAND_DENY))
    rare_min: int = RARE_BRAND_MIN


RULES = {
    "v2": RuleSet("v2", FUEL_MAP_V2, BRAND_MAP_V2, FUEL_DROP_FINAL_V2),
    "v1": RuleSet("v1", FUEL_MAP_V1, BRAND_MAP_V1, FUEL_DROP_FINAL_V1),
}


def rules(name: str = "v2") -> RuleSet:
    return RULES[name]


def missing_columns(columns, required) -> list:
    """Required columns absent from ``columns`` (in required order)."""
    have = set(columns)
    return [c for c in required if c not in have]


def require_columns(df, required) -> None:
    """Raise when a DataFrame lacks required columns."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def source_schema(cols: list = PROCESSED_COLUMNS) -> T.StructType:
    """Vehicle schema with source column names, in ``cols`` order."""
    by_name = {f.name: f for f in VEHICLE_SCHEMA.fields}
    return T.StructType([T.StructField(INTERNAL_TO_SOURCE[c], by_name[c].dataType) for c in cols])
