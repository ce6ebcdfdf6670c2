"""Categorical encodings, train/test splits and standard scaling."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoframe.functions.expressions import col_of, hash_bucket32, lossless_key
from ecoframe.operators.windows import rank_within_groups
from ecoframe.schema import SPLIT_SEED, TEST_FRACTION


def categories(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` in sorted order."""
    c = col_of(col)
    return df.select(c).filter(c.isNotNull()).distinct().orderBy(c)


MAX_CATEGORIES = 10_000  # more columns than this are no schema


def category_list(trained: DataFrame, col: str, most: int = MAX_CATEGORIES) -> list:
    """Sorted values of a trained category table.  They become column names, so
    the driver needs them: more than ``most`` are an error, and the vector encoding is the form to use."""
    found = [r[0] for r in categories(trained, col).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {col}: not a categorical column")
    return found


def onehot_wide(df: DataFrame, col: str, prefix: str | None = None, cats: list | None = None) -> DataFrame:
    """pandas ``get_dummies`` on one column: the column is removed and one
    0/1 (bigint) column per sorted category is appended; null -> all zeros.
    One projection, no shuffle; ``cats`` are the caller's (or the trained) categories."""
    prefix = prefix or col
    cats = category_list(df, col) if cats is None else list(cats)
    c = col_of(col)
    flags = [F.coalesce((c == F.lit(v)).cast("long"), F.lit(0).cast("long")).alias(f"{prefix}_{v}") for v in cats]
    return df.select(*[col_of(x) for x in df.columns if x != col], *flags)


def onehot_vector_model(cols: list, numeric: list, out: str = "features"):
    """StringIndexer (alphabetical) + OneHotEncoder (no category dropped) +
    VectorAssembler: the ML form of the wide encoding, safe for names with
    dots.  Unseen categories at scoring time are kept in an extra slot."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep") for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols],
                        dropLast=False, handleInvalid="keep")
    asm = VectorAssembler(inputCols=list(numeric) + [f"{c}_vec" for c in cols], outputCol=out)
    return Pipeline(stages=[*idx, ohe, asm])


def vehicle_key() -> Column:
    from ecoframe.schema import NUMERIC_COLUMNS
    return lossless_key(["mk", "cn", "year", "ft", *NUMERIC_COLUMNS])


def with_split(df: DataFrame, key: Column, seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION,
               name: str = "split") -> DataFrame:
    """Hash split: ``test`` when the 32-bit md5 bucket of ``seed:key`` falls
    below ``test_fraction * 2^32``.  Stable under any partitioning or row
    order, and a narrow transformation (no shuffle)."""
    cut = int(math.floor(test_fraction * 4294967296))
    b = hash_bucket32(key, seed)
    return df.withColumn(name, F.when(b < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def exact_split(df: DataFrame, key: Column, seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION,
                name: str = "split") -> DataFrame:
    """Exact-size split: the first ``ceil(test_fraction * n)`` rows in
    (hash bucket, key) order are ``test``.

    One count per 16-bit prefix of the bucket finds the prefix in which the cut
    falls; only its rows (about n / 65,536, more where keys repeat) are ranked, spread over
    tasks (``rank_within_groups``), and all others are decided by their prefix."""
    coarse = 65536
    t = df.withColumn("_b", hash_bucket32(key, seed)).withColumn("_k", key)
    prefix = F.floor(F.col("_b") / F.lit(coarse))
    counts = sorted((r["p"], r["n"]) for r in t.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    m = int(math.ceil(test_fraction * sum(n for _, n in counts)))
    below, cut = 0, None
    for p, n in counts:
        if below + n > m:
            cut = p
            break
        below += n
    if cut is None:
        return df.withColumn(name, F.lit("test"))
    sure = t.filter(prefix != cut).withColumn(name, F.when(prefix < cut, F.lit("test")).otherwise(F.lit("train")))
    edge = rank_within_groups(t.filter(prefix == cut), [], ["_b", "_k"], "_rn")
    edge = edge.withColumn(name, F.when(F.col("_rn") <= m - below, F.lit("test")).otherwise(F.lit("train"))).drop("_rn")
    return sure.unionByName(edge).drop("_b", "_k")


def random_split(df: DataFrame, test_fraction: float = TEST_FRACTION, seed: int | None = None):
    """Unseeded (or seeded) Bernoulli split; sizes vary run to run."""
    return df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)


def scaler_stats(train: DataFrame, cols: list) -> dict:
    """Mean and population std per column (std 0 -> 1, as sklearn).  One
    aggregate row; returned as driver floats (2 x columns numbers)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(col_of(c)).alias(f"m{len(aggs)}"), F.stddev_pop(col_of(c)).alias(f"s{len(aggs)}")]
    row = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[2 * i], row[2 * i + 1]
        out[c] = (float(m), 1.0 if (s is None or s == 0.0) else float(s))
    return out


def scaler_apply(df: DataFrame, stats: dict, suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` per column, with the fitted numbers as literals."""
    cols = []
    for c in df.columns:
        if c in stats:
            m, s = stats[c]
            cols.append(((col_of(c) - F.lit(m)) / F.lit(s)).alias(c + suffix))
        else:
            cols.append(col_of(c))
    return df.select(*cols)
