"""Source projection, deduplication and category normalisation.

Null handling follows the reference's pandas semantics: inequality and
deny-list filters keep null rows (``not_equal_keep_null``), and the brand
frequency filter is a semi join (null makes never match).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.functions.expressions import (
    col_of, first_substring_match, not_equal_keep_null, not_in_keep_null, replace_values,
)
from ecoframe.schema import (
    FUEL_DROP_AFTER_MAP, FUEL_DROP_EARLY, RAW_COLUMNS, SOURCE_TO_INTERNAL, RuleSet, require_columns, rules,
)


def rename_to_internal(df: DataFrame, mapping: dict = SOURCE_TO_INTERNAL) -> DataFrame:
    """Source names (``M (kg)``...) to internal snake_case names."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def strip_column_names(df: DataFrame) -> DataFrame:
    """Remove blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def select_source(df: DataFrame, cols: list = RAW_COLUMNS) -> DataFrame:
    """``SELECT DISTINCT cols ... WHERE every col IS NOT NULL``.

    One hash aggregate on all columns (partial aggregation before the
    shuffle, so repeated rows collapse map-side).
    """
    require_columns(df, cols)
    return df.select(*[col_of(c) for c in cols]).dropna(how="any").distinct()


def dedup_first(df: DataFrame, exclude: list = ("cn", "year"), order: list = ("year", "cn")) -> DataFrame:
    """Keep one row per key, key = every column not in ``exclude``.

    The kept row is the first in ``order`` (the reference keeps the first row
    in file order; its files come in year order).  Because the non-key
    columns are exactly the ordering columns, the kept row is the key plus
    the lexicographic minimum of ``order``: a ``min(struct)`` aggregate, which
    combines map-side and so stays cheap when one key holds many rows.
    """
    exclude = list(exclude)
    order = list(order)
    key = [c for c in df.columns if c not in exclude]
    rest = [c for c in exclude if c not in order]
    pick = F.min(F.struct(*[col_of(c) for c in order + rest])).alias("_first")
    out = df.groupBy(*[col_of(c) for c in key]).agg(pick)
    return out.select(*[F.col(f"_first.{c}").alias(c) if c in exclude else col_of(c) for c in df.columns])


def clean_fuel(df: DataFrame, col: str = "ft", rule: RuleSet | str = "v2") -> DataFrame:
    """Lower-case, drop ``unknown``, map by the fuel dictionary, drop electric."""
    rule = rules(rule) if isinstance(rule, str) else rule
    out = df.withColumn(col, F.lower(col_of(col)))
    for v in FUEL_DROP_EARLY:
        out = out.filter(not_equal_keep_null(col, v))
    out = out.withColumn(col, replace_values(col, rule.fuel_map))
    for v in FUEL_DROP_AFTER_MAP:
        out = out.filter(not_equal_keep_null(col, v))
    return out


def extract_brand(df: DataFrame, col: str = "mk", brands: list | None = None) -> DataFrame:
    """Replace the make by the first listed brand it contains (list order)."""
    return df.withColumn(col, first_substring_match(col, brands if brands is not None else rules().brands))


def brand_expression(c, rule: RuleSet) -> F.Column:
    """Upper-case, first-match brand extraction, then spelling fixes."""
    return replace_values(first_substring_match(F.upper(col_of(c)), rule.brands), rule.brand_map)


def normalize_by_dictionary(df: DataFrame, col: str, make_expr, keep=None) -> DataFrame:
    """Replace ``col`` by ``make_expr(col)`` computed once per distinct value.

    The distinct values form a dictionary (partial aggregation before the
    shuffle, one row per value); an optional ``keep`` predicate on the
    normalised value is applied to the dictionary, then the dictionary is
    joined back with a null-safe equi-join.  AQE broadcasts the dictionary
    when its measured size is under the broadcast threshold, else it runs a
    sort-merge join with skew splitting.  Costly expressions (a long ordered
    substring search) run once per distinct value, not once per row.
    """
    raw = F.col(f"`{col}`")
    d = (df.groupBy(raw.alias("_raw")).agg(F.count(F.lit(1)).alias("_n"))
           .withColumn("_norm", make_expr(F.col("_raw"))))
    if keep is not None:
        # Guarded by the aggregate output ``_n`` so the optimizer cannot push
        # the predicate below the aggregate (where it would run per row).
        d = d.filter(F.when(F.col("_n") > 0, keep(F.col("_norm"))).otherwise(F.lit(False)))
    d = d.select("_raw", "_norm")
    j = df.join(d, raw.eqNullSafe(F.col("_raw")), "inner")
    return j.select(*[F.col("_norm").alias(c) if c == col else col_of(c) for c in df.columns])


def clean_brand(df: DataFrame, col: str = "mk", rule: RuleSet | str = "v2") -> DataFrame:
    """Upper-case, first-match brand extraction, spelling fixes, deny-list
    (null makes kept), evaluated on the dictionary of distinct makes."""
    rule = rules(rule) if isinstance(rule, str) else rule
    return normalize_by_dictionary(df, col, lambda c: brand_expression(c, rule),
                                   keep=lambda c: not_in_keep_null(c, rule.deny))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per value (a partial + final hash aggregate)."""
    return df.groupBy(col_of(col)).agg(F.count(F.lit(1)).alias(name))


def frequent_values(df: DataFrame, col: str = "mk", threshold: int = 5) -> DataFrame:
    return value_counts(df, col).filter(F.col("n") >= threshold).select(col_of(col))


def keep_frequent(df: DataFrame, col: str = "mk", threshold: int = 5) -> DataFrame:
    """Rows whose ``col`` value occurs at least ``threshold`` times.

    Semi join against the per-value counts: the count table has one row per
    distinct value, so AQE broadcasts it when it is small at run time and
    falls back to a sort-merge semi join when it is not.
    """
    return df.join(frequent_values(df, col, threshold), on=col, how="left_semi")


def drop_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Successive null-keeping ``!=`` filters."""
    for v in values:
        df = df.filter(not_equal_keep_null(col, v))
    return df


def extract_brand_by_join(df: DataFrame, brands_df: DataFrame, col: str = "mk",
                          brand: str = "brand", pos: str = "pos") -> DataFrame:
    """First-match brand extraction as an equi-join, for long brand lists.

    For every distinct make, the substrings with the lengths that occur in
    the brand list are generated (one row per start position and length),
    joined to the brand table on equality, and the hit with the smallest list
    position wins (``min_by``); makes with no hit keep their value.  Work is
    proportional to make length x distinct brand lengths, never makes x
    brands."""
    # distinct brand lengths: at most the longest brand name, a handful of numbers
    lengths = sorted(r[0] for r in brands_df.select(F.length(brand)).distinct().collect())
    makes = df.select(col_of(col).alias("_make")).distinct().filter(F.col("_make").isNotNull())
    subs = (makes.withColumn("_len", F.explode(F.array(*[F.lit(n) for n in lengths])))
                 .withColumn("_start", F.explode(F.sequence(F.lit(1), F.greatest(
                     F.length("_make") - F.col("_len") + 1, F.lit(0)))))
                 .filter(F.col("_start") >= 1)
                 .select("_make", F.expr("substring(_make, _start, _len)").alias("_sub")))
    hits = subs.join(brands_df.select(F.col(brand).alias("_sub"), F.col(pos).alias("_pos")), "_sub")
    best = hits.groupBy("_make").agg(F.min_by("_sub", "_pos").alias("_brand"))
    j = df.join(best, col_of(col) == F.col("_make"), "left")
    return j.select(*[F.coalesce(F.col("_brand"), col_of(c)).alias(c) if c == col else col_of(c)
                      for c in df.columns])
