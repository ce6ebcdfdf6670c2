"""Column expressions built only from Spark built-ins (stay inside codegen)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Column from a name (back-ticked, so names with dots work) or a Column."""
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`")


def replace_values(c, mapping: dict) -> Column:
    """Whole-value replacement; values not in ``mapping`` are kept as is."""
    c = col_of(c)
    if not mapping:
        return c
    items = list(mapping.items())
    expr = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(c)


def first_substring_match(c, candidates: list) -> Column:
    """First candidate (in list order) contained in ``c``; ``c`` itself if none.

    List order decides, not text position: a regex alternation would prefer
    the leftmost hit in the text, which is a different rule.  Written as a
    higher-order ``filter`` over a literal array so the generated code stays
    small for long lists.
    """
    c = col_of(c)
    if not candidates:
        return c
    hits = F.filter(F.array(*[F.lit(b) for b in candidates]), lambda b: c.contains(b))
    return F.coalesce(F.get(hits, 0), c)


def not_equal_keep_null(c, value) -> Column:
    """``c != value`` with pandas semantics: null rows are kept."""
    return ~col_of(c).eqNullSafe(F.lit(value))


def not_in_keep_null(c, values: list) -> Column:
    """``~c.isin(values)`` with pandas semantics: null rows are kept."""
    return ~F.coalesce(col_of(c).isin(list(values)), F.lit(False))


def all_not_null(cols) -> Column:
    return reduce(lambda a, b: a & b, [col_of(c).isNotNull() for c in cols])


def round_half_even_1(c) -> Column:
    """numpy ``round(x, 1)``: ``rint(x * 10) / 10`` (half to even on x*10)."""
    return F.rint(col_of(c) * F.lit(10.0)) / F.lit(10.0)


def abs_diff(a, b) -> Column:
    return F.abs(col_of(a) - col_of(b))


def format_size(c) -> Column:
    """Byte count as text: B below 1 KiB, then KB, MB, GB with two decimals.

    Python formats half-way cases to even (1152 B -> "1.12 KB") while Java's
    ``%.2f`` rounds them up, so the value is rounded half-even (``bround``)
    before formatting."""
    x = col_of(c).cast("double")
    kib, mib, gib = 1024.0, 1024.0 ** 2, 1024.0 ** 3

    def fmt(v, unit):
        return F.format_string(f"%.2f {unit}", F.bround(v, 2))
    return (F.when(x < kib, fmt(x, "B"))
            .when(x < mib, fmt(x / F.lit(kib), "KB"))
            .when(x < gib, fmt(x / F.lit(mib), "MB"))
            .otherwise(fmt(x / F.lit(gib), "GB")))


def progress_percent(done, total) -> Column:
    """``int(done * 100 / total)``, null when the total is unknown (0)."""
    d, t = col_of(done).cast("double"), col_of(total).cast("double")
    return F.when(t > 0, F.floor(d * F.lit(100.0) / t).cast("int"))


def hash_bucket32(key: Column, seed: int) -> Column:
    """Unsigned 32-bit bucket from the first 8 hex digits of md5(seed:key).

    Same value in any engine that has md5, so splits are reproducible and
    independent of partitioning and row order.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def lossless_key(cols) -> Column:
    """One text that differs whenever any of the columns differs.

    Numbers are written in their shortest form that reads back to the same
    value, nulls as ``\\N``; the escape sign and the separator are escaped."""
    def part(c):
        text = F.replace(F.replace(col_of(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(text, F.lit("\\N"))

    return F.concat_ws("|", *[part(c) for c in cols])
