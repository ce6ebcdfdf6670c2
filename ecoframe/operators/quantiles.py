"""Exact quantiles with linear interpolation, computed without gathering the
column into one task.

Spark's ``percentile`` aggregate is exact but merges a value->count map of
the whole column in a single final task; for a global (ungrouped) quantile
over billions of distinct doubles that task holds everything.  Here the
order statistics are found by histogram refinement instead, for all columns
and all wanted ranks together:

1. one pass for the count, the finite minimum and maximum and the number of
   infinite values of every column;
2. each further pass builds an equal-width histogram (``buckets`` bins) over
   every interval that still holds a wanted rank, every task contributing
   partial counts; the bin that holds the rank becomes the next interval, cut
   to the smallest and largest value found in it.  An interval of one value
   is the answer.

An interval's two ends always fall into different bins, so every pass narrows
it and the search ends.  A pass returns at most ``buckets`` rows per open
interval, whatever the column holds; no values are fetched.

A job that writes the column can take a mergeable sketch on the way
(`sketch_marks`, an aggregate for ``observe``): values just below and above every wanted
quantile.  `quantiles_between` then starts with one scan that counts the rows at and between these
marks instead of step 1 and a histogram of the whole range.  The zones cover all values, so the result is exact whatever
the sketch says; a poor mark only leaves a wider interval to narrow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoframe.functions.expressions import col_of


def _long_form(df: DataFrame, cols: list) -> DataFrame:
    """(c, x): number of the column and its value; nulls and NaN are left out."""
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), col_of(c).cast("double").alias("x")) for i, c in enumerate(cols)])
    return df.select(F.explode(pairs).alias("_p")).select("_p.c", "_p.x").filter(
        F.col("x").isNotNull() & ~F.isnan(F.col("x")))


def order_statistics(x: DataFrame, wanted: list, buckets: int) -> dict:
    """Values at 0-based ranks.  ``wanted``: (column, lowest, highest, rows below the lowest, ranks)."""
    out = {}
    pending = [(c, lo, hi, below, sorted(set(ranks))) for c, lo, hi, below, ranks in wanted if ranks]
    while pending:
        for c, lo, hi, _, ranks in pending:
            if lo == hi:
                out.update({(c, r): lo for r in ranks})
        pending = [p for p in pending if p[1] < p[2]]
        if not pending:
            break
        number = bucket = None
        for i, (c, lo, hi, _, _) in enumerate(pending):
            inside = (F.col("c") == c) & F.col("x").between(lo, hi)
            width = hi / buckets - lo / buckets  # a difference of the ends could overflow
            place = (F.least(F.floor(F.col("x") / F.lit(width) - F.lit(lo / width)), F.lit(buckets - 1)) if width > 0
                     and math.isfinite(lo / width) and math.isfinite(hi / width) else F.lit(1))
            # Rounding can't merge the ends: the lowest value has the first bin, the highest the last.
            place = F.when(F.col("x") == lo, F.lit(0)).when(F.col("x") == hi, F.lit(buckets)).otherwise(
                F.greatest(place.cast("int"), F.lit(1)))
            number = F.when(inside, F.lit(i)) if number is None else number.when(inside, F.lit(i))
            bucket = F.when(inside, place) if bucket is None else bucket.when(inside, place)
        hist = (x.select("x", number.alias("i"), bucket.alias("b")).filter("i IS NOT NULL").groupBy("i", "b")
                .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        narrowed = []
        for i, (c, _, _, below, ranks) in enumerate(pending):
            for row in sorted((r for r in hist if r["i"] == i), key=lambda r: r["lo"]):
                hit = [r for r in ranks if below <= r < below + row["n"]]
                if hit:
                    narrowed.append((c, row["lo"], row["hi"], below, hit))
                below += row["n"]
        pending = narrowed
    return out


def exact_quantiles_of(df: DataFrame, cols: list, probs: list, buckets: int = 1024) -> dict:
    """{column: quantiles} for several columns in the same passes; linear
    interpolation between order statistics as in numpy/pandas:
    ``q = x[f] + (x[f+1] - x[f]) * t`` with ``pos = p * (n - 1)``,
    ``f = floor(pos)``, ``t = pos - f``.  Without values: None."""
    x = _long_form(df, cols)
    finite = F.abs(F.col("x")) < F.lit(float("inf"))
    stats = {r["c"]: r for r in x.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(finite, F.col("x"))).alias("lo"),
        F.max(F.when(finite, F.col("x"))).alias("hi"), F.count_if(F.col("x") == F.lit(float("-inf"))).alias("under"),
        F.count_if(F.col("x") == F.lit(float("inf"))).alias("over")).collect()}
    ranks, wanted, known = {}, [], {}
    for i, _ in enumerate(cols):
        if i not in stats:
            continue
        s = stats[i]
        ranks[i] = [(math.floor(p * (s["n"] - 1)), p * (s["n"] - 1)) for p in probs]
        need = {min(f + d, s["n"] - 1) for f, _ in ranks[i] for d in (0, 1)}
        for r in need:
            if r < s["under"]:
                known[i, r] = float("-inf")
            elif r >= s["n"] - s["over"]:
                known[i, r] = float("inf")
        wanted.append((i, s["lo"], s["hi"], s["under"], [r for r in need if (i, r) not in known]))
    known |= order_statistics(x, wanted, buckets)
    out = {}
    for i, c in enumerate(cols):
        out[c] = [None] * len(probs)
        for at, (f, pos) in enumerate(ranks.get(i, ())):
            low, t = known[i, f], pos - f
            out[c][at] = low if t == 0 else low + (known[i, min(f + 1, stats[i]["n"] - 1)] - low) * t
    return out


def sketch_marks(col, probs: list, accuracy: int = 10_000) -> Column:
    """Aggregate: finite values of ``col`` two sketch errors below and above every quantile, in order (null without values)."""
    x, off = col_of(col).cast("double"), 2.0 / accuracy
    places = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-off, off)})
    return F.percentile_approx(F.when(F.abs(x) < F.lit(float("inf")), x), places, accuracy)


def quantiles_between(df: DataFrame, col, probs: list, marks: list | None, buckets: int = 1024) -> list:
    """Quantiles of one column, as `exact_quantiles`, from the ``marks`` of a sketch."""
    x = _long_form(df.select(col_of(col).alias("x")), ["x"])
    zone = F.lit(0)
    for cut in sorted({float("-inf"), *(marks or []), float("inf")}):
        zone = zone + (F.col("x") >= F.lit(cut)).cast("int") + (F.col("x") > F.lit(cut)).cast("int")
    zones = sorted(x.groupBy(zone.alias("zone")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"),
                                                     F.max("x").alias("hi")).collect())
    n, below, wanted, known = sum(z["n"] for z in zones), 0, [], {}
    if not n:
        return [None] * len(probs)
    need = {min(math.floor(p * (n - 1)) + d, n - 1) for p in probs for d in (0, 1)}
    for z in zones:
        hit = [r for r in need if below <= r < below + z["n"]]
        if z["lo"] == z["hi"]:
            known.update({r: z["lo"] for r in hit})
        else:
            wanted.append((0, z["lo"], z["hi"], below, hit))
        below += z["n"]
    known |= {r: v for (_, r), v in order_statistics(x, wanted, buckets).items()}
    return [_interpolated(known, p * (n - 1), n) for p in probs]


def _interpolated(values: dict, pos: float, n: int) -> float:
    """Value at the place ``pos`` between the ranks that ``values`` holds."""
    low, t = values[math.floor(pos)], pos - math.floor(pos)
    return low if t == 0 else low + (values[min(math.floor(pos) + 1, n - 1)] - low) * t


def exact_quantiles(df: DataFrame, col, probs: list, buckets: int = 1024) -> list:
    """Quantiles of one column (see `exact_quantiles_of`)."""
    return exact_quantiles_of(df.select(col_of(col).alias("x")), ["x"], probs, buckets)["x"]
