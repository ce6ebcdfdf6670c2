"""Group-mean / IQR outlier removal.

One pass: mean of ``target`` per group (rows with a null group key get no
mean and are dropped, as pandas ``groupby`` drops null keys), absolute
distance to the mean, threshold ``Q3 + 1.5 * IQR`` of the distances rounded
half-even to one decimal, keep rows with distance ``<=`` threshold.  Passes
are sequential: pass *n* uses the survivors of pass *n-1*, and the lineage is
cut after each pass by writing the survivors to the shared work folder.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ecoframe.functions.expressions import abs_diff, col_of
from ecoframe.operators.quantiles import exact_quantiles, quantiles_between, sketch_marks
from ecoframe.schema import IQR_FACTOR, OUTLIER_GROUP, OUTLIER_ORDER
from ecoframe.session import discard, materialize  # noqa: F401  (re-exported)


def group_mean(df: DataFrame, target: str, group: list = OUTLIER_GROUP) -> DataFrame:
    """Mean of ``target`` per group (partial + final hash aggregate)."""
    return df.groupBy(*[col_of(g) for g in group]).agg(F.avg(col_of(target)).alias(f"{target}_mean"))


def attach_group_mean(df: DataFrame, target: str, group: list = OUTLIER_GROUP, means: DataFrame | None = None) -> DataFrame:
    """Left equi-join of the group means (``means``, where they are written already); null keys never match.

    The statistics side has one row per group, so AQE turns the join into a
    broadcast when it is small and otherwise keeps a sort-merge join whose
    skewed partitions it splits (a hot group cannot stall one task).
    """
    return df.join(group_mean(df, target, group) if means is None else means, on=list(group), how="left")


def with_distance(df: DataFrame, target: str, group: list = OUTLIER_GROUP, means: DataFrame | None = None) -> DataFrame:
    j = attach_group_mean(df, target, group, means)
    return j.withColumn(f"diff_{target}", abs_diff(target, f"{target}_mean"))


QUARTILES = [0.25, 0.75]


def iqr_threshold(df: DataFrame, dist_col: str, factor: float = IQR_FACTOR, sketched: dict | None = None) -> float:
    """``round(Q3 + factor * (Q3 - Q1), 1)`` with numpy rounding; NaN without distances.

    ``sketched``: what a sketch of the distances found while they were written (``marks``)."""
    q1, q3 = exact_quantiles(df, dist_col, QUARTILES) if sketched is None else quantiles_between(df, dist_col, QUARTILES, sketched["marks"])
    if q1 is None:
        return float("nan")
    return float(np.round(np.float64(q3) + factor * (np.float64(q3) - np.float64(q1)), 1))


@dataclass
class PassReport:
    target: str
    threshold: float
    at_or_above: int
    rows_after: int


def outlier_pass(df: DataFrame, target: str, group: list = OUTLIER_GROUP,
                 factor: float = IQR_FACTOR, keep_helpers: bool = True):
    """One pass; returns (survivors, threshold).  With ``keep_helpers`` the
    survivors carry ``<target>_mean`` and ``diff_<target>``."""
    j = with_distance(df, target, group)
    seuil = iqr_threshold(j, f"diff_{target}", factor)
    kept = j.filter(F.col(f"diff_{target}") <= F.lit(seuil))
    if not keep_helpers:
        kept = kept.select(*[col_of(c) for c in df.columns])
    return kept, seuil


GROUP_NO = "_group_no"


def numbered_groups(df: DataFrame, group: list = OUTLIER_GROUP) -> DataFrame:
    """``df``, written with the number of each row's group (null where a key is null): later passes group and join by
    one number, so the means are a small table that Spark broadcasts by its size on disk, and no pass shuffles rows."""
    keys = df.select(*[col_of(g) for g in group]).dropna(how="any").distinct()
    numbers = materialize(keys.withColumn(GROUP_NO, F.monotonically_increasing_id()), "outlier-groups")  # fixed by writing them
    rows = materialize(df.join(numbers, on=list(group), how="left").select(*[col_of(c) for c in df.columns], GROUP_NO), "outlier-rows")
    discard(numbers)
    return rows


def outlier_chain(df: DataFrame, targets: list = OUTLIER_ORDER, group: list = OUTLIER_GROUP,
                  factor: float = IQR_FACTOR):
    """Sequential passes over ``targets``; returns (survivors, [PassReport]).

    Groups are numbered once.  Each pass writes its means and its table with distances once; the table of the pass
    before is then removed."""
    cols = list(df.columns)
    reports = []
    written = cur = numbered_groups(df, group)
    for t in targets:
        # written once, the quartiles sketched on the way: exact quantiles, counts and the next pass read this table, the last
        # with a pushed-down filter
        means, sketch = materialize(group_mean(cur, t, [GROUP_NO]), f"outlier-means-{t}"), Observation()
        distances = with_distance(cur, t, [GROUP_NO], means).select(*[col_of(c) for c in cols], GROUP_NO, f"diff_{t}")
        j = materialize(distances.observe(sketch, sketch_marks(f"diff_{t}", QUARTILES).alias("marks")), f"outlier-{t}")
        d = F.col(f"diff_{t}")
        seuil = iqr_threshold(j, f"diff_{t}", factor, sketch.get)
        counts = j.agg(F.count_if(d >= F.lit(seuil)).alias("above"),
                       F.count_if(d <= F.lit(seuil)).alias("kept")).first()
        for table in (means, written):
            discard(table)
        written = j
        reports.append(PassReport(t, seuil, int(counts["above"]), int(counts["kept"])))
        cur = j.filter(d <= F.lit(seuil)).select(*[col_of(c) for c in cols], GROUP_NO)
    return cur.select(*[col_of(c) for c in cols]), reports


def reports_frame(spark, reports: list) -> DataFrame:
    rows = [(i + 1, r.target, r.threshold, r.at_or_above, r.rows_after) for i, r in enumerate(reports)]
    return spark.createDataFrame(
        rows, "pass_no int, target string, threshold double, at_or_above long, rows_after long")
