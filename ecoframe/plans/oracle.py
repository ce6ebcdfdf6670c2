"""DuckDB SQL for the same stages, used as an independent oracle.

Built from CTE fragments so each query is the cleaning chain up to the stage
it needs followed by its own SELECT.  Only standard SQL plus a few DuckDB
built-ins (``quantile_cont``, ``round_even``, ``md5``).
"""

from __future__ import annotations

from ecoframe.schema import (
    FUEL_DROP_AFTER_MAP, FUEL_DROP_EARLY, IQR_FACTOR, OUTLIER_GROUP, OUTLIER_ORDER, PROCESSED_COLUMNS,
    RAW_COLUMNS, rules,
)
from ecoframe.sources.fixtures import VEHICLES_RAW_SQL


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {col} END"


def first_match_sql(col: str, brands: list) -> str:
    whens = " ".join(f"WHEN contains({col}, {q(b)}) THEN {q(b)}" for b in brands)
    return f"CASE {whens} ELSE {col} END"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


RAW_COLS = ", ".join(RAW_COLUMNS)
PROC_COLS = ", ".join(PROCESSED_COLUMNS)


def ctes(stage: str = "final", rule: str = "v2") -> list:
    """(name, sql) pairs from the raw fixture up to ``stage``."""
    r = rules(rule)
    out = [("raw", VEHICLES_RAW_SQL)]
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS)
    sel = ", ".join("CAST(year AS INTEGER) AS year" if c == "year" else c for c in RAW_COLUMNS)
    out.append(("src", f"SELECT DISTINCT {sel} FROM raw WHERE {notnull}"))
    if stage == "src":
        return out
    key = [c for c in RAW_COLUMNS if c not in ("cn", "year")]
    out.append(("dedup", f"SELECT {RAW_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} "
                         f"ORDER BY year, cn) AS rn FROM src) WHERE rn = 1"))
    if stage == "dedup":
        return out
    drop_early = " AND ".join(f"lower(ft) IS DISTINCT FROM {q(v)}" for v in FUEL_DROP_EARLY)
    out.append(("fuel0", f"SELECT * REPLACE (lower(ft) AS ft) FROM dedup WHERE {drop_early}"))
    drop_after = " AND ".join(f"ft IS DISTINCT FROM {q(v)}" for v in FUEL_DROP_AFTER_MAP)
    out.append(("fuel1", f"SELECT * REPLACE ({case_map('ft', r.fuel_map)} AS ft) FROM fuel0"))
    out.append(("fuel", f"SELECT * FROM fuel1 WHERE {drop_after}"))
    if stage == "fuel":
        return out
    out.append(("brand0", f"SELECT * REPLACE ({first_match_sql('upper(mk)', r.brands)} AS mk) FROM fuel"))
    out.append(("brand1", f"SELECT * REPLACE ({case_map('mk', r.brand_map)} AS mk) FROM brand0"))
    out.append(("brand", f"SELECT * FROM brand1 WHERE NOT coalesce(mk IN ({in_list(r.deny)}), false)"))
    if stage == "brand":
        return out
    out.append(("rare", f"SELECT * FROM brand WHERE mk IN "
                        f"(SELECT mk FROM brand GROUP BY mk HAVING count(*) >= {r.rare_min})"))
    if stage == "rare":
        return out
    prev = "rare"
    for i, t in enumerate(OUTLIER_ORDER, start=1):
        out += outlier_pass_ctes(prev, f"p{i}", t)
        prev = f"p{i}"
    if stage == "chain":
        return out
    final_drop = " AND ".join(f"ft IS DISTINCT FROM {q(v)}" for v in r.fuel_drop_final)
    out.append(("final", f"SELECT {PROC_COLS} FROM {prev} WHERE {final_drop}"))
    return out


def outlier_pass_ctes(src: str, name: str, t: str, group=OUTLIER_GROUP, keep_cols=RAW_COLUMNS) -> list:
    g = ", ".join(group)
    on = " AND ".join(f"p.{c} = m.{c}" for c in group)
    cols = ", ".join(keep_cols)
    return [
        (f"{name}_m", f"SELECT {g}, avg({t}) AS {t}_mean FROM {src} GROUP BY {g}"),
        (f"{name}_j", f"SELECT p.*, m.{t}_mean, abs(p.{t} - m.{t}_mean) AS diff_{t} "
                      f"FROM {src} p LEFT JOIN {name}_m m ON {on}"),
        (f"{name}_s", f"SELECT round_even((q3 + {IQR_FACTOR} * (q3 - q1)) * 10, 0) / 10 AS seuil FROM "
                      f"(SELECT quantile_cont(diff_{t}, 0.25) AS q1, quantile_cont(diff_{t}, 0.75) AS q3 "
                      f"FROM {name}_j)"),
        (name, f"SELECT {cols} FROM {name}_j, {name}_s WHERE diff_{t} <= seuil"),
    ]


def with_ctes(pairs: list, select: str) -> str:
    body = ",\n".join(f"{n} AS (\n{s}\n)" for n, s in pairs)
    return f"WITH {body}\n{select}"


def stage_sql(stage: str, select: str, rule: str = "v2") -> str:
    return with_ctes(ctes(stage, rule), select)


def thresholds_sql(rule: str = "v2") -> str:
    pairs = ctes("chain", rule)
    parts = []
    prev = "rare"
    for i, t in enumerate(OUTLIER_ORDER, start=1):
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS pass_no, {q(t)} AS target, s.seuil AS threshold, "
            f"(SELECT count(*) FROM p{i}_j, p{i}_s WHERE diff_{t} >= p{i}_s.seuil) AS at_or_above, "
            f"(SELECT count(*) FROM p{i}) AS rows_after FROM p{i}_s s")
        prev = f"p{i}"
    return with_ctes(pairs, "\nUNION ALL\n".join(parts))
