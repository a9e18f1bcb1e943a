"""DuckDB oracle SQL for the registered queries.

Each statement runs on the benchmark tables as views and restates the
operator's result in plain SQL by another method than the Spark code: the
percentile by rank and interpolation, the previous value by row numbers, guarded
percentages by joining only what passes the guard.
"""

from __future__ import annotations

from gaugeflow.plans.proxy import PROXY_AS_OF, PROXY_CATALOG_SQL, PROXY_MIN_DATE, PROXY_RAW_SQL


def with_ctes(body: str, **ctes: str) -> str:
    parts = [f"{name} AS ({sql.strip()})" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


STG_SQL = f"""
SELECT * FROM raw
WHERE fecha >= DATE '{PROXY_MIN_DATE}'
  AND fecha <= DATE '{PROXY_AS_OF}'
  AND volumen_alm_mm3 >= 0
"""

# The exact percentile by position: with n ordered values it stands at
# (n - 1) * 0.99, between the values of the two ranks around it.
RANKED_SQL = """
SELECT dam_key, volumen_alm_mm3 AS v,
       row_number() OVER (PARTITION BY dam_key ORDER BY volumen_alm_mm3) - 1 AS rank,
       (count(*) OVER (PARTITION BY dam_key) - 1) * CAST(0.99 AS DOUBLE) AS pos
FROM stg
"""

P99_SQL = """
SELECT a.dam_key, CASE WHEN a.v = b.v THEN a.v ELSE (ceil(a.pos) - a.pos) * a.v + (a.pos - floor(a.pos)) * b.v END AS p99
FROM ranked AS a JOIN ranked AS b ON b.dam_key = a.dam_key AND a.rank = floor(a.pos) AND b.rank = ceil(b.pos)
"""

SPAN_SQL = """
SELECT dam_key, first_value(fecha) OVER days AS lo, last_value(fecha) OVER days AS hi,
       count(*) OVER days AS n, max(volumen_alm_mm3) OVER days AS top
FROM stg
WINDOW days AS (PARTITION BY dam_key ORDER BY fecha ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

HIST_SQL = """
SELECT DISTINCT sp.dam_key, sp.lo AS first_record_date, sp.hi AS last_record_date, sp.n AS total_records,
       sp.top AS max_volumen_historico_mm3, p99.p99 AS volumen_p99_mm3
FROM sp, p99 WHERE p99.dam_key = sp.dam_key
"""

# Percentages by joining only the entities whose capacity is positive.
GAP_SQL = """
SELECT cat.dam_key, round((hist.volumen_p99_mm3 - cat.namo_oficial_mm3) / cat.namo_oficial_mm3 * 100, 2) AS gap
FROM cat, hist WHERE hist.dam_key = cat.dam_key AND cat.namo_oficial_mm3 > 0
"""

DIM_SQL = """
SELECT cat.*, hist.* EXCLUDE (dam_key, volumen_p99_mm3), hist.volumen_p99_mm3 AS namo_estimado_mm3,
       gap.gap AS namo_p99_vs_oficial_pct
FROM cat LEFT JOIN hist USING (dam_key) LEFT JOIN gap USING (dam_key)
"""

# Rows numbered per entity; the previous value is the row one number lower.
NUMBERED_SQL = "SELECT *, row_number() OVER (PARTITION BY dam_key ORDER BY fecha) AS no FROM stg"

FILL_SQL = """
SELECT dam_key, which, cap FROM dim
UNPIVOT (cap FOR which IN (namo_oficial_mm3, name_oficial_mm3)) WHERE cap > 0
"""

FACT_SQL = """
SELECT n.dam_key, n.fecha, dim.state, n.volumen_alm_mm3, dim.namo_oficial_mm3, dim.name_oficial_mm3,
       round(n.volumen_alm_mm3 * 100.0 / a.cap, 2) AS pct_llenado, round(n.volumen_alm_mm3 * 100.0 / e.cap, 2) AS pct_llenado_name,
       n.precipitacion_mm, n.evaporacion_mm, n.obra_toma_m3s, n.vertedor_m3s, n.derrame_m3s,
       p.volumen_alm_mm3 AS volumen_prev_mm3, n.volumen_alm_mm3 - p.volumen_alm_mm3 AS delta_volumen_mm3
FROM num AS n
LEFT JOIN num AS p ON p.dam_key = n.dam_key AND p.no = n.no - 1
LEFT JOIN dim ON dim.dam_key = n.dam_key
LEFT JOIN fill AS a ON a.dam_key = n.dam_key AND a.which = 'namo_oficial_mm3'
LEFT JOIN fill AS e ON e.dam_key = n.dam_key AND e.which = 'name_oficial_mm3'
"""

# Newest row of each entity, with four dimension columns.
SNAPSHOT_SQL = """
SELECT f.*, d.dam_name_clean, d.latitude, d.longitude, d.municipality
FROM (SELECT * FROM fct QUALIFY row_number() OVER (PARTITION BY dam_key ORDER BY fecha DESC) = 1) AS f
LEFT JOIN dim AS d ON d.dam_key = f.dam_key
"""


def marts_ctes(upto: str, raw: str = PROXY_RAW_SQL) -> dict[str, str]:
    """The chain of common table expressions, cut after ``upto``."""
    chain = [
        ("raw", raw),
        ("cat", PROXY_CATALOG_SQL),
        ("stg", STG_SQL),
        ("ranked", RANKED_SQL),
        ("p99", P99_SQL),
        ("sp", SPAN_SQL),
        ("hist", HIST_SQL),
        ("gap", GAP_SQL),
        ("dim", DIM_SQL),
        ("num", NUMBERED_SQL),
        ("fill", FILL_SQL),
        ("fct", FACT_SQL),
        ("snap", SNAPSHOT_SQL),
    ]
    out = {}
    for name, sql in chain:
        out[name] = sql
        if name == upto:
            break
    return out


def marts_sql(body: str, upto: str, raw: str = PROXY_RAW_SQL) -> str:
    return with_ctes(body, **marts_ctes(upto, raw))
