"""Registered queries for staging, marts, aggregates, windows, top-k and the
data-quality suite over the proxy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S

from gaugeflow.operators import marts, quality, stored_checks, upsert
from gaugeflow.plans import marts_plan as mp
from gaugeflow.plans.oracle import SNAPSHOT_SQL, marts_ctes, marts_sql, with_ctes
from gaugeflow.plans.proxy import PROXY_RAW_SQL, proxy_raw
from gaugeflow.plans.registry import register
from gaugeflow.session import scratch_path
from gaugeflow.sinks import export


@register("p11_stage_daily", marts_sql("SELECT * FROM stg", "stg"))
def q_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mp.staged(spark, sf_dir)


@register("a1_a2_history_stats", marts_sql("SELECT * FROM hist", "hist"))
def q_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.history_stats(mp.staged(spark, sf_dir))


@register("a2_percentile_hot_key_path", marts_sql("SELECT * FROM hist", "hist"))
def q_hist_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History stats whose percentile runs over a written raw table: every key
    takes the range-partitioned path, whatever its size."""
    return marts.history_stats(mp.ProxyMarts(spark, sf_dir).staged)


@register("j3_p13_dim", marts_sql("SELECT * FROM dim", "dim"))
def q_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mp.dim(spark, sf_dir)


@register("j4_p12_w1_w2_fact", marts_sql("SELECT * FROM fct", "fct"))
def q_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mp.fact(spark, sf_dir)


@register("w3_j5_p15_snapshot", marts_sql(SNAPSHOT_SQL, "fct"))
def q_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mp.snapshot(spark, sf_dir)


@register("l1_top_capacity", marts_sql(
    """
    SELECT dam_key, dam_name_clean, namo_oficial_mm3, namo_estimado_mm3,
           CASE WHEN namo_oficial_mm3 > 0
                THEN (namo_estimado_mm3 - namo_oficial_mm3) / namo_oficial_mm3 * 100 END AS diff_pct
    FROM dim
    WHERE namo_oficial_mm3 IS NOT NULL AND namo_estimado_mm3 IS NOT NULL
    ORDER BY namo_oficial_mm3 DESC, dam_key
    LIMIT 10
    """, "dim"))
def q_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_capacity(mp.dim(spark, sf_dir), 10)


@register("a4_global_stats", marts_sql(
    """
    SELECT (SELECT count(DISTINCT dam_key) FROM fct) AS total_presas,
           (SELECT min(fecha) FROM fct)        AS data_min_fecha,
           (SELECT max(fecha) FROM fct)        AS data_max_fecha,
           (SELECT count(*) FROM fct)          AS fact_rows
    """, "fct"))
def q_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mp.ProxyMarts(spark, sf_dir)
    return export.global_stats(m.fact_table, m.snapshot())


@register("a5_distinct_states", marts_sql(
    "SELECT DISTINCT state FROM dim WHERE state IS NOT NULL", "dim"))
def q_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.distinct_states(mp.dim(spark, sf_dir))


@register("a3_watermarks", with_ctes(
    "SELECT dam_key, max(fecha) AS max_fecha FROM raw GROUP BY dam_key", raw=PROXY_RAW_SQL))
def q_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.operators.upsert import watermarks

    return watermarks(proxy_raw(spark, sf_dir))


_DQ_BODY = """
SELECT 'catalog' AS table_name, 'not_null' AS check_name, 'dam_key' AS columns,
       count(*) FILTER (WHERE dam_key IS NULL) AS failures FROM cat
UNION ALL SELECT 'catalog', 'not_null', 'numero', count(*) FILTER (WHERE numero IS NULL) FROM cat
UNION ALL SELECT 'catalog', 'not_null', 'latitude', count(*) FILTER (WHERE latitude IS NULL) FROM cat
UNION ALL SELECT 'catalog', 'not_null', 'longitude', count(*) FILTER (WHERE longitude IS NULL) FROM cat
UNION ALL SELECT 'catalog', 'not_null', 'namo_oficial_mm3',
                 count(*) FILTER (WHERE namo_oficial_mm3 IS NULL) FROM cat
UNION ALL SELECT 'catalog', 'not_null', 'name_oficial_mm3',
                 count(*) FILTER (WHERE name_oficial_mm3 IS NULL) FROM cat
UNION ALL SELECT 'catalog', 'unique', 'dam_key', count(*) FROM (
    SELECT dam_key FROM cat WHERE dam_key IS NOT NULL GROUP BY dam_key HAVING count(*) > 1) u1
UNION ALL SELECT 'catalog', 'unique', 'numero', count(*) FROM (
    SELECT numero FROM cat WHERE numero IS NOT NULL GROUP BY numero HAVING count(*) > 1) u2
UNION ALL SELECT 'raw', 'not_null', 'dam_key', count(*) FILTER (WHERE dam_key IS NULL) FROM raw
UNION ALL SELECT 'raw', 'not_null', 'fecha', count(*) FILTER (WHERE fecha IS NULL) FROM raw
UNION ALL SELECT 'dim', 'not_null', 'dam_key', count(*) FILTER (WHERE dam_key IS NULL) FROM dim
UNION ALL SELECT 'dim', 'unique', 'dam_key', count(*) FROM (
    SELECT dam_key FROM dim WHERE dam_key IS NOT NULL GROUP BY dam_key HAVING count(*) > 1) u3
UNION ALL SELECT 'fact', 'not_null', 'dam_key', count(*) FILTER (WHERE dam_key IS NULL) FROM fct
UNION ALL SELECT 'fact', 'not_null', 'fecha', count(*) FILTER (WHERE fecha IS NULL) FROM fct
UNION ALL SELECT 'fact', 'unique_combination', 'dam_key,fecha', count(*) FROM (
    SELECT dam_key, fecha FROM fct GROUP BY dam_key, fecha HAVING count(*) > 1) u4
UNION ALL SELECT 'snapshot', 'not_null', 'dam_key', count(*) FILTER (WHERE dam_key IS NULL) FROM snap
UNION ALL SELECT 'snapshot', 'unique', 'dam_key', count(*) FROM (
    SELECT dam_key FROM snap WHERE dam_key IS NOT NULL GROUP BY dam_key HAVING count(*) > 1) u5
"""

_SNAP_CTE = """
SELECT * FROM fct QUALIFY row_number() OVER (PARTITION BY dam_key ORDER BY fecha DESC) = 1
"""

_DQ_SQL = with_ctes(_DQ_BODY, **marts_ctes("fct"), snap=_SNAP_CTE)


@register("q1_q2_q3_q4_dq_suite", _DQ_SQL)
def q_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mp.ProxyMarts(spark, sf_dir)
    return quality.run_suite(quality.default_suite(m.catalog, m.raw, m.dim, m.fact_table, m.snapshot()))


@register("q1_q3_q4_stored_checks", _DQ_SQL)
def q_stored_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite from stored counts. The tables are first counted without their
    last years and then hold all rows; only what was added is counted then."""
    m = mp.ProxyMarts(spark, sf_dir)
    paths = {"raw": scratch_path(spark, "q-checks-raw"), "fact": scratch_path(spark, "q-checks-fact")}
    suite = quality.default_suite(m.catalog, m.raw, m.dim, m.fact_table, m.snapshot())
    late = F.col(S.DATE) >= F.lit("1997-01-01").cast("date")
    for t in suite:
        if t.name in paths:
            upsert.write_partitions(upsert.with_partition(t.df.where(~late)), paths[t.name])
            stored_checks.refresh_counts(spark, paths[t.name], t)
            upsert.write_partitions(upsert.with_partition(t.df.where(late)), paths[t.name], dynamic=True)
    return stored_checks.run_stored_suite(spark, suite, paths)
