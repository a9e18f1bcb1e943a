"""Registered queries for the catalog side path.

The catalog sheet and the capacity report are rendered from
supplier/nation/region (one row per supplier) under the shared folder and
read back with the real readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow import schemas as S
from gaugeflow.operators import catalog as cat_ops
from gaugeflow.plans.fixtures import REPORT_MISSING_NATION, render_capacity_report, render_sheet
from gaugeflow.plans.oracle import with_ctes
from gaugeflow.plans.registry import register
from gaugeflow.session import scratch_path
from gaugeflow.sinks.catalog import write_catalog_csv
from gaugeflow.sources import catalog as cat_src

_SUP_SQL = """
SELECT * FROM supplier
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

_KEY_SQL = "'D' || cast(s_suppkey AS varchar) || 'N' || lpad(cast(n_nationkey AS varchar), 2, '0')"

_NAMED_SQL = """
SELECT *, CASE WHEN r_name = 'ASIA' THEN s_name
               ELSE s_name || ', ' || upper(substr(r_name, 1, 1)) || lower(substr(r_name, 2, 2)) || '.'
          END AS dname
FROM sup
"""

_SEED_SQL = f"""
SELECT cast(s_suppkey AS int)                                  AS numero,
       {_KEY_SQL}                                              AS dam_key,
       lpad(cast(n_nationkey AS varchar), 2, '0')              AS state_code,
       dname                                                   AS dam_name,
       regexp_replace(dname, ',\\s*[A-Z][a-z.]+\\.?\\s*$', '')  AS dam_name_clean,
       n_name                                                  AS state,
       CASE WHEN r_name = 'AFRICA' THEN NULL ELSE r_name END   AS municipality,
       CASE WHEN s_acctbal < 0 THEN NULL
            ELSE cast(n_nationkey AS double) + 0.5 END         AS latitude,
       cast(-n_regionkey AS double)                            AS longitude,
       cast(floor(s_acctbal) AS double)                        AS altitude_m,
       cast(n_regionkey AS int)                                AS basin_id,
       r_name                                                  AS basin_name,
       CASE WHEN r_name = 'AMERICA' THEN NULL
            ELSE cast(n_nationkey AS int) END                  AS hydro_region_id,
       n_name                                                  AS hydro_region_name
FROM named
"""

_CAPACITY_SQL = f"""
SELECT {_KEY_SQL}                                              AS dam_key,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal / 100 END AS namo_oficial_mm3,
       cast(n_nationkey + 1000 AS double)                      AS name_elev_msnm,
       s_acctbal / 80                                          AS name_oficial_mm3,
       cast(n_nationkey + 990 AS double)                       AS namo_elev_msnm,
       cast(s_nationkey AS double)                             AS altura_cortina_m,
       cast(n_regionkey + 1005 AS double)                      AS elev_corona_msnm,
       CASE WHEN r_name = 'EUROPE' THEN NULL
            ELSE cast(n_nationkey + 1950 AS int) END           AS inicio_operacion,
       r_name                                                  AS corriente,
       n_name                                                  AS uso,
       'LIBRE'                                                 AS tipo_vertedor,
       s_name                                                  AS nombre_comun
FROM sup
"""

_JOIN_CAPACITY_SQL = f"{_CAPACITY_SQL} WHERE n_name <> '{REPORT_MISSING_NATION}'"

_ENRICHED_SQL = f"""
SELECT {", ".join(S.CATALOG_COLUMNS)}
FROM seed LEFT JOIN cap USING (dam_key)
"""


def _ctes(**extra: str) -> dict[str, str]:
    return {"sup": _SUP_SQL, "named": _NAMED_SQL, "seed": _SEED_SQL, "cap": _JOIN_CAPACITY_SQL, **extra}


def cleaned_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "catalog-sheet")
    render_sheet(spark, sf_dir, path)
    return cat_ops.clean_sheet(cat_src.read_sheet(spark, path))


def capacities(spark: SparkSession, sf_dir: str, without: str | None = REPORT_MISSING_NATION) -> DataFrame:
    path = scratch_path(spark, "capacity-report")
    render_capacity_report(spark, sf_dir, path, without)
    return cat_ops.coerce_capacities(cat_src.read_capacity_report(spark, path, multi_line=False))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat_ops.enrich(cleaned_seed(spark, sf_dir), capacities(spark, sf_dir))


@register("p1_p8_catalog_clean", with_ctes("SELECT * FROM seed", **_ctes()))
def q_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_seed(spark, sf_dir)


@register("s8_k7_seed_roundtrip", with_ctes(
    "SELECT * REPLACE (cast(altitude_m AS int) AS altitude_m) FROM seed", **_ctes()))
def q_seed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "seed-csv")
    write_catalog_csv(cleaned_seed(spark, sf_dir), path, cat_src.seed_schema())
    return cat_src.read_seed(spark, path)


@register("s9_p3_p4_capacity_scan", with_ctes("SELECT * FROM cap", **_ctes(cap=_CAPACITY_SQL)))
def q_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacities(spark, sf_dir, without=None)


@register("s10_ordered_keys", with_ctes("SELECT dam_key, numero FROM seed ORDER BY numero", **_ctes()))
def q_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat_src.ordered_keys(cleaned_seed(spark, sf_dir))


@register("j1_catalog_enrich", with_ctes(_ENRICHED_SQL, **_ctes()))
def q_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir)


@register("j2_match_summary", with_ctes(
    "SELECT count(namo_oficial_mm3) AS matched, count(*) AS total FROM enr", **_ctes(enr=_ENRICHED_SQL)))
def q_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat_ops.match_summary(enriched(spark, sf_dir))


@register("j2_unmatched", with_ctes(
    "SELECT dam_key, dam_name_clean FROM enr WHERE namo_oficial_mm3 IS NULL", **_ctes(enr=_ENRICHED_SQL)))
def q_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat_ops.unmatched(enriched(spark, sf_dir))


@register("k7_enriched_catalog_csv", with_ctes(
    "SELECT * REPLACE (cast(altitude_m AS int) AS altitude_m) FROM enr", **_ctes(enr=_ENRICHED_SQL)))
def q_enriched_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched catalog written as CSV with declared types and read back;
    enriching the written catalog again gives the same table."""
    path = scratch_path(spark, "catalog-csv")
    write_catalog_csv(enriched(spark, sf_dir), path, S.CATALOG_SCHEMA)
    back = spark.read.schema(S.CATALOG_SCHEMA).option("header", True).csv(path)
    return cat_ops.enrich(back, capacities(spark, sf_dir))
