"""Proxy inputs derived from the benchmark tables (TPC-H-like parquet).

The gauge domain has no public sample data, so every operator is exercised on
tables that Spark derives from the given ones; their size grows with the
scale factor:

* ``proxy_raw``: one daily row per supplier and ship date (entity = supplier),
  six measures from lineitem aggregates. Integer-valued sums and min/max only,
  so doubles are exact and independent of addition order.
* ``proxy_catalog``: one catalog row per supplier with nation/region as state
  and municipality, plus one entity without history. Suppliers of one nation
  are left out to exercise entities missing from the catalog, and one region
  gets NULL capacities to exercise the guards.
* ``proxy_capacity_report`` / ``proxy_seed_sheet``: the two catalog inputs in
  their pre-cleaning form (text cells, upstream names).

``PROXY_*_SQL`` are the same definitions in SQL that both Spark and DuckDB run;
the oracle queries use them as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Staging bounds used with the proxy tables (the run date is injected).
PROXY_MIN_DATE = "1996-01-01"
PROXY_AS_OF = "2001-06-30"
# Suppliers of this nation are absent from the proxy catalog.
PROXY_MISSING_NATION = "NATION_7"
# Suppliers of this region have no official capacity in the proxy catalog.
PROXY_NULL_CAPACITY_REGION = "EUROPE"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def proxy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily per-entity measures, grain (dam_key, fecha). One partial+final
    hash aggregate over lineitem by two numbers, the key's text made of the
    groups; only the columns used are read from the scan."""
    li = table(spark, sf_dir, "lineitem")
    daily = (
        li.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("fecha"))
        .agg(
            F.max("l_discount").alias("precipitacion_mm"),
            F.min("l_tax").alias("evaporacion_mm"),
            F.max("l_extendedprice").alias("obra_toma_m3s"),
            F.min("l_quantity").alias("vertedor_m3s"),
            F.when(F.count(F.lit(1)) > 1, F.max("l_quantity")).alias("derrame_m3s"),
            F.when(F.max("l_discount") >= 0.095, F.lit(None).cast("double"))
            .otherwise(F.sum("l_quantity") - 5.0)
            .alias("volumen_alm_mm3"),
        )
    )
    return daily.select(F.concat(F.lit("D"), F.col("l_suppkey").cast("string")).alias("dam_key"), *daily.columns[1:])


def proxy_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity catalog (dimension input) over supplier/nation/region."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    cat = (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .where(F.col("n_name") != PROXY_MISSING_NATION)
        .select(
            F.col("s_suppkey").cast("int").alias("numero"),
            F.concat(F.lit("D"), F.col("s_suppkey").cast("string")).alias("dam_key"),
            F.col("s_name").alias("dam_name_clean"),
            F.replace(F.col("n_name"), F.lit("_"), F.lit(" ")).alias("state"),
            F.col("r_name").alias("municipality"),
            F.col("n_nationkey").cast("double").alias("latitude"),
            (-F.col("n_regionkey")).cast("double").alias("longitude"),
            F.when(F.col("r_name") == PROXY_NULL_CAPACITY_REGION, F.lit(None).cast("double"))
            .otherwise(F.col("s_acctbal") / 100)
            .alias("namo_oficial_mm3"),
            (F.col("s_acctbal") / 80).alias("name_oficial_mm3"),
        )
    )
    extra = spark.createDataFrame(
        [(-1, "DNONE", "No history", "NATION 0", "NOWHERE", 0.0, 0.0, 1.0, 2.0)],
        cat.schema,
    )
    return cat.unionByName(extra)


PROXY_RAW_SQL = """
SELECT concat('D', cast(l_suppkey AS varchar))  AS dam_key,
       cast(l_shipdate AS date)                 AS fecha,
       max(l_discount)                          AS precipitacion_mm,
       min(l_tax)                               AS evaporacion_mm,
       max(l_extendedprice)                     AS obra_toma_m3s,
       min(l_quantity)                          AS vertedor_m3s,
       CASE WHEN count(*) > 1 THEN max(l_quantity) END AS derrame_m3s,
       CASE WHEN max(l_discount) >= 0.095 THEN NULL
            ELSE sum(l_quantity) - 5.0 END      AS volumen_alm_mm3
FROM lineitem
GROUP BY 1, 2
"""

PROXY_CATALOG_SQL = f"""
SELECT cast(s_suppkey AS int)                   AS numero,
       concat('D', cast(s_suppkey AS varchar))  AS dam_key,
       s_name                                   AS dam_name_clean,
       replace(n_name, '_', ' ')                AS state,
       r_name                                   AS municipality,
       cast(n_nationkey AS double)              AS latitude,
       cast(-n_regionkey AS double)             AS longitude,
       CASE WHEN r_name = '{PROXY_NULL_CAPACITY_REGION}' THEN NULL
            ELSE s_acctbal / 100 END            AS namo_oficial_mm3,
       s_acctbal / 80                           AS name_oficial_mm3
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE n_name <> '{PROXY_MISSING_NATION}'
UNION ALL
SELECT -1, 'DNONE', 'No history', 'NATION 0', 'NOWHERE',
       cast(0 AS double), cast(0 AS double), cast(1 AS double), cast(2 AS double)
"""
