"""Registered queries for keyed writes, incremental refresh, export and the
streaming ingest (A3, J6, M1-M5, K1-K6, P16, P17, T1).

The proxy daily table is split at a date: the older part plays the existing
table, the rest (with duplicates, late rows and corrections derived from data
properties) the incoming batch. Each query's oracle is the table the
operation must produce.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions.expr import month_key
from gaugeflow.operators import incremental, marts, upsert
from gaugeflow.plans import daily
from gaugeflow.plans import marts_plan as mp
from gaugeflow.plans.fixtures import RENDER_EPOCH, RENDER_SPAN_DAYS, render_gauge_files
from gaugeflow.plans.oracle import SNAPSHOT_SQL, marts_sql, with_ctes
from gaugeflow.plans.marts_plan import ProxyMarts
from gaugeflow.plans.proxy import PROXY_AS_OF, PROXY_MIN_DATE, PROXY_RAW_SQL
from gaugeflow.plans.registry import register
from gaugeflow.session import materialize, scratch_path
from gaugeflow.sinks import export
from gaugeflow.sources import landing
from gaugeflow.streaming import ingest

SPLIT = "2001-01-01"
OVERLAP_FROM = "2000-12-01"
# Watermark date for the tail-gap check: near the median start of the last 60
# rows per key, so some keys show a gap and others overlap.
GAP_SPLIT = "2001-01-15"
LOADED_AT = dt.datetime(2001, 7, 1, 6, 0, 0)
RAW_OUT = [S.KEY, S.DATE, *S.MEASURES]


def _d(s: str):
    return F.lit(s).cast("date")


def _late() -> F.Column:
    """Rows delivered late: a data property, about one row in twelve."""
    return F.col("vertedor_m3s") == 1.0


def _existing(raw: DataFrame) -> DataFrame:
    return raw.where((F.col(S.DATE) < _d(SPLIT)) & ~_late()).withColumn(
        "ingested_at", F.lit(dt.datetime(2001, 1, 1)).cast("timestamp"))


def _batch_with_duplicates(raw: DataFrame) -> DataFrame:
    """Batch rows (late ones included) plus a second, altered copy of every
    row from the overlap month that appears later in line order."""
    batch = raw.where((F.col(S.DATE) >= _d(OVERLAP_FROM)) | _late()).withColumn("line_order", F.lit(0))
    dup = (raw.where(F.col(S.DATE) >= _d(OVERLAP_FROM))
           .withColumn(S.VOLUME, F.col(S.VOLUME) + 1000.0).withColumn("line_order", F.lit(1)))
    return batch.unionByName(dup)


_WM_SQL = f"""
SELECT dam_key, max(fecha) AS max_fecha FROM raw
WHERE fecha < DATE '{SPLIT}' AND NOT vertedor_m3s = 1.0
GROUP BY dam_key
"""
_KEPT_BATCH = f"""
(r.fecha >= DATE '{OVERLAP_FROM}' OR r.vertedor_m3s = 1.0)
AND (wm.max_fecha IS NULL OR r.fecha > wm.max_fecha)
"""
_MEASURES_SQL = ", ".join(f"r.{m}" for m in S.MEASURES)

_NEW_DATES_SQL = with_ctes(
    f"""
    SELECT r.dam_key, r.fecha, {_MEASURES_SQL}
    FROM raw r LEFT JOIN wm USING (dam_key)
    WHERE (r.fecha < DATE '{SPLIT}' AND NOT r.vertedor_m3s = 1.0) OR ({_KEPT_BATCH})
    """, raw=PROXY_RAW_SQL, wm=_WM_SQL)


@register("j6_m2_m1_upsert_new_dates", _NEW_DATES_SQL)
def q_upsert_new_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default mode: batch rows at or before their key's watermark are dropped
    (late rows never land), duplicates inside the batch keep the first line."""
    raw = ProxyMarts(spark, sf_dir).raw
    batch = upsert.dedupe_batch(_batch_with_duplicates(raw), order=["line_order"]).drop("line_order")
    merged = upsert.merge_rows(_existing(raw), batch, mode="new_dates", loaded_at=LOADED_AT)
    return merged.select(*RAW_OUT)


@register("j6_after_watermark", with_ctes(
    f"""
    SELECT r.dam_key, r.fecha, {_MEASURES_SQL}
    FROM raw r LEFT JOIN wm USING (dam_key)
    WHERE {_KEPT_BATCH}
    """, raw=PROXY_RAW_SQL, wm=_WM_SQL))
def q_after_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch rows kept by the per-key watermark filter alone."""
    raw = ProxyMarts(spark, sf_dir).raw
    batch = raw.where((F.col(S.DATE) >= _d(OVERLAP_FROM)) | _late())
    return upsert.after_watermark(batch, upsert.watermarks(_existing(raw))).select(*RAW_OUT)


@register("s7_j6_tail_gaps", with_ctes(
    f"""
    SELECT t.dam_key, w.max_fecha, t.first_new_fecha, datediff('day', w.max_fecha, t.first_new_fecha) AS gap_days
    FROM (SELECT dam_key, min(fecha) AS first_new_fecha FROM (
              SELECT dam_key, fecha FROM raw
              QUALIFY row_number() OVER (PARTITION BY dam_key ORDER BY fecha DESC) <= {S.TAIL_ROWS}) x
          GROUP BY dam_key) t
    JOIN (SELECT dam_key, max(fecha) AS max_fecha FROM raw WHERE fecha < DATE '{GAP_SPLIT}' GROUP BY dam_key) w
      ON w.dam_key = t.dam_key
    WHERE t.first_new_fecha > w.max_fecha + INTERVAL 1 DAY
    """, raw=PROXY_RAW_SQL))
def q_tail_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose last 60 rows (a tail-trimmed fetch) start after the day
    following their watermark: the rows in between would never load."""
    from gaugeflow.operators.windows import latest_per_key

    raw = ProxyMarts(spark, sf_dir).raw
    tail = latest_per_key(raw, S.KEY, S.DATE, S.TAIL_ROWS)
    marks = upsert.watermarks(raw.where(F.col(S.DATE) < _d(GAP_SPLIT)))
    return upsert.watermark_gaps(tail, marks)


@register("m1_upsert_corrections", with_ctes(f"SELECT dam_key, fecha, {', '.join(S.MEASURES)} FROM raw",
                                             raw=PROXY_RAW_SQL))
def q_upsert_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``upsert`` mode: corrected values replace existing rows, late rows land."""
    raw = ProxyMarts(spark, sf_dir).raw
    existing = raw.where(F.col(S.DATE) < _d(SPLIT)).withColumn(
        S.VOLUME, F.when(_late(), F.lit(-1.0)).otherwise(F.col(S.VOLUME))).withColumn(
        "ingested_at", F.lit(dt.datetime(2001, 1, 1)).cast("timestamp"))
    batch = raw.where((F.col(S.DATE) >= _d(SPLIT)) | _late())
    return upsert.merge_rows(existing, batch, mode="upsert", loaded_at=LOADED_AT).select(*RAW_OUT)


@register("m1_upsert_partitioned_table", with_ctes(
    f"SELECT dam_key, fecha, {', '.join(S.MEASURES)} FROM raw", raw=PROXY_RAW_SQL))
def q_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a year-partitioned parquet table: only years with replaced
    rows are rewritten (staged, then dynamic partition overwrite); applied twice."""
    raw = ProxyMarts(spark, sf_dir).raw
    target = scratch_path(spark, "raw-table")
    existing = raw.where(F.col(S.DATE) < _d(SPLIT)).withColumn(
        S.VOLUME, F.when(_late(), F.lit(-1.0)).otherwise(F.col(S.VOLUME))).withColumn(
        "ingested_at", F.lit(dt.datetime(2001, 1, 1)).cast("timestamp"))
    upsert.create_table(existing, target)
    batch = raw.where((F.col(S.DATE) >= _d(SPLIT)) | _late())
    upsert.upsert_table(spark, target, batch, mode="upsert", loaded_at=LOADED_AT)
    upsert.upsert_table(spark, target, batch, mode="upsert", loaded_at=LOADED_AT)
    return ingest.read_raw(spark, target).select(*RAW_OUT)


APPEND_DAYS = ["2001-01-01", "2001-01-02", "2001-01-03"]
APPEND_FIX = "2000-12-31"


@register("m1_j6_appended_days", with_ctes(
    f"""
    SELECT dam_key, fecha, {', '.join(m if m != S.VOLUME else f"CASE WHEN fecha = DATE '{APPEND_FIX}' THEN -5.0 ELSE {m} END AS {m}" for m in S.MEASURES)},
           CASE WHEN fecha >= DATE '{APPEND_DAYS[0]}' THEN date_diff('day', DATE '{APPEND_DAYS[0]}', fecha) + 1
                WHEN fecha = DATE '{APPEND_FIX}' THEN 4 ELSE 0 END::INTEGER AS load,
           year(fecha) < year(DATE '{APPEND_FIX}') AND year(fecha) < year(DATE '{APPEND_DAYS[0]}')
             OR fecha >= DATE '{APPEND_DAYS[0]}' AS own_file
    FROM raw WHERE fecha <= DATE '{APPEND_DAYS[-1]}'
    """, raw=PROXY_RAW_SQL))
def q_appended_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days loaded one by one into a table of all earlier rows, then a
    corrected day of the year before. ``load``: which of them a row came with;
    ``own_file``: its file was written by that load and not since, so only the
    year with corrected rows was written anew."""
    raw = ProxyMarts(spark, sf_dir).raw.where(F.col(S.DATE) <= _d(APPEND_DAYS[-1]))
    target = scratch_path(spark, "appended")
    loads = [LOADED_AT + dt.timedelta(days=i) for i in range(len(APPEND_DAYS) + 2)]
    upsert.create_table(raw.where(F.col(S.DATE) < _d(APPEND_DAYS[0])).withColumn(
        "ingested_at", F.lit(loads[0]).cast("timestamp")), target)
    files = [set(spark.read.parquet(target).inputFiles())]
    for day, at in zip(APPEND_DAYS, loads[1:], strict=False):
        upsert.upsert_table(spark, target, raw.where(F.col(S.DATE) == _d(day)).drop("ingested_at"), loaded_at=at)
        files.append(set(spark.read.parquet(target).inputFiles()) - set().union(*files))
    fix = raw.where(F.col(S.DATE) == _d(APPEND_FIX)).withColumn(S.VOLUME, F.lit(-5.0)).drop("ingested_at")
    upsert.upsert_table(spark, target, fix, mode="upsert", loaded_at=loads[-1])
    born = spark.createDataFrame([("/".join(f.rsplit("/", 2)[1:]), i) for i, part in enumerate(files) for f in part], "name string, born int")
    rows = spark.read.parquet(target).select(*RAW_OUT, "ingested_at", F.substring_index("_metadata.file_path", "/", -2).alias("name"))
    load = F.datediff("ingested_at", F.lit(LOADED_AT)).cast("int")
    return rows.join(born, "name", "left").select(*RAW_OUT, load.alias("load"), F.coalesce(F.col("born") == load, F.lit(False)).alias("own_file"))


# ---- incremental fact --------------------------------------------------------

INCR_UNTIL = "2001-03-01"
INCR_LATE_FROM = "2001-02-24"
INCR_MISSING_STATE = "NATION 4"


def _partial_target(m: mp.ProxyMarts) -> DataFrame:
    """An older fact: built from the source before INCR_UNTIL, without late
    rows of its last days and without the entities of one state."""
    src, dim = m.staged, m.dim
    missing = dim.where(F.col("state") == INCR_MISSING_STATE).select(S.KEY)
    old = (src.where(F.col(S.DATE) < _d(INCR_UNTIL))
           .where(~((F.col(S.DATE) >= _d(INCR_LATE_FROM)) & _late()))
           .join(missing, S.KEY, "left_anti"))
    return marts.build_fact(old, dim)


def prepare_incremental(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source, older fact and dimension of :func:`q_incremental` (fixture step)."""
    m = mp.ProxyMarts(spark, sf_dir)
    return m.staged, materialize(spark, _partial_target(m), "fact-target"), m.dim


def refresh_prepared(source: DataFrame, target: DataFrame, dim: DataFrame) -> DataFrame:
    """The refresh itself (the operator step)."""
    return incremental.refresh_fact(source, target, dim)


@register("m3_incremental_fact", marts_sql("SELECT * FROM fct", "fct"))
def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental refresh == full refresh (late rows in the look-back window,
    entities new to the target, lag right at each window edge)."""
    return refresh_prepared(*prepare_incremental(spark, sf_dir))


@register("m3_m4_incremental_fact_table", marts_sql("SELECT * FROM fct", "fct"))
def q_incremental_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same as ``m3_incremental_fact`` on a year-partitioned table: only the
    years holding recomputed rows are rewritten in place."""
    m = mp.ProxyMarts(spark, sf_dir)
    path = scratch_path(spark, "fact-table")
    incremental.write_fact_table(_partial_target(m), path)
    incremental.refresh_fact_table(spark, m.staged, path, m.dim)
    return incremental.read_fact(spark, path).select(*S.FACT_COLUMNS)


def _refreshed(spark: SparkSession, m: mp.ProxyMarts, old: DataFrame, **kw) -> DataFrame:
    """The fact table made from ``old`` and refreshed from the whole source."""
    path = scratch_path(spark, "fact-table")
    incremental.write_fact_table(old, path)
    incremental.refresh_fact_table(spark, kw.pop("source", m.staged), path, m.dim, **kw)
    return incremental.read_fact(spark, path).select(*S.FACT_COLUMNS)


@register("m3_lagging_entities", marts_sql("SELECT * FROM fct", "fct"))
def q_lagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the entities stopped months before the others: their next
    rows are far older than the newest date of the fact and still arrive."""
    m = mp.ProxyMarts(spark, sf_dir)
    stops = F.pmod(F.crc32(S.KEY), F.lit(3)) == 0
    old = m.staged.where(F.col(S.DATE) < F.when(stops, _d("1999-06-01")).otherwise(_d(INCR_UNTIL)))
    return _refreshed(spark, m, marts.build_fact(old, m.dim))


@register("m3_corrections", marts_sql("SELECT * FROM fct", "fct"))
def q_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded since the last run count however old they are: corrected
    values (about one row in twelve, over all years) and rows that were missing."""
    m = mp.ProxyMarts(spark, sf_dir)
    missing = (F.dayofmonth(S.DATE) == 13) & ~_late()
    old = m.staged.where(~missing).withColumn(
        S.VOLUME, F.when(_late(), F.col(S.VOLUME) + 1000.0).otherwise(F.col(S.VOLUME)))
    loaded = F.when(_late() | missing, F.lit(LOADED_AT)).otherwise(F.lit(dt.datetime(2001, 1, 1)))
    return _refreshed(spark, m, marts.build_fact(old, m.dim), source=m.staged.withColumn("ingested_at", loaded),
                      since=dt.datetime(2001, 6, 1), seen_until=dt.date(2001, 6, 30))


@register("m3_capacity_change", marts_sql("SELECT * FROM fct", "fct"))
def q_capacity_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacities and states that changed in the dimension reach the rows of
    all years of their entities."""
    m = mp.ProxyMarts(spark, sf_dir)
    some = F.pmod(F.crc32(S.KEY), F.lit(4))
    before = m.dim.withColumn("namo_oficial_mm3", F.when(some == 0, F.col("namo_oficial_mm3") * 2).when(
        some == 1, F.lit(None)).otherwise(F.col("namo_oficial_mm3"))).withColumn(
        "state", F.when(some == 2, F.lit("ELSEWHERE")).otherwise(F.col("state")))
    return _refreshed(spark, m, marts.build_fact(m.staged, before))


# Corrections that take rows out of the staged table: a third of the late rows
# get -1, a third NULL, the others a new value; run dates before and after.
_LEAVING_RAW_SQL = f"""
SELECT * REPLACE (CASE WHEN vertedor_m3s <> 1.0 THEN volumen_alm_mm3
                       WHEN dayofmonth(fecha) % 3 = 0 THEN -1.0
                       WHEN dayofmonth(fecha) % 3 = 1 THEN NULL
                       ELSE volumen_alm_mm3 + 1000 END AS volumen_alm_mm3)
FROM ({PROXY_RAW_SQL})
"""
LEAVING_FIRST_RUN = dt.date(2001, 12, 31)


def _after_corrections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(dim, fact) of two daily runs. Between them a load corrects rows of all
    years, and adds rows of a year far ahead; the second run's date is earlier
    than the first one's, so rows leave for that reason too."""
    m = mp.ProxyMarts(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    loads = [dt.datetime(2001, 1, 1), LOADED_AT]
    upsert.create_table(m.raw.withColumn("ingested_at", F.lit(loads[0]).cast("timestamp")), f"{root}/raw")
    daily.build_marts(spark, root, m.catalog, LEAVING_FIRST_RUN, "first", min_date=PROXY_MIN_DATE, until=loads[0])
    third = F.dayofmonth(S.DATE) % 3
    fixes = m.raw.where(_late()).withColumn(S.VOLUME, F.when(third == 0, F.lit(-1.0)).when(third == 1, F.lit(None)).otherwise(
        F.col(S.VOLUME) + 1000.0))
    ahead = m.raw.where(_late() & (F.year(S.DATE) == 1998)).withColumn(S.DATE, F.add_months(S.DATE, 12 * 60))
    upsert.upsert_table(spark, f"{root}/raw", fixes.unionByName(ahead), mode="upsert", loaded_at=loads[1])
    _, dim, fact, _ = daily.build_marts(spark, root, m.catalog, dt.date.fromisoformat(PROXY_AS_OF), "second",
                                        min_date=PROXY_MIN_DATE, until=loads[1])
    return dim, fact


@register("m3_rows_leaving_source", marts_sql("SELECT * FROM fct", "fct", _LEAVING_RAW_SQL))
def q_rows_leaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a correction or the run date made invalid are gone from the
    refreshed fact, and the rows after them have the right previous value."""
    return _after_corrections(spark, sf_dir)[1].select(*S.FACT_COLUMNS)


@register("a1_a2_j3_stored_history", marts_sql("SELECT * FROM dim", "dim", _LEAVING_RAW_SQL))
def q_stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension from stored partial aggregates, of which the second run
    redid the touched slices, equals that of a full rebuild."""
    return _after_corrections(spark, sf_dir)[0]


@register("m5_evolve_written_table", marts_sql(
    """
    SELECT * REPLACE (CASE WHEN fecha < DATE '1999-01-01' THEN NULL ELSE pct_llenado_name END AS pct_llenado_name)
    FROM fct
    """, "fct"))
def q_evolve_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose older years were written before a column existed: after a
    refresh with new rows they have NULL in it, and all other years, those
    that the refresh did not touch included, keep their values."""
    m = mp.ProxyMarts(spark, sf_dir)
    path = scratch_path(spark, "fact-table")
    fact = m.fact_table.where(F.col(S.DATE) < _d(SPLIT)).withColumn(incremental.PARTITION_COL, F.year(S.DATE))
    added = F.col(S.DATE) >= _d("1999-01-01")
    upsert.write_partitions(fact.where(~added).drop("pct_llenado_name"), path)
    upsert.write_partitions(fact.where(added), path, mode="append")
    incremental.refresh_fact_table(spark, m.staged, path, m.dim, lookback_days=0)
    return incremental.read_fact(spark, path).select(*S.FACT_COLUMNS)


@register("m5_append_new_columns", marts_sql(
    f"""
    SELECT * REPLACE (CASE WHEN fecha < DATE '{SPLIT}' THEN NULL ELSE pct_llenado_name END AS pct_llenado_name)
    FROM fct
    """, "fct"))
def q_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows written before a column existed get NULL in it."""
    fact = mp.fact(spark, sf_dir)
    old = fact.where(F.col(S.DATE) < _d(SPLIT)).drop("pct_llenado_name")
    new = fact.where(F.col(S.DATE) >= _d(SPLIT))
    return incremental.evolve_union(old, new)


# ---- export ------------------------------------------------------------------

@register("k1_dim_parquet", marts_sql("SELECT * FROM dim", "dim"))
def q_dim_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export-dim")
    export.write_parquet(mp.dim(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("k2_l2_fact_by_state", marts_sql("SELECT * FROM fct WHERE state IS NOT NULL", "fct"))
def q_fact_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export-fact")
    # From the written fact: the range sort samples its input.
    export.write_fact_by_state(mp.ProxyMarts(spark, sf_dir).fact_table, path)
    return export.read_fact_by_state(spark, path)


@register("k4_monthly_archive", marts_sql(SNAPSHOT_SQL, "fct"))
def q_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive written on day 1 (the run on day 2 writes nothing), same month
    overwritten by a forced run."""
    root = scratch_path(spark, "export-archive")
    snap = mp.snapshot(spark, sf_dir)
    assert export.write_archive(snap, root, dt.date(2001, 7, 2)) is None
    month = export.write_archive(snap, root, dt.date(2001, 7, 1))
    export.write_archive(snap, root, dt.date(2001, 7, 15), force=True)
    return spark.read.parquet(f"{root}/archive/month={month}")


@register("p16_state_labels", marts_sql(
    """
    SELECT DISTINCT state, translate(state, ' /', '__') AS label, false AS label_collision
    FROM dim WHERE state IS NOT NULL
    """, "dim"))
def q_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.state_labels(mp.dim(spark, sf_dir))


@register("p17_month_keys", marts_sql(
    """
    SELECT strftime(fecha, '%Y-%m') AS month, count(*) AS fact_rows,
           count(*) FILTER (WHERE dayofmonth(fecha) = 1) AS day_one_rows
    FROM fct GROUP BY 1
    """, "fct"))
def q_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = mp.fact(spark, sf_dir)
    return fact.groupBy(month_key(S.DATE).alias("month")).agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.dayofmonth(S.DATE) == 1).alias("day_one_rows"),
    )


def _publish(spark: SparkSession, sf_dir: str):
    m = mp.ProxyMarts(spark, sf_dir)
    root = scratch_path(spark, "export")
    return export.export_all(spark, m.dim, m.fact_table, m.snapshot(), root, dt.date(2001, 7, 1),
                             generated_at=dt.datetime(2001, 7, 1, 6, 0, tzinfo=dt.timezone.utc))


_DATASETS_SQL = """
SELECT 'dim' AS dataset, NULL AS state, count(*) AS n, min(first_record_date) AS lo, max(last_record_date) AS hi FROM dim
UNION ALL SELECT 'snapshot', NULL, count(*), min(fecha), max(fecha) FROM snap
UNION ALL SELECT 'fct_by_state/state_part=' || translate(state, ' /', '__'), state, count(*), min(fecha), max(fecha)
FROM fct WHERE state IS NOT NULL GROUP BY state
"""


def _read_back(spark: SparkSession, current: str) -> DataFrame:
    """Rows and dates of each published directory, counted from its files."""
    def counted(sub: str, lo: str, hi: str) -> DataFrame:
        rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{current}/{sub}")
        name = F.regexp_extract(F.col("_metadata.file_path"), "/current/(.*)/[^/]*$", 1)
        return rows.select(name.alias("dataset"), F.col(lo).alias("lo"), F.col(hi).alias("hi")).groupBy("dataset").agg(
            F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    return counted("dim", "first_record_date", "last_record_date").unionByName(
        counted("snapshot", S.DATE, S.DATE)).unionByName(counted("fct_by_state", S.DATE, S.DATE))


@register("k3_k5_file_inventory", marts_sql(
    f"SELECT dataset, n, lo, hi, true AS sizes_match, true AS hashes_match FROM ({_DATASETS_SQL})", "snap"))
def q_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published file once in the written inventory, with the size and
    hash that its bytes have when they are read again; rows per data set."""
    run_dir, _ = _publish(spark, sf_dir)
    written = spark.read.schema("key string, size_bytes long, hash string, state string").json(f"{run_dir}/files")
    again = export.file_inventory(spark, f"{run_dir}/current")
    both = written.join(again.select(F.col("relpath").alias("key"), F.col("size_bytes").alias("size2"),
                                     F.col("hash").alias("hash2")), "key", "full_outer")
    per = both.groupBy(F.regexp_replace("key", "/[^/]*$", "").alias("dataset")).agg(
        F.min(F.col("size_bytes").eqNullSafe(F.col("size2"))).alias("sizes_match"),
        F.min(F.col("hash").eqNullSafe(F.col("hash2"))).alias("hashes_match"))
    return _read_back(spark, f"{run_dir}/current").join(per, "dataset").select(
        "dataset", "n", "lo", "hi", "sizes_match", "hashes_match")


_ENTRY = "struct<files:long,size_bytes:long,hash:string,state:string>"
_MANIFEST = (f"schema_version int, data_min_fecha date, data_max_fecha date, total_presas long, current map<string,{_ENTRY}>, "
             "latest_archive struct<month:string,size_bytes:long>, states_without_rows array<string>, total_bytes long")


@register("k6_manifest", marts_sql(
    f"""
    SELECT d.dataset, d.state, d.n, d.lo, d.hi, true AS sums_match, 1 AS schema_version, '2001-07' AS archive_month,
           (SELECT min(fecha) FROM fct) AS data_min_fecha, (SELECT max(fecha) FROM fct) AS data_max_fecha,
           (SELECT count(*) FROM snap) AS total_presas,
           (SELECT count(DISTINCT state) FROM dim WHERE state NOT IN (SELECT state FROM fct WHERE state IS NOT NULL))
               AS states_without_rows
    FROM ({_DATASETS_SQL}) d
    """, "snap"))
def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's entries: true state, rows re-read per directory, the
    date range, entity count and empty states; sizes and total checked against
    the files."""
    run_dir, manifest = _publish(spark, sf_dir)
    doc = manifest.select(F.from_json("manifest", _MANIFEST).alias("d")).select("d.*")
    entries = doc.select("*", F.explode("current").alias("dataset", "e"))
    sizes = export.file_inventory(spark, f"{run_dir}/current").groupBy(
        F.regexp_replace("relpath", "/[^/]*$", "").alias("dataset")).agg(
        F.sum("size_bytes").alias("size2"), F.count(F.lit(1)).alias("files2"))
    total = sizes.agg(F.sum("size2").alias("total2"))
    return entries.join(sizes, "dataset").join(_read_back(spark, f"{run_dir}/current"), "dataset").join(
        total, entries["total_bytes"] == total["total2"], "left").select(
        "dataset", "e.state", "n", "lo", "hi",
        ((F.col("e.size_bytes") == F.col("size2")) & (F.col("e.files") == F.col("files2"))
         & F.col("total2").isNotNull()).alias("sums_match"),
        "schema_version", F.col("latest_archive.month").alias("archive_month"), "data_min_fecha", "data_max_fecha",
        "total_presas", F.size("states_without_rows").cast("long").alias("states_without_rows"))


# ---- streaming ingest --------------------------------------------------------

_STREAM_KW = dict(key_pattern=r"dam_key=([^/]+)/", glob="*.txt", members=True)


@register("t1_streaming_ingest", with_ctes(
    f"SELECT dam_key, fecha, {', '.join(S.MEASURES)} FROM raw", raw=PROXY_RAW_SQL))
def q_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing runs, each picked up by a run-once stream: the first creates
    the raw table, the second upserts the newer rows."""
    raw = ProxyMarts(spark, sf_dir).raw
    root = scratch_path(spark, "stream")
    landing_dir, target, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/checkpoint"
    kw = dict(loaded_at=LOADED_AT, **_STREAM_KW)
    render_gauge_files(raw.where(F.col(S.DATE) < _d(SPLIT)), f"{landing_dir}/run_date=2001-01-01", S.GAUGE_HEADER, bundled=True)
    ingest.run_ingest(spark, landing_dir, target, ckpt, **kw)
    render_gauge_files(raw.where(F.col(S.DATE) >= _d(SPLIT)), f"{landing_dir}/run_date=2001-07-01", S.GAUGE_HEADER, bundled=True)
    ingest.run_ingest(spark, landing_dir, target, ckpt, **kw)
    return ingest.read_raw(spark, target).select(*RAW_OUT)


def _streamed_out_of_order(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """One run over files of every entity that land newest rows first, a
    quarter of the files per micro-batch."""
    raw = ProxyMarts(spark, sf_dir).raw
    root = scratch_path(spark, "stream")
    landing_dir, target, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/checkpoint"
    render_gauge_files(raw.where(F.col(S.DATE) >= _d(SPLIT)), f"{landing_dir}/a_newest", S.GAUGE_HEADER, bundled=True)
    render_gauge_files(raw.where(F.col(S.DATE) < _d(SPLIT)), f"{landing_dir}/b_older", S.GAUGE_HEADER, bundled=True)
    files = landing.scan_files(spark, landing_dir, _STREAM_KW["key_pattern"], _STREAM_KW["glob"], recursive=True).count()
    ingest.run_ingest(spark, landing_dir, target, ckpt, loaded_at=LOADED_AT,
                      max_files_per_trigger=max(1, files // 4), **_STREAM_KW)
    return target, ckpt


@register("t1_stream_out_of_order", with_ctes(
    f"SELECT dam_key, fecha, {', '.join(S.MEASURES)} FROM raw", raw=PROXY_RAW_SQL))
def q_stream_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No row falls under a watermark that the same run has raised."""
    target, _ = _streamed_out_of_order(spark, sf_dir)
    return ingest.read_raw(spark, target).select(*RAW_OUT)


@register("t1_stream_status", with_ctes(
    f"""
    SELECT dam_key, CASE WHEN fecha >= DATE '{SPLIT}' THEN 'a_newest' ELSE 'b_older' END AS run, 'ok' AS status,
           NULL AS reason, count(*) AS data_rows, cast(0 AS bigint) AS rejected_rows
    FROM raw GROUP BY dam_key, floor(datediff('day', DATE '{RENDER_EPOCH}', fecha) / {RENDER_SPAN_DAYS}), 2
    """, raw=PROXY_RAW_SQL))
def q_stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of every streamed file, kept per micro-batch."""
    _, ckpt = _streamed_out_of_order(spark, sf_dir)
    return ingest.file_status(spark, ckpt).select(
        S.KEY, F.regexp_extract("file", "/(a_newest|b_older)/", 1).alias("run"), "status", "reason", "data_rows", "rejected_rows")
