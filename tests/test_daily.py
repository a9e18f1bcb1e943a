"""The composed daily run over two landing runs equals a full rebuild."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators import marts, quality
from gaugeflow.plans import daily
from gaugeflow.plans.fixtures import RENDER_KEY_PATTERN, render_gauge_files
from gaugeflow.plans.proxy import proxy_catalog, proxy_raw
from gaugeflow.session import scratch_path
from tests.conftest import SF_SMALL


def test_two_daily_runs_equal_full_rebuild(spark):
    raw = proxy_raw(spark, SF_SMALL)
    cat = proxy_catalog(spark, SF_SMALL)
    root = scratch_path(spark, "t-daily")
    kw = dict(key_pattern=RENDER_KEY_PATTERN, glob="*.txt", recursive=True)
    split = F.lit("2001-01-01").cast("date")
    render_gauge_files(raw.where(F.col(S.DATE) < split), f"{root}/landing/run1", S.GAUGE_HEADER)
    r1 = daily.run_daily(spark, f"{root}/landing/run1", cat, f"{root}/wh", f"{root}/out",
                         dt.date(2001, 1, 1), **kw)
    assert {r.status for r in r1.status.collect()} == {"ok"}
    render_gauge_files(raw.where(F.col(S.DATE) >= split), f"{root}/landing/run2", S.GAUGE_HEADER)
    r2 = daily.run_daily(spark, f"{root}/landing/run2", cat, f"{root}/wh", f"{root}/out",
                         dt.date(2001, 12, 1), force_archive=True, **kw)
    fact = spark.read.parquet(f"{root}/wh/fact").drop("year")
    staged = marts.stage_daily(raw, as_of=dt.date(2001, 12, 1))
    full = marts.build_fact(staged, marts.build_dim(cat, staged))
    assert fact.count() == full.count()
    assert fact.select(*S.FACT_COLUMNS).exceptAll(full).count() == 0
    dq = {(r.table_name, r.check_name, r.columns): r.failures for r in r2.dq.collect()}
    assert dq[("fact", "unique_combination", "dam_key,fecha")] == 0
    assert dq[("snapshot", "unique", "dam_key")] == 0
    # The second run counted the years it wrote; the sums are those of all rows.
    rows = spark.read.parquet(f"{root}/wh/raw")
    scanned = quality.run_suite([t for t in quality.default_suite(cat, rows, cat, fact, cat) if t.name in ("raw", "fact")])
    assert {k: v for k, v in dq.items() if k[0] in ("raw", "fact")} == {
        (r.table_name, r.check_name, r.columns): r.failures for r in scanned.collect()}
    assert len(dq) == 17
    counts = spark.read.parquet(f"{root}/wh/raw_checks").where("check_name = 'rows'")
    assert counts.agg(F.sum("failures")).first()[0] == rows.count()
    doc = json.loads(r2.manifest.first().manifest)
    assert doc["latest_archive"]["month"] == "2001-12"
    assert doc["data_max_fecha"] == str(full.agg(F.max(S.DATE)).first()[0])


def test_daily_corrections_and_future_rows_reach_the_fact(spark):
    """A correction of an old day, a row dated after the run that loaded it,
    and a failed fact run: the next run's fact equals a full rebuild."""
    from gaugeflow.operators import upsert

    cat = proxy_catalog(spark, SF_SMALL)
    raw = proxy_raw(spark, SF_SMALL)
    root = scratch_path(spark, "t-daily-fix")
    t = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    upsert.create_table(raw.where(F.col(S.DATE) < F.lit("2001-03-01").cast("date")).withColumn("ingested_at", F.lit(t[0])), f"{root}/raw")
    daily.build_marts(spark, root, cat, dt.date(2001, 1, 15), "r1", until=t[0])
    fix = raw.where(F.year(S.DATE) == 1997).withColumn(S.VOLUME, F.col(S.VOLUME) + 1000.0)
    upsert.upsert_table(spark, f"{root}/raw", fix, mode="upsert", loaded_at=t[1])  # its fact run failed
    upsert.upsert_table(spark, f"{root}/raw", raw.where(F.col(S.DATE) >= F.lit("2001-03-01").cast("date")), loaded_at=t[2])
    raw2, dim, fact, _ = daily.build_marts(spark, root, cat, dt.date(2001, 12, 1), "r2", until=t[2])
    full = marts.build_fact(marts.stage_daily(raw2, as_of=dt.date(2001, 12, 1)), dim)
    got = fact.select(*S.FACT_COLUMNS)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert got.where(F.col(S.VOLUME) > 1000).count() > 0


def test_rows_that_leave_the_source(spark):
    """Corrections to -1 and NULL, rows dated ahead, a whole year that becomes
    invalid and an earlier run date: fact and dimension equal a full rebuild."""
    from gaugeflow.operators import upsert

    cat = proxy_catalog(spark, SF_SMALL)
    raw = proxy_raw(spark, SF_SMALL)
    root = scratch_path(spark, "t-daily-leave")
    t = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    upsert.create_table(raw.withColumn("ingested_at", F.lit(t[0])), f"{root}/raw")
    daily.build_marts(spark, root, cat, dt.date(2001, 12, 31), "r1", until=t[0])
    gone = F.when(F.year(S.DATE) == 1997, F.lit(-1.0)).when(F.dayofmonth(S.DATE) == 3, F.lit(None).cast("double"))
    fix = raw.withColumn("bad", (F.year(S.DATE) == 1997) | (F.dayofmonth(S.DATE) == 3)).where("bad").drop("bad")
    ahead = raw.where(F.year(S.DATE) == 1999).withColumn(S.DATE, F.add_months(S.DATE, 1200))
    upsert.upsert_table(spark, f"{root}/raw", fix.withColumn(S.VOLUME, gone).unionByName(ahead), mode="upsert", loaded_at=t[1])

    def equals_full(run_date, run_id, until):
        raw2, dim, fact, _ = daily.build_marts(spark, root, cat, run_date, run_id, until=until)
        staged = marts.stage_daily(raw2, as_of=run_date)
        full_dim = marts.build_dim(cat, staged)
        full = marts.build_fact(staged, full_dim)
        for a, b in ((fact.select(*S.FACT_COLUMNS), full), (dim, full_dim)):
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        return fact

    fact = equals_full(dt.date(2001, 3, 1), "r2", t[1])
    assert fact.where(F.year(S.DATE) == 1997).count() == 0 and fact.count() > 0
    fact = equals_full(dt.date(2120, 1, 1), "r3", t[2])
    assert fact.where(F.year(S.DATE) == 2099).count() > 0


def test_daily_run_reads_only_touched_years(spark):
    """A load of one day: the years read for history and fact are its own."""
    from gaugeflow.operators import incremental, upsert

    raw = proxy_raw(spark, SF_SMALL)
    root = scratch_path(spark, "t-daily-prune")
    t = [dt.datetime(2026, 1, d) for d in (1, 2)]
    upsert.create_table(raw.withColumn("ingested_at", F.lit(t[0])), f"{root}/raw")
    day = raw.where(F.col(S.DATE) == raw.where(F.year(S.DATE) == 1998).agg(F.max(S.DATE)).first()[0])
    upsert.upsert_table(spark, f"{root}/raw", day.withColumn(S.VOLUME, F.lit(7.0)), mode="upsert", loaded_at=t[1])
    staged = marts.stage_daily(spark.read.parquet(f"{root}/raw"), as_of=dt.date(2001, 12, 31))
    feed = upsert.changes_since(spark, f"{root}/raw", t[0])
    assert feed.count() == day.select(S.KEY).distinct().count()
    last = dt.date(2001, 12, 31)
    touched = incremental.touched_slices(staged, feed, feed, last, last)
    assert {r.year for r in touched.collect()} == {1998}
    rows = incremental.rows_of_slices(staged, touched)
    assert {r.year for r in rows.select("year").distinct().collect()} == {1998}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and S.VOLUME in line]
    assert scans and all("year#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
