"""The daily run, composed from the operators: land -> upsert raw -> marts ->
data-quality checks -> publish. This replaces the upstream sequence of
ingest script, model build and export script with plain function calls.

Warehouse layout under ``root`` (a shared folder)::

    root/raw/year=YYYY/        raw daily table (upserted, year partitions), raw_marks, raw_changes
    root/history/              statistics per entity and year, value counts
    root/dim/run=<run_id>/     dimension, rebuilt every run
    root/fact/year=YYYY/       daily fact (incremental, touched years rewritten)
    root/{raw,fact}_checks/    data-quality counts per year
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators import history, incremental, marts, quality, stored_checks, upsert
from gaugeflow.session import exists, materialize
from gaugeflow.sinks import export
from gaugeflow.sources import landing


@dataclass
class RunResult:
    status: DataFrame      # per landed file
    dq: DataFrame          # one row per check
    run_dir: str           # published run directory
    manifest: DataFrame    # one JSON row


def ingest(spark: SparkSession, landing_dir: str, root: str, mode: str = "new_dates",
           key_pattern: str = landing.STEM_PATTERN, glob: str = "*.csv", recursive: bool = False,
           aliases: dict[str, list[str]] | None = None, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Parse the landed files and upsert them into ``root/raw``; returns the
    per-file status."""
    lines = landing.scan_lines(spark, landing_dir, key_pattern, glob, recursive)
    files = landing.scan_files(spark, landing_dir, key_pattern, glob, recursive)
    rows, _, status = landing.load_lines(lines, aliases=aliases, files=files)
    batch = upsert.dedupe_batch(rows, order=["file", *landing.ORDER_COLS]).select(S.KEY, S.DATE, *S.MEASURES)
    raw_path = f"{root}/raw"
    if not exists(spark, raw_path):
        ts = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
        upsert.create_table(batch.withColumn("ingested_at", ts), raw_path)
    else:
        upsert.upsert_table(spark, raw_path, batch, mode=mode, loaded_at=loaded_at)
    return status


def build_marts(spark: SparkSession, root: str, catalog: DataFrame, run_date: dt.date,
                run_id: str, incremental_fact: bool = True,
                min_date: str = S.MIN_VALID_DATE,
                until: dt.datetime | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Dimension, fact (both from changed slices, or in full), snapshot (lazy).
    Returns (raw, dim, fact, snapshot).

    ``until`` is the load time of the newest raw rows. It is recorded once the
    fact holds them. The next run asks the raw table's change feed for the
    slices touched since, corrections and rows that became invalid included;
    loads of a run that failed before its fact are picked up too. The history
    statistics and the fact are made anew for these slices alone."""
    raw_path, fact_path, runs_path, history_path = (f"{root}/{x}" for x in ("raw", "fact", "fact_runs", "history"))
    raw = spark.read.parquet(raw_path)
    staged = marts.stage_daily(raw, as_of=run_date, min_date=min_date)
    touched = None
    if incremental_fact and exists(spark, runs_path) and exists(spark, fact_path):
        since, seen, bound = spark.read.parquet(runs_path).agg(
            F.max("until"), F.max_by("as_of", "until"), F.max_by("min_date", "until")).first()
        feed = upsert.changes_since(spark, raw_path, since)
        # Another lower bound changes slices that no load has touched.
        if feed is not None and bound == str(min_date):
            slices = incremental.fact_slices(spark, fact_path)
            touched = materialize(spark, incremental.touched_slices(staged, slices, feed, seen, run_date), "touched")
    if touched is None:
        history.write_history(staged, history_path)
    else:
        history.refresh_history(spark, staged, history_path, touched)
    dim_path = f"{root}/dim/run={run_id}"
    marts.dim_of(catalog, history.read_history(spark, history_path)).write.parquet(dim_path)
    dim = spark.read.parquet(dim_path)
    if touched is None:
        incremental.write_fact_table(marts.build_fact(staged, dim), fact_path)
    else:
        incremental.refresh_fact_table(spark, staged, fact_path, dim, touched=touched)
    if until is not None:
        spark.range(1).select(F.lit(until).cast("timestamp").alias("until"), F.lit(run_date).alias("as_of"),
                              F.lit(str(min_date)).alias("min_date")).write.mode("append").parquet(runs_path)
    # Years rewritten after a column was added carry it; the others do not.
    fact = incremental.read_fact(spark, fact_path).drop(incremental.PARTITION_COL)
    return raw.drop(upsert.PARTITION_COL), dim, fact, marts.build_snapshot(fact, dim)


def run_daily(spark: SparkSession, landing_dir: str, catalog: DataFrame, root: str, export_root: str,
              run_date: dt.date, force_archive: bool = False, **ingest_kw) -> RunResult:
    """One full run. The DQ result (17 rows) is returned, not raised on:
    callers decide which failures block a publish."""
    root = root.rstrip("/")
    run_id = export.new_run_id(run_date)
    loaded_at = ingest_kw.pop("loaded_at", None) or dt.datetime.now()
    status = ingest(spark, landing_dir, root, loaded_at=loaded_at, **ingest_kw)
    raw, dim, fact, snapshot = build_marts(spark, root, catalog, run_date, run_id, until=loaded_at)
    snapshot = materialize(spark, snapshot, "snapshot")  # read by its checks and the export
    dq = stored_checks.run_stored_suite(spark, quality.default_suite(catalog, raw, dim, fact, snapshot),
                                        {"raw": f"{root}/raw", "fact": f"{root}/fact"})
    run_dir, manifest = export.export_all(spark, dim, fact, snapshot, export_root, run_date, force_archive,
                                          slices=incremental.fact_slices(spark, f"{root}/fact"))
    return RunResult(status, dq, run_dir, manifest)
