"""Stored partial aggregates of the history (A1, A2), so that a daily run does
not read all of it.

Two tables stand under one path, both by slice, that is key and year:

* ``slices``: first and last date, rows and largest value;
* ``values``: rows per value, in year partitions.

They hold what the staged rows gave at the last run. A run makes the slices
anew in which the source changed (see :mod:`gaugeflow.operators.incremental`)
from the rows of those years, replaces them, and merges slices to one row per
key: minima, maxima and sums, and the exact percentile of the merged value
counts. Keys without a changed slice keep the percentile of the run before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators.incremental import SLICE, rows_of_slices
from gaugeflow.operators.percentile import percentile_of_counts, value_counts
from gaugeflow.operators.upsert import PARTITION_COL, drop_partitions, write_partitions
from gaugeflow.session import exists, materialize

P99 = "volumen_p99_mm3"


def slice_stats(daily: DataFrame) -> DataFrame:
    """A1 per key and year of rows that have a year column."""
    return daily.groupBy(*SLICE).agg(
        F.min(S.DATE).alias("first_date"), F.max(S.DATE).alias("last_date"),
        F.count(F.lit(1)).alias("rows"), F.max(S.VOLUME).alias("top"))


def _paths(path: str) -> tuple[str, str, str]:
    root = path.rstrip("/")
    return f"{root}/slices", f"{root}/values", f"{root}/percentiles"


def write_history(daily: DataFrame, path: str, quantile: float = S.CAPACITY_QUANTILE) -> None:
    """Both tables and the percentiles from all staged rows."""
    spark = daily.sparkSession
    slices, values, percentiles = _paths(path)
    rows = daily.where(F.col(S.VOLUME).isNotNull()).select(S.KEY, F.year(S.DATE).alias(PARTITION_COL), S.DATE, S.VOLUME)
    write_partitions(value_counts(rows, SLICE, S.VOLUME), values)
    slice_stats(rows).write.mode("overwrite").parquet(slices)
    _percentiles(spark.read.parquet(values), quantile).write.mode("overwrite").parquet(percentiles)


def _percentiles(values: DataFrame, quantile: float) -> DataFrame:
    merged = values.groupBy(S.KEY, S.VOLUME).agg(F.sum("_c").alias("_c"))
    return percentile_of_counts(merged, S.KEY, S.VOLUME, quantile).withColumnRenamed("percentile", P99)


def refresh_history(spark: SparkSession, daily: DataFrame, path: str, touched: DataFrame,
                    quantile: float = S.CAPACITY_QUANTILE) -> None:
    """Make the slices ``touched`` (a written table) anew from the staged
    rows ``daily``. Of the rows, and of the value counts that are replaced,
    only the years of those slices are read."""
    if not exists(spark, _paths(path)[0]):
        return write_history(daily, path, quantile)
    slices, values, percentiles = _paths(path)
    years = [r[0] for r in touched.select(PARTITION_COL).distinct().collect()]  # one per year
    if not years:
        return None
    rows = materialize(spark, rows_of_slices(daily.where(F.col(S.VOLUME).isNotNull()), touched).select(
        *SLICE, S.DATE, S.VOLUME), "history-rows")
    kept = spark.read.parquet(slices).join(touched, SLICE, "left_anti")
    fresh = materialize(spark, kept.unionByName(slice_stats(rows)), "history-slices")
    left = {r[0] for r in fresh.select(PARTITION_COL).distinct().collect()}  # one per year
    counts = spark.read.parquet(values).where(F.col(PARTITION_COL).isin(years)).join(touched, SLICE, "left_anti")
    write_partitions(counts.unionByName(value_counts(rows, SLICE, S.VOLUME)), values, dynamic=True)
    drop_partitions(spark, values, [y for y in years if y not in left])
    keys = touched.select(S.KEY).distinct()
    anew = _percentiles(spark.read.parquet(values).join(keys, S.KEY, "left_semi"), quantile)
    merged = spark.read.parquet(percentiles).join(keys, S.KEY, "left_anti").unionByName(anew)
    materialize(spark, merged, "history-percentiles").write.mode("overwrite").parquet(percentiles)
    # The slices last: they say what the run has made.
    fresh.write.mode("overwrite").parquet(slices)
    return None


def history_slices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(_paths(path)[0])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per key, the columns of :func:`gaugeflow.operators.marts.history_stats`."""
    stats = history_slices(spark, path).groupBy(S.KEY).agg(
        F.min("first_date").alias("first_record_date"), F.max("last_date").alias("last_record_date"),
        F.sum("rows").alias("total_records"), F.max("top").alias("max_volumen_historico_mm3"))
    return stats.join(spark.read.parquet(_paths(path)[2]), S.KEY, "left")
