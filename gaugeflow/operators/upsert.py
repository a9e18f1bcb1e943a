"""Per-key watermark, batch de-duplication and keyed upsert.

Parquet tables have no MERGE. Where a batch replaces rows, the upsert is
``existing ⟕anti batch ∪ batch`` over the years of those rows, published in one
write with a dynamic partition overwrite: Spark writes the new files beside the
old ones and swaps the partitions when the job commits. Years in which the batch
replaces nothing, as those of a daily load, get its rows as further files, so
what is written follows the batch and not the year. Once such files are many, the
next load that touches the year writes it anew.

Next to a table stand its watermarks (one row per key) and its change feed: the
(key, year) of every slice that a load added rows to or replaced rows of, with
the load time. Readers that keep something derived from the table ask the feed
what to redo, so they also learn of rows that a correction made invalid, which
no filter over the present rows can show.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators.windows import first_per_group
from gaugeflow.session import exists, materialize

PARTITION_COL = "year"
SMALL_FILE = 16 << 20  # bytes under which a file of the table counts as small
YEAR_PART = 2 * SMALL_FILE  # bytes of a year's files in the table per part of it that one task merges
FEW_PARTS = 8  # parts up to which a smaller year is cut, so that its merge is not left to one task
LEAST_PART = 1 << 20  # bytes that such a part has at least
MOST_SMALL_FILES = 32  # small files with which a year is written anew by the next load


def watermarks(table: DataFrame, key: str = S.KEY, date_col: str = S.DATE) -> DataFrame:
    """``max(date)`` per key (A3): a partial/final hash aggregate, one row per key."""
    return table.groupBy(key).agg(F.max(date_col).alias("max_fecha"))


def after_watermark(batch: DataFrame, marks: DataFrame, key: str = S.KEY, date_col: str = S.DATE) -> DataFrame:
    """Keep batch rows dated after their key's watermark; keys without one keep
    every row (J6). One join instead of one query per file; ``marks`` (one row
    per key) is best a written table, whose size Spark knows."""
    kept = batch.join(marks.select(key, "max_fecha"), key, "left").where(
        F.col("max_fecha").isNull() | (F.col(date_col) > F.col("max_fecha")))
    return kept.drop("max_fecha")


def watermark_gaps(batch: DataFrame, marks: DataFrame, key: str = S.KEY, date_col: str = S.DATE,
                   max_gap_days: int = 1) -> DataFrame:
    """Keys whose earliest incoming date is more than ``max_gap_days`` after
    their watermark: with tail-trimmed fetches the rows in between were never
    delivered (S7 gap check). One partial/final min per key, joined with the
    watermark table."""
    first_new = batch.groupBy(key).agg(F.min(date_col).alias("first_new_fecha"))
    m = marks.select(key, "max_fecha")
    return first_new.join(m, key, "inner").where(
        F.col("first_new_fecha") > F.date_add("max_fecha", max_gap_days)
    ).select(key, "max_fecha", "first_new_fecha",
             F.datediff("first_new_fecha", "max_fecha").alias("gap_days"))


def dedupe_batch(batch: DataFrame, keys: Sequence[str] = (S.KEY, S.DATE),
                 order: Sequence[Column | str] = ("line_order",)) -> DataFrame:
    """One row per key: the first by ``order`` (file line order) wins (M2).
    Groups are (key, date) pairs, so no group is large; the row_number filter
    is planned with a map-side group limit."""
    return first_per_group(batch, list(keys), list(order))


def merge_rows(existing: DataFrame, batch: DataFrame, keys: Sequence[str] = (S.KEY, S.DATE),
               mode: str = "new_dates", key: str = S.KEY, date_col: str = S.DATE,
               loaded_at: dt.datetime | Column | None = None) -> DataFrame:
    """Result of the keyed upsert as a lazy DataFrame (M1).

    ``mode='new_dates'``: batch rows at or before the key's watermark are
    dropped first (the upstream behaviour, so existing rows are never changed).
    ``mode='upsert'``: every batch row replaces the existing row with its key.
    ``batch`` must already be unique on ``keys`` (see :func:`dedupe_batch`).
    Loaded rows get ``ingested_at = loaded_at``; kept rows keep theirs.
    """
    if mode not in ("new_dates", "upsert"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "new_dates":
        batch = after_watermark(batch, watermarks(existing, key, date_col), key, date_col)
    incoming = _stamped(batch, existing.columns, loaded_at)
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming)


def _stamped(batch: DataFrame, columns: Sequence[str], loaded_at: dt.datetime | Column | None) -> DataFrame:
    """The rows of a batch as rows of the table with ``columns``."""
    ts = loaded_at if isinstance(loaded_at, Column) else (
        F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp"))
    return batch.withColumn("ingested_at", ts).select(*columns)


def with_partition(df: DataFrame, date_col: str = S.DATE) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.year(date_col))


def write_partitions(df: DataFrame, target: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Write a frame with the partition column: rows are rebalanced by year,
    so a year gets files of the advisory size, not one per task, and a large
    year is still split. With ``dynamic`` only the years in ``df`` are
    replaced, at the commit; ``df`` may read the years that it replaces."""
    writer = df.hint("rebalance", F.col(PARTITION_COL)).write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PARTITION_COL).parquet(target)


def part_of(keys: Sequence[str], parts: dict[int, int]) -> Column:
    """The part of its year that a row is in; ``parts`` has the number of parts
    of each year (one where it is missing). The first of ``keys`` decides, so
    that the rows of an entity stay together in one file; without it, all do."""
    n = F.lit(1)
    for year, k in parts.items():
        if k > 1:
            n = F.when(F.col(PARTITION_COL) == year, F.lit(k)).otherwise(n)
    return F.pmod(F.when(F.col(keys[0]).isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(keys[0])), n)


def parts_of_year(n: int, least: int, full: int) -> int:
    """Parts of a year of size ``n``: up to ``FEW_PARTS`` of at least the size
    ``least``, or more of the size ``full``."""
    return max(min(n // least, FEW_PARTS), n // full, 1)


def merge_partitions(spark: SparkSession, touched: DataFrame, batch: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Replace the years of ``touched`` (their rows in the table at ``target``)
    and ``batch`` (rows of the table, unique on ``keys``) by the upsert of
    both, as :func:`merge_rows` does. The rows are shuffled once: by year and
    by :func:`part_of` it, of as many as :func:`parts_of_year` cuts the year
    into, so that a task has whole keys and writes files of that size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
    sizes = files.groupBy(PARTITION_COL).agg(F.sum("length").alias("n")).where(F.col(PARTITION_COL).isNotNull()).collect()  # one row per year
    part = part_of(keys, {r[PARTITION_COL]: parts_of_year(r["n"], LEAST_PART, YEAR_PART) for r in sizes})
    both = touched.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)))
    cut = both.withColumn("_part", part).repartition(PARTITION_COL, "_part")
    # By the key first, whose first bytes tell most rows apart: a task has few years.
    replaced = F.max("_new").over(Window.partitionBy(*keys, PARTITION_COL, "_part"))
    # As in a join, a key with a null is like no other.
    alone = F.lit(False)
    for k in keys:
        alone = alone | F.col(k).isNull()
    merged = cut.withColumn("_replaced", replaced).where(F.col("_new") | ~F.col("_replaced") | alone)
    merged.drop("_new", "_part", "_replaced").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        PARTITION_COL).parquet(target)


def marks_path(target: str) -> str:
    return f"{target.rstrip('/')}_marks"


def stored_watermarks(spark: SparkSession, target: str, key: str = S.KEY, date_col: str = S.DATE) -> DataFrame:
    """The watermark table kept next to ``target``, one row per key; made from
    the table where it is missing."""
    path = marks_path(target)
    if not exists(spark, path):
        watermarks(spark.read.parquet(target), key, date_col).write.parquet(path)
    return spark.read.parquet(path)


def changes_path(target: str) -> str:
    return f"{target.rstrip('/')}_changes"


def record_changes(slices: DataFrame, target: str, loaded_at: dt.datetime, key: str = S.KEY) -> None:
    """Append touched slices (``key``, year) to the feed of ``target``, filed
    by the day of the load."""
    at = F.lit(loaded_at).cast("timestamp")
    slices.select(key, F.col(PARTITION_COL).cast("int").alias(PARTITION_COL)).distinct().withColumns(
        {"loaded_at": at, "load_day": F.to_date(at)}).write.mode("append").partitionBy("load_day").parquet(changes_path(target))


def changes_since(spark: SparkSession, target: str, since: dt.datetime, key: str = S.KEY) -> DataFrame | None:
    """Slices touched by loads after ``since``; None for a table without a
    feed. Only the files of the days from then on are read."""
    if not exists(spark, changes_path(target)):
        return None
    at = F.lit(since).cast("timestamp")
    feed = spark.read.parquet(changes_path(target))
    return feed.where((F.col("load_day") >= F.to_date(at)) & (F.col("loaded_at") > at)).select(key, PARTITION_COL).distinct()


def drop_partitions(spark: SparkSession, target: str, values: Sequence[int]) -> None:
    """Remove whole partitions: a dynamic overwrite leaves those alone that
    have no row in the new data."""
    for v in values:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{PARTITION_COL}={v}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def years_to_rewrite(spark: SparkSession, target: str, batch: DataFrame, keys: Sequence[str] = (S.KEY, S.DATE),
                     date_col: str = S.DATE) -> list[int | None]:
    """Years of the table at ``target`` to which the rows of the written
    ``batch`` can not just be added: those in which it replaces rows, those
    with many small files, and the rows without a date. Of the table only
    the keys are read, within the dates of the batch; the small files are
    counted from the listing."""
    spans = batch.groupBy(F.year(date_col).alias(PARTITION_COL)).agg(
        F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).collect()  # one row per year
    years = [r[PARTITION_COL] for r in spans if r[PARTITION_COL] is not None]
    out: list[int | None] = [None] if len(years) < len(spans) else []
    if not years:
        return out
    within = F.col(date_col).between(min(r.lo for r in spans if r.lo), max(r.hi for r in spans if r.hi))
    there = spark.read.parquet(target).where(F.col(PARTITION_COL).isin(years) & within).select(PARTITION_COL, *keys)
    replaced = there.join(batch.select(*keys), list(keys), "left_semi").select(PARTITION_COL).distinct()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
    small = files.where(F.col(PARTITION_COL).isin(years) & (F.col("length") < SMALL_FILE)).groupBy(PARTITION_COL).count().where(
        F.col("count") >= MOST_SMALL_FILES).select(PARTITION_COL)
    return out + sorted(r[0] for r in replaced.union(small).distinct().collect())


def upsert_table(spark: SparkSession, target: str, batch: DataFrame, keys: Sequence[str] = (S.KEY, S.DATE),
                 mode: str = "new_dates", loaded_at: dt.datetime | None = None,
                 date_col: str = S.DATE, marks: DataFrame | None = None) -> int:
    """Apply :func:`merge_rows` to a year-partitioned parquet table at ``target``.

    The batch is filtered first (``new_dates``: by the stored watermarks, or by
    ``marks``) and written to the shared folder. Of the years that it then
    holds, those of :func:`years_to_rewrite` are read, merged and replaced, in one
    write; the others get its rows as further files. A batch with nothing new
    writes nothing. Re-running a batch gives the same table, also after a load
    that failed in between: what it had added is found and replaced. Returns
    the number of batch rows that were applied.
    """
    key = keys[0]
    loaded_at = loaded_at or dt.datetime.now()
    batch = batch.select(*[c for c in batch.columns if c != PARTITION_COL])
    stored = stored_watermarks(spark, target, key, date_col)
    if mode == "new_dates":
        batch = after_watermark(batch, stored if marks is None else marks, key, date_col)
    batch = materialize(spark, batch, "upsert-batch")
    per_year = batch.groupBy(F.year(date_col)).count().collect()  # one row per year
    if not per_year:
        return 0
    # Before the rows: a load that fails in between is redone, and its slices are only looked at twice.
    record_changes(with_partition(batch, date_col), target, loaded_at, key)
    table = spark.read.parquet(target)
    columns = [c for c in table.columns if c != PARTITION_COL]
    redo = years_to_rewrite(spark, target, batch, keys, date_col)
    of_redo = F.coalesce(F.year(date_col).isin([y for y in redo if y is not None]), F.lit(True))
    if redo:
        touched = table.where(F.col(PARTITION_COL).isin([y for y in redo if y is not None])).select(*columns)
        merge_partitions(spark, with_partition(touched, date_col),
                         with_partition(_stamped(batch.where(of_redo), columns, loaded_at), date_col), target, keys)
    if len(redo) < len(per_year):
        added = _stamped(batch.where(~of_redo), columns, loaded_at)
        write_partitions(with_partition(added, date_col), target, mode="append")
    new_marks = stored.unionByName(watermarks(batch, key, date_col)).groupBy(key).agg(F.max("max_fecha").alias("max_fecha"))
    materialize(spark, new_marks, "marks").write.mode("overwrite").parquet(marks_path(target))
    return sum(r[1] for r in per_year)


def create_table(raw: DataFrame, target: str, date_col: str = S.DATE, key: str = S.KEY) -> None:
    """Initial load of a year-partitioned raw table and its watermarks, which
    replace those of an earlier table at ``target``. The feed gets all slices
    of the table, and once more all that an earlier table had."""
    spark = raw.sparkSession
    write_partitions(with_partition(raw, date_col), target)
    loaded = with_partition(spark.read.schema(raw.schema).parquet(target), date_col)
    stamp = F.max("ingested_at") if "ingested_at" in raw.columns else F.lit(None)
    # Marks, feed and load time from one pass over the table.
    made = materialize(spark, loaded.groupBy(key, PARTITION_COL).agg(
        F.max(date_col).alias("max_fecha"), stamp.cast("timestamp").alias("at")), "created-slices")
    watermarks(made, key, "max_fecha").write.mode("overwrite").parquet(marks_path(target))
    slices = made.select(key, PARTITION_COL)
    if exists(spark, changes_path(target)):
        # Written first: the feed that it reads is added to.
        slices = materialize(spark, slices.unionByName(
            spark.read.parquet(changes_path(target)).select(key, PARTITION_COL)).distinct(), "feed-slices")
    at = made.agg(F.max("at")).first()[0]
    record_changes(slices, target, at or dt.datetime.now(), key)
