"""Incremental landing ingest with Structured Streaming.

The file source tracks which files were processed (in the checkpoint), so
every landed file is parsed once. A run has two steps:

1. each micro-batch parses its files with the batch code (S1-S5) and writes
   rows and per-file status under its own number, so a replay after a failure
   writes the same directory again;
2. when all files are in, the batches that were not merged yet go through
   de-duplication (M2), the watermark filter (J6) and one keyed upsert (M1).

Watermarks are therefore taken once per run, and the result does not depend on
how the files were cut into micro-batches or in which order they came. A run
that fails before its merge leaves its batches to the next one; merging a
batch twice gives the same table.

Landing runs should go to their own ``run_date=...`` directories: the file
source remembers paths, and a path that is overwritten in place is not read
again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow import schemas as S
from gaugeflow.operators import upsert
from gaugeflow.session import exists, materialize
from gaugeflow.sources import landing

BATCH_COL = "batch"


def batches_path(checkpoint: str) -> str:
    """Where parsed micro-batches, their status and the merge marks are kept."""
    return f"{checkpoint.rstrip('/')}_batches"


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    checkpoint: str,
    key_pattern: str = landing.STEM_PATTERN,
    glob: str = "*.csv",
    aliases: dict[str, list[str]] | None = None,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    members: bool = False,
) -> StreamingQuery:
    """Start a run-once (``availableNow``) stream that parses the files of
    ``landing_dir``. Call ``awaitTermination()``, then :func:`merge_batches`;
    :func:`run_ingest` does both. With ``archive_dir`` the source moves files
    there once a later batch shows that they are done with. ``members``: the
    files are bundles of gauge files (see :mod:`gaugeflow.sources.landing`)."""
    reader = (spark.readStream.format("text")
              .option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    src = reader.load(landing_dir).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )
    out = batches_path(checkpoint)

    def process(batch: DataFrame, epoch_id: int) -> None:
        # The lines are written first (line ids fixed, lineage cut) and parsed
        # through the main session, so adaptive execution applies.
        lines = materialize(spark, landing.ordered_lines(batch, key_pattern, members), f"stream-lines-{epoch_id}")
        rows, _, status = landing.load_lines(lines, aliases=aliases)
        rows.write.mode("overwrite").parquet(f"{out}/rows/{BATCH_COL}={epoch_id}")
        status.write.mode("overwrite").parquet(f"{out}/status/{BATCH_COL}={epoch_id}")

    return (src.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def merge_batches(spark: SparkSession, target: str, checkpoint: str, mode: str = "new_dates",
                  loaded_at: dt.datetime | None = None) -> None:
    """Upsert the parsed batches that no run has merged yet into ``target``,
    then remove them. A run that ended between its mark and the removal left
    merged batches, which are only removed."""
    out = batches_path(checkpoint)
    batches = _batches(spark, f"{out}/rows")
    if not batches:
        return
    done = -1
    if exists(spark, f"{out}/merged"):
        done = spark.read.parquet(f"{out}/merged").agg(F.max("until")).first()[0]
    if batches[-1] > done:
        rows = spark.read.parquet(f"{out}/rows").where(F.col(BATCH_COL).between(done + 1, batches[-1]))
        new = upsert.dedupe_batch(rows, order=["file", *landing.ORDER_COLS]).select(S.KEY, S.DATE, *S.MEASURES)
        if not exists(spark, target):
            ts = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
            upsert.create_table(new.withColumn("ingested_at", ts), target)
        else:
            upsert.upsert_table(spark, target, new, mode=mode, loaded_at=loaded_at)
        spark.range(1).select(F.lit(batches[-1]).cast("long").alias("until")).write.mode("append").parquet(f"{out}/merged")
    _remove(spark, f"{out}/rows")


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches under ``path``, ascending."""
    fs, where = _folder(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH_COL}="))


def _remove(spark: SparkSession, path: str) -> None:
    """Remove ``path``: no stream runs while its batches are merged."""
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def _record_empty(spark: SparkSession, files: DataFrame, checkpoint: str) -> None:
    """Add the files of the list that gave no line and are not known yet."""
    out = batches_path(checkpoint)
    columns = ["file", S.KEY, "status", "data_rows", "rejected_rows", "bad_dates", "reason"]
    known = spark.createDataFrame([], "file string")
    for part in ("status", "empty"):
        if exists(spark, f"{out}/{part}"):
            known = known.unionByName(spark.read.parquet(f"{out}/{part}").select("file"))
    no_status = files.select(S.KEY).limit(0).selectExpr(
        "'' AS file", S.KEY, "'' AS status", "0L AS data_rows", "0L AS rejected_rows", "0L AS bad_dates", "'' AS reason")
    fresh = landing.with_empty_files(no_status, landing.without_files(files, known)).select(*columns)
    fresh.write.mode("append").parquet(f"{out}/empty")


def run_ingest(spark: SparkSession, landing_dir: str, target: str, checkpoint: str, mode: str = "new_dates",
               loaded_at: dt.datetime | None = None, **kw) -> None:
    """Process every file that arrived since the last run, then stop."""
    files = materialize(spark, landing.scan_files(
        spark, landing_dir, kw.get("key_pattern", landing.STEM_PATTERN), kw.get("glob", "*.csv"), recursive=True), "stream-files")
    start_ingest(spark, landing_dir, checkpoint, **kw).awaitTermination()
    _record_empty(spark, files, checkpoint)
    merge_batches(spark, target, checkpoint, mode, loaded_at)


def file_status(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The status of every landed file; those with lines have the number of
    their batch."""
    out = batches_path(checkpoint)
    parts = [spark.read.parquet(f"{out}/{part}") for part in ("status", "empty") if exists(spark, f"{out}/{part}")]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_raw(spark: SparkSession, target: str) -> DataFrame:
    """The raw table without its partition column."""
    return spark.read.parquet(target).drop(upsert.PARTITION_COL)
