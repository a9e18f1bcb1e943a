"""Export of the marts.

Layout of one publish (``root`` is a shared folder)::

    root/runs/<run_id>/current/dim/part-*.parquet
    root/runs/<run_id>/current/snapshot/part-*.parquet
    root/runs/<run_id>/current/fct_by_state/state_part=<label>/part-*.parquet
    root/runs/<run_id>/current/fct_without_rows/part-*.parquet   (the file of states without rows)
    root/archive/month=<yyyy-MM>/part-*.parquet        (day 1 of a month, or forced)
    root/runs/<run_id>/manifest/part-*.txt               (one JSON line)
    root/runs/<run_id>/files/part-*.txt                  (one JSON line per file)
    root/manifest.json                                   (the manifest of the current run)

Every run writes into its own new directory, so a publish never deletes
files a reader may be using and never leaves orphans next to new files (K3).
Its manifest lists the files of every data set by path. The last step renames
that manifest onto ``root/manifest.json``: readers find the current run there
without listing anything, and a publish that fails leaves the old one in place.

A state whose rows did not change since the current manifest is not written
again: its entry, files of an earlier run included, goes over to the new
manifest. Whether it changed is told by a digest of its rows, combined from
those of its slices, which the fact keeps (see ``incremental.slices_of``).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions.expr import safe_label
from gaugeflow.operators.incremental import slices_of
from gaugeflow.session import materialize

STATE_PART = "state_part"
MANIFEST = "manifest.json"
# Spark's name for the directory of an empty partition value.
DEFAULT_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"
ENTRY = ("struct<files:long,size_bytes:long,hash:string,state:string,digest:string,"
         "paths:array<struct<path:string,size_bytes:long,hash:string>>>")
# Bound on the bytes of an output file before compression: the content hash
# reads a file as one binaryFile row.
MAX_FILE_BYTES = 256 * 1024 * 1024
TEXT_BYTES = 64  # taken for a text cell (names, codes, labels); 8 for any other


def records_per_file(df: DataFrame) -> int:
    """Rows that keep a file under ``MAX_FILE_BYTES``, from the columns of the
    frame: a table that gains columns gets fewer rows per file."""
    width = sum(TEXT_BYTES if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema.fields)
    return max(1, MAX_FILE_BYTES // max(8, width))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Query -> zstd parquet directory (K1)."""
    (df.write.mode(mode).option("compression", "zstd")
     .option("maxRecordsPerFile", records_per_file(df)).parquet(path))


def distinct_states(dim: DataFrame, state_col: str = "state") -> DataFrame:
    """Distinct non-NULL states, sorted (A5)."""
    return dim.where(F.col(state_col).isNotNull()).select(state_col).distinct().orderBy(state_col)


def state_labels(dim: DataFrame, state_col: str = "state") -> DataFrame:
    """(state, label) per distinct state (P16) with a collision flag: two
    states that map to one label (``A B`` and ``A_B``) would share a file."""
    states = dim.where(F.col(state_col).isNotNull()).select(state_col).distinct()
    labelled = states.withColumn("label", safe_label(state_col))
    return labelled.withColumn(
        "label_collision", F.count(F.lit(1)).over(Window.partitionBy("label")) > 1
    )


def fact_by_state(fact: DataFrame, state_col: str = "state") -> DataFrame:
    """Fact rows with a non-NULL state, labelled and globally sorted by
    (label, key, date) (K2, L2).

    The sort is a range partitioning on all three columns: a state holding a
    large share of rows is split over several tasks (several ordered files in
    its directory) instead of landing whole in one task.
    """
    return (
        fact.where(F.col(state_col).isNotNull())
        .withColumn(STATE_PART, safe_label(state_col))
        .orderBy(STATE_PART, S.KEY, S.DATE)
    )


def write_fact_by_state(fact: DataFrame, path: str, state_col: str = "state") -> None:
    """One directory per state label; ``state`` stays in the data (K2)."""
    (fact_by_state(fact, state_col).write.mode("overwrite").option("compression", "zstd")
     .option("maxRecordsPerFile", records_per_file(fact)).partitionBy(STATE_PART).parquet(path))


def read_fact_by_state(spark: SparkSession, path: str) -> DataFrame:
    """Read K2 output back; the partition label is dropped (it duplicates state)."""
    return spark.read.parquet(path).drop(STATE_PART)


def global_stats(fact: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row: entity count of the snapshot, fact date range and row count
    (A4). Two single-row aggregates combined by a union + max, no join."""
    none_date = F.lit(None).cast("date")
    none_long = F.lit(None).cast("long")
    snap = snapshot.agg(F.count(F.lit(1)).alias("total_presas")).select(
        "total_presas", none_date.alias("data_min_fecha"), none_date.alias("data_max_fecha"),
        none_long.alias("fact_rows"),
    )
    f = fact.agg(
        F.min(S.DATE).alias("data_min_fecha"), F.max(S.DATE).alias("data_max_fecha"),
        F.count(F.lit(1)).alias("fact_rows"),
    ).select(none_long.alias("total_presas"), "data_min_fecha", "data_max_fecha", "fact_rows")
    return snap.unionByName(f).agg(
        F.max("total_presas").alias("total_presas"),
        F.max("data_min_fecha").alias("data_min_fecha"),
        F.max("data_max_fecha").alias("data_max_fecha"),
        F.max("fact_rows").alias("fact_rows"),
    )


def load_stats(raw: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """One row after a load (A4): total rows and newest date of the raw table,
    and, given the per-file status, files loaded and files failed."""
    out = raw.agg(F.count(F.lit(1)).alias("total_rows"), F.max(S.DATE).alias("max_fecha"))
    if status is None:
        return out
    files = status.agg(
        F.count_if(F.col("status") == "ok").alias("files_ok"),
        F.count_if(F.col("status") != "ok").alias("files_failed"),
    )
    none_long = F.lit(None).cast("long")
    return out.select("total_rows", "max_fecha", none_long.alias("files_ok"), none_long.alias("files_failed")) \
        .unionByName(files.select(none_long.alias("total_rows"), F.lit(None).cast("date").alias("max_fecha"),
                                  "files_ok", "files_failed")) \
        .agg(*[F.max(c).alias(c) for c in ("total_rows", "max_fecha", "files_ok", "files_failed")])


def archive_due(run_date: dt.date, force: bool = False) -> bool:
    """The monthly archive is written on day 1 or when forced (K4)."""
    return force or run_date.day == 1


def write_archive(snapshot: DataFrame, root: str, run_date: dt.date, force: bool = False) -> str | None:
    """Snapshot -> ``root/archive/month=yyyy-MM`` (same month overwrites) (K4).
    Returns the month key, or None when not due."""
    if not archive_due(run_date, force):
        return None
    month = run_date.strftime("%Y-%m")
    write_parquet(snapshot, f"{root.rstrip('/')}/archive/month={month}")
    return month


def file_inventory(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """Size and first 16 hex digits of the SHA-256 of every parquet file under
    ``path`` (K5), read and hashed on the executors. ``relpath`` is relative to
    ``base`` (default ``path``)."""
    base = (base or path).rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    # The path after the base, whatever scheme or host stands before it.
    folder = F.lit("/" + base.split(":", 1)[-1].strip("/") + "/")
    return files.select(
        F.substr(F.col("path"), F.instr("path", folder) + F.length(folder)).alias("relpath"),
        F.col("length").alias("size_bytes"),
        F.substring(F.sha2(F.col("content"), 256), 1, 16).alias("hash"),
    )


def directory_label(relpath: Column) -> Column:
    """The label in a state directory's name. Spark escapes characters as %XX
    there and gives the empty label its default name; a plus is a plus."""
    name = F.regexp_extract(relpath, STATE_PART + r"=([^/]+)/", 1)
    label = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name == "", None).when(name == DEFAULT_DIRECTORY, "").otherwise(label)


def with_state(files: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Adds ``state``: the state itself, looked up by the directory's label."""
    if labels is None:
        return files.withColumn("state", F.lit(None).cast("string"))
    names = labels.select("state", F.col("label").alias("_label"))
    return files.join(names, directory_label(F.col("relpath")) == names["_label"], "left").drop("_label")


def dataset_summary(inventory: DataFrame, labels: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """One row per output directory (dim, snapshot, one per state, an archive
    month): its files with their paths below ``prefix``, their number and
    bytes, and a content hash that does not depend on file order or part-file
    names. The files of a directory are one per ``MAX_FILE_BYTES``."""
    d = with_state(inventory, labels).withColumn("dataset", F.regexp_replace("relpath", "/[^/]*$", ""))
    h = F.sum(F.xxhash64("hash").cast("decimal(38,0)"))
    return d.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size_bytes").alias("size_bytes"),
        F.substring(F.sha2(h.cast("string"), 256), 1, 16).alias("hash"),
        F.max("state").alias("state"),
        F.array_sort(F.collect_list(F.struct(F.concat(F.lit(prefix), "relpath").alias("path"), "size_bytes", "hash"))).alias("paths"),
    )


def state_digests(slices: DataFrame) -> DataFrame:
    """(state, digest) of the rows of each non-NULL state, from the fact's
    slices (see ``incremental.slices_of``)."""
    part = F.xxhash64(S.KEY, "year", F.col("digest").cast("string")).cast("decimal(38,0)")
    return slices.where(F.col("state").isNotNull()).groupBy("state").agg(
        F.substring(F.sha2(F.sum(part).cast("string"), 256), 1, 16).alias("digest"))


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """The current manifest's data sets, a row each (``dataset`` and the fields
    of its entry); None before the first publish."""
    path = f"{root.rstrip('/')}/{MANIFEST}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", f"current map<string,{ENTRY}>").alias("d")).select(
        F.explode("d.current").alias("dataset", "e")).select("dataset", "e.*")


def point_to(spark: SparkSession, root: str, manifest_text: str) -> None:
    """Make ``manifest_text`` the current manifest: written under another name
    first, then renamed over the old one in one step."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    target = fs.Path(f"{root.rstrip('/')}/{MANIFEST}")
    fresh = fs.Path(f"{root.rstrip('/')}/.{MANIFEST}.{uuid.uuid4().hex}")
    out = fresh.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh, True)
    try:
        out.write(bytearray(manifest_text.encode()))
    finally:
        out.close()
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = fs.FileContext.getFileContext(target.makeQualified(
        target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), fs.Path("/")).toUri(), spark._jsc.hadoopConfiguration())
    files.rename(fresh, target, options)


def read_published(spark: SparkSession, root: str, dataset: str | None = None) -> DataFrame:
    """Rows of a data set of the current run (the fact of all states unless one
    is named), from the files that the manifest lists."""
    entries = read_manifest(spark, root)
    if entries is None:
        raise ValueError(f"nothing is published under {root}")
    wanted = F.col("dataset") == dataset if dataset else F.col("dataset").startswith("fct_")
    paths = [r[0] for r in entries.where(wanted).select(F.explode("paths.path")).collect()]  # one per file
    return spark.read.parquet(*[f"{root.rstrip('/')}/{p}" for p in paths])


def manifest(
    inventory: DataFrame,
    stats: DataFrame,
    generated_at: dt.datetime,
    archive: DataFrame | None = None,
    empty_states: DataFrame | None = None,
    labels: DataFrame | None = None,
    digests: DataFrame | None = None,
    kept: DataFrame | None = None,
    prefix: str = "",
) -> DataFrame:
    """Manifest as one JSON text row (K6): schema version, generation time,
    date range, entity count, ``current`` map of data sets (bytes, content
    hash, state, digest of the state's rows, and each file's path, size and
    hash), latest archive entry, states without rows, total bytes.

    ``kept`` are entries of an earlier manifest that stay as they are. The row
    has one path per file of at most ``MAX_FILE_BYTES`` before compression:
    about 60 MB for 100 TB of output.
    """
    ds = dataset_summary(inventory, labels, prefix)
    if digests is not None:
        ds = ds.join(digests, "state", "left")
    else:
        ds = ds.withColumn("digest", F.lit(None).cast("string"))
    fields = ["files", "size_bytes", "hash", "state", "digest", "paths"]
    ds = ds.select("dataset", *fields)
    if kept is not None:
        ds = ds.unionByName(kept.select("dataset", *fields))
    entries = ds.select(
        F.struct(
            F.col("dataset").alias("key"),
            F.struct(*fields).alias("value"),
        ).alias("e"),
        "size_bytes",
    )
    files = entries.agg(
        F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("current"),
        F.sum("size_bytes").alias("total_bytes"),
    )
    body = files
    if archive is not None:
        arch = dataset_summary(archive).agg(
            F.struct(
                F.first(F.regexp_extract("dataset", r"month=([^/]+)", 1)).alias("month"),
                F.sum("size_bytes").alias("size_bytes"),
                F.first("hash").alias("hash"),
            ).alias("latest_archive")
        )
        body = body.unionByName(arch, allowMissingColumns=True)
    else:
        body = body.withColumn("latest_archive",
                               F.lit(None).cast("struct<month:string,size_bytes:bigint,hash:string>"))
    body = body.unionByName(stats, allowMissingColumns=True)
    if empty_states is not None:
        es = empty_states.agg(F.array_sort(F.collect_list("state")).alias("states_without_rows"))
        body = body.unionByName(es, allowMissingColumns=True)
    else:
        body = body.withColumn("states_without_rows", F.array().cast("array<string>"))
    merged = body.agg(
        F.first("current", ignorenulls=True).alias("current"),
        F.max("total_bytes").alias("total_bytes"),
        F.first("latest_archive", ignorenulls=True).alias("latest_archive"),
        F.max("total_presas").alias("total_presas"),
        F.max("data_min_fecha").alias("data_min_fecha"),
        F.max("data_max_fecha").alias("data_max_fecha"),
        F.first("states_without_rows", ignorenulls=True).alias("states_without_rows"),
    )
    return merged.select(
        F.to_json(
            F.struct(
                F.lit(1).alias("schema_version"),
                F.lit(generated_at.isoformat()).alias("generated_at"),
                F.date_format("data_min_fecha", "yyyy-MM-dd").alias("data_min_fecha"),
                F.date_format("data_max_fecha", "yyyy-MM-dd").alias("data_max_fecha"),
                "total_presas",
                "current",
                "latest_archive",
                "states_without_rows",
                "total_bytes",
            )
        ).alias("manifest")
    )


def file_entries(inventory: DataFrame, labels: DataFrame) -> DataFrame:
    """The manifest's entries per file, one JSON row each: path, size, content
    hash and state."""
    return with_state(inventory, labels).select(F.to_json(F.struct(
        F.col("relpath").alias("key"), "size_bytes", "hash", "state")).alias("entry"))


def published_bytes(spark: SparkSession, *paths: str) -> DataFrame:
    """One row with the bytes of all files under ``paths``: data, archive,
    file entries and manifest. Only the sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select(F.col("length")).agg(F.sum("length").alias("total_bytes"))


def new_run_id(run_date: dt.date) -> str:
    return f"{run_date.isoformat()}-{uuid.uuid4().hex[:8]}"


def export_all(
    spark: SparkSession,
    dim: DataFrame,
    fact: DataFrame,
    snapshot: DataFrame,
    root: str,
    run_date: dt.date,
    force_archive: bool = False,
    generated_at: dt.datetime | None = None,
    slices: DataFrame | None = None,
) -> tuple[str, DataFrame]:
    """Write dim, snapshot, the fact of changed states, the archive when due,
    and the manifest into a new run directory, then point to it. ``slices`` are
    the fact's (made from it where not given). Returns (run directory, manifest
    df)."""
    root = root.rstrip("/")
    run_id = new_run_id(run_date)
    run_dir = f"{root}/runs/{run_id}"
    current = f"{run_dir}/current"
    labels = state_labels(dim)
    clashes = labels.where("label_collision").select("state", "label").collect()
    if clashes:
        raise ValueError(f"state labels collide: {[(r.state, r.label) for r in clashes]}")
    digests = materialize(spark, state_digests(slices_of(fact) if slices is None else slices), "state-digests")
    before = read_manifest(spark, root)
    kept = None
    if before is not None:
        kept = materialize(spark, before.join(digests, ["state", "digest"], "left_semi"), "kept-entries")
    write_parquet(dim, f"{current}/dim")
    write_parquet(snapshot, f"{current}/snapshot")
    write_parquet(fact.limit(0), f"{current}/fct_without_rows")
    same = [] if kept is None else [r[0] for r in kept.select("state").collect()]  # one per state
    write_fact_by_state(fact.where(~F.col("state").isin(same)) if same else fact, f"{current}/fct_by_state")
    month = write_archive(snapshot, root, run_date, force_archive)
    inv = file_inventory(spark, current)
    arch = None
    if month is not None:
        arch = file_inventory(spark, f"{root}/archive/month={month}", base=root)
    empty = labels.select("state").join(digests, "state", "left_anti")
    stats = global_stats(fact, snapshot)
    file_entries(inv, labels).withColumnRenamed("entry", "value").write.mode("overwrite").text(f"{run_dir}/files")
    m = manifest(inv, stats, generated_at or dt.datetime.now(dt.timezone.utc), arch, empty, labels, digests, kept,
                 f"runs/{run_id}/current/")
    m.write.mode("overwrite").text(f"{run_dir}/manifest")
    written = spark.read.text(f"{run_dir}/manifest").withColumnRenamed("value", "manifest")
    point_to(spark, root, written.first().manifest)
    return run_dir, written
