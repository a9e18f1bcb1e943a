"""Session helpers: building a session for local runs and locating the shared
scratch folder (``spark.checkpoint.dir``) for staged writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on. On a cluster they come from the cluster
# config; `get_spark` only fills in what is unset.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions are sized by AQE from this target, not by a fixed count.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Whether the shuffle files of an execution are deleted at its end (Spark 4.1).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session or build one (local runs and tests)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName("gaugeflow")
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``. Only a local master may go without:
    there a fresh temporary folder is created and set. On a cluster a folder of
    one machine would lose data, so an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="gaugeflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/gaugeflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder; never reused between runs."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's staged tables, at the end of a job: no frame
    that reads them may be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists. Only "path not found" means that there is no
    table; any other error (an unreadable or empty directory) is raised, so
    that nobody overwrites what could not be read."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files when they end. What is
    written needs them no more; else they stay on the executors' disks until the
    driver happens to collect its garbage, often to the end of the job. A failed
    task is repeated as before, within its write."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` as parquet to a new path under the shared folder and read
    it back: a table that cuts the lineage and is read column-pruned."""
    path = scratch_path(spark, name)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
