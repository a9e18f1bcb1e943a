"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import materialize


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    The written table survives lost executors and cuts the lineage, and Spark
    knows its real size when it picks the join.
    """
    return materialize(df.sparkSession, df, f"llm-{name}")


BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between Spark and Python by bytes. Rows here are
    whole documents: by the usual count of rows, one batch of long documents
    could fill a task's memory. Sets the session's
    ``spark.sql.execution.arrow.maxBytesPerBatch``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other
    columns of the caller can not clash with the operator's."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in cols.items()])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the columns ``names`` of both sides."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond
