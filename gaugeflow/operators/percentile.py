"""Exact continuous percentile per key (A2), balanced for keys of any size.

``percentile`` merges, for each key, a map of all its values in one task. Here
no task holds a key:

1. distinct (key, value) with counts, combined before the shuffle;
2. range-partitioned on (key, value), so a large key spans many partitions,
   and written once to the shared folder with its partition id (which then
   never changes, even if a later stage is recomputed);
3. counts accumulated inside each (partition, key), ordered by value;
4. per key, the offset of every partition: one row per partition and key;
5. the values holding ranks floor(pos) and ceil(pos), pos = (n - 1) * q, and
   the interpolation ``(ceil - pos) * v_lo + (pos - floor) * v_hi``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import materialize


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per key and non-NULL value, as ``_c``."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))


def percentile_by_key(df: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """(key, percentile) for every key with at least one non-NULL value."""
    return percentile_of_counts(value_counts(df, [key], value), key, value, q)


def percentile_of_counts(counts: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """(key, percentile) from ``counts``: ``_c`` rows of each (key, value), a
    pair standing once."""
    ranged = materialize(counts.sparkSession, counts.repartitionByRange(key, value)
                         .withColumn("_pid", F.spark_partition_id()), "percentile-ranges")
    inside = Window.partitionBy(key, "_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_cum", F.sum("_c").over(inside))
    totals = ranged.groupBy("_pid", key).agg(F.sum("_c").alias("_t"))
    by_key = Window.partitionBy(key)
    before = by_key.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select(
        key, "_pid", (F.sum("_t").over(before) - F.col("_t")).alias("_off"),
        ((F.sum("_t").over(by_key) - 1) * F.lit(q)).alias("_pos"))
    # A value holds the ranks [end - count, end) of its key.
    end = F.col("_off") + F.col("_cum")

    def holds(rank):
        return (end - F.col("_c") <= rank) & (rank < end)

    lo, hi = F.floor("_pos"), F.ceil("_pos")
    v = F.col(value).cast("double")
    picked = local.join(offsets, [key, "_pid"]).where(holds(lo) | holds(hi)).groupBy(key).agg(
        F.max("_pos").alias("_pos"), F.max(F.when(holds(lo), v)).alias("_v_lo"), F.max(F.when(holds(hi), v)).alias("_v_hi"))
    return picked.select(
        key,
        F.when((lo == hi) | (F.col("_v_lo") == F.col("_v_hi")), F.col("_v_lo"))
        .otherwise((hi - F.col("_pos")) * F.col("_v_lo") + (F.col("_pos") - lo) * F.col("_v_hi")).alias("percentile"))
