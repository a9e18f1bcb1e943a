"""Packing with optimal length buckets.

The lengths of all sequences are counted in one histogram; dynamic programming
over it chooses the bucket boundaries that minimise the padding, when every
sequence is padded to the boundary above it. Inside a bucket, batches hold as
many sequences as the token budget allows.

A token is a word between white space unless the caller gives its own length
column. Documents over ``max_len`` are cut into pieces of ``max_len`` tokens
and a rest. Only the histogram reaches the driver: at most ``max_len`` + 1
rows. Sequences are numbered inside their bucket by range-partitioned rank:
a written, sorted table knows each partition's first number, so a bucket with
most of the rows is spread over many tasks.

Defined results:

* no tokens (null, empty, blank): one row with ``n_tokens`` 0 and neither
  bucket nor batch, as there is nothing to train on;
* fewer different lengths than buckets: one bucket per length, no padding;
* ties between equally good boundaries: the lower ones;
* repeated rows and null doc_ids: each row is packed; nulls come first;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage

MAX_LEN = 2048
BUCKETS = 16
TOKEN_BUDGET = 65536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0))


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding."""
    sizes = sorted(n for n, c in histogram.items() if n > 0 and c > 0)
    if not sizes:
        return []
    length = np.array([0, *sizes], np.int64)
    count = np.concatenate([[0], np.cumsum([histogram[n] for n in sizes])]).astype(np.int64)
    m = len(sizes)
    never = np.iinfo(np.int64).max // 4
    # Padded tokens of the first j lengths; the real tokens are the same for all choices.
    best = np.full(m + 1, never, np.int64)
    best[0] = 0
    back = []
    for _ in range(min(buckets, m)):
        new, frm = np.full(m + 1, never, np.int64), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + length[j] * (count[j] - count[:j])
            i = int(np.argmin(cost))
            new[j], frm[j] = min(cost[i], never), i
        back.append(frm)
        best = new
    out, j = [], m
    for frm in reversed(back):
        out.append(int(length[j]))
        j = int(frm[j])
        if j == 0:
            break
    return out[::-1]


def pack(documents: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
         length: Column | None = None) -> DataFrame:
    """A row per sequence: ``doc_id``, ``piece``, ``first_token``,
    ``n_tokens``, ``bucket_len``, ``batch`` (number inside the bucket) and
    ``slot`` (place inside the batch). A batch holds
    ``max(1, token_budget // bucket_len)`` sequences."""
    n = word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0))
    docs = stage(documents.select("doc_id", n.cast("long").alias("n")), "pack-lengths")
    first = F.col("piece") * max_len
    seqs = docs.select("doc_id", "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0).cast("long")))).alias("piece")).select(
        "doc_id", "piece", first.alias("first_token"), F.least(F.col("n") - first, F.lit(max_len)).cast("long").alias("n_tokens"))
    histogram = {r[0]: r[1] for r in seqs.groupBy("n_tokens").count().collect()}
    bounds = optimal_boundaries(histogram, buckets)
    bucket = F.element_at(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b >= F.col("n_tokens")), 1)
    seqs = seqs.withColumn("bucket_len", F.when(F.col("n_tokens") > 0, bucket) if bounds else F.lit(None).cast("long"))
    order = ["bucket_len", "doc_id", "piece", "n_tokens"]
    ranked = stage(seqs.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "part": F.spark_partition_id(),
        "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "pack-ranked")
    # One row per partition and bucket: partitions + buckets of them.
    runs = ranked.groupBy("bucket_len", "part").agg(F.count("*").alias("n"), F.min("at").alias("lo"))
    before = F.sum("n").over(Window.partitionBy("bucket_len").orderBy("part")) - F.col("n")
    runs = stage(runs.select("bucket_len", "part", (before - F.col("lo")).alias("shift")), "pack-runs")
    out = ranked.join(runs, (ranked["part"] == runs["part"]) & ranked["bucket_len"].eqNullSafe(runs["bucket_len"])).select(
        ranked["*"], (F.col("at") + F.col("shift")).alias("rank"))
    room = F.when(F.col("bucket_len").isNotNull(), F.greatest(
        F.floor(F.lit(token_budget) / F.col("bucket_len")), F.lit(1)).cast("long"))
    return out.select("doc_id", "piece", "first_token", "n_tokens", "bucket_len",
                      F.floor(F.col("rank") / room).cast("long").alias("batch"), (F.col("rank") % room).alias("slot"))
