"""Filter interaction audit by wide packed counters.

Which filter removes a document depends on the order of the filters. A document
is described by its *mask*: one bit for each filter that it fails. With five
filters there are 120 orders of five steps, so a mask has 600 step outcomes:
removed at this step of this order, or not. Each mask is mapped to one big
integer with a field for every outcome, and a few fields more (rows, failures
and lone failures of each filter). Integers are summed per part, first inside
every task; what is shuffled is one integer per task and part. The sums are cut
into their fields again, and all other numbers of the report follow from them.

A field has 64 bits and counts documents, each of which adds 0 or 1 to it. A
table has fewer than 2**63 rows, so no field can carry into the next.

A filter is a named boolean column over the text, null meaning that it is
passed. One more filter, ``duplicates``, fails a document whose text equals
that of any smaller doc_id in the whole table. Equal texts are found by their
SHA-256; the rows of one text are counted before they meet, so a text of which
a third of all documents are copies is a few rows per task.

Defined results:

* null text is the empty text; a null part is the empty string;
* a null doc_id is compared with nothing: such a row never fails
  ``duplicates``, no row fails for its sake, and it has no label;
* rows with one doc_id and one text are not each other's copies, each counts;
* several labels of one doc_id: it is good (toxic) if any of them says so;
  missing or null labels count as neither;
* a part has all its rows in the report, zeros included; an empty table has no
  parts and gives an empty report; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage

WIDTH = 64
#: Partial sums of one part meet in this many groups before they meet in one.
SALTS = 64
#: Parts of which a task holds sums at a time.
HELD_PARTS = 1024

SUMS = "part string, everything binary, good binary, toxic binary"
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def default_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the audited filters. A word is a run of
    characters other than white space."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": F.rlike(text, F.lit(r"[#$%&*|]")),
    }


class Counters:
    """The fields of a packed counter for ``names`` filters: every outcome
    (order, step), then failures and lone failures by filter, then rows."""

    def __init__(self, names: list[str]):
        self.names = names
        self.orders = list(permutations(range(len(names))))
        self.fields = len(self.orders) * len(names) + 2 * len(names) + 1

    def outcome(self, order: int, step: int) -> int:
        return order * len(self.names) + step

    def packed(self, mask: int) -> int:
        """The integer of one document with this mask."""
        k = len(self.names)
        failed = [i for i in range(k) if mask >> i & 1]
        tail = len(self.orders) * k
        fields = [tail + i for i in failed] + [tail + 2 * k]
        if len(failed) == 1:
            fields.append(tail + k + failed[0])
        for o, order in enumerate(self.orders):
            first = next((s for s, i in enumerate(order) if mask >> i & 1), None)
            if first is not None:
                fields.append(self.outcome(o, first))
        return sum(1 << WIDTH * f for f in fields)

    def to_bytes(self, total: int) -> bytes:
        return total.to_bytes(self.fields * WIDTH // 8, "little")

    def unpack(self, total: bytes) -> np.ndarray:
        return np.frombuffer(total, "<u8").astype(np.int64)

    def report(self, part: str, everything: bytes, good: bytes, toxic: bytes) -> pd.DataFrame:
        """All orders and steps of one part."""
        k, tail = len(self.names), len(self.orders) * len(self.names)
        fields = self.unpack(everything)
        lost = [self.unpack(x)[:tail] for x in (good, toxic)]
        removed = fields[:tail].reshape(-1, k)
        filter_at = np.array(self.orders)
        shapley = np.zeros(k, np.int64)
        np.add.at(shapley, filter_at.ravel(), removed.ravel())
        fails, alone, rows = fields[tail:tail + k], fields[tail + k:tail + 2 * k], fields[tail + 2 * k]
        return pd.DataFrame({
            "part": part,
            "filter_order": np.repeat(["".join(self.names[i] for i in o) for o in self.orders], k),
            "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(self.orders)),
            "kept": (rows - removed.cumsum(axis=1)).ravel(),
            "removed": removed.ravel(),
            "redundant": (fails[filter_at] - removed).ravel(),
            "unique_fails": alone[filter_at].ravel(),
            "good_lost": lost[0],
            "toxic_lost": lost[1],
            "shapley": shapley[filter_at].ravel(),
        })


def mask_counts(documents: DataFrame, labels: DataFrame, filters: dict[str, Column], part: str = "lang") -> DataFrame:
    """``part``, ``mask`` (bits in the order of ``filters``), ``good``,
    ``toxic``, ``n_first`` and ``n_copies``: documents that pass and that fail
    the filter for repeated texts, whose bit is not in the mask yet. One row or
    more per part and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = F.lit(0)
    for i, failed in enumerate(filters.values()):
        mask = mask + F.coalesce(failed.cast("int"), F.lit(0)) * (1 << i)
    rows = stage(documents.select(
        "doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), mask.alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest")), "audit-masks")
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    # A doc_id is in a group once, so its rows are counted in the least struct.
    texts = known.join(marks, "doc_id", "left").select("part", "mask", "digest", "doc_id", "n", *flags).groupBy(
        "digest", "part", "mask", "good", "toxic").agg(F.min(F.struct("doc_id", "n")).alias("least"), F.sum("n").alias("n"))
    smallest = F.min("least.doc_id").over(Window.partitionBy("digest"))
    texts = texts.withColumn("n_first", F.when(F.col("least.doc_id") == smallest, F.col("least.n")).otherwise(F.lit(0)))
    columns = ["part", "mask", "good", "toxic", "n_first"]
    unknown = rows.where(F.col("doc_id").isNull()).groupBy("part", "mask").agg(F.count("*").alias("n_first"))
    return texts.select(*columns, (F.col("n") - F.col("n_first")).alias("n_copies")).unionByName(
        unknown.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n_first",
                       F.lit(0).cast("long").alias("n_copies")))


def interaction_audit(documents: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None,
                      duplicates: str = "E", part: str = "lang") -> DataFrame:
    """The report: a row per part, order of the filters and step. ``filters``
    maps a one-letter name to its failure condition over the columns of
    ``documents``; ``duplicates`` names the filter for repeated texts, which
    comes after them. The number of orders is the factorial of that of the
    filters: up to six are sensible."""
    if filters is None:
        filters = default_filters(F.coalesce(F.col("text"), F.lit("")))
    counters = Counters([*filters, duplicates])
    copy = 1 << len(filters)
    counts = mask_counts(documents, labels, filters, part)

    def packed_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        integers = [counters.packed(m) for m in range(2 * copy)]
        held: dict[str, list[int]] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(p, *map(counters.to_bytes, s)) for p, s in held.items()],
                               columns=["part", "everything", "good", "toxic"])
            held.clear()
            return out

        for batch in batches:
            groups = batch.groupby(["part", "mask", "good", "toxic"])[["n_first", "n_copies"]].sum()
            for (p, m, good, toxic), n_first, n_copies in groups.itertuples(name=None):
                total = int(n_first) * integers[m] + int(n_copies) * integers[m | copy]
                sums = held.setdefault(p, [0, 0, 0])
                for i, counted in enumerate((True, good, toxic)):
                    if counted:
                        sums[i] += total
                if len(held) > HELD_PARTS:
                    yield flush()
        if held:
            yield flush()

    def add(rows: pd.DataFrame) -> list[bytes]:
        return [counters.to_bytes(sum(int.from_bytes(x, "little") for x in rows[c])) for c in ("everything", "good", "toxic")]

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(rows["part"].iloc[0], *add(rows))], columns=["part", "everything", "good", "toxic"])

    def report(rows: pd.DataFrame) -> pd.DataFrame:
        return counters.report(rows["part"].iloc[0], *add(rows))

    sums = counts.mapInPandas(packed_sums, SUMS).withColumn("salt", F.spark_partition_id() % SALTS)
    return sums.groupBy("part", "salt").applyInPandas(merged, SUMS).groupBy("part").applyInPandas(report, REPORT)


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
masks AS (
  SELECT doc_id, part,
         (len(w) < 200)::int
         + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
         + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body))::int
         + 8 * regexp_matches(body, '[#$%&*|]')::int
         + 16 * coalesce(doc_id > least, false)::int AS mask
  FROM words),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counted AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, s.step::int AS step, substr(filter_order, s.step, 1) AS letter,
         1 << (ascii(substr(filter_order, s.step, 1)) - 65) AS bit,
         list_sum([1 << (ascii(c) - 65) FOR c IN string_split(substr(filter_order, 1, s.step - 1), '') IF c <> '']) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
tallied AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & (coalesce(earlier, 0)::int | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(earlier, 0)::int = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(earlier, 0)::int <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN good AND mask & bit <> 0 AND mask & coalesce(earlier, 0)::int = 0 THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN toxic AND mask & bit <> 0 AND mask & coalesce(earlier, 0)::int = 0 THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM tallied
"""
