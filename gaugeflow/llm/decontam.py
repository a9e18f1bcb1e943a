"""Benchmark decontamination by winnowing.

Both sides keep the smallest hash of every ``WINDOW`` consecutive ``K``-word
grams (the rightmost of equals). ``K + WINDOW - 1`` words are 13, so every
shared run of 13 words has a kept gram at the same place on both sides. A kept
gram carries the hashes of the windows that chose it. The fingerprints are joined
on gram and window, so that a common gram alone makes no pair, and each hit is
extended word by word to both sides as far as a 13-word window around it can
reach; a run of 13 or more equal words is contamination. An item of fewer than
13 words is one window: every gram of that length is looked up, so it can not
be missed either.

Documents are read once. A fixed-size bit table of the benchmark's windows is
sent to the tasks, so that only fingerprints which may match leave them; its
size does not depend on the data, and a full table only sends more rows. The
join itself is left to Spark, which broadcasts the written benchmark table
only under its own size limit and splits skewed keys otherwise.

Defined results:

* null or wordless text: no words, no hits, not contaminated;
* null or wordless item: has no window; items with equal windows are each
  reported; a null item_id is not counted; an id repeated on several rows
  counts once, with the windows of all of them;
* rows are told apart by doc_id and text: equal rows give equal results;
* empty tables: no rows, or no hits; other columns are ignored.

Memory of a task is a small multiple of 2 MB of text, or of its longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import bound_batches, pick, same, stage
from gaugeflow.llm.words import Words, grams, text_slices, words_of

SPAN = 13
K = 5
WINDOW = SPAN - K + 1
TABLE_BITS = 26  # of the bit table: 8 MB
CHUNK_BITS = 15  # of one row of it

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def winnow(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window, in order: the word index of the K-gram that it keeps,
    the hash of that gram, and the window's own."""
    h, _ = grams(w, K)
    window, whole = grams(w, SPAN)
    n = len(window)
    if not n:
        return np.zeros(0, np.int64), h[:0], window
    low, at = h[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, WINDOW):
        nxt = h[j:j + n]
        better = nxt <= low
        at[better] = j
        np.minimum(low, nxt, out=low)
    at = (np.arange(n) + at)[whole]
    return at, h[at], window[whole]


def _kept(w: Words, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(window length, word indexes, gram hashes, window hashes): winnowed
    grams for the full span, and every gram of each shorter length."""
    yield SPAN, *winnow(w)
    for n in lengths:
        h, whole = grams(w, n)
        at = np.flatnonzero(whole)
        yield n, at, h[at], h[at]


HITS = "array<struct<span:int, at:int, hash:long, left:int, near:string, wins:array<long>>>"


def _fingerprints(df: DataFrame, of_items: bool, lengths: list[int], table=None) -> DataFrame:
    """``df`` (with ``text``) plus ``n_words`` and ``hits``: the kept grams
    with the words around them that a 13-word window can reach. Without
    ``table`` all are kept; ``of_items``: a text shorter than 13 words gives
    the one gram that it is."""
    names = [c for c in df.columns if c != "text"]
    schema = df.select(*names, F.lit(0).alias("n_words"), F.lit(None).cast(HITS).alias("hits")).schema
    arrow_hits = pa.list_(pa.struct([("span", pa.int32()), ("at", pa.int32()), ("hash", pa.int64()),
                                     ("left", pa.int32()), ("near", pa.string()), ("wins", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else np.frombuffer(table.value, np.uint8)
        for b in batches:
            for row, data, off in text_slices(b.column(b.schema.get_field_index("text"))):
                w = words_of(data, off)
                count = np.diff(w.first)
                hits: list[list[dict]] = [[] for _ in count]
                for span, at, h, win in _kept(w, sorted({int(c) for c in count if 0 < c < SPAN}) if of_items else lengths):
                    if of_items and span < SPAN:
                        own = (count[w.doc[at]] == span)
                        at, h, win = at[own], h[own], win[own]
                    if bits is not None:
                        slot = win >> np.uint64(64 - TABLE_BITS)
                        on = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        at, h, win = at[on], h[on], win[on]
                    reach = SPAN - K if span == SPAN else 0
                    if not len(at):
                        continue
                    at, first = np.unique(at, return_index=True)  # windows that keep one gram follow each other
                    wins = np.split(win.view(np.int64), first[1:])
                    for i, x, ws in zip(at.tolist(), h[first].view(np.int64).tolist(), wins, strict=True):
                        d = int(w.doc[i])
                        lo = max(i - reach, int(w.first[d]))
                        hi = min(i + (SPAN if span == SPAN else span), int(w.first[d + 1]))
                        near = w.lower[w.start[lo]:w.end[hi - 1]].tobytes().decode("utf-8", "replace")
                        hits[d].append({"span": span, "at": i - int(w.first[d]), "hash": x, "left": i - lo, "near": near, "wins": ws})
                part = b.slice(row, len(count))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in names],
                     pa.array(count, pa.int32()), pa.array(hits, arrow_hits)], [*names, "n_words", "hits"])

    return df.mapInArrow(run, schema)


def _bit_table(spark, marks: DataFrame):
    """The windows of ``marks`` as a bit table of 2**TABLE_BITS bits, gathered
    in rows of 2**CHUNK_BITS; its size is fixed."""
    slot = F.shiftrightunsigned("win", 64 - TABLE_BITS)
    rows = marks.select(slot.alias("slot")).groupBy(F.shiftright("slot", CHUNK_BITS).alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))).alias("bits")).collect()
    out = bytearray(1 << (TABLE_BITS - 3))
    width = 1 << (CHUNK_BITS - 3)
    for r in rows:
        out[r.chunk * width:(r.chunk + 1) * width] = r.bits[:width]
    return spark.sparkContext.broadcast(bytes(out))


def extend(doc: list[str], left: int, item: list[str], item_left: int) -> tuple[int, int]:
    """Words that agree before and from the aligned places on."""
    back = 0
    while back < min(left, item_left) and doc[left - back - 1] == item[item_left - back - 1]:
        back += 1
    ahead, most = 0, min(len(doc) - left, len(item) - item_left)
    while ahead < most and doc[left + ahead] == item[item_left + ahead]:
        ahead += 1
    return back, ahead


def paired(hits: DataFrame, near: DataFrame) -> DataFrame:
    """Each hit with the benchmark contexts of its gram that hold its window:
    but for hashes that collide, no pair without a shared window."""
    return hits.join(near, ["hash", "span", "win"])


def _extended(pairs: DataFrame) -> DataFrame:
    """Hits that hold a window: the covered words and the benchmark context."""
    def run(batches):
        for pdf in batches:
            words: dict[str, list[str]] = {}  # of the benchmark contexts of this batch
            lo, hi = [], []
            for r in pdf.itertuples(index=False):
                if r.near2 not in words:
                    words[r.near2] = _WORD.findall(r.near2)
                back, ahead = extend(_WORD.findall(r.near), r.left, words[r.near2], r.left2)
                ok = back + ahead >= r.span
                lo.append(r.at - back if ok else -1)
                hi.append(r.at + ahead if ok else -1)
            pdf = pdf[["doc_id", "mark", "context"]].assign(lo=lo, hi=hi)
            yield pdf[pdf["lo"] >= 0]

    return pairs.mapInPandas(run, "doc_id long, mark long, context long, lo int, hi int")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, ``mark`` (hash of its text), ``n_words``,
    ``n_hit`` (words inside an occurrence of a window), ``n_items``,
    ``items_sha256`` and ``contaminated``."""
    spark = documents.sparkSession
    bound_batches(spark)
    items = stage(_fingerprints(pick(benchmark, item_id="item_id", text="text"), True, [])
                  .select("item_id", F.explode("hits").alias("hit")).select("item_id", "hit.*"), "bench")
    near = stage(items.select("span", "hash", F.explode("wins").alias("win"), F.col("left").alias("left2"), F.col("near").alias("near2"))
                 .distinct().withColumn("context", F.xxhash64("span", "hash", "left2", "near2")), "bench-contexts")
    members = stage(items.filter("item_id is not null").select(
        F.xxhash64("span", "hash", "left", "near").alias("context"),
        F.col("item_id").cast("string").alias("item")).distinct(), "bench-items")
    lengths = sorted(r[0] for r in near.filter(F.col("span") < SPAN).select("span").distinct().collect())  # 12 at most

    docs = pick(documents, doc_id="doc_id", text="text").withColumn("mark", F.xxhash64("text"))
    found = stage(_fingerprints(docs, False, lengths, _bit_table(spark, near)), "bench-hits")
    hits = found.filter(F.size("hits") > 0).select("doc_id", "mark", F.explode("hits").alias("hit")).select(
        "doc_id", "mark", "hit.*").withColumn("win", F.explode("wins")).drop("wins")
    runs = stage(_extended(paired(hits, near)).distinct(), "bench-runs")

    earlier = Window.partitionBy("doc_id", "mark").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    covered = runs.select("doc_id", "mark", "lo", "hi").distinct().withColumn(
        "from", F.greatest("lo", F.max("hi").over(earlier))).groupBy("doc_id", "mark").agg(
        F.sum(F.greatest(F.lit(0), F.col("hi") - F.col("from"))).alias("n_hit"))
    named = runs.select("doc_id", "mark", "context").distinct().join(members, "context").select(
        "doc_id", "mark", "item").distinct().groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    base = found.select("doc_id", "mark", F.col("n_words").cast("long").alias("n_words"))
    out = base.join(covered, same(base, covered, "doc_id", "mark"), "left").select(base["*"], "n_hit")
    out = out.join(named, same(out, named, "doc_id", "mark"), "left").select(out["*"], "items")
    return out.select(
        "doc_id", "mark", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated."""
    bad = stage(decontaminate(documents, benchmark).filter("contaminated").select(
        "doc_id", "mark").distinct(), "bench-bad")
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["doc_id"])
                          & (F.xxhash64(documents["text"]) == bad["mark"]), "left_anti")


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE_SQL = f"""
WITH i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), {SPAN}) AS n, unnest(range(1, greatest(len(w) - {SPAN - 1}, 1) + 1)) AS p, w FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM win),
d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
dp AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g FROM dp),
hit AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON iw.g = dw.g AND iw.n = dw.n),
pos AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hit),
cnt AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cnt ON cnt.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""
