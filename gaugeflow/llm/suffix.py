"""Removal of repeated byte strings through a logarithmic suffix index family.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts
earlier: in a smaller doc_id, or earlier in the same document.

A full suffix array of a large corpus would hold a row per byte. This one is
sparse: a suffix starts at an *anchor*, the smallest ``K``-byte hash of a
window of ``LENGTH`` bytes (the rightmost of equals). Every window has one
anchor and equal windows have it at the same place, so no repeat is missed.
An entry stands for the run of windows that share an anchor; it holds the
hash of its ``K`` bytes (``key``, the order of the array) and of all bytes
that its windows cover (``ctx``).

1. Batches of texts become sorted suffix arrays, in which repeats inside the
   batch are settled; the rest is dealt out by key.
2. Each key range holds a family of sorted levels. A new batch is scanned
   against every level: of entries with equal context the later one is a
   repeat, the earlier one stays. Levels of equal size are merged, so there
   are about log(batches) of them.
3. Entries left with a key but different contexts match in part, as at the
   ends of a copied passage. Their bytes are fetched and their windows are
   compared one by one, as bytes.

A key with very many different contexts (a common line among ever different
neighbours) would pile up in one task. Such keys are found in a sample of whole
documents, bounded in bytes, and their windows become entries of their own, keyed by all
their bytes; equal ones are settled per batch first. Those that the sample
missed are counted over all entries before step 3, where their windows are grouped
and joined by Spark. The answer is the same.

Defined results:

* null text: no bytes; texts under ``LENGTH`` bytes keep all;
* a null doc_id comes after all others, and all nulls are one id;
* rows with one doc_id: the string that starts at the smaller offset is the
  earlier one, at equal offsets neither is; rows equal in all are returned
  alike. Rows of one doc_id are told apart by a 64-bit hash of their text
  (``mark``);
* empty table: empty result; other columns are ignored.

Contexts are compared by two 64-bit hashes, part matches by their bytes, those
of keys with over ``WIDE`` contexts by a 128-bit hash of each window.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import bound_batches, pick, stage
from gaugeflow.llm.words import BASE, mix, powers

LENGTH = 100
K = 24
SLICE_BYTES = 1 << 19      # of text whose anchors are found together
ARRAY = 200_000            # entries from which a suffix array is dealt out
PART_BYTES = 8 << 20       # of text whose entries make one key range
BATCH = 1 << 15            # entries added to a family at once
SAMPLE_BYTES = 64 << 20    # of whole texts, as expected, to find keys with very many contexts
MANY = 8                   # contexts in the sample that make a key such a one
WIDE = 256                 # contexts to compare, of all rows, from which a key's windows are grouped by Spark
RANGES = 64                # key ranges that one task reads in turn, at most
LAST = (1 << 63) - 1       # stands for a null doc_id
CTX_BASE = 0xC2B2AE3D27D4EB4F

# An entry's place: anchor (31 bits), anchor - first window (7), windows - 1 (7).
_AT, _LEFT = 14, 7
FIELDS = ("key", "ctx", "doc", "place", "mark")


@dataclass
class Entries:
    key: np.ndarray
    ctx: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    mark: np.ndarray | None = None  # with doc, the row; by default one row per doc

    def __post_init__(self):
        if self.mark is None:
            self.mark = np.zeros(len(self.key), np.int64)

    def __len__(self) -> int:
        return len(self.key)

    def take(self, i) -> Entries:
        return Entries(*[getattr(self, f)[i] for f in FIELDS])

    @classmethod
    def join(cls, parts: list[Entries]) -> Entries:
        if not parts:
            return cls(*[np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.uint64, np.int64)])
        return cls(*[np.concatenate([getattr(p, f) for p in parts]) for f in FIELDS])

    def ordered(self) -> Entries:
        return self.take(np.lexsort((self.mark, self.place, self.doc, self.ctx, self.key)))

    def firsts(self) -> np.ndarray:
        """For each sorted entry, the first one of its key and context."""
        first = np.arange(len(self))
        first[1:][(self.key[1:] == self.key[:-1]) & (self.ctx[1:] == self.ctx[:-1])] = 0
        return np.maximum.accumulate(first)

    def first_of(self, other: Entries) -> np.ndarray:
        """For each entry of ``other``, the first one here of its key and
        context, or -1: a binary search for the key, then for the context
        inside the key, so that it costs the same for a key with many."""
        lo = np.searchsorted(self.key, other.key)
        end = np.searchsorted(self.key, other.key, "right")
        hi = end.copy()
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            less = self.ctx[mid] < other.ctx[open_]
            lo[open_[less]], hi[open_[~less]] = mid[less] + 1, mid[~less]
        hit = np.flatnonzero(lo < end)
        hit = hit[self.ctx[lo[hit]] == other.ctx[hit]]
        out = np.full(len(other), -1)
        out[hit] = lo[hit]
        return out

    def at(self) -> np.ndarray:
        return self.place >> np.uint64(_AT)

    def bytes_from(self) -> np.ndarray:
        return (self.at() - (self.place >> np.uint64(_LEFT) & np.uint64(127))).astype(np.int64)

    def bytes_to(self) -> np.ndarray:
        return self.bytes_from() + (self.place & np.uint64(127)).astype(np.int64) + LENGTH

    def pack(self) -> bytes:
        import zstandard

        return zstandard.ZstdCompressor(level=1).compress(b"".join(
            np.ascontiguousarray(getattr(self, f)).tobytes() for f in FIELDS))

    @classmethod
    def unpack(cls, data: bytes) -> Entries:
        import zstandard

        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint64).reshape(len(FIELDS), -1)
        return cls(raw[0], raw[1], raw[2].view(np.int64), raw[3], raw[4].view(np.int64))


def _later(doc: np.ndarray, at: np.ndarray, doc2: np.ndarray, at2: np.ndarray) -> np.ndarray:
    return (doc > doc2) | ((doc == doc2) & (at > at2))


def settle(e: Entries) -> tuple[Entries, Entries]:
    """(entries that stay, repeats) of sorted entries: of equal contexts all
    but the earliest are repeats. Equal entries are kept once."""
    if not len(e):
        return e, e
    same = (e.key[1:] == e.key[:-1]) & (e.ctx[1:] == e.ctx[:-1])
    equal = np.zeros(len(e), bool)
    equal[1:] = same & (e.doc[1:] == e.doc[:-1]) & (e.place[1:] == e.place[:-1]) & (e.mark[1:] == e.mark[:-1])
    first, at = e.firsts(), e.at()
    repeat = _later(e.doc, at, e.doc[first], at[first])
    return e.take(~repeat & ~equal), e.take(repeat & ~equal)


class Family:
    """Sorted levels of settled entries, each about twice the next."""

    def __init__(self):
        self.levels: list[Entries] = []
        self.repeats: list[Entries] = []

    def add(self, batch: Entries) -> None:
        """Scan a new sorted batch against every level, then make it a level
        and merge levels of about equal size."""
        batch, gone = settle(batch.ordered())
        self.repeats.append(gone)
        for i, level in enumerate(self.levels):
            found = level.first_of(batch)
            mine = np.flatnonzero(found >= 0)
            theirs = found[mine]
            new, old = batch.take(mine), level.take(theirs)
            mine_gone, theirs_gone = np.zeros(len(batch), bool), np.zeros(len(level), bool)
            mine_gone[mine[_later(new.doc, new.at(), old.doc, old.at())]] = True
            theirs_gone[theirs[_later(old.doc, old.at(), new.doc, new.at())]] = True
            # Settled entries of one context all start at the same place, so what holds for the first holds for each.
            theirs_gone = theirs_gone[level.firsts()]
            self.repeats += [batch.take(mine_gone), level.take(theirs_gone)]
            self.levels[i], batch = level.take(~theirs_gone), batch.take(~mine_gone)
        self.levels.append(batch)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) >= len(self.levels[-2]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(settle(Entries.join([a, b]).ordered())[0])

    def split_keys(self) -> Entries:
        """Entries whose key has several contexts."""
        e = Entries.join(self.levels).ordered()
        if not len(e):
            return e
        new_key = np.ones(len(e), bool)
        new_key[1:] = e.key[1:] != e.key[:-1]
        new = new_key.copy()
        new[1:] |= e.ctx[1:] != e.ctx[:-1]
        group = np.cumsum(new_key) - 1
        return e.take(np.bincount(group, weights=new)[group] > 1)


def _sums(data: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), base), out=out[1:])
    return out


def _hash(sums: np.ndarray, base: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mix((sums[hi] - sums[lo]) * powers(len(sums), pow(base, -1, 1 << 64))[lo])


def suffix_array(data: np.ndarray, off: np.ndarray, doc: np.ndarray, mark: np.ndarray, start: np.ndarray,
                 many: np.ndarray) -> Entries:
    """The entries of texts laid end to end in ``data`` at ``off``. ``start``:
    offset of each text's first byte in its document. ``many``: sorted keys
    whose windows become entries of their own."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return Entries.join([])
    sums = _sums(data, BASE)
    low = mix((sums[K:] - sums[:-K]) * powers(len(sums), pow(BASE, -1, 1 << 64))[:len(sums) - K])
    hashes, at, width, most = low, np.arange(len(low), dtype=np.int32), 1, LENGTH - K + 1
    while width < most:  # smallest of 1, 2, 4, .. then all positions; of equals the right one
        step = min(width, most - width)
        right = low[step:] <= low[:-step]
        at = np.where(right, at[step:], at[:-step])
        low = np.where(right, low[step:], low[:-step])
        width += step
    owner = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    s = np.flatnonzero(owner[:n] == owner[LENGTH - 1:])  # windows inside one text
    if not len(s):
        return Entries.join([])
    a = at[s]
    new = np.ones(len(s), bool)
    new[1:] = (a[1:] != a[:-1]) | (owner[s[1:]] != owner[s[:-1]])
    i = np.flatnonzero(new)
    lo, hi, a = s[i], s[np.append(i[1:], len(s)) - 1], a[i].astype(np.int64)
    key, own = hashes[a], owner[lo]
    if len(many):
        slot = np.minimum(np.searchsorted(many, key), len(many) - 1)
        hot = many[slot] == key
        if hot.any():
            count = (hi - lo + 1)[hot]
            w = np.repeat(lo[hot], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            lo, hi, a = np.concatenate([lo[~hot], w]), np.concatenate([hi[~hot], w]), np.concatenate([a[~hot], w])
            key = np.concatenate([key[~hot], _hash(sums, BASE, w, w + LENGTH) ^ np.uint64(LENGTH)])
            own = owner[lo]
    sums = _sums(data, CTX_BASE)
    ctx = _hash(sums, CTX_BASE, lo, hi + LENGTH) ^ mix((a - lo).astype(np.uint64) << np.uint64(8) | (hi - lo).astype(np.uint64))
    where = (a - off[own] + start[own]).astype(np.uint64)
    place = where << np.uint64(_AT) | (a - lo).astype(np.uint64) << np.uint64(_LEFT) | (hi - lo).astype(np.uint64)
    return Entries(key, ctx, doc[own], place, mark[own])


def _slices(b: pa.RecordBatch) -> Iterator[tuple]:
    """(data, off, doc, mark, start) of runs of rows of about SLICE_BYTES; a
    longer text comes in pieces that share LENGTH - 1 bytes."""
    doc = b.column(0).to_numpy(zero_copy_only=False)
    mark = b.column(1).to_numpy(zero_copy_only=False)
    col = b.column(2).cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, "right")) - 1)
        size = off[j] - off[i]
        if size <= SLICE_BYTES:
            yield data[off[i]:off[j]], off[i:j + 1] - off[i], doc[i:j], mark[i:j], np.zeros(j - i, np.int64)
        else:
            for at in range(0, size - LENGTH + 1, SLICE_BYTES - LENGTH + 1):
                part = data[off[i] + at:min(off[i] + at + SLICE_BYTES, off[j])]
                yield part, np.array([0, len(part)]), doc[i:j], mark[i:j], np.array([at])
        i = j


# part: key range of ``data``; else a row per byte range. key null: a repeat.
STEP_SCHEMA = "part int, data binary, doc long, mark long, lo int, hi int, at int, key long"
_STEP = pa.schema([("part", pa.int32()), ("data", pa.binary()), ("doc", pa.int64()), ("mark", pa.int64()),
                   ("lo", pa.int32()), ("hi", pa.int32()), ("at", pa.int32()), ("key", pa.int64())])


def _asked(e: Entries) -> pa.RecordBatch:
    """Rows of entries whose bytes are to be compared."""
    n = len(e)
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(e.doc), pa.array(e.mark),
        pa.array(e.bytes_from().astype(np.int32)), pa.array(e.bytes_to().astype(np.int32)),
        pa.array(e.at().astype(np.int32)), pa.array(e.key.view(np.int64))], schema=_STEP)


def merged(doc: np.ndarray, mark: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """The union of byte ranges, per document, as few ranges in order."""
    if not len(doc):
        return doc, mark, lo, hi
    order = np.lexsort((lo, mark, doc))
    doc, mark, lo, hi = doc[order], mark[order], lo[order], hi[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    # Ranges of later documents lie above those of earlier ones, so that one
    # running maximum serves all.
    base = (np.cumsum(new) - 1) << 32
    top = np.maximum.accumulate(base + hi)
    new[1:] |= (base + lo)[1:] > top[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], mark[first], lo[first], (top - base)[last]


def _repeats(e: Entries, parts: int) -> pa.RecordBatch:
    """Rows of the byte ranges that repeats cover."""
    doc, mark, lo, hi = merged(e.doc, e.mark, e.bytes_from(), e.bytes_to())
    n = len(doc)
    blank = pa.nulls(n, pa.int32())
    to = mix(doc.view(np.uint64) ^ mark.view(np.uint64)) % np.uint64(parts)  # neither one id nor one text is in one part
    return pa.RecordBatch.from_arrays([
        pa.array(to.astype(np.int32)), pa.nulls(n, pa.binary()), pa.array(doc), pa.array(mark),
        pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), blank, pa.nulls(n, pa.int64())], schema=_STEP)


def _arrays(docs: DataFrame, parts: int, many) -> DataFrame:
    """Step 1: packed suffix arrays by key range, and repeats inside a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.frombuffer(many.value, np.uint64)

        def dealt(pieces: list[Entries]) -> Iterator[pa.RecordBatch]:
            e, gone = settle(Entries.join(pieces).ordered())
            if len(gone):
                yield _repeats(gone, parts)
            to = (e.key % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            got, first = np.unique(to[order], return_index=True)
            blank = pa.nulls(len(got), pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(got, pa.int32()), pa.array([e.take(i).pack() for i in np.split(order, first[1:])][:len(got)], pa.binary()),
                pa.nulls(len(got), pa.int64()), pa.nulls(len(got), pa.int64()), blank, blank, blank, pa.nulls(len(got), pa.int64())], schema=_STEP)

        pieces, n = [], 0
        for b in batches:
            for piece in _slices(b):
                pieces.append(suffix_array(*piece, hot))
                n += len(pieces[-1])
                if n >= ARRAY:
                    yield from dealt(pieces)
                    pieces, n = [], 0
        yield from dealt(pieces)

    return docs.mapInArrow(run, STEP_SCHEMA)


def _families(arrays: DataFrame) -> DataFrame:
    """Step 2, on rows that come by key range: repeats, and entries to compare."""
    def finish(family: Family, waiting: list[Entries]) -> Iterator[pa.RecordBatch]:
        family.add(Entries.join(waiting))
        asked = family.split_keys()
        if len(asked):
            yield _asked(asked)
        gone = Entries.join(family.repeats)
        if len(gone):
            yield _repeats(gone, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, family, waiting, n = None, Family(), [], 0
        for b in batches:
            packed = pc.is_valid(b.column(1))
            plain = b.filter(pc.invert(packed))
            if plain.num_rows:
                yield plain
            rows = b.filter(packed)
            for part, data in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                if part != now:
                    if now is not None:
                        yield from finish(family, waiting)
                    now, family, waiting, n = part, Family(), [], 0
                waiting.append(Entries.unpack(data.as_py()))
                n += len(waiting[-1])
                if n >= BATCH:
                    family.add(Entries.join(waiting))
                    waiting, n = [], 0
        if now is not None:
            yield from finish(family, waiting)

    return arrays.mapInArrow(run, STEP_SCHEMA)


def _packed_texts(docs: DataFrame, once: bool = False) -> DataFrame:
    """``docs`` with compressed texts, for a smaller shuffle. ``once``: of
    equal rows in a batch only the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            if once:
                row = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
                b = b.take(pa.array(np.sort(np.unique(row, axis=0, return_index=True)[1])))
            data = [z.compress(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(data, pa.binary()), b.column(3)],
                                             ["doc", "mark", "data", "doc_id"])

    return docs.mapInArrow(run, "doc long, mark long, data binary, doc_id long")


def _contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The bytes of the entries to compare: (key, doc, mark, lo, data)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for b in batches:
            for doc, mark, packed, asks in zip(b.column(0), b.column(1), b.column(2), b.column(3), strict=True):
                text, asks = z.decompress(packed.as_py()), asks.as_py()
                yield pa.RecordBatch.from_pydict({
                    "key": [x["key"] for x in asks], "doc": [doc.as_py()] * len(asks), "mark": [mark.as_py()] * len(asks),
                    "lo": [x["lo"] for x in asks], "data": [text[x["lo"]:x["hi"]] for x in asks]},
                    pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("lo", pa.int32()), ("data", pa.binary())]))

    lists = asked.select("doc", "mark", F.struct("key", "lo", "hi").alias("ask")).distinct().groupBy("doc", "mark").agg(
        F.collect_list("ask").alias("asks"))
    # Equal rows ask for the same bytes. Most go before the shuffle; the join has dealt the rest to one task already.
    texts = _packed_texts(docs, once=True).select("doc", "mark", "data").join(lists, ["doc", "mark"]).dropDuplicates(["doc", "mark"])
    return texts.select("doc", "mark", "data", "asks").mapInArrow(run, "key long, doc long, mark long, lo int, data binary")


def windows_seen(rows: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """(doc, mark, from, to) of the byte ranges of ``rows`` (doc, lo, mark,
    data) whose windows start earlier in another row."""
    seen: dict[bytes, tuple[int, int]] = {}
    for doc, lo, _, data in sorted(rows):
        for i in range(len(data) - LENGTH + 1):
            w = data[i:i + LENGTH]
            if w not in seen or (doc, lo + i) < seen[w]:
                seen[w] = (doc, lo + i)
    for doc, lo, mark, data in rows:
        run = None
        for i in range(len(data) - LENGTH + 1):
            if seen[data[i:i + LENGTH]] < (doc, lo + i):
                run = (run[0] if run else i, i)
            elif run:
                yield doc, mark, lo + run[0], lo + run[1] + LENGTH
                run = None
        if run:
            yield doc, mark, lo + run[0], lo + run[1] + LENGTH


def _windows(contexts: DataFrame) -> DataFrame:
    """A row per window of the contexts: two hashes of it, and its place."""
    names = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("lo", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for doc, mark, lo, data in zip(*[b.column(i).to_pylist() for i in (1, 2, 3, 4)], strict=True):
                n = len(data) - LENGTH + 1
                both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[i:i + LENGTH]) for i in range(n)), np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(both[::2]), pa.array(both[1::2]), pa.array(np.full(n, doc)), pa.array(np.full(n, mark)),
                    pa.array(np.arange(lo, lo + n, dtype=np.int32))], schema=names)

    return contexts.mapInArrow(run, "w1 long, w2 long, doc long, mark long, lo int")


def _compared_wide(contexts: DataFrame) -> DataFrame:
    """Step 3 for keys with very many contexts: a grouping finds where each
    window starts first, a join the windows that start later. Each task sends
    one row per window to the grouping, and the join splits a window that
    stands in very many documents, so that no task holds a whole key."""
    windows = stage(_windows(contexts), "suffix-windows")
    place = F.struct("doc", F.col("lo").alias("at"))
    first = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(
        F.col("first") < F.col("last")).select("w1", "w2", "first")
    return windows.join(first, ["w1", "w2"]).filter(F.col("first") < place).select(
        "doc", "mark", "lo", (F.col("lo") + LENGTH).alias("hi"))


def _compared(contexts: DataFrame, parts: int) -> DataFrame:
    """Step 3: the entries of one key, window by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []
        names = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), names.types, strict=True)], schema=names)

        for b in batches:
            for key, doc, mark, lo, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if key != now:
                    out += windows_seen(rows)
                    now, rows = key, []
                    if len(out) >= 10_000:
                        yield batch()
                        out = []
                rows.append((doc, lo, mark, data))
        out += windows_seen(rows)
        if out:
            yield batch()

    return contexts.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "doc long, mark long, lo int, hi int")


def _cut(docs: DataFrame, ranges: DataFrame, with_bytes: bool) -> DataFrame:
    """The rest of every text after its byte ranges are taken out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()

        def batch(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                ids, pa.array([x[0] for x in out], pa.int64()), pa.array([x[0] - len(x[2]) for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.int64()), pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string()),
                pa.array([x[2] if with_bytes else None for x in out], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

        for b in batches:
            first, out, size = 0, [], 0
            for i, (packed, spans) in enumerate(zip(b.column(1), b.column(2), strict=True)):
                if size > SLICE_BYTES:
                    yield batch(b.column(0).slice(first, i - first), out)
                    first, out, size = i, [], 0
                text = z.decompress(packed.as_py())
                size += len(text)
                kept, at, n = [], 0, 0
                end = -1  # of the removed run that is being read
                for x in sorted(spans.as_py() or []):
                    lo, hi = x >> 32, x & 0xFFFFFFFF
                    if lo > end:
                        kept.append(text[at:lo])
                        n += 1
                    end = at = max(end, hi)
                kept.append(text[at:])
                out.append((len(text), n, b"".join(kept)))
            yield batch(b.column(0).slice(first), out)

    lists = ranges.groupBy("doc", "mark").agg(F.collect_list(
        F.shiftleft(F.col("lo").cast("long"), 32).bitwiseOR(F.col("hi").cast("long"))).alias("spans"))
    rows = _packed_texts(docs).join(lists, ["doc", "mark"], "left").select("doc_id", "data", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(documents: DataFrame, with_bytes: bool = True) -> DataFrame:
    """A row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256`` and ``kept`` (the bytes left; a
    removed run can end inside a character). ``with_bytes`` False leaves
    ``kept`` null, for callers that need the counts and digests alone."""
    spark = documents.sparkSession
    bound_batches(spark)
    text = F.coalesce("text", F.lit(""))
    docs = pick(documents, doc_id="doc_id", text="text").select(
        F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("mark"),
        text.cast("binary").alias("text"), "doc_id")
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(n_bytes / PART_BYTES))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in _slices(b):
                e = suffix_array(*piece, np.zeros(0, np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(e.key.view(np.int64)), pa.array(e.ctx.view(np.int64))], ["key", "ctx"])

    sample = docs.filter(F.pmod(F.xxhash64("doc", "mark"), F.lit(max(1, n_bytes // SAMPLE_BYTES))) == 0)
    hot = sample.select("doc", "mark", "text").mapInArrow(hashed, "key long, ctx long").distinct().groupBy("key").count().filter(
        F.col("count") >= MANY).select("key").collect()  # at most the sample's entries / MANY
    many = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64)).tobytes())

    tasks = min(parts, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(parts / RANGES)))
    arrays = _arrays(docs.select("doc", "mark", "text"), parts, many)
    found = stage(_families(arrays.repartition(tasks, "part").sortWithinPartitions("part")).drop("part", "data"), "suffix-found")
    asked = found.filter("key is not null")
    wide = stage(asked.groupBy("key").count().filter(F.col("count") > WIDE).select("key"), "suffix-wide")
    ranges = found.filter("key is null").select("doc", "mark", "lo", "hi")
    if not wide.isEmpty():
        ranges = ranges.unionByName(_compared_wide(_contexts(docs, asked.join(wide, "key", "left_semi"))))
        asked = asked.join(wide, "key", "left_anti")
    return _cut(docs, ranges.unionByName(_compared(_contexts(docs, asked), tasks)), with_bytes)
