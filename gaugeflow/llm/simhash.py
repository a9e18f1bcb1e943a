"""SimHash near-duplicates, linked through a vantage-point tree.

A fingerprint has 64 bits. The tree has one level per block of bits: a level
holds a vantage point, and its children are the rings of equal Hamming
distance to that point within the block. By the triangle inequality a query
at ring ``d`` reaches only children whose ring differs by no more than the
bits that may still differ; and as the blocks are disjoint, the differences
of all levels add up, so the budget shrinks on the way down.

The upper tree has four wide blocks, from some 2e10 fingerprints on eight. Its
leaves are shards: every fingerprint goes to its own and, as a query, to those
across a boundary, 21 or 73 in all for a radius of two, however large the corpus.
A shard is searched inside its task by the lower tree, whose blocks are parts of
the upper ones seen from the same vantage points: a ring above is then the sum
of its rings below, and a lower path belongs to one shard. The lower tree is deep
enough that a path meets few fingerprints, and each one met is checked exactly.
The fingerprints of a shard with over ``PIECE`` are dealt by hash into pieces, and so
are its queries; each pair of the two is a cell of its own. A task holds the
fingerprints of one cell and streams the queries past them.

Only a bounded sample of fingerprints reaches the driver, to choose the vantage
points; they change the balance of the tree, never its answers.

Defined results:

* null or blank text: fingerprint zero, linked like any other;
* under ``shingle`` words: the whole word sequence is the only shingle;
* null doc_id: takes part, and is not a candidate for ``component_id`` unless
  all of its component are null, which gives null;
* repeated rows: each is returned; :func:`one_per_group` keeps one of them;
* empty table: empty result; other columns pass or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import bound_batches, pick, stage
from gaugeflow.llm.components import components

BITS = 64
SEED = 42
SAMPLE = 1024          # fingerprints sampled to choose vantage points
CANDIDATES = 16        # vantage points tried per level
SHINGLES_AT_ONCE = 1 << 16
SHARD_LEVELS = [4, 8]  # of the upper tree
DEPTHS = [4, 8, 16]    # of the lower tree; a path's number, one digit per level, fits 63 bits
PIECE = 1 << 23        # fingerprints of a shard that a task holds
QUERIES = 1 << 19      # rows searched at once
ASKING = 1 << 18       # fingerprints whose queries are made by one task
PAIRS = 1 << 22        # candidates checked at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of one text, as an unsigned 64-bit number."""
    import xxhash

    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    words = (text or "").encode("utf-8", "surrogatepass").translate(lower).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest, ones, n, part = xxhash.xxh64_digest, np.zeros(BITS, np.int64), 0, []

    def add() -> None:
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8).reshape(-1, 8), axis=1)
        ones[:] += bits.sum(axis=0, dtype=np.int64)

    for g in grams:
        part.append(digest(g, SEED))
        if len(part) == SHINGLES_AT_ONCE:
            add()
            n, part = n + len(part), []
    if part:
        add()
        n += len(part)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``df`` plus the signed 64-bit fingerprint of its column ``text``."""
    bound_batches(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps)], [*b.schema.names, out])

    return df.mapInArrow(run, schema)


def _blocks(levels: int) -> list[int]:
    """The bit masks of the levels: disjoint, together all 64 bits."""
    edges = [round(i * BITS / levels) for i in range(levels + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]


def _levels(n: int, radius: int = 2) -> int:
    """The depth at which a lower leaf is expected to hold at most one of ``n``
    random fingerprints, or the deepest whose numbers fit 63 bits: two of them
    share a ring of a w-bit block with probability C(2w, w) / 4**w."""
    from math import comb

    fit = [x for x in DEPTHS if _base(x, radius) ** x < 1 << 63]
    for levels in fit:
        share = 1.0
        for mask in _blocks(levels):
            w = mask.bit_count()
            share *= comb(2 * w, w) / 4.0 ** w
        if n * share <= 1:
            return levels
    return fit[-1]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _vantage_points(sample: list[int], masks: list[int]) -> list[int]:
    """Per level the candidate that spreads the sample best over its rings."""
    if not sample:
        return [0] * len(masks)
    a = np.array([x & ((1 << BITS) - 1) for x in sample], np.uint64)
    out = []
    for m in masks:
        spread = [np.bitwise_count((a ^ v) & np.uint64(m)).astype(float).var() for v in a[:CANDIDATES]]
        out.append(int(a[int(np.argmax(spread))]))
    return out


def _steps(levels: int, radius: int) -> set[tuple[tuple[int, int], ...]]:
    """The ring differences, as (level, difference), that a radius allows."""
    steps: set[tuple[tuple[int, int], ...]] = {()}
    for r in range(1, radius + 1):
        for at in combinations(range(levels), r):
            def fill(i: int, left: int, at=at) -> list[tuple[int, ...]]:
                if i == len(at):
                    return [()]
                return [(s * d, *rest) for d in range(1, left - (len(at) - i - 1) + 1) for s in (1, -1)
                        for rest in fill(i + 1, left - d, at)]
            steps.update(tuple(zip(at, v, strict=True)) for v in fill(0, radius))
    return steps


def _paths(levels: int, radius: int, base: int) -> list[int]:
    """Leaf offsets within the budget, one of each opposite pair (the other
    end of a link finds the other one)."""
    return sorted(sum(d * base ** lv for lv, d in s) for s in _steps(levels, radius) if not s or s[-1][1] > 0)


def _base(levels: int, radius: int) -> int:
    """No two paths share a number in this base."""
    return max(m.bit_count() for m in _blocks(levels)) + 1 + radius


def _below(top: int, levels: int, radius: int) -> dict[int, list[int]]:
    """For each shard offset to ask, the lower leaf offsets to look up there;
    of each opposite pair of lower paths one."""
    base, low, each = _base(top, radius), _base(levels, radius), levels // top
    out: dict[int, list[int]] = {}
    for s in _steps(levels, radius):
        shard = sum(d * base ** (lv // each) for lv, d in s)
        leaf = sum(d * low ** lv for lv, d in s)
        if (shard, leaf) >= (0, 0):
            out.setdefault(shard, []).append(leaf)
    return out


def _shard_levels(n: int) -> int:
    """The depth at which the fullest shard of ``n`` random fingerprints is
    expected to be a few pieces at most."""
    from math import comb

    for top in SHARD_LEVELS:
        share = 1.0
        for mask in _blocks(top):
            w = mask.bit_count()
            share *= comb(w, w // 2) / 2.0 ** w
        if n * share <= 4 * PIECE:
            return top
    return SHARD_LEVELS[-1]


def _leaves(fp: np.ndarray, points: list[int], masks: list[int], base: int) -> np.ndarray:
    """The lower leaf of each fingerprint."""
    out = np.zeros(len(fp), np.int64)
    for i, (v, m) in enumerate(zip(points, masks, strict=True)):
        out += np.bitwise_count((fp ^ np.uint64(v)) & np.uint64(m)).astype(np.int64) * base ** i
    return out


def _met(points: np.ndarray, leaves: np.ndarray, asked: np.ndarray, wanted: np.ndarray, max_bits: int) -> Iterator[np.ndarray]:
    """Pairs within ``max_bits`` of each of ``asked`` and the ``points``,
    ordered by leaf, whose leaf is the wanted one."""
    lo = np.searchsorted(leaves, wanted)
    count = np.searchsorted(leaves, wanted, "right") - lo
    some = np.flatnonzero(count)
    lo, count, asked = lo[some], count[some], asked[some]
    part = np.cumsum(count) // PAIRS
    for i in np.split(np.arange(len(some)), np.flatnonzero(np.diff(part)) + 1):
        c = count[i]
        q = np.repeat(asked[i], c)
        p = points[np.repeat(lo[i] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        near = (q != p) & (np.bitwise_count(q ^ p) <= max_bits)
        yield np.stack([q[near], p[near]]).view(np.int64)


def _searched(shards: DataFrame, points: list[int], top: int, levels: int, max_bits: int) -> DataFrame:
    """Links of ``shards`` (shard, cell, step, fp), whose rows come by shard and
    cell: first its fingerprints, without a step, then the queries."""
    masks, base = _blocks(levels), _base(levels, max_bits)
    own = [points[i * top // levels] for i in range(levels)]
    below = {s: np.array(x, np.int64) for s, x in _below(top, levels, max_bits).items()}
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    most = QUERIES

    def found(held: np.ndarray, asked: np.ndarray, steps: np.ndarray) -> Iterator[pa.RecordBatch]:
        leaves = _leaves(held, own, masks, base)
        order = np.argsort(leaves)
        held, leaves = held[order], leaves[order]
        at = _leaves(asked, own, masks, base)
        order = np.argsort(at)
        asked, steps, at = asked[order], steps[order], at[order]
        for step in np.unique(steps).tolist():
            mine = steps == step
            for offset in below[step]:
                for q, p in _met(held, leaves, asked[mine], at[mine] + offset, max_bits):
                    if len(q):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(q, p)), pa.array(np.maximum(q, p))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells, asked, steps = [], [], [], []
        n, last = 0, None

        def search() -> Iterator[pa.RecordBatch]:
            if held and asked:
                yield from found(np.concatenate(held), np.concatenate(asked), np.concatenate(steps))

        for b in batches:
            if not b.num_rows:
                continue
            if n >= most:
                # Fingerprints come before queries, so of those held only the ones of the last cell are asked again.
                yield from search()
                open_ = np.concatenate(cells) == last
                held, cells = [np.concatenate(held)[open_]], [np.concatenate(cells)[open_]]
                asked, steps, n = [], [], 0
            cell = np.empty(b.num_rows, _CELL)
            cell["shard"], cell["cell"] = b.column(0).to_numpy(), b.column(1).to_numpy()
            fp = b.column(3).to_numpy().view(np.uint64)
            query = pc.is_valid(b.column(2)).to_numpy(zero_copy_only=False)
            held.append(fp[~query])
            cells.append(cell[~query])
            asked.append(fp[query])
            steps.append(pc.fill_null(b.column(2), 0).to_numpy()[query])
            n, last = n + b.num_rows, cell[-1]
        yield from search()

    return shards.mapInArrow(run, "a long, b long")


_CELL = np.dtype([("shard", np.int64), ("cell", np.int64)])


def links(fps: DataFrame, max_bits: int = 2, levels: int | None = None, top: int | None = None) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of different values of ``fps.fp`` with at
    most ``max_bits`` differing bits. ``fps`` should be a written table. The
    depths of the lower and upper tree follow from their number unless ``levels``
    (a multiple of ``top``) and ``top`` are given; they change the work, not the
    pairs."""
    points = stage(fps.select("fp").distinct(), "simhash-points")
    sample = [r[0] for r in points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    n = points.count()
    top = top or min(_shard_levels(n), levels or DEPTHS[-1])
    levels = max(top, levels or _levels(n, max_bits))
    masks = _blocks(top)
    base = _base(top, max_bits)
    vantage = _vantage_points(sample, masks)
    shard = F.lit(0).cast("long")
    for i, (m, v) in enumerate(zip(masks, vantage, strict=True)):
        ring = F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(v))).bitwiseAND(F.lit(_signed(m))))
        shard = shard + ring.cast("long") * F.lit(base ** i)
    tree = stage(points.select("fp", shard.alias("shard")), "simhash-tree")
    large = stage(tree.groupBy("shard").count().filter(F.col("count") > PIECE).select(
        "shard", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces")), "simhash-large")
    pieces = F.coalesce("pieces", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), pieces)
    every = F.explode(F.sequence(F.lit(0), pieces - 1)).alias("i")
    steps = F.array(*[F.lit(o).cast("long") for o in sorted(_below(top, levels, max_bits))])
    asking = tree.repartition(max(1, -(-n // ASKING)), "fp").select("fp", F.col("shard").alias("own"), F.explode(steps).alias("step")).select(
        (F.col("own") + F.col("step")).alias("shard"), "step", "fp")
    asked = asking.join(large, "shard", "left").select("shard", pieces.alias("n"), mine.alias("mine"), every, "step", "fp").select(
        "shard", (F.col("i") * F.col("n") + F.col("mine")).cast("long").alias("cell"), "step", "fp")
    held = tree.join(large, "shard", "left").select("shard", pieces.alias("n"), mine.alias("mine"), every, "fp").select(
        "shard", (F.col("mine") * F.col("n") + F.col("i")).cast("long").alias("cell"), F.lit(None).cast("long").alias("step"), "fp")
    shards = held.unionByName(asked).repartition("shard", "cell").sortWithinPartitions("shard", "cell", F.col("step").asc_nulls_first())
    return _searched(shards, vantage, top, levels, max_bits).distinct()


def _groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root)`` for every fingerprint of the written table ``rows``."""
    roots = components(links(rows, max_bits), "simhash")
    return rows.select("fp").distinct().join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """A row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest doc_id of all that it is linked with,
    directly or through others."""
    docs = pick(documents, doc_id="doc_id", text="text")
    rows = stage(with_fingerprint(docs, shingle=shingle).select("doc_id", "fp"), "simhash")
    groups = stage(_groups(rows, max_bits), "simhash-groups")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("doc")).join(groups, "fp").groupBy("root").agg(
        F.min("doc").alias("component_id"))
    ids = stage(groups.join(least, "root").select("fp", "component_id"), "simhash-ids")
    return rows.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(documents: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``documents`` with one left of each group: that with the
    smallest doc_id, nulls last, and any one of repeated rows."""
    cols = documents.columns
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_doc"), "text", "doc_id",
                           F.monotonically_increasing_id().alias("row"))
    keyed = stage(own, "simhash-rows")  # written, so the row numbers stay
    rows = stage(with_fingerprint(keyed.select("row", "doc_id", "text"), shingle=shingle).drop("text"), "simhash")
    groups = stage(_groups(rows, max_bits), "simhash-groups")
    found = rows.join(groups, "fp")
    first = found.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "row"))["row"].alias("row"))
    gone = stage(rows.select("row").join(first, "row", "left_anti"), "simhash-gone")
    return keyed.join(gone, "row", "left_anti").select("_doc.*")
