"""Resharding by minimum-cost flow: new shards of equal bytes, with as few
bytes as possible moved from the old ones.

A table lies in old shards of any sizes. Inside a shard the rows stand in the
order of a hash, cut into blocks, each a directory of one file or a few; so a
run of blocks is a fair sample of its shard. Old shards supply their bytes, new
shards take up to their capacity; staying in the shard of the same number is
free, moving costs one per byte. The flow of least cost says how many bytes go
from each old shard to each new one: the transfers, at most one more than there
are old and new shards. A transfer is a range of bytes in its old shard's order,
and a row belongs to the range that holds its middle byte.

Only blocks with a row that moves are rewritten, into a second generation of
files, each row with its place; all other files stay as they are. A manifest,
written last, lists the live blocks: readers see the old layout or the new one.

Law: ``bytes``. Rows of at least a 200th of a shard's bytes could upset it when a
range ends inside them, so each is a block of its own: an old shard keeps its
largest while they fit, the others go, largest first, to the shard with the
fewest bytes. What is left of the capacities is for the flow. There are at most
200 such rows per new shard, whatever the table's size: they, the sums of the old
shards and the transfers are all that reaches the driver. A shard misses its
capacity by less than half such a row at each end of its ranges (in large tables
by a few bytes in a million), unless the large rows alone forbid equal shards.

Defined results:

* the size of a row is the UTF-8 bytes of its text and 16; a null text has no
  bytes and the checksum 0;
* equal texts, repeated rows and null doc_ids are rows like any other; equal
  rows may change places with each other, nothing else depends on the order in
  which the table is read;
* slots of a shard count from 0 without gaps: first rows that stayed, then those
  that came, by old shard;
* fewer new shards than old: the shards that end give all their rows;
* empty table: no rows, all shards empty; columns of the caller are kept in one
  struct, so their names can not clash.

The table must be read from files (or be written first): a lost task then deals
its rows as before.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage
from gaugeflow.session import scratch_path

BLOCK_BYTES = 128 << 20
#: A shard has this many blocks at least, so that small moves stay small.
SHARD_BLOCKS = 4
#: Rows of at least this part of a shard are blocks of their own.
LARGE = 200
OVERHEAD = 16
NEVER = 1 << 62

LAYOUT = "at long, size long, row struct<{row}>, shard int, block int"
REWRITTEN = "slot long, size long, row struct<{row}>, shard int, block int"


def min_cost_flow(arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """The flow on each arc (from, to, capacity, cost of at least 0) of a
    maximum flow with the least cost. Shortest paths give every node a
    potential; then all paths of that length are filled at once."""
    nodes = 1 + max(max(u, v) for u, v, *_ in arcs)
    to, room, price = [], [], []
    out: list[list[int]] = [[] for _ in range(nodes)]
    for u, v, capacity, cost in arcs:
        for a, b, r, p in ((u, v, capacity, cost), (v, u, 0, -cost)):
            out[a].append(len(to))
            to.append(b)
            room.append(r)
            price.append(p)
    potential = [0] * nodes
    while True:
        far = [NEVER] * nodes
        far[source] = 0
        queue = [(0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for e in out[u]:
                v = to[e]
                if room[e] and d + price[e] + potential[u] - potential[v] < far[v]:
                    far[v] = d + price[e] + potential[u] - potential[v]
                    heapq.heappush(queue, (far[v], v))
        if far[sink] == NEVER:
            return [room[2 * i + 1] for i in range(len(arcs))]
        potential = [p + min(d, far[sink]) for p, d in zip(potential, far)]
        while _fill(out, to, room, lambda e, u: price[e] + potential[u] == potential[to[e]], source, sink):
            pass


def _fill(out, to, room, tight, source, sink) -> bool:
    """One blocking flow over the tight arcs with room; False if none is left."""
    depth = {source: 0}
    queue = [source]
    for u in queue:
        for e in out[u]:
            if room[e] and to[e] not in depth and tight(e, u):
                depth[to[e]] = depth[u] + 1
                queue.append(to[e])
    if sink not in depth:
        return False
    tried = [0] * len(out)
    path: list[int] = []
    u = source
    while True:
        if u == sink:
            pushed = min(room[e] for e in path)
            for e in path:
                room[e] -= pushed
                room[e ^ 1] += pushed
            first = next(i for i, e in enumerate(path) if not room[e])
            u = to[path[first] ^ 1]
            del path[first:]
            continue
        while tried[u] < len(out[u]):
            e = out[u][tried[u]]
            if room[e] and depth.get(to[e]) == depth[u] + 1 and tight(e, u):
                path.append(e)
                u = to[e]
                break
            tried[u] += 1
        else:
            if not path:
                return True
            u = to[path.pop() ^ 1]
            tried[u] += 1


@dataclass(frozen=True)
class Transfer:
    """Bytes ``lo`` to ``hi`` of the old shard go to the new one (or stay)."""

    old: int
    new: int
    lo: int
    hi: int


def transfers(sizes: dict[int, int], capacities: list[int]) -> list[Transfer]:
    """The moves of fewest bytes from old shards of ``sizes`` into new ones of
    ``capacities`` (the same bytes in all). Each old shard's ranges cover it,
    what stays first. As all moves cost the same, they pass one middle node."""
    olds = sorted(o for o, s in sizes.items() if s)
    if not olds:
        return []
    news = range(len(capacities))
    source, sink, middle = 0, 1, 2
    old_node = {o: 3 + i for i, o in enumerate(olds)}
    new_node = {j: 3 + len(olds) + j for j in news}
    arcs = [(source, old_node[o], sizes[o], 0) for o in olds]
    arcs += [(new_node[j], sink, capacities[j], 0) for j in news]
    stay = {o: len(arcs) + i for i, o in enumerate(x for x in olds if x in new_node)}
    arcs += [(old_node[o], new_node[o], sizes[o], 0) for o in stay]
    leave = {o: len(arcs) + i for i, o in enumerate(olds)}
    arcs += [(old_node[o], middle, sizes[o], 1) for o in olds]
    come = {j: len(arcs) + j for j in news}
    arcs += [(middle, new_node[j], capacities[j], 0) for j in news]
    flow = min_cost_flow(arcs, source, sink)
    out = []
    wanted = [[j, flow[come[j]]] for j in news if flow[come[j]]]
    for o in olds:
        at = flow[stay[o]] if o in stay else 0
        if at:
            out.append(Transfer(o, o, 0, at))
        left = flow[leave[o]]
        while left:
            j, open_bytes = wanted[-1]
            n = min(left, open_bytes)
            out.append(Transfer(o, j, at, at + n))
            at, left, wanted[-1][1] = at + n, left - n, open_bytes - n
            if n == open_bytes:
                wanted.pop()
    return out


def deal_large(rows: list[tuple[int, int]], shards: int, capacity: int) -> tuple[list[int], list[int]]:
    """New shards of large rows, given as (size, old shard), and the bytes that
    each new shard then has. An old shard keeps its largest rows while they fit
    (its largest in any case); the others go to the shard with the fewest bytes."""
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][0], i))
    load, target, rest = [0] * shards, [0] * len(rows), []
    for i in order:
        size, old = rows[i]
        if old < shards and (load[old] == 0 or load[old] + size <= capacity):
            target[i], load[old] = old, load[old] + size
        else:
            rest.append(i)
    queue = [(n, j) for j, n in enumerate(load)]
    heapq.heapify(queue)
    for i in rest:
        n, j = heapq.heappop(queue)
        target[i], load[j] = j, n + rows[i][0]
        heapq.heappush(queue, (load[j], j))
    return target, load


def fill_level(load: list[int], extra: int) -> list[int]:
    """Capacities that bring shards with ``load`` bytes to one level, as far as
    ``extra`` bytes do."""
    order = sorted(range(len(load)), key=lambda j: (load[j], j))
    used, level, n = 0, 0, 0
    for n in range(1, len(order) + 1):
        used += load[order[n - 1]]
        level = (extra + used) // n
        if n == len(order) or level <= load[order[n]]:
            break
    out = [0] * len(load)
    spare = extra + used - level * n
    for i, j in enumerate(order[:n]):
        out[j] = level - load[j] + (1 if i < spare else 0)
    return out


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _row_type(documents: DataFrame) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in documents.schema)


def write_layout(documents: DataFrame, old_shard: Column, old_shards: int, path: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Write ``documents`` in their old shards (0 to ``old_shards`` - 1), cut
    into blocks; returns the sum of the sizes. A row has ``at``, its place
    in its block."""
    size = text_bytes(F.col("text"))
    total = documents.agg(F.sum(size)).first()[0] or 0
    blocks = max(old_shards * SHARD_BLOCKS, -(-total // block_bytes))
    rows = documents.select(
        old_shard.cast("int").alias("shard"), size.alias("size"), F.xxhash64("doc_id", "text").alias("mix"),
        # Equal rows have one hash; the row number lets them part.
        F.monotonically_increasing_id().alias("tie"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    placed = rows.repartitionByRange(blocks, "shard", "mix", "tie").withColumn("block", F.spark_partition_id())
    placed = placed.sortWithinPartitions("shard", "block", "mix", "tie").withColumn(
        "at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed.select("at", "size", "row", "shard", "block").write.partitionBy("shard", "block").parquet(f"{path}/generation=0")
    return total


def plan_moves(layout: DataFrame, total: int, shards: int) -> DataFrame:
    """Pieces of the blocks: rows ``lo`` to ``hi`` of (``shard``, ``block``)
    belong to ``target``, from slot ``base`` on. A written table; ``whole`` says
    that no row of the block moves."""
    spark = layout.sparkSession
    capacity = total // shards
    large = F.col("size") >= max(1, capacity // LARGE)
    rows = layout.select("shard", "block", "at", "size", large.alias("large"))
    big = rows.where("large").select("block", "at", "size", "shard").orderBy("shard", "block", "at").collect()
    target, load = deal_large([(r["size"], r["shard"]) for r in big], shards, capacity)
    sums = rows.where("not large").groupBy("shard", "block").agg(F.sum("size").alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("shard").orderBy("block")) - F.col("bytes")
    sums = stage(sums.select("shard", "block", "bytes", before.alias("before")), "reshard-blocks")
    sizes = {r["shard"]: r["bytes"] for r in sums.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    moves = spark.createDataFrame([(t.old, t.new, t.lo, t.hi) for t in transfers(sizes, fill_level(load, sum(sizes.values())))],
                                  "old int, new int, first long, last long")
    dealt = spark.createDataFrame([(r["block"], r["at"], t) for r, t in zip(big, target)], "block int, at long, dealt int")
    in_block = Window.partitionBy("shard", "block").orderBy("at")
    small = F.when(F.col("large"), 0).otherwise(F.col("size"))
    middle = F.coalesce("before", F.lit(0)) + F.sum(small).over(in_block) - F.ceil(F.col("size") / 2)
    # Both sides have a bound: transfers, and large rows per shard.
    known = rows.join(sums, ["shard", "block"], "left").withColumn("middle", F.when(~F.col("large"), middle)).join(
        F.broadcast(dealt), ["block", "at"], "left")
    known = known.join(F.broadcast(moves), (F.col("shard") == F.col("old")) & (F.col("middle") >= F.col("first"))
                       & (F.col("middle") < F.col("last")), "left").withColumn("target", F.coalesce("dealt", "new"))
    edge = F.lag("target").over(in_block)
    starts = known.withColumn("starts", (edge.isNull() | (edge != F.col("target"))).cast("int"))
    pieces = starts.withColumn("piece", F.sum("starts").over(in_block)).groupBy("shard", "block", "piece").agg(
        F.first("target").alias("target"), F.min("at").alias("lo"), F.max("at").alias("hi"), F.sum("size").alias("bytes"))
    n = F.col("hi") - F.col("lo") + 1
    slots = Window.partitionBy("target").orderBy(F.col("shard") != F.col("target"), "shard", "block", "lo")
    whole = F.min(F.col("shard") == F.col("target")).over(Window.partitionBy("shard", "block"))
    return stage(pieces.withColumns({"base": F.sum(n).over(slots) - n, "whole": whole}).drop("piece"), "reshard-pieces")


def rewrite(layout: DataFrame, pieces: DataFrame, path: str) -> None:
    """Write the rows of all blocks that lose some, each under its new shard,
    then the manifest of live blocks."""
    moved = pieces.where("not whole").select("shard", "block", "target", "lo", "hi", "base")
    rows = layout.join(moved, ["shard", "block"]).where(F.col("at").between(F.col("lo"), F.col("hi")))
    slot = (F.col("base") + F.col("at") - F.col("lo")).alias("slot")
    rows.select(slot, "size", "row", F.col("target").alias("shard"), "block").write.partitionBy("shard", "block").parquet(
        f"{path}/generation=1")
    live = pieces.groupBy(F.when(F.col("whole"), 0).otherwise(1).alias("generation"), F.col("target").alias("shard"), "block").agg(
        F.sum(F.col("hi") - F.col("lo") + 1).alias("rows"), F.sum("bytes").alias("bytes"),
        F.min(F.when(F.col("whole"), F.col("lo"))).alias("lo"), F.min(F.when(F.col("whole"), F.col("base"))).alias("base"))
    live.write.parquet(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str, row_type: str) -> DataFrame:
    """``shard``, ``slot`` and ``row`` of the new layout, from its live files."""
    live = spark.read.parquet(f"{path}/manifest")
    old = spark.read.schema(LAYOUT.format(row=row_type)).parquet(f"{path}/generation=0")
    kept = old.join(live.where("generation = 0").select("shard", "block", "lo", "base"), ["shard", "block"]).select(
        "shard", (F.col("base") + F.col("at") - F.col("lo")).alias("slot"), "row")
    new = spark.read.schema(REWRITTEN.format(row=row_type)).parquet(f"{path}/generation=1")
    return kept.unionByName(new.select("shard", "slot", "row"))


def reshard(documents: DataFrame, old_shard: Column, old_shards: int, new_shards: int, path: str | None = None,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Lay ``documents`` out in ``old_shards`` by ``old_shard``, move them into
    ``new_shards`` of equal bytes, and read the result back from its files:
    ``shard``, ``slot`` and ``row``, a struct of the caller's columns."""
    spark = documents.sparkSession
    path = path or scratch_path(spark, "llm-reshard")
    row_type = _row_type(documents)
    total = write_layout(documents, old_shard, old_shards, path, block_bytes)
    layout = spark.read.schema(LAYOUT.format(row=row_type)).parquet(f"{path}/generation=0")
    pieces = plan_moves(layout, total, new_shards)
    rewrite(layout, pieces, path)
    return read_shards(spark, path, row_type)


def shard_table(documents: DataFrame, old_shards: int = 32, new_shards: int = 40) -> DataFrame:
    """All documents in ``new_shards`` by the law ``bytes``, moved there from
    shards by a hash of doc_id."""
    old = F.pmod(F.xxhash64("doc_id"), F.lit(old_shards))
    text = F.col("row.text")
    return reshard(documents, old, old_shards, new_shards).select(
        F.col("row.doc_id").alias("doc_id"), text_bytes(text).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
