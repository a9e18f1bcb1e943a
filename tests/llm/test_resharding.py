import os
import random
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import resharding as R

SCHEMA = "doc_id long, text string, shard string, block int, at long, size int, row string, slot int, target int"


def best_cost(sizes, capacities, cost):
    """Least cost over all ways to cut each size over the new shards."""
    def cuts(n, k):
        return [(n,)] if k == 1 else [(i, *c) for i in range(n + 1) for c in cuts(n - i, k - 1)]
    best = None
    for way in product(*[cuts(s, len(capacities)) for s in sizes]):
        if all(sum(w[j] for w in way) <= c for j, c in enumerate(capacities)):
            total = sum(w[j] * cost[i][j] for i, w in enumerate(way) for j in range(len(capacities)))
            best = total if best is None else min(best, total)
    return best


def test_flow_has_least_cost():
    rnd = random.Random(1)
    for _ in range(60):
        n, m = rnd.randint(1, 3), rnd.randint(1, 3)
        sizes = [rnd.randint(0, 4) for _ in range(n)]
        capacities = [rnd.randint(0, 4) for _ in range(m)]
        capacities[0] += max(0, sum(sizes) - sum(capacities))
        cost = [[rnd.randint(0, 5) for _ in range(m)] for _ in range(n)]
        arcs = [(0, 2 + i, s, 0) for i, s in enumerate(sizes)] + [(2 + n + j, 1, c, 0) for j, c in enumerate(capacities)]
        arcs += [(2 + i, 2 + n + j, 99, cost[i][j]) for i in range(n) for j in range(m)]
        flow = R.min_cost_flow(arcs, 0, 1)
        assert sum(flow[:n]) == sum(sizes) and all(0 <= f <= a[2] for f, a in zip(flow, arcs))
        assert sum(f * a[3] for f, a in zip(flow, arcs)) == best_cost(sizes, capacities, cost)


def test_transfers_move_fewest_bytes():
    rnd = random.Random(2)
    for _ in range(200):
        n, m = rnd.randint(1, 12), rnd.randint(1, 12)
        sizes = {o: rnd.choice([0, 1, rnd.randint(0, 10 ** 9), 10 ** 15]) for o in range(n)}
        capacities = R.fill_level([0] * m, sum(sizes.values()))
        out = R.transfers(sizes, capacities)
        moved = sum(t.hi - t.lo for t in out if t.old != t.new)
        assert moved == sum(max(0, s - (capacities[o] if o < m else 0)) for o, s in sizes.items())
        assert len(out) <= n + m + 1
        for o, s in sizes.items():
            at = 0
            for t in (t for t in out if t.old == o):
                assert t.lo == at
                at = t.hi
            assert at == s
        assert [sum(t.hi - t.lo for t in out if t.new == j) for j in range(m)] == capacities


def test_levels():
    assert R.fill_level([0, 0, 0], 10) == [4, 3, 3]
    assert R.fill_level([100, 0, 3], 9) == [0, 6, 3]
    assert R.fill_level([5, 5], 0) == [0, 0]
    target, load = R.deal_large([(9, 0), (8, 0), (7, 5), (50, 1), (1, 1)], 3, 10)
    assert target == [0, 2, 2, 1, 0] and load == [10, 50, 15]


def result(spark, df, old=8, new=10):
    got = R.shard_table(df, old, new)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return [tuple(r) for r in got.collect()]


def check(rows, got, new):
    want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    assert sorted((r[:3] for r in got), key=str) == want
    assert {r[3] for r in got} <= {"bytes"} and {r[6] for r in got} <= {None}
    for s in range(new):
        assert sorted(r[5] for r in got if r[4] == s) == list(range(sum(r[4] == s for r in got)))
    return [sum(r[1] for r in got if r[4] == s) for s in range(new)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, "s", 1, 2, 3, "r", 4, 5) for d, t in rows], SCHEMA).repartition(parts)


def saved(spark, rows, folder, parts=3):
    frame(spark, rows, parts).write.parquet(f"{folder}/docs-{parts}")
    return spark.read.parquet(f"{folder}/docs-{parts}")


def test_equal_bytes(spark, tmpdir_path):
    rnd = random.Random(4)
    rows = [(i, "wö " * rnd.randint(0, 60)) for i in range(6000)] + [(7000 + i, "copy of a text") for i in range(2000)]
    rows += [(None, None)] * 50 + [(5, "same")] * 500 + [(8000, None), (8001, ""), (9000, "x" * 9000)]
    rnd.shuffle(rows)
    got = result(spark, saved(spark, rows, tmpdir_path))
    sizes = check(rows, got, 10)
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 10
    again = result(spark, saved(spark, rows, tmpdir_path, 5))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_long_rows_and_fewer_shards(spark, tmpdir_path):
    rnd = random.Random(5)
    rows = [(i, "y" * rnd.choice([0, 10, 100, 5000, 40000])) for i in range(300)]
    sizes = check(rows, result(spark, saved(spark, rows, tmpdir_path), 8, 3), 3)
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 3
    one = [(1, "z" * 100000), (2, "a"), (3, None)]
    check(one, result(spark, saved(spark, one, tmpdir_path, 1), 2, 4), 4)


def test_empty(spark):
    assert result(spark, frame(spark, [])) == []


def test_only_affected_files_are_rewritten(spark, tmpdir_path):
    path = f"{tmpdir_path}/layout"
    df = saved(spark, [(i, f"text {i} " * (i % 5)) for i in range(5000)], tmpdir_path)
    old = F.col("doc_id") % 4
    rows = R.reshard(df, old, 4, 5, path)
    assert sorted((r.row.doc_id, r.row.shard) for r in rows.collect()) == [(i, "s") for i in range(5000)]
    live = {(r.generation, r.shard, r.block): r.rows for r in spark.read.parquet(f"{path}/manifest").collect()}
    kept = {k for k in live if k[0] == 0}
    moved_shards = {s for g, s, _ in live if g == 1}
    assert len(kept) >= 6 and 4 in moved_shards and sum(live.values()) == 5000
    # A kept block's files are those of the old layout; rewritten blocks are in the second generation alone.
    for _, s, b in kept:
        assert os.path.isdir(f"{path}/generation=0/shard={s}/block={b}")
    for g, s, b in set(live) - kept:
        assert os.path.isdir(f"{path}/generation=1/shard={s}/block={b}")
    moved = rows.where(F.col("row.doc_id") % 4 != F.col("shard")).agg(F.sum(R.text_bytes(F.col("row.text")))).first()[0]
    total = df.agg(F.sum(R.text_bytes(F.col("text")))).first()[0]
    assert moved < 0.23 * total


@pytest.mark.parametrize("shards", [1, 3])
def test_nothing_moves(spark, tmpdir_path, shards):
    path = f"{tmpdir_path}/same-{shards}"
    df = spark.createDataFrame([(i, "t" * 500) for i in range(30)], "doc_id long, text string")
    rows = R.reshard(df, F.col("doc_id") % shards, shards, shards, path)
    assert rows.count() == 30 and not spark.read.parquet(f"{path}/manifest").where("generation = 1").count()
