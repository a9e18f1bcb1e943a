import re

import xxhash
from pyspark.sql import functions as F

from gaugeflow.llm import simhash as S

SCHEMA = "doc_id long, text string, lang string, fp string, row int, leaf int"


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hs = [xxhash.xxh64(" ".join(words[i:i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """(doc_id, text) rows -> sorted (doc_id, fingerprint, component)."""
    fps = [plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for j, (x, _) in enumerate(rows) if find(j) == find(i) and x is not None]
        out.append((d, f"{fps[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_small_and_odd_rows(spark):
    base = " ".join(f"w{i % 37} x{i}" for i in range(300))
    rows = [(1, base), (2, base), (5, base + " tail"), (2, base), (None, base), (7, None), (8, " \n"), (9, "A"),
            (10, "a"), (11, "a b"), (None, "only null"), (12, "É È\x0bç d e"), (13, base * 30)]
    df = spark.createDataFrame([(d, t, "en", "x", 1, 2) for d, t in rows], SCHEMA)
    assert rows_of(S.near_duplicates(df)) == brute(rows)
    left = S.one_per_group(df)
    assert left.columns == df.columns
    groups = {}
    for d, f, c in brute(rows):
        groups.setdefault((c, f if c is None else None), 0)
    assert left.count() == len(groups)
    assert left.filter("doc_id = 2").count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(df).count() == 0
    assert S.one_per_group(df).count() == 0


def test_links_equal_all_pairs(spark):
    import random

    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(40)]
    vals = set(centres)
    for c in centres:
        for _ in range(30):
            vals.add(c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))))
    vals = sorted(S._signed(v) for v in vals)
    df = spark.createDataFrame([(v,) for v in vals], "fp long")
    u = [v & (2**64 - 1) for v in vals]
    want = {(a, b) for i, a in enumerate(vals) for j, b in enumerate(vals) if i < j and (u[i] ^ u[j]).bit_count() <= 2}
    assert len(want) > 500
    assert {tuple(r) for r in S.links(df).collect()} == want
    for levels in S.DEPTHS:
        assert {tuple(r) for r in S.links(df, levels=levels).collect()} == want, levels


def test_links_at_every_depth_cell_and_buffer(spark, monkeypatch):
    """Both depths of the upper tree, shards cut into cells, cells longer than
    a buffer, a radius of three: always all pairs, each once."""
    import random

    rnd = random.Random(8)
    vals = {rnd.getrandbits(64) for _ in range(300)}
    for c in sorted(vals)[:20]:
        for _ in range(40):
            vals.add(c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5))))
    u = sorted(vals)
    df = spark.createDataFrame([(S._signed(v),) for v in u], "fp long")
    want = {r: sorted(tuple(sorted((S._signed(a), S._signed(b)))) for i, a in enumerate(u) for b in u[:i] if (a ^ b).bit_count() <= r)
            for r in (0, 1, 2, 3)}
    assert len(want[3]) > len(want[2]) > 200
    monkeypatch.setattr(S, "QUERIES", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        for piece, radius, levels, top in ((1 << 23, 2, 16, 8), (3, 2, 8, 4), (7, 2, 8, 8), (2, 3, 16, 4), (5, 1, 4, 4), (5, 0, 8, 4)):
            monkeypatch.setattr(S, "PIECE", piece)
            got = sorted(tuple(r) for r in S.links(df, max_bits=radius, levels=levels, top=top).collect())
            assert got == want[radius], (piece, radius, levels, top)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_queries_per_fingerprint_do_not_grow():
    for n, most in ((10, 21), (10 ** 6, 21), (10 ** 10, 21), (10 ** 11, 73), (10 ** 15, 73)):
        assert len(S._below(S._shard_levels(n), S._levels(n), 2)) <= most


def test_candidates_are_checked_in_parts(monkeypatch):
    import numpy as np

    monkeypatch.setattr(S, "PAIRS", 5)
    points = np.arange(40, dtype=np.uint64)
    leaves = np.sort(np.arange(40) % 4)
    asked = np.arange(10, dtype=np.uint64)
    parts = list(S._met(points, leaves, asked, np.arange(10) % 5, 2))
    got = {tuple(p) for x in parts for p in x.T.tolist()}
    assert got == {(q, p) for q in range(10) for p in range(40)
                   if q % 5 < 4 and leaves[p] == q % 5 and q != p and (q ^ p).bit_count() <= 2} and len(parts) > 3


def test_depth_stays_within_63_bits():
    for n in (1, 10 ** 5, 10 ** 7, 10 ** 9, 10 ** 10, 10 ** 11, 10 ** 15):
        levels = S._levels(n)
        base = max(m.bit_count() for m in S._blocks(levels)) + 3
        assert base ** levels < 1 << 63


def test_paths_cover_every_budget():
    for levels in (4, 8):
        masks = S._blocks(levels)
        base = max(m.bit_count() for m in masks) + 3
        got = set(S._paths(levels, 2, base))
        assert len(got) == (1 + 4 * levels + 2 * levels * (levels - 1) - 1) // 2 + 1


def test_long_chain_is_one_component(spark):
    from gaugeflow.llm.components import components

    edges = spark.range(0, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(1, 201)}


def test_sample_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert rows_of(S.near_duplicates(df)) == brute(rows)
