import random
from itertools import combinations

from gaugeflow.llm import packing as P

SCHEMA = "doc_id long, text string, n int, part int, piece string, bucket_len int"


def padding(hist, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in hist.items())


def test_boundaries_are_optimal():
    rnd = random.Random(1)
    for _ in range(60):
        hist = {n: rnd.randint(1, 50) for n in rnd.sample(range(1, 60), rnd.randint(1, 9))}
        k = rnd.randint(1, 5)
        got = P.optimal_boundaries(hist, k)
        top = max(hist)
        best = min(padding(hist, [*c, top]) for r in range(k) for c in combinations([n for n in hist if n < top], r))
        assert len(got) <= k and got == sorted(got) and padding(hist, got) == best
    assert P.optimal_boundaries({}, 4) == [] and P.optimal_boundaries({0: 3}, 4) == []


def brute(rows, max_len, buckets, budget):
    seqs = []
    for d, t in rows:
        n = len((t or "").split())
        for p in range(max(1, -(-n // max_len))):
            seqs.append((d, p, p * max_len, min(max_len, n - p * max_len)))
    hist = {}
    for s in seqs:
        hist[s[3]] = hist.get(s[3], 0) + 1
    bounds = P.optimal_boundaries(hist, buckets)
    seqs.sort(key=lambda s: (s[0] is not None, s[0] or 0, s[1], s[3]))
    out, seen = [], {}
    for s in seqs:
        if s[3] == 0:
            out.append((*s, None, None, None))
            continue
        b = min(x for x in bounds if x >= s[3])
        i = seen.get(b, 0)
        seen[b] = i + 1
        room = max(1, budget // b)
        out.append((*s, b, i // room, i % room))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, " \n".join("w" for _ in range(rnd.choice([0, 1, 3, 7, 20, 64, 65, 300])))) for i in range(300)]
    rows += [(400, None), (401, " \t"), (None, "a b"), (None, "a"), (5, "one two"), (5, "one two"), (402, "x " * 20000)]
    df = spark.createDataFrame([(d, t, 1, 2, "x", 3) for d, t in rows], SCHEMA)
    got = P.pack(df, max_len=64, buckets=4, token_budget=200)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 64, 4, 200)
    per = got.filter("bucket_len is not null").groupBy("bucket_len", "batch").count().collect()
    assert all(r["count"] <= max(1, 200 // r.bucket_len) for r in per)


def test_empty(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.pack(spark.createDataFrame([(1, "", 1, 2, "x", 3)], SCHEMA)).collect()[0].bucket_len is None
