import hashlib
import random

import numpy as np

from gaugeflow.llm import suffix as S

SCHEMA = "doc_id long, text string, doc int, mark string, lo int, part int, data string, key int"


def brute(rows, length=100):
    first = {}
    texts = [((d if d is not None else S.LAST), (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    for (doc_id, _), (d, b) in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (d, i):
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "m", 2, 3, "d", 4) for d, t in rows], SCHEMA)


def corpus(seed, n):
    rnd = random.Random(seed)
    syl = ["the", "tion", "é", "an", "er ", "ou ", ". ", "\n", "ing ", "ß"]

    def text(k):
        return "".join(rnd.choice(syl) for _ in range(k))

    line = "a very common line that is rather long but under hundred bytes"
    pool = [text(60) for _ in range(12)]
    rows = []
    for i in range(n):
        t = text(rnd.choice([0, 5, 40, 200]))
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(pool)
            a = rnd.randint(0, 30)
            t += p[a:a + rnd.randint(60, 200)] + rnd.choice(["", text(3), line, line + text(2)])
        rows.append((i, t))
    for i in range(10):  # near copies, copies inside a document, exact copies
        t = rows[i * 3][1]
        cut = len(t) // 2
        rows.append((n + 3 * i, t[:cut] + "X" + t[cut:]))
        rows.append((n + 3 * i + 1, t + t))
        rows.append((n + 3 * i + 2, t))
    rnd.shuffle(rows)
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = corpus(1, 120)
    rows += [(900, None), (901, ""), (902, "é" * 30), (None, rows[5][1]), (None, rows[6][1] + "tail"), (903, "z" * 1000), (904, "z" * 99),
             (905, "ab" * 400), (7, rows[3][1]), (7, "q" + rows[3][1]), (8, rows[9][1]), (8, rows[9][1])]
    df = frame(spark, rows)
    want = brute(rows)
    assert sum(r[2] for r in want) > 5000
    assert rows_of(S.remove_repeats(df.repartition(3))) == want
    # Small slices, key ranges and batches, and every second key a hot one.
    monkeypatch.setattr(S, "SLICE_BYTES", 700)
    monkeypatch.setattr(S, "PART_BYTES", 9000)
    monkeypatch.setattr(S, "BATCH", 40)
    monkeypatch.setattr(S, "ARRAY", 100)
    monkeypatch.setattr(S, "MANY", 2)
    assert rows_of(S.remove_repeats(df.repartition(2))) == want
    # No hot key is in the sample; several key ranges in each task.
    monkeypatch.setattr(S, "MANY", 10**9)
    monkeypatch.setattr(S, "WIDE", 3)
    monkeypatch.setattr(S, "RANGES", 3)
    assert rows_of(S.remove_repeats(df.repartition(2))) == want


def test_family_keeps_the_earliest(monkeypatch):
    rnd = np.random.default_rng(2)
    n = 4000
    e = S.Entries(rnd.integers(0, 300, n).astype(np.uint64), rnd.integers(0, 3, n).astype(np.uint64),
                  rnd.integers(0, 50, n), rnd.integers(0, 1 << 20, n).astype(np.uint64) << np.uint64(S._AT))
    family = S.Family()
    for i in range(0, n, 100):
        family.add(e.take(slice(i, i + 100)))
        assert len(family.levels) <= 8
    kept, gone = S.settle(e.ordered())
    got = S.Entries.join(family.levels).ordered()
    assert all((getattr(kept, f) == getattr(got, f)).all() for f in ("key", "ctx", "doc", "place"))
    assert len(S.Entries.join(family.repeats)) == len(gone)
    split = family.split_keys()
    assert len(split) == sum(1 for k in kept.key if len(set(kept.ctx[kept.key == k])) > 1)


def test_empty_and_short(spark):
    assert S.remove_repeats(frame(spark, [])).count() == 0
    rows = [(1, "short"), (2, "short"), (None, None)]
    assert rows_of(S.remove_repeats(frame(spark, rows))) == brute(rows)


def test_sample_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert rows_of(S.remove_repeats(df)) == brute(rows)


def test_batches_are_bounded_by_bytes(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from gaugeflow.llm.common import BATCH_BYTES, bound_batches

    bound_batches(spark)
    df = spark.range(0, 300, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("t"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    sizes = [r.n for r in df.mapInArrow(run, "n long").collect()]
    assert sum(sizes) == 300 and max(sizes) * 100_000 <= BATCH_BYTES + 100_000


def test_merged_ranges_are_the_union():
    rnd = np.random.default_rng(5)
    n = 500
    doc, mark = rnd.integers(-3, 6, n), rnd.integers(0, 2, n).astype(np.int32)
    lo = rnd.integers(0, 3000, n)
    hi = lo + rnd.integers(1, 60, n)
    got = list(zip(*[x.tolist() for x in S.merged(doc, mark, lo, hi)], strict=True))
    for key in {(d, m) for d, m in zip(doc.tolist(), mark.tolist(), strict=True)}:
        want = {i for d, m, a, b in zip(doc.tolist(), mark.tolist(), lo.tolist(), hi.tolist(), strict=True) if (d, m) == key for i in range(a, b)}
        mine = [(a, b) for d, m, a, b in got if (d, m) == key]
        assert {i for a, b in mine for i in range(a, b)} == want
        assert all(b < c for (_, b), (c, _) in zip(mine, mine[1:], strict=False))
    assert len(S.merged(doc[:0], mark[:0], lo[:0], hi[:0])[0]) == 0


def test_many_rows_of_one_id(spark):
    """Thousands of texts under one id or none: ranges stay with their row."""
    rnd = random.Random(8)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(130))
    rows = [(None if i % 2 else 5, "".join(rnd.choice("ijklmnop ") for _ in range(rnd.randint(0, 90))) + passage + str(i)) for i in range(5000)]
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 4000
    assert rows_of(S.remove_repeats(frame(spark, rows).repartition(4))) == want


def test_a_key_with_many_contexts_is_searched_in_it():
    """The cost of a batch does not grow with the contexts of its keys."""
    n = 60_000
    rnd = np.random.default_rng(3)

    def batch(key, ctx, doc):
        return S.Entries(key.astype(np.uint64), ctx.astype(np.uint64), doc, np.zeros(n, np.uint64))

    family = S.Family()
    family.add(batch(np.full(n, 7), np.arange(n), np.arange(n)))
    family.add(batch(np.full(n, 7), rnd.permutation(n) + n // 2, np.arange(n) + n))  # the product has 3.6e9 pairs
    assert sum(len(x) for x in family.repeats) == n // 2
    assert len(family.split_keys()) == n + n // 2
    a = batch(rnd.integers(0, 5, n), rnd.integers(0, 50, n), np.arange(n)).ordered()
    b = batch(rnd.integers(0, 9, n), rnd.integers(0, 70, n), np.arange(n))
    first = {}
    for i, k in enumerate(zip(a.key.tolist(), a.ctx.tolist(), strict=True)):
        first.setdefault(k, i)
    assert a.first_of(b).tolist() == [first.get(k, -1) for k in zip(b.key.tolist(), b.ctx.tolist(), strict=True)]
    assert S.Entries.join([]).first_of(b).tolist() == [-1] * n


def test_equal_rows_are_compared_once(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, 5, bytearray(b"x" * 200), 1)] * 500 + [(2, 6, bytearray(b"y" * 200), 2)],
                                 "doc long, mark long, text binary, doc_id long").repartition(3)
    asked = spark.createDataFrame([(9, 1, 5, 0, 120), (9, 1, 5, 30, 150), (9, 2, 6, 0, 100)] * 3, "key long, doc long, mark long, lo int, hi int")
    got = S._contexts(docs, asked)
    assert got.count() == 3 and got.agg(F.sum(F.octet_length("data"))).first()[0] == 340
