import hashlib
import heapq
import random

from gaugeflow.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string, run int, bytes int, first long"


def brute(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and p is not None:
            d = hashlib.sha256(b).hexdigest()
            first[d] = min(first.get(d, p), p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        d = hashlib.sha256(b).hexdigest()
        f = first.get(d)
        rev = f is not None and p != f
        out.append((p, len(b), d, "revisit" if rev else "response", f if rev else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        h = rnd.choice(["é", "WARC/1.1\r\n\r\n", "\r\n\r\n", "x\n"]) * rnd.choice([0, 1, 20, 200])
        rows.append((i - 3, f"https://www.H{i % 5}.example.org:443/a?{i % 9}#f", h))
    rows += [(400, None, None), (401, "http://a.b/\r\nX-Evil: 1", "<p>" * 50), (None, "u", "q" * 100), (None, "u", "q" * 100),
             (None, "u", "z" * 120), (402, "u", "z" * 120), (7, rows[10][1], rows[10][2]), (403, "", "y" * 300000), (403, "", "y" * 300000)]
    df = spark.createDataFrame([(*r, "d", 1, 2, 3) for r in rows], SCHEMA).repartition(5)
    got = W.capture_index(df)
    assert rows_of(got) == brute(rows)
    keys = [W._order(r.asDict()) for r in got.collect()]
    assert keys == sorted(keys) and len({k[4] for k in keys}) > 1


def test_ranges_are_in_global_order(spark, monkeypatch):
    monkeypatch.setattr(W, "RANGE_ROWS", 50)
    df = spark.createDataFrame([(i, "http://hot.example/" if i % 3 else f"http://{i}.example/", "h", "", 1, 2, 3) for i in range(400)], SCHEMA)
    got = W.capture_index(df.repartition(4))
    assert got.rdd.getNumPartitions() == 8
    keys = [W._order(r.asDict()) for r in got.collect()]
    assert len(keys) == 400 and keys == sorted(keys)


def test_empty(spark):
    assert W.capture_index(spark.createDataFrame([], SCHEMA)).count() == 0


def test_loser_tree():
    rnd = random.Random(6)
    for k in (0, 1, 2, 3, 7, 33):
        runs = [sorted(rnd.randint(0, 50) for _ in range(rnd.randint(0, 30))) for _ in range(k)]
        assert list(W.LoserTree(runs, lambda x: x)) == list(heapq.merge(*runs))


def test_url_key():
    assert W.url_key("HTTPS://u@www2.Ab.C.org:443/P?q#f") == "org,c,ab)/p?q"
    assert W.url_key("http://a.b") == "b,a)/"
    assert W.url_key(None) == ""


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    """Pages of many MB: files keep to the bound, a larger record stands alone."""
    from pyspark.sql import functions as F

    from gaugeflow.session import scratch_path

    most = 8 << 20
    monkeypatch.setattr(W, "ARCHIVE_BYTES", most, raising=False)
    sizes = [3_000_000] * 6 + [12_000_000] + [200] * 50 + [5_000_000] * 2
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "page_id long, n int").coalesce(1).select(
        "page_id", F.lit("http://a.example/").alias("url"),
        F.concat(F.col("page_id").cast("string"), F.repeat(F.lit("x"), F.col("n"))).alias("html"))
    path = scratch_path(spark, "test-warc")
    W.write_archives(df, path)
    files = [r.length for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert [n for n in files if n > most] == [n for n in files if n > 12_000_000] and max(files) < 12_001_000
    assert len(files) <= 8
    got = {r.page_id: r.payload_bytes for r in W.merge_runs(W.read_runs(spark, path)).collect()}
    assert got == {i: n + len(str(i)) for i, n in enumerate(sizes)}
