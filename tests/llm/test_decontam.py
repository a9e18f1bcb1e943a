import hashlib
import random
import re

from gaugeflow.llm import decontam as D

DOCS = "doc_id long, text string, hits string, mark int, n_words int, item_id long"
ITEMS = "item_id long, text string, hash string, doc_id long"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[s:s + 13]), set()).add(i)
    out = []
    for d, t in docs:
        w = words(t)
        hit, its = set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                got = wins.get(tuple(w[s:s + n]))
                if got:
                    hit.update(range(s, s + n))
                    its |= got
        ids = sorted(str(i) for i in its if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in docs], DOCS),
            spark.createDataFrame([(i, t, "y", 4) for i, t in items], ITEMS))


def test_against_brute_force(spark):
    rnd = random.Random(5)

    def text(n):
        return " ".join(rnd.choice(["a", "bé", "C3", "dd", "e", "f9"]) + rnd.choice(["", ",", ".\n", "-"]) for _ in range(n))

    items = [(i, text(rnd.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for i in range(30)]
    items += [(100, items[7][1]), (None, items[8][1]), (5, text(20)), (200, None), (201, "-- !"),
              (300, "once upon a time there was a very long test item with many more words than thirteen")]
    docs = []
    for d in range(60):
        t = text(rnd.choice([0, 3, 12, 13, 40, 200]))
        for _ in range(rnd.randint(0, 2)):
            w = (rnd.choice(items)[1] or "").split(" ")
            a = rnd.randint(0, max(0, len(w) - 13))
            t += " " + " ".join(w[a:a + rnd.randint(11, 40)]) + " " + text(rnd.randint(0, 5))
        docs.append((d, t))
    docs += [(70, None), (71, ""), (72, " ,.;"), (None, items[9][1]), (3, docs[3][1]), (3, items[9][1]),
             (73, "x ONCE upon a time, there was a very long test item with many more words than y"),
             (74, "x once upon a time there was a very long test item with many y" + " z1" * 5000)]
    got = rows_of(D.decontaminate(*frames(spark, docs, items)))
    assert got == brute(docs, items)


def test_common_runs_make_no_pairs(spark, monkeypatch):
    """Five-word runs that most documents and items hold, without a shared
    window: no pair leaves the join. With one shared window: one per place."""
    runs = [" ".join(f"common{r}x{i}" for i in range(5)) for r in range(10)]
    items = [(i, " ".join(f"{runs[(i + j) % 10]} item{i}w{j} item{i}v{j} item{i}u{j}" for j in range(6))) for i in range(40)]
    docs = [(d, " ".join(f"{runs[(d + j) % 10]} doc{d}w{j} doc{d}v{j} doc{d}u{j}" for j in range(6))) for d in range(200)]
    seen = []

    def counted(hits, near):
        seen.append(real(hits, near).count())
        return real(hits, near)

    real = D.paired
    monkeypatch.setattr(D, "paired", counted)
    assert rows_of(D.decontaminate(*frames(spark, docs, items))) == brute(docs, items)
    docs[7] = (7, " ".join(items[3][1].split(" ")[5:30]))
    got = rows_of(D.decontaminate(*frames(spark, docs, items)))
    assert got == brute(docs, items) and sum(r[5] for r in got) == 1
    assert seen[0] == 0 and seen[1] == 25 - 12  # one per window of the copied words


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b c")], [(1, "a b")])
    none_docs, none_items = frames(spark, [], [])
    assert D.decontaminate(none_docs, items).count() == 0
    assert rows_of(D.decontaminate(docs, none_items)) == brute([(1, "a b c")], [])
    assert D.keep_clean(docs, none_items).count() == 1
    left = D.keep_clean(docs, items)
    assert left.columns == docs.columns and left.count() == 0


def test_sample_table_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert rows_of(D.decontaminate(docs, items)) == want
    assert any(r[5] for r in want)
