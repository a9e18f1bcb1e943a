import random
import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from gaugeflow.llm import interactions as I

DOCS = "doc_id long, text string, lang string, part string, mask int, n long, digest string, good string, least int"
LABELS = "doc_id long, quality int, toxic int, part string, n int"


def mask_of(doc_id, text, rows):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    t = text or ""
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             bool(re.search(r"[#$%&*|]", t)),
             doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, _ in rows)]
    return "".join(n for n, f in zip("ABCDE", fails) if f)


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out = {}
    for part in {lang or "" for *_, lang in rows}:
        mine = [(d, mask_of(d, t, rows)) for d, t, lang in rows if (lang or "") == part]
        table, shapley = {}, Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for s, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                table[order, s + 1] = [len(left), len(gone), sum(f in m for _, m in mine) - len(gone), sum(m == f for _, m in mine),
                                       sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (order, s), v in table.items():
            out[part, order, s] = (*v, shapley[order[s - 1]])
    return out


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y", "z", 3) for r in rows], DOCS)
    return docs, spark.createDataFrame([(*x, "p", 9) for x in labels], LABELS)


def report(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_against_brute_force(spark):
    rnd = random.Random(3)
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", " \t\n", "a b", "A B", "a # b", long, long.upper(), long + " %", "same same " * 150, "Same $ " * 150,
             "é word " * 210, long * 40]
    rows = [(i, rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in range(120)]
    rows += [(5, "a b", "en"), (5, "a b", "en"), (5, "other", "de"), (None, "a b", "en"), (None, None, None), (-3, "tail a", "fr")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 120, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    docs, marks = frames(spark, rows, labels)
    got = report(I.interaction_audit(docs, marks))
    assert got == brute(rows, labels)
    assert len(got) == 600 * len({p for p, *_ in got})


def test_hot_text_and_many_parts(spark, monkeypatch):
    monkeypatch.setattr(I, "HELD_PARTS", 3)
    rows = [(i, "copy", f"l{i % 9}") for i in range(300)] + [(300 + i, f"text {i}", f"l{i % 9}") for i in range(60)]
    docs, marks = frames(spark, rows, [(0, 1, 0), (1, 1, 1)])
    assert report(I.interaction_audit(docs.repartition(7), marks)) == brute(rows, [(0, 1, 0), (1, 1, 1)])


def test_fields_do_not_overflow():
    c = I.Counters(list("ABCDE"))
    assert c.fields == 611 and len(c.orders) == 120
    n = 2 ** 62
    total = sum(n // 32 * c.packed(m) for m in range(32))
    fields = c.unpack(c.to_bytes(total))
    assert fields[-1] == n and fields.min() >= 0
    # Every order removes all documents but those of the empty mask.
    assert (fields[:600].reshape(120, 5).sum(axis=1) == n - n // 32).all()
    assert sum(1 for b in range(600) if c.packed(0) >> 64 * b & 1) == 0


def test_own_filters(spark):
    docs, marks = frames(spark, [(1, "abc", "en"), (2, "abc", "en"), (3, None, "en")], [])
    got = report(I.interaction_audit(docs, marks, {"S": F.length("text") < 4}, duplicates="T"))
    # A null condition is passed.
    assert got["en", "ST", 1][:2] == (1, 2) and got["en", "TS", 1][:2] == (2, 1) and got["en", "TS", 2][:3] == (1, 1, 1)


def test_empty_tables(spark):
    docs, marks = frames(spark, [], [])
    assert I.interaction_audit(docs, marks).count() == 0
    docs, _ = frames(spark, [(1, None, None)], [])
    assert report(I.interaction_audit(docs, marks))["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
