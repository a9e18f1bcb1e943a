import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, held_out int, score string, n int"


@pytest.fixture(scope="module")
def pieces():
    return L.Pieces.load(L.VOCABULARY)


def all_cuts(pieces, s, p):
    """Summed probability over every segmentation, by recursion."""
    if not s:
        return 1.0
    total = 0.0
    for j in range(1, len(s) + 1):
        if s[:j] in pieces.ids:
            total += p[pieces.ids[s[:j]]] * all_cuts(pieces, s[j:], p)
    if s[0] not in pieces.ids:
        total += math.prod(p[pieces.ids[f"<0x{b:02X}>"]] for b in s[0].encode()) * all_cuts(pieces, s[1:], p)
    return total


def test_forward_equals_all_segmentations(pieces):
    rnd = random.Random(1)
    p = [rnd.random() for _ in range(pieces.size)]
    p = [x / sum(p) for x in p]
    for w in ("the", "thing", "ñandú", "straße", "abሴc", "z", "ingtion"):
        edges, n = pieces.edges(w)
        assert L.log_probability(edges, n, p) == pytest.approx(math.log(all_cuts(pieces, L.WORD_MARK + w, p)), rel=1e-9)
    edges, n = pieces.edges("the" * 400)
    assert -1e6 < L.log_probability(edges, n, p) < -1000
    edges, n = pieces.edges("thing" * 5)
    tiny = [x * 1e-100 for x in p]
    assert L.log_probability(edges, n, tiny) < -700


def test_batched_forward_equals_one_by_one(pieces):
    rnd = random.Random(2)
    model = {g: [rnd.random() + 1e-6 for _ in range(pieces.size)] for g in "abc"}
    model = {g: [x / sum(p) for x in p] for g, p in model.items()}
    scorer = L.Scorer(pieces, model)
    found = ["the", "a", "ñandú", "漢字", "漢", "thing" * 11, "ሴ" * 50, "z" * 61, "straße"] + [
        "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 20))) for _ in range(200)]
    found = list(dict.fromkeys(found))
    got = scorer._rows(found)
    for w, row in zip(found, got, strict=True):
        edges, n = pieces.edges(w)
        assert list(row) == pytest.approx([L.log_probability(edges, n, model[g]) for g in "abc"], rel=1e-9)


def test_small_memory_gives_the_same(pieces, monkeypatch):
    rnd = random.Random(3)
    model = {g: [rnd.random() for _ in range(pieces.size)] for g in "ab"}
    texts = [" ".join("".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 5))) for _ in range(40)) for _ in range(30)] + [None, "1"]
    want = L.Scorer(pieces, model).predict(texts)
    monkeypatch.setattr(L, "CACHE_CELLS", 26)
    got = L.Scorer(pieces, model)
    assert got.predict(texts) == want
    assert [got.predict([t])[0] for t in texts] == want
    assert want[-2:] == [("und", 0.0)] * 2


def test_fit_raises_likelihood(pieces):
    counts = {"the": 50, "thing": 20, "ingthe": 5}

    def score(p):
        return sum(c * L.log_probability(*pieces.edges(w), p) for w, c in counts.items())

    one, three = L.fit(pieces, counts, 1), L.fit(pieces, counts, 3)
    assert score(three) > score(one) > score([1 / pieces.size] * pieces.size)
    assert sum(three) == pytest.approx(1.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.identify(docs).cache()
    assert got.count() == docs.count()
    held = got.filter("held_out").join(docs.filter("lang is not null"), "doc_id")
    n = held.count()
    assert n > 150 and held.filter(F.col("lang") == F.col("lang_pred")).count() >= 0.97 * n
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows_and_no_leak(spark):
    rows = []
    for i in range(80):
        lang, t = ("xx", "kromba valu teski ") if i % 2 else ("yy", "mipa sonde furi ")
        if zlib.crc32(str(i).encode()) % 4 == 2:
            lang = "never"  # only in the held-out fold
        rows.append((i, t * 5, lang))
    rows += [(200, None, "xx"), (201, "12 ... 34", "yy"), (202, "", None), (None, "valu teski kromba", "secret"),
             (203, "valu " * 20000, None), (204, "k" * 5000, None), (205, "ВЯ 漢字", None), (1, rows[1][1], "xx")]
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in L.identify(df).collect()}
    assert L.identify(df).count() == len(rows)
    assert set(r.lang_pred for r in got.values()) == {"xx", "yy", "und"}
    assert [got[k].lang_pred for k in (200, 201, 202)] == ["und"] * 3 and got[200].score == 0
    assert got[203].lang_pred == "xx" and got[None].lang_pred == "xx" and got[None].held_out is False
    for r in got.values():
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_words_are_letters_only():
    assert L.words("Ab1c ½ x²y Ⅷ _d é") == {"ab": 1, "c": 1, "x": 1, "y": 1, "d": 1, "é": 1}
    assert L.words(None) == {} and L.words("½ ² 3 !") == {}


def test_empty_and_unlabelled(spark):
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    r = L.identify(spark.createDataFrame([(1, "abc", None, 1, "", 1)], SCHEMA)).collect()[0]
    assert (r.lang_pred, r.score) == ("und", 0.0)


def test_fit_learns_from_words_that_underflow(pieces):
    """Characters outside the vocabulary are three byte pieces each."""
    for n in (3, 30, 300):
        p = L.fit(pieces, {"ሴ" * n: 2}, 1)
        total = L.SMOOTHING * pieces.size + 2 * (3 * n + 1)
        for b in "ሴ".encode():
            assert p[pieces.ids[f"<0x{b:02X}>"]] == pytest.approx((L.SMOOTHING + 2 * n) / total, rel=1e-9)
    uniform = [1 / pieces.size] * pieces.size
    edges, n = pieces.edges("thing")
    uses = L._shares(edges, n, uniform)
    assert sum((j - i) * e for (i, j, _), e in zip(edges, uses, strict=True)) == pytest.approx(n)
    want = [L.SMOOTHING] * pieces.size
    for (_, _, k), e in zip(edges, uses, strict=True):
        for m in k:
            want[m] += e
    assert L.fit(pieces, {"thing": 1}, 1) == pytest.approx([x / sum(want) for x in want], rel=1e-9)


def test_sample_is_bounded_for_repeated_rows(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][:20]
    rows = [(i, "same text", "xx") for i in ids for _ in range(30)] + [(ids[0], f"text {k}", "yy") for k in range(50)] + [(ids[1], "other", "yy")]
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA).repartition(5)
    got = [(r.lang, r.text) for r in L.training_rows(df, 7).collect()]
    assert sum(g == "xx" for g, _ in got) == 7 and sum(g == "yy" for g, _ in got) == 7
    assert len({t for g, t in got if g == "yy"}) == 7
    assert L.training_rows(df, 1000).count() == 20 + 51


def test_sample_is_the_first_by_hash_of_any_number(spark, monkeypatch):
    """The cut before the ranking changes no choice."""
    df = spark.range(0, 6000).select(
        F.when(F.col("id") < 2000, 4).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 50 == 0, "yy").otherwise("xx").alias("lang"), F.lit(1).alias("place"), F.lit("s").alias("rows"), F.lit(2).alias("n"))
    for size in (1, 7, 200):
        got = {(r.lang, r.text) for r in L.training_rows(df, size).collect()}
        with monkeypatch.context() as m:
            m.setattr(L, "MARGIN_DOCS", 10**6)
            assert got == {(r.lang, r.text) for r in L.training_rows(df, size).collect()}
        assert sum(g == "xx" for g, _ in got) == size
        assert sum(g == "yy" for g, _ in got) == min(size, len({i for i in range(0, 6000, 50) if i < 2000 or zlib.crc32(str(i).encode()) % 4 != 2}))
