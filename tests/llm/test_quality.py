import math
import random
import re

from gaugeflow.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, kept boolean, n_words string, source string"
SPACE = r"[\x20\x09-\x0D]"


def base(text):
    w = [x for x in re.split(SPACE + "+", text or "") if x]
    wins = {}
    for i in range(len(w) - 4):
        wins.setdefault(tuple(w[i:i + 5]), []).append(i)
    rep = {i + j for at in wins.values() if len(at) > 1 for i in at for j in range(5)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.sub(SPACE, "", x):
            dup += x in seen
            seen.add(x)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(rep),
            len(w) < 10 or 100 * len(rep) > 20 * len(w))


def hists(text, lang):
    import unicodedata

    n = dict.fromkeys(Q.CLASSES, 0)
    for c in text or "":
        k = unicodedata.category(c)
        n["space" if re.match(SPACE, c) else "upper" if k == "Lu" else "other_letter" if k[0] == "L" else "digit" if k == "Nd"
          else "symbol" if c in Q.SYMBOLS else "other"] += 1
    words = [x for x in re.split(SPACE + "+", text or "") if x]
    common = Q.COMMON_WORDS.get(lang)
    wh = [words.count(x) for x in common] if common else None
    return [n[k] for k in Q.CLASSES], wh + [len(words) - sum(wh)] if common else None


def js(p, q):
    if not p or not q or not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = sum(a * math.log2(a / ((a + b) / 2)) for a, b in zip(p, q) if a) + sum(b * math.log2(b / ((a + b) / 2)) for a, b in zip(p, q) if b)
    return math.sqrt(max(0.0, kl / 2))


def brute(rows, params):
    info = [(d, base(t), *hists(t, g), g if g in Q.COMMON_WORDS else "") for d, t, g in rows]

    def refs(which):
        out = {}
        for i in which:
            _, b, c, w, g = info[i]
            if sum(c) >= params.min_class_chars:
                out[g, "c"] = [x + y for x, y in zip(out.get((g, "c"), [0] * 6), c)]
            if w and b[0] >= params.min_word_words:
                out[g, "w"] = [x + y for x, y in zip(out.get((g, "w"), [0] * 21), w)]
        return out

    def keep(i, r):
        _, b, c, w, g = info[i]
        cj = js(c, r.get((g, "c"))) if sum(c) >= params.min_class_chars else None
        wj = js(w, r.get((g, "w"))) if b[0] >= params.min_word_words else None
        return not b[5] and (cj or 0) <= params.max_class_js and (wj or 0) <= params.max_word_js

    first = refs(range(len(rows)))
    second = refs([i for i in range(len(rows)) if keep(i, first)])
    return sorted([(info[i][0], *info[i][1], keep(i, second)) for i in range(len(rows))], key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                   for r in df.collect()), key=str)


def prose(rnd, n, lang):
    return " ".join(rnd.choice(Q.COMMON_WORDS[lang]) if rnd.random() < 0.4 else f"w{'abcdefgh'[rnd.randint(0, 7)]}{rnd.choice('xyz')}" * 2
                    for _ in range(n))


def test_against_brute_force(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(80):
        g = rnd.choice(["en", "fr", "de", "es"])
        t = prose(rnd, rnd.choice([3, 9, 10, 30, 80, 200]), g)
        kind = i % 8
        t = (t.upper() if kind == 1 else " ".join(x + "%%%" for x in t.split()) if kind == 2 else t + "\n" + t if kind == 3
             else "\n".join([t, "same line", "\t ", "same line"]) if kind == 4 else t)
        rows.append((i, t, g))
    rows += [(100, None, "en"), (101, "", "en"), (102, " \n\x0b", None), (103, prose(rnd, 90, "en"), "xx"), (104, prose(rnd, 90, "en"), None),
             (105, "a b c d e a b c d e f", "en"), (106, "x " * 30000, "en"), (None, rows[5][1], "en"), (5, rows[5][1], "en"),
             (107, "a b c d e f g a b c d e f q r s", "en"), (108, "Ünïcode Èé     x y z 1 2 3 4 5", "fr")]
    df = spark.createDataFrame([(*r, True, "n", "s") for r in rows], SCHEMA)
    p = Q.QualityParams()
    want = brute(rows, p)
    assert rows_of(Q.quality_rules(df, p)) == want
    assert {r[-1] for r in want} == {True, False}
    good = Q.keep_good(df, p)
    assert good.columns == df.columns
    assert sorted((r.doc_id for r in good.collect()), key=str) == sorted((r[0] for r in want if r[-1]), key=str)


def test_empty_and_native(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert Q.quality_rules(df).count() == 0 and Q.keep_good(df).count() == 0
    one = spark.createDataFrame([(1, "a b", "en", True, "", "")], SCHEMA)
    plan = Q.with_features(one)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labels_of_the_sample(spark):
    d = "/root/testdata/sf0.01"
    got = Q.quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    good, bad = got.filter("quality = 1 and not base_failed"), got.filter("quality = 0")
    assert good.filter("kept").count() >= 0.99 * good.count()
    assert bad.filter("not kept").count() >= 0.95 * bad.count()
