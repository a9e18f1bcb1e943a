from collections import Counter, defaultdict

from gaugeflow.llm import linededup as L

SCHEMA = "doc_id long, source string, text string, n_chars long, lines int, site string, line string"


def brute(rows, ratio, min_pages):
    texts = defaultdict(set)
    for _, s, t in rows:
        if t is not None:
            texts[s].add(t)
    bad = {}
    for s, pages in texts.items():
        n = Counter(x for t in pages for x in set(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r"))
        bad[s] = {x for x, c in n.items() if c > 1 and c > ratio * len(pages)} if len(pages) >= min_pages else set()
    out = []
    for d, s, t in rows:
        a = t.split("\n") if t is not None else []
        k = [x for x in a if x not in bad.get(s, ())]
        out.append((d, len(a), len(a) - len(k), "\n".join(k) if t is not None else None))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = []
    for i in range(60):
        host = ["a", "b", None, "tiny"][0 if i % 3 else i % 4]
        rows.append((i, host, f"Menu\nunique {i}\n\nshared {i % 7}\nMenu\n  \n"))
    rows += [(70, "a", None), (71, "a", ""), (72, "tiny", "Menu"), (None, "a", "Menu\nx"), (3, "a", rows[3][2]),
             (73, "a", "Menu"), (74, "b", "Menu\n" * 5000 + "end")]
    rows += [(100 + i, "a", "copied page\nwith two lines") for i in range(50)]
    df = spark.createDataFrame([(d, s, t, 1, 2, "x", "y") for d, s, t in rows], SCHEMA)
    want = brute(rows, 0.1, 10)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in L.line_dedup(df).collect()), key=str)
    assert got == want
    assert sum(r[2] for r in want) > 60
    assert (100, 2, 0, "copied page\nwith two lines") in want
    kept = L.without_boilerplate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (r[0] is None, r[0] or 0, r[3] or "") for r in want)
    assert kept.filter("doc_id = 73 and text = '' and n_chars = 0").count() == 1


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert L.line_dedup(df).count() == 0
    assert L.without_boilerplate(df).count() == 0
