import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos int, digest string, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """Root, and the path of every node: [(left, right) per level]."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 16 * 16:a // 16 * 16 + 16]
            paths[i].append(("".join(run[:a % 16]), "".join(run[a % 16 + 1:])))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at = [a // 16 for a in at]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for doc_id, text, lang, source, n in rows:
        seen = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            seen = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups.setdefault(source, []).append((doc_id, leaf_of(doc_id, source, lang, n, text), leaf_of(doc_id, source, lang, n, seen)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in groups[s]])
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (doc_id, leaf, seen), path in zip(groups[s], trees[s][1]):
            whole = path + top
            node = seen
            for left, right in whole:
                node = h(left, node, right)
            out.append((doc_id, leaf, trees[s][0], root, h(*[x for p in whole for x in p]), node, node == root))
    return sorted(out, key=str)


def run(spark, rows, partitions=3):
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(partitions)
    got = M.dataset_manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    sizes = {"hot": 600, "run": 16, "over": 17, "two": 2, "one": 1, None: 33, "": 3, "é": 5, "~": 257}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = rnd.choice([None, "", "Some Text", "no capitals", "É Ü", f"Text {i} " * rnd.randint(1, 30)])
            rows.append((i, text, rnd.choice(["en", None]), source, rnd.choice([None, len(text or "")])))
            i += 1
    rows += [(7, "again", "en", "hot", 5), (7, "again", "en", "hot", 5), (None, "A null id", "en", "hot", 9),
             (None, None, None, None, None), (10 ** 12, "B" * 200000, "en", "hot", 200000)]
    rnd.shuffle(rows)
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_many_groups(spark):
    rows = [(i, f"Doc {i}", "en", f"s{i % 300}", 5) for i in range(400)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_level_edges(spark, n):
    rows = [(i * 3, f"T{i}", None, "s", 1) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_of_one_key(spark):
    rows = [(1, "same", "en", "s", 4)] * 50 + [(2, "T", "en", "s", 1)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_any_change_is_found(spark):
    df = spark.createDataFrame([(i, "text", "en", "s", 4, "", 1, "", "") for i in range(40)], SCHEMA)
    rows = M.manifest(df, "doc_id", "source", M.COLUMNS, {"n_chars": F.when(F.col("doc_id") == 7, 5).otherwise(F.col("n_chars"))})
    wrong = rows.where(M.fold(F.col("seen_leaf"), F.col("path")) != F.col("root")).collect()
    assert [r.doc_id for r in wrong] == [7]
