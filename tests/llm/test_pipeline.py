"""Each stage of the pipeline on its own input, against brute force."""

import corpus_pipeline as P
from gaugeflow.llm.common import stage
from gaugeflow.llm.linededup import MIN_PAGES, RATIO
from gaugeflow.llm.packing import BUCKETS, MAX_LEN, TOKEN_BUDGET
from gaugeflow.llm.quality import QualityParams
from tests.llm import test_decontam, test_linededup, test_packing, test_quality, test_simhash

SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def check_stages(spark, docs):
    """Runs the stages; every one is held against brute force on its input."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    steps, columns, counts = dict(P.STAGES), docs.columns, [docs.count()]

    def run(name, df):
        out = stage(steps[name](spark, df, SF), "t")
        counts.append(out.count())
        return out

    def ids(rows):
        return sorted(rows, key=str)

    good = run("quality_rules", docs)
    want = test_quality.brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], QualityParams())
    assert ids(r.doc_id for r in good.collect()) == ids(r[0] for r in want if r[-1])
    assert good.columns == columns

    clean = run("line_dedup", good)
    want = test_linededup.brute([(r.doc_id, r.source, r.text) for r in good.collect()], RATIO, MIN_PAGES)
    assert ids(texts(clean)) == ids((r[0], r[3]) for r in want)
    assert clean.columns == columns

    single = run("simhash_near_dedup", clean)
    groups = {}
    for (d, t), (_, _, c) in zip(ids(texts(clean)), test_simhash.brute(ids(texts(clean))), strict=True):
        groups.setdefault(c, []).append((d, t))
    assert len(ids(texts(single))) == len(groups)
    assert all(min(x[0] for x in g) in {r.doc_id for r in single.collect()} for g in groups.values())
    assert single.columns == columns

    kept = run("benchmark_decontamination", single)
    want = test_decontam.brute(texts(single), items)
    assert ids(r.doc_id for r in kept.collect()) == ids(r[0] for r in want if not r[-1])
    assert kept.columns == columns

    packed = run("packing", kept)
    want = test_packing.brute([(d, t) for d, t in texts(kept)], MAX_LEN, BUCKETS, TOKEN_BUDGET)
    assert ids(tuple(r) for r in packed.collect()) == want
    return counts


def test_sample_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = check_stages(spark, docs)
    assert counts[0] > counts[1] == counts[2] > counts[3] > counts[4]
    last = P.run(spark, SF)
    assert last.count() == counts[5] and P.ORACLE_SQL is None


def test_clashing_columns_and_odd_rows(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6 + i, t, g, s, None) for i, (t, g, s) in enumerate(
        [(None, None, None), ("", "en", None), (" \n ", None, "src0"), ("word " * 30000, "en", "src1"),
         (" ".join(f"w{i}" for i in range(50)), None, None)])], docs.schema)
    extra = docs.unionByName(odd)
    names = ("_doc", "kept", "mark", "n_words", "n_hit", "row", "fp", "root", "site", "lines", "all", "_n_dropped", "class_js", "piece", "hits", "ref_lang")
    for i, c in enumerate(names):
        extra = extra.withColumn(c, F.lit(i))
    check_stages(spark, extra)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in P.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0
