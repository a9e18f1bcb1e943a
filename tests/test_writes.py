"""Keyed upsert, incremental refresh, export and streaming ingest."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators import incremental, marts, upsert
from gaugeflow.plans.fixtures import render_gauge_files
from gaugeflow.plans.marts_plan import ProxyMarts
from gaugeflow.session import scratch_path
from gaugeflow.sinks import export
from gaugeflow.sources import landing
from gaugeflow.streaming import ingest
from tests.conftest import SF_SMALL

D = dt.date


def _raw(spark, rows):
    return spark.createDataFrame(
        [(k, d, *([v] * len(S.MEASURES)), dt.datetime(2020, 1, 1)) for k, d, v in rows], S.RAW_SCHEMA)


def test_upsert_modes_and_idempotence(spark):
    target = scratch_path(spark, "t-upsert")
    upsert.create_table(_raw(spark, [("A", D(2019, 12, 30), 1.0), ("A", D(2020, 1, 2), 2.0)]), target)
    batch = _raw(spark, [("A", D(2020, 1, 1), 9.0), ("A", D(2020, 1, 2), 8.0), ("A", D(2020, 1, 3), 3.0),
                         ("B", D(2018, 5, 5), 4.0)]).drop("ingested_at")
    upsert.upsert_table(spark, target, batch, mode="new_dates")
    got = {(r.dam_key, r.fecha): r.volumen_alm_mm3 for r in ingest.read_raw(spark, target).collect()}
    # late row (2020-01-01 <= watermark 2020-01-02) dropped, conflict untouched, new key loads
    assert got == {("A", D(2019, 12, 30)): 1.0, ("A", D(2020, 1, 2)): 2.0, ("A", D(2020, 1, 3)): 3.0,
                   ("B", D(2018, 5, 5)): 4.0}
    upsert.upsert_table(spark, target, batch, mode="upsert")
    once = sorted(ingest.read_raw(spark, target).drop("ingested_at").collect())
    upsert.upsert_table(spark, target, batch, mode="upsert")
    twice = sorted(ingest.read_raw(spark, target).drop("ingested_at").collect())
    assert once == twice
    assert {(r.dam_key, r.fecha): r.volumen_alm_mm3 for r in once}[("A", D(2020, 1, 2))] == 8.0
    # the 2019 partition was not touched by the 2020/2018 batch rewrite
    assert os.path.isdir(os.path.join(target.replace("file:", ""), "year=2019"))


def test_incremental_equals_full_and_empty_target(spark):
    m = ProxyMarts(spark, SF_SMALL)
    full = m.fact()
    empty = spark.createDataFrame([], full.schema)
    got = incremental.refresh_fact(m.staged, empty, m.dim)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    # a target that is already current stays the same
    again = incremental.refresh_fact(m.staged, m.fact_table, m.dim)
    assert again.exceptAll(full).count() == 0 and full.exceptAll(again).count() == 0


def _days(spark, rows):
    return spark.createDataFrame([(k, D.fromisoformat(d), *([v] * len(S.MEASURES)), dt.datetime.fromisoformat(t))
                                  for k, d, v, t in rows], S.RAW_SCHEMA)


def test_incremental_lagging_corrections_and_capacity(spark):
    from gaugeflow.operators import marts

    t0, t1 = "2024-01-01", "2024-02-01"
    old = [("A", "2024-01-10", 1.0, t0), ("A", "2022-05-05", 5.0, t0), ("B", "2023-11-01", 1.0, t0), ("C", "2021-12-31", 2.0, t0),
           ("C", "2022-01-01", 3.0, t0), ("C", "2023-03-03", 4.0, t0)]
    new = [("A", "2024-01-11", 2.0, t1), ("B", "2023-11-02", 7.0, t1), ("C", "2021-12-31", 9.0, t1), ("D", "2020-02-02", 1.0, t1)]
    keys = [(k, f"S{k}", 10.0 * (1 + i), 12.0) for i, k in enumerate("ABCD")]
    dim0 = spark.createDataFrame(keys, "dam_key string, state string, namo_oficial_mm3 double, name_oficial_mm3 double")
    dim1 = dim0.withColumn("namo_oficial_mm3", F.when(F.col("dam_key") == "A", F.lit(100.0)).otherwise(F.col("namo_oficial_mm3")))
    path = scratch_path(spark, "t-incr")
    incremental.write_fact_table(marts.build_fact(_days(spark, old), dim0), path)
    now = {(k, d): (k, d, v, t) for k, d, v, t in old + new}
    source = _days(spark, list(now.values()))
    n = incremental.refresh_fact_table(spark, source, path, dim1, lookback_days=0, since=dt.datetime(2024, 1, 15))
    full = marts.build_fact(source, dim1)
    got = incremental.read_fact(spark, path).select(*S.FACT_COLUMNS)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert 0 < n < full.count()  # C in 2023 is untouched
    assert incremental.refresh_fact_table(spark, source, path, dim1, lookback_days=0) == 0


def test_upsert_with_nothing_new_rewrites_nothing(spark):
    target = scratch_path(spark, "t-same")
    raw = _raw(spark, [("A", D(y, 1, 1), 1.0) for y in range(2010, 2020)])
    upsert.create_table(raw, target)
    before = sorted(spark.read.parquet(target).inputFiles())
    assert upsert.upsert_table(spark, target, raw.drop("ingested_at")) == 0
    assert sorted(spark.read.parquet(target).inputFiles()) == before
    more = _raw(spark, [("A", D(2019, 5, 1), 2.0)]).drop("ingested_at")
    assert upsert.upsert_table(spark, target, more) == 1
    after = sorted(spark.read.parquet(target).inputFiles())
    assert [f for f in before if "year=2019" not in f] == [f for f in after if "year=2019" not in f]
    marks = {r.dam_key: r.max_fecha for r in upsert.stored_watermarks(spark, target).collect()}
    assert marks == {"A": D(2019, 5, 1)}


def _files(spark, target, year):
    return sorted(f for f in spark.read.parquet(target).inputFiles() if f"year={year}" in f)


def test_a_day_is_added_without_rewriting_its_year(spark, monkeypatch):
    target = scratch_path(spark, "t-append")
    rows = {("A", D(2020, 1, d)): float(d) for d in range(1, 11)}
    upsert.create_table(_raw(spark, [(k, d, v) for (k, d), v in rows.items()]), target)
    known = _files(spark, target, 2020)
    for day in (11, 12):  # what is written is the day, not the year
        batch = _raw(spark, [("A", D(2020, 1, day), float(day)), ("B", D(2021, 1, day), 1.0)]).drop("ingested_at")
        assert upsert.upsert_table(spark, target, batch) == 2
        rows |= {("A", D(2020, 1, day)): float(day), ("B", D(2021, 1, day)): 1.0}
        now = _files(spark, target, 2020)
        assert set(known) < set(now)
        new = spark.read.parquet(*(set(now) - set(known)))
        assert [tuple(r) for r in new.select(S.KEY, S.DATE).collect()] == [("A", D(2020, 1, day))]
        known = now

    def got():
        return {(r.dam_key, r.fecha): r.volumen_alm_mm3 for r in ingest.read_raw(spark, target).collect()}

    assert got() == rows and ingest.read_raw(spark, target).count() == len(rows)
    # a load that added its rows and failed before its watermarks is redone: nothing twice
    old = upsert.stored_watermarks(spark, target).where("dam_key = 'none'")
    assert upsert.upsert_table(spark, target, batch, marks=old) == 2
    assert got() == rows and ingest.read_raw(spark, target).count() == len(rows)
    # a correction and a late row of one year, a new row of another
    other = _files(spark, target, 2021)
    batch = _raw(spark, [("A", D(2020, 1, 3), -3.0), ("A", D(2020, 6, 1), 6.0), ("C", D(2021, 5, 5), 5.0)]).drop("ingested_at")
    upsert.upsert_table(spark, target, batch, mode="upsert")
    rows |= {("A", D(2020, 1, 3)): -3.0, ("A", D(2020, 6, 1)): 6.0, ("C", D(2021, 5, 5)): 5.0}
    assert got() == rows and set(other) < set(_files(spark, target, 2021))
    # many small files: the next load writes the year anew
    monkeypatch.setattr(upsert, "MOST_SMALL_FILES", 2)
    batch = _raw(spark, [("C", D(2021, 5, 6), 6.0)]).drop("ingested_at")
    upsert.upsert_table(spark, target, batch)
    rows |= {("C", D(2021, 5, 6)): 6.0}
    assert got() == rows and len(_files(spark, target, 2021)) == 1
    assert ingest.read_raw(spark, target).count() == len(rows)


def test_reloaded_table_gets_new_watermarks(spark):
    target = scratch_path(spark, "t-reload")
    upsert.create_table(_raw(spark, [("A", D(2020, 1, 1), 1.0)]), target)
    batch = _raw(spark, [("A", D(2020, 5, 1), 2.0), ("B", D(2020, 5, 1), 2.0)]).drop("ingested_at")
    assert upsert.upsert_table(spark, target, batch) == 2
    upsert.create_table(_raw(spark, [("A", D(2020, 2, 1), 3.0)]), target)  # loaded again, without the batch
    assert upsert.upsert_table(spark, target, batch) == 2
    got = {(r.dam_key, r.fecha): r.volumen_alm_mm3 for r in ingest.read_raw(spark, target).collect()}
    assert got == {("A", D(2020, 2, 1)): 3.0, ("A", D(2020, 5, 1)): 2.0, ("B", D(2020, 5, 1)): 2.0}


def test_exists_tells_missing_from_unreadable(spark):
    import pytest

    from gaugeflow.session import exists

    path = scratch_path(spark, "t-exists")
    assert not exists(spark, path)
    spark.range(1).write.format("json").save(path)
    with pytest.raises(Exception, match="FOOTER|UNABLE_TO_INFER"):
        exists(spark, path)


def test_shared_folder_must_be_set_on_a_cluster():
    import pytest

    from gaugeflow.session import ensure_checkpoint_dir

    class Conf:
        def get(self, name, default=None):
            return "spark://host:7077" if name == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_drop_scratch_removes_only_own_stages(spark):
    from gaugeflow import session

    keep = session.scratch_root
    own = scratch_path(spark, "t-drop").rsplit("/", 1)[0] + "-sub"
    try:
        session.scratch_root = lambda s: own
        session.materialize(spark, spark.range(3), "x")
        assert os.path.isdir(own.replace("file:", ""))
        session.drop_scratch(spark)
        assert not os.path.exists(own.replace("file:", ""))
    finally:
        session.scratch_root = keep


def test_catalog_csv_keeps_fractional_altitude(spark):
    from pyspark.sql import types as T

    from gaugeflow.sinks.catalog import to_declared_types

    df = spark.createDataFrame([("A", 12.5), ("B", -3.5), ("C", None), ("D", 7.0)], "k string, a double")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("a", T.IntegerType())])
    assert {r.k: r.a for r in to_declared_types(df, schema).collect()} == {"A": 13, "B": -4, "C": None, "D": 7}


def test_evolve_union_keeps_removed_and_adds_new(spark):
    old = spark.createDataFrame([("A", 1.0, "x")], "k string, v double, gone string")
    new = spark.createDataFrame([("B", 2.0, 7)], "k string, v double, added int")
    out = incremental.evolve_union(old, new)
    assert out.columns == ["k", "v", "gone", "added"]
    assert sorted(out.collect()) == [("A", 1.0, "x", None), ("B", 2.0, None, 7)]


def test_export_manifest_and_sorted_files(spark):
    m = ProxyMarts(spark, SF_SMALL)
    root = scratch_path(spark, "t-export")
    run_dir, man = export.export_all(spark, m.dim, m.fact_table, m.snapshot(), root, D(2001, 7, 1),
                                     generated_at=dt.datetime(2001, 7, 1, tzinfo=dt.timezone.utc))
    doc = json.loads(man.first().manifest)
    assert doc["schema_version"] == 1 and doc["latest_archive"]["month"] == "2001-07"
    assert doc["total_presas"] == m.snapshot().count()
    assert doc["total_bytes"] == sum(v["size_bytes"] for v in doc["current"].values())
    entries = [json.loads(r.value) for r in spark.read.text(f"{run_dir}/files").collect()]
    assert sum(e["size_bytes"] for e in entries) == doc["total_bytes"] and all(len(e["hash"]) == 16 for e in entries)
    states = {e["key"]: e.get("state") for e in entries if "state_part=" in e["key"]}
    assert states and all(" " in v and f"state_part={v.replace(' ', '_')}/" in k for k, v in states.items())
    assert export.published_bytes(spark, run_dir, f"{root}/archive").first()[0] > doc["total_bytes"]
    assert any(k.startswith("fct_by_state/state_part=") for k in doc["current"])
    inv1 = sorted(export.file_inventory(spark, f"{run_dir}/current").collect())
    inv2 = sorted(export.file_inventory(spark, f"{run_dir}/current").collect())
    assert inv1 == inv2
    # each written fact file is sorted by (key, date)
    for f in spark.read.parquet(f"{run_dir}/current/fct_by_state").inputFiles()[:5]:
        rows = [(r.dam_key, r.fecha) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows)
    # not day 1 and not forced: no archive
    assert export.write_archive(m.snapshot(), root, D(2001, 7, 2)) is None


def _published(spark, root):
    return {r.dataset: r for r in export.read_manifest(spark, root).collect()}


def test_publish_writes_changed_states_only(spark):
    """One changed state: one state is written, the others' files are those of
    the first run; every listed file has its size and hash; a failed publish
    leaves the pointer; labels with a plus, an empty state, a root in brackets."""
    import hashlib

    root = scratch_path(spark, "t-export(x)+")
    states = {"A": "A+B", "B": "", "C": "C D", "E": "E%41"}
    dim = spark.createDataFrame([(k, v, 1.0, 2.0) for k, v in [*states.items(), ("F", "No rows")]],
                                "dam_key string, state string, namo_oficial_mm3 double, name_oficial_mm3 double")
    raw = _raw(spark, [(k, D(2020, 1, i), float(i)) for k in states for i in range(1, 5)]).drop("ingested_at")
    for m in S.MEASURES:
        raw = raw if m in raw.columns else raw.withColumn(m, F.lit(None).cast("double"))

    def publish(rows, day):
        fact = marts.build_fact(rows, dim)
        return export.export_all(spark, dim, fact, fact.limit(1), root, day)[0]

    first = publish(raw, D(2020, 2, 2))
    before = _published(spark, root)
    assert {r.state for r in before.values()} == {*states.values(), None}
    second = publish(raw.withColumn(S.VOLUME, F.when(F.col(S.KEY) == "C", 9.0).otherwise(F.col(S.VOLUME))), D(2020, 2, 3))
    after = _published(spark, root)
    plain = second.replace("file:", "")
    assert os.listdir(f"{plain}/current/fct_by_state") and [x for x in os.listdir(f"{plain}/current/fct_by_state") if "=" in x] == ["state_part=C_D"]
    assert {r.state: r.paths != before[d].paths for d, r in after.items() if r.state is not None} == {
        "A+B": False, "": False, "C D": True, "E%41": False}
    for r in after.values():
        for f in r.paths:
            data = open(f"{root.replace('file:', '')}/{f.path}", "rb").read()
            assert len(data) == f.size_bytes and hashlib.sha256(data).hexdigest()[:16] == f.hash
    rows = export.read_published(spark, root)
    assert rows.count() == 16 and rows.where("state = 'C D' AND volumen_alm_mm3 = 9").count() == 4
    assert export.read_published(spark, root, "dim").count() == 5
    assert spark.read.parquet(f"{first}/current/fct_without_rows").count() == 0
    doc = json.loads(open(f"{root.replace('file:', '')}/manifest.json").read())
    assert doc["states_without_rows"] == ["No rows"] and doc["total_bytes"] == sum(e["size_bytes"] for e in doc["current"].values())
    try:
        publish(raw.withColumn(S.VOLUME, F.raise_error(F.lit("lost")).cast("double")), D(2020, 2, 4))
        raise AssertionError("the publish must fail")
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    assert _published(spark, root) == after


def test_state_label_collision(spark):
    dim = spark.createDataFrame([("A B",), ("A_B",), ("C",)], "state string")
    lab = {r.state: r.label_collision for r in export.state_labels(dim).collect()}
    assert lab == {"A B": True, "A_B": True, "C": False}


def test_stream_second_run_only_new_files(spark):
    root = scratch_path(spark, "t-stream")
    raw = _raw(spark, [("A", D(2020, 1, i), float(i)) for i in range(1, 11)])
    kw = dict(key_pattern=r"dam_key=([^/]+)/", glob="*.txt")
    render_gauge_files(raw.where(F.col("fecha") <= D(2020, 1, 5)), f"{root}/landing/run=1", S.GAUGE_HEADER)
    ingest.run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/ckpt", **kw)
    assert ingest.read_raw(spark, f"{root}/raw").count() == 5
    ingest.run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/ckpt", **kw)  # nothing new
    assert ingest.read_raw(spark, f"{root}/raw").count() == 5
    render_gauge_files(raw.where(F.col("fecha") > D(2020, 1, 5)), f"{root}/landing/run=2", S.GAUGE_HEADER)
    ingest.run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/ckpt", **kw)
    assert sorted(r.volumen_alm_mm3 for r in ingest.read_raw(spark, f"{root}/raw").collect()) == \
        [float(i) for i in range(1, 11)]


def test_stream_result_does_not_depend_on_batch_size(spark):
    raw = _raw(spark, [("A", D(2020, 1, i), float(i)) for i in range(1, 7)])
    kw = dict(key_pattern=r"dam_key=([^/]+)/", glob="*.txt")
    for limit in (None, 1):
        root = scratch_path(spark, "t-stream-order")
        render_gauge_files(raw.where(F.col("fecha") > D(2020, 1, 3)), f"{root}/landing/a", S.GAUGE_HEADER)
        render_gauge_files(raw.where(F.col("fecha") <= D(2020, 1, 3)), f"{root}/landing/b", S.GAUGE_HEADER)
        os.makedirs(f"{root.replace('file:', '')}/landing/c/dam_key=B")
        with open(f"{root.replace('file:', '')}/landing/c/dam_key=B/x.txt", "w") as f:
            f.write("no header\n")
        open(f"{root.replace('file:', '')}/landing/c/dam_key=B/empty é.txt", "w").close()
        ingest.run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/ckpt", max_files_per_trigger=limit, **kw)
        assert ingest.read_raw(spark, f"{root}/raw").count() == 6
        ingest.merge_batches(spark, f"{root}/raw", f"{root}/ckpt")  # nothing is left to merge
        assert ingest.read_raw(spark, f"{root}/raw").count() == 6
        got = sorted((r.dam_key, r.status, r.reason) for r in ingest.file_status(spark, f"{root}/ckpt").collect())
        assert got == [("A", "ok", None), ("A", "ok", None), ("B", "empty", "empty file"), ("B", "no_header", "no header line")]
        lines = landing.scan_lines(spark, f"{root}/landing", kw["key_pattern"], kw["glob"], recursive=True)
        files = landing.scan_files(spark, f"{root}/landing", kw["key_pattern"], kw["glob"], recursive=True)
        batch = landing.load_lines(lines, files=files)[2]
        assert got == sorted((r.dam_key, r.status, r.reason) for r in batch.collect())
        assert not os.path.exists(f"{root.replace('file:', '')}/ckpt_batches/rows")
        ingest.run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/ckpt", **kw)
        assert ingest.file_status(spark, f"{root}/ckpt").count() == 4


def test_watermark_gaps_and_load_stats(spark):
    batch = _raw(spark, [("A", D(2020, 1, 3), 1.0), ("A", D(2020, 1, 4), 1.0),
                         ("B", D(2020, 3, 1), 1.0), ("C", D(2020, 1, 1), 1.0)]).drop("ingested_at")
    marks = spark.createDataFrame([("A", D(2020, 1, 2)), ("B", D(2020, 1, 31))], "dam_key string, max_fecha date")
    gaps = {r.dam_key: r.gap_days for r in upsert.watermark_gaps(batch, marks).collect()}
    assert gaps == {"B": 30}  # A continues the day after; C has no watermark
    status = spark.createDataFrame([("f1", "A", "ok"), ("f2", "B", "bad_dates"), ("f3", "C", "empty")],
                                   "file string, dam_key string, status string")
    st = export.load_stats(batch, status).first()
    assert (st.total_rows, st.max_fecha, st.files_ok, st.files_failed) == (4, D(2020, 3, 1), 1, 2)


def test_years_are_merged_in_parts(spark, monkeypatch):
    """Years are merged part by part, in one write; rows with null keys, which
    no batch row replaces, and doubled rows of the table stay."""
    target = scratch_path(spark, "t-merge")
    rows = [("A", D(2020, 1, i), float(i)) for i in range(1, 20)] + [("B", D(2021, 1, 1), 1.0), ("B", D(2021, 1, 1), 2.0), ("-", D(2020, 1, 3), 9.0)]
    no_key = F.when(F.col("dam_key") != "-", F.col("dam_key"))
    upsert.create_table(_raw(spark, rows).withColumn("dam_key", no_key), target)
    batch = _raw(spark, [("A", D(2020, 1, 3), 30.0), ("-", D(2020, 1, 3), 90.0), ("C", D(2021, 2, 1), 5.0), ("A", D(2020, 1, 20), 20.0)]).drop("ingested_at").withColumn("dam_key", no_key)
    monkeypatch.setattr(upsert, "YEAR_PART", 100)  # many parts
    plans, shown = [], upsert.merge_partitions

    def spied(spark, touched, new, *a):
        kept = touched.join(new, ["dam_key", "fecha"], "left_anti").count()
        plans.append(kept)
        shown(spark, touched, new, *a)

    monkeypatch.setattr(upsert, "merge_partitions", spied)
    upsert.upsert_table(spark, target, batch, mode="upsert")
    got = sorted((r.dam_key or "", str(r.fecha), r.volumen_alm_mm3) for r in ingest.read_raw(spark, target).collect())
    want = [(k.strip("-"), str(d), v) for k, d, v in rows if (k, d) != ("A", D(2020, 1, 3))]
    want += [("A", "2020-01-03", 30.0), ("", "2020-01-03", 90.0), ("C", "2021-02-01", 5.0), ("A", "2020-01-20", 20.0)]
    assert got == sorted(want) and plans == [19]


def test_slices_are_hashed_not_sorted(spark):
    """The scan of a fact's rows feeds a hash aggregate; a slice whose rows
    have several states is still one row."""
    fact = spark.createDataFrame(
        [("A", D(2020, 1, 1), "X", 1.0, 5.0), ("A", D(2020, 1, 2), "Y", None, 6.0), ("A", D(2020, 1, 3), None, 3.0, None)],
        "dam_key string, fecha date, state string, volumen_alm_mm3 double, namo_oficial_mm3 double").withColumn("name_oficial_mm3", F.lit(1.0))
    r = incremental.slices_of(fact).collect()
    assert [(x.dam_key, x.year, x.last_date, x.last_volume, x.state, x.namo_oficial_mm3) for x in r] == [("A", 2020, D(2020, 1, 3), 3.0, "Y", 6.0)]
    of_rows = [x for x in incremental.slices_of(fact)._jdf.queryExecution().sparkPlan().toString().splitlines() if "xxhash64" in x and "Aggregate" in x]
    assert of_rows and all("HashAggregate" in x for x in of_rows)


def test_small_year_is_merged_in_parts_of_whole_entities(spark, monkeypatch):
    """A year under the size of one full part is not left to one task; the
    rows of an entity are in one file of the merged year."""
    target = scratch_path(spark, "t-small-parts")
    rows = [(f"K{k}", D(2020, 1, d), float(d)) for k in range(40) for d in range(1, 8)]
    upsert.create_table(_raw(spark, rows), target)
    monkeypatch.setattr(upsert, "LEAST_PART", 100)
    seen, part_of = [], upsert.part_of

    def spied(keys, parts):
        seen.append(parts)
        return part_of(keys, parts)

    monkeypatch.setattr(upsert, "part_of", spied)
    batch = _raw(spark, [(f"K{k}", D(2020, 1, 3), -1.0) for k in range(40)]).drop("ingested_at")
    upsert.upsert_table(spark, target, batch, mode="upsert")
    assert seen == [{2020: upsert.FEW_PARTS}]
    got = sorted((r.dam_key, r.fecha, r.volumen_alm_mm3) for r in ingest.read_raw(spark, target).collect())
    assert got == sorted((k, d, -1.0 if d == D(2020, 1, 3) else v) for k, d, v in rows)
    files = spark.read.parquet(target).groupBy("dam_key").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert files.where("n > 1").count() == 0


def test_redone_rows_join_no_slices(spark, monkeypatch):
    """Redone rows are joined with the dimension alone: what is redone and the
    values before come as rows of the lag's window. Slices that are not
    redone, rows without a key and years cut into parts are right."""
    monkeypatch.setattr(incremental, "LEAST_ROWS", 1)  # many parts
    t = "2024-01-01"
    rows = [(f"K{k}", f"{y}-0{m}-01", float(10 * y + m + k), t) for k in range(12) for y in (2021, 2022, 2023) for m in (1, 2, 3)]
    source = _days(spark, rows).unionByName(_days(spark, [("-", "2022-05-05", 1.0, t)]).withColumn("dam_key", F.lit(None).cast("string")))
    dim = spark.createDataFrame([(f"K{k}", f"S{k}", 100.0, 120.0) for k in range(12)], "dam_key string, state string, namo_oficial_mm3 double, name_oficial_mm3 double")
    full = marts.build_fact(source, dim)
    # K9 had rows in 2020 that left the source: they hand on no value.
    slices = incremental.slices_of(marts.build_fact(source.unionByName(_days(spark, [("K9", "2020-07-01", 999.0, t)])), dim))
    redo = spark.createDataFrame([(f"K{k}", y) for k in range(6) for y in (2022, 2023)] + [("K9", 2020), ("K9", 2021)], "dam_key string, year int")
    ends = incremental.slice_ends(source, redo)
    assert ends.agg(F.sum("rows")).first()[0] == 13 * 3
    got = incremental.redone_rows(source, slices, dim, redo, ends)
    want = full.withColumn("year", F.year("fecha")).join(redo, ["dam_key", "year"], "left_semi").select(*S.FACT_COLUMNS)
    assert got.count() == 39 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rows_side = incremental.marts.fact_rows(source, dim)._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert rows_side == 1 and plan.split("Window", 1)[1].count("RepartitionByExpression") == 1
    assert sum("Join LeftSemi" in x for x in plan.splitlines()) == 0


def test_written_tables_leave_no_shuffle_files(spark):
    """Staging and rendering delete the shuffle files of their writes, and set
    the session back."""
    import time

    from gaugeflow.session import materialize

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before, was = shuffled(), spark.conf.get(setting, None)
    raw = _raw(spark, [(k, D(2020, 1, i), float(i)) for i in range(1, 11) for k in "ABC"]).drop("ingested_at")
    dealt = raw.repartition(3, "dam_key")
    kept = materialize(spark, dealt.groupBy("fecha").count(), "t-shuffled")
    for bundled in (False, True):
        render_gauge_files(dealt, f"{scratch_path(spark, 't-rendered')}/landing", S.GAUGE_HEADER, bundled=bundled)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(setting, None) == was
    assert kept.agg({"count": "sum"}).first()[0] == 30 and dealt.count() == 30
