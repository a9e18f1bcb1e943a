"""Landing parser on handmade gauge files (FIXTURES §2 cases A-L)."""

import os

from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators.upsert import dedupe_batch
from gaugeflow.sources import landing
from tests.conftest import write_file

META = "".join(f"meta {i}\n" for i in range(1, 8))
CANON = ",".join(S.GAUGE_HEADER)


def gauge(rows, header=CANON):
    return META + header + "\n" + "".join(r + "\n" for r in rows)


def row(key, date, vol="10.5", pre="1.0", evap="0.5", obra="2.0", vert="0.0", der="3.0"):
    return ",".join([key, date, pre, evap, obra, vert, der, vol])


def load(spark, d, aliases=None):
    lines = landing.scan_lines(spark, d)
    rows, rejects, status = landing.load_lines(lines, aliases=aliases)
    return rows, rejects, {r.dam_key: r for r in status.collect()}


def test_normal_reordered_nulls_bad_numbers(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/A01.csv", gauge([row("A", "2020-01-01"), row("A", "2020-01-02"), row("A", "2020-01-03")]))
    reordered = ["Estacion", "Fecha", "VolumenAlm(Mm3)", "Precipitacion(mm)", "Evaporacion(mm)",
                 "ObraToma(m3/s)", "Vertedor(m3/s)", "Derrame(m3/s)"]
    write_file(f"{d}/B02.csv", gauge(["B,2020-01-01,99.5,1,2,3,4,5"], ",".join(reordered)))
    write_file(f"{d}/C03.csv", gauge(["C,2020-01-01,,NULL,null,x, 4.5 ,7"]))
    rows, rejects, status = load(spark, d)
    got = {(r.dam_key, str(r.fecha)): r for r in rows.collect()}
    assert len(got) == 5
    assert got[("A01", "2020-01-02")].volumen_alm_mm3 == 10.5
    b = got[("B02", "2020-01-01")]
    assert (b.volumen_alm_mm3, b.precipitacion_mm, b.derrame_m3s) == (99.5, 1.0, 5.0)
    c = got[("C03", "2020-01-01")]
    assert c.precipitacion_mm is None and c.evaporacion_mm is None and c.obra_toma_m3s is None
    assert c.vertedor_m3s is None  # 'x' is not a number: NULL, row kept
    assert c.derrame_m3s == 4.5 and c.volumen_alm_mm3 == 7.0
    assert all(s.status == "ok" for s in status.values())
    assert rejects.count() == 0


def test_ragged_rows_rejected_and_no_date_dropped(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/E01.csv", gauge([
        row("E", "2020-01-01"),
        "E,2020-01-02,1,2",
        "E,2020-01-03,1,2,3,4,5,6,7,8",
        row("E", ""),
        row("E", "NULL"),
    ]))
    rows, rejects, status = load(spark, d)
    assert [str(r.fecha) for r in rows.collect()] == ["2020-01-01"]
    assert rejects.count() == 2
    st = status["E01"]
    assert (st.status, st.data_rows, st.rejected_rows, st.bad_dates) == ("ok", 1, 2, 0)


def test_bad_date_fails_only_that_file(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/G01.csv", gauge([row("G", "2020-01-01"), row("G", "32/13/2020")]))
    write_file(f"{d}/G02.csv", gauge([row("G", "2020-01-01")]))
    rows, _, status = load(spark, d)
    assert [r.dam_key for r in rows.collect()] == ["G02"]
    assert status["G01"].status == "bad_dates" and status["G01"].bad_dates == 1
    assert status["G02"].status == "ok"


def test_variant_header_strict_and_alias(spark, tmpdir_path):
    d = tmpdir_path
    hdr = CANON.replace("Precipitacion(mm)", "Precipitación(mm)").replace("VolumenAlm(Mm3)", "Almacenamiento(hm³)")
    write_file(f"{d}/H01.csv", gauge([row("H", "2020-01-01", vol="42.0", pre="1.5")], hdr))
    rows, _, status = load(spark, d)
    assert rows.count() == 0 and status["H01"].status == "missing_columns"
    rows, _, status = load(spark, d, aliases=landing.VARIANT_ALIASES)
    r = rows.collect()[0]
    assert (r.volumen_alm_mm3, r.precipitacion_mm) == (42.0, 1.5)
    assert status["H01"].status == "ok"


def test_duplicate_dates_first_line_wins(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/I01.csv", gauge([row("I", "2020-01-01", vol="1.0"), row("I", "2020-01-01", vol="2.0")]))
    rows, _, _ = load(spark, d)
    out = dedupe_batch(rows, order=["file", *landing.ORDER_COLS]).collect()
    assert [r.volumen_alm_mm3 for r in out] == [1.0]


def test_short_files_do_not_crash(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/J01.csv", META)
    write_file(f"{d}/J02.csv", META + CANON + "\n")
    write_file(f"{d}/J03.csv", gauge([row("J", "2020-01-01")]))
    rows, _, status = load(spark, d)
    assert [r.dam_key for r in rows.collect()] == ["J03"]
    assert status["J01"].status == "no_header"
    assert (status["J02"].status, status["J02"].data_rows) == ("ok", 0)


def test_quoting_and_crlf(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/K01.csv", gauge(['K,2020-01-01,"1,5",2,3,4,5,"6"']), newline="\r\n")
    rows, rejects, status = load(spark, d)
    r = rows.collect()[0]
    assert r.precipitacion_mm is None  # "1,5" is one cell, not a number
    assert r.volumen_alm_mm3 == 6.0 and rejects.count() == 0
    assert status["K01"].status == "ok"


def test_tail_trim_keeps_last_rows(spark, tmpdir_path):
    d = tmpdir_path
    days = [f"2020-{1 + i // 28:02d}-{1 + i % 28:02d}" for i in range(200)]
    write_file(f"{d}/L01.csv", gauge([row("L", x, vol=str(i)) for i, x in enumerate(days)]))
    lines = landing.scan_lines(spark, d)
    heads = landing.file_heads(lines).persist()
    trimmed = landing.tail_lines(lines, heads, 60)
    rows, _, _ = landing.load_lines(trimmed)
    vols = sorted(r.volumen_alm_mm3 for r in rows.collect())
    assert vols == [float(i) for i in range(140, 200)]


def test_large_file_split_into_blocks(spark, tmpdir_path):
    """A file bigger than one split is read by several tasks: header found in
    the first block, order kept across blocks, no row lost or duplicated."""
    d = tmpdir_path
    n = 3000
    write_file(f"{d}/M01.csv", gauge([row("M", f"{1900 + i // 12:04d}-{1 + i % 12:02d}-01", vol=str(i))
                                       for i in range(n)]))
    assert os.path.getsize(f"{d}/M01.csv") > 64 * 1024
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = landing.scan_lines(spark, d)
        assert lines.select("file_block_start").distinct().count() > 3
        rows, _, status = landing.load_lines(lines)
        assert status.collect()[0].data_rows == n
        assert sorted(r.volumen_alm_mm3 for r in rows.collect()) == [float(i) for i in range(n)]
        heads = landing.file_heads(lines).persist()
        tail, _, _ = landing.load_lines(landing.tail_lines(lines, heads, 60))
        assert sorted(r.volumen_alm_mm3 for r in tail.collect()) == [float(i) for i in range(n - 60, n)]
        # line order across blocks: a duplicate date in a later block loses
        dup = rows.unionByName(rows.where(F.col("volumen_alm_mm3") == 5.0)
                               .withColumn("file_block_start", F.lit(10 ** 9)))
        kept = dedupe_batch(dup, order=["file", *landing.ORDER_COLS]).count()
        assert kept == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_header_in_a_later_block(spark, tmpdir_path):
    """Long metadata lines push the header out of the first split."""
    d = tmpdir_path
    meta = "".join("m" * 10_000 + f" {i}\n" for i in range(7))
    body = "".join(row("N", f"2020-01-{i + 1:02d}", vol=str(i)) + "\n" for i in range(20))
    write_file(f"{d}/N01.csv", meta + CANON + "\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = landing.scan_lines(spark, d)
        heads = landing.file_heads(lines).collect()
        assert heads[0].header_block > 0 and heads[0].header_line == CANON
        rows, rejects, status = landing.load_lines(lines)
        assert sorted(r.volumen_alm_mm3 for r in rows.collect()) == [float(i) for i in range(20)]
        assert rejects.count() == 0 and status.collect()[0].status == "ok"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_file_reported(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/Z01.csv", "")
    write_file(f"{d}/Z02.csv", gauge([row("Z", "2020-01-01")]))
    lines = landing.scan_lines(spark, d)
    rows, _, status = landing.load_lines(lines, files=landing.scan_files(spark, d))
    st = {r.dam_key: r.status for r in status.collect()}
    assert st == {"Z01": "empty", "Z02": "ok"}
    assert rows.count() == 1


def test_date_forms(spark, tmpdir_path):
    d = tmpdir_path
    forms = ["2024/01/05", "2024-1-5", " 2024-01-05", "2024-01-05 00:00:00", "2024-01-05T10:00:00Z", "2024/1/5 ", "2024-01-05 10:00",
             "05/01/2024", "5.1.2024", "05-01-2024 10:00:00"]
    for i, f in enumerate(forms):
        write_file(f"{d}/P{i:02}.csv", gauge([row("P", f)]))
    for i, f in enumerate(["2024-13-01", "2024-02-30", "05/13/24", "2024-01/05", "2024-01-05x", "20240105"]):
        write_file(f"{d}/Q{i:02}.csv", gauge([row("Q", f)]))
    rows, _, status = load(spark, d)
    assert {r.dam_key: str(r.fecha) for r in rows.collect()} == {f"P{i:02}": "2024-01-05" for i in range(len(forms))}
    assert {k: s.status for k, s in status.items() if k[0] == "Q"} == {f"Q{i:02}": "bad_dates" for i in range(6)}
    assert status["Q00"].reason == "bad date: 2024-13-01"


def test_quoted_header_and_cells(spark, tmpdir_path):
    d = tmpdir_path
    header = CANON + ',"Nota, libre"'
    write_file(f"{d}/N01.csv", gauge([row("N", "2020-01-01") + ',"a, ""b"", c"', row("N", "2020-01-02") + ",", '"N",2020-01-03,1,2,3,4,5,6,x'],
                                     header))
    rows, rejects, status = load(spark, d)
    assert rows.count() == 3 and rejects.count() == 0 and status["N01"].status == "ok"
    cells = landing.split_cells(F.col("t"))
    lines = [',a', 'a,', '"x,y",z', '"",""', 'a"b,c"d,e', '"open,to the end', 'q']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in lines], "t string").select(cells).collect()]
    assert got == [["", "a"], ["a", ""], ["x,y", "z"], ["", ""], ['a"b,c"d', "e"], ["open,to the end"], ["q"]]


def test_reasons_and_files_without_fitting_lines(spark, tmpdir_path):
    d = tmpdir_path
    write_file(f"{d}/R01.csv", gauge(["one,two", "three"]))
    write_file(f"{d}/R02.csv", gauge([row("R", "2020-01-01")], CANON.replace("Derrame(m3/s)", "Otro")))
    write_file(f"{d}/R03.csv", "meta\n")
    write_file(f"{d}/R04.csv", "")
    write_file(f"{d}/R05.csv", gauge([row("R", "x" * 500)]))
    lines = landing.scan_lines(spark, d)
    _, _, status = landing.load_lines(lines, files=landing.scan_files(spark, d))
    got = {r.dam_key: (r.status, r.reason) for r in status.collect()}
    assert got["R01"] == ("all_rejected", "no line fits the header, first: one,two")
    assert got["R02"] == ("missing_columns", "missing columns: Derrame(m3/s)")
    assert got["R03"] == ("no_header", "no header line") and got["R04"] == ("empty", "empty file")
    assert got["R05"][0] == "bad_dates" and len(got["R05"][1]) == 200


def test_tail_trim_is_per_file(spark, tmpdir_path):
    d = tmpdir_path
    for span, day in (("9", "2012-01-01"), ("10", "2013-01-01")):
        write_file(f"{d}/dam_key=A/span={span}/x.csv", gauge([row("A", day), row("A", day[:-1] + "2")]))
    lines = landing.scan_lines(spark, d, key_pattern=r"dam_key=([^/]+)/", recursive=True)
    rows, _, _ = landing.load_lines(landing.tail_lines(lines, landing.file_heads(lines), 1))
    assert sorted(str(r.fecha) for r in rows.collect()) == ["2012-01-02", "2013-01-02"]


def test_separators_and_date_orders(spark, tmpdir_path):
    """One choice per file: the separator that finds the columns, the order of
    date parts that fits all lines (year, then day, then month first)."""
    d = tmpdir_path
    days = ["2020-01-05", "2020-02-03", "2020-02-28"]

    def body(form, sep, dates=days):
        return [row("X", form.format(*x.split("-")), vol="6.5").replace(",", sep) for x in dates]

    cases = {"semi": ("{0}-{1}-{2}", ";"), "tab": ("{2}/{1}/{0}", "\t"), "bar": ("{0}/{1}/{2}", "|"),
             "dmy": ("{2}-{1}-{0}", ","), "mdy": ("{1}/{2}/{0}", ","), "dot": ("{2}.{1}.{0} 10:00:00", ";")}
    for name, (form, sep) in cases.items():
        write_file(f"{d}/{name}.csv", gauge(body(form, sep), CANON.replace(",", sep)))
    write_file(f"{d}/both.csv", gauge(body("{1}/{2}/{0}", ",", ["2020-01-05", "2020-02-03"])))
    write_file(f"{d}/mixed.csv", gauge(body("{2}/{1}/{0}", ",") + body("{1}/{2}/{0}", ",")))
    write_file(f"{d}/ragged.csv", gauge([*body("{0}-{1}-{2}", ";"), "X;1;2"], CANON.replace(",", ";")))
    write_file(f"{d}/none.csv", gauge(body("{0}-{1}-{2}", ":"), CANON.replace(",", ":")))
    rows, rejects, status = load(spark, d)
    got = {}
    for r in rows.collect():
        got.setdefault(r.dam_key, []).append(str(r.fecha))
        assert r.volumen_alm_mm3 == 6.5 and r.precipitacion_mm is not None
    assert {k: sorted(v) for k, v in got.items()} == {
        **{name: days for name in (*cases, "ragged")}, "both": ["2020-03-02", "2020-05-01"]}
    assert status["mixed"].status == "bad_dates" and status["mixed"].reason == "bad date: 02/28/2020"
    assert (status["mixed"].data_rows, status["mixed"].bad_dates) == (5, 1)
    assert status["none"].status == "missing_columns"
    assert [(r.dam_key, r.value) for r in rejects.collect()] == [("ragged", "X;1;2")]


def test_line_breaks_in_quoted_cells(spark, tmpdir_path):
    """A quoted cell over several lines, also over the edge of a block; quotes
    that are never closed, or close nothing, are plain characters."""
    d = tmpdir_path
    normal = [row("L", f"{1900 + i // 12:04d}-{1 + i % 12:02d}-01", vol=str(i)) for i in range(600)]
    broken = [f'"L{"x" * 40}\n{"y" * 40}, ""z""\n\nend",' + r.split(",", 1)[1] if i % 3 == 0 else r for i, r in enumerate(normal)]
    write_file(f"{d}/L01.csv", gauge(broken))
    write_file(f"{d}/L02.csv", gauge(normal))
    stray = list(normal[:300])
    stray[10] = stray[10].replace("L,", 'L",', 1)
    write_file(f"{d}/L03.csv", gauge(stray))
    stray[40] = stray[40].replace("L,", 'L",', 1)
    write_file(f"{d}/L04.csv", gauge(stray))
    stray[250] = '"' + stray[250]
    write_file(f"{d}/L05.csv", gauge(stray))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = landing.scan_lines(spark, d)
        rows, rejects, status = landing.load_lines(lines)
        got = {}
        for r in rows.collect():
            got.setdefault(r.dam_key, []).append(r.volumen_alm_mm3)
        for name, n, cut in (("L01", 600, []), ("L02", 600, []), ("L03", 300, [10]), ("L04", 300, [10, 40]), ("L05", 300, [10, 40, 250])):
            assert sorted(got[name]) == [float(i) for i in range(n) if i not in cut], name
        assert {r.status for r in status.collect()} == {"ok"} and rejects.count() == 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bundles_of_many_files(spark, tmpdir_path):
    """Gauge files as members of bundles: the same rows, rejects and status as
    from files of their own, and far fewer landed files."""
    from gaugeflow.plans.fixtures import RENDER_KEY_PATTERN, render_gauge_files

    raw = spark.range(1200).selectExpr(
        "concat('D', cast(id % 40 as string)) as dam_key", "date_add(date'2000-11-01', cast(id div 40 as int) * 2) as fecha",
        *[f"cast(id + {i} as double) as {m}" for i, m in enumerate(S.MEASURES)])
    note = F.when(F.dayofmonth(S.DATE) == 1, F.lit('"a\nb"')).otherwise(F.col(S.KEY))
    seen = []
    for bundled in (False, True):
        d = f"{tmpdir_path}/{bundled}"
        render_gauge_files(raw, d, S.GAUGE_HEADER, {"Estacion": note}, F.when(F.dayofmonth(S.DATE) == 3, F.lit("x,1")), bundled=bundled)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        try:
            where = dict(key_pattern=RENDER_KEY_PATTERN, glob="*.txt", recursive=True)
            files = landing.scan_files(spark, d, **where)
            rows, rejects, status = landing.load_lines(landing.scan_lines(spark, d, members=bundled, **where), files=files)
            seen.append([sorted(map(tuple, x.collect())) for x in (
                rows.select(S.KEY, S.DATE, *S.MEASURES), rejects.select(S.KEY, "value"),
                status.select(S.KEY, F.regexp_extract("file", r"span=(\d+)/", 1), "status", "data_rows", "rejected_rows"))])
            landed = files.count()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0] == seen[1] and len(seen[1][0]) == 1200 and len(seen[1][2]) == 80 and landed <= 8


def test_tail_of_bundled_files(spark, tmpdir_path):
    """Members are trimmed each for itself; lines without a name belong to the
    landed file; a bundle with lines is not an empty file."""
    d = f"{tmpdir_path}/a#b"
    text = gauge([row("A", f"2020-01-{i:02d}", vol=str(i)) for i in range(1, 10)])
    other = gauge([row("B", "2020-02-01")])
    write_file(f"{d}/all.csv", "".join(f"dam_key={k}/g.csv\t{x}\n" for k, t in (("A", text), ("B", other)) for x in t.splitlines()))
    write_file(f"{d}/dam_key=C/own.csv", gauge([row("C", "2020-03-01")]))
    write_file(f"{d}/dam_key=E/none.csv", "")
    where = dict(key_pattern=r"dam_key=([^/]+)/", recursive=True)
    lines = landing.scan_lines(spark, d, members=True, **where)
    _, _, status = landing.load_lines(lines, files=landing.scan_files(spark, d, **where))
    assert sorted((r.dam_key, r.status, r.data_rows) for r in status.collect()) == [
        ("A", "ok", 9), ("B", "ok", 1), ("C", "ok", 1), ("E", "empty", 0)]
    rows, _, _ = landing.load_lines(landing.tail_lines(lines, landing.file_heads(lines), 2))
    assert sorted((r.dam_key, str(r.fecha)) for r in rows.collect()) == [
        ("A", "2020-01-08"), ("A", "2020-01-09"), ("B", "2020-02-01"), ("C", "2020-03-01")]


def test_doubles_of_an_array_equal_those_of_its_elements(spark):
    from gaugeflow.functions.expr import try_double, try_doubles

    texts = ["1", " 2 ", "-.5", "5.", "1d", "0x1p3", "inf", "NaN", "1e5", "1 2", "--1", "", "x", None, "3\t"]
    df = spark.createDataFrame([([a, b],) for a in texts for b in texts], "c array<string>")
    both = df.select("c", try_doubles("c").alias("n"), F.transform("c", try_double).alias("o"))
    assert both.where(~F.col("n").eqNullSafe(F.col("o"))).isEmpty()


def test_quoted_cells_split_as_by_the_full_pattern(spark):
    import itertools

    cells = ["a", '""', '"b"', '"b,c"', ' "b" ', '"x""y"', 'b"c', '"q', "", '"\n"', '"']
    rows = spark.createDataFrame([(",".join(c),) for c in itertools.product(cells, repeat=3)], "line string")
    full = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), "line"), F.lit(landing.CELL.format(",")), F.lit(1)),
        lambda c: F.when(F.instr(c, '"') > 0, F.regexp_replace(F.regexp_replace(c, r'^\s*"|"\s*$', ""), '""', '"')).otherwise(c))
    assert rows.where(~landing.split_cells(F.col("line")).eqNullSafe(full)).isEmpty()


def test_text_is_staged_of_rejected_lines_only(spark, tmp_path):
    head = "\n".join([*(f"m{i}" for i in range(S.GAUGE_METADATA_LINES)), ",".join(S.GAUGE_HEADER)])
    (tmp_path / "A.csv").write_text(head + '\nA,2001-01-01,1,2,"3",null,5,6\nA,cut\n')
    p = landing.parse_lines(landing.scan_lines(spark, str(tmp_path)))
    assert sorted((r["_ragged"], r["value"]) for r in p.parsed.collect()) == [(False, None), (True, "A,cut")]
    assert [(r[S.KEY], r["value"]) for r in p.rejects.collect()] == [("A", "A,cut")]
    assert [(r[S.KEY], r["obra_toma_m3s"], r["vertedor_m3s"]) for r in landing.accepted_rows(p).collect()] == [("A", 3.0, None)]


def test_lines_name_their_file_by_number_and_are_counted_by_hash(spark, tmp_path, monkeypatch):
    """Staged lines hold no path and no key; the counts per file need no sort."""
    made = {}

    def kept(session, df, name):
        made[name] = (dict(df.dtypes), df._jdf.queryExecution().executedPlan().toString())
        return materialize(session, df, name)

    from gaugeflow.session import materialize

    monkeypatch.setattr(landing, "materialize", kept)
    header = ",".join(S.GAUGE_HEADER)
    meta = "".join(f"m{i}\n" for i in range(S.GAUGE_METADATA_LINES))
    write_file(str(tmp_path / "A.csv"), meta + header + '\nA,2020-01-01,"1.5",x,"NULL","",2,3\nA,2020-13-45,1,1,1,1,1,1\nA,cut\n')
    write_file(str(tmp_path / "B.csv"), meta + header + '\nB,"2020-01-01"," 1.5 ","1,5","2""5",,2,"3"\nB,cut\n')
    write_file(str(tmp_path / "C.csv"), meta + header + "\nC,cut,first\nC,cut\n")
    rows, rejects, status = landing.load_lines(landing.scan_lines(spark, str(tmp_path)))
    types, _ = made["parsed-lines"]
    assert types["_file"] == "bigint" and "file" not in types and S.KEY not in types
    _, plan = made["file-counts"]
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert {r[S.KEY]: (r["status"], r["data_rows"], r["rejected_rows"], r["bad_dates"], r["reason"]) for r in status.collect()} == {
        "A": ("bad_dates", 1, 1, 1, "bad date: 2020-13-45"), "B": ("ok", 1, 1, 0, None),
        "C": ("all_rejected", 0, 2, 0, "no line fits the header, first: C,cut,first")}
    assert [(r[S.KEY], str(r[S.DATE]), *[r[m] for m in S.MEASURES]) for r in rows.collect()] == [
        ("B", "2020-01-01", 1.5, None, None, None, 2.0, 3.0)]
    assert sorted((r[S.KEY], r["value"]) for r in rejects.collect()) == [("A", "A,cut"), ("B", "B,cut"), ("C", "C,cut"), ("C", "C,cut,first")]


def test_whole_quoted_cells_need_no_quote_aware_split(spark):
    """Lines that the pattern takes have the cells of the full split."""
    import re

    whole = re.compile(landing.WHOLE_CELLS.format(",").replace(r"\z", r"\Z"))
    lines = ["", "a", '"a"', 'a,"b",c', '"a","b"', '"",""', ',"",', 'a,"b,c"', '"a""b"', 'x"y"', '"a"x', '"a', 'a,"b', ' "a"', '"a\nb",c']
    simple = [t for t in lines if whole.match(t)]
    assert simple == ["", "a", '"a"', 'a,"b",c', '"a","b"', '"",""', ',"",', '"a\nb",c']
    df = spark.createDataFrame([(t,) for t in simple], "t string")
    for r in df.select("t", landing.split_cells(F.col("t")).alias("c")).collect():
        assert r.c == r.t.replace('"', "").split(",")


def test_rendered_files_have_their_lines_in_order(spark, tmp_path):
    """Metadata and header first, then the days, each with its extra line, in
    one pass over the rows: bundled or not, the same files."""
    import datetime as dt

    from gaugeflow.plans.fixtures import RENDER_KEY_PATTERN, render_gauge_files

    days = [(k, dt.date(2020, 1, d), *[float(d)] * len(S.MEASURES)) for d in (3, 1, 2) for k in ("D1", "D2")]
    raw = spark.createDataFrame(days, ", ".join([f"{S.KEY} string", f"{S.DATE} date", *[f"{m} double" for m in S.MEASURES]]))
    extra = F.when(F.dayofmonth(S.DATE) == 2, F.lit("extra"))
    seen = []
    for bundled in (False, True):
        path = str(tmp_path / f"b{bundled}")
        render_gauge_files(raw, path, S.GAUGE_HEADER, extra_lines=extra, bundled=bundled)
        lines = landing.scan_lines(spark, path, RENDER_KEY_PATTERN, "*.txt", recursive=True, members=bundled)
        got = {}
        for r in lines.orderBy("file", *landing.ORDER_COLS).collect():
            got.setdefault(r[S.KEY], []).append(r["value"])
        seen.append(got)
    assert seen[0] == seen[1] and set(seen[0]) == {"D1", "D2"}
    at = S.GAUGE_METADATA_LINES
    assert seen[0]["D1"][at] == ",".join(S.GAUGE_HEADER) and seen[0]["D1"][0] == "Metadato 1"
    assert [t[:13] for t in seen[0]["D1"][at + 1:]] == ["D1,2020-01-01", "D1,2020-01-02", "extra", "D1,2020-01-03"]


def test_lines_with_torn_cells_are_written_once(spark, tmp_path, monkeypatch):
    """Lines of files with an open quote are staged before they are joined, and
    of those files alone."""
    from gaugeflow.session import materialize

    made = {}

    def kept(session, df, name):
        made[name] = materialize(session, df, name)
        return made[name]

    monkeypatch.setattr(landing, "materialize", kept)
    write_file(str(tmp_path / "A.csv"), gauge(['"A\nnote",2020-01-01,1,2,3,4,5,6', row("A", "2020-01-02")]))
    write_file(str(tmp_path / "B.csv"), gauge([row("B", "2020-01-01")]))
    rows, rejects, status = load(spark, str(tmp_path))
    assert {r.file.rsplit("/", 1)[1] for r in made["broken-lines"].collect()} == {"A.csv"}
    assert sorted((r.dam_key, str(r.fecha)) for r in rows.collect()) == [("A", "2020-01-01"), ("A", "2020-01-02"), ("B", "2020-01-01")]
    assert rejects.isEmpty() and {k: v.data_rows for k, v in status.items()} == {"A": 2, "B": 1}


def _daily(spark, entities, days):
    return spark.range(entities * days).selectExpr(
        f"concat('D', cast(id % {entities} as string)) as dam_key",
        f"date_add(date'1998-01-01', cast(id div {entities} as int)) as fecha",
        *[f"cast((id * {7 + i}) % 97 as double) as {m}" for i, m in enumerate(S.MEASURES)])


def _landed_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_compressed_bundles(spark, tmpdir_path, monkeypatch):
    """The same gauge files from bundles with and without gzip, each whole in
    one of many bundles."""
    from gaugeflow.plans import fixtures

    monkeypatch.setattr(fixtures, "BUNDLE_DAYS", 100)
    raw = _daily(spark, 40, 30)
    note = F.when(F.dayofmonth(S.DATE) == 1, F.lit('"a\nb"')).otherwise(F.col(S.KEY))
    seen, landed = [], []
    for compressed in (False, True):
        d = f"{tmpdir_path}/{compressed}"
        fixtures.render_gauge_files(raw, d, S.GAUGE_HEADER, {"Estacion": note}, F.when(F.dayofmonth(S.DATE) == 3, F.lit("x,1")),
                                    bundled=True, compressed=compressed)
        lines = landing.scan_lines(spark, d, fixtures.RENDER_KEY_PATTERN, "*.txt.gz" if compressed else "*.txt", members=True)
        rows, rejects, status = landing.load_lines(lines)
        seen.append([sorted(map(tuple, x.collect())) for x in (
            rows.select(S.KEY, S.DATE, *S.MEASURES), rejects.select(S.KEY, "value"),
            status.select(S.KEY, F.regexp_extract("file", r"span=(\d+)/", 1), "status", "data_rows", "rejected_rows"))])
        landed.append(lines.select(F.substring_index("file", landing.MEMBER_MARK, 1)).distinct().count())
    assert seen[0] == seen[1] and len(seen[1][0]) == 1200 and len(seen[1][2]) == 40
    assert 6 < landed[1] <= 12


def test_registered_landing_files_are_compressed(spark, tmpdir_path):
    """The rendered files of a query take a fraction of their text on disk."""
    from gaugeflow.plans import landing_queries as L

    raw = _daily(spark, 20, 400)
    for path in [*L.render_messy(raw, tmpdir_path), *L.render_broken(raw, tmpdir_path).values()]:
        text = L._lines(spark, path).select(F.sum(F.length("value") + F.length(S.KEY) + F.lit(len("dam_key=/span=8/gauge.txt")))).first()[0]
        assert text > 100_000 and _landed_bytes(path) < text / 3
