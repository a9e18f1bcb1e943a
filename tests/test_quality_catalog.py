"""Data-quality checks (positive and negative) and catalog operators."""

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import catalog as C
from gaugeflow.operators import quality as Q
from gaugeflow.sources import catalog as src
from tests.conftest import write_file


def test_checks_positive_and_negative(spark):
    good = spark.createDataFrame([("A", 1), ("B", 2)], "k string, n int")
    bad = spark.createDataFrame([("A", 1), ("A", None), (None, 2), (None, 2)], "k string, n int")
    suite = [Q.TableChecks("good", good, not_null=["k", "n"], unique=["k"], unique_combinations=[["k", "n"]]),
             Q.TableChecks("bad", bad, not_null=["k", "n"], unique=["k", "n"], unique_combinations=[["k", "n"]])]
    res = {(r.table_name, r.check_name, r.columns): r.failures for r in Q.run_suite(suite).collect()}
    assert all(v == 0 for (t, _, _), v in res.items() if t == "good")
    assert res[("bad", "not_null", "k")] == 2 and res[("bad", "not_null", "n")] == 1
    assert res[("bad", "unique", "k")] == 1          # NULL keys ignored
    assert res[("bad", "unique", "n")] == 1
    assert res[("bad", "unique_combination", "k,n")] == 1  # (NULL, 2) twice
    Q.assert_clean(Q.run_suite(suite[:1]))
    with pytest.raises(AssertionError):
        Q.assert_clean(Q.run_suite(suite[1:]))


def test_sheet_with_line_break_headers_and_missing_columns(spark, tmpdir_path):
    header = ('Número,Clave,"Nombre de\nla presa",Latitud,Longitud,Altitud,Estado,Municipio,'
              '"Identificador de la cuenca  de disponibilidad",Cuenca de disponibilidad,'
              'Número de la región hidrológica,Región hidrológica')
    row = '1, ABC12 ,"Presa Uno, Ags.",21.5,-102.3,1900.0, Estado X ,Mun,3.0,Cuenca,7,Region'
    write_file(f"{tmpdir_path}/sheet/a.csv", header + "\n" + row + "\n")
    seed = C.clean_sheet(src.read_sheet(spark, f"{tmpdir_path}/sheet")).first()
    assert (seed.numero, seed.dam_key, seed.state_code) == (1, "ABC12", "12")
    assert (seed.dam_name_clean, seed.state, seed.basin_id) == ("Presa Uno", "Estado X", 3)
    write_file(f"{tmpdir_path}/bad/a.csv", "Número,Clave\n1,A\n")
    with pytest.raises(ValueError, match="not renamed"):
        src.read_sheet(spark, f"{tmpdir_path}/bad")


def test_enrich_is_rerunnable_and_rejects_duplicate_keys(spark):
    seed = spark.createDataFrame([(1, "A01", "Uno"), (2, "B02", "Dos")], "numero int, dam_key string, dam_name_clean string")
    caps = spark.createDataFrame([("A01", 10.0, 12.0), (None, 1.0, 1.0)],
                                 "dam_key string, namo_oficial_mm3 double, name_oficial_mm3 double")
    once = C.enrich(seed, caps)
    twice = C.enrich(once, caps)
    assert once.columns == twice.columns
    assert sorted(once.collect()) == sorted(twice.collect())
    assert C.match_summary(once).first().asDict() == {"matched": 1, "total": 2}
    assert [r.dam_key for r in C.unmatched(once).collect()] == ["B02"]
    dup = caps.unionByName(caps.where(F.col("dam_key") == "A01"))
    with pytest.raises(ValueError, match="duplicate"):
        C.enrich(seed, dup)


def test_capacity_report_single_json_array(spark, tmpdir_path):
    write_file(f"{tmpdir_path}/rep/r.json",
               '[\n {"clavesih": "A01", "namoalmac": "10.5", "inicioop": "1990", "uso": "riego"},\n'
               ' {"clavesih": "B02", "namoalmac": "ND", "inicioop": "1990.5"}\n]\n')
    rep = C.coerce_capacities(src.read_capacity_report(spark, f"{tmpdir_path}/rep")).collect()
    got = {r.dam_key: (r.namo_oficial_mm3, r.inicio_operacion, r.uso) for r in rep}
    assert got == {"A01": (10.5, 1990, "riego"), "B02": (None, None, None)}


def test_stored_checks_count_changed_years_only(spark, monkeypatch):
    """Equal to the suite over all rows after each change; years with the same
    files are not read again."""
    from gaugeflow.operators import stored_checks as SC
    from gaugeflow.operators.upsert import with_partition, write_partitions
    from gaugeflow.session import scratch_path

    rows = [(k, f"{y}-01-0{d}", 1.0) for k in "ABC" for y in (1999, 2000, 2001) for d in (1, 2)]

    def frame(rows):
        return spark.createDataFrame(rows, "dam_key string, d string, v double").selectExpr("dam_key", "cast(d as date) fecha", "v")

    path = scratch_path(spark, "t-checks")
    write_partitions(with_partition(frame(rows)), path)
    counted = []
    counts = SC.year_counts
    monkeypatch.setattr(SC, "year_counts", lambda table, *a: (counted.append(
        {r[0] for r in table.select("year").distinct().collect()}), counts(table, *a))[1])

    def check(not_null=("dam_key", "fecha")):
        t = Q.TableChecks("t", spark.read.parquet(path), list(not_null), [], [["dam_key", "fecha"]])
        got = sorted(SC.run_stored_suite(spark, [t], {"t": path}).collect())
        assert got == sorted(Q.run_suite([t]).collect())
        return {(r.check_name, r.columns): r.failures for r in got}

    assert set(check().values()) == {0} and counted == [{1999, 2000, 2001}]
    check()
    assert len(counted) == 1  # nothing new, nothing read
    bad = [("A", "2000-01-01", 2.0), ("A", "2000-01-01", 3.0), (None, "2000-01-05", 1.0), ("B", None, 1.0), ("B", None, 2.0)]
    write_partitions(with_partition(frame(bad)), path, dynamic=True)
    assert check() == {("not_null", "dam_key"): 1, ("not_null", "fecha"): 2, ("unique_combination", "dam_key,fecha"): 2}
    assert counted[1:] == [{2000, None}]
    write_partitions(with_partition(frame([("A", "2000-01-01", 2.0)])), path, dynamic=True)
    assert check()[("not_null", "dam_key")] == 0 and counted[2:] == [{2000}]
    check(not_null=["v"])  # other checks: every year
    assert counted[3:] == [{1999, 2000, 2001, None}]
    write_partitions(with_partition(frame(rows[:1])), path)  # years that are gone
    assert set(check(not_null=["v"]).values()) == {0} and counted[4:] == [{1999}]
    with pytest.raises(ValueError):
        SC.refresh_counts(spark, path, Q.TableChecks("t", frame(rows), unique=["dam_key"]))
