"""Data-quality counts kept per year of a written table (Q1, Q3, Q4).

The checks of the raw table and of the fact are sums over years: a missing
value stands in one year, and so do rows that share key and date. Next to such
a table the counts of each year are kept with a digest of the year's files. A
year whose files are those that were counted is not read again, whoever wrote
the others: a rewritten partition has files of new names.

Defined results: rows without a date are a year of their own (null); years that
are gone leave the counts; other declared checks than those of the stored
counts, or no stored counts, count every year.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators.quality import RESULT_SCHEMA, TableChecks, run_suite
from gaugeflow.operators.upsert import PARTITION_COL
from gaugeflow.session import exists, materialize

ROWS = "rows"  # the name of a year's row count among its checks


def store_path(path: str) -> str:
    return f"{path.rstrip('/')}_checks"


def year_files(spark: SparkSession, path: str) -> DataFrame:
    """A row per year partition: a digest of its files' names and sizes, from
    the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(F.col(PARTITION_COL).cast("int").alias(PARTITION_COL)).agg(
        F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).alias("files"))


def year_counts(table: DataFrame, not_null: Sequence[str], combinations: Sequence[Sequence[str]]) -> DataFrame:
    """(year, check_name, columns, failures) of ``table``: one scan for all
    missing values, one aggregate per combination. Combinations without a
    failure have no row."""
    year = F.col(PARTITION_COL).cast("int").alias(PARTITION_COL)
    nulls = table.groupBy(year).agg(F.count(F.lit(1)).alias(ROWS), *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in not_null])
    counts = nulls.unpivot([PARTITION_COL], [ROWS, *[f"null:{c}" for c in not_null]], "what", "failures")
    is_rows = F.col("what") == ROWS
    out = counts.select(PARTITION_COL, F.when(is_rows, ROWS).otherwise("not_null").alias("check_name"),
                        F.when(is_rows, "").otherwise(F.substring("what", 6, 1000)).alias("columns"), "failures")
    for cols in combinations:
        again = table.groupBy(year, *cols).count().where(F.col("count") > 1)
        out = out.unionByName(again.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("failures")).select(
            PARTITION_COL, F.lit("unique_combination").alias("check_name"), F.lit(",".join(cols)).alias("columns"), "failures"))
    return out


def refresh_counts(spark: SparkSession, path: str, checks: TableChecks, date_col: str = S.DATE) -> DataFrame:
    """The counts of every year of the table at ``path``, of which only the
    years with other files than at the last call are read. A combination must
    hold ``date_col``, so that equal ones share a year."""
    if checks.unique or any(date_col not in c for c in checks.unique_combinations):
        raise ValueError(f"checks of {checks.name} do not split into years")
    store = store_path(path)
    declared = json.dumps([checks.not_null, checks.unique_combinations])
    now = materialize(spark, year_files(spark, path).withColumn("declared", F.lit(declared)), "year-files")
    stale, valid = now, None
    if exists(spark, store):
        known = spark.read.parquet(store)
        same = (F.col("n.year").eqNullSafe(F.col("k.year")) & (F.col("n.files") == F.col("k.files"))
                & (F.col("n.declared") == F.col("k.declared")))
        valid = known.alias("k").join(now.alias("n"), same, "left_semi")
        stale = now.alias("n").join(known.alias("k"), same, "left_anti")
        if stale.isEmpty() and known.alias("k").join(now.alias("n"), same, "left_anti").isEmpty():
            return known
    years = [r[0] for r in stale.select(PARTITION_COL).collect()]  # one per year
    wanted = F.col(PARTITION_COL).isin([y for y in years if y is not None])
    if None in years:
        wanted = F.col(PARTITION_COL).isNull() | F.coalesce(wanted, F.lit(False))
    table = spark.read.option("mergeSchema", "true").parquet(path).where(wanted)
    counts = year_counts(table, checks.not_null, checks.unique_combinations).alias("c")
    fresh = counts.join(now.alias("n"), F.col("c.year").eqNullSafe(F.col("n.year"))).select("c.*", "files", "declared")
    out = materialize(spark, fresh if valid is None else valid.unionByName(fresh), "checks")
    out.write.mode("overwrite").parquet(store)
    return out


def suite_rows(spark: SparkSession, checks: TableChecks, counts: DataFrame) -> DataFrame:
    """One row per declared check, as :func:`quality.run_suite` gives them."""
    names = [("not_null", c) for c in checks.not_null] + [("unique_combination", ",".join(c)) for c in checks.unique_combinations]
    declared = spark.createDataFrame([(checks.name, *n) for n in names], "table_name string, check_name string, columns string")
    sums = counts.groupBy("check_name", "columns").agg(F.sum("failures").alias("failures"))
    return declared.join(sums, ["check_name", "columns"], "left").select(
        "table_name", "check_name", "columns", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))


def run_stored_suite(spark: SparkSession, tables: Sequence[TableChecks], paths: dict[str, str]) -> DataFrame:
    """:func:`quality.run_suite`, with the tables named in ``paths`` (written,
    partitioned by year) checked through their stored counts."""
    other = [t for t in tables if t.name not in paths]
    out = run_suite(other) if other else spark.createDataFrame([], RESULT_SCHEMA)
    for t in tables:
        if t.name in paths:
            out = out.unionByName(suite_rows(spark, t, refresh_counts(spark, paths[t.name], t)))
    return out
