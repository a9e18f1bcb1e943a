"""Data-quality checks (Q1-Q4): not-null, unique, unique combination, and a
suite that reports one row per check.

All not-null checks of one table run as a single aggregate (one scan);
each uniqueness check is one partial/final aggregate on its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("columns", T.StringType(), False),
        T.StructField("failures", T.LongType(), False),
    ]
)


@dataclass
class TableChecks:
    """Checks declared on one table."""

    name: str
    df: DataFrame
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    unique_combinations: list[list[str]] = field(default_factory=list)


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows failing ``not_null(column)`` (Q1)."""
    return df.where(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once; NULLs are ignored (Q2)."""
    return df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)


def combination_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations occurring more than once (Q3); NULLs group together."""
    return df.groupBy(*columns).count().where(F.col("count") > 1)


def _not_null_rows(t: TableChecks) -> DataFrame:
    agg = t.df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in t.not_null])
    return agg.unpivot([], list(t.not_null), "columns", "failures").select(
        F.lit(t.name).alias("table_name"),
        F.lit("not_null").alias("check_name"),
        F.col("columns"),
        F.col("failures").cast("long").alias("failures"),
    )


def _count_row(v: DataFrame, table: str, check: str, columns: str) -> DataFrame:
    return v.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(columns).alias("columns"),
        F.col("failures").cast("long").alias("failures"),
    )


def run_suite(tables: Sequence[TableChecks]) -> DataFrame:
    """One row per check: (table_name, check_name, columns, failures) (Q4)."""
    parts: list[DataFrame] = []
    for t in tables:
        if t.not_null:
            parts.append(_not_null_rows(t))
        for c in t.unique:
            parts.append(_count_row(unique_violations(t.df, c), t.name, "unique", c))
        for cols in t.unique_combinations:
            parts.append(_count_row(combination_violations(t.df, cols), t.name, "unique_combination", ",".join(cols)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def default_suite(catalog: DataFrame, raw: DataFrame, dim: DataFrame, fact: DataFrame,
                  snapshot: DataFrame) -> list[TableChecks]:
    """The 17 declared checks: 8 on the catalog, 2 on the raw table, 7 on the marts."""
    return [
        TableChecks(
            "catalog", catalog,
            not_null=[S.KEY, "numero", "latitude", "longitude", "namo_oficial_mm3", "name_oficial_mm3"],
            unique=[S.KEY, "numero"],
        ),
        TableChecks("raw", raw, not_null=[S.KEY, S.DATE]),
        TableChecks("dim", dim, not_null=[S.KEY], unique=[S.KEY]),
        TableChecks("fact", fact, not_null=[S.KEY, S.DATE], unique_combinations=[[S.KEY, S.DATE]]),
        TableChecks("snapshot", snapshot, not_null=[S.KEY], unique=[S.KEY]),
    ]


def assert_clean(result: DataFrame, allow: Sequence[tuple[str, str, str]] = ()) -> None:
    """Raise when a check has failures (the suite result is 17 rows: safe to
    bring to the driver)."""
    bad = [
        r for r in result.where(F.col("failures") > 0).collect()
        if (r.table_name, r.check_name, r.columns) not in set(allow)
    ]
    if bad:
        msg = ", ".join(f"{r.table_name}.{r.check_name}({r.columns})={r.failures}" for r in bad)
        raise AssertionError(f"data-quality checks failed: {msg}")
