"""Catalog inputs (S8, S9, S10, P1, P2): the cleaned seed CSV, the raw
catalog sheet (upstream header names) and the capacity report (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S
from gaugeflow.functions.expr import normalize_header


def seed_schema(columns: list[str] | None = None) -> T.StructType:
    """Declared types of the seed columns."""
    cols = columns or S.SEED_COLUMNS
    by_name = {f.name: f for f in S.CATALOG_SCHEMA.fields}
    return T.StructType([by_name[c] for c in cols])


def read_seed(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Seed CSV with declared column types (S8). Header names are checked
    against the schema (a reordered or renamed file fails instead of being
    read by position)."""
    return (
        spark.read.schema(seed_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_sheet(spark: SparkSession, path: str, renames: dict[str, str] | None = None,
               multi_line: bool = True) -> DataFrame:
    """Raw catalog sheet exported as CSV: every cell as text, header names
    whitespace-normalised (P1), renamed, required columns checked (P2).

    ``multi_line`` allows quoted header cells with line breaks."""
    renames = renames or S.CATALOG_RENAMES
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    df = df.toDF(*[normalize_header(c) for c in df.columns])
    df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    missing = set(renames.values()) - set(df.columns)
    if missing:
        raise ValueError(f"catalog columns not renamed: {sorted(missing)}; columns: {df.columns}")
    return df


def read_capacity_report(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Capacity report (S9): JSON records read as text, 12 fields selected and
    renamed. ``multi_line=True`` reads files holding one JSON array each;
    ``False`` reads line-delimited records or arrays, which splits large files."""
    schema = T.StructType([T.StructField(k, T.StringType(), True) for k in S.CAPACITY_RENAMES])
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return df.select(*[F.col(k).alias(v) for k, v in S.CAPACITY_RENAMES.items()])


def ordered_keys(catalog: DataFrame, key: str = S.KEY, order: str = "numero") -> DataFrame:
    """Entity keys in catalog order."""
    return catalog.select(key, order).orderBy(order, key)
