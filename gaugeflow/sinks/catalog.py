"""Catalog write-back (K7): CSV with a header, columns cast to their declared
types so the seed reader (S8) reads the file back unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.expr import round_half_away, try_double, try_int


def to_declared_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each column to its declared type; a number for an int column is
    rounded, halves away from zero, as the seed loader's cast does (an altitude
    of 12.5 is 13, not lost)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType) and not isinstance(df.schema[f.name].dataType, T.IntegerType):
            cols.append(try_int(round_half_away(try_double(c.cast("string")), 0)).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def write_catalog_csv(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Write to a new path (never over the input being read)."""
    out = to_declared_types(df, schema) if schema is not None else df
    out.write.mode("errorifexists").option("header", True).csv(path)
