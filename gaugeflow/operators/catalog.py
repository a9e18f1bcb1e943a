"""Catalog cleaning and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions.expr import clean_dam_name, right, strip_ws, try_double, try_int


def clean_sheet(sheet: DataFrame, strict_int: bool = False) -> DataFrame:
    """Renamed sheet -> seed table (14 columns, fixed order).

    Numbers to double (P3) and nullable int (P4), six text columns stripped
    (P5; NULL stays NULL), name suffix removed (P6), state code = last two
    characters of the key (P7), fixed projection (P8).
    """
    cols = {c: try_double(c) for c in S.CATALOG_DOUBLE_COLUMNS}
    cols.update({c: try_int(c, strict=strict_int) for c in S.CATALOG_INT_COLUMNS})
    cols.update({c: strip_ws(c) for c in S.CATALOG_STRIP_COLUMNS})
    df = sheet.withColumns(cols)
    df = df.withColumns({
        "dam_name_clean": clean_dam_name("dam_name"),
        "state_code": right(S.KEY, 2),
    })
    return df.select(*S.SEED_COLUMNS)


def coerce_capacities(report: DataFrame, strict_int: bool = False) -> DataFrame:
    """Capacity report text cells -> doubles (P3) and nullable int."""
    cols = {c: try_double(c) for c in S.CAPACITY_DOUBLE_COLUMNS}
    cols.update({c: try_int(c, strict=strict_int) for c in S.CAPACITY_INT_COLUMNS})
    return report.withColumns(cols)


def duplicate_keys(df: DataFrame, key: str = S.KEY) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1)


def enrich(seed: DataFrame, capacities: DataFrame, key: str = S.KEY, check_unique: bool = True) -> DataFrame:
    """seed ⟕ capacities on the key (J1), 25 columns in catalog order.

    Capacity columns already on the seed are replaced, so enriching twice
    gives the same table. Right-side rows with a NULL key never match. With
    ``check_unique`` a duplicated right key raises (it would duplicate seed
    rows); the check is one aggregate over the report.
    """
    right_cols = [c for c in capacities.columns if c != key]
    caps = capacities.where(F.col(key).isNotNull())
    if check_unique:
        dups = duplicate_keys(caps, key).limit(5).collect()
        if dups:
            raise ValueError(f"capacity report has duplicate keys: {[r[0] for r in dups]}")
    base = seed.drop(*[c for c in right_cols if c in seed.columns])
    joined = base.join(caps, key, "left")
    return joined.select(*[c for c in S.CATALOG_COLUMNS if c in joined.columns])


def match_summary(enriched: DataFrame, capacity_col: str = "namo_oficial_mm3") -> DataFrame:
    """Matched / total entities (J2). "Matched" means a non-NULL capacity after
    the join, so a matched key with a NULL capacity counts as unmatched."""
    return enriched.agg(
        F.count(capacity_col).alias("matched"),
        F.count(F.lit(1)).alias("total"),
    )


def unmatched(enriched: DataFrame, key: str = S.KEY, capacity_col: str = "namo_oficial_mm3") -> DataFrame:
    """Entities without a capacity after the join, with their name."""
    return enriched.where(F.col(capacity_col).isNull()).select(key, "dam_name_clean")
