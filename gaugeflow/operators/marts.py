"""Marts: staging filter, entity dimension with history statistics, daily fact
with fill percentages / previous value / delta, latest-row snapshot, top-k.

Functions take and return DataFrames; the run date is a parameter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions.expr import pct_of, rel_diff_pct
from gaugeflow.operators.percentile import percentile_by_key
from gaugeflow.operators.windows import lag_by_key, latest_per_key


def _date(d: str | dt.date | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(str(d)).cast("date")


def stage_daily(
    raw: DataFrame,
    as_of: str | dt.date | Column | None = None,
    min_date: str | dt.date = S.MIN_VALID_DATE,
    date_col: str = S.DATE,
    value_col: str = S.VOLUME,
) -> DataFrame:
    """Staging row filter (P11): ``min_date <= date <= as_of`` and
    ``value >= 0`` (drops NULL values too). ``as_of`` defaults to today."""
    upper = F.current_date() if as_of is None else _date(as_of)
    d, v = F.col(date_col), F.col(value_col)
    return raw.where((d >= _date(min_date)) & (d <= upper) & (v >= 0))


def history_stats(
    daily: DataFrame,
    key: str = S.KEY,
    date_col: str = S.DATE,
    value_col: str = S.VOLUME,
    quantile: float = S.CAPACITY_QUANTILE,
) -> DataFrame:
    """Per-entity history statistics (A1) and exact continuous percentile (A2).

    One hash aggregate with partial aggregation, joined with the percentile of
    :mod:`gaugeflow.operators.percentile` (one row per key on both sides)."""
    v = F.col(value_col)
    values = daily.where(v.isNotNull())
    stats = values.groupBy(key).agg(
        F.min(date_col).alias("first_record_date"),
        F.max(date_col).alias("last_record_date"),
        F.count(F.lit(1)).alias("total_records"),
        F.max(v).alias("max_volumen_historico_mm3"),
    )
    p = percentile_by_key(values, key, value_col, quantile)
    return stats.join(p.withColumnRenamed("percentile", "volumen_p99_mm3"), key, "left")


def build_dim(catalog: DataFrame, daily: DataFrame, key: str = S.KEY, **kw) -> DataFrame:
    """Entity dimension (J3 + P13) from all daily rows."""
    return dim_of(catalog, history_stats(daily, key=key, **kw), key)


def dim_of(catalog: DataFrame, hist: DataFrame, key: str = S.KEY) -> DataFrame:
    """Entity dimension (J3 + P13): every catalog column, then history stats
    (entities without history keep NULLs), estimated capacity and its
    difference to the official one. ``hist`` is one row per entity, see
    :func:`history_stats` and :mod:`gaugeflow.operators.history`."""
    joined = catalog.join(hist, key, "left")
    return joined.select(
        *[F.col(c) for c in catalog.columns],
        "first_record_date",
        "last_record_date",
        "total_records",
        "max_volumen_historico_mm3",
        F.col("volumen_p99_mm3").alias("namo_estimado_mm3"),
        rel_diff_pct("volumen_p99_mm3", "namo_oficial_mm3").alias("namo_p99_vs_oficial_pct"),
    )


def fact_rows(daily: DataFrame, dim: DataFrame, key: str = S.KEY) -> DataFrame:
    """Daily fact before the lag columns: left join with three dimension
    columns (J4) and guarded fill percentages (P12). ``dim`` should be a
    written table: Spark then knows its size and broadcasts it only under its
    own limit."""
    d = dim.select(key, "state", "namo_oficial_mm3", "name_oficial_mm3")
    s = daily.alias("s")
    joined = s.join(d, key, "left")
    return joined.select(
        F.col(key),
        F.col(S.DATE),
        F.col("state"),
        F.col(S.VOLUME),
        F.col("namo_oficial_mm3"),
        F.col("name_oficial_mm3"),
        pct_of(S.VOLUME, "namo_oficial_mm3").alias("pct_llenado"),
        pct_of(S.VOLUME, "name_oficial_mm3").alias("pct_llenado_name"),
        *[F.col(m) for m in S.MEASURES if m != S.VOLUME],
    )


def add_prev_delta(fact: DataFrame, key: str = S.KEY, split: Column | bool | None = True) -> DataFrame:
    """Previous record's volume (W1) and the delta (W2). One window defines
    the lag; the delta is derived from it."""
    with_prev = lag_by_key(fact, key, S.DATE, {"volumen_prev_mm3": S.VOLUME}, split=split)
    return with_prev.withColumn(
        "delta_volumen_mm3", F.col(S.VOLUME) - F.col("volumen_prev_mm3")
    ).select(*S.FACT_COLUMNS)


def build_fact(daily: DataFrame, dim: DataFrame, key: str = S.KEY, split: Column | bool | None = True) -> DataFrame:
    """Full-refresh daily fact, 15 columns (M4)."""
    return add_prev_delta(fact_rows(daily, dim, key), key, split=split)


def build_snapshot(fact: DataFrame, dim: DataFrame, key: str = S.KEY) -> DataFrame:
    """Latest row per entity (W3) with four dimension columns (J5), rank
    column dropped (P15). Ranking runs first (map-side top-1), the join after:
    same result because the dimension is unique on the key."""
    latest = latest_per_key(fact, key, S.DATE)
    d = dim.select(key, *S.SNAPSHOT_DIM_COLUMNS)
    return latest.join(d, key, "left").select(*fact.columns, *S.SNAPSHOT_DIM_COLUMNS)


def top_capacity(dim: DataFrame, n: int = 10, key: str = S.KEY) -> DataFrame:
    """Top-``n`` entities by official capacity with the estimate and the
    unrounded difference (L1). Ties broken by key; rows without either value
    are left out. Planned as TakeOrderedAndProject (per-task top-n)."""
    return (
        dim.where(F.col("namo_oficial_mm3").isNotNull() & F.col("namo_estimado_mm3").isNotNull())
        .select(
            key,
            "dam_name_clean",
            "namo_oficial_mm3",
            "namo_estimado_mm3",
            rel_diff_pct("namo_estimado_mm3", "namo_oficial_mm3", scale=None).alias("diff_pct"),
        )
        .orderBy(F.col("namo_oficial_mm3").desc(), F.col(key))
        .limit(n)
    )
