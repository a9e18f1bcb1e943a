"""Incremental refresh of the daily fact (M3) and schema evolution (M5).

The full-refresh fact is the specification: an incremental run gives the same
table. The unit of work is a *slice*: one key in one year. A slice is redone
when

* the change feed of the source names it: a load after the fact's last run
  added or replaced rows in it, be they valid now or not;
* the run date moved: it holds rows dated after what the last run saw, or the
  fact has rows in it dated after the present run;
* where there is no feed: it holds a row loaded after the last run, or, where
  load times are not known either, a row or a fact row dated after its own
  key's last fact date minus ``lookback_days``, or a key the fact lacks;
* the state or a capacity of its key changed in the dimension;
* it is the key's next slice after one of these, as its first row's previous
  value may have changed.

A table of one row per slice (first and last date, last volume, the dimension
values used) is kept next to the fact. It gives the cuts, the changed
capacities and the seeds of the lag, so neither the fact's nor the source's
history is read for them: the source is read for the years of the redone
slices, and the fact for the years that are replaced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.operators import marts
from gaugeflow.operators.upsert import PARTITION_COL, drop_partitions, part_of, parts_of_year, write_partitions
from gaugeflow.session import exists, materialize

DIM_COLS = ["state", "namo_oficial_mm3", "name_oficial_mm3"]
SLICE = [S.KEY, PARTITION_COL]
PART_ROWS = 1_000_000  # rows of a year per part of it that one task redoes and writes
LEAST_ROWS = 100_000  # rows that a part of a smaller year has at least


def slices_of(fact: DataFrame) -> DataFrame:
    """One row per key and year of a fact. ``digest`` is that of its rows,
    in any order."""
    columns = [c for c in S.FACT_COLUMNS if c in fact.columns]
    # The hash passes over nulls, so their places are hashed too.
    nulls = sum((F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(columns)), F.lit(0))
    # One dimension row made all rows of a slice. By its state first: all that
    # is left to aggregate are numbers and dates, so the rows are hashed; the
    # largest text of a group would have them sorted.
    state, numbers = DIM_COLS[0], DIM_COLS[1:]
    # The sum of the hashes, as sums of their upper and lower halves: a row adds two longs, not a decimal.
    row = F.xxhash64(*columns, nulls)
    upper, lower = F.shiftright(row, 32), row.bitwiseAND(F.lit(0xFFFFFFFF))
    per_state = fact.groupBy(S.KEY, F.year(S.DATE).alias(PARTITION_COL), state).agg(
        F.sum(upper).alias("_upper"), F.sum(lower).alias("_lower"), F.max(S.DATE).alias("last_date"),
        F.max_by(S.VOLUME, S.DATE).alias("last_volume"), *[F.max(c).alias(c) for c in numbers])
    digest = F.col("_upper").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_lower").cast("decimal(19,0)")
    return per_state.withColumn("digest", digest.cast("decimal(38,0)")).groupBy(*SLICE).agg(
        F.sum("digest").cast("decimal(38,0)").alias("digest"), F.max("last_date").alias("last_date"),
        F.max_by("last_volume", "last_date").alias("last_volume"), *[F.max(c).alias(c) for c in DIM_COLS])


def touched_slices(source: DataFrame, slices: DataFrame, feed: DataFrame, seen_until: dt.date, as_of: dt.date) -> DataFrame:
    """(key, year) in which the staged ``source`` may differ from what the last
    run saw: those of the ``feed``, and what a moved run date lets in or out.
    ``slices`` has the last date of each slice that the run made."""
    newer = _from_year(source, seen_until).where(F.col(S.DATE) > F.lit(seen_until))
    out = feed.select(*SLICE).unionByName(newer.select(S.KEY, F.year(S.DATE).alias(PARTITION_COL)))
    if as_of < seen_until:
        out = out.unionByName(slices.where(F.col("last_date") > F.lit(as_of)).select(*SLICE))
    return out.distinct()


def _from_year(source: DataFrame, day: dt.date) -> DataFrame:
    """Rows of the years from ``day`` on, by partition where the frame has them."""
    return source.where(F.col(PARTITION_COL) >= day.year) if PARTITION_COL in source.columns else source


def in_years(source: DataFrame, years: list[int]) -> DataFrame:
    """Rows of the given years, pruned by partition and by date."""
    spans = F.lit(False)
    for a, b in _runs(years):
        spans = spans | F.col(S.DATE).between(F.lit(dt.date(a, 1, 1)), F.lit(dt.date(b, 12, 31)))
    return (source.where(F.col(PARTITION_COL).isin(years)) if PARTITION_COL in source.columns else source).where(spans)


def rows_of_slices(source: DataFrame, slices: DataFrame) -> DataFrame:
    """Rows of ``source`` in the given slices (a written table), with their
    year. Only the years that the slices have are read."""
    years = [r[0] for r in slices.select(PARTITION_COL).distinct().collect()]  # one per year
    return in_years(source, years).withColumn(PARTITION_COL, F.year(S.DATE)).join(slices.select(*SLICE), SLICE, "left_semi")


def changed_slices(source: DataFrame, slices: DataFrame, dim: DataFrame, lookback_days: int = S.LOOKBACK_DAYS,
                   since: dt.datetime | None = None, seen_until: dt.date | None = None,
                   touched: DataFrame | None = None) -> DataFrame:
    """(key, year) of every slice to redo; see the module doc. ``touched`` (see
    :func:`touched_slices`) says where the source changed. Without it, rows
    loaded after ``since`` or dated after ``seen_until`` count as new; without
    those, keys and dates are compared with the slices, and what stopped being
    valid is found inside the look-back only."""
    if touched is not None:
        changed = touched.select(*SLICE)
    else:
        loaded = F.col("ingested_at") > F.lit(since) if since is not None and "ingested_at" in source.columns else F.lit(False)
        if since is not None and seen_until is not None and "ingested_at" in source.columns:
            rows = source.where(loaded | (F.col(S.DATE) > F.lit(seen_until)))
            changed = rows.select(S.KEY, F.year(S.DATE).alias(PARTITION_COL)).distinct()
        else:
            marks = slices.groupBy(S.KEY).agg(F.max("last_date").alias("_mark"))
            recent = F.date_sub("_mark", lookback_days)
            rows = source.join(marks, S.KEY, "left").where(loaded | F.col("_mark").isNull() | (F.col(S.DATE) > recent))
            ends = slices.join(marks, S.KEY).where(F.col("last_date") > recent)
            changed = rows.select(S.KEY, F.year(S.DATE).alias(PARTITION_COL)).unionByName(ends.select(*SLICE)).distinct()
        changed = materialize(source.sparkSession, changed, "changed")  # used twice: the source is read for it once
    now = dim.select(S.KEY, *[F.col(c).alias(f"_{c}") for c in DIM_COLS])
    differs = F.lit(False)
    for c in DIM_COLS:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    stale = slices.join(now, S.KEY, "left").where(differs).select(*SLICE)
    redo = changed.unionByName(stale).distinct().withColumn("_redo", F.lit(True))
    known = slices.select(*SLICE).unionByName(changed).distinct().join(redo, SLICE, "left")
    # The next slice with rows: one that lost its last row has none to hand on to.
    after = F.lag("_redo").over(Window.partitionBy(S.KEY).orderBy(PARTITION_COL))
    return known.withColumn("_after", after).where(F.col("_redo") | F.col("_after")).select(*SLICE)


def slice_ends(source: DataFrame, redo: DataFrame) -> DataFrame:
    """Rows and last volume of the slices ``redo`` (a written table) that have
    source rows: a written table. The rows are aggregated first, so the join
    is one of slices."""
    years = [r[0] for r in redo.select(PARTITION_COL).distinct().collect()]  # one per year
    ends = in_years(source, years).groupBy(S.KEY, F.year(S.DATE).alias(PARTITION_COL)).agg(
        F.max_by(S.VOLUME, S.DATE).alias("last_volume"), F.count(F.lit(1)).alias("rows"))
    return materialize(source.sparkSession, ends.join(redo.select(*SLICE), SLICE, "left_semi"), "slice-ends")


def redone_rows(source: DataFrame, slices: DataFrame, dim: DataFrame, redo: DataFrame, ends: DataFrame) -> DataFrame:
    """Fact rows of the slices ``redo``, of which ``ends`` (see :func:`slice_ends`)
    have source rows, from the rows of those years. The first row of a slice takes its previous value from
    the last row of the key's slice before it, redone or as it stands.

    Each slice sends one row ahead of its own rows, with that value as its
    volume: it seeds the lag, and slices without one are not redone. So rows are
    joined with slices by the shuffle and sort of the lag alone. They are dealt
    by year and by parts of it, so a task writes few years."""
    counts = ends.groupBy(PARTITION_COL).agg(F.sum("rows").alias("n")).collect()  # one row per year
    before = F.lag("last_volume").over(Window.partitionBy(S.KEY).orderBy(PARTITION_COL))
    stand = slices.join(redo, SLICE, "left_anti").select(*SLICE, "last_volume", F.lit(False).alias("_redo"))
    both = ends.select(*SLICE, "last_volume", F.lit(True).alias("_redo")).unionByName(stand)
    heads = both.withColumn(S.VOLUME, before).where("_redo").select(*SLICE, S.VOLUME, "_redo")
    rows = in_years(source, [r[PARTITION_COL] for r in counts])
    fact = marts.fact_rows(rows.drop(PARTITION_COL), dim).withColumn(PARTITION_COL, F.year(S.DATE))
    part = part_of([S.KEY], {r[PARTITION_COL]: parts_of_year(r["n"], LEAST_ROWS, PART_ROWS) for r in counts})
    dealt = fact.unionByName(heads, allowMissingColumns=True).withColumn("_part", part).repartition(PARTITION_COL, "_part")
    order = Window.partitionBy(S.KEY, PARTITION_COL, "_part").orderBy(F.col(S.DATE).asc_nulls_first())
    lagged = dealt.withColumns({"volumen_prev_mm3": F.lag(S.VOLUME).over(order), "_of": F.first("_redo").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))}).where(F.col("_of") & F.col("_redo").isNull())
    return lagged.withColumn("delta_volumen_mm3", F.col(S.VOLUME) - F.col("volumen_prev_mm3")).select(*S.FACT_COLUMNS)


def _runs(years: list[int]) -> list[tuple[int, int]]:
    """Consecutive years as (first, last)."""
    out: list[tuple[int, int]] = []
    for y in sorted(years):
        if out and y == out[-1][1] + 1:
            out[-1] = (out[-1][0], y)
        else:
            out.append((y, y))
    return out


def replace_slices(target: DataFrame, fresh: DataFrame, redo: DataFrame) -> DataFrame:
    """Rows of ``target`` outside the redone slices, and the fresh rows."""
    kept = target.withColumn(PARTITION_COL, F.year(S.DATE)).join(redo, SLICE, "left_anti").drop(PARTITION_COL)
    return evolve_union(kept, fresh)


def refresh_fact(source: DataFrame, target: DataFrame, dim: DataFrame, lookback_days: int = S.LOOKBACK_DAYS,
                 since: dt.datetime | None = None) -> DataFrame:
    """New fact = target rows outside the redone slices ∪ redone rows (M3), for
    a fact that is no table yet: its slices are computed from it. ``source``
    is the staged daily table; :func:`refresh_fact_table` keeps the slices."""
    spark = source.sparkSession
    slices = materialize(spark, slices_of(target), "slices")
    redo = materialize(spark, changed_slices(source, slices, dim, lookback_days, since), "redo")
    return replace_slices(target, redone_rows(source, slices, dim, redo, slice_ends(source, redo)), redo)


def slices_path(path: str) -> str:
    return f"{path.rstrip('/')}_slices"


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact table with the columns of all its files: years written before
    a column was added have NULL in it."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_fact_table(fact: DataFrame, path: str) -> None:
    """Full rebuild of the fact as a year-partitioned table (M4), with its
    table of slices."""
    spark = fact.sparkSession
    write_partitions(fact.withColumn(PARTITION_COL, F.year(S.DATE)), path)
    slices_of(spark.read.parquet(path).drop(PARTITION_COL)).write.mode("overwrite").parquet(slices_path(path))


def fact_slices(spark: SparkSession, path: str) -> DataFrame:
    """The table of slices next to the fact at ``path``; made where missing."""
    if not exists(spark, slices_path(path)) or "digest" not in spark.read.parquet(slices_path(path)).columns:
        slices_of(read_fact(spark, path).drop(PARTITION_COL)).write.mode("overwrite").parquet(slices_path(path))
    return spark.read.parquet(slices_path(path))


def refresh_fact_table(spark: SparkSession, source: DataFrame, path: str, dim: DataFrame,
                       lookback_days: int = S.LOOKBACK_DAYS, since: dt.datetime | None = None,
                       seen_until: dt.date | None = None, touched: DataFrame | None = None) -> int:
    """Incremental refresh of the year-partitioned fact at ``path`` (M3).

    Only the years with redone slices are read, merged and replaced, in one
    write with a dynamic partition overwrite; years that lost all their rows
    are removed; a missing table is built in full. For ``touched`` see
    :func:`changed_slices`. Returns the number of redone rows, -1 after a full
    build."""
    if not exists(spark, path):
        write_fact_table(marts.build_fact(source, dim), path)
        return -1
    slices = fact_slices(spark, path)
    redo = materialize(spark, changed_slices(source, slices, dim, lookback_days, since, seen_until, touched), "redo")
    years = [r[0] for r in redo.select(PARTITION_COL).distinct().collect()]  # one per year
    if not years:
        return 0
    ends = slice_ends(source, redo)
    stand = slices.join(redo, SLICE, "left_anti")
    left = {r[0] for r in stand.select(PARTITION_COL).union(ends.select(PARTITION_COL)).distinct().collect()}  # one per year
    of_years = read_fact(spark, path).where(F.col(PARTITION_COL).isin(years))
    kept = of_years.join(redo, SLICE, "left_anti").drop(PARTITION_COL)
    # The kept rows alone are dealt for the write; the fresh ones are already.
    merged = evolve_union(kept.withColumn(PARTITION_COL, F.year(S.DATE)).hint("rebalance", F.col(PARTITION_COL)),
                          redone_rows(source, slices, dim, redo, ends).withColumn(PARTITION_COL, F.year(S.DATE)))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(path)
    drop_partitions(spark, path, [y for y in years if y not in left])
    redone = ends.agg(F.sum("rows")).first()[0] or 0
    if redone:
        # Read back from what was written; a slice is cheaper to leave out than its rows.
        written = read_fact(spark, path).where(F.col(PARTITION_COL).isin(years)).drop(PARTITION_COL)
        stand = stand.unionByName(slices_of(written).join(ends, SLICE, "left_semi"))
    materialize(spark, stand, "slices").write.mode("overwrite").parquet(slices_path(path))
    return redone


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append-new-columns schema evolution (M5): columns only in ``new`` are
    NULL for old rows; columns only in ``old`` are kept (NULL for new rows).
    Column order: ``old``'s, then the added ones."""
    out = old.unionByName(new, allowMissingColumns=True)
    added = [c for c in new.columns if c not in old.columns]
    return out.select(*old.columns, *added)
