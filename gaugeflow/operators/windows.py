"""Window operators that stay balanced when one key holds a large share of
the rows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task. Here
the window is partitioned by ``(key, split)`` where ``split`` cuts each key's
time line into ranges (by default the year of the date). The only value that
crosses a split boundary for ``lag`` is the last row of the previous non-empty
split of the same key; it is computed by a partial/final aggregate (one row per
(key, split), combined map-side before its shuffle) and a window over that
small table (one row per split per key), then joined back on (key, split); the
big side of that join is already partitioned by (key, split) from the window,
so it is not shuffled again. Results equal the unsplit window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_split(order_col: str) -> Column:
    """Year of the ordering column: bounds a daily series to 366 rows/split."""
    return F.year(F.col(order_col))


def lag_by_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    values: dict[str, str],
    split: Column | None | bool = True,
) -> DataFrame:
    """Add ``lag(value)`` columns, one previous record per key ordered by
    ``order`` (W1). ``values`` maps output column -> input column.

    ``order`` must be unique within a key (the grain). ``split=True`` uses
    :func:`default_split`, a Column uses that expression, ``False`` or ``None``
    gives the plain single-partition-per-key window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if split is None or split is False:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({out: F.lag(src).over(w) for out, src in values.items()})

    split_expr = default_split(order) if split is True else split
    cols = df.columns
    d = df.withColumn("_split", split_expr)
    w = Window.partitionBy(*keys, "_split").orderBy(order)
    lagged = d.withColumns({
        "_prev_order": F.lag(order).over(w),
        **{out: F.lag(src).over(w) for out, src in values.items()},
    })
    # Last record of every (key, split): a partial/final aggregate, combined
    # map-side, so only one row per (key, split) and task is shuffled; the
    # scan below it reads just the key, order and value columns.
    last = d.groupBy(*keys, "_split").agg(
        *[F.max_by(src, order).alias(f"_last_{out}") for out, src in values.items()])
    wk = Window.partitionBy(*keys).orderBy("_split")
    carry = last.select(
        *keys,
        "_split",
        *[F.lag(f"_last_{out}").over(wk).alias(f"_carry_{out}") for out in values],
    )
    joined = lagged.join(carry, [*keys, "_split"], "left")
    first = F.col("_prev_order").isNull()
    return joined.select(
        *[
            F.when(first, F.col(f"_carry_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in cols
        ],
        *[
            F.when(first, F.col(f"_carry_{out}")).otherwise(F.col(out)).alias(out)
            for out in values
            if out not in cols
        ],
    )


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str, n: int = 1) -> DataFrame:
    """Top-``n`` rows per key by ``order`` descending.

    ``row_number() <= n`` is planned as a map-side WindowGroupLimit before the
    shuffle, so each map task sends at most ``n`` rows per key: a hot key does
    not land whole in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def first_n_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows per key by ``order`` ascending, map-side limited."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each group of ``keys`` by ``order`` ascending
    (used for de-duplication)."""
    return first_n_per_key(df, list(keys), order, 1)
