"""Running (day-to-date) aggregates that survive hot groups.

A plain ``Window.partitionBy(symbol, day)`` puts a whole symbol-day into one
task; when one symbol holds a third of all quotes that task holds a third of
the data.  Here the group is cut into contiguous time chunks:

1. per-chunk aggregates (a hash aggregate with map-side partial combine),
2. an exclusive prefix over the chunk table (one row per chunk, so the
   per-group window is bounded by the number of chunks in a day),
3. a running window inside each chunk, combined with the prefix.

The result equals the plain running window ordered by ``order_cols`` as long
as chunks are contiguous in that order, which holds because the chunk is a
truncation of the leading order column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_stats(df: DataFrame, keys: list[str], ts_col: str, tie_col: str, value_col: str,
                  chunk_unit: str = "second", prefix: str = "run") -> DataFrame:
    """Append ``{prefix}_first/_max/_min/_count`` running over ``keys`` ordered by (ts, tie)."""
    chunk = "_chunk"
    order = [ts_col, tie_col]
    base = df.withColumn(chunk, F.date_trunc(chunk_unit, F.col(ts_col)))

    per_chunk = base.groupBy(*keys, chunk).agg(
        F.count(F.lit(1)).alias("_c_n"),
        F.max(value_col).alias("_c_max"),
        F.min(value_col).alias("_c_min"),
        F.min_by(F.col(value_col), F.struct(*[F.col(c) for c in order])).alias("_c_first"),
    )
    w_chunks = Window.partitionBy(*keys).orderBy(chunk)
    before = w_chunks.rowsBetween(Window.unboundedPreceding, -1)
    upto = w_chunks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    join_keys = [*keys, chunk]
    prefix_tbl = per_chunk.select(
        *[F.col(k).alias(f"_k_{k}") for k in join_keys],
        F.coalesce(F.sum("_c_n").over(before), F.lit(0)).alias("_p_n"),
        F.max("_c_max").over(before).alias("_p_max"),
        F.min("_c_min").over(before).alias("_p_min"),
        F.first("_c_first").over(upto).alias("_p_first"),
    )

    w_in = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # null-safe: a row with a null key or time belongs to a group like any other
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in join_keys])
    joined = base.join(prefix_tbl, same)
    return joined.select(
        *[c for c in df.columns],
        F.col("_p_first").alias(f"{prefix}_first"),
        F.greatest(F.col("_p_max"), F.max(value_col).over(w_in)).alias(f"{prefix}_max"),
        F.least(F.col("_p_min"), F.min(value_col).over(w_in)).alias(f"{prefix}_min"),
        (F.col("_p_n") + F.count(F.lit(1)).over(w_in)).alias(f"{prefix}_count"),
    )


def col_or_lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)
