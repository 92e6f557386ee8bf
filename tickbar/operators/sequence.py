"""Consecutive row numbers over a global order without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into
one task.  Instead: range-partition and sort by the order (Spark samples the
keys, so a hot value is split across partitions), checkpoint to fix the
partition assignment, count rows per partition (one small row each), turn the
counts into offsets and add each row's position inside its partition.
The offset table has one row per partition, a bound known up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = 33  # monotonically_increasing_id keeps the in-partition index in the low 33 bits


def global_row_number(df: DataFrame, order_cols: list[str], name: str = "seq") -> DataFrame:
    ranged = (df.orderBy(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _LOW_BITS)
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + local + 1).drop("_pid", "_mid", "_off")


def chunk_numbers(df: DataFrame, seq_col: str, size: int, name: str = "batch_no") -> DataFrame:
    """Chunk id of consecutive rows: ``ceil(seq / size)``."""
    return df.withColumn(name, F.ceil(F.col(seq_col) / F.lit(size)).cast("bigint"))


def value_ranks(rows: DataFrame, group_col: str, *value_cols: str) -> DataFrame:
    """Per distinct value of a group (never null): its rows `n`, the group's rows with smaller values `below`, and all its rows `total`.

    Rows are counted by value first, so a hot value is one row of the range sort.
    """
    order = [group_col, *value_cols]
    counts = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.orderBy(*order).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    before = lambda n, w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranged.groupBy("_pid").agg(F.sum("n").alias("_n")).select("_pid", before("_n", Window.orderBy("_pid")).alias("_off"))
    groups = ranged.groupBy(group_col).agg(F.sum("n").alias("total")).select(  # a row per group
        group_col, "total", before("total", Window.orderBy(group_col)).alias("_start"))
    smaller = before("n", Window.partitionBy("_pid").orderBy(*order))
    out = ranged.withColumn("below", smaller).join(F.broadcast(offsets), "_pid").join(F.broadcast(groups), group_col)
    return out.withColumn("below", F.col("_off") + F.col("below") - F.col("_start")).drop("_pid", "_off", "_start")
