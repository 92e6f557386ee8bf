"""Continuous daily bars and at-least-once dedup on a quote stream.

Both keep their result as a table that every micro-batch merges into, so the order and the
cut of the micro-batches don't matter and no row is ever late: bars hold the order key of
their snapshot and the larger one wins; dedup looks up the keys already stored for the
days that the batch touches.  The days go into the plan as literal partition predicates, so a
batch reads its own days, however long the table's history.  A replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.bars import SNAPSHOT_ORDER, last_snapshot_bars, write_bars
from ..session import drop_path, scratch_path
from ..sources.snapshots import SnapshotTable
from .staging import writer_of


def _start(stream: DataFrame, merge, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_daily_bars(quotes: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = SNAPSHOT_ORDER,
                     available_now: bool = False) -> StreamingQuery:
    """Keep the bar table at ``path`` equal to the batch bars of all quotes seen so far.

    Days are those of the session's time zone.  Only dates that a batch touches are read and rewritten.
    """
    return _start(quotes, lambda batch, _: write_bars(last_snapshot_bars(batch, order), path, order), checkpoint, available_now)


def dedup_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ["day"])


def _stored(schema: T.StructType) -> T.StructType:
    own = [T.StructField(f.name, f.dataType) for f in schema.fields if f.name != "day"]
    return T.StructType([*own, T.StructField("day", T.DateType())])


def read_dedup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored messages (``schema``: that of the stream) and their day."""
    return dedup_table(spark, path).read(_stored(schema))


def dedup_batch(batch: DataFrame, batch_id: int, path: str, key: str = "key", ts: str = "trade_time", writer: str = "dedup") -> None:
    """Append the batch's messages whose key and day aren't stored yet (redelivery keeps key and time).

    Messages without a key have no identity: all of them are stored.  A batch that ``writer`` has
    committed already is skipped.  One stream writes a table at a time.
    """
    spark, table = batch.sparkSession, dedup_table(batch.sparkSession, path)
    if table.has((writer, batch_id)):
        return
    landed = scratch_path(spark, "dedup_landed")  # read twice: for its days, and for its rows
    try:
        batch.withColumn("day", F.to_date(ts)).write.parquet(landed)
        dated = spark.read.schema(_stored(batch.schema)).parquet(landed)
        days = [r[0] for r in dated.select("day").distinct().collect()]  # as many as calendar days
        keyless, new = dated.where(F.col(key).isNull()), dated.where(F.col(key).isNotNull()).dropDuplicates([key, "day"])
        index = T.StructType([T.StructField(key, batch.schema[key].dataType), T.StructField("day", T.DateType())])
        stored = table.read_dates(index, "day", days).select(F.col(key).alias("__key"), F.col("day").alias("__day"))
        new = new.join(stored, (F.col(key) == F.col("__key")) & F.col("day").eqNullSafe(F.col("__day")), "left_anti")
        table.append(new.unionByName(keyless).hint("rebalance", "day"), (writer, batch_id))
    finally:
        drop_path(spark, landed)


def start_dedup(messages: DataFrame, path: str, checkpoint: str, key: str = "key", ts: str = "trade_time",
                available_now: bool = False) -> StreamingQuery:
    def merge(batch: DataFrame, i: int) -> None:
        dedup_batch(batch, i, path, key, ts, writer_of(batch.sparkSession, checkpoint))
    return _start(messages, merge, checkpoint, available_now)


def compact_dedup(spark: SparkSession, path: str, schema: T.StructType, key: str = "key") -> int:
    """Rewrite the days that many batches have added to, sorted by key; the stream may go on meanwhile."""
    return dedup_table(spark, path).compact(_stored(schema), lambda df: df.hint("rebalance", "day").sortWithinPartitions("day", key))
