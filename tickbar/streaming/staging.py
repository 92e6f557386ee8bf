"""Structured Streaming: framed messages -> staged, partitioned quote table.

Source format is a parameter: Kafka in production (``kafka_source_options``), a file
directory of ``(key, value)`` rows in tests.  Each micro-batch is decoded with the whole
schema catalogue in one plan and written once: good rows and rejects (with key, id, raw value and reason)
are told apart by the partition column ``route``, so a batch reads its source and decodes it once.
The table has a manifest (``sources.snapshots``): a batch appears whole, a replayed one is skipped,
a day's read lists that day's folders, and ``compact_staged`` may run between two batches.

The catalogue may be a table that every batch reads anew.  Messages whose schema id isn't in it are rejects of
the route ``unknown_schema``; when an id appears, they are decoded and move to the staged rows, in one commit.
The query has its own checkpoint location.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.bars import for_day
from ..operators.framing import FRAME_SCHEMA, as_avro, as_struct, decode_by_schema, partition_columns
from ..session import file_system, path_exists
from ..sources.files import clustered_for_write
from ..sources.snapshots import Manifest, SnapshotTable, values_of

Schemas = dict[int, T.StructType | str]
PARTITION_COLS = ["year", "month", "day"]
ROUTE, STAGED, UNKNOWN = "route", "staged", "unknown_schema"
TABLE_PARTITIONS = [ROUTE, *PARTITION_COLS]
CATALOGUE_SCHEMA = "schema_id int, schema string"


# ------------------------------------------------------------- catalogue ----
def register_schema(spark: SparkSession, path: str, schema_id: int, schema: T.StructType | str) -> None:
    """Add a writer schema (a registry's Avro text, or a struct) to the catalogue table."""
    spark.createDataFrame([(schema_id, as_avro(schema))], CATALOGUE_SCHEMA).coalesce(1).write.mode("append").json(path)


def read_catalogue(spark: SparkSession, path: str) -> Schemas:
    """The catalogue as it is now; a row per producer schema, so the driver holds it.  An id has one schema for ever."""
    if not path_exists(spark, path):
        return {}
    found: Schemas = {}
    for r in spark.read.schema(CATALOGUE_SCHEMA).json(path).collect():
        if found.setdefault(r["schema_id"], r["schema"]) != r["schema"]:
            raise ValueError(f"{path}: two schemas for id {r['schema_id']}")
    return found


def _catalogue(spark: SparkSession, schemas: Schemas | str) -> Schemas:
    return read_catalogue(spark, schemas) if isinstance(schemas, str) else schemas


# ----------------------------------------------------------------- table ----
def staged_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, TABLE_PARTITIONS)


def staged_schema(schemas: Schemas) -> T.StructType:
    """Read-back schema of the staged rows: union of writer schemas + partitions."""
    seen: dict[str, T.DataType] = {"key": T.StringType(), "schema_id": T.IntegerType()}
    for _, s in sorted(schemas.items()):
        for f in as_struct(s).fields:
            seen.setdefault(f.name, f.dataType)
    fields = [T.StructField(k, v) for k, v in seen.items()]
    fields += [T.StructField(c, T.IntegerType()) for c in PARTITION_COLS] + [T.StructField("batch", T.LongType())]
    return T.StructType(fields)


def _table_schema(schemas: Schemas) -> T.StructType:
    """All columns as they are stored (a month is the text 01)."""
    own = [T.StructField(f.name, T.StringType()) if f.name in PARTITION_COLS else f for f in staged_schema(schemas).fields]
    return T.StructType([*own, T.StructField("value", T.BinaryType()), T.StructField(ROUTE, T.StringType())])


def _routed(decoded: DataFrame) -> DataFrame:
    """Rows of the table: a good one under its day, a reject under its reason with the raw value."""
    good = F.col("reason").isNull()
    lacking = {"symbol": "string", "trade_time": "timestamp"}  # while the catalogue is empty
    dated = partition_columns(decoded.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items() if c not in decoded.columns}))
    return dated.withColumns({**{c: F.when(good, F.col(c)) for c in PARTITION_COLS}, "value": F.when(~good, F.col("value")),
                              ROUTE: F.coalesce("reason", F.lit(STAGED))}).drop("reason")


def _arranged(rows: DataFrame) -> DataFrame:
    return clustered_for_write(rows, TABLE_PARTITIONS).sortWithinPartitions(*TABLE_PARTITIONS, "symbol", "trade_time")


def read_staged(spark: SparkSession, path: str, schemas: Schemas | str, day: dt.date | str | None = None) -> DataFrame:
    """The staged rows, of one day if given (only its folders are listed)."""
    schema, table = staged_schema(_catalogue(spark, schemas)), staged_table(spark, path)
    if day is None:
        return table.read(schema, lambda v: v[ROUTE] == STAGED)
    return for_day(table.read(schema, lambda v: v[ROUTE] == STAGED and of_day(v, day)), str(day))


def of_day(values: dict[str, str | None], day: dt.date | str) -> bool:
    """A partition's values name this day."""
    want = dt.date.fromisoformat(str(day))
    return None not in (values["year"], values["month"], values["day"]) and \
        (int(values["year"]), int(values["month"]), int(values["day"])) == (want.year, want.month, want.day)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """key, schema_id, raw value, reason and batch of the messages that didn't decode."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("schema_id", T.IntegerType()),
                           T.StructField("value", T.BinaryType()), T.StructField("batch", T.LongType()), T.StructField(ROUTE, T.StringType())])
    rows = staged_table(spark, path).read(schema, lambda v: v[ROUTE] != STAGED)
    return rows.select("key", "schema_id", "value", F.col(ROUTE).alias("reason"), "batch")


# ---------------------------------------------------------------- stream ----
def stage_batch(batch: DataFrame, batch_id: int, sink_path: str, schemas: Schemas | str, codec: str = "json",
                writer: str = "staging") -> None:
    """Write one micro-batch of ``(key, value)`` rows to the table, after the replay of rejects whose schema has appeared."""
    spark, table = batch.sparkSession, staged_table(batch.sparkSession, sink_path)
    known = _catalogue(spark, schemas)
    if isinstance(schemas, str):
        replay_rejects(spark, sink_path, known, codec)
    if table.has((writer, batch_id)):
        return
    decoded = decode_by_schema(batch, known, codec).withColumn("batch", F.lit(batch_id).cast("bigint"))
    table.append(_arranged(_routed(decoded)), (writer, batch_id), _noted(table.manifest(), known))


def _noted(state: Manifest, known: Schemas) -> dict:
    return {"schema_ids": sorted({*state.notes.get("schema_ids", []), *known})}


def replay_rejects(spark: SparkSession, path: str, schemas: Schemas | str, codec: str = "json") -> bool:
    """Decode the rejects of unknown schemas again if the catalogue has ids that the table hasn't met.

    What decodes now moves to the staged rows, with its batch; what is broken gets its reason; the rest stays.  All in one
    commit, so a message is never in both places, nor in none.
    """
    known, table = _catalogue(spark, schemas), staged_table(spark, path)
    base = table.manifest()
    new = set(known) - set(base.notes.get("schema_ids", []))
    waiting = [p for p in base.folders if values_of(p)[ROUTE] == UNKNOWN]
    if not new or not waiting:
        return False
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType()),
                           T.StructField("batch", T.LongType())])
    frames = table.read(schema, lambda v: v[ROUTE] == UNKNOWN, base)
    decoded = decode_by_schema(frames, known, codec, keep=("key", "schema_id", "batch"))
    table.replace(_arranged(_routed(decoded)), base, lambda v: v[ROUTE] == UNKNOWN, notes=_noted(base, known))
    return True


def framed_stream(spark: SparkSession, fmt: str, options: dict | None = None, path: str | None = None) -> DataFrame:
    """Message stream: key (string) and value (the whole frame)."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(FRAME_SCHEMA)
    src = reader.load(path) if path else reader.load()
    return src.select(F.col("key").cast("string").alias("key"), "value")


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query with this checkpoint (a new checkpoint counts its batches anew)."""
    fs, at = file_system(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start_staging(stream: DataFrame, sink_path: str, checkpoint: str, schemas: Schemas | str, codec: str = "json",
                  available_now: bool = False) -> StreamingQuery:
    """``schemas``: a fixed catalogue, or the path of a catalogue table that every batch reads."""
    def stage(batch: DataFrame, batch_id: int) -> None:
        stage_batch(batch, batch_id, sink_path, schemas, codec, writer_of(batch.sparkSession, checkpoint))
    writer = stream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def compact_staged(spark: SparkSession, path: str, schemas: Schemas | str) -> int:
    """Rewrite the days that many batches have added to into one folder each, sorted by symbol; the number of these days.

    The stream may go on meanwhile, readers see the old folders or the new ones.
    """
    known, table = _catalogue(spark, schemas), staged_table(spark, path)
    met = table.manifest().notes.get("schema_ids", [])
    if not set(met) <= set(known):  # their columns would be lost
        raise ValueError(f"the catalogue lacks ids {sorted(set(met) - set(known))} of {path}")
    return table.compact(_table_schema(known), _arranged)
