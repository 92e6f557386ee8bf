"""Connector option builders and the Avro writer schema (no broker or database needed)."""

import datetime as dt
import json
import uuid

from pyspark.sql import types as T

from tickbar.operators.framing import avro_schema_json, decode_by_schema, frame_quotes, struct_from_avro
from tickbar.operators.quotes import stamp
from tickbar.schemas import QUOTE_SCHEMA
from tickbar.sources import files as FS


def test_kafka_and_jdbc_options():
    src = FS.kafka_source_options("broker:9092", "stock", minPartitions=1)
    assert src == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "stock", "startingOffsets": "latest",
                   "failOnDataLoss": "false", "minPartitions": "1"}
    assert FS.kafka_sink_options("broker:9092", "stock") == {"kafka.bootstrap.servers": "broker:9092", "topic": "stock"}
    j = FS.jdbc_options("jdbc:postgresql://db/stock", "symbols", user="u", password="p", numPartitions=4)
    assert j["dbtable"] == "symbols" and j["numPartitions"] == "4" and j["user"] == "u"


def test_relation_by_format(spark, tmp_dir):
    spark.createDataFrame([("A", "a", 1)], "symbol string, tb string, extra int").write.parquet(f"{tmp_dir}/s")
    assert [tuple(r) for r in FS.read_symbols(spark, path=f"{tmp_dir}/s").collect()] == [("A", "a")]


def test_defaults_of_publishing(spark):
    rows = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "symbol string, schema_id int, last_price double")
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("last_price", T.DoubleType())])
    keys = [r["key"] for r in frame_quotes(rows, {1: schema}).collect()]
    assert len({str(uuid.UUID(k)) for k in keys}) == 2  # random keys unless one is given
    start = dt.datetime.now()
    times = {r["trade_time"] for r in stamp(rows).collect()}
    assert len(times) == 1 and abs((times.pop() - start).total_seconds()) < 3600 * 24  # one fetch time for all


def test_avro_text_stands_for_a_struct(spark):
    text = avro_schema_json(QUOTE_SCHEMA)
    body = b'{"symbol":"S","exchange_name":"HNX","trade_time":"2024-01-02T03:04:05.000000Z","last_price":2.5}'
    raw = spark.createDataFrame([("k", bytes([0, 0, 0, 0, 7]) + body)], "key string, value binary")
    r = decode_by_schema(raw, {7: text}).collect()[0]
    assert r["reason"] is None and r["symbol"] == "S" and r["last_price"] == 2.5


def test_avro_writer_schema():
    doc = json.loads(avro_schema_json(QUOTE_SCHEMA))
    assert doc["type"] == "record" and len(doc["fields"]) == 30
    f = {x["name"]: x["type"] for x in doc["fields"]}
    assert f["symbol"] == "string" and f["exchange_name"] == "string"  # required: no union, no branch byte
    assert f["trade_time"] == {"type": "long", "logicalType": "timestamp-micros"}
    assert f["last_price"] == ["null", "double"]
    assert struct_from_avro(avro_schema_json(QUOTE_SCHEMA)) == QUOTE_SCHEMA
    extra = T.StructType(list(QUOTE_SCHEMA.fields) + [T.StructField("lot_size", T.DoubleType())])
    assert len(json.loads(avro_schema_json(extra))["fields"]) == 31
