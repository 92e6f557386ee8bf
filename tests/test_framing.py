"""Framing round trip and decode-by-schema-id (FIXTURES F3)."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbar.operators import framing as FR

S1 = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("last_price", T.DoubleType())])
S2 = T.StructType(list(S1.fields) + [T.StructField("lot_size", T.DoubleType())])


def _frames(spark, ids):
    df = spark.createDataFrame([(str(i), sid, "S", float(i), 100.0) for i, sid in enumerate(ids)],
                               "k string, schema_id int, symbol string, last_price double, lot_size double")
    return FR.frame_quotes(df, {1: S1, 2: S2, 258: S1}, key=F.col("k"))


def test_header_and_round_trip(spark):
    u = FR.unframe(_frames(spark, [1, 2, 258])).orderBy("key").collect()
    assert [r["schema_id"] for r in u] == [1, 2, 258]
    assert all(r["magic"] == 0 for r in u)
    assert bytes(u[2]["value"][:5]).hex() == "0000000102"


def test_decode_by_schema_merges_columns(spark):
    d = FR.decode_by_schema(_frames(spark, [1, 2, 1, 2]), {1: S1, 2: S2}).orderBy("key").collect()
    assert [r["lot_size"] for r in d] == [None, 100.0, None, 100.0]
    assert [r["last_price"] for r in d] == [0.0, 1.0, 2.0, 3.0]


def test_unknown_id(spark):
    f = _frames(spark, [1, 258])
    d = {r["key"]: r["reason"] for r in FR.decode_by_schema(f, {1: S1}).collect()}
    assert d == {"0": None, "1": "unknown_schema"}
    with pytest.raises(Exception, match="no writer schema registered for id 258"):
        FR.decode_by_schema(f, {1: S1}, unknown="raise").collect()


def test_damaged_frames_are_told_apart(spark):
    need = T.StructType([T.StructField("symbol", T.StringType(), False), *S1.fields[1:], T.StructField("trade_time", T.TimestampType())])
    head = bytes([0, 0, 0, 0, 1])
    rows = [("ok", head + b'{"symbol":"S","last_price":1.5}'), ("none", None), ("short", b"\0\0"), ("header", head[:4]),
            ("empty", head), ("magic", b"\1" + head[1:] + b'{"symbol":"S"}'), ("json", head + b"{not json"), ("text", head + b"not json"),
            ("type", head + b'{"symbol":"S","last_price":"abc"}'), ("time", head + b'{"symbol":"S","trade_time":"soon"}'),
            ("null", head + b'{"last_price":1.0}'), ("blank", head + b'{"symbol":""}'), ("utf8", head + b"\xff\xfe{")]
    raw = spark.createDataFrame(rows, "key string, value binary")
    d = {r["key"]: r for r in FR.decode_by_schema(raw, {1: need}).collect()}
    assert {k: r["reason"] for k, r in d.items()} == {
        "ok": None, "none": "short_frame", "short": "short_frame", "header": "short_frame", "empty": "bad_body",
        "magic": "bad_magic", "json": "bad_body", "text": "bad_body", "type": "bad_body", "time": "bad_body",
        "null": "missing_field", "blank": "missing_field", "utf8": "bad_body"}
    assert all(d[k]["value"] == v for k, v in rows)
    assert FR.unframe(raw).where("key = 'empty'").collect()[0]["payload"] == bytearray()


def test_partition_columns_padded(spark):
    df = spark.createDataFrame([("2024-03-05 09:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("trade_time"))
    r = FR.partition_columns(df).collect()[0]
    assert (r["year"], r["month"], r["day"]) == ("2024", "03", "05")


def test_unframe_keeps_the_whole_payload(spark):
    from tickbar.sources.fixtures import frames_v

    frames = frames_v(spark, "/root/testdata/sf0.001").collect()
    got = {r["key"]: (r["n"], r["md5"]) for r in FR.unframe(spark.createDataFrame(frames)).select(
        "key", F.length("payload").alias("n"), F.md5("payload").alias("md5")).collect()}
    assert got == {r["key"]: (len(r["value"]) - 5, hashlib.md5(bytes(r["value"])[5:]).hexdigest()) for r in frames}
