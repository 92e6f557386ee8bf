"""Fixture views built from the driver's tables.

The quote feed, the framed stream and the bar history are not in the driver
data, so they are derived from ``events`` and ``orders`` with DataFrame
expressions; the oracle SQL builds the same views in DuckDB.

* ``quotes_v``  - one quote snapshot per event: symbol = event_type, price =
  value, day-to-date open / max / min / count carried on every snapshot.
* ``bars_v``    - one daily bar per order priority and order date.
* ``symbols_v`` - every symbol of both tables plus ``ZZZ`` which has no data.
* ``raw_v``     - one landed feed response per event (JSON body with an
  ``obj`` array of pipe-delimited strings, including the edge cases).
* ``frames_v``  - ``quotes_v`` framed as registry messages, schema id 1 or 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.framing import frame_quotes
from ..operators.running import running_stats
from ..schemas import EXCHANGE_NAME, KEY_AREAS, QUOTE_NUMERIC_FIELDS, quote_schema_for
from .tables import read_table

NO_DATA_SYMBOL = ("ZZZ", "zzz")
# Schema id 2 carries one field more than id 1.
EXTRA_FIELDS = {2: ["lot_size"]}
FRAME_SCHEMAS = {1: quote_schema_for(1, EXTRA_FIELDS), 2: quote_schema_for(2, EXTRA_FIELDS)}


def key_area(letter: Column) -> Column:
    """Key-area bucket of a ticker's first letter (the feed is polled per bucket)."""
    expr = None
    for area in KEY_AREAS:
        cond = F.instr(F.lit(area), letter) > 0
        expr = F.when(cond, F.lit(area)) if expr is None else expr.when(cond, F.lit(area))
    return expr


def quotes_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    base = ev.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("trade_time"),
        F.col("event_id").alias("msg_seq"),
        F.to_date("ts").alias("_day"),
        "user_id", "value",
    )
    run = running_stats(base, ["symbol", "_day"], "trade_time", "msg_seq", "value")
    derived = {
        "last_price": F.col("value"),
        "close_price": F.col("value"),
        "last_qtty": F.col("user_id").cast("double"),
        "open_price": F.col("run_first"),
        "max_price": F.col("run_max"),
        "min_price": F.col("run_min"),
        "traded_quantity": F.col("run_count").cast("double"),
    }
    cols = [F.col("symbol"), F.lit(EXCHANGE_NAME).alias("exchange_name"), F.col("trade_time")]
    cols += [derived.get(f, F.lit(None).cast("double")).alias(f) for f in QUOTE_NUMERIC_FIELDS]
    return run.select(*cols, F.col("msg_seq"))


def bars_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return (
        o.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("trade_date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def symbol_table_name(symbol: Column) -> Column:
    return F.lower(F.regexp_replace(symbol, "[^A-Za-z0-9]", ""))


def symbols_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"]).select(F.col("o_orderpriority").alias("symbol"))
    e = read_table(spark, sf_dir, "events", ["event_type"]).select(F.col("event_type").alias("symbol"))
    extra = spark.createDataFrame([NO_DATA_SYMBOL[:1]], "symbol string")
    syms = o.union(e).union(extra).distinct()
    return syms.select("symbol", symbol_table_name(F.col("symbol")).alias("tb"))


def raw_payload(sym: Column, value: Column, event_id: Column, user_id: Column) -> Column:
    """``|S|S_<FIELD>*<value>*<fmt>|...`` with a duplicate key, a comma number,
    an empty value, a metadata token, an occasional bad number (also with a type suffix, or
    with the ticker in it) and a trailing pipe."""
    ceil_val = (F.when(event_id % 53 == 0, F.lit("n/a")).when(event_id % 59 == 0, F.lit("12.5f"))
                .when(event_id % 61 == 0, F.lit("12d")).when(event_id % 67 == 0, F.concat(sym, F.lit("_5")))
                .otherwise(user_id.cast("string")))
    return F.concat(
        F.lit("|"), sym, F.lit("|"),
        sym, F.lit("_LAST_PRICE*0*f|"),
        sym, F.lit("_REF_PRICE*"), value.cast("string"), F.lit("*f|"),
        sym, F.lit("_TRADED_QUANTITY*"), F.format_number(event_id, 0), F.lit("*n|"),
        sym, F.lit("_OPEN_PRICE**f|"),
        F.lit("LOT"), user_id.cast("string"), F.lit("|"),
        sym, F.lit("_CEIL_PRICE*"), ceil_val, F.lit("*f|"),
        sym, F.lit("_LAST_PRICE*"), value.cast("string"), F.lit("*f|"),
    )


def raw_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    eid, sym = F.col("event_id"), F.col("event_type")
    payload = raw_payload(sym, F.col("value"), eid, F.col("user_id"))
    obj = (
        F.when(eid % 97 == 0, F.lit(None).cast("array<string>"))
        .when(eid % 89 == 0, F.array().cast("array<string>"))
        .when(eid % 41 == 0, F.array(payload, F.lit("nothing")))
        .when(eid % 43 == 0, F.array(payload, F.concat(F.lit("x"), payload)))
        .when(eid % 47 == 0, F.array(payload, F.lit("||")))
        .otherwise(F.array(payload))
    )
    return ev.select(
        eid.alias("response_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("LIS")).otherwise(F.lit("UPC")).alias("exchange_code"),
        key_area(F.upper(F.substring(sym, 1, 1))).alias("key_area"),
        F.when(sym == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.to_json(F.struct(obj.alias("obj"))).alias("body"),
    )


def frame_schema_id(msg_seq: Column) -> Column:
    return F.when(msg_seq % 2 == 0, F.lit(1)).otherwise(F.lit(2))


BAD_FRAMES = ("short_frame", "bad_magic", "unknown_schema", "bad_body", "missing_field")


def bad_frames_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``frames_v`` plus a damaged copy of every frame, damaged in a way that follows its key."""
    good = frames_v(spark, sf_dir)
    kind = F.col("key").cast("bigint") % 6
    text = F.expr("substring(value, 6)").cast("string")
    body = (F.when(kind == 3, F.lit("not json"))
            .when(kind == 4, F.regexp_replace(text, '"last_price":[^,}]*', '"last_price":"abc"'))
            .when(kind == 5, F.regexp_replace(text, '"symbol":"[^"]*"', '"symbol":""')).otherwise(text))
    head = (F.when(kind == 1, F.unhex(F.lit("0100000001"))).when(kind == 2, F.unhex(F.lit("0000000063")))
            .otherwise(F.substring("value", 1, 5)))
    value = F.when(kind == 0, F.unhex(F.lit("0000"))).otherwise(F.concat(head, F.encode(body, "UTF-8")))
    return good.unionByName(good.select(F.concat(F.lit("bad-"), F.col("key")).alias("key"), value.alias("value")))


def frames_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes_v(spark, sf_dir).withColumn("lot_size", F.lit(100.0))
    q = q.withColumn("schema_id", frame_schema_id(F.col("msg_seq")))
    return frame_quotes(q, FRAME_SCHEMAS, key=F.col("msg_seq").cast("string"))


__all__ = ["quotes_v", "bars_v", "symbols_v", "raw_v", "frames_v", "bad_frames_v", "FRAME_SCHEMAS", "EXTRA_FIELDS",
           "key_area", "NO_DATA_SYMBOL"]
