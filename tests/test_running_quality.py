"""Chunked running aggregates equal the plain window; the bar-quality report."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickbar.operators import bars as B
from tickbar.operators.running import running_stats


def test_running_stats_equals_plain_window(spark):
    rng = random.Random(11)
    base = dt.datetime(2024, 1, 1, 9, 0, 0)
    rows = []
    for i in range(600):
        sym = "HOT" if rng.random() < 0.7 else rng.choice(["A", "B"])  # one symbol holds most rows
        t = base + dt.timedelta(days=rng.randint(0, 2), seconds=rng.randint(0, 40), microseconds=rng.randint(0, 3) * 1000)
        rows.append((sym, t, i, float(rng.randint(1, 50))))
    df = spark.createDataFrame(rows, "symbol string, trade_time timestamp, msg_seq long, value double") \
        .withColumn("_day", F.to_date("trade_time"))
    got = running_stats(df, ["symbol", "_day"], "trade_time", "msg_seq", "value")
    w = Window.partitionBy("symbol", "_day").orderBy("trade_time", "msg_seq") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("msg_seq", F.first("value").over(w).alias("f"), F.max("value").over(w).alias("mx"),
                     F.min("value").over(w).alias("mn"), F.count(F.lit(1)).over(w).alias("n"))
    g = {r["msg_seq"]: (r["run_first"], r["run_max"], r["run_min"], r["run_count"]) for r in got.collect()}
    e = {r["msg_seq"]: (r["f"], r["mx"], r["mn"], r["n"]) for r in want.collect()}
    assert g == e


def test_running_stats_keep_null_keys(spark):
    rows = [(None, dt.datetime(2024, 1, 1), 1, 2.0), (None, dt.datetime(2024, 1, 1), 2, 5.0), ("A", None, 3, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, trade_time timestamp, msg_seq long, value double")
    got = {r["msg_seq"]: (r["run_max"], r["run_count"]) for r in running_stats(df, ["symbol"], "trade_time", "msg_seq", "value").collect()}
    assert got == {1: (2.0, 1), 2: (5.0, 2), 3: (1.0, 1)}


def test_bars_quality_flags(spark):
    rows = [("DHT", dt.date(2015, 1, 5), 10.0, 9.5, 9.0, 9.8, 100),    # Max below Open
            ("HAT", dt.date(2012, 3, 1), 10.0, 12.0, 10.5, 10.2, 50),  # Min above Open and Close
            ("HAT", dt.date(2012, 3, 2), 10.0, 12.0, 9.0, 11.0, 0),    # zero volume
            ("HAT", dt.date(2012, 3, 3), 10.0, 12.0, 9.0, 11.0, None)]
    bars = spark.createDataFrame(rows, "symbol string, trade_date date, open double, high double, low double, "
                                       "close double, volume long")
    q = {r["symbol"]: r for r in B.bars_quality(bars).collect()}
    assert q["DHT"]["n_high_below_body"] == 1 and q["DHT"]["n_low_above_body"] == 0
    assert q["HAT"]["n_low_above_body"] == 1 and q["HAT"]["n_zero_volume"] == 1 and q["HAT"]["n_null_volume"] == 1
