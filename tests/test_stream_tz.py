"""Streamed day windows follow the session's local midnight."""

import datetime as dt

from pyspark.sql import functions as F

from tickbar.operators.bars import read_bars
from tickbar.streaming.bars_stream import start_daily_bars


def test_day_window_in_session_zone(spark, tmp_dir):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")  # UTC+7
    try:
        rows = [("ABC", "2024-01-02 03:00:00", 1, 10.0, 11.0, 9.0, 10.5, 5.0),   # 2024-01-01 20:00 UTC
                ("ABC", "2024-01-02 15:00:00", 2, 10.0, 12.0, 9.0, 11.5, 9.0),
                ("ABC", "2024-01-04 10:00:00", 3, 1.0, 1.0, 1.0, 1.0, 1.0)]    # advances the watermark
        df = spark.createDataFrame(rows, "symbol string, t string, msg_seq long, open_price double, "
                                         "max_price double, min_price double, close_price double, "
                                         "traded_quantity double")
        df = df.withColumn("trade_time", F.to_timestamp("t")).drop("t")
        src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
        df.write.parquet(src)
        stream = spark.readStream.schema(df.schema).parquet(src)
        start_daily_bars(stream, out, ckpt, available_now=True).awaitTermination()
        got = {r["trade_date"]: r for r in read_bars(spark, out).collect()}
        assert set(got) == {dt.date(2024, 1, 2), dt.date(2024, 1, 4)}
        assert got[dt.date(2024, 1, 2)]["close"] == 11.5 and got[dt.date(2024, 1, 2)]["volume"] == 9
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
