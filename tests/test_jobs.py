"""End-to-end: ingest -> staging stream -> daily run -> forecast, with Parquet standing in for Kafka."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbar import jobs
from tickbar.operators import bars as B
from tickbar.operators.framing import frame_quotes
from tickbar.sources.fixtures import FRAME_SCHEMAS, raw_v, symbols_v
from tickbar.streaming import staging as ST

SMOKE = "/root/testdata/sf0.001"


def test_end_to_end(spark, tmp_dir):
    topic, staged, ckpt, bars = (f"{tmp_dir}/{n}" for n in ("topic", "staged", "ckpt", "bars"))
    raw = raw_v(spark, SMOKE)
    rejects = jobs.run_ingest(raw, 1, FRAME_SCHEMAS, "parquet", path=topic, trade_time=F.col("fetched_at"))
    assert rejects.count() > 0
    jobs.run_staging(spark, "parquet", None, staged, ckpt, FRAME_SCHEMAS, source_path=topic, available_now=True)
    staged_rows = ST.read_staged(spark, staged, FRAME_SCHEMAS)
    n_good = spark.read.parquet(topic).count()
    assert staged_rows.count() == n_good
    day = staged_rows.select(F.make_date("year", "month", "day").alias("d")).agg(F.max("d")).collect()[0][0]
    missing = jobs.run_daily(spark, staged, symbols_v(spark, SMOKE), bars, day.isoformat(), FRAME_SCHEMAS)
    out = B.read_bars(spark, bars).collect()
    assert out and {r["trade_date"] for r in out} == {day}
    assert "ZZZ" in {r["symbol"] for r in missing.collect()}
    # re-running the same day replaces its bars
    jobs.run_daily(spark, staged, symbols_v(spark, SMOKE), bars, day.isoformat(), FRAME_SCHEMAS)
    again = B.read_bars(spark, bars)
    assert again.count() == len(out)
    assert len(jobs.preview(again, ["symbol"], 2).collect()) == min(2, len(out))
    assert isinstance(day, dt.date)


def test_snapshots_of_one_time_are_told_apart_by_numbers(spark, tmp_dir):
    schema = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("trade_time", T.TimestampType(), False),
                           *[T.StructField(c, T.DoubleType()) for c in ("open_price", "max_price", "min_price", "close_price", "traded_quantity")]])
    rows = [(k, "S", dt.datetime(2024, 1, 5, 10), 1.0, 2.0, 0.5, close, 10.0) for k, close in (("9:1", 9.0), ("10:1", 10.0), ("10:0", 8.0))]
    quotes = spark.createDataFrame(rows, T.StructType([T.StructField("k", T.StringType()), *schema.fields]))
    frames = frame_quotes(quotes.withColumn("schema_id", F.lit(1)), {1: schema}, key=F.col("k"))
    ST.stage_batch(frames, 0, f"{tmp_dir}/staged", {1: schema})
    symbols = spark.createDataFrame([("S", "s"), ("Z", "z")], "symbol string, tb string")
    missing = jobs.run_daily(spark, f"{tmp_dir}/staged", symbols, f"{tmp_dir}/bars", "2024-01-05", {1: schema})
    assert [r["close"] for r in B.read_bars(spark, f"{tmp_dir}/bars").collect()] == [10.0]  # as text 9:1 would be the last
    assert [r["symbol"] for r in missing.collect()] == ["Z"]


def test_forecast_job(spark):
    from tickbar.sources.fixtures import bars_v

    res = jobs.run_forecast(bars_v(spark, "/root/testdata/sf0.01"))
    assert res["ar5"].count() == res["lag_ols"].count() > 0
    assert res["comparison"].where("rank = 1").count() == 5
