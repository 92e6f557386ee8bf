"""Streaming staging equals the batch decode; restart adds nothing; sequence numbers."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbar.operators import framing as FR
from tickbar.operators.sequence import chunk_numbers, global_row_number
from tickbar.operators import bars as B
from tickbar.sources.fixtures import BAD_FRAMES, FRAME_SCHEMAS, bad_frames_v, frames_v, quotes_v
from tickbar.streaming import bars_stream as BS
from tickbar.streaming import staging as ST

SMOKE = "/root/testdata/sf0.001"


def test_stream_stage_matches_batch_and_is_idempotent(spark, tmp_dir):
    topic, sink, ckpt = f"{tmp_dir}/topic", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    frames_v(spark, SMOKE).write.parquet(topic)
    for _ in range(2):  # the second run resumes from the checkpoint and adds nothing
        q = ST.start_staging(ST.framed_stream(spark, "parquet", path=topic), sink, ckpt, FRAME_SCHEMAS,
                             available_now=True)
        q.awaitTermination()
    got = ST.read_staged(spark, sink, FRAME_SCHEMAS).drop("batch", "year", "month", "day")
    batch = FR.decode_by_schema(spark.read.parquet(topic), FRAME_SCHEMAS).where("reason IS NULL").drop("value", "reason")
    assert got.count() == batch.count() == 1000
    assert got.select(*sorted(batch.columns)).exceptAll(batch.select(*sorted(batch.columns))).count() == 0
    assert ST.read_rejects(spark, sink).count() == 0


def test_damaged_frames_do_not_stop_the_stream(spark, tmp_dir):
    topic, sink, ckpt = f"{tmp_dir}/topic", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    frames = bad_frames_v(spark, SMOKE)
    frames.write.parquet(topic)
    ST.start_staging(ST.framed_stream(spark, "parquet", path=topic), sink, ckpt, FRAME_SCHEMAS,
                     available_now=True).awaitTermination()
    assert ST.read_staged(spark, sink, FRAME_SCHEMAS).count() == 1000
    bad = ST.read_rejects(spark, sink)
    assert set(r["reason"] for r in bad.select("reason").distinct().collect()) == set(BAD_FRAMES)
    raw = frames.where("key LIKE 'bad-%'")
    assert bad.select("key", "value").exceptAll(raw).count() == 0 and bad.count() == raw.count()  # replayable


def _shuffled_stream(spark, path, df, files=4):
    for i in range(files):  # out of order by days: every file holds rows of every day
        df.where(F.pmod(F.xxhash64("msg_seq"), F.lit(files)) == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streamed_bars_over_shuffled_batches_equal_batch_bars(spark, tmp_dir):
    quotes = quotes_v(spark, "/root/testdata/sf0.01")
    out = f"{tmp_dir}/bars"
    q = BS.start_daily_bars(_shuffled_stream(spark, f"{tmp_dir}/src", quotes), out, f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination()
    assert len(q.recentProgress) >= 4
    want = B.daily_bars(quotes)
    got = B.read_bars(spark, out).select(*want.columns)
    assert got.count() == want.count() == 150
    assert got.exceptAll(want).count() == 0


def test_streamed_dedup_over_shuffled_batches_keeps_every_key_once(spark, tmp_dir):
    quotes = quotes_v(spark, SMOKE).select(F.col("msg_seq").cast("string").alias("key"), "symbol", "trade_time", "msg_seq")
    twice = quotes.unionAll(quotes.where("msg_seq % 3 = 0")).withColumn("msg_seq", F.monotonically_increasing_id()).checkpoint()
    out = f"{tmp_dir}/dedup"
    for _ in range(2):  # the second run resumes and adds nothing
        stream = _shuffled_stream(spark, f"{tmp_dir}/src", twice) if _ == 0 else \
            spark.readStream.schema(twice.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src")
        BS.start_dedup(stream.drop("msg_seq"), out, f"{tmp_dir}/ckpt", available_now=True).awaitTermination()
    schema = twice.drop("msg_seq").schema
    got = BS.read_dedup(spark, out, schema)
    assert got.count() == got.select("key").distinct().count() == quotes.count()
    first = spark.read.parquet(f"{tmp_dir}/src").drop("msg_seq").limit(50)  # redelivered to another writer
    BS.dedup_batch(first, 0, out)
    assert BS.read_dedup(spark, out, schema).groupBy("key").count().where("count > 1").count() == 0
    folders = sum(map(len, BS.dedup_table(spark, out).manifest().folders.values()))
    assert BS.compact_dedup(spark, out, schema) > 0
    state = BS.dedup_table(spark, out).manifest()
    assert len(state.folders) == sum(map(len, state.folders.values())) < folders
    assert BS.read_dedup(spark, out, schema).count() == quotes.count()


def test_a_dedup_batch_reads_only_its_days(spark, tmp_dir):
    def batch(*days):
        return spark.createDataFrame([(f"{d}{i}", f"2024-01-{d:02d} 10:00:00", i) for d in days for i in range(3)], "key string, t string, n int") \
            .select("key", F.to_timestamp("t").alias("trade_time"), "n")
    path, read = f"{tmp_dir}/days", []
    table = BS.SnapshotTable
    for i, days in enumerate([(1, 2, 3), (2, 4), (2,)]):
        was = table.read_dates

        def spy(self, schema, column, dates, state=None, was=was):
            df = was(self, schema, column, dates, state)
            read.append((sorted(map(str, dates)), len(df.inputFiles()), df._jdf.queryExecution().executedPlan().toString()))
            return df
        table.read_dates = spy
        try:
            BS.dedup_batch(batch(*days), i, path)
        finally:
            table.read_dates = was
    assert [r[0] for r in read] == [["2024-01-01", "2024-01-02", "2024-01-03"], ["2024-01-02", "2024-01-04"], ["2024-01-02"]]
    assert read[0][1] == 0 and "PartitionFilters: [" in read[2][2] and "2024-01-02" in read[2][2].split("PartitionFilters: [")[1].split("]")[0]
    stored = {p.split("=")[1]: len(f) for p, f in BS.dedup_table(spark, path).manifest().folders.items()}
    assert stored == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1, "2024-01-04": 1}
    assert BS.read_dedup(spark, path, batch(1).schema).count() == 12


def test_dedup_stores_every_message_without_a_key(spark, tmp_dir):
    rows = [("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-01 10:00:00", 1), ("b", None, 2), (None, "2024-01-01 10:00:00", 3),
            (None, "2024-01-01 10:00:00", 4), (None, "2024-01-02 10:00:00", 5)]
    batch = spark.createDataFrame(rows, "key string, t string, n int").select("key", F.to_timestamp("t").alias("trade_time"), "n")
    for i in (0, 1, 1):  # the last one is a replay
        BS.dedup_batch(batch, i, f"{tmp_dir}/keyless")
    got = sorted((r["key"] or "", r["n"]) for r in BS.read_dedup(spark, f"{tmp_dir}/keyless", batch.schema).collect())
    assert got == [("", 3), ("", 3), ("", 4), ("", 4), ("", 5), ("", 5), ("a", 1), ("b", 2)]


def test_global_row_number(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    seq = global_row_number(df, ["v"]).collect()
    assert sorted(r["seq"] for r in seq) == list(range(1, 1001))
    assert all(r["seq"] == r["v"] + 1 for r in seq)
    chunks = chunk_numbers(global_row_number(df, ["v"]), "seq", 10).groupBy("batch_no").count().collect()
    assert len(chunks) == 100 and all(r["count"] == 10 for r in chunks)


def test_global_row_number_hot_key(spark):
    # 80% of rows share one leading key value; the tie-break column makes the order total
    df = spark.range(0, 2000, 1, 6).select(
        F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), F.col("id").alias("tie"))
    rows = global_row_number(df, ["k", "tie"]).collect()
    assert sorted(r["seq"] for r in rows) == list(range(1, 2001))
    ordered = sorted(rows, key=lambda r: r["seq"])
    keys = [(r["k"], r["tie"]) for r in ordered]
    assert keys == sorted(keys)


def _frame(schema_id, **fields):
    return bytes([0]) + schema_id.to_bytes(4, "big") + json.dumps(fields).encode()


def _files(spark, topic, *rows):
    spark.createDataFrame(rows, "key string, value binary").coalesce(1).write.mode("append").parquet(topic)


S1 = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("trade_time", T.TimestampType()), T.StructField("x", T.DoubleType())])
S2 = T.StructType([*S1.fields, T.StructField("y", T.DoubleType())])
WHEN = "2024-01-05T10:00:00.000000Z"


def test_schemas_that_appear_while_the_stream_runs(spark, tmp_dir):
    topic, sink, ckpt, known = (f"{tmp_dir}/{n}" for n in ("topic", "sink", "ckpt", "known"))

    def run():
        q = ST.start_staging(ST.framed_stream(spark, "parquet", path=topic), sink, ckpt, known, available_now=True)
        q.awaitTermination()
        return {r["key"]: (r["y"] if "y" in r else None, r["batch"]) for r in map(lambda r: r.asDict(), ST.read_staged(spark, sink, known).collect())}, \
            {r["key"]: (r["reason"], r["batch"]) for r in ST.read_rejects(spark, sink).collect()}
    _files(spark, topic, ("a", _frame(1, symbol="S", trade_time=WHEN, x=1.0)), ("b", _frame(2, symbol="S", trade_time=WHEN, y=5.0)))
    assert run() == ({}, {"a": ("unknown_schema", 0), "b": ("unknown_schema", 0)})  # the catalogue is empty
    ST.register_schema(spark, known, 1, S1)
    _files(spark, topic, ("c", _frame(2, symbol="S", trade_time=WHEN, y=6.0)), ("d", _frame(2, nothing=1)), ("e", b"\1\2"), ("f", _frame(3, x=1)))
    staged, bad = run()
    assert staged == {"a": (None, 0)} and bad == {"b": ("unknown_schema", 0), "c": ("unknown_schema", 1), "d": ("unknown_schema", 1),
                                                  "e": ("short_frame", 1), "f": ("unknown_schema", 1)}
    ST.register_schema(spark, known, 2, S2)
    _files(spark, topic, ("g", _frame(2, symbol="T", trade_time=WHEN, y=7.0)))
    for _ in range(2):  # the second run adds nothing
        staged, bad = run()
        assert staged == {"a": (None, 0), "b": (5.0, 0), "c": (6.0, 1), "g": (7.0, 2)}
        assert bad == {"d": ("missing_field", 1), "e": ("short_frame", 1), "f": ("unknown_schema", 1)}
    assert not ST.replay_rejects(spark, sink, known)
    assert ST.read_staged(spark, sink, known, "2024-01-05").count() == 4 and ST.read_staged(spark, sink, known, "2024-01-06").count() == 0
    with pytest.raises(ValueError, match="lacks ids"):
        ST.compact_staged(spark, sink, {1: S1})
    with pytest.raises(ValueError, match="two schemas"):
        ST.register_schema(spark, known, 2, S1)
        ST.read_catalogue(spark, known)


def test_a_batch_reads_its_source_once(spark, tmp_dir):
    topic, sink = f"{tmp_dir}/topic", f"{tmp_dir}/sink"
    bad_frames_v(spark, SMOKE).write.parquet(topic)
    n = spark.read.parquet(topic).count()
    q = ST.start_staging(ST.framed_stream(spark, "parquet", path=topic), sink, f"{tmp_dir}/ckpt", FRAME_SCHEMAS, available_now=True)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == n  # a second scan would count them twice
    assert ST.read_staged(spark, sink, FRAME_SCHEMAS).count() + ST.read_rejects(spark, sink).count() == n


def test_compaction_between_batches_and_replayed_batches(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    frames = frames_v(spark, SMOKE)
    want = FR.decode_by_schema(frames, FRAME_SCHEMAS).select("key", "symbol", "last_price")
    for i in range(3):
        ST.stage_batch(frames.where(F.pmod(F.xxhash64("key"), F.lit(3)) == i), i, sink, FRAME_SCHEMAS)
        if i == 1:
            assert ST.compact_staged(spark, sink, FRAME_SCHEMAS) > 0
        ST.stage_batch(frames.where(F.pmod(F.xxhash64("key"), F.lit(3)) == i), i, sink, FRAME_SCHEMAS)  # a replay
    for _ in range(2):
        got = ST.read_staged(spark, sink, FRAME_SCHEMAS).select("key", "symbol", "last_price")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        ST.compact_staged(spark, sink, FRAME_SCHEMAS)
    assert set(map(len, ST.staged_table(spark, sink).manifest().folders.values())) == {1}
    day = ST.read_staged(spark, sink, FRAME_SCHEMAS).agg(F.max(F.to_date("trade_time"))).collect()[0][0]
    one = ST.read_staged(spark, sink, FRAME_SCHEMAS, day)
    assert all(f"/year={day.year}/month={day.month:02d}/day={day.day:02d}/" in f for f in one.inputFiles())
