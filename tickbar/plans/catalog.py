"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Each reads the driver tables (through the fixture
views) in full; queries that write put their output under the session's
checkpoint directory and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bars as B
from ..operators import features as FE
from ..operators import forecast as FC
from ..operators import framing as FR
from ..operators import history as H
from ..operators import quotes as Q
from ..operators.sequence import chunk_numbers, global_row_number
from ..schemas import BAR_COLUMNS, DAILY_TSV_SCHEMA, HISTORY_TSV_SCHEMA, PUBLISH_BATCH_SIZE, QUOTE_SCHEMA, SYMBOL_SCHEMA
from ..session import scratch_path
from ..sources import dump as DU
from ..sources import files as FS
from ..sources.fixtures import FRAME_SCHEMAS, NO_DATA_SYMBOL, bad_frames_v, bars_v, frames_v, quotes_v, raw_v, symbols_v
from ..sources.snapshots import SnapshotTable
from ..streaming import bars_stream as BS
from ..streaming import staging as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries (the operators take them as arguments).
RANGE_START, RANGE_END = "1996-01-01", "1997-12-31"
SCAN_DAY, SCAN_SYMBOL = "2024-01-15", "click"
AS_OF, ONE_SYMBOL = "1997-02-28", "1-URGENT"
SYMBOL_BUCKETS = 16
TICK = 0.01  # the order prices are quoted in cents
DUMP_FILES = 4
HISTORY_CUT_END, DAILY_CUT_START = "2000-12-31", "2000-12-01"
PASSTHROUGH_SQL = ("SELECT symbol, count(*) AS n_bars, min(trade_date) AS first_date, max(trade_date) AS last_date, "
                   "CAST(sum(volume) AS BIGINT) AS total_volume FROM bars GROUP BY symbol")


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- bars ----
@register("daily_bars")
def q_daily_bars(spark, sf):
    return B.daily_bars(quotes_v(spark, sf), symbols_v(spark, sf))


@register("latest_quote")
def q_latest_quote(spark, sf):
    return B.latest_quote(quotes_v(spark, sf))


@register("symbols_missing_today")
def q_symbols_missing(spark, sf):
    return B.symbols_missing(symbols_v(spark, sf), quotes_v(spark, sf), SCAN_DAY)


QUOTE_TABLE = T.StructType([*[T.StructField(f.name, f.dataType) for f in QUOTE_SCHEMA.fields], T.StructField("msg_seq", T.LongType()),
                            *[T.StructField(c, T.IntegerType()) for c in ST.PARTITION_COLS]])


def _staged_day(spark, sf, day) -> DataFrame:
    """One day of a staged quote table: its folders come from the table's manifest."""
    table = SnapshotTable(spark, scratch_path(spark, "quotes_staged"), ST.PARTITION_COLS)
    q = FS.clustered_for_write(FR.partition_columns(quotes_v(spark, sf)), ST.PARTITION_COLS)
    table.append(q.sortWithinPartitions(*ST.PARTITION_COLS, "symbol", "trade_time"))
    return B.for_day(table.read(QUOTE_TABLE, lambda v: ST.of_day(v, day)), day)


_SCAN_COLUMNS = ["symbol", "trade_time", "open_price", "max_price", "min_price", "close_price", "traded_quantity",
                 "msg_seq", "year", "month", "day"]


@register("quotes_partition_scan")
def q_partition_scan(spark, sf):
    return _staged_day(spark, sf, SCAN_DAY).select(*_SCAN_COLUMNS)


@register("quotes_symbol_day_scan")
def q_symbol_day_scan(spark, sf):
    return _staged_day(spark, sf, SCAN_DAY).where(F.col("symbol") == SCAN_SYMBOL).select(*_SCAN_COLUMNS)


@register("daily_bars_upsert")
def q_daily_bars_upsert(spark, sf):
    path = scratch_path(spark, "bars_table")
    bars = B.daily_bars(quotes_v(spark, sf), symbols_v(spark, sf))
    B.write_bars(bars, path)
    some = B.read_bars(spark, path).where(F.crc32("symbol") % 2 == 0)
    B.write_bars(some, path)  # a re-run with some of the symbols keeps the others' bars
    return B.read_bars(spark, path)


@register("bars_quality")
def q_bars_quality(spark, sf):
    return B.bars_quality(bars_v(spark, sf))


def _history_files(spark, sf) -> tuple[str, str]:
    bars = bars_v(spark, sf)
    hist_path, daily_path = scratch_path(spark, "history_tsv"), scratch_path(spark, "daily_tsv")
    hist = B.to_history_layout(bars.where(F.col("trade_date") <= F.lit(HISTORY_CUT_END).cast("date")))
    daily = B.to_daily_layout(bars.where(F.col("trade_date") >= F.lit(DAILY_CUT_START).cast("date")))
    FS.write_tsv(FS.clustered_for_write(hist, ["symbol"]), hist_path, ["symbol"])
    FS.write_tsv(FS.clustered_for_write(daily, ["symbol"]), daily_path, ["symbol"])
    return hist_path, daily_path


@register("history_tsv_load")
def q_history_tsv_load(spark, sf):
    path = scratch_path(spark, "history_tsv")
    FS.write_tsv(B.to_history_layout(bars_v(spark, sf)), path, ["symbol"])
    return B.normalise_history(FS.read_history_tsv(spark, path))


@register("history_union")
def q_history_union(spark, sf):
    hist_path, daily_path = _history_files(spark, sf)
    hist = B.normalise_history(FS.read_history_tsv(spark, hist_path))
    daily = B.normalise_daily(FS.read_daily_tsv(spark, daily_path))
    return B.history_union(hist, daily)


def _dump_lines(spark, sf) -> DataFrame:
    """The bars as the text of a dump of two databases: a history and a daily table per symbol, and the symbol dimension."""
    bars, symbols = bars_v(spark, sf), symbols_v(spark, sf)
    tables = symbols.select(F.col("symbol").alias("sym"), "tb", F.pmod(F.xxhash64("symbol"), F.lit(DUMP_FILES)).alias("part"))

    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("\\N"))

    def section(database, rank, layout, columns, rows):
        listed = ", ".join(c if c.islower() else f'"{c}"' for c in columns)
        places = [F.lit(rank).alias("db"), F.col("tb").alias("name")]
        head = F.concat(F.lit('COPY public."'), "tb", F.lit(f'" ({listed}) FROM stdin;'))
        opened = tables.select("part", *places, F.lit(0).alias("step"), F.lit("").alias("row"), head.alias("line"))
        closed = tables.select("part", *places, F.lit(2).alias("step"), F.lit("").alias("row"), F.lit("\\.").alias("line"))
        body = layout(rows).join(tables, F.col("symbol") == F.col("sym")).select(
            "part", *places, F.lit(1).alias("step"), text("Date").alias("row"), F.concat_ws("\t", *[text(c) for c in columns]).alias("line"))
        start = tables.select("part").distinct().select("part", F.lit(rank).alias("db"), F.lit("").alias("name"), F.lit(0).alias("step"),
                                                        F.lit("").alias("row"), F.lit(f"\\connect {database}").alias("line"))
        return [start, opened, body, closed]
    hist = bars.where(F.col("trade_date") <= F.lit(HISTORY_CUT_END).cast("date"))
    daily = bars.where(F.col("trade_date") >= F.lit(DAILY_CUT_START).cast("date"))
    parts = [*section("historical", 1, B.to_history_layout, HISTORY_TSV_SCHEMA.names, hist),
             *section("stock", 2, B.to_daily_layout, DAILY_TSV_SCHEMA.names, daily)]
    last = [F.lit(0).cast("long").alias("part"), F.lit(3).alias("db"), F.lit("").alias("name")]
    dimension = symbols.select(*last, F.lit(1).alias("step"), F.col("symbol").alias("row"), F.concat_ws("\t", "symbol", "tb").alias("line"))
    head, end = (tables.where(F.col("sym") == NO_DATA_SYMBOL[0]).select(*last, F.lit(i).alias("step"), F.lit("").alias("row"), F.lit(x).alias("line"))
                 for i, x in ((0, "COPY public.symbols (symbol, tb) FROM stdin;"), (2, "\\.")))
    return reduce(DataFrame.unionByName, [*parts, head, dimension, end])


@register("dump_sections_load")
def q_dump_sections_load(spark, sf):
    """A dump with the sections of all tables in a few files: its rows by their own headers, symbols from its own dimension."""
    path = scratch_path(spark, "dump")
    _dump_lines(spark, sf).repartition(DUMP_FILES, "part").sortWithinPartitions("part", "db", "name", "step", "row").select("line").write.text(path)
    rows = DU.read_dump(spark, path)
    dimension = F.col("table_name") == "symbols"
    symbols = DU.typed(rows.where(dimension), SYMBOL_SCHEMA, keep=())
    hist = B.normalise_history(DU.typed(rows.where(~dimension & (F.col("database") == "historical")), HISTORY_TSV_SCHEMA), "table_name")
    daily = B.normalise_daily(DU.typed(rows.where(~dimension & (F.col("database") == "stock")), DAILY_TSV_SCHEMA), "table_name")
    both = hist.withColumn("database", F.lit("historical")).unionByName(daily.withColumn("database", F.lit("stock")))
    named = both.withColumnRenamed("symbol", "tb").join(symbols, "tb")
    return named.select("database", *BAR_COLUMNS)


# ------------------------------------------------------------- symbols ----
@register("symbols_scan")
def q_symbols_scan(spark, sf):
    table = scratch_path(spark, "symbols")
    FS.load_symbols(symbols_v(spark, sf), table)
    return FS.read_symbols(spark, path=table)


def _symbols_with_duplicate(spark, sf):
    dup = spark.createDataFrame([("ZZZ", "zzz_old")], "symbol string, tb string")
    return symbols_v(spark, sf).unionByName(dup)


@register("symbols_csv_load")
def q_symbols_csv_load(spark, sf):
    path = scratch_path(spark, "symbols_csv")
    FS.write_symbols_csv(_symbols_with_duplicate(spark, sf), path)
    table = scratch_path(spark, "symbols")
    FS.load_symbols(FS.read_symbols_csv(spark, path), table)
    return FS.read_symbols(spark, path=table)


@register("symbols_pk_audit")
def q_symbols_pk_audit(spark, sf):
    path = scratch_path(spark, "symbols_csv")
    FS.write_symbols_csv(_symbols_with_duplicate(spark, sf), path)
    return FS.symbols_pk_audit(FS.read_symbols_csv(spark, path))


# ------------------------------------------------------------- history ----
@register("history_for_symbol")
def q_history_for_symbol(spark, sf):
    return H.history_for_symbol(bars_v(spark, sf))


@register("history_one_symbol")
def q_history_one_symbol(spark, sf):
    return H.history_for_symbol(bars_v(spark, sf), [ONE_SYMBOL])


def _by_symbol(spark, sf) -> DataFrame:
    """The bars as a catalog table, bucketed by symbol."""
    path = scratch_path(spark, "bars_by_symbol")
    name = "bars_by_symbol_" + path.rsplit("-", 1)[-1]
    FS.write_by_symbol(bars_v(spark, sf), name, path, SYMBOL_BUCKETS)
    return spark.table(name)


@register("history_one_symbol_bucketed")
def q_history_one_symbol_bucketed(spark, sf):
    return H.history_for_symbol(_by_symbol(spark, sf), [ONE_SYMBOL])


@register("history_for_symbol_bucketed")
def q_history_for_symbol_bucketed(spark, sf):
    return H.history_for_symbol(_by_symbol(spark, sf))


@register("sql_passthrough")
def q_sql_passthrough(spark, sf):
    bars_v(spark, sf).createOrReplaceTempView("bars")
    return spark.sql(PASSTHROUGH_SQL)


@register("history_bounds")
def q_history_bounds(spark, sf):
    return H.history_bounds(bars_v(spark, sf))


@register("bars_date_range")
def q_bars_date_range(spark, sf):
    return H.date_range(bars_v(spark, sf), RANGE_START, RANGE_END)


def _preset(name, as_of=None):
    def fn(spark, sf):
        return H.preset_range(bars_v(spark, sf), name, as_of)
    return fn


for _p in H.PRESETS:
    register(f"bars_{_p}")(_preset(_p))
    register(f"bars_{_p}_as_of")(_preset(_p, AS_OF))


@register("kpi_latest")
def q_kpi_latest(spark, sf):
    return H.kpi_latest(bars_v(spark, sf))


@register("chart_volume")
def q_chart_volume(spark, sf):
    return H.chart_volume(bars_v(spark, sf))


@register("chart_candles")
def q_chart_candles(spark, sf):
    return H.chart_candles(bars_v(spark, sf))


@register("chart_volume_close")
def q_chart_volume_close(spark, sf):
    return H.chart_volume_close(bars_v(spark, sf))


@register("chart_prices_long")
def q_chart_prices_long(spark, sf):
    return H.chart_prices_long(bars_v(spark, sf))


@register("corr_matrix")
def q_corr_matrix(spark, sf):
    c = H.corr_matrix(bars_v(spark, sf))
    return c.withColumn("corr", F.round("corr", 6))


@register("corr_matrix_rounded")
def q_corr_matrix_rounded(spark, sf):
    return H.corr_matrix(bars_v(spark, sf), decimals=2)


def _range(spark, sf):
    return H.date_range(bars_v(spark, sf), RANGE_START, RANGE_END)


@register("chart_candles_range")
def q_chart_candles_range(spark, sf):
    return H.chart_candles(_range(spark, sf))


@register("chart_volume_range")
def q_chart_volume_range(spark, sf):
    return H.chart_volume(_range(spark, sf))


@register("chart_volume_close_range")
def q_chart_volume_close_range(spark, sf):
    return H.chart_volume_close(_range(spark, sf))


@register("chart_prices_long_range")
def q_chart_prices_long_range(spark, sf):
    return H.chart_prices_long(_range(spark, sf))


@register("corr_matrix_range")
def q_corr_matrix_range(spark, sf):
    return H.corr_matrix(_range(spark, sf)).withColumn("corr", F.round("corr", 6))


# ------------------------------------------------------------ features ----
@register("close_series")
def q_close_series(spark, sf):
    return FE.close_series(bars_v(spark, sf))


@register("train_valid_split")
def q_train_valid_split(spark, sf):
    return FE.train_valid_split(bars_v(spark, sf))


@register("minmax_scale")
def q_minmax_scale(spark, sf):
    s = FE.minmax_scale(FE.train_valid_split(bars_v(spark, sf)))
    return s.select("symbol", "trade_date", "close", "x_min", "x_max", "scaled")


@register("minmax_inverse")
def q_minmax_inverse(spark, sf):
    s = FE.minmax_inverse(FE.minmax_scale(FE.train_valid_split(bars_v(spark, sf))))
    return s.select("symbol", "trade_date", "close", "unscaled")


@register("lag_windows_train")
def q_lag_train(spark, sf):
    return FE.lag_windows(FE.minmax_scale(FE.train_valid_split(bars_v(spark, sf))), "train")


@register("lag_windows_valid")
def q_lag_valid(spark, sf):
    return FE.lag_windows(FE.minmax_scale(FE.train_valid_split(bars_v(spark, sf))), "valid")


@register("diff_series")
def q_diff_series(spark, sf):
    return FE.diff_series(bars_v(spark, sf))


# ------------------------------------------------------------ forecast ----
def _both(spark, sf, models=FC.MODELS):
    return FC.predictions(bars_v(spark, sf), models, tick=TICK)


@register("forecast_ar5_walkforward")
def q_forecast_ar5(spark, sf):
    return FC.finish(FC.of_model(_both(spark, sf, ("ar5",)), "ar5"))


@register("forecast_lag_ols")
def q_forecast_ols(spark, sf):
    return FC.finish(FC.of_model(_both(spark, sf, ("lag_ols",)), "lag_ols"))


@register("forecast_lag_mllib")
def q_forecast_mllib(spark, sf):
    return FC.finish(FC.lag_mllib(bars_v(spark, sf)))


@register("forecast_gbt")
def q_forecast_gbt(spark, sf):
    return FC.finish(FC.lag_gbt(bars_v(spark, sf)))


@register("model_comparison_gbt")
def q_model_comparison_gbt(spark, sf):
    """Linear models and the boosted trees, ranked by RMSE for each symbol."""
    trees = FC.rmse_of(FC.lag_gbt(bars_v(spark, sf)), "gbt")
    return FC.model_comparison(FC.rmse(_both(spark, sf)).unionByName(trees))


@register("rmse_ar5")
def q_rmse_ar5(spark, sf):
    return FC.rmse_table(FC.rmse(_both(spark, sf, ("ar5",)), ("ar5",)))


@register("rmse_lag_ols")
def q_rmse_ols(spark, sf):
    return FC.rmse_table(FC.rmse(_both(spark, sf, ("lag_ols",)), ("lag_ols",)))


@register("rmse_report")
def q_rmse_report(spark, sf):
    return FC.rmse_report(FC.rmse(_both(spark, sf)))


@register("model_comparison")
def q_model_comparison(spark, sf):
    return FC.model_comparison(FC.rmse(_both(spark, sf)))


@register("forecast_last")
def q_forecast_last(spark, sf):
    return FC.forecast_last(_both(spark, sf))


def _chart_frame(spark, sf, model):
    pred = FC.of_model(_both(spark, sf, (model,)), model)
    return FC.forecast_chart_frame(bars_v(spark, sf), pred, model)


@register("forecast_chart_frame")
def q_forecast_chart_frame(spark, sf):
    return _chart_frame(spark, sf, "ar5")


@register("forecast_chart_frame_ols")
def q_forecast_chart_frame_ols(spark, sf):
    return _chart_frame(spark, sf, "lag_ols")


# ---------------------------------------------------------------- feed ----
@register("feed_requests")
def q_feed_requests(spark, sf):
    raw = raw_v(spark, sf)
    counts = raw.groupBy("exchange_code", "key_area").agg(
        F.count(F.lit(1)).alias("n_responses"), F.count(F.when(F.col("status") == 200, 1)).alias("n_ok"))
    grid = Q.feed_request_grid(spark)
    out = grid.join(counts, ["exchange_code", "key_area"], "left")
    return out.select("request_seq", "exchange_code", "key_area",
                      F.coalesce("n_responses", F.lit(0)).alias("n_responses"),
                      F.coalesce("n_ok", F.lit(0)).alias("n_ok"))


@register("feed_explode")
def q_feed_explode(spark, sf):
    return Q.feed_explode(raw_v(spark, sf))


@register("feed_union")
def q_feed_union(spark, sf):
    path = scratch_path(spark, "raw_landed")
    FS.clustered_for_write(raw_v(spark, sf), ["exchange_code", "key_area"]) \
        .write.mode("overwrite").partitionBy("exchange_code", "key_area").parquet(path)
    # what is landed is the union of all requests; a response without a bucket is part of it
    return Q.feed_explode(spark.read.parquet(path), keep=("exchange_code", "key_area", "response_id"))


def _items(spark, sf):
    return Q.feed_explode(raw_v(spark, sf), keep=("response_id", "fetched_at"))


@register("quotes_parsed")
def q_quotes_parsed(spark, sf):
    p = Q.parse_payload(_items(spark, sf)).where(F.col("has_pipe") & F.col("first_empty"))
    e = p.select("response_id", "item_pos", F.col("ticker").alias("symbol"),
                 F.inline(Q.parsed_entries(F.col("fields"))))
    return e.withColumnsRenamed({"k": "field", "v": "value"})


@register("quotes_metadata")
def q_quotes_metadata(spark, sf):
    p = Q.parse_payload(_items(spark, sf)).where(F.col("has_pipe") & F.col("first_empty"))
    return p.select("response_id", "item_pos", F.posexplode("metadata").alias("meta_pos", "token"))


def _typed(spark, sf):
    return Q.quotes_from_content(_items(spark, sf), trade_time=F.col("fetched_at"), keep=("response_id", "item_pos"))


@register("quotes_typed")
def q_quotes_typed(spark, sf):
    return _typed(spark, sf)[0]


@register("quotes_stamp")
def q_quotes_stamp(spark, sf):
    return _typed(spark, sf)[0].select("response_id", "item_pos", "symbol", "exchange_name", "trade_time")


@register("quotes_rejects")
def q_quotes_rejects(spark, sf):
    return _typed(spark, sf)[1]


@register("publish_batches")
def q_publish_batches(spark, sf):
    path, keys = scratch_path(spark, "publish_keys"), ["trade_time", "response_id", "item_pos"]
    _typed(spark, sf)[0].select(*keys).write.parquet(path)  # parsed once; the sort's sample reads the keys only
    seq = global_row_number(spark.read.parquet(path), keys)
    return chunk_numbers(seq, "seq", PUBLISH_BATCH_SIZE).groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


# ------------------------------------------------------------- framing ----
@register("frame_quotes")
def q_frame_quotes(spark, sf):
    body = F.expr("substring(value, 6)")
    return frames_v(spark, sf).select("key", F.hex(F.substring("value", 1, 5)).alias("header_hex"),
                                      F.length("value").alias("n_bytes"), F.md5(body).alias("body_md5"))


@register("unframe_quotes")
def q_unframe_quotes(spark, sf):
    u = FR.unframe(frames_v(spark, sf))
    body = F.decode("payload", "UTF-8")
    return u.select("key", "magic", "schema_id", F.get_json_object(body, "$.symbol").alias("symbol"),
                    F.get_json_object(body, "$.last_price").cast("double").alias("last_price"),
                    F.length("payload").alias("n_bytes"), F.md5("payload").alias("payload_md5"))


@register("distinct_schema_ids")
def q_distinct_schema_ids(spark, sf):
    return FR.distinct_schema_ids(FR.unframe(frames_v(spark, sf)))


@register("stage_by_schema")
def q_stage_by_schema(spark, sf):
    d = FR.decode_by_schema(frames_v(spark, sf), FRAME_SCHEMAS, unknown="raise")
    return FR.partition_columns(d.where("reason IS NULL").drop("value", "reason"))


@register("stage_rejects")
def q_stage_rejects(spark, sf):
    """Damaged frames after a staging run: the reject table with the raw values."""
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic_bad", "staged_bad", "staging_bad_ckpt"))
    bad_frames_v(spark, sf).write.mode("overwrite").parquet(topic)
    ST.start_staging(ST.framed_stream(spark, "parquet", path=topic), sink, ckpt, FRAME_SCHEMAS,
                     available_now=True).awaitTermination()
    return ST.read_rejects(spark, sink).select("key", "reason", F.length("value").alias("n_bytes"),
                                               F.hex(F.substring("value", 1, 5)).alias("header_hex"))


@register("partition_columns")
def q_partition_columns(spark, sf):
    return FR.partition_columns(quotes_v(spark, sf)).select("symbol", "msg_seq", "trade_time", "year", "month", "day")


# ----------------------------------------------------------- streaming ----
@register("stream_stage")
def q_stream_stage(spark, sf):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "staged", "staging_ckpt"))
    frames_v(spark, sf).write.mode("overwrite").parquet(topic)
    stream = ST.framed_stream(spark, "parquet", path=topic)
    q = ST.start_staging(stream, sink, ckpt, FRAME_SCHEMAS, available_now=True)
    q.awaitTermination()
    return ST.read_staged(spark, sink, FRAME_SCHEMAS).drop("batch")


def _stage_in_runs(spark, sf, between) -> DataFrame:
    """The frames staged in two runs of one stream with a growing catalogue; `between` gets the paths of table and catalogue."""
    topic, sink, ckpt, known = (scratch_path(spark, n) for n in ("topic", "staged", "staging_ckpt", "schemas"))
    frames = frames_v(spark, sf)
    first, *rest = sorted(FRAME_SCHEMAS)
    ST.register_schema(spark, known, first, FRAME_SCHEMAS[first])
    for i in range(2):
        frames.where(F.pmod(F.xxhash64("key"), F.lit(2)) == i).write.mode("append").parquet(topic)
        ST.start_staging(ST.framed_stream(spark, "parquet", path=topic), sink, ckpt, known, available_now=True).awaitTermination()
        if i == 0:
            for schema_id in rest:
                ST.register_schema(spark, known, schema_id, FRAME_SCHEMAS[schema_id])
            between(sink, known)
    return ST.read_staged(spark, sink, known).drop("batch")


@register("stream_replay")
def q_stream_replay(spark, sf):
    """Schema ids that appear while the stream runs: their rejects move to the staged rows with the next batch."""
    return _stage_in_runs(spark, sf, lambda sink, known: None)


@register("staged_compaction")
def q_staged_compaction(spark, sf):
    """The staged table compacted between two batches of its stream and after them."""
    def compact(sink, known):
        ST.replay_rejects(spark, sink, known)
        ST.compact_staged(spark, sink, known)
        compacted.append((sink, known))
    compacted: list[tuple[str, str]] = []
    _stage_in_runs(spark, sf, compact)
    sink, known = compacted[0]
    ST.compact_staged(spark, sink, known)
    return ST.read_staged(spark, sink, known).drop("batch")


def _quote_stream(spark, sf, copies: int = 1) -> DataFrame:
    """The quotes as a stream of shuffled files, one per micro-batch (so batches are out of order)."""
    path = scratch_path(spark, "quotes_src")
    q = quotes_v(spark, sf).withColumn("key", F.col("msg_seq").cast("string"))
    for _ in range(copies):
        q.repartition(STREAM_FILES, F.xxhash64("msg_seq")).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", STREAM_FILES * copies // 4).parquet(path)


STREAM_FILES = 4


@register("stream_daily_bars")
def q_stream_daily_bars(spark, sf):
    out, ckpt = scratch_path(spark, "bars_out"), scratch_path(spark, "bars_ckpt")
    BS.start_daily_bars(_quote_stream(spark, sf), out, ckpt, available_now=True).awaitTermination()
    return B.read_bars(spark, out)


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    out, ckpt = scratch_path(spark, "dedup_out"), scratch_path(spark, "dd_ckpt")
    messages = _quote_stream(spark, sf, copies=2).select("key", "symbol", "trade_time", "last_price")
    BS.start_dedup(messages, out, ckpt, available_now=True).awaitTermination()
    return BS.read_dedup(spark, out, messages.schema).drop("day")


__all__ = ["QUERIES"]
