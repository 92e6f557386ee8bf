"""Job entry points: the scheduled runs of the quote system as Spark jobs.

* ``run_ingest``   landed feed responses -> typed quotes -> framed messages -> sink
* ``run_staging``  framed message stream -> staged, partitioned quote table (runs until stopped)
* ``run_daily``    one day of staged quotes -> one bar per symbol -> idempotent upsert
* ``run_forecast`` bars -> per-symbol forecasts and their RMSE tables

Formats and options are parameters: Kafka / JDBC in production, Parquet in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import bars as B
from .operators import forecast as FC
from .operators import quotes as Q
from .operators.framing import frame_quotes
from .streaming import staging as ST


def publish_frames(frames: DataFrame, fmt: str, options: dict | None = None, path: str | None = None) -> None:
    """Write framed ``(key, value)`` rows to a sink (``kafka`` with a topic option in production)."""
    w = frames.select("key", "value").write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode("append")
    w.save(path) if path else w.save()


def preview(df: DataFrame, order_cols: list[str], n: int = 20) -> DataFrame:
    """First rows in an explicit order (a preview never relies on storage order)."""
    return df.orderBy(*order_cols).limit(n)


def run_ingest(raw: DataFrame, schema_id: int, schemas: dict[int, T.StructType], fmt: str,
               options: dict | None = None, path: str | None = None, trade_time=None) -> DataFrame:
    """Parse landed responses, frame the valid quotes with ``schema_id``, publish them;
    returns the rejects (a table, not a failed run)."""
    items = Q.feed_explode(raw, keep=tuple(c for c in raw.columns if c not in ("body", "status")))
    good, bad = Q.quotes_from_content(items, trade_time=trade_time, keep=("response_id", "item_pos"))
    # a key derived from the landed item, not a random one: a retried task re-emits the
    # same keys, so redelivery stays visible to the dedup-by-key downstream
    key = F.concat_ws(":", F.col("response_id").cast("string"), F.col("item_pos").cast("string"))
    frames = frame_quotes(good.withColumn("schema_id", F.lit(schema_id)), schemas, key=key)
    publish_frames(frames, fmt, options, path)
    return bad


def run_staging(spark: SparkSession, fmt: str, source_options: dict | None, sink_path: str, checkpoint: str,
                schemas: ST.Schemas | str, codec: str = "json", source_path: str | None = None,
                available_now: bool = False) -> None:
    """``schemas``: a fixed catalogue, or the path of a catalogue table that grows while the job runs."""
    stream = ST.framed_stream(spark, fmt, source_options, source_path)
    q = ST.start_staging(stream, sink_path, checkpoint, schemas, codec, available_now)
    q.awaitTermination()


def run_daily(spark: SparkSession, staged_path: str, symbols: DataFrame, bars_path: str, as_of: str,
              schemas: ST.Schemas | str) -> DataFrame:
    """Bars of ``as_of`` from the staged table (only that day's folders are read), upserted into ``bars_path``;
    returns the symbols that had no data that day.

    Of snapshots with the same time the one of the later batch counts, then the one with the larger key; the parts of a
    key ``response:item`` are compared as numbers.
    """
    parts = F.split("key", ":")
    numbers = F.transform(parts, lambda p: F.coalesce(p.try_cast("bigint"), F.lit(-1)))
    quotes = ST.read_staged(spark, staged_path, schemas, as_of).withColumns({"key_numbers": numbers, "msg_seq": F.col("key")})
    B.write_bars(B.daily_bars(quotes, symbols, order=("trade_time", "batch", "key_numbers", "msg_seq")), bars_path)
    return B.symbols_missing(symbols, quotes)


def run_forecast(bars: DataFrame) -> dict[str, DataFrame]:
    both = FC.predictions(bars)
    return {**{m: FC.finish(FC.of_model(both, m)) for m in FC.MODELS}, "comparison": FC.model_comparison(FC.rmse(both)),
            "last": FC.forecast_last(both)}
