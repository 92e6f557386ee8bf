"""Quote snapshots -> daily bars, and the bar table's maintenance.

All per-(symbol, day) selections are grouped ``max_by`` aggregates: Spark
combines them map-side before the shuffle, so a symbol holding a third of all
snapshots still sends one partial row per task, and no sort or per-symbol
driver loop is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BAR_COLUMNS, BAR_SCHEMA
from ..session import drop_path, scratch_path
from ..sources.snapshots import Conflict, SnapshotTable

SNAPSHOT_ORDER = ("trade_time", "msg_seq")


def _order_key(order: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def with_trade_date(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("trade_date", F.to_date("trade_time"))


def for_day(quotes: DataFrame, as_of) -> DataFrame:
    """Restrict to one session day by a range on ``trade_time`` (pushed to the scan); on a
    table with year / month / day partition columns also by these, which prunes."""
    d = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of
    day = quotes.where((F.col("trade_time") >= d.cast("timestamp")) & (F.col("trade_time") < F.date_add(d, 1).cast("timestamp")))
    if {"year", "month", "day"} <= set(quotes.columns):
        day = day.where((F.col("year") == F.year(d)) & (F.col("month") == F.month(d)) & (F.col("day") == F.dayofmonth(d)))
    return day


def latest_quote(quotes: DataFrame, order: tuple[str, ...] = SNAPSHOT_ORDER) -> DataFrame:
    """The last snapshot per (symbol, trade_date): arg-max by time, then the tie-break column."""
    fields = [c for c in quotes.columns if c not in ("symbol",)]
    q = with_trade_date(quotes)
    latest = q.groupBy("symbol", "trade_date").agg(
        F.max_by(F.struct(*[F.col(c) for c in fields]), _order_key(order)).alias("_s"))
    return latest.select("symbol", "trade_date", *[F.col(f"_s.{c}").alias(c) for c in fields])


def last_snapshot_bars(quotes: DataFrame, order: tuple[str, ...] = SNAPSHOT_ORDER) -> DataFrame:
    """One bar per symbol and day from the day's last snapshot, with the order columns of that snapshot."""
    q = with_trade_date(quotes)
    snap = F.struct(
        F.col("open_price").alias("open"), F.col("max_price").alias("high"), F.col("min_price").alias("low"),
        F.col("close_price").alias("close"), F.col("traded_quantity").alias("volume"), *[F.col(c) for c in order])
    agg = q.groupBy("symbol", "trade_date").agg(F.max_by(snap, _order_key(order)).alias("_b"))
    return agg.select("symbol", "trade_date", "_b.open", "_b.high", "_b.low", "_b.close",
                      F.col("_b.volume").try_cast("bigint").alias("volume"), *[F.col(f"_b.{c}").alias(c) for c in order])


def daily_bars(quotes: DataFrame, symbols: DataFrame | None = None, as_of=None,
               order: tuple[str, ...] = SNAPSHOT_ORDER) -> DataFrame:
    """One OHLCV bar per symbol and day from the day's last snapshot.

    ``symbols`` restricts to the symbol dimension.  The restriction is a pure
    filter, so it is applied AFTER the grouped arg-max: the snapshots are
    combined map-side and shuffled on (symbol, day) with no join in front, and
    the semi-join then runs on the bars (one row per symbol and day).  Joining
    first would let the aggregate reuse a shuffle on ``symbol`` alone and put
    a hot symbol into one task.  ``as_of`` restricts to one day, as the
    scheduled run does (a partition predicate on a staged table).
    """
    bars = last_snapshot_bars(quotes if as_of is None else for_day(quotes, as_of), order).select(*BAR_COLUMNS)
    if symbols is not None:
        bars = bars.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return bars


def symbols_missing(symbols: DataFrame, quotes: DataFrame, as_of=None) -> DataFrame:
    """Symbols of the dimension with no snapshot (on ``as_of`` when given)."""
    q = quotes if as_of is None else for_day(quotes, as_of)
    # distinct first: a partial aggregate per task, so a hot symbol is never shuffled row by row.
    # Left join + null test rather than LEFT ANTI: an anti join is pushed through a union on the
    # dimension side, which would replicate the whole quote plan once per union branch.
    present = q.select("symbol").distinct().withColumn("_present", F.lit(True))
    return symbols.join(present, "symbol", "left").where(F.col("_present").isNull()).drop("_present")


def normalise_history(hist: DataFrame, symbol: Column | str = "symbol") -> DataFrame:
    """Historical layout ``index, Open, Max, Min, Close, Vol, Date`` -> canonical bars (by name)."""
    return hist.select(
        (F.col(symbol) if isinstance(symbol, str) else symbol).alias("symbol"),
        F.to_date("Date").alias("trade_date"), F.col("Open").alias("open"), F.col("Max").alias("high"),
        F.col("Min").alias("low"), F.col("Close").alias("close"), F.col("Vol").cast("bigint").alias("volume"))


def normalise_daily(daily: DataFrame, symbol: Column | str = "symbol") -> DataFrame:
    """Daily layout ``index, Date, Open, Close, Max, Min, Vol(text)`` -> canonical bars (by name).
    Text volumes go through an exact decimal, not a double."""
    return daily.select(
        (F.col(symbol) if isinstance(symbol, str) else symbol).alias("symbol"),
        F.col("Date").cast("date").alias("trade_date"), F.col("Open").alias("open"), F.col("Max").alias("high"),
        F.col("Min").alias("low"), F.col("Close").alias("close"),
        F.col("Vol").try_cast("decimal(38,6)").try_cast("bigint").alias("volume"))


def history_union(historical: DataFrame, daily: DataFrame) -> DataFrame:
    """UNION ALL of both sources, then one row per (symbol, trade_date).  Where both have
    the day, each column takes the daily source's value unless that is null."""
    both = (historical.select(*BAR_COLUMNS).withColumn("_src", F.lit(0))
            .unionByName(daily.select(*BAR_COLUMNS).withColumn("_src", F.lit(1))))
    vals = [c for c in BAR_COLUMNS if c not in ("symbol", "trade_date")]
    return both.groupBy("symbol", "trade_date").agg(
        *[F.max_by(c, F.struct(F.col(c).isNotNull(), F.col("_src"))).alias(c) for c in vals])


def to_history_layout(bars: DataFrame) -> DataFrame:
    """Canonical bars -> historical dump layout (``index`` 0 = newest per symbol)."""
    from pyspark.sql import Window

    w = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    return bars.select(
        "symbol", (F.row_number().over(w) - 1).cast("bigint").alias("index"),
        F.col("open").alias("Open"), F.col("high").alias("Max"), F.col("low").alias("Min"),
        F.col("close").alias("Close"), F.col("volume").alias("Vol"),
        F.col("trade_date").cast("timestamp_ntz").alias("Date"))


def to_daily_layout(bars: DataFrame) -> DataFrame:
    """Canonical bars -> daily dump layout; every appended row keeps index 0."""
    return bars.select(
        "symbol", F.lit(0).cast("bigint").alias("index"), F.col("trade_date").alias("Date"),
        F.col("open").alias("Open"), F.col("close").alias("Close"), F.col("high").alias("Max"),
        F.col("low").alias("Min"), F.col("volume").cast("string").alias("Vol"))


def bar_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ["trade_date"])


def read_bars(spark: SparkSession, path: str, dates: list | None = None, extra: list[T.StructField] | None = None) -> DataFrame:
    """The bar table (of some dates only; None among them: bars without a date), with ``extra`` stored columns."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*BAR_SCHEMA.fields, *(extra or [])]])
    table = bar_table(spark, path)
    return table.read(schema) if dates is None else table.read_dates(schema, "trade_date", dates)


def write_bars(bars: DataFrame, path: str, order: tuple[str, ...] = (), attempts: int = 5) -> None:
    """Upsert on (symbol, trade_date) into the bar table, whose partitions are the dates.

    Only the touched dates are read (they are literal partition predicates) and written anew;
    the manifest then names the new folders, so readers see all of the upsert or nothing, and a killed run
    changes nothing.  A bar replaces the stored one of its symbol and date, all other rows of the date stay;
    null is a date (and a symbol) like any other.  With ``order``, the columns of that name are stored
    too and the row with the larger value wins, so late or redelivered snapshots never replace newer ones.
    Where another writer changes the same dates meanwhile, the merge starts anew.
    Rows are sorted by symbol inside a date, so Parquet's min/max statistics serve per-symbol reads.
    """
    spark = bars.sparkSession
    keys = ["symbol", "trade_date"]
    cols = [*BAR_COLUMNS, *order]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in bars.select(*cols).schema.fields])
    table = bar_table(spark, path)
    landed = scratch_path(spark, "bars_landed")  # the input is used twice
    try:
        bars.select(*cols).write.parquet(landed)
        new = spark.read.schema(schema).parquet(landed)
        dates = [r[0] for r in new.select("trade_date").distinct().collect()]  # as many as calendar days
        texts = {None if d is None else d.isoformat() for d in dates}
        for attempt in range(attempts):
            base = table.manifest()
            old = table.read_dates(schema, "trade_date", dates, base)
            if order:
                rest = [c for c in cols if c not in keys]
                merged = old.unionByName(new).groupBy(*keys).agg(
                    F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_b")).select(
                    *keys, *[F.col(f"_b.{c}").alias(c) for c in rest])
            else:
                fresh = new.select(*[F.col(k).alias(f"_{k}") for k in keys])
                same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
                merged = old.join(fresh, same, "left_anti").unionByName(new)
            merged = merged.select(*cols).hint("rebalance", "trade_date").sortWithinPartitions("trade_date", "symbol")
            try:
                table.replace(merged, base, lambda v: v["trade_date"] in texts, alone=True)
                return
            except Conflict:
                if attempt + 1 == attempts:
                    raise
    finally:
        drop_path(spark, landed)


def bars_quality(bars: DataFrame) -> DataFrame:
    """Per symbol: bars whose high/low do not bracket open and close, and zero volume."""
    return bars.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.count(F.when(F.col("high") < F.greatest("open", "close"), 1)).alias("n_high_below_body"),
        F.count(F.when(F.col("low") > F.least("open", "close"), 1)).alias("n_low_above_body"),
        F.count(F.when(F.col("volume") == 0, 1)).alias("n_zero_volume"),
        F.count(F.when(F.col("volume").isNull(), 1)).alias("n_null_volume"),
    )


__all__ = ["latest_quote", "daily_bars", "symbols_missing", "history_union", "normalise_history",
           "normalise_daily", "to_history_layout", "to_daily_layout", "bar_table", "read_bars", "write_bars", "bars_quality"]
