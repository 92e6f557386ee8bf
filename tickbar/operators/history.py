"""History questions over the bar table: ranges, presets, KPIs, chart frames,
correlation.

Bars are unique on (symbol, trade_date), so a per-symbol window holds at most
one row per calendar day; it is bounded by the calendar, not by data volume.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICE_COLUMNS = ["open", "high", "low", "close"]
CORR_COLUMNS = ["open", "close", "high", "low", "volume"]
PRESETS = {"last_week": ("weeks", 1), "last_month": ("months", 1), "last_year": ("months", 12),
           "last_5_years": ("months", 60)}


def history_for_symbol(bars: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Bars of the given symbols (all when None) relabelled like the serving frame:
    ``id`` (0 = newest), Open, High, Low, Close, Volume, Date."""
    b = bars if symbols is None else bars.where(F.col("symbol").isin(symbols))
    w = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    return b.select(
        "symbol", (F.row_number().over(w) - 1).cast("bigint").alias("id"),
        F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.col("close").alias("Close"), F.col("volume").alias("Volume"), F.col("trade_date").alias("Date"))


def history_bounds(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"),
        F.count(F.lit(1)).alias("n_bars"))


def date_range(bars: DataFrame, start, end) -> DataFrame:
    """Inclusive [start, end] on trade_date (pushed to the scan as a range filter)."""
    return bars.where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def preset_start(as_of: Column, preset: str) -> Column:
    unit, n = PRESETS[preset]
    return F.date_sub(as_of, 7 * n) if unit == "weeks" else F.add_months(as_of, -n)


def preset_range(bars: DataFrame, preset: str, as_of=None) -> DataFrame:
    """Last week / month / year / 5 years ending at ``as_of`` (calendar-aware,
    end-of-month clamped).  Without ``as_of`` each symbol anchors on its own
    latest bar."""
    if as_of is not None:
        end = F.lit(as_of).cast("date")
        return bars.where(F.col("trade_date").between(preset_start(end, preset), end))
    # one partially aggregated row per symbol, joined back: no sort and no shuffle of the whole history
    anchors = bars.groupBy(F.col("symbol").alias("_sym")).agg(F.max("trade_date").alias("_as_of"))
    anchored = bars.join(anchors, F.col("symbol").eqNullSafe(F.col("_sym")))
    return anchored.where(F.col("trade_date").between(preset_start(F.col("_as_of"), preset), F.col("_as_of"))) \
        .drop("_as_of", "_sym")


def kpi_latest(bars: DataFrame) -> DataFrame:
    """Newest bar per symbol with the change from the previous bar for each price
    (NULL when the symbol has one bar)."""
    # one sort per symbol: newest first, the previous bar is the next row
    w = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    prev = {f"prev_{c}": F.lead(c).over(w) for c in PRICE_COLUMNS}
    staged = bars.select("symbol", "trade_date", *PRICE_COLUMNS, *[e.alias(k) for k, e in prev.items()],
                         F.row_number().over(w).alias("_rn"))
    return staged.where(F.col("_rn") == 1).select(
        "symbol", "trade_date", *PRICE_COLUMNS,
        *[(F.col(c) - F.col(f"prev_{c}")).alias(f"{c}_delta") for c in PRICE_COLUMNS])


def chart_volume(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", F.col("trade_date").alias("Date"), F.col("volume").alias("Volume"))


def chart_candles(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", F.col("trade_date").alias("Date"), F.col("open").alias("Open"),
                       F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"))


def chart_volume_close(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", F.col("trade_date").alias("Date"), F.col("volume").alias("Volume"),
                       F.col("close").alias("Close"))


def chart_prices_long(bars: DataFrame) -> DataFrame:
    """Wide -> long of the four prices for a multi-line chart."""
    return bars.unpivot(["symbol", "trade_date"], PRICE_COLUMNS, "series", "price")


def corr_matrix(bars: DataFrame, columns: list[str] = CORR_COLUMNS, decimals: int | None = None) -> DataFrame:
    """Pearson correlation per symbol in long form (row_col, col_col, corr).

    One grouped aggregate computes the 10 pair covariances and 5 deviations
    (partial aggregation, no pandas); a constant column gives NULL, the
    diagonal is 1.0 exactly.
    """
    aggs = [F.stddev_pop(c).alias(f"sd_{c}") for c in columns]
    aggs += [F.covar_pop(a, b).alias(f"cv_{a}_{b}") for a, b in combinations(columns, 2)]
    stats = bars.groupBy("symbol").agg(*aggs)
    cells = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if i == j:
                val = F.when(F.col(f"sd_{a}") > 0, F.lit(1.0))
            else:
                x, y = (a, b) if i < j else (b, a)
                val = F.try_divide(F.col(f"cv_{x}_{y}"), F.col(f"sd_{a}") * F.col(f"sd_{b}"))
                if decimals is not None:
                    val = F.bround(val, decimals)
            cells.append(F.struct(F.lit(a).alias("row_col"), F.lit(b).alias("col_col"), val.alias("corr")))
    return stats.select("symbol", F.inline(F.array(*cells)))


__all__ = ["history_for_symbol", "history_bounds", "date_range", "preset_range", "kpi_latest", "chart_volume",
           "chart_candles", "chart_volume_close", "chart_prices_long", "corr_matrix", "PRESETS"]
