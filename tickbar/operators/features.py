"""Per-symbol series features: train/validation split, min-max scaling, lag
windows, differences.  Every operator runs on all symbols at once with
windows partitioned by symbol (bounded by one row per calendar day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_LAGS = 5


def _w():
    return Window.partitionBy("symbol").orderBy("trade_date")


def close_series(bars: DataFrame, value_col: str = "close") -> DataFrame:
    """``(symbol, trade_date, close)``, each symbol's rows together and oldest first."""
    return bars.select("symbol", "trade_date", value_col).repartition("symbol").sortWithinPartitions("symbol", "trade_date")


def train_valid_split(bars: DataFrame, value_col: str = "close") -> DataFrame:
    """Row number, series length and the first ``ceil(0.9 n)`` rows as train.

    ``ceil(0.9 n)`` is computed exactly in integers as ``(9 n + 9) div 10``.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    out = bars.select("symbol", "trade_date", value_col, F.row_number().over(_w()).cast("bigint").alias("rn"), n.alias("n"))
    out = out.withColumn("train_len", F.expr("(n * 9 + 9) div 10"))
    return out.withColumn("split", F.when(F.col("rn") <= F.col("train_len"), F.lit("train")).otherwise(F.lit("valid")))


def minmax_scale(split_df: DataFrame, value_col: str = "close", fit_on: str = "all") -> DataFrame:
    """Scale to [0, 1] with the series' min and max (``fit_on="train"`` uses
    train rows only).  A constant series maps to 0.0."""
    w_all = Window.partitionBy("symbol")
    src = F.col(value_col) if fit_on == "all" else F.when(F.col("split") == "train", F.col(value_col))
    out = split_df.withColumns({"x_min": F.min(src).over(w_all), "x_max": F.max(src).over(w_all)})
    rng = F.col("x_max") - F.col("x_min")
    return out.withColumn("scaled", F.when(rng == 0, F.lit(0.0)).otherwise((F.col(value_col) - F.col("x_min")) / rng))


def minmax_inverse(scaled_df: DataFrame, col: str = "scaled", out: str = "unscaled") -> DataFrame:
    return scaled_df.withColumn(out, F.col(col) * (F.col("x_max") - F.col("x_min")) + F.col("x_min"))


def add_lags(df: DataFrame, col: str, k: int = N_LAGS, prefix: str = "lag") -> DataFrame:
    """``lag_1`` = t-1 ... ``lag_k`` = t-k (the newest lag first)."""
    return df.withColumns({f"{prefix}_{i}": F.lag(col, i).over(_w()) for i in range(1, k + 1)})


def lag_windows(scaled_df: DataFrame, which: str, col: str = "scaled", k: int = N_LAGS) -> DataFrame:
    """Supervised windows: features ``t-k..t-1``, label ``t``.  ``train`` rows start
    at position k; ``valid`` rows reach back into train for their lags."""
    lagged = add_lags(scaled_df, col, k)
    if which == "train":
        lagged = lagged.where((F.col("rn") > k) & (F.col("split") == "train"))
    else:
        lagged = lagged.where(F.col("split") == "valid")
    return lagged.select("symbol", "trade_date", *[f"lag_{i}" for i in range(1, k + 1)], F.col(col).alias("label"))


def diff_series(bars: DataFrame, value_col: str = "close") -> DataFrame:
    """First difference ``y_t - y_{t-1}`` (NULL on the first row)."""
    return bars.select("symbol", "trade_date", value_col,
                       (F.col(value_col) - F.lag(value_col).over(_w())).alias("diff"))
