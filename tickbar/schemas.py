"""Canonical schemas and the fixed values of the quote model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must equal the quote model of the exchange feed ---------
# The 27 optional numeric fields of a quote snapshot, in model order.
QUOTE_NUMERIC_FIELDS = [
    "ref_price", "ceil_price", "floor_price",
    "b_qtty_3", "b_price_3", "b_qtty_2", "b_price_2", "b_qtty_1", "b_price_1",
    "pct_change", "last_price", "last_qtty", "traded_quantity", "total_value_traded_qtt",
    "s_qtty_3", "s_price_3", "s_qtty_2", "s_price_2", "s_qtty_1", "s_price_1",
    "open_price", "mid_px", "max_price", "min_price",
    "foreign_buy", "foreign_sell", "close_price",
]
# Exchange listing codes and the key-area buckets the feed is polled by.
EXCHANGE_CODES = ["LIS", "UPC"]
KEY_AREAS = ["ABC", "DEF", "GHI", "JKL", "MNO", "PQR", "STUV", "WXYZ"]
# Constant stamped on every fetched record, and the publish chunk size.
EXCHANGE_NAME = "HNX"
PUBLISH_BATCH_SIZE = 10
# ---------------------------------------------------------------------------

QUOTE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("exchange_name", T.StringType(), False),
        T.StructField("trade_time", T.TimestampType(), False),
    ]
    + [T.StructField(f, T.DoubleType(), True) for f in QUOTE_NUMERIC_FIELDS]
)

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("trade_date", T.DateType(), False),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("volume", T.LongType(), True),
    ]
)
BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]

SYMBOL_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType(), False), T.StructField("tb", T.StringType(), True)]
)

# Tab-separated dump layouts; ``\N`` marks NULL.
HISTORY_TSV_SCHEMA = T.StructType(
    [
        T.StructField("index", T.LongType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("Max", T.DoubleType()),
        T.StructField("Min", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Vol", T.LongType()),
        T.StructField("Date", T.TimestampNTZType()),
    ]
)
DAILY_TSV_SCHEMA = T.StructType(
    [
        T.StructField("index", T.LongType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Max", T.DoubleType()),
        T.StructField("Min", T.DoubleType()),
        T.StructField("Vol", T.StringType()),
    ]
)


def quote_schema_for(schema_id: int, extra_fields: dict[int, list[str]] | None = None) -> T.StructType:
    """Writer schema of a framed message: the quote model plus per-id additions.

    The model's required fields (symbol, exchange name, trade time) are not nullable.
    """
    extra = (extra_fields or {}).get(schema_id, [])
    return T.StructType([*QUOTE_SCHEMA.fields, *[T.StructField(f, T.DoubleType(), True) for f in extra]])
