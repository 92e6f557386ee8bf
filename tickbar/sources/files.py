"""File and external-system connectors.

Tab-separated dumps (``\\N`` = NULL), the symbol CSV, partitioned quote
tables, and option builders for JDBC and Kafka.  Readers always pass an
explicit schema: no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DAILY_TSV_SCHEMA, HISTORY_TSV_SCHEMA, SYMBOL_SCHEMA

TSV_OPTIONS = {"sep": "\t", "nullValue": "\\N", "header": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
               "dateFormat": "yyyy-MM-dd"}


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, partition_cols: dict[str, T.DataType] | None = None
             ) -> DataFrame:
    full = schema
    for name, dtype in (partition_cols or {}).items():
        full = full.add(name, dtype)
    return spark.read.options(**TSV_OPTIONS).schema(full).csv(path)


def read_history_tsv(spark: SparkSession, path: str, by_symbol_dir: bool = True) -> DataFrame:
    """Historical dump ``index, Open, Max, Min, Close, Vol, Date``; with
    ``by_symbol_dir`` the files sit under ``symbol=<S>/`` directories."""
    return read_tsv(spark, path, HISTORY_TSV_SCHEMA, {"symbol": T.StringType()} if by_symbol_dir else None)


def read_daily_tsv(spark: SparkSession, path: str, by_symbol_dir: bool = True) -> DataFrame:
    return read_tsv(spark, path, DAILY_TSV_SCHEMA, {"symbol": T.StringType()} if by_symbol_dir else None)


def write_tsv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").options(**TSV_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_symbols_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").schema(SYMBOL_SCHEMA).csv(path)


def write_symbols_csv(df: DataFrame, path: str) -> None:
    df.select("symbol", "tb").write.mode("overwrite").option("header", "true").csv(path)


def dedup_symbols(df: DataFrame) -> DataFrame:
    """Enforce the primary key on ``symbol``: keep the smallest table name."""
    return df.groupBy("symbol").agg(F.min("tb").alias("tb"))


def symbols_pk_audit(df: DataFrame) -> DataFrame:
    """Keys that occur more than once (primary-key violations)."""
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def clustered_for_write(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rebalance on the table's partition columns before a partitioned write.

    The REBALANCE hint hash-partitions by the partition columns, so each
    partition value is written by few tasks (few files).  AQE then splits a
    skewed shuffle partition (a hot symbol-day) into several tasks and
    coalesces small ones.  Unlike range partitioning there is no sampling pass,
    which would recompute the whole upstream plan once more.
    """
    return df.hint("rebalance", *partition_cols)


def read_partitioned_quotes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Partitioned quote table.  The schema is given, so no footer is read before pruning and
    files written before a field was added read it as NULL."""
    return spark.read.schema(schema).parquet(path)


def write_by_symbol(bars: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """The bars once more, bucketed and sorted by symbol: a symbol's history is one bucket, whatever the number of dates.

    ``buckets`` is the table's for good; a bucket should be some hundred MB.  One task writes a bucket, in one file.
    """
    spread = bars.repartition(buckets, "symbol")
    (spread.write.mode("overwrite").option("path", path).bucketBy(buckets, "symbol").sortBy("symbol", "trade_date")
     .format("parquet").saveAsTable(table))


def load_symbols(df: DataFrame, path: str) -> None:
    """Write the symbol dimension, one row per symbol."""
    dedup_symbols(df).write.mode("overwrite").parquet(path)


def read_symbols(spark: SparkSession, fmt: str = "parquet", options: dict | None = None, path: str | None = None) -> DataFrame:
    """Full scan of the symbol dimension."""
    return read_relation(spark, fmt, options, path, SYMBOL_SCHEMA).select("symbol", "tb")


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, **extra) -> dict:
    """Options for ``spark.read.format("jdbc")``; pass partitionColumn/lowerBound/
    upperBound/numPartitions in ``extra`` to read a large table in parallel."""
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_relation(spark: SparkSession, fmt: str, options: dict | None = None, path: str | None = None,
                  schema: T.StructType | None = None) -> DataFrame:
    """A whole relational table: ``fmt="jdbc"`` with ``jdbc_options`` in production, a file format in tests."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None and fmt != "jdbc":  # a database brings its own schema
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_source_options(bootstrap: str, topic: str, starting: str = "latest", **extra) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting,
            "failOnDataLoss": "false"}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_sink_options(bootstrap: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}
