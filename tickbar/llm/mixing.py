"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is what brings its mass (bytes or rows) to its target
share.  Each document's copy count is the inverse Poisson distribution function at a
uniform number hashed from seed and id, so a rerun or a lost executor gives the same
mix.  Copies are exploded and dealt to partitions, and ordered inside them, by a hash.

All of it is DataFrame functions.  The one broadcast table has a row per named source
plus one for all others, a bound set by the parameter.

Defined results: sources without a weight of their own (null included) share the pool's
weight; rows with equal ids are copied alike (a null id is an id like any other); null
and empty texts weigh one byte; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, without

MAX_MEAN = 16.0  # a larger rate is a sum of independent Poisson counts of at most this mean
TERMS = 96       # of the distribution function; beyond them lies less than 2**-52 for that mean


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from the seed and the parts."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(count <= k) for k = 0 .. TERMS."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("c"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k.cast("double")
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, lambda state: state["c"])


def rates(docs: DataFrame, weights: dict[str, float], other_weight: float, by: str = "bytes",
          epochs: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """bucket, mass, rate: a row per named source present, and one (null) for all others."""
    if by not in ("bytes", "rows"):
        raise ValueError(f"by must be 'bytes' or 'rows', not {by!r}")
    given = [*weights.values(), other_weight]
    if any(not math.isfinite(w) or w < 0 for w in given):
        raise ValueError("weights must be finite and not negative")
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long") + 1 if by == "bytes" else F.lit(1)
    mass = docs.groupBy(_bucket(weights, source_col).alias("bucket")).agg(F.sum(size.cast("long")).alias("mass"))
    weight = F.lit(float(other_weight))
    for name, w in weights.items():
        weight = F.when(F.col("bucket") == name, float(w)).otherwise(weight)
    every = Window.partitionBy(F.lit(0))  # a row per bucket, at most one more than there are weights
    mass = mass.withColumn("weight", weight).withColumns(
        {"total": F.sum("mass").over(every), "weights": F.sum("weight").over(every)})
    return mass.select(
        "bucket", "mass",
        F.when(F.col("weights") > 0, F.col("weight") / F.col("weights") * F.col("total") * F.lit(float(epochs))
               / F.col("mass")).otherwise(F.lit(0.0)).alias("rate"))


def _bucket(weights: dict[str, float], source_col: str) -> Column:
    return F.when(F.col(source_col).isin(*weights), F.col(source_col)) if weights else F.lit(None).cast("string")


def replicate(docs: DataFrame, weights: dict[str, float], other_weight: float, by: str = "bytes",
              epochs: float = 1.0, seed: int = 0, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text", copy_col: str = "copy_no", copies_col: str = "n_copies",
              key_col: str = "shuffle_key") -> DataFrame:
    """Every copy of every document: all columns plus copy number (from 1), copies, and shuffle key."""
    docs_cols = without(docs.columns, copy_col, copies_col, key_col)
    docs = docs.select(*docs_cols)
    bucket, joined = fresh(docs, "__bucket"), fresh(docs, "__joined")
    cdf, parts = fresh(docs, "__cdf"), fresh(docs, "__parts")
    pool = rates(docs, weights, other_weight, by, epochs, source_col, text_col)
    n = F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_MEAN).cast("int"))
    pool = pool.select(F.col("bucket").alias(joined), n.alias(parts), poisson_cdf(F.col("rate") / n).alias(cdf))
    dealt = docs.withColumn(bucket, _bucket(weights, source_col)).join(
        F.broadcast(pool), F.col(bucket).eqNullSafe(F.col(joined)))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col(parts)), F.lit(0),
        lambda acc, j: acc + F.size(F.filter(cdf, lambda c: c <= uniform(seed, F.col(id_col), j))))
    return (dealt.withColumn(copies_col, count).where(F.col(copies_col) > 0)
            .withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col(copies_col))))
            .withColumn(key_col, F.md5(F.concat_ws(":", F.lit(f"shuffle {seed}"),
                                                   F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                                                   F.col(copy_col).cast("string"))))
            .select(*docs_cols, copy_col, copies_col, key_col))


def mix(docs: DataFrame, weights: dict[str, float], other_weight: float, **options) -> DataFrame:
    """`replicate`, then a global shuffle: partition and order within it follow the shuffle key."""
    out = replicate(docs, weights, other_weight, **options)
    key = options.get("key_col", "shuffle_key")
    return out.repartition(F.col(key)).sortWithinPartitions(key)


def mix_sql(weights: dict[str, float], other_weight: float, seed: int = 0, epochs: float = 1.0) -> str:
    """DuckDB SQL for doc_id, source, copy_no, n_copies, shuffle_key and text_sha256 of `mix(documents, ..., by="bytes")`."""
    names = ", ".join(f"'{n}'" for n in weights)
    case = " ".join(f"WHEN bucket = '{n}' THEN CAST({w!r} AS DOUBLE)" for n, w in weights.items())
    number = f"CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || j), 1, 13) AS BIGINT)"
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CASE WHEN source IN ({names}) THEN source END AS bucket,
         strlen(coalesce(text, '')) + 1 AS size, sha256(text) AS text_sha256 FROM documents),
mass AS (
  SELECT bucket, CAST(sum(size) AS BIGINT) AS mass,
         CASE {case} ELSE CAST({other_weight!r} AS DOUBLE) END AS weight FROM sized GROUP BY bucket),
rated AS (
  SELECT bucket, weight / sum(weight) OVER () * CAST(sum(mass) OVER () AS BIGINT) * CAST({epochs!r} AS DOUBLE) / mass AS rate
  FROM mass),
pool AS (SELECT bucket, greatest(1, CAST(ceil(rate / {MAX_MEAN}) AS INTEGER)) AS parts, rate FROM rated),
cdf AS (
  SELECT bucket, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c FROM pool
  UNION ALL
  SELECT bucket, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < {TERMS}),
lists AS (SELECT bucket, list(c ORDER BY k) AS cs FROM cdf GROUP BY bucket),
drawn AS (
  SELECT s.doc_id, s.source, s.text_sha256, l.cs, p.parts,
         list_sum(list_transform(range(1, p.parts + 1), lambda j: len(list_filter(l.cs, lambda c: c <= {number} / 4503599627370496.0))))
           AS n_copies
  FROM sized s JOIN pool p ON s.bucket IS NOT DISTINCT FROM p.bucket
  JOIN lists l ON s.bucket IS NOT DISTINCT FROM l.bucket)
SELECT doc_id, source, CAST(copy_no AS INTEGER) AS copy_no, CAST(n_copies AS INTEGER) AS n_copies,
       md5('shuffle {seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || copy_no) AS shuffle_key, text_sha256
FROM (SELECT doc_id, source, text_sha256, n_copies, unnest(range(1, CAST(n_copies AS BIGINT) + 1)) AS copy_no FROM drawn)"""
