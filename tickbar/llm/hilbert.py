"""Sharding along a Hilbert curve over several metadata dimensions.

A value's cell in its dimension is the share of all rows with a smaller value, in 2**bits steps: cells
follow the order of values, and a dimension fills its whole range however its values are spread.  Spark counts and ranks
every value; tasks get the 2**bits values at evenly spaced ranks, which is all that the cells depend on.  Rows are sorted by the curve
index of their cells, and the sorted run is cut into shards of equal row counts.  Rows of a shard are
neighbours in every dimension at once, so the min/max statistics of its files prune
predicates on any of them.

The order is total (curve index, then id, then text checksum), so a hot source or a group
of copies is cut like any other run: the range sort splits it, no task holds it whole.

Defined results: a null metadata value comes before all others (cell 0); a null text has size 1 (nothing plus
one) and checksum 0; repeated rows get slots of their own; an empty table gives no rows;
with fewer rows than shards the last shards stay empty.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbar.operators.sequence import global_row_number, value_ranks

from .common import fresh, id_rank, lean, scratch, without


@dataclass(frozen=True)
class Dimension:
    """A metadata column: its values are compared as text, or as numbers."""

    name: str
    number: bool = False

    def value(self) -> Column:
        return F.col(self.name).cast("double" if self.number else "string")


def _key(value) -> bytes | float:
    """What values are ordered by (text in the order of its UTF-8 bytes, as Spark does)."""
    return value.encode() if isinstance(value, str) else value


def quantiles(docs: DataFrame, dimensions: list[Dimension], bits: int) -> list[list]:
    """Per dimension, the values at 2**bits evenly spaced ranks of all its rows' values (nulls have none), in order.

    The c-th is the value at rank ceil(c * rows / 2**bits), so as many of them are smaller than a value as its cell says:
    c of them exactly where at least c / 2**bits of the rows are smaller.
    """
    entries = [F.struct(F.lit(i).alias("dim"), (F.lit(None) if d.number else d.value()).cast("string").alias("text"),
                        (d.value() if d.number else F.lit(None)).cast("double").alias("number")) for i, d in enumerate(dimensions)]
    values = docs.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("text is not null or number is not null")
    ranked = value_ranks(values, "dim", "text", "number").select(
        "dim", "text", "number", F.expr(f"shiftleft(below, {bits}) div total").alias("a"),
        F.expr(f"shiftleft(below + n, {bits}) div total").alias("b"))
    out = [[] for _ in dimensions]
    for r in sorted(ranked.where("b > a").collect(), key=lambda r: (r["dim"], r["a"])):  # at most 2**bits a dimension
        out[r["dim"]] += [_key(r["number"] if r["text"] is None else r["text"])] * (r["b"] - r["a"])
    return out


def cells_of(values: pa.Array, sample: list, bits: int) -> np.ndarray:
    """The cell of each value: the share of sorted values that are smaller, in 2**bits steps (null: 0)."""
    coded = values.dictionary_encode()
    known = [_key(v) for v in coded.dictionary.to_pylist()]
    place = np.array([bisect.bisect_left(sample, v) for v in known] + [0], np.int64)
    index = coded.indices.fill_null(len(known)).to_numpy(zero_copy_only=False)
    return np.minimum((place[index] << bits) // max(len(sample), 1), (1 << bits) - 1)


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cell coordinates (n x dims, dims * bits <= 62).

    Works from the highest bit down: each step undoes the rotation and reflection of the
    sub-cube that the higher bits have chosen, then a Gray-code decode orders the sub-cubes.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            set_ = (x[d] >> level & 1).astype(bool)
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | (x[d] >> level & 1)
    return out


def _indexer(samples: list[list], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = len(batch.schema.names) - len(samples)
            cells = np.stack([cells_of(batch.column(at + d), own, bits) for d, own in enumerate(samples)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(curve_index(cells, bits))],
                                             [*batch.schema.names[:at], "curve"])
    return lean(run)


def shard(docs: DataFrame, dimensions: list[Dimension], n_shards: int, bits: int = 8, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard, slot of every row: counts per shard differ by one at most.

    `keep`: further columns to carry along (`write_shards` wants all).
    """
    own = ["doc_id", "size", "text_crc32", "curve", "shard", "slot"]
    keep = without(keep or [], *own)
    text = F.coalesce(F.col(text_col), F.lit(""))
    values = [d.value().alias(fresh(docs, f"__value{i}")) for i, d in enumerate(dimensions)]
    keyed = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                        F.crc32(text).alias("text_crc32"), *keep, *values)
    schema = keyed.select("doc_id", "size", "text_crc32", *keep, F.lit(0).cast("long").alias("curve")).schema
    curve = scratch(keyed.mapInArrow(_indexer(quantiles(docs, dimensions, bits), bits), schema), "curve")
    rank_col = fresh(curve, "__rank")
    ranked = global_row_number(curve.withColumn(rank_col, id_rank(F.col("doc_id"))),
                               ["curve", rank_col, "text_crc32", "size"], name=(seq := fresh(curve, "__seq")))
    n = curve.count()
    small, extra = divmod(n, n_shards)
    rank, head = F.col(seq) - 1, extra * (small + 1)  # the first shards hold one row more
    in_head = rank < head
    which = F.when(in_head, F.floor(rank / (small + 1))).otherwise(extra + F.floor((rank - head) / max(small, 1)))
    start = F.when(in_head, F.col("shard") * (small + 1)).otherwise(head + (F.col("shard") - extra) * small)
    return (ranked.withColumn("shard", which.cast("int"))
            .withColumn("slot", (rank - start).cast("long")).select(*own, *keep))


def write_shards(placed: DataFrame, path: str) -> None:
    """Write placed rows (with the columns to keep) as Parquet, a folder per shard, in slot order."""
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
