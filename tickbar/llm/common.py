"""Helpers shared by the operators: scratch tables, Arrow access, word hashing."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbar.session import scratch_path

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have inverses modulo 2**64
_PIECE = 1 << 20
BATCH_BYTES = 2 << 20


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have (callers' extra columns may clash with ours)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def without(columns: list[str], *names: str) -> list[str]:
    """The columns but for those that an operator's own output columns replace."""
    own = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in own]


def id_rank(col: Column) -> Column:
    """Comparable id: null ids come after all others."""
    return F.coalesce(col.cast("long"), F.lit((1 << 63) - 1))


def hash_sample(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """At most n rows, the smallest by a hash of the key columns.

    Where there are many more, a filter on the hash lets only about twice as many through to
    the sort, so what one task sorts is bounded whatever the table's size.
    """
    slot = F.pmod(F.xxhash64(F.lit(17), *key), F.lit(1 << 40))
    share = min(1.0, (2.0 * n + 200) / max(rows.count(), 1))
    return rows.where(slot < int(share * (1 << 40))).orderBy(slot, *key).limit(n)


def binaries(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The values of a text column as UTF-8 bytes."""
    for x in batch.column(batch.schema.get_field_index(name)):
        buf = x.as_buffer() if x.is_valid else None
        yield None if buf is None else buf.to_pybytes()


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ in UTF-8 bytes."""
    space = _SPACE[np.frombuffer(text, np.uint8)].view(np.int8)
    edge = np.diff(np.concatenate((np.ones(1, np.int8), space, np.ones(1, np.int8))))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def lower_ascii(text: bytes) -> bytes:
    return _LOWER[np.frombuffer(text, np.uint8)].tobytes()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        have = _POW[base] = _powers(base, max(n, 1 << 14))
    return have


def word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of a polynomial over the bytes.

    Long texts go in pieces cut between words, so memory follows the piece, not the text.
    """
    base = _BASES[seed]
    inverse = pow(base, -1, 1 << 64)
    data = np.frombuffer(text, np.uint8)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + _PIECE, side="right")))
        s, e = starts[i:j] - at, ends[i:j] - at
        n = int(e[-1])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[at:at + n].astype(np.uint64) + np.uint64(1)) * _powers_of(base, n)[:n], out=sums[1:])
        out[i:j] = (sums[e] - sums[s]) * _powers_of(inverse, n + 1)[s]
        i = j
    return mix(out)


def run_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of k consecutive words."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    base = np.uint64(_BASES[1 - seed])
    for j in range(k):
        out = out * base + words[j:j + n]
    return mix(out)


def release() -> None:
    """Give memory that a finished task has freed back to the system (workers live on between tasks)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function whose task releases its memory at the end."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return wrapped


def bound_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches between Spark and its Python workers at about BATCH_BYTES, in this session.

    By rows alone (10,000) a batch of whole texts takes tens of MB, in buffers that double as they fill, once per Python
    step of a task; the executor's allocator keeps such blocks in each thread's arena long after the task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what is made per batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def once(key: tuple, build: Callable[[], Any]) -> Any:
    """What `build` gives, made once in the life of a Python worker (tasks reuse workers)."""
    store = sys.modules.setdefault("_tickbar_worker", types.ModuleType("_tickbar_worker")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]
