"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in Python from every word shingle of the whole text.  Distinct
fingerprints are laid into tiles by the population counts of their four 16-bit quarters:
two fingerprints within the radius have tiles whose counts differ by the radius in all at
most, so every other pair of tiles is skipped.  A task holds one block of a tile and streams
the blocks of the neighbouring tiles past it, comparing with exclusive-or and bit counts in numpy.
No link is lost; copies are never expanded into pairs, since equal fingerprints are one row.

A tile of any size is cut into blocks of bounded size, and a task reports only the links
that join different trees, so a large group of near copies gives a row per member, not per pair.

Defined results: lower-casing touches A-Z only; a null, empty or blank text has fingerprint
zero, linked like any other; a text with fewer words than a shingle is one shingle;
rows without an id take part, and a component's id is null only if no member has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, fresh, id_rank, lean, lower_ascii, scratch, without, word_bounds
from .components import connected_components

SEED = 42
BLOCK = 8192
_AT_ONCE = 1 << 16  # shingles or pairs handled in one numpy step
_BITS = 64
_FEW = 512


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Majority of the bits of the shingles' XXH64, as an unsigned integer."""
    low = lower_ascii(text or b"")
    starts, ends = word_bounds(low)
    if not len(starts):
        return 0
    words = b" ".join([low[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    stops = np.cumsum(ends - starts + 1) - 1
    k = min(shingle, len(starts))
    begins = np.concatenate(([0], stops[:-1] + 1))[:len(starts) - k + 1]
    stops = stops[k - 1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(_BITS, np.int64)
    for at in range(0, len(begins), _AT_ONCE):
        h = np.array([digest(words[a:b], SEED) for a, b in
                      zip(begins[at:at + _AT_ONCE].tolist(), stops[at:at + _AT_ONCE].tolist())], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = np.packbits(counts * 2 > len(begins), bitorder="little")
    return int(set_.view("<u8")[0])


def _fingerprints(name: str, kept: int, shingle: int, fp_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in binaries(batch, name)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(fps.view(np.int64))],
                                             [*batch.schema.names[:kept], fp_col])
    return lean(run)


def with_fingerprint(docs: DataFrame, fp_col: str, shingle: int = 3, text_col: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default: all) of every row plus its fingerprint as a signed long."""
    keep = without(docs.columns if keep is None else keep, fp_col)
    alias = fresh(docs, "__text")
    src = docs.select(*keep, F.col(text_col).alias(alias))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(fp_col, T.LongType())])
    return src.mapInArrow(_fingerprints(alias, len(keep), shingle, fp_col), schema)


def _tile(fp: Column, radius: int) -> Column:
    """Tile number: the population counts of the quarters as digits, with room for steps of the radius."""
    tile = F.lit(0)
    for quarter in range(4):
        count = F.bit_count(F.shiftrightunsigned(fp, 16 * quarter).bitwiseAND(F.lit(0xFFFF)))
        tile = tile * (17 + 2 * radius) + count + radius
    return tile.cast("int")


def _steps(radius: int) -> list[int]:
    """Steps to the neighbouring tiles that are not after a tile (each pair of tiles meets once)."""
    base = 17 + 2 * radius
    steps = (sum(d * base ** (3 - i) for i, d in enumerate(v)) for v in product(range(-radius, radius + 1), repeat=4)
             if sum(map(abs, v)) <= radius)
    return sorted(s for s in steps if s <= 0)


def _compare(radius: int):
    """Links between the home block's fingerprints and those streamed past it."""
    from .components import Forest

    def links(home: np.ndarray, guests: np.ndarray, trees: Forest, own: bool) -> list[tuple[int, int]]:
        found: list[tuple[int, int]] = []
        roots = None
        step = max(1, _AT_ONCE // max(1, len(guests)))
        for at in range(0, len(home), step):
            near = np.bitwise_count(home[at:at + step, None] ^ guests[None, :]) <= radius
            i, j = np.nonzero(near)
            i += at
            if own:
                later = i < j
                i, j = i[later], j[later]
            if len(i) <= _FEW:
                pairs = zip(home[i].tolist(), guests[j].tolist())
                new = [(x, y) for x, y in pairs if trees.join(x, y)]
                if new:
                    found += new
                    roots = None
                continue
            if roots is None:  # many links: look only at those between different trees
                roots = [np.array([trees.root(x) for x in side.tolist()], np.uint64) for side in (home, guests)]
            a, b = roots[0][i], roots[1][j]
            differ = a != b
            if not differ.any():
                continue
            pairs = np.unique(np.stack((a[differ], b[differ])), axis=1)
            found += [(x, y) for x, y in pairs.T.tolist() if trees.join(x, y)]
            roots = None
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, home, trees = None, [], None, Forest()

        def settle() -> list[tuple[int, int]]:
            nonlocal home
            home = np.concatenate(held)
            return links(home, home, trees, True)

        def batch_of(found):
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

        for batch in batches:
            tile, block, role, fp = (batch.column(i).to_numpy() for i in range(4))
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((np.diff(tile) != 0) | (np.diff(block) != 0) | (np.diff(role) != 0)) + 1
            found: list[tuple[int, int]] = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tile)]):
                if b == a:
                    continue
                if (tile[a], block[a]) != key:
                    if held and home is None:
                        found += settle()
                    key, held, home, trees = (tile[a], block[a]), [], None, Forest()
                if role[a] == 0:
                    held.append(fp[a:b])
                elif held:
                    if home is None:
                        found += settle()
                    found += links(home, fp[a:b], trees, False)
            if found:
                yield batch_of(found)
        if held and home is None and (found := settle()):
            yield batch_of(found)
    return lean(run)


def links(groups: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """u, v: a forest that joins all distinct fingerprints (column fp) within the radius."""
    rows = groups.select("fp").withColumn("tile", _tile(F.col("fp"), radius))
    tiles = (rows.groupBy(F.col("tile").alias("home")).count()
             .select("home", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    rows = rows.withColumn("home", F.explode(F.array(*[F.col("tile") + s for s in _steps(radius)])))
    # a tile is four counts of 0 to 16: at most 17**4 rows
    met = rows.join(F.broadcast(tiles), "home")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")  # the block of a row in its own tile
    last = F.when(F.col("home") == F.col("tile"), own).otherwise(F.col("blocks") - 1)
    met = met.withColumn("own", own).withColumn("block", F.explode(F.sequence(F.lit(0), last)))
    role = F.when((F.col("home") == F.col("tile")) & (F.col("block") == F.col("own")), 0).otherwise(1)
    dealt = (met.select("home", "block", role.cast("int").alias("role"), "fp").repartition("home", "block")
             .sortWithinPartitions("home", "block", "role"))
    return dealt.mapInArrow(_compare(radius), "u long, v long")


def classes(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """fp, component (a fingerprint), component_rank of every distinct fingerprint, from rows (rank, fp)."""
    groups = scratch(fps.groupBy("fp").agg(F.min("rank").alias("rank")), "simhash-groups")
    comp = connected_components(links(groups, radius, block))
    named = groups.join(comp, groups["fp"] == comp["node"], "left").select(
        "fp", "rank", F.coalesce("component", "fp").alias("component"))
    named = scratch(named, "simhash-named")
    least = scratch(named.groupBy(F.col("component").alias("of")).agg(F.min("rank").alias("component_rank")),
                    "simhash-least")
    return named.join(least, named["component"] == least["of"]).select("fp", "component", "component_rank")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) of every row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fps = scratch(with_fingerprint(src, "fp", shingle, keep=["doc_id"])
                  .withColumn("rank", id_rank(F.col("doc_id"))), "simhash-fps")
    found = scratch(classes(fps, radius).withColumnRenamed("fp", "of"), "simhash-classes")
    return fps.join(found, F.col("fp") == F.col("of")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("component_rank") < (1 << 63) - 1, F.col("component_rank")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns: the smallest id (a null id only if there is no other)."""
    fp, rank, best = (fresh(docs, c) for c in ("__fp", "__rank", "__best"))
    rows = scratch(with_fingerprint(docs, fp, shingle, text_col).withColumn(rank, id_rank(F.col(id_col))),
                   "simhash-rows")
    fps = rows.select(F.col(fp).alias("fp"), F.col(rank).alias("rank"))
    found = classes(fps, radius)
    pairs = fps.groupBy("fp").agg(F.min("rank").alias("rank")).join(found, "fp")
    best_of = pairs.groupBy("component").agg(F.min(F.struct("rank", "fp")).alias(best))
    best_of = scratch(best_of.select(best), "simhash-best")
    kept = rows.join(best_of, (rows[rank] == best_of[f"{best}.rank"]) & (rows[fp] == best_of[f"{best}.fp"]))
    return kept.dropDuplicates([rank, fp]).select(*docs.columns)
