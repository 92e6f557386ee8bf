"""Alignment of two tokenizations of the same text, by lockstep merging.

A (byte-level BPE) and B (sentence pieces) cut the same bytes.  All documents of a batch are merged
at once: a state vector holds a pointer into A's and one into B's token ends for every document; each
step compares the two ends, emits a link and a cut where they are equal, advances the pointer that is
behind (both, where equal) and drops the documents that are through.  A long document goes as
several lanes, cut at A's ends: whether two ends are equal depends on nothing before them, so lanes are independent and
the number of steps is bounded whatever the longest text.

Every token has at least one byte, so at most one token of each side ends at an offset: a cut is one link.

Counts over the corpus: the links of a block of documents (about `BLOCK` links) are counted
once in the task, so Spark adds up one row per block and pair of ids; the totals return to the block
in the same grain.  No document is exploded, and no pair, however frequent, has more rows than there are blocks.

Defined results: a text that is null, empty, or that one of the tokenizers doesn't keep byte for byte
has no tokens; repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Vocabulary
from .common import binaries, fresh, lean, once, scratch, slices, without

LANE = 512  # A tokens of a lane
BLOCK = 1 << 19  # links of a block
_SLICE_BYTES = 1 << 20
_IDS = T.ArrayType(T.IntegerType())
_PAIRS = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                                   T.StructField("n", T.LongType())]))


class Pieces:
    """A sentence-piece vocabulary: ids of texts, bytes of ids."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of = [self._bytes(self.coder.id_to_piece(i)) for i in range(self.coder.get_piece_size())]
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


def merge(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray,
          lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A's and in B's flat arrays) of the tokens that end together, in order.

    `ends_*`: byte ends of all tokens, document after document, ascending inside each; `docs_*`: where each document starts,
    and the total.
    """
    at_a, stop_a, at_b, stop_b = _lanes(ends_a, ends_b, docs_a, docs_b, lane)
    links_a, links_b = [], []
    while len(at_a):
        live = (at_a < stop_a) & (at_b < stop_b)
        if not live.all():  # documents that are through leave the state
            at_a, stop_a, at_b, stop_b = at_a[live], stop_a[live], at_b[live], stop_b[live]
            continue
        a, b = ends_a[at_a], ends_b[at_b]
        same = a == b
        links_a.append(at_a[same])
        links_b.append(at_b[same])
        at_a = at_a + (a <= b)
        at_b = at_b + (b <= a)
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    links_a, links_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(links_a, kind="stable")
    return links_a[order], links_b[order]


def _lanes(ends_a, ends_b, docs_a, docs_b, lane):
    """Start and stop of each lane in A and in B."""
    a0, a1, b0, b1 = [], [], [], []
    for i in range(len(docs_a) - 1):
        cuts = np.arange(docs_a[i], docs_a[i + 1], lane)
        if not len(cuts) or docs_b[i] == docs_b[i + 1]:
            continue
        own = ends_b[docs_b[i]:docs_b[i + 1]]
        meet = docs_b[i] + np.searchsorted(own, ends_a[cuts[1:] - 1], side="right")
        a0 += cuts.tolist()
        a1 += [*cuts[1:].tolist(), int(docs_a[i + 1])]
        b0 += [int(docs_b[i]), *meet.tolist()]
        b1 += [*meet.tolist(), int(docs_b[i + 1])]
    return tuple(np.array(x, np.int64) for x in (a0, a1, b0, b1))


def _tokens(texts: list[bytes | None], a: Vocabulary, b: Pieces) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both sides for each text; none where a side doesn't keep the bytes."""
    none = np.zeros(0, np.int32)
    ids_b = b.ids([(t or b"").decode("utf-8") for t in texts])
    out_a, out_b = [], []
    for text, found in zip(texts, ids_b, strict=True):
        if text:
            whole = b" " + text
            if b"".join([b.bytes_of[i] for i in found]) == whole:
                own = a.ids(whole)
                if b"".join([a.bytes_of[i] for i in own.tolist()]) == whole:
                    out_a.append(own)
                    out_b.append(np.array(found, np.int32))
                    continue
        out_a.append(none)
        out_b.append(none)
    return out_a, out_b


def _starts(runs: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(runs) + 1, np.int64)
    np.cumsum([len(r) for r in runs], out=out[1:])
    return out


def _ends(ids: np.ndarray, docs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of the tokens, each document's from zero."""
    sizes = lengths[ids]
    if len(sizes) and not sizes.all():
        raise ValueError("a token has no bytes")
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    return sums[1:] - np.repeat(sums[docs[:-1]], np.diff(docs))


def _lists(values: np.ndarray, docs: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(docs.astype(np.int32)), pa.array(values, kind))


def _byte_slices(batch: pa.RecordBatch, name: str) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    texts: list[bytes | None] = []
    first = size = 0
    for i, text in enumerate(binaries(batch, name)):
        texts.append(text)
        size += len(text or b"")
        if size >= _SLICE_BYTES or i + 1 == batch.num_rows:
            yield batch.slice(first, len(texts)), texts
            texts, size, first = [], 0, i + 1


_marked: dict[str, np.ndarray] = {}


def _marks(mark: str, size: int) -> np.ndarray:
    """Each id in decimal, with a mark after it."""
    have = _marked.get(mark)
    if have is None or len(have) < size:
        have = _marked[mark] = np.array([f"{i}{mark}" for i in range(size)], object)
    return have


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, size: int) -> str:
    """The groups of a document, `a1,a2|b1;a3|b2,b3`, ids in order (no tokens: empty); `size`: above all ids."""
    if not len(ids_a):
        return ""
    through_a, through_b = np.flatnonzero(ends_a) + 1, np.flatnonzero(ends_b) + 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    words = np.empty(len(ids_a) + len(ids_b), object)
    at_a = np.arange(len(ids_a)) + np.concatenate((np.zeros(1, np.int64), through_b))[group_a]
    at_b = np.arange(len(ids_b)) + through_a[group_b]
    words[at_a] = np.where(ends_a, _marks("|", size)[ids_a], _marks(",", size)[ids_a])
    words[at_b] = np.where(ends_b, _marks(";", size)[ids_b], _marks(",", size)[ids_b])
    return "".join(words.tolist())[:-1]


def _aligner(spec, model, name: str, kept: list[str], out: T.StructType, block_links: int, groups: bool):
    """Rows of documents, and after those of a block one row with its distinct pairs."""
    extra = [f.name for f in out.fields[len(kept):]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        a = once(("vocabulary", xxhash.xxh3_128_hexdigest(spec.value)), lambda: Vocabulary(spec.value))
        b = once(("pieces", xxhash.xxh3_128_hexdigest(model.value)), lambda: Pieces(model.value))
        most = max(len(a.bytes_of), len(b.bytes_of))
        part, block = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([h[-1] for h in held]) if held else np.zeros(0, np.int64)
            pairs, place, n = np.unique(keys, return_inverse=True, return_counts=True)
            at = 0
            for keep, docs_a, docs_b, ids_a, ids_b, ends_a, ends_b, docs, own in held:
                texts = [groups_text(ids_a[a0:a1], ids_b[b0:b1], ends_a[a0:a1], ends_b[b0:b1], most) for a0, a1, b0, b1 in zip(
                    docs_a[:-1], docs_a[1:], docs_b[:-1], docs_b[1:], strict=True)] if groups else [None] * keep.num_rows
                links = place[at:at + len(own)].astype(np.int32)
                at += len(own)
                # in ascending order inside each document: smaller when written, and sums don't mind
                links = links[np.lexsort((links, np.repeat(np.arange(keep.num_rows), np.diff(docs))))]
                columns = [_lists(ids_a, docs_a, pa.int32()), _lists(ids_b, docs_b, pa.int32()), _lists(ends_a, docs_a, pa.bool_()),
                           _lists(ends_b, docs_b, pa.bool_()), pa.array(texts, pa.string()), pa.array(np.full(keep.num_rows, part + block)),
                           _lists(links, docs, pa.int32()), pa.nulls(keep.num_rows, schema.field(extra[-1]).type)]
                yield pa.RecordBatch.from_arrays([*keep.columns, *columns], schema=schema)
            if len(pairs):
                items = pa.StructArray.from_arrays([pa.array((pairs >> 32).astype(np.int32)),
                                                    pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["a", "b", "n"])
                row = {f.name: pa.nulls(1, f.type) for f in schema}
                row[extra[5]] = pa.array([part + block])
                row[extra[-1]] = pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), items).cast(schema.field(extra[-1]).type)
                yield pa.RecordBatch.from_arrays([row[f.name] for f in schema], schema=schema)
            held.clear()

        for batch in slices(batches):
            for own, texts in _byte_slices(batch, name):
                runs_a, runs_b = _tokens(texts, a, b)
                docs_a, docs_b = _starts(runs_a), _starts(runs_b)
                ids_a, ids_b = np.concatenate(runs_a), np.concatenate(runs_b)
                at_a, at_b = merge(_ends(ids_a, docs_a, a.lengths), _ends(ids_b, docs_b, b.lengths), docs_a, docs_b)
                ends_a, ends_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
                ends_a[at_a] = ends_b[at_b] = True
                docs = np.searchsorted(at_a, docs_a)
                keys = (ids_a[at_a].astype(np.int64) << 32) | ids_b[at_b]
                held.append((own.select(kept), docs_a, docs_b, ids_a, ids_b, ends_a, ends_b, docs, keys))
                size += len(keys)
                if size >= block_links:
                    yield from flush()
                    size, block = 0, block + 1
        yield from flush()
    return lean(run)


def align(docs: DataFrame, byte_bpe_path: str, pieces_path: str, text_col: str = "text", keep: list[str] | None = None,
          columns: dict[str, Column] | None = None, groups: bool = False, block_links: int = BLOCK) -> Alignment:
    """Both tokenizations of every text and their common ends, written as a table.

    Of a document: `keep` (default: all its columns), ids_a, ids_b, ends_a, ends_b (does a token end where one of
    the other side does), links (place of each link's pair in its block's list) and, with `groups`, their text
    `a1,a2|b1;a3|b2,b3`.  `columns` (by name, made of these) are stored instead of the four arrays where only they are wanted.
    """
    names = ["ids_a", "ids_b", "ends_a", "ends_b", "groups"]
    keep = without(docs.columns if keep is None else keep, *names, "links", *(columns or ()))
    alias, block, pairs = fresh(docs, "__text"), fresh(docs, "__block"), fresh(docs, "__pairs")
    flags = T.ArrayType(T.BooleanType())
    kinds = [_IDS, _IDS, flags, flags, T.StringType(), T.LongType(), _IDS, _PAIRS]
    kept = [T.StructField(f.name, f.dataType) for f in docs.select(*keep).schema.fields]
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in zip([*names, block, "links", pairs], kinds, strict=True))])
    context = docs.sparkSession.sparkContext
    with open(byte_bpe_path, encoding="utf-8") as f:  # both files have a fixed size, a few MB
        spec = context.broadcast(f.read())
    with open(pieces_path, "rb") as f:
        model = context.broadcast(f.read())
    rows = docs.select(*keep, F.col(text_col).alias(alias)).mapInArrow(
        _aligner(spec, model, alias, keep, schema, block_links, groups), schema)
    out = [c.alias(n) for n, c in columns.items()] if columns else names[:4 + groups]
    return Alignment(scratch(rows.select(*keep, *out, block, "links", pairs), "aligned"), block, pairs)


class Alignment:
    """Aligned documents (a written table), with the pairs of their blocks."""

    def __init__(self, rows: DataFrame, block: str, pairs: str):
        self.rows, self.block, self.pairs = rows, block, pairs

    def documents(self) -> DataFrame:
        """A row per document.  Groups run from one common end to the next; the links are the tokens that close a group."""
        return self.rows.where(F.col(self.pairs).isNull()).drop(self.pairs)

    def _pairs(self) -> DataFrame:
        return self.rows.where(F.col(self.pairs).isNotNull()).select(
            F.col(self.block).alias("block"), F.posexplode(self.pairs).alias("k", "pair")).select(
            "block", "k", "pair.a", "pair.b", "pair.n")

    def pair_counts(self) -> DataFrame:
        """a, b, count over the corpus, and whether that is the highest of its b."""
        counts = self._pairs().groupBy("a", "b").agg(F.sum("n").alias("count"))
        counts = scratch(counts, "pair-counts")
        most = counts.groupBy(F.col("b").alias("top_b")).agg(F.max("count").alias("most"))
        return counts.join(most, F.col("b") == F.col("top_b")).select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))

    def scored(self) -> DataFrame:
        """The stored columns of every document, n_links, n_best (links whose count is the highest of their b)
        and count_sum (over the links)."""
        rows, links = self.documents(), [self.block, "links"]
        counts = self.pair_counts().select(F.col("a").alias("own_a"), F.col("b").alias("own_b"), "count", "best")
        back = self._pairs().join(counts, (F.col("a") == F.col("own_a")) & (F.col("b") == F.col("own_b"))).select(
            "block", "k", "count", "best")
        names = without(rows.columns, *links, "n_links", "n_best", "count_sum")
        fields = [*rows.select(*names).schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_links", "n_best", "count_sum"))]
        return rows.select(*names, *links).groupBy(self.block).cogroup(back.groupBy("block")).applyInArrow(
            _scorer(names), T.StructType(fields))


def _scorer(names: list[str]):
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        """One block: the counts of its pairs, looked up for every link."""
        k = back.column("k").to_numpy()
        count, best = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        count[k] = back.column("count").to_numpy()
        best[k] = back.column("best").to_numpy()
        links = docs.column("links").combine_chunks()
        offsets = links.offsets.to_numpy()
        own = links.values.to_numpy()
        sums = [np.concatenate((np.zeros(1, np.int64), np.cumsum(v[own]))) for v in (best, count)]
        out = [np.diff(offsets).astype(np.int64), *(np.diff(v[offsets]) for v in sums)]
        return pa.Table.from_arrays([*docs.select(names).columns, *map(pa.array, out)], [*names, "n_links", "n_best", "count_sum"])
    return run
