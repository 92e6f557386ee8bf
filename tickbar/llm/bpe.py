"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut where a rolling hash of the last 32 bytes meets a mask, so equal
passages give equal chunks wherever they stand.  Documents are brought together
by their smallest chunk hash (copies and near copies meet in one task; a rebalance
lets Spark split a partition that a hot group makes large), each distinct chunk of
a task is encoded once, and every chunk join is repaired: the text around the join
is encoded again, over a window that grows until its tokens agree with those of
both neighbours.

Why the repair is exact: a space before an ASCII letter or digit always starts a
pre-token, whatever stands around it.  Between two such places the tokens depend
on nothing outside, so a window from one to the other that agrees with both sides
continues them exactly.

Defined results: a null or empty text has no tokens and decodes to the empty text;
repeated rows are encoded like any other; added tokens of the vocabulary (such as
the end-of-text mark) become their single id, as the library does by default.
"""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, fresh, lean, once, without

CACHE_BYTES = 24 << 20
CHUNK_MASK_BITS = 11  # chunks of about 2 KB
MIN_CHUNK = 512
_FLUSH = 2 << 20

# The splitting pattern of this public byte-level vocabulary family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# White space as the pattern has it.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2000,}")

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_GEAR = np.random.default_rng(2024).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_letters() -> dict[str, int]:
    """The printable stand-in letter of each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary read from a tokenizers JSON file (its text is what travels)."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if all(c in letters for c in token)}
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", ())}
        for t in self.special:
            ranks.pop(t, None)
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in [*ranks.items(), *self.special.items()]:
            self.bytes_of[i] = token
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    def _coder(self, pattern: str):
        import tiktoken

        ranks = {b: i for i, b in enumerate(self.bytes_of) if b and b not in self.special}
        return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def coder(self):
        """The encoder (decoding needs none)."""
        return self._coder(PATTERN)

    @cached_property
    def piece_coder(self):
        """The encoder of a single pre-token."""
        return self._coder("(?s:.+)")

    def ids(self, piece: bytes) -> np.ndarray:
        """Token ids of a text without added tokens.

        The pattern backtracks over runs of white space, so long ones are cut out by its own rule: all of a run but
        its last character (at the end of the text: all of it) is a pre-token.
        """
        text = piece.decode("utf-8")
        runs, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            runs += [self._ids(text[at:run.start()]), self._single(text[run.start():stop])]
            at = stop
        return np.concatenate([*runs, self._ids(text[at:])]) if runs else self._ids(text)

    def _ids(self, text: str) -> np.ndarray:
        return self.coder.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def _single(self, pre_token: str) -> np.ndarray:
        return self.piece_coder.encode_to_numpy(pre_token, disallowed_special=()).astype(np.int32)

    def segments(self, text: bytes) -> Iterator[tuple[bytes, int | None]]:
        """Stretches of plain text, each with the id of the added token that ends it."""
        while self.special:
            found = min(((at, -len(t), t) for t in self.special if (at := text.find(t)) >= 0), default=None)
            if found is None:
                break
            at, _, token = found
            yield text[:at], self.special[token]
            text = text[at + len(token):]
        yield text, None


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the content-defined chunks of a byte array, never inside a UTF-8 character."""
    n = len(data)
    if n <= MIN_CHUNK:
        return np.array([n], np.int64)
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):  # h[i] gathers the last 32 bytes
        shifted = h[:-step] << np.uint64(step)
        h = h.copy()
        h[step:] += shifted
    cut = (h[:-1] >> np.uint64(64 - CHUNK_MASK_BITS)) == 0
    cut &= (data[1:] & 0xC0) != 0x80
    ends, last = [], 0
    for at in (np.flatnonzero(cut) + 1).tolist():
        if at - last >= MIN_CHUNK:
            ends.append(at)
            last = at
    if not ends or ends[-1] != n:
        ends.append(n)
    return np.array(ends, np.int64)


class ChunkEncoder:
    """Encodes texts chunk by chunk, each distinct chunk once while the cache holds it."""

    def __init__(self, vocabulary: Vocabulary, cache_bytes: int = CACHE_BYTES):
        self.v, self.room = vocabulary, cache_bytes
        self.cache: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.held = self.hits = self.misses = self.widened = 0

    def chunk(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a chunk and the byte offset at which each starts (and the end)."""
        got = self.cache.get(piece)
        if got is not None:
            self.hits += 1
            self.cache.move_to_end(piece)
            return got
        self.misses += 1
        ids = self.v.ids(piece)
        at = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(self.v.lengths[ids], out=at[1:])
        self.cache[piece] = ids, at
        self.held += len(piece) + 8 * len(ids) + 300
        while self.held > self.room and len(self.cache) > 1:
            old, (gone, _) = self.cache.popitem(last=False)
            self.held -= len(old) + 8 * len(gone) + 300
        return ids, at

    def plain(self, text: bytes) -> list[np.ndarray]:
        """Token ids of text without added tokens, as a list of runs."""
        data = np.frombuffer(text, np.uint8)
        ends = chunk_ends(data).tolist()
        if len(ends) == 1:
            return [self.chunk(text)[0]]
        sync = np.flatnonzero((data[:-1] == 32) & _ALNUM[data[1:]])  # always the start of a pre-token
        out: list[np.ndarray] = []
        start, clean = 0, 0  # chunk start; up to where the text's tokens are out
        for k, end in enumerate(ends):
            ids, at = self.chunk(text[start:end])
            if k:  # tokens of this chunk hold from its first sync place that agrees
                joined = self.join(text, sync, clean, start, end, ids, at)
                if joined is None:  # none in this chunk: the next join covers it too
                    start = end
                    continue
                repaired, clean = joined
                out.append(repaired)
            if end == len(text):
                out.append(ids[np.searchsorted(at, clean - start):])
                return out
            # hold back the last two sync places before the join for the repair
            lo, hi = np.searchsorted(sync, (max(clean, start), end - 1))
            stop = int(sync[max(lo, hi - 2)]) if hi > lo else clean
            if stop > clean:
                a, b = np.searchsorted(at, (clean - start, stop - start))
                out.append(ids[a:b])
                clean = stop
            start = end
        out.append(self.v.ids(text[clean:]))
        return out

    def join(self, text: bytes, sync: np.ndarray, clean: int, start: int, end: int,
             ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, int] | None:
        """Encode again from `clean`, over the join, until the tail agrees with the chunk's tokens."""
        i = int(np.searchsorted(sync, start))
        last = int(np.searchsorted(sync, end - 1))
        while i < last:
            q = int(sync[i])
            q2 = int(sync[i + 1]) if i + 1 < last else end
            window = self.v.ids(text[clean:q2]) if q2 < end or end == len(text) else self.v.ids(text[clean:q])
            if q2 == end and end != len(text):  # the last place of the chunk: nothing after it to compare
                return window, q
            a, b = np.searchsorted(at, (q - start, q2 - start))
            tail = b - a
            if at[a] == q - start and tail <= len(window) and np.array_equal(window[len(window) - tail:], ids[a:b]):
                return window[:len(window) - tail], q
            self.widened += 1
            i += 1
        return None

    def encode(self, text: bytes | None) -> np.ndarray:
        runs: list[np.ndarray] = []
        for piece, special in self.v.segments(text or b""):
            if piece:
                runs += self.plain(piece)
            if special is not None:
                runs.append(np.array([special], np.int32))
        return np.concatenate(runs) if runs else np.zeros(0, np.int32)


def _signature(name: str, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(binaries(batch, name)):
                if text:
                    a, least = 0, (1 << 63) - 1
                    for b in chunk_ends(np.frombuffer(text, np.uint8)).tolist():
                        least = min(least, xxhash.xxh3_64_intdigest(text[a:b]) >> 1)
                        a = b
                    out[i] = least
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, key])
    return lean(run)


def _vocabulary(spec) -> Vocabulary:
    """The broadcast vocabulary, built once per worker."""
    text = spec.value
    return once(("vocabulary", xxhash.xxh3_128_hexdigest(text)), lambda: Vocabulary(text))


def _encoder(spec, name: str, kept: list[str], ids_col: str, cache_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkEncoder(_vocabulary(spec), cache_bytes)
        for batch in batches:
            keep = batch.select(kept)
            runs: list[np.ndarray] = []
            first = size = 0
            for i, text in enumerate(binaries(batch, name)):
                runs.append(coder.encode(text))
                size += len(text or b"")
                if size >= _FLUSH or i + 1 == batch.num_rows:
                    offsets = np.zeros(len(runs) + 1, np.int32)
                    np.cumsum([len(r) for r in runs], out=offsets[1:])
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(runs)))
                    yield pa.RecordBatch.from_arrays([*keep.slice(first, len(runs)).columns, ids], [*kept, ids_col])
                    runs, size, first = [], 0, i + 1
    return lean(run)


def _decoder(spec, name: str, kept: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _vocabulary(spec).bytes_of
        for batch in batches:
            keep = batch.select(kept)
            texts: list[str] = []
            first = size = 0
            ids = batch.column(batch.schema.get_field_index(name))
            for i in range(batch.num_rows):
                own = ids[i].values
                own = [] if own is None else own.to_numpy(zero_copy_only=False).tolist()
                texts.append(b"".join([bytes_of[x] for x in own]).decode("utf-8", "replace"))
                size += 4 * len(own)
                if size >= _FLUSH or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*keep.slice(first, len(texts)).columns, pa.array(texts, pa.string())], [*kept, text_col])
                    texts, size, first = [], 0, i + 1
    return lean(run)


def _spec(df: DataFrame, path: str):
    """The vocabulary file's text, read on the driver and broadcast (fixed size, a few MB)."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids",
           keep: list[str] | None = None, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """`keep` columns (default: all) of every row plus its token ids (array<int>, never null)."""
    keep = without(docs.columns if keep is None else keep, ids_col)
    alias, key = fresh(docs, "__text"), fresh(docs, "__signature")
    src = docs.select(*keep, F.col(text_col).alias(alias))
    signed = src.mapInArrow(_signature(alias, key), _with(src.schema, key, T.LongType()))
    schema = _with(docs.select(*keep).schema, ids_col, T.ArrayType(T.IntegerType()))
    coder = _encoder(_spec(docs, vocabulary_path), alias, keep, ids_col, cache_bytes)
    return signed.hint("rebalance", key).mapInArrow(coder, schema)


def decode(encoded: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of `encoded` plus the decoded text."""
    keep = without(encoded.columns, text_col)
    return encoded.mapInArrow(_decoder(_spec(encoded, vocabulary_path), ids_col, keep, text_col),
                              _with(encoded.select(*keep).schema, text_col, T.StringType()))


def ids_text(col: Column | str) -> Column:
    """The ids in decimal, joined by commas."""
    return F.array_join(F.col(col).cast("array<string>") if isinstance(col, str) else col.cast("array<string>"), ",")
