"""Substring dedup with repeated-phrase automata.

1. Anchors.  In every 50-word window the 10-word phrase with the smallest hash is its
   anchor; equal windows have equal anchors, so a passage that recurs shares one.  Texts with
   the same word sequence are one class, of which the smallest id goes on.
2. Recurring phrases: anchors of classes with different ids.  Each belongs to the class with the
   smallest id; phrases of a class go to one shard, so documents are routed to few shards.
3. Automata.  A task compiles the Aho-Corasick automaton of its shard's phrases, taken
   from the owners' texts, and streams every document with one of them through it to locate
   every occurrence.  A shard with many documents is dealt to several tasks, each with the
   automaton.
4. Confirmation.  Windows anchored at an occurrence are told apart by 128-bit hashes of their words' bytes; a
   window that also stands in a document with a smaller id is removed from this one.

Anchors are chosen by polynomial hashes of words, which equal words share; that two words collide there (one can
make such words) costs work, never a removal, since phrases are matched as text and windows by step 4.
Texts travel under id and text together, so texts that share an id (or have none) don't meet each other.
Memory in a task follows the shard size (a parameter) and the longest text; a shard's texts are dealt to
tasks by their words.  Documents without a recurring phrase are never routed.

Defined results: a null text has no words and stays null; ids are compared as integers, a null
id after all others; rows with equal ids don't remove each other's words, and repeated
rows are treated alike; a text shorter than a window is left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, fresh, id_rank, lean, run_hashes, scratch, slices, without, word_bounds, word_hashes

WINDOW = 50
PHRASE = 10
PHRASES_PER_SHARD = 8192
WORDS_PER_TASK = 1 << 20


def joined_words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each starts and ends in that."""
    starts, ends = word_bounds(text)
    joined = b" ".join([text[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    stops = np.cumsum(ends - starts + 1) - 1
    return joined, stops - (ends - starts), stops


def sequence_key(joined: bytes) -> bytes:
    return hashlib.blake2b(joined, digest_size=16).digest()


def window_keys(joined: bytes, starts: np.ndarray, stops: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """A 128-bit hash, as two integers, of the words of each window that starts at a place of `at`."""
    ends = stops[at + window - 1].tolist()
    found = b"".join([xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(starts[at].tolist(), ends, strict=True)])
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def text_key(text: Column) -> Column:
    """Tells the texts of an id apart (a null has none)."""
    return F.xxhash64(text)


def anchor_of_windows(phrases: np.ndarray, per_window: int) -> np.ndarray:
    """Place of the leftmost smallest phrase hash of each window of `per_window` phrases."""
    if len(phrases) < per_window:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(phrases, per_window)
    return views.argmin(axis=1) + np.arange(len(views))


def _anchors(window: int, phrase: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seqs, counts, anchors, offsets = [], [], [np.zeros(0, np.uint64)], [0]
            for text in binaries(batch, "text"):
                text = text or b""
                joined, starts, stops = joined_words(text)
                seqs.append(sequence_key(joined))
                counts.append(len(starts))
                if len(starts) >= window:
                    runs = run_hashes(word_hashes(joined, starts, stops), phrase)
                    anchors.append(np.unique(runs[np.unique(anchor_of_windows(runs, window - phrase + 1))]))
                    offsets.append(offsets[-1] + len(anchors[-1]))
                else:
                    offsets.append(offsets[-1])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                             pa.array(np.concatenate(anchors).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(seqs, pa.binary()), pa.array(counts, pa.int64()), lists],
                ["id", "text_key", "seq", "n_words", "anchors"])
    return lean(run)


def _locate(window: int, phrase: int):
    """128-bit hashes of the windows around each occurrence of the shard's phrases."""
    import ahocorasick

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, wanted, automaton, compiled = None, {}, None, False
        for batch in batches:
            shard, part, role = (batch.column(i).to_numpy() for i in range(3))
            ids = batch.column(3).to_pylist()
            seqs = batch.column(4).to_pylist()
            lists = batch.column(5)
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, text in enumerate(binaries(batch, "text")):
                if (shard[i], part[i]) != key:
                    key, automaton, compiled = (shard[i], part[i]), ahocorasick.Automaton(), False
                joined, starts, stops = joined_words(text or b"")
                if sequence_key(joined) != seqs[i]:  # another text with the same id
                    continue
                words = word_hashes(joined, starts, stops)
                padded = b" " + joined + b" "
                if role[i] == 0:  # an owner: take its phrases from the text
                    own = lists[i].values.to_numpy().view(np.uint64)
                    for p in np.flatnonzero(np.isin(run_hashes(words, phrase), own)).tolist():
                        automaton.add_word(padded[starts[p]:stops[p + phrase - 1] + 2].decode("latin-1"), True)
                    continue
                if not compiled:
                    automaton.make_automaton()
                    compiled = True
                if not len(automaton):
                    continue
                found = np.fromiter((e for e, _ in automaton.iter(padded.decode("latin-1"))), np.int64)
                if not len(found):
                    continue
                located = np.zeros(len(starts) - phrase + 1, bool)
                located[np.searchsorted(stops, found - 1) - phrase + 1] = True
                at = np.flatnonzero(located[anchor_of_windows(run_hashes(words, phrase), window - phrase + 1)])
                if not len(at):
                    continue
                keys = window_keys(joined, starts, stops, at, window)
                out[0].append(keys[:, 0])
                out[1].append(keys[:, 1])
                out[2].append(np.full(len(at), ids[i], np.int64))
                out[3].append(np.full(len(at), int.from_bytes(seqs[i][:8], "big", signed=True), np.int64))
                out[4].append(at.astype(np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 ["w1", "w2", "id", "tag", "start"])
    return lean(run)


def _remove(window: int, text_at: int, told_at: int, kept: list[str], own: list[str], one_space: bool):
    def cut(text: bytes, told: list[dict] | None) -> tuple[int, int, bytes]:
        joined, starts, stops = joined_words(text)
        n = len(starts)
        decision = None
        if told:
            tag = int.from_bytes(sequence_key(joined)[:8], "big", signed=True)
            decision = next((t for t in told if t["tag"] == tag), None)
        if decision is None:
            return n, 0, joined if one_space else text
        if decision["whole"]:
            return n, n, b""
        marks = np.zeros(n + 1, np.int64)
        first = np.unique(decision["starts"])
        marks[first] += 1
        marks[first + window] -= 1
        keep = np.cumsum(marks[:-1]) == 0
        if one_space:
            out = b" ".join([joined[a:b] for a, b in zip(starts[keep].tolist(), stops[keep].tolist())])
        else:  # a covered word goes with the space after it
            begins, _ = word_bounds(text)
            edges = np.append(begins, len(text))
            edges[0] = 0
            turn = np.flatnonzero(np.diff(keep.astype(np.int8))) + 1
            cuts = [0, *turn.tolist(), n]
            out = b"".join([text[edges[a]:edges[b]] for a, b in zip(cuts, cuts[1:]) if keep[a]])
        return n, int(n - keep.sum()), out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            told = batch.column(told_at).to_pylist()
            rows = [(0, 0, None) if t is None else cut(t, d)
                    for t, d in zip(binaries(batch, batch.schema.names[text_at]), told)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())],
                [*kept, *own])
    return lean(run)


def find_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_col: str = "doc_id",
                 text_col: str = "text", per_shard: int = PHRASES_PER_SHARD,
                 words_per_task: int = WORDS_PER_TASK) -> DataFrame:
    """What to remove, a row per id and text: id, text_key, told = array of (tag of the word sequence, whole, window starts)."""
    if not 0 < phrase <= window:
        raise ValueError("a phrase must fit into a window")
    src = docs.select(id_rank(F.col(id_col)).alias("id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    rows = scratch(src.mapInArrow(_anchors(window, phrase), "id long, text_key long, seq binary, n_words long, anchors array<long>"),
                   "substring-rows").where(F.col("n_words") >= window)
    heads = rows.groupBy("seq").agg(F.min(F.struct("id", "text_key")).alias("head"), F.first("n_words").alias("n_words"),
                                    F.first("anchors").alias("anchors"))
    heads = scratch(heads.select("seq", "head.id", "head.text_key", "n_words", "anchors"), "substring-heads")

    posts = heads.select("id", "text_key", "seq", "n_words", F.explode("anchors").alias("anchor"))
    shared = posts.groupBy("anchor").agg(F.min(F.struct("id", "seq", "text_key")).alias("owner"), F.max("id").alias("last"))
    shared = scratch(shared.where(F.col("last") > F.col("owner.id")).select("anchor", "owner"), "substring-phrases")
    n_shards = max(1, -(-shared.count() // per_shard))
    shard = F.pmod(F.xxhash64("owner.id", "owner.seq"), F.lit(n_shards)).cast("int")
    shared = shared.withColumn("shard", shard)

    owners = shared.groupBy("shard", "owner").agg(F.collect_list("anchor").alias("own")).select(
        "shard", F.col("owner.id").alias("id"), F.col("owner.text_key").alias("text_key"), F.col("owner.seq").alias("seq"), "own")
    routed = scratch(posts.join(shared, "anchor").select("shard", "id", "text_key", "seq", "n_words").distinct(), "substring-routes")
    loads = scratch(routed.groupBy("shard").agg(F.ceil(F.sum("n_words") / words_per_task).cast("int").alias("parts")),
                    "substring-loads")
    every = owners.join(loads, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "id", "text_key", "seq", "own")
    some = routed.join(loads, "shard").select(
        "shard", F.pmod(F.xxhash64("id", "seq"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "id",
        "text_key", "seq", F.lit(None).cast("array<long>").alias("own"))
    stream = every.union(some).join(src.where(F.col("text").isNotNull()), ["id", "text_key"]).select(
        "shard", "part", "role", "id", "seq", "own", "text")
    stream = stream.repartition("shard", "part").sortWithinPartitions("shard", "part", "role")
    found = scratch(stream.mapInArrow(_locate(window, phrase), "w1 long, w2 long, id long, tag long, start int"),
                    "substring-windows")

    first = scratch(found.groupBy(F.col("w1").alias("x1"), F.col("w2").alias("x2"))
                    .agg(F.min("id").alias("least"), F.max("id").alias("most")).where("most > least").drop("most"),
                    "substring-first")
    later = found.join(first, (found["w1"] == first["x1"]) & (found["w2"] == first["x2"])).where("id > least")
    spans = later.groupBy("id", "tag").agg(F.collect_set("start").alias("starts")).select(
        "id", "tag", F.lit(False).alias("whole"), "starts")
    tag = F.conv(F.hex(F.substring("seq", 1, 8)), 16, -10).cast("long").alias("tag")
    texts = rows.select("id", tag, "text_key").distinct()  # a word sequence may stand in an id with other white space too
    minima = heads.select(F.col("seq").alias("own"), F.col("id").alias("least"))
    copies = rows.join(minima, F.col("seq") == F.col("own")).where("id > least").select("id", tag).distinct()
    copies = copies.select("id", "tag", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("starts"))
    told = spans.union(copies).join(texts, ["id", "tag"]).groupBy("id", "text_key").agg(
        F.collect_list(F.struct("tag", "whole", "starts")).alias("told"))
    return scratch(told, "substring-told")


def remove_repeats(docs: DataFrame, repeats: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", keep: list[str] | None = None, kept_col: str = "kept",
                   one_space: bool = False, n_col: str = "n_words", removed_col: str = "n_removed") -> DataFrame:
    """`keep` columns (default: all but the text) of every row, its word count, words removed, and the text left.

    With `one_space` the words left are joined by one space; else their own separators stay.
    """
    keep = without([c for c in docs.columns if c != text_col] if keep is None else keep, n_col, removed_col, kept_col)
    text, rank, own_key, told, key, told_key = (fresh(docs, c) for c in ("__text", "__rank", "__own", "__told", "__key", "__text_key"))
    src = docs.select(*keep, F.col(text_col).alias(text), id_rank(F.col(id_col)).alias(rank), text_key(F.col(text_col)).alias(own_key))
    met = src.join(repeats.select(F.col("id").alias(key), F.col("text_key").alias(told_key), F.col("told").alias(told)),
                   (F.col(rank) == F.col(key)) & (F.col(own_key) == F.col(told_key)), "left")
    met = met.select(*keep, text, told)
    own = [n_col, removed_col, kept_col]
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(c, t) for c, t in zip(
        own, (T.LongType(), T.LongType(), T.StringType()))]])
    return met.mapInArrow(_remove(window, len(keep), len(keep) + 1, keep, own, one_space), schema)
