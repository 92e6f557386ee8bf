"""Language identification with interpolated Kneser-Ney character models.

Counting is a Spark job over every training document: tasks count character n-grams
(orders 1 to ORDER) per language by a 64-bit key, and the counts are summed by key in a table that grows
with the corpus.  Continuation counts, discounts, back-off weights and probabilities are joins and
groups of that table.  The model is written to the shared folder: per language, order and key
range a file of sorted keys with their log probabilities, and one of contexts with their back-off
weights.  Tasks look up the distinct n-grams of many texts at once, a file at a time, and keep
at most CACHE_BYTES of files.

A text's score per language is the cross-entropy in nats per character; the lowest wins (ties: the
language name that sorts first).  Confidence and rejection are calibrated on a fold that is not
counted until then: a logistic fit of "correct" on the margin to the second language, and per
language the cross-entropy beyond which a text doesn't look like the language at all.  Then this
fold is counted too, so the final model has all documents but the held-out fold.  Every document of the fold
calibrates (one row per id): Spark sums each Newton step of the fit, and ranks the cross-entropies for the exact limits.

Letters are lower-cased, every run of other characters is one space.

Defined results: a null text or one without letters is `und` with score 0; with no training
language everything is `und`; repeated rows are scored alike; null languages are never learned;
null ids hash as the empty text.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbar.operators.sequence import value_ranks
from tickbar.session import scratch_path

from .common import binaries, lean, mix, once, scratch, slices, without

ORDER = 4
BITS = 64
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
REJECT_QUANTILE = 0.995
UNDETERMINED = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE = 1 << 18
_HELD = 1 << 20          # n-grams that a counting task collects before it adds them up
RANGE_ROWS = 1 << 20     # wanted entries of a model file
CACHE_BYTES = 128 << 20  # model files that a worker keeps


def letter_table() -> np.ndarray:
    return once(("letters",), lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def characters(text: bytes | None, letters: np.ndarray) -> np.ndarray:
    """Code points of a text, letters only, with one 0 for each run of others and at both ends."""
    raw = np.frombuffer((text or b"").decode("utf-8").lower().encode("utf-32-le"), np.uint32)
    codes = np.zeros(len(raw) + 2, np.uint64)
    codes[1:-1] = np.where(letters[raw], raw, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def slots(codes: np.ndarray, order: int, bits: int) -> list[np.ndarray]:
    """Per order m, the key of the n-gram that ends at each place (undefined before place m - 1)."""
    out, sums, factor = [], np.zeros(len(codes), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for m in range(order):
            sums = sums.copy()
            sums[m:] += (codes[:len(codes) - m] + np.uint64(1)) * factor
            factor = factor * _BASE
            out.append((mix(sums + np.uint64(m)) >> np.uint64(64 - bits)).view(np.int64))
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and the place of each key among them."""
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


def _summed(parts: list[tuple]) -> tuple:
    """keys, contexts, suffixes and counts of several parts as one, a row per key."""
    key, ctx, suf = (np.concatenate([x[i] for x in parts]) for i in range(3))
    n = np.concatenate([np.ones(len(x[0]), np.int64) if x[3] is None else x[3] for x in parts])
    found, at = _distinct(key)
    out = [np.zeros(len(found), np.int64) for _ in range(3)]
    out[0][at], out[1][at] = ctx, suf
    np.add.at(out[2], at, n)
    return found, *out


def _count(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        held: dict[tuple[str, int], list[tuple]] = {}
        size = 0

        def flush():
            for (lang, m), parts in held.items():
                key, ctx, suf, n = _summed(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key), pa.string()), pa.array(np.full(len(key), m + 1, np.int32)),
                     pa.array(key), pa.array(ctx), pa.array(suf), pa.array(n)], ["lang", "m", "slot", "ctx", "suf", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, binaries(batch, "text")):
                codes = characters(text, letters)
                if len(codes) < 3 and not codes.any():
                    continue
                for at in range(0, len(codes), _AT_ONCE):  # pieces overlap by what an n-gram needs
                    back = min(at, order - 1)
                    own = slots(codes[at - back:at + _AT_ONCE], order, bits)
                    for m in range(order):
                        start = max(m, back, 1 if at == 0 else back)  # the leading 0 is context only
                        s = own[m][start:]
                        none = np.zeros(len(s), np.int64)
                        held.setdefault((lang, m), []).append(
                            (s, own[m - 1][start - 1:-1], own[m - 1][start:], None) if m else (s, none, none, None))
                        size += len(s)
                    if size >= _HELD:
                        for k, parts in held.items():
                            held[k] = [_summed(parts)]
                        size = sum(len(x[0][0]) for x in held.values())
                        if size >= _HELD // 2:
                            yield from flush()
                            size = 0
        yield from flush()
    return lean(run)


def kneser_ney(m: np.ndarray, slot: np.ndarray, ctx: np.ndarray, suf: np.ndarray, n: np.ndarray, order: int, bits: int) -> list:
    """Per order: sorted slots, their log probabilities, sorted contexts, their log back-off weights.

    The plain reading of what `probabilities` does, for counts of one language in 2**bits slots.
    """
    size = 1 << bits
    by = [np.flatnonzero(m == k + 1) for k in range(order)]
    by = [x[np.argsort(slot[x])] for x in by]
    out, lower = [], None
    for k in range(order):
        x = by[k]
        if k + 1 < order:  # continuation counts: how many different characters stand before
            count = np.maximum(np.bincount(suf[by[k + 1]], minlength=size)[slot[x]], 1).astype(np.float64)
        else:
            count = n[x].astype(np.float64)
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        d = min(max(n1 / (n1 + 2.0 * n2) if n1 else 0.5, 0.1), 0.9)
        if k == 0:
            total = count.sum()
            floor = d * len(x) / total / (len(x) + 1.0)
            p = np.maximum(count - d, 0) / total + floor
            contexts, weight = np.zeros(1, np.int32), np.array([floor])  # the weight of an unseen character
        else:
            total = np.bincount(ctx[x], weights=count, minlength=size)
            kinds = np.bincount(ctx[x], minlength=size)
            contexts = np.flatnonzero(kinds).astype(np.int32)
            gamma = np.ones(size)
            gamma[contexts] = d * kinds[contexts] / total[contexts]
            p = np.maximum(count - d, 0) / total[ctx[x]] + gamma[ctx[x]] * lower[suf[x]]
            weight = gamma[contexts]
        lower = np.full(size, floor)
        lower[slot[x]] = p
        out.append((slot[x], np.log(p).astype(np.float32), contexts, np.log(weight).astype(np.float32)))
    return out


def _score_places(own: list[np.ndarray], model: list, bits: int, tables: list) -> np.ndarray:
    """Log probability of each character, from dense views of the sorted arrays."""
    lp = tables[0][0][own[0]]
    for k in range(1, len(own)):
        seen, gamma = tables[k]
        direct = seen[own[k][k:]]
        back = gamma[own[k - 1][k - 1:-1]] + lp[k:]
        lp[k:] = np.where(np.isnan(direct), back, direct)
    return lp


def _dense(model: list, bits: int) -> list:
    out = []
    for k, (slot, lp, contexts, weight) in enumerate(model):
        seen = np.full(1 << bits, weight[0] if k == 0 else np.nan, np.float32)
        seen[slot] = lp
        gamma = np.zeros(1 << bits, np.float32)
        if k:
            gamma[contexts] = weight
        out.append((seen, gamma))
    return out


def probabilities(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """lang, m, kind, slot, value: log probabilities (kind 0) by n-gram, log back-off weights (kind 1) by
    context; and lang, floor: the log probability of an unseen character."""
    before = counts.where("m > 1").groupBy("lang", (F.col("m") - 1).alias("m"), F.col("suf").alias("slot")).agg(
        F.count(F.lit(1)).alias("before"))  # continuation counts: how many different characters stand before
    rows = counts.join(before, ["lang", "m", "slot"], "left").select(
        "lang", "m", "slot", "ctx", "suf", F.when(F.col("m") == order, F.col("n")).otherwise(F.coalesce("before", F.lit(1))).alias("n"))
    rows = scratch(rows, "langid-rows")
    one = lambda k: F.sum((F.col("n") == k).cast("long"))
    rate = F.when(one(1) > 0, one(1) / (one(1) + 2.0 * one(2))).otherwise(F.lit(0.5))
    rates = rows.groupBy("lang", "m").agg(F.least(F.greatest(rate, F.lit(0.1)), F.lit(0.9)).alias("d"),
                                          F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    floor = F.col("d") * F.col("kinds") / F.col("total") / (F.col("kinds") + 1.0)
    rates = scratch(rates.withColumn("floor", floor), "langid-rates")
    share = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
    lower = rows.where("m = 1").join(rates.where("m = 1").drop("m"), "lang").select("lang", "slot", (share + F.col("floor")).alias("p"))
    lower = scratch(lower, "langid-p")
    entry = lambda t, m, kind, value: t.select(
        "lang", F.lit(m).alias("m"), F.lit(kind).alias("kind"), "slot", F.log(value).cast("float").alias("value"))
    out = entry(lower, 1, 0, "p")
    for m in range(2, order + 1):
        own = rows.where(F.col("m") == m).drop("m")
        gamma = own.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        gamma = gamma.join(rates.where(F.col("m") == m).select("lang", "d"), "lang").select(
            "lang", "ctx", "total", "d", (F.col("d") * F.col("kinds") / F.col("total")).alias("gamma"))
        gamma = scratch(gamma, "langid-gamma")
        # every suffix of a counted n-gram is counted itself
        lower = own.join(gamma, ["lang", "ctx"]).join(lower.select("lang", F.col("slot").alias("suf"), F.col("p").alias("less")), ["lang", "suf"])
        lower = scratch(lower.select("lang", "slot", (share + F.col("gamma") * F.col("less")).alias("p")), "langid-p")
        out = out.union(entry(lower, m, 0, "p")).union(entry(gamma.withColumnRenamed("ctx", "slot"), m, 1, "gamma"))
    return out, rates.where("m = 1").select("lang", F.log("floor").alias("floor"))


_FILES = "lang string, m int, kind int, part int, name string, rows long"


def _writer(root: str):
    """A file per language, order, kind and key range: the sorted keys, then their values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        key, parts = None, []

        def settle():
            name = uuid.uuid4().hex
            store.create_dir(base, recursive=True)
            slot, value = (np.concatenate([x[i] for x in parts]) for i in (0, 1))
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(slot.astype("<i8").tobytes())
                out.write(value.astype("<f4").tobytes())
            return pa.RecordBatch.from_pydict({"lang": [key[0]], "m": pa.array([key[1]], pa.int32()), "kind": pa.array([key[2]], pa.int32()),
                                               "part": pa.array([key[3]], pa.int32()), "name": [name], "rows": [len(slot)]})

        for batch in batches:
            if not batch.num_rows:
                continue
            lang = batch.column(0).dictionary_encode()
            marks = np.stack([lang.indices.to_numpy(), *(batch.column(i).to_numpy() for i in (1, 2, 3))])
            cuts = np.flatnonzero((np.diff(marks, axis=1) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                now = (lang.dictionary[int(marks[0, a])].as_py(), *(int(x) for x in marks[1:, a]))
                if now != key and parts:
                    yield settle()
                    parts = []
                key = now
                parts.append((batch.column(4).to_numpy()[a:b], batch.column(5).to_numpy()[a:b]))
        if parts:
            yield settle()
    return lean(run)


def build(counts: DataFrame, order: int, bits: int) -> dict:
    """The model of a count table: its files in the shared folder, and what is known of them."""
    spark = counts.sparkSession
    table, floors = probabilities(counts, order)
    floors = {r["lang"]: r["floor"] for r in floors.collect()}  # a row per language
    root = scratch_path(spark, "langid-model")
    most = counts.groupBy("lang", "m").count().agg(F.max("count")).first()[0] or 0
    ranges = min(1 << 16, -(-most // RANGE_ROWS) or 1)
    part = F.floor((F.shiftright("slot", 48) + (1 << 15)) * ranges / (1 << 16)).cast("int")
    key = ["lang", "m", "kind", "part"]
    table = table.withColumn("part", part).select(*key, "slot", "value").repartition(*key).sortWithinPartitions(*key, "slot")
    files = scratch(table.mapInArrow(_writer(root), _FILES), "langid-files").collect()  # a row per file
    names = sorted(floors)
    return {"languages": names, "floors": [floors[x] for x in names], "root": root, "order": order, "bits": bits,
            "files": {(r["lang"], r["m"], r["kind"], r["part"]): (r["name"], r["rows"]) for r in files},
            "ranges": ranges, "confidence": (8.0, 0.0), "limits": [float("inf")] * len(names)}


class Lookup:
    """Reads a model's files; the ones read last are kept up to CACHE_BYTES."""

    def __init__(self, model: dict):
        self.model = model
        self.kept: OrderedDict = once(("langid-files",), OrderedDict)

    def load(self, name: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
        if name in self.kept:
            self.kept.move_to_end(name)
            return self.kept[name]
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.model["root"])
        with store.open_input_file(f"{base}/{name}") as file:
            raw = file.read()
        own = np.frombuffer(raw, "<i8", rows), np.frombuffer(raw, "<f4", rows, 8 * rows)
        self.kept[name] = own
        while len(self.kept) > 1 and 12 * sum(len(x[0]) for x in self.kept.values()) > CACHE_BYTES:
            self.kept.popitem(last=False)
        return own

    def values(self, lang: str, m: int, kind: int, keys: np.ndarray, default: float) -> np.ndarray:
        """The values of sorted keys."""
        out = np.full(len(keys), default, np.float32)
        ranges = self.model["ranges"]
        if ranges == 1:
            cuts = [0, len(keys)]
        else:
            part = ((keys >> 48) + (1 << 15)) * ranges // (1 << 16)
            cuts = np.searchsorted(part, np.arange(ranges + 1)).tolist()
        for r in range(ranges):
            file, (a, b) = self.model["files"].get((lang, m, kind, r)), cuts[r:r + 2]
            if file is None or a == b:
                continue
            slot, value = self.load(*file)
            at = np.minimum(np.searchsorted(slot, keys[a:b]), len(slot) - 1)
            out[a:b] = np.where(slot[at] == keys[a:b], value[at], out[a:b])
        return out


def cross_entropies(texts: list[bytes | None], model: dict, letters: np.ndarray) -> np.ndarray:
    """texts x languages, nats per character; NaN where a text has no letter."""
    order, bits, lookup = model["order"], model["bits"], Lookup(model)
    out = np.full((len(texts), len(model["languages"])), np.nan)
    total = np.zeros_like(out)
    pieces: list[tuple[int, int, list[np.ndarray]]] = []
    size = 0

    def settle():
        """Adds the log probabilities of the pieces to their texts' totals."""
        if not pieces:
            return
        lengths = [len(own[0]) for _, _, own in pieces]
        place = np.concatenate([np.arange(n) for n in lengths])
        owner = np.repeat([i for i, _, _ in pieces], lengths)
        counted = place >= np.repeat([skip for _, skip, _ in pieces], lengths)
        keys, at = [], []
        for m in range(order):
            found, index = _distinct(np.concatenate([own[m] for _, _, own in pieces]))
            rank = np.argsort(found)
            back = np.empty(len(rank), np.int64)
            back[rank] = np.arange(len(rank))
            keys.append(found[rank])
            at.append(back[index])
        pieces.clear()
        rows, owner = np.unique(owner, return_inverse=True)
        for k, lang in enumerate(model["languages"]):
            lp = lookup.values(lang, 1, 0, keys[0], model["floors"][k])[at[0]]
            for m in range(1, order):
                direct = lookup.values(lang, m + 1, 0, keys[m], np.nan)[at[m]]
                weight = lookup.values(lang, m + 1, 1, keys[m - 1], 0.0)[at[m - 1]]
                longer = np.where(np.isnan(direct[1:]), weight[:-1] + lp[1:], direct[1:])
                lp[1:] = np.where(place[1:] >= m, longer, lp[1:])
            total[rows, k] += np.bincount(owner, np.where(counted, lp, 0.0), len(rows))

    for i, text in enumerate(texts):
        codes = characters(text, letters)
        if not codes.any():
            continue
        out[i] = -1.0 / (len(codes) - 1)
        for at in range(0, len(codes) - 1, _AT_ONCE):
            back = min(at, order - 1)
            pieces.append((i, 1 if at == 0 else back + 1, slots(codes[at - back:at + _AT_ONCE + 1], order, bits)))
            size += len(pieces[-1][2][0])
            if size >= 2 * _AT_ONCE:
                settle()
                size = 0
    settle()
    return out * total


def decide(xent: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its cross-entropy, confidence and rejection of each row of cross-entropies."""
    best = np.argmin(np.where(np.isnan(xent), np.inf, xent), axis=1)
    rows = np.arange(len(xent))
    least = xent[rows, best]
    if xent.shape[1] > 1:
        rest = xent.copy()
        rest[rows, best] = np.inf
        margin = rest.min(axis=1) - least
    else:
        margin = np.ones(len(xent))
    a, b = model["confidence"]
    score = 1.0 / (1.0 + np.exp(-np.clip(a * margin + b, -30, 30)))
    return best, least, score, least > np.asarray(model["limits"])[best]


def _scorer(broadcast, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = broadcast.value, letter_table()
        names = model["languages"]
        for batch in slices(batches):
            texts = list(binaries(batch, "__text"))
            none = np.array([True] * len(texts))
            if names:
                xent = cross_entropies(texts, model, letters)
                none = np.isnan(xent).any(axis=1)
                best, least, score, out_of = decide(xent, model)
                cols = [pa.array([UNDETERMINED if u else names[b] for u, b in zip(none, best)], pa.string()),
                        pa.array(np.where(none, 0.0, score)), pa.array(least, mask=none), pa.array(none | out_of)]
            else:
                cols = [pa.array([UNDETERMINED] * len(texts), pa.string()), pa.array(np.zeros(len(texts))),
                        pa.nulls(len(texts), pa.float64()), pa.array(none)]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, *cols],
                                             [*kept, "__lang", "__score", "__xent", "__rejected"])
    return lean(run)


def fold(id_col: str, folds: int = FOLDS):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def _logistic(scored: DataFrame, ridge: float = 1e-2) -> tuple[float, float] | None:
    """Slope and offset of a ridge logistic fit of `right` on `margin`, by Newton steps whose sums Spark adds up; None without rows."""
    x, y = F.col("margin"), F.col("right").cast("double")
    p, weight = F.col("p"), F.col("p") * (1 - F.col("p"))
    w, step, best = np.zeros(2), np.zeros(2), -np.inf
    for _ in range(50):
        z = F.least(F.greatest(F.lit(float(w[0])) * x + F.lit(float(w[1])), F.lit(-30.0)), F.lit(30.0))
        rows = scored.select(x, y.alias("y"), (1.0 / (1.0 + F.exp(-z))).alias("p"))
        likely = F.log(F.when(F.col("y") == 1, p).otherwise(1 - p))
        g0, g1, h00, h01, h11, fit = rows.agg(F.sum((F.col("y") - p) * x), F.sum(F.col("y") - p), F.sum(weight * x * x),
                                              F.sum(weight * x), F.sum(weight), F.sum(likely)).first()
        if fit is None:
            return None
        fit -= ridge / 2 * float(w @ w)
        if fit < best - 1e-9 * abs(best):  # the step was too long
            step = step / 2
            w = w - step
            continue
        best = fit
        step = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + ridge * np.eye(2), np.array([g0, g1]) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _limits(scored: DataFrame) -> dict[str, float]:
    """Per language of 20 rightly told texts or more, the cross-entropy beyond which one doesn't look like it."""
    ranked = value_ranks(scored.where("right"), "lang", "xent").where("total >= 20")
    place = (F.lit(REJECT_QUANTILE) * (F.col("total") - 1)).alias("place")
    around = ranked.withColumn("place", place).where((F.col("below") + F.col("n") > F.floor("place")) & (
        F.col("below") <= F.least(F.floor("place") + 1, F.col("total") - 1)))  # the values at the two ranks beside the place
    ends = around.groupBy("lang").agg(F.min("xent").alias("low"), F.max("xent").alias("high"), F.first("place").alias("place"))
    return {r["lang"]: (r["low"] + (r["high"] - r["low"]) * (r["place"] % 1)) * 1.1 for r in ends.collect()}  # a row per language


def count(rows: DataFrame, order: int, bits: int) -> DataFrame:
    """lang, m, slot, ctx, suf, n: the n-grams of the rows' texts."""
    counted = rows.select("lang", "text").mapInArrow(_count(order, bits), "lang string, m int, slot long, ctx long, suf long, n long")
    table = counted.groupBy("lang", "m", "slot").agg(F.min("ctx").alias("ctx"), F.min("suf").alias("suf"), F.sum("n").alias("n"))
    return scratch(table, "langid-counts")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          order: int = ORDER, bits: int = BITS) -> dict:
    """The model, from documents with a language outside the held-out fold."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), fold(id_col).alias("fold"),
                       F.col(id_col).cast("string").alias("id"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("fold") != HELD_OUT))
    folded = rows.where(F.col("fold") == CALIBRATION)
    counts = count(rows.where(F.col("fold") != CALIBRATION), order, bits)
    model = build(counts, order, bits)
    names, confidence, limits = model["languages"], model["confidence"], {}
    if names:
        spark = docs.sparkSession
        told = folded.groupBy("id").agg(F.min(F.struct("lang", "text")).alias("s"))  # one row per id
        scored = told.select("s.lang", F.col("s.text").alias("__text")).mapInArrow(
            _calibrate(spark.sparkContext.broadcast(model)), "lang string, best string, margin double, xent double")
        scored = scratch(scored.select("lang", (F.col("lang") == F.col("best")).alias("right"), "margin", "xent"), "langid-scored")
        confidence, limits = _logistic(scored) or confidence, _limits(scored)
    # counts are sums: the calibration fold joins them once it has calibrated
    both = counts.union(count(folded, order, bits)).groupBy("lang", "m", "slot").agg(
        F.min("ctx").alias("ctx"), F.min("suf").alias("suf"), F.sum("n").alias("n"))
    model = build(scratch(both, "langid-all"), order, bits)
    return model | {"confidence": confidence, "limits": [limits.get(x, float("inf")) for x in model["languages"]]}


def _calibrate(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = broadcast.value, letter_table()
        for batch in slices(batches):
            xent = cross_entropies(list(binaries(batch, "__text")), model, letters)
            ok = ~np.isnan(xent).any(axis=1)
            xent = xent[ok]
            order = np.sort(xent, axis=1)
            margin = order[:, 1] - order[:, 0] if xent.shape[1] > 1 else np.ones(len(xent))
            best = [model["languages"][k] for k in np.argmin(xent, axis=1)] if len(xent) else []
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), pa.array(best, pa.string()), pa.array(margin),
                                              pa.array(order[:, 0])], ["lang", "best", "margin", "xent"])
    return lean(run)


def identify(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default: all) plus lang_pred, score, cross_entropy, rejected."""
    keep = without(docs.columns if keep is None else keep, "lang_pred", "score", "cross_entropy", "rejected")
    names = [f"k{i}" for i in range(len(keep))]  # the columns' own names may clash
    src = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("__text"))
    schema = T.StructType([*src.drop("__text").schema.fields, T.StructField("__lang", T.StringType()),
                           T.StructField("__score", T.DoubleType()), T.StructField("__xent", T.DoubleType()),
                           T.StructField("__rejected", T.BooleanType())])
    out = src.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model), names), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], F.col("__lang").alias("lang_pred"),
                      F.col("__score").alias("score"), F.col("__xent").alias("cross_entropy"),
                      F.col("__rejected").alias("rejected"))
