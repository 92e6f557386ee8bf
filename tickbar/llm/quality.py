"""Quality classifier by co-training two views of a document.

The text view sees which words and symbol runs a document has; the metadata view sees its
source, language and layout figures (length, lines, shares of letters, digits, symbols,
distinct words ...).  Per target, each view has a logistic model.  In every round each
view labels the unlabelled documents it is sure of, and these pseudo-labels join the
other view's training rows.  At the end each view is calibrated on labelled rows that were
never trained on, and a logistic model of both calibrated views gives the score.

The labelled rows are a bounded sample (about TRAIN_ROWS, the smallest by hash of the id) that keeps as
many rows of every class as fit; a row counts by the inverse of its class's share.  All unlabelled
documents take part: their features are a table, and in each round Spark sums per term how many of
them each class has, for the choice of terms, and the sums of the Newton steps.  Pseudo-labels
of a class weigh at most PSEUDO_WEIGHT of its labelled rows together.

Targets are columns of the labels table; `bad` names those where 1 is the bad value.  A document
is kept if no target finds it more likely bad than good.

Defined results: null and empty texts are scored from the metadata and an empty word set; null
labels are skipped; of repeated labels of an id the worst counts; a target with one class only, or no
labels, rejects nothing; repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, hash_sample, lean, lower_ascii, release, scratch, slices, without, word_hashes

TRAIN_ROWS = 12_000
ROUNDS = 3
STEPS, LAST_STEPS = 2, 4  # Newton steps over the unlabelled documents in a round (from the last one's weights), and in the last
MAX_TERMS = 512          # terms of the text view's model
MIN_CHI2, MIN_DOCS = 20.0, 5
SURE = 0.99              # a view teaches the other what it holds at least this likely
PSEUDO_WEIGHT = 0.5
RIDGE = 0.05
BUCKETS = 32             # hash buckets of source and of language
CALIBRATION_SHARE = 4    # one labelled row in so many calibrates

TERM_BYTES = 4           # a term is named by a hash of so many bytes (of 10**7 terms some 10**4 share one with another)

_CLASS = np.zeros(256, np.int8)  # 0 space, 1 letters and digits and all beyond ASCII, 2 ASCII symbols
_CLASS[33:127] = 2
_CLASS[128:] = 1
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = 1


def terms(text: bytes) -> np.ndarray:
    """Hashes (TERM_BYTES long) of the runs of letters and of symbols, in order, A-Z in lower case."""
    low = lower_ascii(text)
    kind = _CLASS[np.frombuffer(low, np.uint8)]
    edge = np.flatnonzero(np.diff(kind)) + 1
    starts = np.concatenate((np.zeros(min(1, len(kind)), np.int64), edge))
    ends = np.concatenate((edge, np.full(min(1, len(kind)), len(kind))))
    real = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    return word_hashes(low, starts[real], ends[real]) >> np.uint64(64 - 8 * TERM_BYTES)


def packed(own: np.ndarray) -> bytes:
    """Terms as bytes; the features of all documents are written and shuffled in this form."""
    return own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TERM_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // TERM_BYTES, 8), np.uint8)
    out[:, :TERM_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TERM_BYTES)
    return out.view("<i8").ravel()


def layout(text: bytes, words: np.ndarray, n_chars: int | None) -> list[float]:
    """Figures of the metadata view."""
    data = np.frombuffer(text, np.uint8)
    n = max(len(data), 1)
    kind = np.bincount(_CLASS[data], minlength=3)
    counts = np.unique(words, return_counts=True)[1] if len(words) else np.zeros(1, np.int64)
    lines = int((data == 10).sum()) + 1
    total = max(len(words), 1)
    chars = int(((data & 0xC0) != 0x80).sum())
    return [np.log1p(len(data)), np.log1p(lines), np.log1p(n / lines), np.log1p(n / total), kind[0] / n, kind[2] / n,
            ((data >= 65) & (data <= 90)).sum() / n, ((data >= 48) & (data <= 57)).sum() / n, (data >= 128).sum() / n,
            len(counts) / total, counts.max() / total, np.log1p(total),
            1.0 if n_chars is None else min(abs(n_chars - chars) / n, 1.0)]


N_LAYOUT = 13


def metadata(text: bytes, words: np.ndarray, source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(N_LAYOUT + 2 * BUCKETS, np.float32)
    out[:N_LAYOUT] = layout(text, words, n_chars)
    for k, value in enumerate((source, lang)):
        if value is not None:
            out[N_LAYOUT + k * BUCKETS + xxhash.xxh64_intdigest(value.encode()) % BUCKETS] = 1.0
    return out


def _features(columns: list[str]):
    """Rows of (columns ..., terms, figures)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, figures = [], []
            meta = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__source", "__lang", "__chars")))
            for text, (source, lang, chars) in zip(binaries(batch, "__text"), meta):
                words = terms(text or b"")
                figures.append(metadata(text or b"", words, source, lang, chars))
                found.append(packed(np.unique(words)))
            width = N_LAYOUT + 2 * BUCKETS
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, pa.array(found, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(figures) + 1) * width, pa.int32()),
                                          pa.array(np.concatenate([np.zeros(0, np.float32), *figures])))], [*columns, "terms", "figures"])
    return lean(run)


def _views(docs: DataFrame, keep: list, text_col: str, source_col: str, lang_col: str, chars_col: str) -> DataFrame:
    return docs.select(*keep, F.col(text_col).alias("__text"), F.col(source_col).cast("string").alias("__source"),
                       F.col(lang_col).cast("string").alias("__lang"), F.col(chars_col).cast("long").alias("__chars"))


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The Hessian of the loss, and as last column the gradient of the likelihood."""
    n = x.shape[1] + 1
    out = np.zeros((n, n + 1))
    for at in range(0, len(x), 2048):  # pieces, so that no second copy of the rows is made
        part = np.ones((len(x[at:at + 2048]), n), np.float32)
        part[:, :-1] = x[at:at + 2048]
        p, own = _chance(part @ w), weight[at:at + 2048]
        out[:, -1] += part.T @ (own * (y[at:at + 2048] - p))
        out[:, :-1] += (part * (own * p * (1 - p)).astype(np.float32)[:, None]).T @ part
    return out


def _newton(sums: np.ndarray, w: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """The weights after a step, and the largest change."""
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-4
    step = np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1] - penalty * w)
    most = float(np.abs(step).max())
    return w + step * min(1.0, 5.0 / max(most, 1e-12)), most


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the offset."""
    w = np.zeros(x.shape[1] + 1)
    for _ in range(25):
        w, most = _newton(_sums(x, y, weight, w), w, ridge)
        if most < 1e-6:
            break
    return w


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def _term_counts(lists: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> tuple:
    """The distinct terms, how many rows have each, and the weight of these rows by class."""
    flat = np.concatenate([*lists, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    vocabulary, index = np.unique(flat, return_inverse=True)
    n = np.bincount(index, minlength=len(vocabulary))
    both = [np.bincount(index, (weight * (y == c))[owner], len(vocabulary)) for c in (0, 1)]
    return vocabulary, n, *both


def _calibrates(ids: list) -> np.ndarray:
    """Which labelled rows calibrate and are never trained on."""
    return np.array([xxhash.xxh64_intdigest(str(i)) % CALIBRATION_SHARE == 0 for i in ids], bool)


def _told_terms(targets: list[str]):
    """target, term, n, zero, one over the training rows of the labelled sample; weights are whole millionths, so sums are exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            trains = ~_calibrates(column["__id"].to_pylist())
            weight = np.rint(1e6 / column["__share"].to_numpy())
            for t, name in enumerate(targets):
                y = column[name].fill_null(-1).to_numpy(zero_copy_only=False)
                use = np.flatnonzero((y >= 0) & trains)
                found = _term_counts([unpacked(column["terms"][i].as_py()) for i in use], y[use], weight[use])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), t, np.int32)), *(pa.array(x.astype(np.int64)) for x in found)],
                                                 ["target", "term", "n", "zero", "one"])
    return lean(run)


def _best_terms(counts: DataFrame, total: float, positive: float) -> np.ndarray:
    """The terms that tell the classes apart best by chi-square, sorted (at most MAX_TERMS).

    counts: term, n, zero, one (weights of the rows that have the term, by class).
    """
    df, share = F.col("zero") + F.col("one"), positive / total
    spread = F.greatest(df * share * (1 - share) * (1 - df / total), F.lit(1e-9))
    chi2 = F.pow(F.col("one") - df * share, F.lit(2.0)) / spread
    good = counts.where(F.col("n") >= MIN_DOCS).select("term", chi2.alias("chi2")).where(F.col("chi2") >= MIN_CHI2)
    top = good.orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).toArrow()
    return np.sort(top.column("term").to_numpy()).astype(np.int64)


def presence(lists: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lists), len(vocabulary)), np.float32)
    if len(vocabulary):
        for i, own in enumerate(lists):
            at = np.searchsorted(vocabulary, own)
            at[at == len(vocabulary)] = 0
            out[i, at[vocabulary[at] == own]] = 1.0
    return out


def _scaled(figures: np.ndarray, model: dict) -> np.ndarray:
    return np.clip((figures - model["mean"]) / np.maximum(model["spread"], 1e-3), -8, 8)


def _pool_rows(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    terms = [unpacked(x.as_py()) for x in batch.column(batch.schema.get_field_index("terms"))]
    flat = batch.column(batch.schema.get_field_index("figures")).flatten().to_numpy()
    return terms, flat.reshape(batch.num_rows, N_LAYOUT + 2 * BUCKETS)


def _lessons(model: dict, lists: list, figures: np.ndarray, opened: np.ndarray) -> list[np.ndarray]:
    """Per view, the labels that the other view is sure of (else -1), of rows without a label."""
    margins = _margin(presence(lists, model["vocabulary"]), model["text"]), _margin(_scaled(figures, model), model["figures"])
    sure = [np.where(c >= SURE, 1, np.where(c <= 1 - SURE, 0, -1)) for c in map(_chance, margins)]
    return [np.where(opened, sure[1 - v], -1) for v in (0, 1)]


def _taught_terms(broadcast):
    """target, view, term, zero, one: taught rows by class, in all (term null) and for the text view by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = broadcast.value
        totals = np.zeros((len(models), 2, 2), np.int64)
        for batch in slices(batches, 4096):
            lists, figures = _pool_rows(batch)
            for t, (name, model) in enumerate(models.items()):
                if model is None:
                    continue
                opened = batch.column(batch.schema.get_field_index(f"open_{name}")).to_numpy(zero_copy_only=False)
                taught = _lessons(model, lists, figures, opened)
                for v in (0, 1):
                    totals[t, v] += np.bincount(taught[v][taught[v] >= 0], minlength=2)
                use = np.flatnonzero(taught[0] >= 0)
                own, _, zero, one = _term_counts([lists[i] for i in use], taught[0][use], np.ones(len(use)))
                yield _term_rows(t, 0, own, zero, one)
        for t in range(len(models)):
            for v in (0, 1):
                yield _term_rows(t, v, None, totals[t, v, :1], totals[t, v, 1:])
    return lean(run)


def _term_rows(t: int, v: int, own, zero, one) -> pa.RecordBatch:
    n = len(zero)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, v, np.int32)), pa.nulls(n, pa.int64()) if own is None else pa.array(own),
         pa.array(np.asarray(zero, np.int64)), pa.array(np.asarray(one, np.int64))], ["target", "view", "term", "zero", "one"])


def _pool_sums(broadcast):
    """target, view, at, sums: the rows of `_sums` over the taught rows of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teachers, students, weights = broadcast.value
        out: dict[tuple[int, int], np.ndarray] = {}
        for batch in slices(batches, 2048):
            lists, figures = _pool_rows(batch)
            for t, (name, teacher) in enumerate(teachers.items()):
                if teacher is None:
                    continue
                student = students[name]
                opened = batch.column(batch.schema.get_field_index(f"open_{name}")).to_numpy(zero_copy_only=False)
                for v, taught in enumerate(_lessons(teacher, lists, figures, opened)):
                    use = np.flatnonzero(taught >= 0)
                    x = presence([lists[i] for i in use], student["vocabulary"]) if v == 0 else _scaled(figures[use], student)
                    own = _sums(x, taught[use], weights[name][v][taught[use]], student[("text", "figures")[v]])
                    out[t, v] = out[t, v] + own if (t, v) in out else own
        for (t, v), own in out.items():
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, v, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                 pa.array(own.tolist(), pa.list_(pa.float64()))], ["target", "view", "at", "sums"])
    return lean(run)


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key of the partition, its sums added up."""
    held: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for *key, own in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            own = own.values.to_numpy()
            held[tuple(key)] = held[tuple(key)] + own if tuple(key) in held else own
    if held:
        keys = np.array(list(held), np.int32)
        yield pa.RecordBatch.from_arrays([*(pa.array(keys[:, i]) for i in range(3)), pa.array([x.tolist() for x in held.values()], pa.list_(pa.float64()))],
                                         ["target", "view", "at", "sums"])


def co_train(pool: DataFrame, told: DataFrame, lists: list[np.ndarray], figures: np.ndarray, labels: dict[str, np.ndarray],
             weights: np.ndarray, calibrate: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Models of both views per target; labels: 1, 0, or -1 (none).  None without two classes.

    pool: terms, figures and open_<target> (without that label) of all other documents.
    told: the counts of `_told_terms` (the driver holds the labelled rows, but not the counts of all their terms).
    """
    spark = pool.sparkSession
    local, models = {}, {}
    for t, y in labels.items():
        known = np.flatnonzero((y >= 0) & ~calibrate)
        models[t] = None
        if len(set(y[known].tolist())) < 2:
            continue
        own = [lists[i] for i in known]
        mean = float(weights[known].mean())
        w = weights[known] / mean
        model = {"mean": figures[known].mean(axis=0), "spread": figures[known].std(axis=0)}
        frame = told.where(F.col("target") == list(labels).index(t)).select("term", "n", *[(F.col(c) / (1e6 * mean)).alias(c) for c in ("zero", "one")])
        model["vocabulary"] = _best_terms(frame, w.sum(), w[y[known] == 1].sum())
        local[t] = known, own, y[known], w, frame
        model["text"] = _fit(presence(own, model["vocabulary"]), y[known], w)
        model["figures"] = _fit(_scaled(figures[known], model), y[known], w)
        models[t] = model
    names = list(models)
    for turn in range(rounds if local else 0):
        counts = pool.mapInArrow(_taught_terms(spark.sparkContext.broadcast(models)), "target int, view int, term long, zero long, one long")
        counts = scratch(counts.groupBy("target", "view", "term").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")), "quality-terms")
        totals = {(r["target"], r["view"]): (r["zero"], r["one"]) for r in counts.where("term is null").collect()}
        students, shares = {}, {}
        for t, (known, own, y, w, frame) in local.items():
            k, model = names.index(t), models[t]
            mass = [w[y == c].sum() for c in (0, 1)]
            share = shares[t] = [PSEUDO_WEIGHT * np.array([min(1.0, mass[c] / max(totals.get((k, v), (0, 0))[c], 1)) for c in (0, 1)]) for v in (0, 1)]
            told = counts.where((F.col("target") == k) & F.col("term").isNotNull()).select(
                "term", (F.col("zero") + F.col("one")).alias("n"), (F.col("zero") * float(share[0][0])).alias("zero"), (F.col("one") * float(share[0][1])).alias("one"))
            both = told.union(frame).groupBy("term").agg(*[F.sum(c).alias(c) for c in ("n", "zero", "one")])
            extra = share[0] * np.array(totals.get((k, 0), (0, 0)))
            vocabulary = _best_terms(both, w.sum() + extra.sum(), mass[1] + extra[1])
            text = np.zeros(len(vocabulary) + 1)
            text[-1] = model["text"][-1]
            _, new, old = np.intersect1d(vocabulary, model["vocabulary"], return_indices=True)
            text[new] = model["text"][old]
            students[t] = model | {"vocabulary": vocabulary, "text": text}
        for _ in range(LAST_STEPS if turn + 1 == rounds else STEPS):
            found = pool.mapInArrow(_pool_sums(spark.sparkContext.broadcast((models, {t: students.get(t) for t in names}, shares))),
                                    "target int, view int, at int, sums array<double>")
            found = found.repartition("target", "view", "at").mapInArrow(lean(_add_rows), found.schema).toArrow().sort_by("at")
            rows: dict = {}
            for k, v, own in zip(found.column("target").to_pylist(), found.column("view").to_pylist(), found.column("sums")):
                rows.setdefault((k, v), []).append(own.values.to_numpy())
            most = 0.0
            for t, (known, own, y, w, _frame) in local.items():
                student = students[t]
                for v, view in enumerate(("text", "figures")):
                    x = presence(own, student["vocabulary"]) if v == 0 else _scaled(figures[known], student)
                    sums = _sums(x, y, w, student[view])
                    if (names.index(t), v) in rows:
                        sums = sums + np.array(rows[names.index(t), v])
                    student[view], step = _newton(sums, student[view], RIDGE)
                    most = max(most, step)
            if most < 1e-3:
                break
        models = {t: students.get(t) for t in names}
    for t, model in models.items():
        if model is None:
            continue
        y = labels[t]
        use = np.flatnonzero((y >= 0) & calibrate)
        if len(set(y[use].tolist())) < 2:
            use = local[t][0]
        margins = np.stack([_margin(presence([lists[i] for i in use], model["vocabulary"]), model["text"]),
                            _margin(_scaled(figures[use], model), model["figures"])], axis=1).clip(-30, 30)
        w = weights[use] / weights[use].mean()
        model["platt"] = [_fit(margins[:, v:v + 1], y[use], w, 1e-2) for v in (0, 1)]
        calibrated = np.stack([_margin(margins[:, v:v + 1], model["platt"][v]) for v in (0, 1)], axis=1)
        model["joint"] = _fit(calibrated, y[use], w, 1e-2)
    return models


def chances(model: dict | None, lists: list[np.ndarray], figures: np.ndarray) -> np.ndarray:
    """Probability of value 1 of a target."""
    if model is None:
        return np.zeros(len(lists))
    scaled = np.clip((figures - model["mean"]) / np.maximum(model["spread"], 1e-3), -8, 8)
    margins = (_margin(presence(lists, model["vocabulary"]), model["text"]), _margin(scaled, model["figures"]))
    calibrated = np.stack([_margin(np.clip(m, -30, 30)[:, None], p) for m, p in zip(margins, model["platt"])], axis=1)
    return _chance(_margin(calibrated, model["joint"]))


def class_shares(groups: list[tuple[tuple, int]], most: int) -> list[dict]:
    """Per target, the share of each class that a sample takes: the rarest whole, the others alike in number.

    groups: how often each combination of labels occurs; the sample has about `most` rows.
    """
    sizes = [{c: sum(n for own, n in groups if own[k] == c) for c in (0, 1)} for k in range(len(groups[0][0]) if groups else 0)]
    low, high = 0.0, float(sum(n for _, n in groups))
    for _ in range(60):
        cap = high if _ == 0 else (low + high) / 2
        shares = [{c: min(1.0, cap / max(n, 1)) for c, n in own.items()} for own in sizes]
        if sum(n * max((s.get(c, 0.0) for s, c in zip(shares, own)), default=0.0) for own, n in groups) <= most:
            low = cap
        else:
            high = cap
    return [{c: min(1.0, low / max(n, 1)) for c, n in own.items()} for own in sizes]


def fit(docs: DataFrame, labels: DataFrame, targets: dict[str, int], id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars", train_rows: int = TRAIN_ROWS,
        pool_rows: int | None = None, rounds: int = ROUNDS) -> dict:
    """Models per target; `targets` maps a label column to its bad value (0 or 1).

    pool_rows: a bound of the unlabelled documents, if the caller wants one.
    """
    worst = [(F.max if bad else F.min)(F.col(t).cast("int")).alias(t) for t, bad in targets.items()]
    told = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(*worst)
    told = told.where(F.coalesce(*targets).isNotNull())
    ids = docs.select(F.col(id_col).alias("__id")).where(F.col("__id").isNotNull())
    told = scratch(told.join(ids, "__id", "left_semi"), "quality-told")
    groups = [(tuple(r[t] for t in targets), r["count"]) for r in told.groupBy(*targets).count().collect()]  # few classes
    share = [F.lit(0.0)] * 2
    for t, own in zip(targets, class_shares(groups, train_rows)):
        share += [F.when(F.col(t) == c, F.lit(x)).otherwise(F.lit(0.0)) for c, x in own.items()]
    slot = F.pmod(F.xxhash64(F.lit(17), "__id"), F.lit(1 << 40))
    chosen = told.withColumn("__share", F.greatest(*share)).where(slot < F.col("__share") * (1 << 40))  # about train_rows
    src = _views(docs, [F.col(id_col).alias("__id")], text_col, source_col, lang_col, chars_col)
    view, cols = ["__text", "__source", "__lang", "__chars"], ["__id", *targets, "__share"]
    some = (src.join(F.broadcast(chosen), "__id").groupBy(*cols)  # one row per id, however often it occurs
            .agg(F.min(F.struct(*view)).alias("view")).select(*cols, *[f"view.{c}" for c in view]))
    made = [T.StructField("terms", T.BinaryType()), T.StructField("figures", T.ArrayType(T.FloatType()))]
    sample = scratch(some.mapInArrow(_features(cols), T.StructType([*some.select(*cols).schema.fields, *made])), "quality-sample")
    terms_told = sample.mapInArrow(_told_terms(list(targets)), "target int, term long, n long, zero long, one long")
    terms_told = scratch(terms_told.groupBy("target", "term").agg(*[F.sum(c).alias(c) for c in ("n", "zero", "one")]), "quality-told-terms")
    rows = sample.toArrow().sort_by("__id")
    lists = [unpacked(x.as_py()) for x in rows.column("terms")]
    figures = np.array([x.values.to_numpy() for x in rows.column("figures")], np.float32).reshape(len(lists), N_LAYOUT + 2 * BUCKETS)
    part = _calibrates(rows.column("__id").to_pylist())
    weights = 1.0 / rows.column("__share").to_numpy()
    known = {t: np.array([-1 if v is None else v for v in rows.column(t).to_pylist()], np.int64) for t in targets}
    del rows
    if pool_rows is not None:
        few = hash_sample(ids.join(told, "__id", "left_anti").distinct(), pool_rows, "__id")
        src = src.join(F.broadcast(few), "__id", "left_semi")
    if not len(lists):
        return {t: None for t in targets}
    pool = src.mapInArrow(_features(["__id"]), T.StructType([src.schema["__id"], *made])).join(told, "__id", "left")
    opened = [F.col(t).isNull().alias(f"open_{t}") for t in targets]
    pool = scratch(pool.where(F.greatest(*[F.col(t).isNull() for t in targets], F.lit(False))).select("terms", "figures", *opened), "quality-pool")
    out = co_train(pool, terms_told, lists, figures, known, weights, part, rounds)
    del lists, figures
    release()
    return out


def _scorer(broadcast, targets: dict[str, int], kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = broadcast.value
        wanted = [m["vocabulary"] for m in models.values() if m is not None]
        wanted = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
        for batch in slices(batches):
            meta = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__source", "__lang", "__chars")))
            lists, figures = [], []
            for text, (source, lang, chars) in zip(binaries(batch, "__text"), meta):
                words = terms(text or b"")
                figures.append(metadata(text or b"", words, source, lang, chars))
                own = words.view(np.int64)
                if len(wanted):
                    at = np.searchsorted(wanted, own)
                    at[at == len(wanted)] = 0
                    own = np.unique(own[wanted[at] == own])
                lists.append(own)
            figures = np.array(figures, np.float32)
            found = [chances(models[t], lists, figures) for t in targets]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, *map(pa.array, found)],
                                             [*kept, *[f"__chance_{t}" for t in targets]])
    return lean(run)


def score(docs: DataFrame, models: dict, targets: dict[str, int], text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", chars_col: str = "n_chars", keep: list[str] | None = None, prefix: str = "p_",
          score_col: str = "score", keep_col: str = "keep") -> DataFrame:
    """`keep` columns (default: all) plus p_<target> (probability of 1), the score (probability that the
    document is good by its worst target) and whether it stays."""
    keep = without(docs.columns if keep is None else keep, keep_col, score_col, *[prefix + t for t in targets])
    names = [f"__k{i}" for i in range(len(keep))]
    src = _views(docs, [F.col(c).alias(n) for c, n in zip(keep, names)], text_col, source_col, lang_col, chars_col)
    schema = T.StructType([*src.select(*names).schema.fields,
                           *[T.StructField(f"__chance_{t}", T.DoubleType()) for t in targets]])
    out = src.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(models), targets, names), schema)
    good = [1 - F.col(f"__chance_{t}") if bad else F.col(f"__chance_{t}") for t, bad in targets.items() if models[t] is not None]
    worst = F.least(*good) if len(good) > 1 else good[0] if good else F.lit(1.0)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)],
                      *[F.col(f"__chance_{t}").alias(prefix + t) for t in targets], worst.alias(score_col),
                      (worst >= 0.5).alias(keep_col))
