"""Text operators against brute force on a messy fixture, and their defined edge cases."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F
from tickbar.llm import bpe, langid, mixing, quality, queries, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMOKE = "/root/testdata/sf0.001"


def messy_rows():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["É", "naïve", "日本", "🙂", "Über"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    shared, hot = text(80), text(55)
    rows = [(0, shared), (1, text(30) + "\n" + shared + "\t" + text(30)), (2, shared[: len(shared) // 2]),
            (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "Two Words"), (8, "two words"), (9, "x " * 300),
            (10, "x " * 400), (11, text(6000)), (12, None), (14, text(49)), (15, text(50))]
    rows += [(15, rows[-1][1]), (15, text(120)), (None, shared), (None, text(60)), (None, None)]
    rows += [(20 + i, text(rnd.randrange(5)) + " " + hot + " " + text(rnd.randrange(40))) for i in range(40)]
    rows += [(70 + i, text(200)) for i in range(10)]
    rows += [(90 + i, rows[-1][1]) for i in range(12)]
    base = text(200).split(" ")
    for i in range(30):
        w = list(base)
        w[rnd.randrange(200)] = "edited"
        rows.append((110 + i, " ".join(w)))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s", i, "x", 1, i) for i, (d, t) in enumerate(messy_rows())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, `keep` int, rank int"
    return spark.createDataFrame(rows, schema).repartition(5).checkpoint()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def smaller(a, b):
    return a is not None and (b is None or a < b)


def brute_removed(rows, window=50):
    words = [WORD.findall(t or "") for _, t in rows]
    starts = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            starts.setdefault(tuple(w[i:i + window]), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in starts.items()}
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if smaller(least[tuple(w[i:i + window])], d):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) if not isinstance(x, bool) else (True, x) for x in row)


@pytest.mark.parametrize("per_shard, words_per_task", [(8192, 1 << 19), (2, 300)])
def test_substring_matches_brute_force(docs, per_shard, words_per_task):
    found = substring.find_repeats(docs, per_shard=per_shard, words_per_task=words_per_task)
    cut = substring.remove_repeats(docs, found, keep=["doc_id"], one_space=True)
    got = cut.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256)).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute_removed(messy_rows())))


def removed(docs, **options):
    cut = substring.remove_repeats(docs, substring.find_repeats(docs, **options), keep=["doc_id"], one_space=True)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256)).collect()


def test_words_made_to_collide_are_told_apart(spark):
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    twins = ["".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)]
    found = [substring.word_hashes(w.encode(), np.array([0]), np.array([1024]), seed) for w in twins for seed in (0, 1)]
    assert found[0] == found[2] and found[1] == found[3]  # the words' polynomial hashes are equal under both seeds
    around = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join([*around[:30], w, *around[31:]])) for i, w in enumerate(twins)] + [(7, " ".join([*around[:30], twins[1], *around[31:]]))]
    got = removed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in got} == {0: 0, 1: 0, 7: 60}
    assert sorted(map(key, got)) == sorted(map(key, brute_removed(rows)))


def test_many_texts_without_an_id(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60)) + " " + passage + f" end{i}") for i in range(2000)]
    rows += [(None, rows[0][1])] * 200 + [(None, rows[1][1].replace(" ", "  ")), (5, "start " + passage)]
    got = removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert sorted(map(key, got)) == sorted(map(key, brute_removed(rows)))
    assert {r["n_removed"] for r in got if r["doc_id"] is None} == {60}


def test_substring_keeps_separators_and_columns(spark, docs, none):
    cut = substring.remove_repeats(docs, substring.find_repeats(docs), kept_col="text")
    assert set(cut.columns) == set(docs.columns) | {"n_words", "n_removed"}
    by = {r["n_chars"]: r for r in cut.collect()}
    for i, (_, text) in enumerate(messy_rows()):
        if by[i]["n_removed"] == 0:
            assert by[i]["text"] == text
    one = by[1]["text"]
    assert by[1]["n_removed"] == 80 and "\n" in one and len(WORD.findall(one)) == 60
    assert substring.remove_repeats(none, substring.find_repeats(none)).count() == 0


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, fps, radius=2):
    n = len(ids)
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                up[root(i)] = root(j)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(ids[i])
    least = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [least[root(i)] for i in range(n)]


def test_simhash_matches_brute_force(docs, none):
    rows = messy_rows()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = [(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, brute_components([d for d, _ in rows], fps))]
    got = simhash.near_duplicates(docs)
    assert sorted(map(key, got.collect())) == sorted(map(key, want))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    survivors = [r["doc_id"] for r in kept.collect()]
    assert {d for d in survivors if d is not None} == {c for _, _, c in want if c is not None}
    assert all(survivors.count(d) == (2 if d == 15 else 1) for d in survivors if d is not None)  # two texts with id 15
    assert sum(d is None for d in survivors) == len({f for d, f, c in want if c is None})
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("block", [8192, 7])
def test_simhash_tiles_lose_no_link(spark, block):
    rnd = np.random.default_rng(1)
    fps = rnd.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [int(f) ^ (1 << int(a)) ^ (1 << int(b)) for f in fps for a, b in rnd.integers(0, 64, (6, 2))]
    values = sorted({int(f) for f in fps} | set(near) | {0, 1, 3, (1 << 64) - 1})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp long, rank long").repartition(4)
    got = {r["fp"]: r["component_rank"] for r in simhash.classes(table, 2, block).collect()}
    assert [got[s] for s in signed] == brute_components(list(range(len(values))), values)


def test_bpe_equals_library(docs, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    library = Tokenizer.from_file(path)
    extra = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame(
        [(900, "a<|endoftext|>b  <|endoftext|> c"), (901, "I'll we're 'S    x\r\n\r\n  y  "), (902, "é" * 5000),
         (903, " " * 3000 + "z"), (904, "%%% " * 2000), (905, "it's " * 3000)], "doc_id long, text string"))
    got = bpe.decode(bpe.encode(extra.withColumn("ids", F.lit(1)), path), path).collect()
    assert len(got) == extra.count()
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(none, path), path).count() == 0


def test_bpe_chunks_are_reused_and_joins_repaired():
    vocabulary = bpe.Vocabulary(open(queries.tokenizer_path(), encoding="utf-8").read())
    coder = bpe.ChunkEncoder(vocabulary, cache_bytes=1 << 20)
    rnd = random.Random(3)
    body = " ".join("".join(rnd.choice("aeiounst") for _ in range(rnd.randrange(1, 12))) for _ in range(8000))
    for text in (body, "new start " + body, body + " new end"):
        assert coder.encode(text.encode()).tolist() == vocabulary.coder.encode_ordinary(text)
    assert coder.hits > coder.misses * 1.5


def test_mix_rates_and_repeats(spark, docs, none):
    rows = [(i, "x" * (i % 50), f"s{i % 4}") for i in range(20000)] + [(None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy_no", F.lit("clash"))
    weights = {"s0": 0.5, "s1": 0.25}
    got = mixing.mix(table, weights, 0.25, epochs=2.0, seed=3).cache()
    assert got.columns == ["doc_id", "text", "source", "copy_no", "n_copies", "shuffle_key"]
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    total = table.agg(F.sum(size)).first()[0]
    by = {r[0]: r[1] / (2.0 * total) for r in got.groupBy("source").agg(F.sum(size)).collect()}
    assert by["s0"] == pytest.approx(0.5, abs=0.02) and by["s1"] == pytest.approx(0.25, abs=0.02)
    assert by["s2"] + by["s3"] == pytest.approx(0.25, abs=0.02)
    copies = got.groupBy("doc_id").agg(F.max("n_copies").alias("n"), F.count("*").alias("m"), F.countDistinct("copy_no").alias("d"))
    assert copies.where("n <> m or m <> d").count() == 0
    again = mixing.mix(table.repartition(7), weights, 0.25, epochs=2.0, seed=3)
    assert again.exceptAll(got).count() == 0 and got.exceptAll(again).count() == 0
    assert mixing.mix(none, weights, 0.25).count() == 0
    assert mixing.mix(docs, {}, 1.0).count() > 0 and mixing.mix(docs, {"s": 0.0}, 0.0).count() == 0


def test_poisson_counts_follow_the_distribution(spark):
    table = spark.range(40000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.lit("s").alias("source"))
    got = mixing.replicate(table, {"s": 1.0}, 0.0, epochs=40.0)  # above MAX_MEAN: a sum of parts
    n = got.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.avg("n"), F.variance("n")).first()
    assert n[0] == pytest.approx(40, abs=0.2) and n[1] == pytest.approx(40, abs=1.5)


def test_language_model_is_a_distribution_and_ranks():
    letters = langid.letter_table()
    texts = [b"the cat sat on the mat and the dog ran", b"an apple a day"]
    batch = __import__("pyarrow").RecordBatch.from_pydict({"lang": ["en", "en"], "text": [t.decode() for t in texts]})
    rows = __import__("pyarrow").Table.from_batches(langid._count(3, 16)(iter([batch])))
    model = langid.kneser_ney(*(rows.column(c).to_numpy() for c in ("m", "slot", "ctx", "suf", "n")), 3, 16)
    alphabet = sorted(set(b"".join(texts).decode()))
    for history in (b"th", b"at", b"zz"):  # probabilities of what follows add up to one with the unseen
        total = 0.0
        for c in alphabet:
            codes = langid.characters(history + c.encode(), letters)[:-1]
            if c == " ":
                codes = np.concatenate((langid.characters(history, letters)[:-1], np.zeros(1, np.uint64)))
            own = langid.slots(codes, 3, 16)
            total += np.exp(langid._score_places(own, model, 16, langid._dense(model, 16))[-1])
        assert 0.9 < total <= 1.0001


def test_language_counts_are_exact_whatever_the_corpus_holds():
    rnd = random.Random(8)
    texts = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(1000)) for _ in range(300)]
    batch = __import__("pyarrow").RecordBatch.from_pydict({"lang": ["zh"] * len(texts), "text": texts})
    rows = __import__("pyarrow").Table.from_batches(langid._count(langid.ORDER, langid.BITS)(iter([batch])))
    want = len({(" " + t + " ")[i:i + 4] for t in texts for i in range(len(t) - 1)})
    assert want > 1 << 18
    four = rows.filter(__import__("pyarrow").compute.equal(rows["m"], 4))
    assert len(set(four["slot"].to_pylist())) == want


def test_language_model_of_spark_equals_plain_reading(spark, monkeypatch):
    monkeypatch.setattr(langid, "RANGE_ROWS", 100)
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcde fgh") for _ in range(200)) for _ in range(12)]
    rows = spark.createDataFrame([("x" if i % 2 else "y", t) for i, t in enumerate(texts)], "lang string, text string").repartition(3)
    letters, bits = langid.letter_table(), 22
    model = langid.build(langid.count(rows, 3, bits), 3, bits)
    assert model["languages"] == ["x", "y"]
    got = langid.cross_entropies([t.encode() for t in texts] + [b"12"], model, letters)
    whole = langid.build(langid.count(rows, 3, 64), 3, 64)
    assert whole["ranges"] > 1
    np.testing.assert_allclose(langid.cross_entropies([t.encode() for t in texts] + [b"12"], whole, letters), got, rtol=1e-5)
    assert np.isnan(got[-1]).all()
    for k, lang in enumerate("xy"):
        c = langid.count(rows.where(F.col("lang") == lang), 3, bits).toArrow()
        plain = langid.kneser_ney(*(c.column(x).to_numpy() for x in ("m", "slot", "ctx", "suf", "n")), 3, bits)
        for i, t in enumerate(texts):
            codes = langid.characters(t.encode(), letters)
            lp = langid._score_places(langid.slots(codes, 3, bits), plain, bits, langid._dense(plain, bits))[1:]
            assert got[i, k] == pytest.approx(-lp.mean(), rel=1e-4)


def test_a_language_of_the_calibration_fold_is_learned(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(60)] + [(i, "der hund und die katze", "de") for i in range(60, 120)]
    rows += [(i, "kissa ja koira istuvat", "fi") for i in range(200, 260)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = table.where((F.col("lang") != "fi") | (langid.fold("doc_id") == langid.CALIBRATION))
    model = langid.train(table)
    assert model["languages"] == ["de", "en", "fi"]
    got = langid.identify(table.where("lang = 'fi'"), model).select("lang_pred").distinct().collect()
    assert [r[0] for r in got] == ["fi"]
    # every document with remainder 1 to 4 is counted
    learned = table.where(langid.fold("doc_id") != langid.HELD_OUT)
    plain = langid.build(langid.count(learned, langid.ORDER, langid.BITS), langid.ORDER, langid.BITS)
    texts, letters = [b"the katze istuvat"], langid.letter_table()
    np.testing.assert_allclose(langid.cross_entropies(texts, model, letters), langid.cross_entropies(texts, plain, letters))


def test_all_of_the_calibration_fold_calibrates(spark):
    rnd = random.Random(10)
    letters = {"x": "aaabbcde ", "y": "aabbccfde ", "z": "bcdefff "}
    rows = [(i, "".join(rnd.choice(letters[lang]) for _ in range(rnd.randrange(8, 40))), lang)
            for i in range(24_000) for lang in [rnd.choice("xxyyyz")]]
    rows += [(i, "a other text under an id that repeats", "x") for i in range(200)] + [(None, "abc", "x"), (7, None, "y"), (8, "12", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(table, order=2)
    known = table.where("text is not null").withColumn("f", langid.fold("doc_id")).where(F.col("f") != langid.HELD_OUT)
    first = langid.build(langid.count(known.where(F.col("f") != langid.CALIBRATION), 2, langid.BITS), 2, langid.BITS)
    told = {}
    for r in known.where(F.col("f") == langid.CALIBRATION).collect():
        told[r["doc_id"]] = min(told.get(r["doc_id"], ("~", "")), (r["lang"], r["text"]))
    assert len(told) > 4500
    xent = langid.cross_entropies([t.encode() for _, t in told.values()], first, langid.letter_table())
    ok = ~np.isnan(xent).any(axis=1)
    xent, truth = xent[ok], np.array([first["languages"].index(lang) for lang, _ in told.values()])[ok]
    best, ranked = xent.argmin(axis=1), np.sort(xent, axis=1)
    a, w = np.stack((ranked[:, 1] - ranked[:, 0], np.ones(len(xent))), axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w += np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ ((best == truth) - p) - 1e-2 * w)
    assert model["confidence"] == pytest.approx(tuple(w), rel=1e-6)
    want = [float(np.quantile(xent[(truth == k) & (best == k), k], langid.REJECT_QUANTILE)) * 1.1 for k in range(3)]
    assert model["limits"] == pytest.approx(want, rel=1e-9)


def test_many_language_values_do_not_stop_the_query(spark):
    rows = [(i, "the cat sat" if i % 2 else "der hund und", f"r{i}") for i in range(450)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(table, order=2)
    assert len(model["languages"]) > 256
    assert langid.identify(table.limit(5), model).where("lang_pred is not null").count() == 5


def test_language_of_documents(spark, docs, none):
    table = queries.table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r["doc_id"]: r["lang"] for r in table.select("doc_id", "lang").collect()}
    got = queries.op5_langid(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and len(held) > 100
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0.0 <= r["score"] <= 1.0 for r in got)
    model = langid.train(table)
    odd = langid.identify(docs.withColumn("score", F.lit("clash")), model, keep=["text", "score"])
    for r in odd.collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(none)).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


def test_quality_on_labels(spark, docs, none):
    sf = "/root/testdata/sf0.1"
    table, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    half = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    models = quality.fit(table, labels.where(half), queries.QUALITY_TARGETS)  # the query's parameters
    got = {r["doc_id"]: r for r in quality.score(table, models, queries.QUALITY_TARGETS, keep=["doc_id", "text"]).collect()}
    told = labels.where(~half).collect()
    junk = [not got[r["doc_id"]]["keep"] for r in told if r["quality"] == 0]
    toxic = [not got[r["doc_id"]]["keep"] for r in told if r["toxic"] == 1]  # all of them
    clean = [got[r["doc_id"]]["keep"] for r in told if r["quality"] == 1 and r["toxic"] == 0]
    assert np.mean(junk) > 0.97 and np.mean(toxic) > 0.9 and np.mean(clean) > 0.99
    odd = quality.score(docs.unionAll(docs.limit(3)), models, queries.QUALITY_TARGETS)
    assert odd.count() == docs.count() + 3 and {"p_quality", "p_toxic", "keep"} <= set(odd.columns)
    empty = quality.fit(docs, labels.limit(0), queries.QUALITY_TARGETS)
    assert quality.score(docs, empty, queries.QUALITY_TARGETS).where("not keep").count() == 0
    assert quality.score(none, models, queries.QUALITY_TARGETS).count() == 0


def test_unlabelled_documents_teach_words_that_no_label_has(spark):
    rnd = random.Random(12)
    text = lambda: " ".join(rnd.choice("abcdefghij") * 3 for _ in range(12))
    rows = [(i, text() + (" zork" if i % 2 and i >= 400 else ""), "en", "bad" if i % 2 else "good", None) for i in range(5400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    models = quality.fit(table, labels, queries.QUALITY_TARGETS)
    zork = quality.terms(b"zork").view(np.int64)[0]
    assert models["quality"] is None and zork in models["toxic"]["vocabulary"]
    assert models["toxic"]["text"][np.searchsorted(models["toxic"]["vocabulary"], zork)] > 1


def test_a_rare_class_is_sampled_whole():
    groups = [((1, 0), 990000), ((0, 0), 9000), ((1, 1), 900), ((None, 1), 100)]
    quality_share, toxic_share = quality.class_shares(groups, 12000)
    assert toxic_share[1] == 1.0 and quality_share[0] > 0.5
    size = sum(n * max(s.get(c, 0) for s, c in zip((quality_share, toxic_share), own)) for own, n in groups)
    assert 11900 < size <= 12000
    assert quality.class_shares([((1,), 50), ((0,), 5)], 100) == [{0: 1.0, 1: 1.0}]


def test_quality_scores_equal_plain_reading(spark):
    """The vectorised terms are the runs of letters and of symbols."""
    for text in ("Of%%% the&&& a,b", "", "  x\n", "É1_a!", "a" * 10):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode()
        plain = re.findall(rb"[0-9a-z\x80-\xff]+|[!-/:-@\[-`{-~]+", low)
        assert len(quality.terms(text.encode())) == len(plain)
        assert len(set(quality.terms(text.encode()).tolist())) == len(set(plain))
    assert os.path.exists(SMOKE)


@pytest.mark.parametrize("text", [" " * 3_000_000, "\t" * 3_000_000 + "x", "\n" * 3_000_000, "a" * 3_000_000, "7" * 1_000_000,
                                  ("x" + " " * 2_000 + "\n" * 2_001 + "é " + "\xa0" * 2_500) * 100],
                         ids=["spaces", "tabs", "newlines", "letters", "digits", "mixed runs"])
def test_bpe_long_runs(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        coder = bpe.ChunkEncoder(bpe.Vocabulary(f.read()))
    assert coder.encode(text.encode()).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
