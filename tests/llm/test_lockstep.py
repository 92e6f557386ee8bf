"""Alignment of two tokenizers against a plain double loop with the libraries, and edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tickbar.llm import bpe, lockstep, queries
from tokenizers import Tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """The contract, document by document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest)."""
    coder, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    coder.encode_special_tokens = True
    letters = bpe._byte_letters()
    done = []
    for doc_id, text in rows:
        a, b = [], []
        if text:
            whole = b" " + text.encode()
            a = [(i, bytes(letters[c] for c in coder.id_to_token(i))) for i in coder.encode(" " + text, add_special_tokens=False).ids]
            for i in pieces.encode(text):
                p = pieces.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a, b = [], []
        ends_a, ends_b = (np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b))
        at_b = {e: j for j, e in enumerate(ends_b)}
        cuts = [(i, at_b[e]) for i, e in enumerate(ends_a) if e in at_b]
        groups, i0, j0 = [], 0, 0
        for i, j in cuts:
            groups.append(",".join(str(x) for x, _ in a[i0:i + 1]) + "|" + ",".join(str(x) for x, _ in b[j0:j + 1]))
            i0, j0 = i + 1, j + 1
        done.append((doc_id, len(a), len(b), ";".join(groups), [(a[i][0], b[j][0]) for i, j in cuts]))
    count = Counter(p for *_, links in done for p in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(d, na, nb, len(links), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for d, na, nb, g, links in done]


ORDER = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest"]


def scored(docs, **options):
    columns = {n: F.size(c).cast("long") for n, c in (("n_a", "ids_a"), ("n_b", "ids_b"), ("n_groups", "links"))}
    columns["digest"] = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return lockstep.align(docs, A, B, keep=["doc_id"], columns=columns, groups=True, **options).scored().select(*ORDER)


def texts():
    rng = random.Random(11)
    words = ["the", "tokenization", "überraschend", "日本語", "ﬁne", "a", "  ", "\n", "\t", "x1y2", "naïve", "🙂👩‍👩‍👧", "<|endoftext|>", "<s>", "</s>", "<unk>",
             "<0x41>", "▁", " ", " ", " ", "é", "\x00", "İ", "...", "don't", "١٢٣", "​", "　", "Ａ"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(1, 60)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, " "), (503, "\n"), (None, "no id"), (7, rows[7][1]), (7, rows[7][1]), (504, "word " * 30000),
                   (505, "z" * 20000), (506, " " * 5000 + "x")]


@pytest.mark.parametrize("block", [lockstep.BLOCK, 500])
def test_against_plain(spark, block):
    rows = texts()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, links string, ids_a int").repartition(4)
    got = [tuple(r) for r in scored(docs, block_links=block).collect()]
    want = plain(rows)
    assert sum(w[1] > 0 for w in want) > 40
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_against_plain(spark):
    smoke = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, smoke, "documents").collect()]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = [tuple(r) for r in queries.QUERIES["op11_lockstep"](spark, smoke).select(*columns).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_lockstep_merge():
    rng = np.random.default_rng(4)
    for lane in (1, 3, 512):
        ends, starts = ([], []), ([0], [0])
        want = []
        for n in (5, 0, 1, 700, 40):
            total = 3 * n
            own = [np.unique(np.append(rng.integers(1, total + 1, n), total)) if n else np.zeros(0, np.int64) for _ in (0, 1)]
            at = [{int(e): i + starts[s][-1] for i, e in enumerate(own[s])} for s in (0, 1)]
            want += [(at[0][e], at[1][e]) for e in sorted(at[0]) if e in at[1]]
            for s in (0, 1):
                ends[s].append(own[s])
                starts[s].append(starts[s][-1] + len(own[s]))
        a, b = (np.concatenate(e) for e in ends)
        got = lockstep.merge(a, b, np.array(starts[0]), np.array(starts[1]), lane)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_empty_and_textless(spark):
    schema = "doc_id long, text string"
    assert scored(spark.createDataFrame([], schema)).count() == 0
    got = scored(spark.createDataFrame([(1, None), (2, "")], schema)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    aligned = lockstep.align(spark.createDataFrame([(1, "hello world"), (2, "hello")], schema), A, B)
    assert {tuple(r) for r in aligned.pair_counts().select("count", "best").collect()} == {(2, True), (1, True)}
    first = aligned.documents().where("doc_id = 1").collect()[0]
    assert first["text"] == "hello world" and len(first["ids_a"]) == len(first["ends_a"]) and any(first["ends_b"])
    assert {r["count_sum"] for r in aligned.scored().collect()} == {3, 2}
