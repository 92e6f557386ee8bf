"""The Merkle manifest against a plain one, and its edge cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tickbar.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars, *_):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """Root and, for each leaf, the siblings level by level."""
    level, at = leaves, list(range(len(leaves)))
    paths = [[] for _ in leaves]
    while len(level) > 1:
        for i, k in enumerate(at):
            run = k // 8 * 8
            paths[i].append(("".join(level[run:k]), "".join(level[k + 1:run + 8])))
            at[i] = k // 8
        level = [h(*level[i:i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def plain_proofs(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda x: x[:3]),) for g in order}
    trees = {g: (own, *plain_tree([x[2] for x in own])) for g, (own,) in trees.items()}
    root, over = plain_tree([trees[g][1] for g in order])
    return [(x[3], x[2], trees[g][1], root, tuple(trees[g][2][i] + over[j]))
            for j, g in enumerate(order) for i, x in enumerate(trees[g][0])]


def cases():
    rng = random.Random(3)
    big = [(i, f"Text {i} é" * (i % 3), "en", f"s{i % 2}", i, "x", "y") for i in range(1500)]
    langs = [(5000 + i, "t", f"l{i % 70:02d}", None, None, "x", "y") for i in range(200)]
    odd = [(None, None, None, None, None, None, None)] * 9 + [(None, "A", None, "s", 1, "x", "y"), (7, "A", "en", "s", 1, "x", "y"),
           (7, "A", "en", "s", 1, "x", "z"), (-3, "", "", "", 0, "x", "y"), (9, "lone", "é", "s", 2, "x", "y"),
           (10, "W" * 300000, "de", "s", 3, "x", "y")]
    rows = big + langs + odd
    rng.shuffle(rows)
    return [rows, rows[:1], [(i, "t", "en", "s", 1, "x", "y") for i in range(8)], [(i, "t", "en", "s", 1, "x", "y") for i in range(513)]]


@pytest.mark.parametrize("rows", cases(), ids=["mixed", "one row", "one run", "one more than a subtree"])
def test_against_plain(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    manifest = merkle.build(docs, FIELDS, "lang", "doc_id", keep={"doc_id": F.col("doc_id"), "extra": F.col("leaf")})
    got = merkle.proofs(manifest).withColumn("digest", merkle.siblings_digest(F.col("path"))).withColumn(
        "folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    want = plain_proofs(rows)
    assert sorted(map(str, [(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in got])) == \
        sorted(map(str, [(*w[:4], tuple(w[4])) for w in want]))
    assert all(r["folded"] == r["root"] for r in got)
    assert all(r["digest"] == h(*(a + b for a, b in r["path"])) for r in got)
    assert manifest.root().collect()[0][0] == want[0][3]
    assert {r["subroot"] for r in manifest.subroots().collect()} == {w[2] for w in want}


def test_changed_rows_are_found(spark):
    rows = [(i, f"Text {i}", "en" if i % 3 else None, "s", i, "x", "y") for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = merkle.leaf(*(F.col(c) for c in FIELDS[:4]), F.lower("text"))
    proved = merkle.proofs(merkle.build(docs, FIELDS, "lang", "doc_id", keep={"other": other}))
    got = proved.select((merkle.fold(F.col("other"), F.col("path")) == F.col("root")).alias("same")).collect()
    assert len(got) == 700 and not any(r["same"] for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    manifest = merkle.build(docs, FIELDS, "lang", "doc_id")
    assert merkle.proofs(manifest).count() == 0 and manifest.root().count() == 0


def test_only_some_levels_are_stored(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    manifest = merkle.build(docs, ["doc_id", "lang"], "lang", "doc_id")
    sizes = [sum(len(r["nodes"]) for r in b.collect()) for b in manifest.groups.blocks]
    assert sizes == [5000, 10]  # levels 0 and 3; 1, 2 (and 4) are made again
