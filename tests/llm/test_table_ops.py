"""WARC, sharding, vectors and the pipeline against brute force, and their edge cases."""

import gzip
import hashlib
import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from tickbar.llm import hilbert, mixing, permutation, queries, vecgraph, warc
from tickbar.llm.components import connected_components

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "é" * 100
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (3, None, None), (4, "u4", ""), (5, "u5", "short"),
            (6, "u6", "short"), (None, "n", big), (7, "u7", "x" * 99), (8, "u8", "x" * 99), (9, "u9", "y" * 100),
            (10, "u10", "y" * 100), (1, "http://a/1", big), (11, "u11", "z" * 200000), (None, "n2", "only" * 50)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)


def test_warc_round_trip(spark, pages, tmp_path):
    root = str(tmp_path / "w")
    index = warc.write_archives(pages, root, roll=2000)
    got = warc.read_records(index, root, gap=100, most=5000).collect()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    want = []
    for page, payload in rows:
        same = [p for p, x in rows if x == payload and p is not None]
        first = min(same, default=None) if len(payload) >= 100 else page
        kind = "response" if page == first else "revisit"
        want.append((page, len(payload), hashlib.sha256(payload).hexdigest(), kind, first if kind == "revisit" else None))
    flat = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(map(str, flat)) == sorted(map(str, want))
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]
    some = warc.read_records(index.where("page_id in (5, 11)"), root).collect()
    assert {r["page_id"] for r in some} == {5, 11} and all(r["payload"] is not None for r in some)
    files = [f for f in os.listdir(tmp_path / "w" / "archive")]
    assert len(files) > 1
    for f in files:  # whole files are valid gzip of WARC records
        assert gzip.open(tmp_path / "w" / "archive" / f).read().startswith(b"WARC/1.1\r\n")
    none = warc.write_archives(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_records(none, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(list(np.ndindex(*[1 << bits] * dims)))
    at = hilbert.curve_index(cells, bits)
    assert sorted(at.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_shards(spark, tmp_path):
    rows = [(i % 700, None if i % 11 == 0 else f"text {i % 50} é", ["en", "de", None][i % 3], "src0" if i % 2 else f"s{i % 9}", i % 200)
            for i in range(1003)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn(
        "curve", F.lit("clash")).withColumn("seq", F.lit(1)).repartition(6)
    got = hilbert.shard(docs, queries.SHARD_DIMENSIONS, 8).collect()
    assert len(got) == len(rows)
    counts = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for s in range(8):
        own = sorted((r["slot"], r["curve"]) for r in got if r["shard"] == s)
        assert [x[0] for x in own] == list(range(len(own))) and [x[1] for x in own] == sorted(x[1] for x in own)
    want = sorted((-1 if d is None else d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    few = hilbert.shard(docs.limit(3), queries.SHARD_DIMENSIONS, 8).collect()
    assert sorted(r["shard"] for r in few) == [0, 1, 2]
    assert hilbert.shard(docs.limit(0), queries.SHARD_DIMENSIONS, 8).count() == 0
    placed = hilbert.shard(docs.unionAll(docs.where("doc_id < 40")), queries.SHARD_DIMENSIONS, 8, keep=docs.columns)
    hilbert.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]  # repeated rows have places of their own
    assert sum(counts) == docs.count() + docs.where("doc_id < 40").count() and len(counts) == 8 and max(counts) - min(counts) <= 1
    assert set(docs.columns) <= set(back.columns) and back.where("source = 'src0'").count() == placed.where("source = 'src0'").count()


def test_shard_statistics_prune_every_dimension(spark, tmp_path):
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents")
    placed = hilbert.shard(docs, queries.SHARD_DIMENSIONS, 8, keep=docs.columns)
    hilbert.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    for c in ("source", "lang", "n_chars"):
        spans = back.groupBy("shard").agg(F.min(c).alias("least"), F.max(c).alias("most")).collect()
        values = [r[0] for r in back.select(c).where(F.col(c).isNotNull()).distinct().collect()]
        held = [sum(r["least"] <= v <= r["most"] for r in spans) for v in values]
        assert min(held) <= 4, (c, min(held))  # an equality on it reads half of the shards or fewer
        assert sum(held) / len(held) < 7


def test_cells_follow_values():
    import pyarrow as pa

    sample = sorted([b"a"] * 50 + [b"b"] * 30 + [b"z"] * 20)
    assert hilbert.cells_of(pa.array(["z", None, "b", "a", "c", "", "zz"]), sample, 8).tolist() == [204, 0, 128, 0, 204, 0, 255]
    assert hilbert.cells_of(pa.array([1.0, None, 9.0, 5.0]), [], 8).tolist() == [0, 0, 0, 0]
    assert hilbert.cells_of(pa.array([], pa.string()), sample, 8).tolist() == []


def test_cells_come_from_all_rows(spark):
    import pyarrow as pa
    from bisect import bisect_left

    n = 20_000  # more than any sample that was taken
    rows = [(i, "t", None if i % 13 == 0 else f"l{min(i * i % 97, 40)}", "hot" if i % 3 else f"s{i % 211}", None if i % 17 == 0 else i * 7919 % 10007)
            for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranks run on over partitions
    try:
        got = {r["doc_id"]: r["curve"] for r in hilbert.shard(docs, queries.SHARD_DIMENSIONS, 8).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    cells = []
    for c in (3, 2, 4):
        known = sorted(r[c] for r in rows if r[c] is not None)
        cells.append([0 if r[c] is None else (bisect_left(known, r[c]) << 8) // len(known) for r in rows])
    assert [got[i] for i in range(n)] == hilbert.curve_index(np.array(cells).T, 8).tolist()
    few = hilbert.quantiles(docs.limit(0), queries.SHARD_DIMENSIONS, 8)
    assert few == [[], [], []] and hilbert.cells_of(pa.array(["a", None]), few[0], 8).tolist() == [0, 0]


def test_components(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    pairs = path + star + [(5000, 5001), (5001, 5000), (-3, 9000), (7, 7)]
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(7)
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)} | {5000: 5000, 5001: 5000, -3: -3, 9000: -3}
    assert got == want
    assert connected_components(edges.limit(0)).count() == 0


def messy_vectors():
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(260, 16))
    near = [base[0] + rnd.normal(size=16) * 0.08 for _ in range(60)]
    chain = [np.r_[np.cos(t), np.sin(t), np.zeros(14)] for t in np.arange(0, 2.0, 0.4)]
    rows = [(i, v.astype(float).tolist()) for i, v in enumerate([*base, *near, *chain])]
    n = len(rows)
    rows += [(n + i, rows[3][1]) for i in range(40)] + [(n + 50, [2 * x for x in rows[3][1]])]
    rows += [(n + 60, None), (n + 61, [0.0] * 16), (n + 62, [float("nan")] + [1.0] * 15), (n + 63, [None] + [1.0] * 15),
             (n + 64, []), (n + 65, [float("inf")] * 16), (n + 66, [1.0, 2.0]), (n + 67, [2.0, 4.0]), (n + 68, [1e300] * 16), (n + 69, [1e-300] * 16)]
    return rows


def cosine(a, b):
    if len(a) != len(b):
        return -2.0
    a, b = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def fit_vectors(rows):
    return {i: v for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, "x") for i, v in messy_vectors()], "vec_id long, embedding array<double>, rank string").repartition(4)


@pytest.mark.parametrize("shard_rows, block", [(1024, 2048), (40, 25)])
def test_vector_links_match_brute_force(vectors, monkeypatch, shard_rows, block):
    monkeypatch.setattr(vecgraph, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(vecgraph, "BLOCK", block)
    good = fit_vectors(messy_vectors())
    links = {i: [j for j in good if j != i and cosine(good[i], good[j]) >= 0.9] for i in good}
    got = {r["vec_id"]: r for r in vecgraph.near_duplicates(vectors, 0.9).collect()}
    for i, _ in messy_vectors():
        seen, todo = {i}, [i]
        while todo:
            todo = [j for k in todo for j in links.get(k, ()) if j not in seen and not seen.add(j)]
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links.get(i, ())), min(seen), i == min(seen)), i
    assert vecgraph.near_duplicates(vectors.limit(0)).count() == 0


def test_tight_groups_are_linked_with_each_other(spark):
    rnd = np.random.default_rng(4)
    centres = [np.eye(16)[0], np.r_[0.93, np.sqrt(1 - 0.93 ** 2), np.zeros(14)]]
    groups = [c + rnd.normal(size=(70, 16)) * 0.002 for c in centres]  # more than CANDIDATES near copies each
    far = np.eye(16)[5] + rnd.normal(size=(200, 16)) * 0.002  # holds the medoid
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([*groups, far]))]
    got = {r["vec_id"]: r for r in vecgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()}
    assert {got[i]["component_id"] for i in range(140)} == {0} and {got[i]["n_links"] for i in range(140)} == {139}
    assert {got[i]["component_id"] for i in range(140, 340)} == {140}


def test_audit_sees_lost_pairs_beside_a_large_group(spark):
    rnd = np.random.default_rng(6)
    group = np.eye(32)[0] + rnd.normal(size=(700, 32)) * 0.002
    single = rnd.normal(size=(1300, 32))
    pairs = rnd.normal(size=(20, 32))
    every = np.concatenate([group, single, pairs, pairs + rnd.normal(size=pairs.shape) * 0.01])
    rows = [(i, v.tolist(), 1, 32) for i, v in enumerate(every)]
    classes = spark.createDataFrame(rows, "rank long, v array<double>, copies long, dim int").repartition(3)
    held = [(i, 0, 699) for i in range(700)]
    schema = "node long, component long, links long"
    assert vecgraph.recall(classes, spark.createDataFrame(held, schema), 0.9) < 0.1  # all pairs are lost
    pair = [(2000 + i + k, 2000 + i, 1) for i in range(20) for k in (0, 20)]
    assert vecgraph.recall(classes, spark.createDataFrame(held + pair, schema), 0.9) == 1.0
    rare = classes.where("rank >= 700")
    assert vecgraph.recall(rare, spark.createDataFrame([], schema), 0.9) == 0.0
    assert vecgraph.recall(classes.where("rank >= 700 and rank < 2000"), spark.createDataFrame([], schema), 0.9) == 1.0


def linked_vectors():
    rnd = np.random.default_rng(12)
    pairs = rnd.normal(size=(300, 24))
    groups = []
    for _ in range(4):  # two tight groups each, of more near copies than a vector has candidates, linked with each other
        a, b = np.linalg.qr(rnd.normal(size=(24, 2)))[0].T
        groups += [c + rnd.normal(size=(80, 24)) * 0.002 for c in (a, 0.93 * a + np.sqrt(1 - 0.93 ** 2) * b)]
    x = np.concatenate([rnd.normal(size=(4600, 24)), pairs, pairs + rnd.normal(size=pairs.shape) * 0.2, *groups])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_graph_search_finds_the_links(spark, monkeypatch):
    x = linked_vectors()
    assert len(x) > 5000
    truth = (x @ x.T >= 0.9).sum(axis=1) - 1
    schema = "rank long, v array<double>, copies long, dim int"
    classes = spark.createDataFrame([(i, v.tolist(), 1, 24) for i, v in enumerate(x)], schema).repartition(4).checkpoint()
    pivots = vecgraph.sample_vectors(classes, len(x) // vecgraph.SHARD_ROWS)
    assert len(pivots) > 5
    got = np.zeros(len(x))
    for r in vecgraph._links(classes, pivots, vecgraph.OVERLAP, 0.9).collect():
        got[r["node"]] = r["links"]
    assert (got <= truth).all() and (truth > 0).sum() > 1000
    assert (got[truth > 0] / truth[truth > 0]).mean() >= 0.99
    monkeypatch.setattr(vecgraph, "greedy", lambda *a: np.zeros(0, np.int64))  # the result does come from the search
    assert vecgraph._links(classes, pivots, vecgraph.OVERLAP, 0.9).count() == 0


def test_every_table_is_audited(vectors, monkeypatch):
    asked = []
    real = vecgraph.recall
    monkeypatch.setattr(vecgraph, "recall", lambda *a: asked.append(real(*a)) or asked[-1])
    vecgraph.near_duplicates(vectors, 0.9).collect()
    assert len(asked) >= 2 and min(asked) >= 0.99  # one shard, two vector lengths


def test_shards_that_lose_links_end_in_an_exact_comparison(vectors, monkeypatch):
    monkeypatch.setattr(vecgraph, "SHARD_ROWS", 10)
    want = sorted(tuple(r) for r in vecgraph.near_duplicates(vectors, 0.9, overlap=1000).collect())
    monkeypatch.setattr(vecgraph, "recall", lambda *a: 0.0)  # no overlap is ever enough
    assert sorted(tuple(r) for r in vecgraph.near_duplicates(vectors, 0.9, overlap=1).collect()) == want


def test_nearest_neighbours(vectors):
    good = fit_vectors(messy_vectors())
    got = {}
    for r in permutation.search(vectors, F.col("vec_id") % 10 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for q in (i for i in good if i % 10 == 0):
        true = sorted((-cosine(good[q], v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:5]
        own = sorted(got.get(q, []))
        assert [r for r, _, _ in own] == list(range(1, len(true) + 1))
        for _, i, s in own:
            assert s == pytest.approx(cosine(good[q], good[i]), abs=1e-12)
        hit += len({i for _, i, _ in own} & {i for _, i in true})
        total += len(true)
    assert hit / total >= 0.9
    assert permutation.search(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_ids_with_several_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i) % 40, rng.normal(size=8).tolist()) for i in range(400)] + [(10, [1.0] * 8), (10, [-1.0] * 8), (11, [1.0] * 8), (12, [1.0] * 8)]
    found = permutation.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=5).collect()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    for query in range(0, 40, 10):
        best = {}
        for j, c in zip(ids.tolist(), (x[ids == query] @ x.T).max(axis=0).tolist()):
            if j != query:
                best[j] = max(best.get(j, -2.0), c)
        want = sorted(best.items(), key=lambda p: (-round(p[1], 12), p[0]))[:5]
        got = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5] and [r["vec_id"] for r in got] == [j for j, _ in want]
        assert np.allclose([r["score"] for r in got], [c for _, c in want])


def test_search_recall_on_table(spark):
    table = queries.table(spark, "/root/testdata/sf0.1", "embeddings")
    found = queries.op8_permutation(spark, "/root/testdata/sf0.1").cache()
    assert permutation.measured_recall(table, found, F.col("vec_id") % 50 == 0, sample=8) >= 0.9


def test_pipeline(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "substring dedup", "mixing sources", "bpe"]
    now, sizes = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "/root/testdata/sf0.01").checkpoint()
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert docs.count() > sizes[0] > sizes[1] == sizes[2]
    again = mixing.mix(now, {}, 1.0)
    assert again.columns[:5] == docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, now, "/root/testdata/sf0.01")
    assert last.count() == sizes[3] and last.where("not exact").count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_give_a_row_per_input(spark, name):
    df = queries.QUERIES[name](spark, SMOKE)
    names = {"op2_warc": "pages", "op7_vecgraph": "embeddings", "op8_permutation": "embeddings"}
    n = queries.table(spark, SMOKE, names.get(name, "documents")).count()
    rows = df.count()
    assert rows == n if name not in ("op3_mix", "op8_permutation") else rows > 0


def test_pipeline_stages_move_texts_in_bounded_batches(spark):
    import pyarrow as pa
    from tickbar.llm.common import BATCH_BYTES

    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab cd "), 500).alias("text"),
                                             F.lit("en").alias("lang"), F.lit("s").alias("source"))
    own = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(own, None)
    spark.conf.unset(own)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})
    try:
        for _, stage in corpus_pipeline.STAGES[-1:]:
            assert stage(spark, docs.limit(3), SMOKE).count() == 3
        seen = docs.select("text").mapInArrow(sizes, "rows long, size long").collect()
    finally:
        spark.conf.unset(own) if was is None else spark.conf.set(own, was)
    assert sum(r["rows"] for r in seen) == 6000 and max(r["size"] for r in seen) < 1.1 * BATCH_BYTES
