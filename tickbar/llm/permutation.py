"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of vectors.  A vector is represented by its PREFIX nearest
pivots in order; vectors are posted, with their places, in the pivots' inverted files, which are
held per block of vectors.  A query sums, over the postings of its own nearest pivots, how
far the places differ (footrule distance; a missing pivot counts as the place after the
last), takes the share RERANK of the block with the smallest distance, and ranks these by
cosine in double precision on the original vectors.

Queries meet every block; what leaves a block is a query's k best.  Equal vectors are one
class that carries its k + 1 smallest ids, which is all that a result can name.

Defined results: unusable vectors (null, zero, null or non-finite components) take no part;
ties go to the smaller id; rows that share the query's id are not its candidates; an id with several vectors is
named once, by its best score, and as a query asks with all of them; rows without an id take no part; vectors of other lengths than the query's are not comparable and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, scratch
from .vectors import as_doubles, matrix, sample_vectors, unit, usable

PIVOTS = 256
PREFIX = 64
RERANK = 0.4
LEAST_RERANK = 64
BLOCK = 8192


def prefixes(x: np.ndarray, pivots: np.ndarray, length: int = PREFIX) -> np.ndarray:
    """The nearest pivots of each unit vector, nearest first (ties: smaller pivot number)."""
    sims = x @ pivots.T
    k = min(length, len(pivots))
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    own = np.take_along_axis(sims, near, axis=1)
    return np.take_along_axis(near, np.lexsort((near, -own), axis=1), axis=1)


class InvertedFiles:
    """Postings (vector, place) per pivot."""

    def __init__(self, orders: np.ndarray, n_pivots: int):
        n, self.length = orders.shape
        flat = orders.ravel()
        by = np.argsort(flat, kind="stable")
        self.vectors = np.repeat(np.arange(n), self.length)[by]
        self.places = np.tile(np.arange(self.length), n)[by]
        self.ends = np.searchsorted(flat[by], np.arange(n_pivots + 1))
        self.n = n

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every vector's prefix to the query's."""
        gain = np.zeros(self.n, np.int64)  # what a shared pivot saves against a missing one
        for place, pivot in enumerate(order.tolist()):
            a, b = self.ends[pivot], self.ends[pivot + 1]
            other = self.places[a:b]
            # missing on both sides costs (length - place) + (length - other)
            gain[self.vectors[a:b]] += 2 * self.length - place - other - np.abs(place - other)
        full = self.length * (self.length + 1)
        return full - gain


def best_ids(cos: np.ndarray, cand: np.ndarray, ids: list[list[int]], query: int, k: int) -> list[tuple[int, float]]:
    """The k best ids but the query's own, each once with its best score; ties go to the smaller id."""
    most = k + 1
    while True:
        near, own = cand, cos
        if most < len(cos):  # with all that tie with the last one
            least = np.partition(cos, len(cos) - most)[len(cos) - most]
            near, own = cand[cos >= least], cos[cos >= least]
        best: dict[int, float] = {}
        for c, j in zip(own.tolist(), near.tolist()):
            for v in ids[j]:
                if v != query and c > best.get(v, -2.0):
                    best[v] = c
        if len(best) >= k or most >= len(cos):
            return sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        most *= 4  # ids with several vectors took the places


def _answer(pivots: np.ndarray, k: int, prefix: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, index = None, [], None

        def prepare():
            x = np.concatenate([matrix(p, "v") for p in parts])
            ids = [own for p in parts for own in p.column(p.schema.get_field_index("ids")).to_pylist()]
            return unit(x), ids, InvertedFiles(prefixes(unit(x), pivots, prefix), len(pivots))

        for batch in batches:
            if not batch.num_rows:
                continue
            block, role = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(role) != 0)) + 1
            out: list[tuple[int, int, float]] = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if block[a] != key:
                    key, parts, index = block[a], [], None
                part = batch.slice(a, b - a)
                if role[a] == 0:
                    parts.append(part)
                    continue
                if not parts:
                    continue
                if index is None:
                    index = prepare()
                x, ids, files = index
                q = unit(matrix(part, "v"))
                orders = prefixes(q, pivots, prefix)
                queries = [own[0] for own in part.column(part.schema.get_field_index("ids")).to_pylist()]
                take = min(files.n, max(LEAST_RERANK, int(np.ceil(share * files.n))))
                for i, query in enumerate(queries):
                    far = files.footrule(orders[i])
                    cand = np.argpartition(far, take - 1)[:take] if take < files.n else np.arange(files.n)
                    cos = (x[cand] * q[i]).sum(axis=1)
                    out += [(query, v, c) for v, c in best_ids(cos, cand, ids, query, k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                                  pa.array([r[2] for r in out], pa.float64())], ["query_id", "vec_id", "score"])
    return lean(run)


def search(embeddings: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           pivots: int = PIVOTS, prefix: int = PREFIX, share: float = RERANK, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query.

    `is_query` is a predicate over the column `vec_id`.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), as_doubles(F.col(vector_col)).alias("v"))
    rows = scratch(rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).distinct(), "ann-rows")
    nth = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = scratch(classes.select("v", "ids", F.size("v").alias("dim"), F.element_at("ids", 1).alias("rank")), "ann-classes")
    dims = [r[0] for r in classes.select("dim").distinct().sort("dim").limit(1025).collect()]
    if len(dims) > 1024:
        raise ValueError("more than 1024 different vector lengths")
    best = None
    for dim in dims:
        own = classes.where(F.col("dim") == dim)
        n_blocks = max(1, -(-own.count() // block))
        data = own.select(F.pmod(F.xxhash64("rank"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(0).alias("role"), "v", "ids")
        asked = rows.where(is_query & (F.size("v") == dim)).select(
            F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("role"), "v",
            F.array("vec_id").alias("ids"))
        stream = data.union(asked).repartition("block").sortWithinPartitions("block", "role")
        found = stream.mapInArrow(_answer(sample_vectors(own, pivots), k, prefix, share),
                                  "query_id long, vec_id long, score double")
        best = found if best is None else best.union(found)
    if best is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def measured_recall(embeddings: DataFrame, found: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                    vector_col: str = "embedding", sample: int = 64) -> float:
    """Share of the true k nearest that `found` names, over a bounded sample of the queries."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), as_doubles(F.col(vector_col)).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    some = rows.where(is_query).orderBy(F.xxhash64("vec_id")).limit(sample).collect()
    hit = total = 0
    for r in some:  # a bounded number of queries, each against all rows
        q = unit(np.array([r["v"]]))[0].tolist()
        dot = F.aggregate(F.zip_with("v", F.array(*map(F.lit, q)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        norm = F.sqrt(F.aggregate(F.transform("v", lambda a: a * a), F.lit(0.0), lambda a, b: a + b))
        true = (rows.where((F.col("vec_id") != r["vec_id"]) & (F.size("v") == len(q))).select("vec_id", (dot / norm).alias("s"))
                .orderBy(F.col("s").desc(), "vec_id").limit(k).collect())
        got = {x["vec_id"] for x in found.where(F.col("query_id") == r["vec_id"]).collect()}
        hit += sum(x["vec_id"] in got for x in true)
        total += len(true)
    return hit / total if total else 1.0
