"""Embedding near-duplicates by a robust-pruned flat graph.

1. Equal vectors are one class with its smallest id and its count.
2. Classes are assigned to their OVERLAP nearest pivots (a bounded sample of vectors).  A
   pivot's members form a shard; a shard of any size is cut into blocks of at most BLOCK.
3. Every block builds a graph: each vector's nearest candidates, robust-pruned to DEGREE edges, and
   of the vectors at growing ranks behind them (each rank half as far again) up to FAR more, pruned in the
   same way.  A tight group can hold all nearest candidates of its members; the farther ranks lead out of it.  The
   adjacency lists of a vector from all its blocks are united, and edges run both ways.
4. Every member of a shard searches each of the shard's blocks: greedy from the block's
   medoid, from its own place in the graph and from its united list, with a beam, until nothing
   nearer comes; then the search expands through every vector within range (less a slack) until
   no more are found.  Blocks are dealt anew in every shard, so a list holds neighbours from
   different blocks and leads into them.
5. A task reports only links that join different trees; these give the components.
6. Links are verified and counted inside the components: blocks of members are compared with
   each other by cosine in double precision on the original vectors.  Only counts leave a task, so
   a large group gives a row per member and block, not per pair.

The recall of the links is audited per linked vector on a sample compared with all rows, whatever the table's size.
The sample is drawn until it has AUDIT_LINKED linked vectors outside the large components, or AUDIT_MOST times
the root of the table's rows.  While recall is under the target, the overlap grows; when one comparison of
all with all would cost no more than the next shards, that exact comparison is the last step.

Vectors are named by a 64-bit hash inside the operator: two different ones share it by chance in a table of some 10**9.

Defined results: unusable vectors (null, zero, null or non-finite components) link with nothing; vectors
of different lengths never link; copies link with each other; repeated rows count as copies;
rows without an id take part, and come last as representatives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_rank, lean, scratch
from .components import Forest, connected_components
from .vectors import as_doubles, matrix, sample_vectors, unit, usable

COSINE = 0.9
SHARD_ROWS = 512      # wanted mean size of a shard without overlap
MAX_PIVOTS = 16384    # bound of the pivot sample
BLOCK = 3072          # above the usual size of a shard with overlap: only hot shards are cut
OVERLAP = 3
DEGREE = 16
CANDIDATES = 48
FAR = 8               # edges to farther ranks
ALPHA = 1.2
BEAM = 16
SLACK = 0.2           # the search expands through vectors this much below the range
AUDIT_ROWS = 1024     # least first draw of the audit, or the root of the table's rows
AUDIT_LINKED = 400    # linked vectors outside large components that the audit wants
AUDIT_LARGE = 0.01    # a component with more than this share of the linked vectors is large
AUDIT_VALUES = 1 << 22  # numbers of sample vectors that tasks hold at once
AUDIT_MOST = 64       # the audit draws at most so many times the root of the table's rows
AUDIT_RECALL = 0.99


def robust_prune(sims: np.ndarray, order: np.ndarray, own: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[int]:
    """Of the candidates, nearest first, those not much nearer to a chosen one than to the vector itself.

    sims: similarities between all vectors of the block; distances are 1 - cosine.
    """
    chosen: list[int] = []
    left = order
    while len(left) and len(chosen) < degree:
        best = int(left[0])
        chosen.append(best)
        left = left[1:]
        left = left[alpha * (1.0 - sims[best, left]) > 1.0 - own[left]]
    return chosen


def far_ranks(n: int) -> np.ndarray:
    """Ranks behind the nearest candidates, each half as far again as the one before."""
    out, at = [], CANDIDATES + CANDIDATES // 4
    while at < n - 1:
        out.append(at)
        at += at // 2
    return np.array(out, np.int64)


def build_block(x: np.ndarray) -> list[list[int]]:
    """Adjacency lists of a block of unit vectors, edges both ways."""
    n = len(x)
    x = x.astype(np.float32)
    sims = x @ x.T
    np.fill_diagonal(sims, -2.0)
    k, ranks = min(CANDIDATES, n - 1), far_ranks(n)
    out: list[set[int]] = [set() for _ in range(n)]
    for i in range(n if k > 0 else 0):
        order = np.lexsort((np.arange(n), -sims[i]))
        near = robust_prune(sims, order[:k], sims[i])
        for j in [*near, *robust_prune(sims, order[ranks], sims[i], FAR)]:
            out[i].add(int(j))
            out[int(j)].add(i)
    return [sorted(s) for s in out]


def greedy(x: np.ndarray, links: list[np.ndarray], q: np.ndarray, starts: list[int], floor: float, beam: int = BEAM) -> np.ndarray:
    """Vectors at or above `floor` found from the starts, the whole range expanded."""
    seen = np.zeros(len(x), bool)
    first = np.unique(np.array(starts))
    seen[first] = True
    ids, sims = first, x[first] @ q
    done: set[int] = set()
    inside = list(first[sims >= floor])
    while True:
        open_ = [k for k in np.argsort(-sims)[:beam].tolist() if int(ids[k]) not in done]
        if not open_:
            break
        at = int(ids[open_[0]])
        done.add(at)
        near = links[at][~seen[links[at]]]
        if len(near):
            seen[near] = True
            s = x[near] @ q
            inside += near[s >= floor].tolist()
            ids, sims = np.concatenate((ids, near)), np.concatenate((sims, s))
            if len(ids) > 4 * beam:
                keep = np.argpartition(-sims, beam)[:beam]
                ids, sims = ids[keep], sims[keep]
    queue = [i for i in inside if int(i) not in done]
    while queue:  # range expansion: a wave at a time
        wave = np.unique(np.concatenate([links[i] for i in queue]))
        wave = wave[~seen[wave]]
        if not len(wave):
            break
        seen[wave] = True
        new = wave[x[wave] @ q >= floor]
        inside += new.tolist()
        queue = new.tolist()
    return np.unique(np.array(inside, np.int64)) if inside else np.zeros(0, np.int64)


def _assign(pivots: np.ndarray, overlap: int):
    """The numbers of the nearest pivots, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch, "v")) if batch.num_rows else np.zeros((0, pivots.shape[1]))
            shards = []
            for at in range(0, len(x), 1024):
                sims = x[at:at + 1024] @ pivots.T
                k = min(overlap, len(pivots))
                near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < len(pivots) else np.tile(np.arange(k), (len(sims), 1))
                shards += np.sort(near, axis=1).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "shards"])
    return lean(run)


def _grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal leading columns, as slices (a group may come in several)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(n_keys)], axis=1)
        cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            yield tuple(keys[a].tolist()), batch.slice(a, b - a)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, near: adjacency lists of each (shard, block)."""
    key, parts = None, []

    def settle():
        x = unit(np.concatenate([matrix(p, "v") for p in parts]))
        nodes = np.concatenate([p.column(2).to_numpy() for p in parts])
        lists = [nodes[near].tolist() for near in build_block(x)]
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(lists, pa.list_(pa.int64()))], ["node", "near"])

    for k, part in _grouped(batches, 2):
        if k != key and parts:
            yield settle()
            parts = []
        key = k
        parts.append(part)
    if parts:
        yield settle()


def _search(cosine: float, exact: bool):
    """Links (u, v) of each query in each block, those that join different trees.

    By the block's graph, or (the last step after a failed audit) by comparison with the whole block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, graph = None, [], None

        def prepare():
            nodes = np.concatenate([p.column(3).to_numpy() for p in parts])
            x = unit(np.concatenate([matrix(p, "v") for p in parts]))
            at = {int(n): i for i, n in enumerate(nodes)}
            near = [[at[j] for j in (own or ()) if j in at] for p in parts for own in p.column("near").to_pylist()]
            links = [np.array(sorted(set(own)), np.int64) for own in near]
            medoid = int(np.argmax(x @ x.mean(axis=0)))
            return nodes, x, at, links, medoid, Forest(), np.arange(len(nodes))

        for k, part in _grouped(batches, 3):
            shard, block, role = k
            if (shard, block) != key:
                key, parts, graph = (shard, block), [], None
            if role == 0:
                parts.append(part)
                continue
            if not parts:
                continue
            if graph is None:
                graph = prepare()
            nodes, x, at, links, medoid, trees, tree_of = graph
            q = unit(matrix(part, "v"))
            ids = part.column(3).to_numpy()
            lists = part.column("near").to_pylist()
            pairs: list[tuple[int, int]] = []
            for i, node in enumerate(() if exact else ids.tolist()):
                starts = [medoid, *[at[j] for j in (node, *(lists[i] or ())) if j in at]]
                found = greedy(x, links, q[i], starts, cosine - SLACK)
                found = found[(x[found] @ q[i] >= cosine) & (nodes[found] != node)]
                if len(found):
                    known = np.unique(tree_of[found])  # one member of each tree met stands for it
                    pairs += [(node, int(nodes[k])) for k in known if trees.join(node, int(nodes[k]))]
                    tree_of[found] = known[0]
            for a in range(0, len(q) if exact else 0, 512):
                hit = (q[a:a + 512] @ x.T >= cosine) & (ids[a:a + 512, None] != nodes)
                for i in np.flatnonzero(hit.any(axis=1)).tolist():
                    node, found = int(ids[a + i]), np.flatnonzero(hit[i])
                    known = np.unique(tree_of[found])
                    pairs += [(node, int(nodes[k])) for k in known if trees.join(node, int(nodes[k]))]
                    tree_of[found] = known[0]
            if pairs:
                u, v = np.array(pairs, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
    return lean(run)


def _count(cosine: float):
    """Per member and block of its component: the copies it links with there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, home = None, [], None
        for k, part in _grouped(batches, 3):
            component, block, role = k
            if (component, block) != key:
                key, parts, home = (component, block), [], None
            if role == 0:
                parts.append(part)
                continue
            if not parts:
                continue
            if home is None:
                home = (unit(np.concatenate([matrix(p, "v") for p in parts])), np.concatenate([p.column(3).to_numpy() for p in parts]),
                        np.concatenate([p.column(5).to_numpy() for p in parts]))
            x, nodes, copies = home
            ids, q = part.column(3).to_numpy(), unit(matrix(part, "v"))
            counts = [((q[a:a + 512] @ x.T >= cosine) & (ids[a:a + 512, None] != nodes)) @ copies for a in range(0, len(q), 512)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(counts))], ["node", "links"])
    return lean(run)


def _audit(sample: np.ndarray, nodes: np.ndarray, cosine: float):
    """Links of the sample's vectors with a partition's, by brute force."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sample), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, ids = unit(matrix(batch, "v")), batch.column(batch.schema.get_field_index("rank")).to_numpy()
                weight = batch.column(batch.schema.get_field_index("copies")).to_numpy()
                for at in range(0, len(x), 512):
                    hit = (sample @ x[at:at + 512].T >= cosine) & (nodes[:, None] != ids[None, at:at + 512])
                    total += hit @ weight[at:at + 512]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(total)], ["node", "truth"])
    return lean(run)


def _edges(classes: DataFrame, pivots: np.ndarray, overlap: int, cosine: float, exact: bool = False) -> DataFrame:
    """u, v: a forest that joins all linked classes found with this overlap (`exact`: no graph, all blocks compared)."""
    fields = "node long, v array<double>, shards array<int>"
    placed = classes.select(F.col("rank").alias("node"), "v").mapInArrow(_assign(pivots, overlap), fields)
    placed = scratch(placed, "vec-placed")
    # a row per pivot at most: bounded by MAX_PIVOTS
    blocks = (placed.select(F.explode("shards").alias("shard")).groupBy("shard").count()
              .select("shard", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    blocks = F.broadcast(scratch(blocks, "vec-blocks"))
    member = placed.withColumn("shard", F.explode("shards")).join(blocks, "shard")
    own = F.pmod(F.xxhash64("node", "shard"), F.col("blocks")).cast("int")

    if exact:
        member = member.withColumn("near", F.lit(None).cast("array<long>"))
    else:
        built = member.select("shard", own.alias("block"), "node", "v").repartition("shard", "block")
        built = built.sortWithinPartitions("shard", "block", "node").mapInArrow(lean(_build), "node long, near array<long>")
        united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        graph = scratch(united.withColumnRenamed("node", "of"), "vec-graph")  # at most overlap lists a node
        member = member.join(graph, F.col("node") == F.col("of"))
    home = member.select("shard", own.alias("block"), F.lit(0).alias("role"), "node", "v", "near")
    query = member.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "shard", "block", F.lit(1).alias("role"), "node", "v", "near")
    stream = home.union(query).repartition("shard", "block").sortWithinPartitions("shard", "block", "role", "node")
    return stream.mapInArrow(_search(cosine, exact), "u long, v long")


def _links(classes: DataFrame, pivots: np.ndarray, overlap: int, cosine: float, exact: bool = False) -> DataFrame:
    """node, component, links of every class that links with another one."""
    comp = scratch(connected_components(_edges(classes, pivots, overlap, cosine, exact)), "vec-components")
    sizes = comp.groupBy(F.col("component").alias("c")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = scratch(sizes, "vec-sizes")
    member = comp.join(sizes, F.col("component") == F.col("c")).join(
        classes.select("rank", "v", "copies"), F.col("node") == F.col("rank")).select("component", "node", "v", "copies", "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    home = member.select("component", own.alias("block"), F.lit(0).alias("role"), "node", "v", "copies")
    query = member.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", "block", F.lit(1).alias("role"), "node", "v", "copies")
    stream = home.union(query).repartition("component", "block").sortWithinPartitions("component", "block", "role", "node")
    counts = stream.mapInArrow(_count(cosine), "node long, links long").groupBy(F.col("node").alias("of")).agg(
        F.sum("links").alias("links"))
    return scratch(comp.join(counts, F.col("node") == F.col("of")).select("node", "component", "links"), "vec-links")


def _truth(classes: DataFrame, slot, low: int, high: int, cosine: float) -> DataFrame:
    """node, truth of the linked vectors with a slot in low..high, a bounded number of them at a time."""
    drawn = scratch(classes.where((slot >= low) & (slot < high)).select("rank", "v", "dim", slot.alias("slot")), "vec-drawn")
    n, dim = drawn.agg(F.count(F.lit(1)), F.max("dim")).first()
    parts = max(1, -(-n * (dim or 1) // AUDIT_VALUES))
    out = None
    for part in range(parts):
        picked = drawn.where(F.pmod(F.xxhash64("slot", "rank"), F.lit(parts)) == part).select("rank", "v").toArrow()
        if not picked.num_rows:
            continue
        sample = unit(np.array(picked.column("v").to_pylist(), np.float64))
        own = classes.select("rank", "v", "copies").mapInArrow(
            _audit(sample, picked.column("rank").to_numpy(), cosine), "node long, truth long")
        own = scratch(own.groupBy("node").agg(F.sum("truth").alias("truth")).where("truth > 0"), "vec-truth")
        out = own if out is None else out.union(own)
    return out


def recall(classes: DataFrame, counts: DataFrame, cosine: float, rows: int = AUDIT_ROWS, wanted: int = AUDIT_LINKED) -> float:
    """Mean share of its links that the counts hold for a linked vector, outside the large components or
    in them, whichever is less.  1 where the sample's vectors have no link, or all are held."""
    n, top = classes.count(), 1 << 40
    counts = counts.select(F.col("node").alias("of"), "component", "links")
    sizes = counts.groupBy(F.col("component").alias("c")).agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > max(16, int(AUDIT_LARGE * counts.count())))
    large = F.broadcast(large.select("c", F.lit(True).alias("large")))  # at most 1 / AUDIT_LARGE rows
    counts = counts.join(large, F.col("component") == F.col("c"), "left")
    slot = F.pmod(F.xxhash64(F.lit(23), "rank"), F.lit(top))
    low, high = 0, min(top, int(top * max(rows, math.isqrt(n)) / max(n, 1)) + 1)
    end = min(top, max(high, int(top * AUDIT_MOST * math.isqrt(n) / max(n, 1)) + 1))
    found: dict[bool, list] = {False: [0, 0.0], True: [0, 0.0]}
    while True:
        truth = _truth(classes, slot, low, high, cosine)
        if truth is not None:
            share = F.least(F.coalesce("links", F.lit(0)) / F.col("truth"), F.lit(1.0))
            both = truth.join(counts, F.col("node") == F.col("of"), "left").groupBy(F.coalesce("large", F.lit(False)).alias("big"))
            for big, linked, held in both.agg(F.count(F.lit(1)), F.sum(share)).collect():
                found[big][0] += linked
                found[big][1] += held
        if found[False][0] >= wanted or high == end:
            return min((held / linked for linked, held in found.values() if linked), default=1.0)
        low, high = high, min(end, 4 * high)


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                    overlap: int = OVERLAP, target: float = AUDIT_RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    src = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), as_doubles(F.col(vector_col)).alias("v"))
    src = src.withColumn("v", F.when(usable(F.col("v")), F.col("v"))).withColumn("rank", id_rank(F.col("vec_id")))
    src = scratch(src, "vec-rows")
    # equal vectors share a key; the key, not the vector, is what later joins carry
    good = src.where(F.col("v").isNotNull())
    classes = good.groupBy("v").agg(F.min("rank").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = scratch(classes.withColumn("rank", F.xxhash64("v")).withColumn("dim", F.size("v")), "vec-classes")
    dims = [r[0] for r in classes.select("dim").distinct().sort("dim").limit(1025).collect()]
    if len(dims) > 1024:
        raise ValueError("more than 1024 different vector lengths")
    linked = None
    for dim in dims:
        own = classes.where(F.col("dim") == dim)
        n = own.count()
        pivots = sample_vectors(own, min(MAX_PIVOTS, max(1, n // SHARD_ROWS)))
        wide = min(overlap, len(pivots))
        while True:
            found = _links(own, pivots, wide, cosine)
            if recall(own, found, cosine) >= target:
                break
            wide = 2 * wide
            if wide * wide >= len(pivots):  # the next shards would cost more than all with all
                found = _links(own, pivots[:1], 1, cosine, exact=True)
                break
        linked = found if linked is None else linked.union(found)
    if linked is None:
        return src.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                          F.lit(True).alias("kept"))
    of = classes.join(linked, F.col("rank") == F.col("node"), "left").select(
        "rank", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rank").alias("component"))
    of = scratch(of, "vec-of")
    named = scratch(of.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_rank")), "vec-named")
    of = scratch(of.join(named, F.col("component") == F.col("c")).select(
        F.col("rank").alias("class"), "copies", "links", "component_rank"), "vec-result")
    out = src.withColumn("key", F.xxhash64("v")).join(of, F.col("v").isNotNull() & (F.col("key") == F.col("class")), "left")
    in_class = F.col("class").isNotNull()
    least = F.when(in_class, F.col("component_rank")).otherwise(F.col("rank"))
    return out.select("vec_id", F.when(in_class, F.col("links") + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      F.when(least < (1 << 63) - 1, least).alias("component_id"), (F.col("rank") == least).alias("kept"))
