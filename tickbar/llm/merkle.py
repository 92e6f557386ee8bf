"""Merkle manifest of a dataset: a root that fixes every row, and proofs of single rows.

A leaf is the digest of a row's fields.  Within a group (null is a group) the leaves stand in
the order of the key, and every run of `FANOUT` nodes becomes the digest of its members until one
is left, the group's subroot; the subroots, ordered by group, make the root in the same way.

Checkpoint and recompute: of the levels of a tree only every `EVERY`-th is stored, as one row per
aligned subtree (at most FANOUT**EVERY nodes).  A proof needs the levels between; they are made
again from the stored descendants of the subtree, give the siblings and are dropped.  Paths go from the
top down, a stored level at a time: a node's path is its own siblings in its subtree, then
the path of the subtree's top.

Rows that share a group, however many, are dealt by ranges of the whole order, so no task holds a group.
Defined results: a null field has its own mark (`-`), null keys come first, rows that are
equal in all fields stand side by side (any order gives the same digests), a lone row is its group's subroot, an
empty table has no leaves and no root.  Kept columns are carried along and are not part of a digest.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch

FANOUT = 8
EVERY = 3
SPAN = FANOUT**EVERY
_PATH = "array<struct<before:string,after:string>>"


def digest(parts: Iterable[Column]) -> Column:
    """SHA-256 (lowercase hex) of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(col: Column) -> Column:
    """`-` for null, else byte count, colon and value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*cols: Column) -> Column:
    """Digest of a row's fields."""
    return digest(field(c) for c in cols)


def _join(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _up(nodes: Column) -> Column:
    """The next level: a digest of each run."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(_join(F.slice(nodes, i * FANOUT + 1, FANOUT)), 256))


def _siblings(nodes: Column, k: Column) -> Column:
    """The rest of node k's run, before and after it."""
    within = k % FANOUT
    return F.struct(_join(F.slice(nodes, k - within + 1, within)).alias("before"),
                    _join(F.slice(nodes, k + 2, FANOUT - 1 - within)).alias("after"))


@dataclass
class Tree:
    """Stored levels of the trees of all groups, as frames over written tables.

    `blocks[i]`: aligned subtrees of level i * EVERY: g, height, block, nodes (pos, digest, kept).
    `tops`: g, subroot.  `kept`: names of the columns carried with a leaf.
    """

    blocks: list[DataFrame]
    tops: DataFrame
    kept: list[str]


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """Position of each row (g, key, digest, kept) in its group, and the group's size.

    Rows are dealt by ranges of (g, key, digest) and written, which fixes their places; the counts of each
    (range, group) give the offsets.
    """
    order = [F.asc_nulls_first(c) for c in ("g", "key", "digest")]
    ranged = scratch(rows.orderBy(*order).withColumns({"pid": F.spark_partition_id(), "mid": F.monotonically_increasing_id()}),
                     name)
    runs = ranged.groupBy("pid", "g").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("g")
    runs = runs.select(
        F.col("pid").alias("run_pid"), F.col("g").alias("run_g"), "first", F.sum("n").over(group).alias("size"),
        F.coalesce(F.sum("n").over(group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    met = ranged.join(runs, (F.col("pid") == F.col("run_pid")) & F.col("g").eqNullSafe(F.col("run_g")))
    return met.select("g", "digest", "kept", "size", (F.col("mid") - F.col("first") + F.col("offset")).alias("pos"))


def _height(size: Column, most: int) -> Column:
    """Levels above the leaves: the least h with FANOUT**h >= size."""
    out = F.lit(0)
    for h in range(most):
        out = out + F.when(size > FANOUT**h, 1).otherwise(0)
    return out


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes (g, height, pos, digest, kept) gathered by aligned subtree, and written."""
    cols = [c for c in ("pos", "digest", "kept") if c in nodes.columns]
    member = F.struct(*cols)
    return scratch(nodes.groupBy("g", "height", F.floor(F.col("pos") / SPAN).alias("block"))
                   .agg(F.sort_array(F.collect_list(member)).alias("nodes")), name)


def tree(rows: DataFrame, kept: list[str], name: str = "merkle") -> Tree:
    """Trees over rows (g, key, digest, kept), one for each g; kept is a struct of orderable columns."""
    placed = _placed(rows, f"{name}-leaves")
    # a BIGINT counts the rows, so no tree is higher than this
    nodes = placed.select("g", _height(F.col("size"), 21).alias("height"), "pos", "digest", "kept")
    stored, level, tops = [], 0, None
    while True:
        here = _blocks(nodes, f"{name}-level{level}")
        stored.append(here)
        up = here.select("g", "height", "block", F.least(F.col("height") - level, F.lit(EVERY)).alias("steps"),
                         F.col("nodes.digest").alias("d0"))
        for i in range(EVERY):
            up = up.withColumn(f"d{i + 1}", F.when(F.col("steps") > i, _up(F.col(f"d{i}"))).otherwise(F.col(f"d{i}")))
        up = scratch(up.select("g", "height", F.col("block").alias("pos"), F.col(f"d{EVERY}")[0].alias("digest")),
                     f"{name}-tops{level}")
        level += EVERY
        done = up.where(F.col("height") <= level).select("g", F.col("digest").alias("subroot"))
        tops = done if tops is None else tops.unionByName(done)
        nodes = up.where(F.col("height") > level)
        if nodes.isEmpty():
            return Tree(stored, tops, kept)


def _paths(t: Tree, above: DataFrame) -> DataFrame:
    """Leaves of the trees (g, digest, kept) with their whole paths.

    `above` (g, path, info): the way on from each tree's subroot, and a struct that every leaf below it gets.
    """
    down = None  # (g, pos, path, info) of the nodes of the stored level above
    for i in range(len(t.blocks) - 1, -1, -1):
        level = i * EVERY
        # a subtree that ends in the subroot goes on with `above`, any other with the path of its top
        over = above.select(F.col("g").alias("over_g"), F.lit(0).cast("long").alias("over_pos"), F.lit(True).alias("over_end"),
                            F.col("path").alias("over"), "info")
        if down is not None:
            over = over.unionByName(down.select(F.col("g").alias("over_g"), F.col("pos").alias("over_pos"),
                                                F.lit(False).alias("over_end"), F.col("path").alias("over"), "info"))
        here = t.blocks[i].select("g", "block", "nodes", F.least(F.col("height") - level, F.lit(EVERY)).alias("steps"),
                                  (F.col("height") <= level + EVERY).alias("ends"))
        met = here.join(over, F.col("g").eqNullSafe(F.col("over_g")) & (F.col("block") == F.col("over_pos"))
                        & (F.col("ends") == F.col("over_end")))
        met = met.withColumn("d0", F.col("nodes.digest"))
        for s in range(1, EVERY):  # the levels that were not stored
            met = met.withColumn(f"d{s}", F.when(F.col("steps") > s, _up(F.col(f"d{s - 1}"))))
        out = met.select("g", "steps", *[f"d{s}" for s in range(EVERY)], "over", "info",
                         F.posexplode("nodes").alias("k", "node"))
        own, k = [], F.col("k")
        for s in range(EVERY):
            own.append(F.when(F.col("steps") > s, F.array(_siblings(F.col(f"d{s}"), k))).otherwise(F.array().cast(_PATH)))
            k = F.floor(k / FANOUT).cast("int")
        down = out.select("g", F.col("node.pos").alias("pos"), F.col("node.digest").alias("digest"),
                          F.concat(*own, F.col("over")).alias("path"), "info",
                          *([F.col("node.kept").alias("kept")] if i == 0 else []))
    return down


@dataclass
class Manifest:
    """Stored trees: one for each group, and one over the subroots."""

    groups: Tree
    over: Tree
    group_col: str

    def root(self) -> DataFrame:
        """One row with the root (none for an empty dataset)."""
        return self.over.tops.select(F.col("subroot").alias("root"))

    def subroots(self) -> DataFrame:
        """One row per group: its subroot."""
        return self.groups.tops.select(F.col("g").alias(self.group_col), "subroot")


def build(rows: DataFrame, fields: list[str], group: str, key: str, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of `rows`: leaves from `fields`, a tree per `group`, leaves ascending by `key`.

    `keep`: columns (by name) that a leaf carries, for later use beside its proof.
    """
    kept = keep or {}
    narrow = rows.select(F.col(group).alias("g"), F.col(key).alias("key"), leaf(*(F.col(c) for c in fields)).alias("digest"),
                         F.struct(*[c.alias(n) for n, c in kept.items()], F.lit(0).alias("__none")).alias("kept"))
    # written first, so that the sampling of the ranges doesn't read and hash the texts once more
    groups = tree(scratch(narrow, "merkle-digests"), list(kept), "merkle")
    top = groups.tops.select(F.lit(0).alias("g"), F.col("g").alias("key"), F.col("subroot").alias("digest"),
                             F.struct(F.col("g").alias("group")).alias("kept"))
    return Manifest(groups, tree(top, ["group"], "merkle-over"), group)


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof: group, kept columns, leaf, subroot, root and path.

    `path`: the siblings before and after the node, level by level up to the root.
    """
    start = manifest.over.tops.select("g", F.array().cast(_PATH).alias("path"), F.struct(F.col("subroot").alias("root")).alias("info"))
    ways = _paths(manifest.over, start).select(F.col("kept.group").alias("g"), "path", F.struct(
        F.col("digest").alias("subroot"), F.col("info.root").alias("root")).alias("info"))
    out = _paths(manifest.groups, scratch(ways, "merkle-ways"))
    return out.select(F.col("g").alias(manifest.group_col), *[F.col(f"kept.{c}").alias(c) for c in manifest.groups.kept],
                      F.col("digest").alias("leaf"), "info.subroot", "info.root", "path")


def siblings_digest(path: Column) -> Column:
    """One digest over all siblings of a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))
