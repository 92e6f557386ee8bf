"""Registered queries of the pipeline operators: `opN_<name>(spark, sf_dir) -> DataFrame`.

Each applies its operator with production parameters to the whole intended table;
ORACLE has the DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    hilbert,
    langid,
    lockstep,
    merkle,
    mixing,
    permutation,
    quality,
    secretscan,
    simhash,
    substring,
    vecgraph,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op9_bpe(spark, sf_dir):
    path = tokenizer_path()
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    return bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text("ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


#: Target weights of the named sources; all others share the pool's weight.
MIX_WEIGHTS = {"src0": 0.15, "src1": 0.10, "src2": 0.10, "src3": 0.05}
MIX_OTHER, MIX_SEED = 0.60, 7


@register
def op3_mix(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_OTHER, seed=MIX_SEED)
    # made of the shuffled rows, so the texts do move
    return mixed.select("doc_id", "source", "copy_no", "n_copies", "shuffle_key", F.sha2("text", 256).alias("text_sha256"))


ORACLE["op3_mix"] = mixing.mix_sql(MIX_WEIGHTS, MIX_OTHER, MIX_SEED)


@register
def op2_warc(spark, sf_dir):
    root = warc.archive_root(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), root)
    read = warc.read_records(index, root)
    return read.select("page_id", "payload_bytes",
                       F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
                       .alias("payload_digest"), "record_type", "refers_to")


ORACLE["op2_warc"] = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT}
                THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""


SHARD_DIMENSIONS = [hilbert.Dimension("source"), hilbert.Dimension("lang"), hilbert.Dimension("n_chars", number=True)]


@register
def op6_shard(spark, sf_dir):
    placed = hilbert.shard(table(spark, sf_dir, "documents"), SHARD_DIMENSIONS, 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


@register
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@register
def op4_substring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cut = substring.remove_repeats(docs, substring.find_repeats(docs), keep=["doc_id"], one_space=True)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@register
def op5_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs), keep=["doc_id"])
    return found.select("doc_id", (langid.fold("doc_id") == langid.HELD_OUT).alias("held_out"), "lang_pred", "score",
                        "cross_entropy", "rejected")


#: Label columns and their bad value.
QUALITY_TARGETS = {"quality": 0, "toxic": 1}


@register
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    models = quality.fit(docs, table(spark, sf_dir, "labels"), QUALITY_TARGETS)
    return quality.score(docs, models, QUALITY_TARGETS, keep=["doc_id"])


@register
def op7_vecgraph(spark, sf_dir):
    return vecgraph.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


ORACLE["op7_vecgraph"] = """
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT reach.vec_id, links.v FROM reach JOIN links ON links.u = reach.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT l.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN degree d ON d.u = l.vec_id"""


@register
def op8_permutation(spark, sf_dir):
    return permutation.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@register
def op11_lockstep(spark, sf_dir):
    import public_tokenizers

    columns = {n: F.size(c).cast("long") for n, c in (("n_a", "ids_a"), ("n_b", "ids_b"), ("n_groups", "links"))}
    columns["groups_sha256"] = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return lockstep.align(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"),
                          keep=["doc_id"], columns=columns, groups=True).scored()


BASE_KINDS = ("assign", "access", "hex")


@register
def op12_secretscan(spark, sf_dir):
    found = secretscan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = [secretscan.count(F.col("findings"), k).alias(f"n_{k}") for k in secretscan.KINDS]
    return found.select("doc_id", *counts, F.sha2(secretscan.spans(F.col("findings"), BASE_KINDS), 256).alias("base_sha256"),
                        secretscan.spans(F.col("findings")).alias("spans"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@register
def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    plain = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tampered = F.when(crc % 3 == 0, merkle.leaf(*plain, F.translate("text", _UPPER, _LOWER)))
    manifest = merkle.build(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                            keep={"doc_id": F.col("doc_id"), "tampered": tampered})
    proved = merkle.proofs(manifest)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return proved.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql() -> str:
    def text(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf_of(value):
        return "sha256(" + " || ".join(text(c) for c in ("doc_id", "source", "lang", "n_chars", value)) + ")"

    def up(nodes):
        return (f"list_transform(range(0, CAST((len({nodes}) + 7) // 8 AS BIGINT)), "
                f"lambda i: sha256(array_to_string({nodes}[i * 8 + 1:i * 8 + 8], '')))")

    step = "xor(a >> 1, (a & 1) * 3988292384)"
    crc = f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: {step})), 4294967295)"""
    siblings = """array_to_string(l.nodes[(p.at // 8) * 8 + 1:p.at], '') || '*' ||
      array_to_string(l.nodes[p.at + 2:(p.at // 8) * 8 + 8], '')"""
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {leaf_of('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0
              THEN {leaf_of(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {leaf_of('text')} END AS start FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
levels AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL SELECT lang, lvl + 1, {up('nodes')} FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
             FROM levels WHERE len(nodes) = 1),
over_levels AS (
  SELECT 0 AS lvl, list(subroot ORDER BY pos) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL SELECT lvl + 1, {up('nodes')} FROM over_levels WHERE len(nodes) > 1),
own AS (SELECT p.doc_id, p.lang, p.pos, list({siblings} ORDER BY l.lvl) AS path
  FROM (SELECT placed.*, lvl, pos >> (3 * lvl) AS at FROM placed, range(0, 21) r(lvl)) p
  JOIN levels l ON l.lang IS NOT DISTINCT FROM p.lang AND l.lvl = p.lvl AND len(l.nodes) > 1 GROUP BY ALL),
over_own AS (SELECT p.lang, list({siblings} ORDER BY l.lvl) AS path
  FROM (SELECT subroots.*, lvl, pos >> (3 * lvl) AS at FROM subroots, range(0, 21) r(lvl)) p
  JOIN over_levels l ON l.lvl = p.lvl AND len(l.nodes) > 1 GROUP BY ALL),
whole AS (
  SELECT d.doc_id, d.leaf, d.start, s.subroot, (SELECT nodes[1] FROM over_levels WHERE len(nodes) = 1) AS root,
         list_concat(coalesce(own.path, []), coalesce(over_own.path, [])) AS path
  FROM placed d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang
  LEFT JOIN own ON own.lang IS NOT DISTINCT FROM d.lang AND own.pos = d.pos
  LEFT JOIN over_own ON over_own.lang IS NOT DISTINCT FROM d.lang),
folded AS (SELECT *, list_reduce(list_concat([start], path), lambda a, x: sha256(replace(x, '*', a))) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '*', '')) AS proof_sha256, folded_root,
       folded_root = root AS verified FROM folded"""


ORACLE["op13_merkle"] = _merkle_sql()
