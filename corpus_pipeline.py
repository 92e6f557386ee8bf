"""Corpus pipeline: the stages, in order, over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's `docs`.  All but the last return the columns of
`documents`.  Stages share one session and its executors, so all run with bounded Arrow batches.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbar.llm import bpe, mixing, quality, simhash, substring
from tickbar.llm.common import bound_batches, scratch
from tickbar.llm.queries import MIX_OTHER, MIX_SEED, MIX_WEIGHTS, QUALITY_TARGETS, table, tokenizer_path


def bounded(stage):
    """The stage with bounded Arrow batches, also when its result is read later."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@bounded
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds of low quality or toxic go."""
    models = quality.fit(docs, table(spark, sf_dir, "labels"), QUALITY_TARGETS)
    scored = quality.score(docs, models, QUALITY_TARGETS, prefix="__p_", score_col="__score", keep_col="__keep")
    return scored.where("__keep").select(*docs.columns)


@bounded
def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, radius=2)


@bounded
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that stand in a document with a smaller id go; n_chars follows the text."""
    cut = substring.remove_repeats(docs, substring.find_repeats(docs), kept_col="text", n_col="__n", removed_col="__removed")
    return cut.withColumn("n_chars", F.when(F.col("__removed") > 0, F.char_length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


@bounded
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, and shuffled; a copy is a row of its own."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_OTHER, seed=MIX_SEED, copy_col="__copy", copies_col="__copies",
                      key_col="__key").select(*docs.columns)


@bounded
def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining row, with the round trip checked."""
    path = tokenizer_path()
    both = bpe.decode(bpe.encode(docs, path, keep=["doc_id", "text", "lang", "source"]), path)
    return both.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


STAGES = [("quality classifier", quality_stage), ("simhash near-dedup", simhash_stage),
          ("substring dedup", substring_stage), ("mixing sources", mix_stage), ("bpe", encode_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
