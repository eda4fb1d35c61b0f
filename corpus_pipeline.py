"""The corpus pipeline: raw documents to token ids, one operator of ``dossier.llm`` per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs.  Stages treat nulls, empty and very long texts, ties,
repeated rows, empty tables and further columns as their operators' docstrings define; all
columns of the input are carried through, but for the last stage's own (ids, decoded, n_tokens,
round_trip), which take the place of input columns of those names; decoded is not returned.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from dossier.llm.common import documents, settled, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half and that pass the base rules."""
    return quality_rules.keep(spark, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return exact_dedup.survivors(docs, *exact_dedup.build_index(spark, docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the least doc_id.

    Documents without doc_id cannot be linked and stay.
    """
    group = settled(spark, lambda: ngram_join.groups(spark, docs, words=5, p=80, q=100), "pipeline-groups")
    first = group.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's weight takes it, up to three times."""
    mix = mixing.mix(spark, docs, mixing.words())
    return mix.where("copies > 0").select(F.explode(F.sequence(F.lit(1), F.col("copies"))), "row").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ids (little-endian unsigned 32-bit), n_tokens and whether decoding gives the text."""
    encoded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.withColumns({
        "n_tokens": F.expr("octet_length(ids) div 4").cast("long"),
        "round_trip": F.col("decoded") == F.coalesce("text", F.lit(""))}).drop("decoded")


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("mixing sources to target weights", mixed), ("BPE encoding and decoding", tokens)]

#: The BPE stage cannot be said in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
