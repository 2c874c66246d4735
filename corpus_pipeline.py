"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept. ``run`` stores every stage's result
in the shared folder the session names, so a lost executor costs one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import fuse_dedup, packing, probminhash, quality_rules, toxicity
from tidemark.llm.common import bucket, held_out, table, text_of
from tidemark.storage import materialize

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text is not scored as toxic.

    The score is learned from the labels of the whole tables, as the stage's own
    documents may be few; what is kept is decided on the stage's documents.
    """
    model = toxicity.train(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5)
    )
    return docs.filter(toxicity.score(F.col("text"), model) < 0.5)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    judged = fuse_dedup.dedup(docs, bucket(F.col("doc_id"), 2) == 0)
    staying = judged.filter("kept").select("doc_id", F.unhex("text_sha256").alias("digest"))
    return _chosen(docs, F.unhex(F.sha2(text_of().cast("binary"), 256)), staying)


def unlike_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least id."""
    judged = probminhash.near_duplicates(docs)
    return _chosen(docs, probminhash.node_of("text"), judged.filter("kept").select("doc_id", F.col("node").alias("digest")))


def _chosen(docs: DataFrame, digest: Column, staying: DataFrame) -> DataFrame:
    """Rows that match a row of ``staying`` by id and digest, one for each.

    Rows travel as one struct, so that their columns may have any names.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), digest.alias("digest")
    )
    wanted = staying.select(F.col("doc_id").alias("wanted"), F.col("digest").alias("sign"))
    same = F.col("id").eqNullSafe(F.col("wanted")) & (F.col("digest") == F.col("sign"))
    met = keyed.join(wanted, same, "left_semi")
    # only rows that repeat an id and a text can match more than once
    repeated = materialize(
        keyed.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
            F.col("id").alias("wanted"), F.col("digest").alias("sign")
        ), "repeated",
    )
    if not repeated.isEmpty():
        once = met.join(repeated, same, "left_semi").groupBy("id", "digest").agg(F.first("row").alias("row"))
        met = met.join(repeated, same, "left_anti").unionByName(once)
    return met.select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths of at most 1024 tokens."""
    return packing.pack(docs, BYTE_BPE, greatest=1024).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("quality rules", rules),
    ("toxicity", clean),
    ("exact dedup", distinct_texts),
    ("near dedup", unlike_texts),
    ("packing", packed),
]

#: SQL can express neither the toxicity score nor the near-duplicate classes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
