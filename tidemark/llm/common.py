"""What the text operators share: tables, held-out rows, text columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of anything but these.
WORD_BREAKS = r"\x20\x09-\x0D"
WORD = rf"[^{WORD_BREAKS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as empty text."""
    as_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % F.lit(parts)


def held_out(doc_id: Column, parts: int) -> Column:
    return bucket(doc_id, parts) == 0


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Jobs run within hand at most about ``size`` at a time to a Python worker, however long single rows are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, sample: int) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``sample`` labelled documents, chosen by a hash of the id.

    Several labels of an id count as the greatest, and of several texts the
    least is taken. The sample's ids are broadcast, so no text is shuffled to
    find them.
    """
    marked = labels.filter(learn_from & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    chosen = marked.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(sample)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
