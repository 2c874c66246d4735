"""Mixing sources to target weights by capped water-filling, and a seeded sample that meets them.

Each source has a weight, and all together are to give ``share`` times the words
there are. A source's target stops at ``epochs`` times its size; what it cannot
take goes to the others by their weights, until none is above its cap.

The outcome is found from the sources in the order of cap / weight, the levels at
which they fill up: a source is full if filling all to its level takes no more
than there is to give. Running sums in that order tell this for all sources at
once, so the rounds of clamping need no loop, however many there are.

A target is a number of whole repetitions of the source and a fraction of one.
All documents get the whole ones. For the fraction, documents are put in the
order of a seeded digest of id and text and taken until its words are used up;
the last one taken gives its first words only, so a source's words are its target
rounded down. No document is taken more than ``epochs`` times, rounded up.

All steps are native expressions. The order is a range partition by source and
digest, so a hot source spreads over many tasks; targets reach the documents of
heavy sources by a broadcast of their few rows. Rows that repeat are taken one by
one. NULL and empty texts have no words; NULL is a source, the last one. Extra
columns are dropped unless asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.quality_rules import words_of
from tidemark.operators.ordered import PIECE, ROW, dense_id, join_carry, pieces, running_sum
from tidemark.operators.skew import join_heavy
from tidemark.storage import materialize

WEIGHTS = (5, 2, 1)
SHARE, EPOCHS = 1.5, 2
SEED = 13


def repeating(weights: tuple[int, ...]) -> Column:
    """The weight of a source by its ``place`` in their order."""
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)


def targets(sizes: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``sizes`` (``source``, ``source_size``, ``weight``) with each source's ``target`` in words.

    Weights are positive. Where all caps together are below the total, every
    target is its cap.
    """
    capped = materialize(sizes.select(
        "source", "source_size", "weight", (F.col("source_size") * epochs).alias("cap"),
        (F.col("source_size") * epochs / F.col("weight")).alias("level"),
    ), "mix-caps")
    words, weights = capped.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    total = float(words * share)
    upto = running_sum(running_sum(capped, [], [F.col("level")], "cap", "caps"), [], [F.col("level")], "weight", "weights")
    # caps up to this level, and the others filled to it; times the weight, so that no division rounds
    need = F.col("weight") * F.col("caps") + F.col("cap") * (F.lit(weights) - F.col("weights"))
    marked = materialize(upto.withColumn("full", need <= F.col("weight") * F.lit(total)), "mix-levels")
    taken, open_weights = marked.agg(
        F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)), F.sum(F.when(~F.col("full"), F.col("weight")))
    ).first()
    shared = F.lit(total - taken) * F.col("weight") / F.lit(open_weights or 1)
    return marked.select(
        "source", "source_size", "weight", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``whole``, ``part``, ``taken``.

    The mix holds ``whole`` copies of the document and the first ``part`` words
    of one more: ``taken`` words. ``weights`` repeat over the sources in code
    point order, NULL last. ``keep_text`` adds ``text``, for ``texts``.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        F.size(words_of(text)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), text).cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("number"),  # tells rows that repeat apart, once stored
        *([F.col(text_column).alias("text")] if keep_text else []),
    ), "mix-sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = dense_id(found, [F.col("source").asc_nulls_last()], "place")
    sources = targets(placed.select("source", "source_size", repeating(weights).cast("long").alias("weight")), share, epochs)

    cut = pieces(rows, [F.col("source"), F.col("key"), F.col("number")])
    earlier = Window.partitionBy("source").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = cut.groupBy("source", PIECE).agg(F.sum("size").alias("_sum")).select(
        "source", PIECE, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    above = Window.partitionBy("source", PIECE).orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("_above", F.coalesce(F.sum("size").over(above), F.lit(0)))
    summed = materialize(
        join_carry(inside, carry, ["source"]).withColumn("before", F.col("_above") + F.col("_before")).drop(
            "_above", "_before", ROW, PIECE, "key", "number"
        ), "mix-order",
    )
    met = join_heavy(summed, materialize(sources, "mix-targets"), ["source"], null_safe=True)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size")) - F.col("before")
    part = F.greatest(F.lit(0).cast("long"), F.least("size", rest))
    return met.withColumn("whole", whole.cast("long")).withColumn("part", part).select(
        "doc_id", "source", "size", "source_size", "target", "whole", "part",
        (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), *(["text"] if keep_text else []),
    )


def texts(mixed: DataFrame) -> DataFrame:
    """The mix itself: ``doc_id``, ``copy`` (from 0) and ``text`` of each repetition, the last one cut where it ends early."""
    cut = F.array_join(F.slice(words_of(F.col("text")), 1, F.col("part").cast("int")), " ")
    copies = F.concat(
        F.transform(F.sequence(F.lit(1), F.col("whole").cast("int"), F.lit(1)), lambda _: F.col("text")),
        F.when(F.col("part") == F.col("size"), F.array("text")).otherwise(F.array(cut)),
    )
    whole = F.when(F.col("whole") > 0, copies).otherwise(F.slice(copies, -1, 1))
    kept = F.when(F.col("part") > 0, whole).otherwise(F.slice(whole, 1, F.col("whole").cast("int")))
    return mixed.filter("taken > 0").select("doc_id", F.posexplode(kept).alias("copy", "text"))
