"""Registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

import string

import public_tokenizers

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import (
    fuse_dedup, language, line_dedup, merkle, mixing, packing, ppm, probminhash, quality, quality_rules,
    sentencepiece_codec, survival, toxicity,
)
from tidemark.llm.common import bucket, held_out, table, text_of
from tidemark.operators.skew import join_heavy
from tidemark.storage import materialize

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5)
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = docs.select("doc_id", out.alias("held_out"), quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 10)
    model, words = ppm.train(docs, ~out)
    return ppm.score(docs, model, words).withColumn("held_out", out)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, greatest=1024)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5)
    model = language.learn(docs.filter(~out))
    found = docs.select("doc_id", out.alias("held_out"), language.predict(F.col("text"), model).alias("r"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the ids stand for the snapshot, the rest for the incoming batch; all rows are handled."""
    docs = table(spark, sf_dir, "documents")
    return fuse_dedup.dedup(docs, bucket(F.col("doc_id"), 2) == 0).drop("in_snapshot")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = docs.select("doc_id", out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), PIECE_BPE)
    return encoded.select(
        "doc_id", "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def manifest_of(docs: DataFrame) -> DataFrame:
    """Leaves of whole rows, in a tree a source; every fifth id (by crc32; none counts as empty) is tampered with."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(bucket(F.col("doc_id"), 5) == 0, merkle.leaf_of(*fields_of(fields), lowered))
    made = merkle.manifest(docs, "source", "doc_id", merkle.leaf_of(*fields_of([*fields, "text"])), tampered=tampered)
    return merkle.fold(made, "tampered").withColumnRenamed("id", "doc_id")


def fields_of(names: list[str]) -> list[Column]:
    return [F.col(n) for n in names]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_of(table(spark, sf_dir, "documents"))


def filter_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the five filters A to E say of each document, and its labels; an id's labels count as the greatest."""
    text, words = text_of(), F.col("words")
    counted = docs.select("doc_id", "source", "text", quality_rules.words_of(text).alias("words"))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    measured = materialize(counted.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        (F.size(words) < 200).alias("few"),
        (100 * F.size(F.array_distinct(words)) < 50 * F.size(words)).alias("repeating"),
        (100 * capitals > 2 * F.length(text)).alias("loud"),
        text.rlike("[#$%&*|]").alias("marked"),
    ), "filter-verdicts")
    firsts = measured.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copied = materialize(
        join_heavy(measured, firsts.select("digest", "first"), ["digest"], "left")
        .withColumn("copied", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("digest", "first"),
        "filter-verdicts",
    )
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")
    )
    return join_heavy(copied, known, ["doc_id"], "left")


def op12_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = filter_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    filters = dict(A="few", B="repeating", C="loud", D="marked", E="copied")
    return survival.audit(verdicts, "part", filters, {"good": "good", "toxic": "toxic"})


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash": op2_minhash,
    "op3_quality": op3_quality,
    "op4_quality_rules": op4_quality_rules,
    "op5_ppm": op5_ppm,
    "op6_packing": op6_packing,
    "op7_language": op7_language,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_merkle": op11_merkle,
    "op12_survival": op12_survival,
    "op13_mixing": op13_mixing,
}

STOP_WORD_LIST = ", ".join(f"'{w}'" for w in quality_rules.STOP_FORMS)

RULES_SQL = rf"""
    WITH cut AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM documents
    ), places AS (
        SELECT row, w, unnest(range(1, len(w) - 1)) AS p FROM cut WHERE len(w) >= 3
    ), windows AS (
        SELECT row, p, count(*) OVER (PARTITION BY row, w[p], w[p + 1], w[p + 2]) AS n FROM places
    ), covered AS (
        SELECT row, count(DISTINCT q) AS n
        FROM (SELECT row, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n > 1) GROUP BY row
    ), counted AS (
        SELECT row, doc_id, len(w) AS n_words,
               length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
               coalesce(covered.n, 0) AS n_repeat_words,
               len(list_intersect(w, [{STOP_WORD_LIST}])) AS n_stops,
               length(t) - length(replace(t, '!', '')) AS n_bangs
        FROM cut LEFT JOIN covered USING (row)
    ), judged AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
    )
"""

SQL: dict[str, str] = {
    "op4_quality_rules": RULES_SQL + """
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.1
                   AND n_stops >= 2 AND n_dup_lines / n_lines <= 0.5 AND n_bangs / n_words <= 0.1 AS kept
        FROM judged
    """,
    # the snapshot's ids need crc32, which the SQL side lacks: that column is left to the tests
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # every level of both trees by a recursive query; crc32 bit by bit
    "op11_merkle": r"""
        WITH RECURSIVE hashed AS (
            SELECT *, sha256(concat(_doc_id, _source, _lang, _n_chars, _text)) AS leaf,
                   CASE WHEN xor(crc, 4294967295) % 5 = 0
                        THEN sha256(concat(_doc_id, _source, _lang, _n_chars, _lowered)) END AS tampered
            FROM (
                SELECT doc_id, source, {fields},
                       list_reduce(list_prepend(4294967295, list_transform(
                               range(1, length(coalesce(CAST(doc_id AS VARCHAR), '')) + 1),
                               lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
                           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                               lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
                FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents)
            )
        ), leaves AS (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM hashed
        ), low AS (
            SELECT tree, 0 AS level, pos AS place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
            UNION ALL
            SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
            FROM low WHERE n > 1 GROUP BY tree, level, place // 16, n
        ), high AS (
            SELECT 0 AS level, tree AS place, digest, count(*) OVER () AS n FROM low WHERE n = 1
            UNION ALL
            SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
            FROM high WHERE n > 1 GROUP BY level, place // 16, n
        ), sides AS (
            SELECT tree, level, place, n, coalesce(string_agg(digest, '') OVER before, '') AS l, coalesce(string_agg(digest, '') OVER after, '') AS r
            FROM (SELECT tree, level, place, digest, n FROM low UNION ALL SELECT -1, level, place, digest, n FROM high)
            WHERE n > 1
            WINDOW before AS (PARTITION BY tree, level, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   after AS (PARTITION BY tree, level, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
        ), climb AS (
            SELECT tree, pos, tree AS here, 0 AS level, pos AS place, coalesce(tampered, leaf) AS digest, '' AS seen FROM leaves
            UNION ALL
            SELECT c.tree, c.pos,
                   CASE WHEN s.tree IS NULL THEN -1 ELSE c.here END,
                   CASE WHEN s.tree IS NULL THEN 0 ELSE c.level + 1 END,
                   CASE WHEN s.tree IS NULL THEN c.tree ELSE c.place // 16 END,
                   CASE WHEN s.tree IS NULL THEN c.digest ELSE sha256(s.l || c.digest || s.r) END,
                   CASE WHEN s.tree IS NULL THEN c.seen ELSE c.seen || s.l || s.r END
            FROM climb c LEFT JOIN sides s ON s.tree = c.here AND s.level = c.level AND s.place = c.place
            WHERE c.here >= 0 OR s.tree IS NOT NULL
        ), folded AS (
            SELECT tree, pos, digest, seen FROM climb c
            WHERE here = -1 AND level = (SELECT max(level) FROM high)
        )
        SELECT v.doc_id, v.leaf, t.digest AS subroot, r.digest AS root, sha256(f.seen) AS proof_sha256,
               f.digest AS folded_root, f.digest = r.digest AS verified
        FROM leaves v JOIN folded f USING (tree, pos) JOIN (SELECT tree, digest FROM low WHERE n = 1) t USING (tree)
        CROSS JOIN (SELECT digest FROM high WHERE n = 1) r
    """.replace("{fields}", ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END AS _{c}"
        for c in ("doc_id", "source", "lang", "n_chars", "text", "lowered")
    )),
    "op12_survival": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ), known AS (
            SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id
        ), judged AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS failed
            FROM cut LEFT JOIN known USING (doc_id)
        ), tallied AS (
            SELECT part, good, toxic, failed, count(*) AS n FROM judged GROUP BY ALL
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
        ), orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                   [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
        ), steps AS (
            SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0) AS before
            FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)
        ), counted AS (
            SELECT part, filter_order, step, own,
                   sum(CASE WHEN failed & before = 0 AND failed & own = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN failed & before = 0 AND failed & own > 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN failed & before > 0 AND failed & own > 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN good AND failed & before = 0 AND failed & own > 0 THEN n ELSE 0 END) AS good_lost,
                   sum(CASE WHEN toxic AND failed & before = 0 AND failed & own > 0 THEN n ELSE 0 END) AS toxic_lost
            FROM (SELECT t.*, filter_order, step, own, CAST(before AS INTEGER) AS before FROM tallied t, steps)
            GROUP BY ALL
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM counted
    """,
    # clamping round by round, as often as there are sources
    "op13_mixing": r"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size,
                   md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source
        ), fill AS (
            SELECT 0 AS round, source, source_size, weight, false AS clamped FROM sources
            UNION ALL
            SELECT round + 1, source, source_size, weight, clamped OR 2 * source_size <
                   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (clamped) OVER (), 0)) * weight
                   / sum(weight) FILTER (NOT clamped) OVER ()
            FROM fill WHERE round < (SELECT count(*) FROM sources)
        ), aimed AS (
            SELECT source, source_size, CASE WHEN clamped THEN 2.0::DOUBLE * source_size ELSE
                   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (clamped) OVER (), 0)) * weight
                   / sum(weight) FILTER (NOT clamped) OVER () END AS target
            FROM fill WHERE round = (SELECT max(round) FROM fill)
        ), placed AS (
            SELECT s.*, a.source_size, a.target,
                   CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS whole,
                   coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized s JOIN aimed a ON a.source IS NOT DISTINCT FROM s.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(whole * size + greatest(0, least(size, floor(target - whole * source_size) - before)) AS BIGINT) AS taken
        FROM placed
    """,
}
