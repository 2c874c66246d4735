"""The pipeline against plain Python on a small fixture."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_probminhash import brute_classes
from tests.llm.test_quality_rules import brute as brute_rules
from tidemark.llm import packing


def fixture(rnd):
    stop = ["the", "of", "and", "to", "in", "is"]
    def prose(n):
        return " ".join(rnd.choice(stop) if rnd.random() < 0.3 else f"w{rnd.randrange(5000)}" for _ in range(n))
    texts = [prose(rnd.randrange(60, 160)) for _ in range(50)]
    texts += [t for t in texts[:6]]  # exact copies
    for t in texts[10:16]:  # near copies
        words = t.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [prose(20), "### $$$ | " * 60, "", None]
    toxic = [f"{prose(80)} idiot {prose(10)} scum" for _ in range(12)]
    return texts, toxic


def test_stages_equal_plain_python(spark, tmp_path):
    rnd = random.Random(9)
    texts, toxic = fixture(rnd)
    data = [(i, t, "en", "src", len(t or "")) for i, t in enumerate([*texts, *toxic])]
    data.append((1000, texts[0].replace("the", "1d10t scum", 1), "en", None, None))
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i >= len(texts))) for i, *_ in data[:-1]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {i: t for i, t, *_ in data}
    kept = {i for i, t in rows.items() if brute_rules(t)[-1]}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == docs.columns
        if name == "toxicity":
            kept -= {i for i in kept if i >= len(texts)}
        if name == "exact dedup":
            last = {}
            for i in sorted(kept):
                last[rows[i]] = i
            kept = set(last.values())
        if name == "near dedup":
            kept = {min(c) for c in brute_classes([(i, rows[i]) for i in sorted(kept)])}
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        assert {r.doc_id for r in docs.select("doc_id").collect()} == kept, name
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i in kept:
        ids = np.array([*library.encode(rows[i], add_special_tokens=False).ids, packing.END_ID], "<u4")
        pieces = docs.filter(F.col("doc_id") == i).orderBy("start").collect()
        assert b"".join(bytes(p.ids) for p in pieces) == ids.tobytes()


def test_repeated_rows_stay_once(spark):
    words = " ".join(f"the w{i}" for i in range(60))
    data = [(1, words, "en", "s", 5), (1, words, "en", "s", 5), (None, words + " end", None, None, None), (2, None, "en", "s", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.distinct_texts(spark, docs, "")
    assert out.columns == docs.columns and sorted(map(str, (r.doc_id for r in out.collect()))) == ["1", "2", "None"]
    out = corpus_pipeline.unlike_texts(spark, docs, "")
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == ["1", "2"]
    assert corpus_pipeline.unlike_texts(spark, docs.filter(F.lit(False)), "").count() == 0


NAMES = ["_digest", "_toxic", "_id", "_d", "id", "digest", "row", "wanted", "sign", "node", "_q_words", "_q_n_words", "_q_text", "a.b"]


def test_columns_of_any_name_are_carried(spark, tmp_path):
    folder, words = str(tmp_path), " ".join(f"the of w{i}" for i in range(60))
    base = spark.createDataFrame(
        [(1, words, "en", "s", 5), (1, words, "en", "s", 5), (2, words + " " + "long " * 30_000, None, None, None), (3, None, "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    base.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = base.withColumns({n: F.lit(n) for n in NAMES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[n] for n in NAMES] == NAMES, name
    assert corpus_pipeline.packed(spark, docs, folder).count() > 0


def test_stages_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == [], name
