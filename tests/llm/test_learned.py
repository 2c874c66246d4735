"""Quality, language and toxicity models: edge cases and held-out accuracy on the driver tables."""

import os
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import language, logistic, quality, toxicity
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")


def test_logistic_fit_separates():
    rng = np.random.default_rng(1)
    x = rng.random((300, 6)) < 0.3
    y = (x[:, 0] | x[:, 1]).astype(int)
    at, features = np.nonzero(x)
    weights, bias = logistic.fit(at, features, y, 6, ridge=0.01)
    assert (((x @ weights + bias) > 0) == y).all()


def test_pairwise_weights_point_from_worse_to_better():
    rng = np.random.default_rng(2)
    better, worse = rng.normal(1, 1, (400, 2)), rng.normal(0, 1, (400, 2))
    better[:, 1], worse[:, 1] = rng.normal(0, 1, 400), rng.normal(0, 1, 400)
    weights = logistic.fit_differences(better, worse)
    assert weights[0] > 0.5 and abs(weights[1]) < 0.2


def test_quality_features_do_not_depend_on_neighbours():
    texts = ["", None, "One two. Three!", "a a a a b", "é " * 4000, "x" * 2_000_000, "one\ntwo | three"]
    together = quality.features(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.array_equal(together[i], quality.features(pa.array([text], pa.string()))[0])
    assert np.isfinite(together).all() and quality.features(pa.array([], pa.string())).shape[0] == 0


@pytest.fixture(scope="module")
def words(spark):
    text = """you are an idiot and a loser and so stupid that the moron said it was trash
        i hate this stupid person and what an ass you are a person of the kind we like""".replace("\n", " ") * 50
    counts = toxicity.letter_counts(spark.createDataFrame([(text,), (None,), ("",), ("w o r d s " * 50,)], "text string"))
    return toxicity.Words(counts)


@pytest.mark.parametrize("written, hidden", [
    ("1d10t", "idiot"), ("l0ser", "loser"), ("s.t.u.p.i.d", "stupid"), ("idiooot", "idiot"), ("tr@sh", "trash"),
    ("looooser", "loser"), ("m0r0n,", "moron"), ("stup1d!!", "stupid"), ("s|t|u|p|i|d", "stupid"), ("s!t!u!p!i!d", "stupid"),
    ("@$$", "ass"), ("1)10+", "idiot"), ("st" + "u" * 71 + "pid", "stupid"), ("stu" + "." * 100_000 + "pid", "stupid"),
])
def test_restores_hidden_words(words, written, hidden):
    assert hidden in words.of_token(written)


@pytest.mark.parametrize("written, restored", [
    ("an i d i o t and l0ser", "an idiot and loser"), ("you are a s t u p i d person", "you are a stupid person"),
    ("I h a t e", "i hate"), ("y o u i d i o t", "you idiot"), ("that id iot", "that idiot"), ("stu pid", "stupid"),
    ("s  t  u\np\ti d", "stupid"), ("a st u pid person", "a stupid person"), ("$ t u p 1 d.", "stupid"),
    ("I have a dog, and you", "I have a dog, and you"), ("", ""), (" \n", " \n"),
])
def test_restores_spaced_words(words, written, restored):
    assert words.restored(written) == restored
    for word in set(restored.lower().split()) - set(written.lower().split()):
        if word.strip(",."):
            assert word in next(words.features([written]))


def test_long_phrases_are_restored(words):
    phrase = "you are an idiot and so stupid that the moron said it was trash " * 300
    marked = "-".join(phrase.replace(" ", ""))
    assert len(words.restored(marked)) == len(phrase.replace(" ", ""))
    spaced = words.restored(" ".join(phrase.replace(" ", "")))
    assert {"idiot", "stupid", "trash"} <= set(spaced.split())


def test_plain_tokens_stay(words):
    assert words.of_token("plain") == toxicity.named("plain")
    assert words.of_token("!!!") == () and words.of_token("108.51.216.133")
    assert words.of_token("a" * 1_000_000) and words.of_token("." * 1_000_000 + "x" + "." * 1_000_000) == ("x",)


def paths(slots):
    return product(*slots)


def test_likeliest_is_least_over_all_paths(words):
    r, rnd = words.restorer, np.random.default_rng(3)

    def price(path):
        at, total = (26, 26, 26), sum(p for _, p in path)
        for c in "".join(x for x, _ in path) + ".":
            s = ord(c) - 97 if "a" <= c <= "z" else 26
            total += float(r.cost[(at[0] * 27 + at[1]) * 27 + at[2], s])
            at = (*at[1:], s)
        return total

    for _ in range(60):
        tokens = ["".join(rnd.choice(list("iidot1|0$@s.+")) for _ in range(rnd.integers(1, 5))) for _ in range(rnd.integers(1, 4))]
        slots = r.lattice(tokens, [0.5] * (len(tokens) - 1))
        best = min(price(p) for p in paths(slots))
        assert price([(r.likeliest(slots), 0.0)]) <= best + 1e-6
        chosen = r.likeliest(slots)
        assert min(price(p) for p in paths(slots) if "".join(x for x, _ in p) == chosen) == pytest.approx(best)


def test_stretches_do_not_depend_on_neighbours(words):
    texts = ["a b c", "", "s t u p i d", "plain words here", "é à ü", "x", " \n ", "id iot and 5 $ t"]
    assert words.restorer.stretches(texts) == [words.restorer.stretches([t])[0] for t in texts]


def test_toxic_scores_of_edge_texts(spark):
    data = [(i, ("bad awful " if i % 3 == 0 else "good fine ") + f"word{i} text") for i in range(90)]
    data += [(100, None), (101, ""), (None, "bad awful"), (102, "awful " * 50_000)]
    docs = spark.createDataFrame([(*r, 1.0) for r in data], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    scored = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s"))
    found = {r.doc_id: r.s for r in scored.collect()}
    assert found[0] > 0.5 > found[1] and found[None] > 0.5 and found[102] > 0.5
    assert found[100] == found[101] < 0.5
    one_sided = toxicity.train(docs, labels.withColumn("toxic", F.lit(0)), F.lit(True))
    assert docs.select(toxicity.score(F.col("text"), one_sided).alias("s")).agg(F.max("s")).first()[0] < 0.5
    none = toxicity.train(docs.filter(F.lit(False)), labels, F.lit(True))
    assert docs.filter(F.lit(False)).select(toxicity.score(F.col("text"), none)).count() == 0


def test_quality_of_edge_texts(spark):
    data = [(i, "A fine text of many words, it is." if i % 2 else "BAD!! TEXT!! HERE!!") for i in range(60)]
    data += [(100, None), (101, ""), (None, "x" * 100_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(100, None)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    found = {r.doc_id: r.s for r in docs.select("doc_id", quality.score(F.col("text"), model).alias("s")).collect()}
    assert found[1] > 0.3 > found[0] and found[100] == found[101]
    assert all(0 <= s <= 1 for s in found.values())
    nothing = quality.train(docs, labels.filter(F.lit(False)), F.lit(True))
    assert docs.select(quality.score(F.col("text"), nothing).alias("s")).count() == len(data)


def test_language_edge_cases(spark):
    english, french = "the cat and the dog with that which", "le chat et les chiens que nous avons"
    data = [(i, english if i % 2 else french, "en" if i % 2 else "fr") for i in range(40)]
    docs = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, lang string, lang_pred string")
    model = language.learn(docs)
    asked = spark.createDataFrame(
        [(1, "The dog and that"), (2, "Les chats que"), (3, None), (4, ""), (5, "123 !!"), (None, "the " * 60_000)],
        "doc_id long, text string",
    )
    found = asked.select("doc_id", language.predict(F.col("text"), model).alias("r")).select("doc_id", "r.*")
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert (got[1][0], got[2][0], got[None][0]) == ("en", "fr", "en")
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert language.learn(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert rows(asked.select(language.predict(F.col("text"), None).alias("r")).select("r.lang_pred").distinct()) == [("und",)]


def gram_sets(text):
    """Sets of 1-, 2- and 3-grams over lower-case letters, a break for other ASCII, and folded further bytes."""
    symbols = []
    for b in text.encode():
        c = chr(b).lower()
        symbols.append(c if "a" <= c <= "z" else " " if b < 128 else b if b >= 192 else ("tail", b % 128 % 64 % 37))
    return [{tuple(symbols[i : i + n]) for i in range(len(symbols) - n + 1)} for n in (1, 2, 3)]


def test_prediction_equals_a_dense_kernel(spark):
    rng = np.random.default_rng(4)
    syllables = {"aa": ["ba", "do", "ki", "é"], "bb": ["ba", "xu", "ro", "ü"], "cc": ["mi", "do", "xu", "no"]}

    def text(lang):
        return "".join(rng.choice(syllables[lang]) + rng.choice(["", " "]) for _ in range(rng.integers(4, 30)))

    known = [(text(lang), lang) for lang in syllables for _ in range(14)]
    asked = [text(lang) for lang in syllables for _ in range(10)]
    model = language.learn(spark.createDataFrame(known, "text string, lang string"), each=50, landmarks=50, ridge=0.1)
    found = [tuple(r) for r in spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "i int, text string").select(
        "i", language.predict(F.col("text"), model).alias("r")).orderBy("i").select("r.*").collect()]

    sets = [gram_sets(t) for t, _ in known]
    every = [set().union(*[s[n] for s in sets]) for n in range(3)]

    def kernel(a, b):
        parts = []
        for n in range(3):
            x, y = a[n] & every[n], b[n] & every[n]
            parts.append(len(x & y) / np.sqrt(max(len(x), 1) * max(len(y), 1)))
        return sum(parts) / 3

    names = sorted(syllables)
    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    target = np.array([[1.0 if lang == name else -1.0 for name in names] for _, lang in known])
    weights = np.linalg.solve(gram + 0.1 * np.eye(len(gram)), target)
    for t, (lang, score) in zip(asked, found):
        margins = np.array([kernel(gram_sets(t), s) for s in sets]) @ weights
        assert lang == names[margins.argmax()]
        assert score == pytest.approx(1 / np.exp(5 * (margins - margins.max())).sum(), abs=1e-3)


def test_language_sample_is_bounded_and_fair(spark):
    rows_ = [(77, f"the words of english number {i}", "en") for i in range(3000)]
    rows_ += [(None, f"les mots de france {i}", "fr") for i in range(900)] + [(i, "immer der gleiche", "de") for i in range(2000)]
    rows_ += [(i, f"only one {i}", f"l{i}") for i in range(700)] + [(1, None, "en"), (2, "x", None), (3, "12 !", "en")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    found = {r.lang: (r.n, r.top) for r in language.sampled(docs, 20, 20_000).groupBy("lang").agg(
        F.count("*").alias("n"), F.max("rank").alias("top")).collect()}
    assert found["en"] == found["fr"] == (20, 19) and found["de"] == (1, 0) and len(found) == 703
    assert language.sampled(docs, 400, 1000).count() == 703
    few = language.sampled(docs, 400, 2)
    assert {r.lang for r in few.collect()} == {"en", "fr"}
    model = language.learn(docs.filter("lang IN ('en', 'fr')"))
    asked = spark.createDataFrame([("the words of english",), ("les mots de france",)], "text string")
    assert [r[0] for r in asked.select(language.predict(F.col("text"), model)["lang_pred"]).collect()] == ["en", "fr"]


def test_pairwise_ranking_equals_descent_over_all_pairs():
    rng = np.random.default_rng(6)
    better, worse = rng.normal(0.5, 1, (60, 3)), rng.normal(0, 1, (60, 3))
    fitted = logistic.fit_differences(better, worse)
    weights, ridge = np.zeros(3), 1.0
    for _ in range(20_000):
        gap = better - worse
        slope = gap.T @ (1 / (1 + np.exp(gap @ weights))) - ridge * weights
        weights += 0.02 * slope
    assert fitted == pytest.approx(weights, abs=1e-4)


@tables
@pytest.mark.parametrize("name, label, least", [("op3_quality", "quality", 0.97), ("op9_toxicity", "toxic", 0.93)])
def test_held_out_labels(spark, name, label, least):
    found = QUERIES[name](spark, FOLDER)
    met = found.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").filter("held_out")
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert met.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


@tables
def test_held_out_languages(spark):
    found = QUERIES["op7_language"](spark, FOLDER)
    met = found.join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert met.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98
