import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import quality_rules as q

COLUMNS = ("doc_id", *q.BASE, "base_failed", "kept")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {p + k for found in places.values() if len(found) > 1 for p in found for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = len(words), sum(map(len, words))
    symbols, bangs = len(re.findall(r"[#*$%&|<>]", text)), text.count("!")
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    kept = not failed and (
        2 <= chars / n <= 14 and symbols / n <= 0.1 and len(set(words) & set(q.STOP_FORMS)) >= 2
        and dup / len(lines) <= 0.5 and bangs / n <= 0.1
    )
    return n, chars, symbols, dup, len(covered), failed, kept


def test_counts_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = ["", None, " \n\t", "a", "a b c", "a b c a b c", "one two\x0bthree\x0cfour\rfive", "été | <b> 日本 😀 #1 $5 !!"]
    texts += ["the of and " * 4000, "x " * 100, "\n".join(["same line here"] * 40)]
    for _ in range(60):
        texts.append("".join(rnd.choice(["the ", "a ", "b ", "c\n", "de ", "f! ", "g\t", "h ", "# "]) for _ in range(rnd.randrange(150))))
    data = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "one", 7), (3, "a", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_words int")
    wanted = sorted([(i, *brute(t)) for i, t, _ in data], key=lambda r: [(v is not None, v) for v in r])
    assert rows(q.measure(df), *COLUMNS) == wanted
    assert q.measure(df.filter(F.lit(False))).count() == 0


def test_keep_agrees_and_keeps_columns(spark):
    good = "The cat of the house and the dog went on to be with it. " * 1 + " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, good, "x"), (2, "short", "x"), (3, None, None), (1, good, "x")], "doc_id long, text string, _keep string")
    kept = q.keep(df)
    assert kept.columns == df.columns and rows(kept, "doc_id") == [(1,), (1,)]


def test_other_thresholds(spark):
    df = spark.createDataFrame([(1, "a b " * 60)], "doc_id long, text string")
    assert not q.measure(df).first().kept
    text = " ".join(f"w{i}" for i in range(60))
    loose = q.measure(spark.createDataFrame([(1, text)], "doc_id long, text string"), rules=(q.Rule("words", 50, 70),))
    assert loose.first().kept
