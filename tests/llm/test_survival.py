"""The filter audit against filters applied one by one."""

from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import queries, survival

DOCS = "doc_id long, source string, text string"
LABELS = "doc_id long, quality int, toxic int"


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_popcounts_equal_counting(words):
    found = survival.popcounts(np.array(words, np.uint32))
    assert list(found) == [sum(w >> i & 1 for w in words) for i in range(32)]


def test_truth_words():
    words = survival.truth_words(5)
    for failed in range(32):
        assert [bool(words[failed] >> s & 1) for s in range(32)] == [not failed & s for s in range(32)]


def fails(rows, row):
    doc, _, text = row
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    out = ""
    out += "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""
    out += "D" if set(text) & set("#$%&*|") else ""
    smaller = [r for r in rows if r[0] is not None and doc is not None and r[0] < doc and (r[2] or "") == text]
    return out + ("E" if smaller else "")


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = sorted({r[1] or "" for r in rows})
    verdict = [(r, fails(rows, r)) for r in rows]
    out, total = {}, Counter()
    for part in parts:
        own = [(r, f) for r, f in verdict if (r[1] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left, gone = own, []
            for step, letter in enumerate(order, 1):
                lost = [(r, f) for r, f in left if letter in f]
                left = [(r, f) for r, f in left if letter not in f]
                total[part, letter] += len(lost)
                out[part, order, step] = [
                    len(left), len(lost), sum(letter in f for _, f in gone), sum(f == letter for _, f in own),
                    sum(r[0] in good for r, _ in lost), sum(r[0] in toxic for r, _ in lost),
                ]
                gone = gone + lost
    return sorted((p, o, s, *v, total[p, o[s - 1]]) for (p, o, s), v in out.items())


def audit(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("part", "words", "digest", "first", "good", "n")})
    verdicts = queries.filter_verdicts(docs, spark.createDataFrame(labels, LABELS))
    filters = dict(A="few", B="repeating", C="loud", D="marked", E="copied")
    return sorted(map(tuple, survival.audit(verdicts, "part", filters, {"good": "good", "toxic": "toxic"}).collect()))


LONG = " ".join(f"word{i}" for i in range(250))


def test_audit_equals_brute_force(spark):
    rows = [
        (1, "a", LONG), (2, "a", LONG), (3, "b", LONG), (3, "b", LONG), (None, "b", LONG), (None, None, None),
        (4, None, ""), (5, "", "ABC"), (6, "a", LONG.upper()), (7, "a", "w " * 400), (8, "a", LONG + " #"),
        (9, "c", "Word " * 300 + "50%"), (10, "c", "é ü\x0b\x0c\r\n" * 300), (11, "c", "a b " * 200_000),
    ] + [(100 + i, "hot", f"{LONG} {i % 7}") for i in range(60)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 1, None), (6, 0, 1), (8, 1, 1), (None, 1, 1), (999, 1, 1), (104, 1, 0)]
    assert audit(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert audit(spark, [], []) == []
    assert len(audit(spark, [(1, "a", "x")], [])) == 600


def test_fewer_filters_and_null_verdicts(spark):
    df = spark.createDataFrame([("p", True, None), ("p", False, True), (None, None, True)], "part string, x boolean, y boolean")
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley)
             for r in survival.audit(df, "part", {"X": "x", "Y": "y"}, {}).collect()}
    assert found["p", "XY", 1] == (1, 1, 0, 2) and found["p", "YX", 2] == (0, 1, 0, 2)
    assert found[None, "XY", 2] == (0, 1, 0, 2)
    with pytest.raises(ValueError):
        survival.survivors(df, "part", list("abcdef"), [])


def test_many_parts(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 1700).cast("string").alias("part"), (F.col("id") % 3 == 0).alias("x"))
    monkeypatch.setattr(survival, "PARTS", 100)
    found = survival.survivors(df, "part", ["x"], [])
    assert found.count() == 1700
    assert found.agg(F.sum(F.col("all_")[0]), F.sum(F.col("all_")[1])).first() == (5000, 3333)
