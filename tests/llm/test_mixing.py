"""Targets against clamping round by round, and what the mix takes."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def rounds(sizes, weights, share, epochs):
    """Clamp what is above its cap and share the rest by weight, until nothing is."""
    total, clamped = share * sum(sizes), set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in clamped)
        open_ = [i for i in range(len(sizes)) if i not in clamped]
        aims = {i: rest * weights[i] / sum(weights[j] for j in open_) for i in open_}
        above = {i for i in open_ if aims[i] > epochs * sizes[i]}
        if not above:
            return [epochs * sizes[i] if i in clamped else aims[i] for i in range(len(sizes))]
        clamped |= above


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_rounds(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, rnd.randrange(10), rnd.randrange(10**rnd.randrange(1, 9))]) for _ in range(200)]
    weights = [rnd.choice([5, 2, 1]) for _ in sizes]
    df = spark.createDataFrame([(str(i), s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight long")
    for share, epochs in ((1.5, 2), (0.5, 1), (3, 3), (2.9, 3)):
        found = {int(r.source): r.target for r in mixing.targets(df, share, epochs).collect()}
        assert [found[i] for i in range(len(sizes))] == pytest.approx(rounds(sizes, weights, share, epochs))
        assert sum(found.values()) == pytest.approx(share * sum(sizes))


def docs_of(spark, big=False):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a"] * 8 + ["b", "ä", "Z", "", None]), "w " * rnd.randrange(60)) for i in range(600)]
    rows += [(None, "a", "one two"), (None, "a", "one two"), (7, "a", None), (8, None, ""), (9, "empty", " \n")]
    if big:  # so big that all others are full
        rows.append((10, "big", "x\t" * 90_000))
    rows += [(77, "same", "equal rows of five words")] * 500
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns(
        {c: F.lit(1) for c in ("size", "key", "number", "place", "whole", "part", "before", "target", "weight")}
    )


@pytest.mark.parametrize("big", [False, True])
def test_sources_meet_their_targets(spark, big):
    rows, docs = docs_of(spark, big)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sums = {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.whole * r.size + r.part
        s = sums.setdefault(r.source, [0, 0, r.source_size, r.target])
        s[0] += r.size
        s[1] += r.taken
    names = sorted((s for s in sums if s is not None)) + [None]
    want = rounds([sums[s][0] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)
    for name, aim in zip(names, want):
        size, taken, source_size, target = sums[name]
        assert size == source_size and target == pytest.approx(aim)
        assert taken == int(target + 1e-6)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)


def test_seed_changes_the_choice(spark):
    _, docs = docs_of(spark)
    one, other = ({(r.doc_id, r.taken) for r in mixing.mix(docs, seed=s).collect()} for s in (1, 2))
    assert one != other


def test_texts_hold_what_is_taken(spark):
    _, docs = docs_of(spark)
    mixed = mixing.mix(docs, keep_text=True)
    out = mixing.texts(mixed).withColumn("words", F.size(mixing.words_of(F.col("text"))))
    taken = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("words").alias("n")).collect()}
    wanted = {r.doc_id: r.n for r in mixed.filter("taken > 0").groupBy("doc_id").agg(F.sum("taken").alias("n")).collect()}
    assert taken == wanted


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(docs_of(spark)[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
