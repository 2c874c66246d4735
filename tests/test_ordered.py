import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import ordered


@pytest.fixture(autouse=True, params=[1, 100, 200_000])
def task_rows(request, monkeypatch):
    """Groups are cut always, if large, or never."""
    monkeypatch.setattr(ordered, "TASK_ROWS", request.param)


def sample(spark, seed=0, n=300):
    pick = random.Random(seed)
    data = [(None if pick.random() < 0.1 else pick.choice("aaab"), pick.randrange(40), pick.randrange(5)) for _ in range(n)]
    return spark.createDataFrame(data, "k string, o int, v int"), data


def test_running_sum_per_key(spark):
    df, data = sample(spark)
    expected = sorted(
        ((k, o, v, sum(w for j, p, w in data if j == k and p <= o)) for k, o, v in data),
        key=lambda r: [(x is not None, x) for x in r],
    )
    assert rows(ordered.running_sum(df, ["k"], [F.col("o")], "v", "s")) == expected


def test_running_sum_of_everything_descending(spark):
    df, data = sample(spark, 3)
    found = ordered.running_sum(df.select("o", "v"), [], [F.col("o").desc()], "v", "s")
    assert rows(found) == sorted((o, v, sum(w for _, p, w in data if p >= o)) for _, o, v in data)


def test_dense_id(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(5)
    numbered = ordered.dense_id(df, [F.col("x")], "n", start=1)
    assert rows(numbered) == [(i, i + 1) for i in range(1000)]


def test_unique_id(spark):
    numbered = ordered.unique_id(spark.range(100).repartition(4), "n")
    assert numbered.select("n").distinct().count() == 100


def test_hot_keys_span_pieces(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    cut = ordered.pieces(df, [F.col("k"), F.col("id")])
    per_piece = [r["count"] for r in cut.groupBy(ordered.PIECE).count().collect()]
    assert len(per_piece) == 4 and max(per_piece) < 2000
    assert cut.filter("k = -1").select(ordered.PIECE).distinct().count() >= 3
    in_order = [(r["k"], r["id"]) for r in cut.orderBy(ordered.ROW).collect()]
    assert in_order == sorted(in_order)
