"""Heavy keys and joins split by them."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.skew import PER_KEY, heavy_hashes, join_heavy, key_skew


@pytest.fixture(scope="module")
def facts(spark):
    """Half of 20,000 rows have one key, a tenth none, the rest one each."""
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    return spark.range(20_000).select("id", key.alias("k"))


def test_heavy_keys_are_found(spark, facts):
    assert len(heavy_hashes(facts, F.xxhash64("k"), 0.01)) == 2
    found = {r.key: (r.rows, r.share) for r in key_skew(facts, "k", 0.01).collect()}
    assert found == {"hot": (10_000, 0.5), None: (2_000, 0.1)}
    assert key_skew(facts.limit(0), "k").collect() == []
    assert rows(key_skew(facts, "id", 0.01)) == []


def test_a_share_below_the_sketch_is_refused(facts):
    with pytest.raises(ValueError):
        heavy_hashes(facts, F.xxhash64("k"), 1e-6)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_split_join_equals_plain_join(spark, facts, how, null_safe):
    keys = [("hot", 1), ("hot", 2), (None, 3)] + [(str(i), i) for i in range(1, 4000, 3)]
    right = spark.createDataFrame(keys, "name string, v int")
    split = join_heavy(facts, right, [("k", "name")], how, null_safe)
    same = F.col("k").eqNullSafe(F.col("name")) if null_safe else F.col("k") == F.col("name")
    assert rows(split) == rows(facts.join(right, same, how).drop("name"))
    assert "BroadcastHashJoin" in split._jdf.queryExecution().executedPlan().toString()


def test_heavy_key_with_many_right_rows(spark, facts):
    right = spark.range(PER_KEY + 1).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    assert join_heavy(facts.limit(200), right, ["k"]).count() == 100 * (PER_KEY + 1)


def test_types_must_agree(spark, facts):
    with pytest.raises(ValueError):
        join_heavy(facts, spark.range(3), [("k", "id")])
