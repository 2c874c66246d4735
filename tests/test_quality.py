import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from tidemark import schemas
from tidemark.operators import quality


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(quality.key_report({"t": (df, ["k"]), "u": (df, ["k", "v"])})) == [("t", 1, 3), ("u", 0, 3)]
    assert rows(quality.repeated_keys(df, ["k"])) == [(1, 2)]
    assert quality.is_unique(df, ["v"]) and not quality.is_unique(df, ["k"])


def test_truncation(spark):
    schema = T.StructType([schemas.text("g", 1), schemas.text("w", 4), schemas.text("n", 2)])
    df = spark.createDataFrame([("F", "free", None), ("M", "paid", None), (None, "x", None), (None, "y", None)], schema)
    assert rows(quality.truncation_report({"staging": (df, schema)})) == [
        ("staging", "g", 100.0, 1), ("staging", "w", 50.0, 4),
    ]


def test_key_markers():
    quality.require_keys(schemas.STAR)
    broken = {"staging_events": schemas.STAGING_EVENTS, "loose": schemas.STAGING_SONGS}
    assert quality.missing_keys(broken) == ["loose"]
    with pytest.raises(ValueError, match="loose"):
        quality.require_keys(broken)


def test_nulls(spark):
    schema = T.StructType([schemas.text("a", nullable=False), schemas.text("b")])
    df = spark.createDataFrame([("x", None), (None, None), ("y", "z")], "a string, b string")
    assert rows(quality.null_violations(df, schema)) == [("a", 1)]
    assert rows(quality.not_null_columns(df.filter("a is not null"))) == [("a",)]


def test_histogram(spark):
    pick = random.Random(1)
    values = [pick.gauss(0, 10) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert [r["count"] for r in quality.histogram(df, "v").orderBy("bin").collect()] == list(np.histogram(values, 30)[0])
    same = spark.createDataFrame([(5,), (5,)], "v int")
    assert rows(quality.histogram(same, "v", 2)) == [(1, 2), (2, 0)]


def test_orphans_and_summary(spark):
    fact = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(quality.orphans(fact, dim, [("k", "id")])) == [(7, 2)]
    assert rows(quality.summary_by(fact, ["k"], ["k"])) == [(None, None, None, None), (1, 1, 1, 1), (7, 7, 7, 14)]


def test_audit(spark, tmp_path):
    audit = quality.load_audit(spark.range(50), lambda df: df.write.parquet(str(tmp_path / "t")))
    found = audit.first()
    assert found["rows"] == 50 and found["files"] is None and found["seconds"] > 0
    named = spark.range(50).select("id", (F.col("id") % 7).alias("_source"))
    assert quality.load_audit(named, lambda df: df.write.parquet(str(tmp_path / "u"))).first()["files"] == 7
