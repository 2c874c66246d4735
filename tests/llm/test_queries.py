"""Text queries that SQL can express, against SQL on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(FOLDER):
        duck.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    expected = duck.execute(SQL[name])
    columns = sorted(c[0] for c in expected.description)
    wanted = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(wanted, key=repr)
