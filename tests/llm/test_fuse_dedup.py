import numpy as np
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import fuse_dedup

SCHEMA = "doc_id long, text string, old boolean, kept string, digest string"


def expected(data):
    groups = {}
    for i, text, *_ in data:
        groups.setdefault(text or "", []).append(i)
    out, used = [], set()
    for i, text, *_ in data:
        text = text or ""
        keep = max(groups[text], key=lambda x: (x is not None, x))
        stays = i == keep and text not in used
        if stays:
            used.add(text)
        out.append((i, keep, len(groups[text]), stays))
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


DATA = [
    (1, "a", True, "x", "y"), (2, "a", False, "x", "y"), (3, "b", True, None, None), (4, None, True, "x", "y"),
    (5, "", False, "x", "y"), (None, "c", False, "x", "y"), (6, "c", True, "x", "y"), (7, "d" * 50_000, False, "", ""),
    (8, "d" * 50_000, False, "", ""), (9, "e", False, "x", "y"), (9, "e", False, "x", "y"), (9, "f", None, "x", "y"),
    (10, "a ", True, "x", "y"),
]


def test_groups_cross_the_snapshot(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = fuse_dedup.dedup(df, F.col("old"))
    assert rows(out, "doc_id", "keep_id", "group_size", "kept") == expected(DATA)


def test_confused_digests_are_split_by_text(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = fuse_dedup.dedup(df, F.col("old"), digest_of=lambda t: F.substring(fuse_dedup.sha256(t), 1, 1))
    assert rows(out, "doc_id", "keep_id", "group_size", "kept") == expected(DATA)


def test_large_groups_are_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(fuse_dedup, "CHECK_ROWS", 3)
    data = [(i, "same" if i % 3 else f"own {i}", i % 2 == 0, "", "") for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(fuse_dedup.dedup(df, F.col("old")), "doc_id", "keep_id", "group_size", "kept") == expected(data)
    weak = fuse_dedup.dedup(df, F.col("old"), digest_of=lambda t: F.lit("0" * 8))
    assert rows(weak, "doc_id", "keep_id", "group_size", "kept") == expected(data)


def test_empty_table_and_empty_snapshot(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fuse_dedup.dedup(empty, F.col("old")).count() == 0
    new = spark.createDataFrame([(1, "a", False, "", ""), (2, "a", False, "", "")], SCHEMA)
    assert rows(fuse_dedup.dedup(new, F.col("old")), "doc_id", "keep_id", "kept") == [(1, 2, False), (2, 2, True)]


def test_filter_has_no_false_negatives():
    random = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = np.unique(random.integers(0, 2**63, n).astype(np.uint64))
        built = fuse_dedup.build_filter(keys)
        assert fuse_dedup.probe_filter(keys, *built).all()
        others = random.integers(2**63, 2**64, 20_000, dtype=np.uint64)
        assert fuse_dedup.probe_filter(others, *built).mean() < 0.008
        if n >= 50_000:
            assert len(built[3]) < 1.25 * n
