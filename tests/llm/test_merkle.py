"""The Merkle manifest against a plain tree, at every size around the bounds of runs and subtrees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, queries
from tidemark.llm.merkle import SPAN

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def way(levels, at):
    """Left and right siblings of each level."""
    out = []
    for row in levels[:-1]:
        first = at // 16 * 16
        out.append((row[first:at], row[at + 1 : first + 16]))
        at //= 16
    return out


def brute(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(groups[s], key=lambda r: (first(r[0]), leaf(r)))
        trees[s] = (members, climb([leaf(r) for r in members]))
    upper = climb([trees[s][1][-1][0] for s in order])
    out = []
    for number, s in enumerate(order):
        members, levels = trees[s]
        above = way(upper, number)
        for i, r in enumerate(members):
            path = way(levels, i) + above
            changed = r
            if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 0 and r[4] is not None:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            folded = leaf(changed)
            for a, b in path:
                folded = h(*a, folded, *b)
            siblings = [d for a, b in path for d in a + b]
            out.append((r[0], leaf(r), levels[-1][0], upper[-1][0], h(*siblings), folded, folded == upper[-1][0]))
    return sorted(out, key=repr)


def run(spark, rows, **clashing):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(v) for n, v in clashing.items()})
    return sorted(map(tuple, queries.manifest_of(df).collect()), key=repr)


def rows_of(n, source, first=0):
    return [(first + i, source, "en", i, f"Text {i} Ünï") for i in range(n)]


@pytest.mark.parametrize("sizes", [[1], [2], [16, 17], [1, 16, 255, 256, 257], [SPAN, 1], [SPAN + 1, 3]])
def test_sizes_equal_brute_force(spark, sizes):
    rows = [r for k, n in enumerate(sizes) for r in rows_of(n, f"s{k}", 10_000 * k)]
    assert run(spark, rows) == brute(rows)


def test_many_groups_equal_brute_force(spark):
    rows = [(i, f"s{i}", None, None, "A") for i in range(300)] + rows_of(40, None, 1000) + rows_of(3, "", 2000)
    assert run(spark, rows) == brute(rows)


def test_edges_equal_brute_force(spark):
    rows = [
        (None, None, None, None, None), (None, "a", "x", 1, "Text"), (5, "a", None, 0, ""), (5, "a", None, 0, ""),
        (5, "a", None, 0, "other"), (7, "ä", "y", -3, "Long Word " * 50_000), (8, "z", "y", 2, "12:-:\n\u0000Q"),
    ]
    assert run(spark, rows, tree=1, pos="p", n=2, digest="d", id=3, part=0, at=1, group="g", first=9, path="q") == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    made = merkle.manifest(spark.createDataFrame([], SCHEMA), "source", "doc_id", merkle.leaf_of(F.col("text")))
    assert made.root() is None


def test_proofs_lead_to_the_root(spark):
    rows = rows_of(20, "a") + rows_of(300, "b", 100)
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), "source", "doc_id", merkle.leaf_of(*map(F.col, NAMES)))
    found = merkle.proofs(made).collect()
    assert len(found) == 320
    for r in found:
        digest = r.leaf
        for step in r.path:
            digest = h(step.left, digest, step.right)
        assert digest == r.root == made.root()


def test_retained_states_fold_every_slot():
    children = [h(str(i)) for i in range(16)]
    parent = merkle.Parent(children)
    for slot in range(16):
        for child in (children[slot], h("new")):
            assert parent.fold(slot, child) == h(*children[:slot], child, *children[slot + 1 :])
