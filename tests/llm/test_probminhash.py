import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import probminhash as pm
from tidemark.llm.shingles import chunks, shingles

import pyarrow as pa


def brute_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_similarity(a, b):
    p, q = ({k: 1 + np.log(c) for k, c in x.items()} for x in (a, b))
    p, q = ({k: w / sum(x.values()) for k, w in x.items()} for x in (p, q))
    both = set(p) | set(q)
    return sum(1 / sum(max(p.get(j, 0) / p[i], q.get(j, 0) / q[i]) for j in both) for i in set(p) & set(q))


def brute_classes(data, threshold=0.8):
    cut = [brute_shingles(t) for _, t in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            same = (data[i][1] or "") == (data[j][1] or "")
            if same or cut[i] and cut[j] and brute_similarity(cut[i], cut[j]) >= threshold - 1e-9:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i in range(len(data)):
        groups.setdefault(root(i), []).append(data[i][0])
    return sorted(sorted(g) for g in groups.values())


def classes_of(df):
    groups = {}
    found = df.collect()
    for r in found:
        groups.setdefault(r.class_id, []).append(r)
    for g in groups.values():
        assert {r.class_size for r in g} == {len(g)} and sum(r.kept for r in g) == 1
        assert [r.doc_id for r in g if r.kept] == [min(r.doc_id for r in g)]
    return sorted(sorted(r.doc_id for r in g) for g in groups.values())


def edited(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"edit{rnd.randrange(10**9)}"
    return " ".join(out)


def test_shingles_and_similarity_equal_brute_force():
    rnd = random.Random(2)
    texts = ["", None, "one", "A b  c\td\n", "a b c d e", "a b c d e " * 30, "é\x0bè ü ö ä ß", " x " * 3000]
    texts += [" ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(60))) for _ in range(60)]
    found = []
    for _, data, offsets in chunks(pa.array(texts)):
        found += shingles(data, offsets, 5)
    for text, (hashes, counts) in zip(texts, found):
        wanted = brute_shingles(text)
        assert len(set(hashes.tolist())) == len(wanted) and sorted(counts.tolist()) == sorted(wanted.values())
    for _ in range(150):
        i, j = rnd.randrange(len(texts)), rnd.randrange(len(texts))
        (a, ca), (b, cb) = found[i], found[j]
        got = pm.similarity(a, pm.weights(ca), b, pm.weights(cb))
        assert abs(got - brute_similarity(brute_shingles(texts[i]), brute_shingles(texts[j]))) < 1e-9


def test_registers_agree_with_the_probability_of_the_similarity():
    rng = np.random.default_rng(4)
    for _ in range(10):
        base = rng.integers(0, 2**63, 40).astype(np.uint64)
        a, b = np.unique(base[:34]), np.unique(base[6:])
        p, q = rng.integers(1, 4, len(a)).astype(float), rng.integers(1, 4, len(b)).astype(float)
        owner = np.repeat([0, 1], [len(a), len(b)])
        got = pm.signatures(owner, np.concatenate([a, b]), np.concatenate([p, q]), 2, 4000)
        assert abs((got[0] == got[1]).mean() - pm.similarity(a, p, b, q)) < 0.04


def test_classes_equal_brute_force(spark):
    rnd = random.Random(7)
    data, hub = [], [f"w{rnd.randrange(500)}" for _ in range(150)]
    data.append((0, " ".join(hub)))
    for i in range(1, 90):  # similar to the hub, hardly to each other
        data.append((i, edited(rnd, hub, rnd.choice([1, 2, 3]))))
    for i in range(90, 150):
        words = [f"v{rnd.randrange(3000)}" for _ in range(rnd.randrange(1, 80))]
        data.append((i, " ".join(words)))
        if i % 3 == 0:
            data.append((1000 + i, edited(rnd, words, 1)))
    data += [(2000, "Same Text"), (2001, "same text"), (2002, "Same Text"), (2003, "x " * 4000), (2004, "x " * 4000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert classes_of(pm.near_duplicates(df)) == brute_classes(data)


def test_a_tie_is_similar(spark):
    """Nine shingles each, eight of them shared: 8 / 10."""
    words = [f"w{i}" for i in range(13)]
    data = [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, " ".join([*words[:-2], "yet", "another"]))]
    assert classes_of(pm.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), bands=200, rows=1)) == [[1, 2], [3]]


def test_rows_of_one_id_make_no_pairs(spark, monkeypatch):
    """300 and 300 rows without an id, of two near texts: one pair is verified."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"])]
    df = spark.createDataFrame([(None, t) for t in texts for _ in range(300)] + [(5, "a b c d e f g")] * 50, "doc_id long, text string")
    seen, verified = [], pm._verified

    def watched(pairs, features, threshold):
        seen.append((pairs.count(), features.count()))
        return verified(pairs, features, threshold)

    monkeypatch.setattr(pm, "_verified", watched)
    found = pm.near_duplicates(df).collect()
    assert len(found) == 650 and sum(r.kept for r in found) == 2 and {r.class_size for r in found} == {600, 50}
    assert seen == [(1, 2)]


def test_template_pages_do_not_meet(spark, monkeypatch):
    """Pages that share a passage of 100 words and are no near copies are not compared with each other."""
    rnd = random.Random(8)
    shared = " ".join(f"w{i}" for i in range(100))
    data = [(i, " ".join([shared, *[f"own{rnd.randrange(10**9)}" for _ in range(rnd.randrange(40, 60))]])) for i in range(1200)]
    data += [(5000 + i, data[i][1] + " end") for i in range(0, 40)]
    compared, links = [], pm._open_groups

    def watched(placed):
        out = links(placed)
        compared.append(out.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return out

    monkeypatch.setattr(pm, "_open_groups", watched)
    found = classes_of(pm.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")))
    assert [g for g in found if len(g) > 1] == [[i, 5000 + i] for i in range(40)]
    assert compared[0] > 1200 and compared[-1] < 500


def test_prefixes_of_similar_texts_meet():
    rng = np.random.default_rng(9)
    often = rng.integers(0, 50, 64)
    for _ in range(300):
        pool = rng.integers(0, 2**63, 60).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 60), replace=False)) for _ in range(2))
        if rng.random() < 0.7:
            b = np.unique(np.append(a[rng.random(len(a)) < 0.95], pool[:2]))
        p, q = rng.integers(1, 4, len(a)).astype(float), rng.integers(1, 4, len(b)).astype(float)
        if pm.similarity(a, p, b, q) >= 0.8 - 1e-9:
            assert set(pm.prefix(a, p, often, 0.8).tolist()) & set(pm.prefix(b, q, often, 0.8).tolist())


def test_recall_of_banding(spark):
    """Of all pairs at 0.8 or more among texts with graded edits, nearly all are in one class."""
    rnd = random.Random(12)
    data = []
    for k in range(150):
        words = [f"v{rnd.randrange(10**6)}" for _ in range(rnd.randrange(60, 200))]
        data.append((2 * k, " ".join(words)))
        data.append((2 * k + 1, edited(rnd, words, max(1, len(words) // rnd.choice([45, 60, 90])))))
    near = [
        k for k in range(150)
        if brute_similarity(brute_shingles(data[2 * k][1]), brute_shingles(data[2 * k + 1][1])) >= 0.8 - 1e-9
    ]
    found = {tuple(g) for g in classes_of(pm.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")))}
    assert 40 < len(near) < 150
    assert sum((2 * k, 2 * k + 1) in found for k in near) >= 0.99 * len(near)


def test_nulls_repeats_and_clashing_names(spark):
    data = [
        (1, "a b c d e f", 1, "n"), (1, "a b c d e f", 1, "n"), (None, "A b c d e f", None, None), (3, None, 1, "n"),
        (4, "", 1, "n"), (5, " \n", 1, "n"), (6, "z", 1, "n"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, class_id long, node string")
    out = pm.near_duplicates(df)
    assert rows(out, "doc_id", "class_id", "class_size", "kept") == [
        (None, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True),
        (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True), (6, 6, 1, True),
    ]
    assert pm.near_duplicates(df.filter(F.lit(False))).count() == 0


def test_components_of_a_path(spark):
    path = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"x", b"y"), (b"z", b"z")]
    found = pm.components(spark.createDataFrame(path, "a binary, b binary")).collect()
    assert {bytes(r.component) for r in found if len(r.node) and r.node[0] <= 40} == {bytes([0])}
    assert {bytes(r.node): bytes(r.component) for r in found}[b"y"] == b"x"
