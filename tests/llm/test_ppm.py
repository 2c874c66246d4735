import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ppm


class Brute:
    """Dictionaries and loops: the same model by its definition."""

    def __init__(self, texts, order=ppm.ORDER, share=ppm.SHARE):
        self.counts = [defaultdict(Counter) for _ in range(order + 1)]
        total = 0
        for text in texts:
            symbols = [ppm.START] * order + list(text) + [ppm.END]
            for i in range(order, len(symbols)):
                total += 1
                for k in range(order + 1):
                    self.counts[k][tuple(symbols[i - k : i])][symbols[i]] += 1
        for level in self.counts:
            for context in list(level):
                level[context] = {s: c for s, c in level[context].items() if c >= total * share}
                if not level[context]:
                    del level[context]
        self.order = order

    def chance(self, context, symbol):
        left, p = set(range(257)), 1.0
        excluded = set()
        for k in range(self.order, -1, -1):
            seen = self.counts[k].get(tuple(context[len(context) - k :]))
            if seen is None:
                continue
            live = {s: c for s, c in seen.items() if s not in excluded}
            if not live:
                continue
            bottom = sum(live.values()) + len(live)
            if symbol in live:
                return p * live[symbol] / bottom
            p *= len(live) / bottom
            excluded |= set(live)
        return p / len(left - excluded)

    def score(self, text):
        symbols = [ppm.START] * self.order + list(text) + [ppm.END]
        return sum(
            math.log10(self.chance(symbols[i - self.order : i], symbols[i])) for i in range(self.order, len(symbols))
        )


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", folded), None]


def expected(train, texts):
    model = Brute([(t or "").encode() for t in train])
    counts = Counter(w for t in train for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for t in texts:
        tokens = words(t)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        out.append((len(tokens), sum(counts[w] > 0 for w in tokens), total, base, model.score((t or "").encode())))
    return out


@pytest.mark.parametrize("share", [ppm.SHARE, 0.01])
def test_scores_equal_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(ppm, "SHARE", share)
    rnd = random.Random(5)
    texts = ["", None, "a", "abracadabra " * 40, "Été à la plage", "\x00\n\n  x", "zzzz unseen Words here"]
    texts += [" ".join(rnd.choice(["the", "cat", "Sat", "on", "mat", "été"]) for _ in range(30)) for _ in range(20)]
    data = [(i, t, i % 4 != 0, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, train boolean, n_tokens int")
    model, counts = ppm.train(df, F.col("train"))
    found = {r.doc_id: r for r in ppm.score(df, model, counts).collect()}
    monkeypatch.setattr(Brute.__init__, "__defaults__", (ppm.ORDER, share))
    wanted = expected([t for _, t, used, _ in data if used], texts)
    assert len(found) == len(texts)
    for (i, *_), want in zip(data, wanted):
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3], rel=1e-9)
        assert r.score == pytest.approx(want[4], rel=1e-9)


def test_chances_sum_to_one():
    text = np.frombuffer(b"abracadabra banana bandana", np.uint8)
    keys, _ = ppm.gram_keys(text, np.array([0, len(text)]))
    levels = []
    for k in range(ppm.ORDER + 1):
        found, n = np.unique(keys & np.uint64((1 << 9 * (k + 1)) - 1), return_counts=True)
        levels.append((found, n))
    trie = ppm.Trie(levels)
    symbols = np.array([*range(256), ppm.END], np.uint64)
    for context in [keys[3], keys[9], keys[-1], np.uint64(12345)]:
        chances = 10 ** trie.log10((context >> np.uint64(9) << np.uint64(9)) | symbols)
        assert abs(chances.sum() - 1) < 1e-9


def test_no_training_texts_and_no_rows(spark):
    df = spark.createDataFrame([(None, "ab"), (1, "")], "doc_id long, text string")
    model, counts = ppm.train(df, F.lit(False))
    found = {r.doc_id: r for r in ppm.score(df, model, counts).collect()}
    assert found[None].score == pytest.approx(-3 * math.log10(257)) and found[1].n_known == 0
    assert ppm.score(df.filter(F.lit(False)), model, counts).count() == 0


def test_rare_grams_of_large_training_are_known(spark):
    """A gram seen once among over 2^20 symbols."""
    texts = ["the cat " * 140_000, "zebra quiz"]
    df = spark.createDataFrame(list(enumerate([*texts, "zebra quit", "quiz"])), "doc_id long, text string")
    model, counts = ppm.train(df, F.col("doc_id") < 2)
    found = {r.doc_id: r.score for r in ppm.score(df.filter("doc_id > 0"), model, counts).collect()}
    brute = Brute([t.encode() for t in texts], share=0)
    for i, text in [(1, "zebra quiz"), (2, "zebra quit"), (3, "quiz")]:
        assert found[i] == pytest.approx(brute.score(text.encode()), rel=1e-9)


@pytest.mark.parametrize("hot", [0, 40])
def test_joined_chances_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(ppm, "HOT", hot)
    monkeypatch.setattr(ppm, "HOT_SHARE", 0.01)
    rnd = random.Random(6)
    texts = ["", None, "mat", "été " * 9, "zzz Zebra"]
    texts += [" ".join(rnd.choice(["the", "cat", "Sat", "on", "mat", "été"]) for _ in range(20)) for _ in range(12)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model, counts = ppm.train(df, F.col("doc_id") % 3 != 0)
    assert len(model.hot.keys) <= hot
    found = {r.doc_id: r for r in ppm.score(df, model, counts).collect()}
    for i, want in enumerate(expected([t for i, t in enumerate(texts) if i % 3], texts)):
        assert (found[i].n_tokens, found[i].n_known) == want[:2]
        assert found[i].base_score == pytest.approx(want[3], rel=1e-9)
        assert found[i].score == pytest.approx(want[4], rel=1e-9)
