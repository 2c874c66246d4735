"""Document quality by Bradley-Terry ranking.

A preference pair is a document marked good and one marked bad. The strength of
a document is linear in features of its whole text, and the chance that it is
preferred is the logistic function of the difference of strengths; the weights
minimise the logistic loss on the pairs' feature differences. The cut lies at
the quantile of the training strengths that leaves the training share of bad
documents below it, and the score is the logistic function of the strength,
shifted so that the cut has the score ``cut_score``.

Fitted on at most ``sample`` labelled rows (a hash of the id chooses them), with
every row in at least one and at most ``PAIRS_EACH`` pairs drawn as the rarer
kind's. Only the weights are broadcast. NULL and empty texts have features, too:
those of a text of no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import labelled_sample
from tidemark.llm.logistic import fit_differences, sigmoid
from tidemark.llm.shingles import chunks, word_hashes

SAMPLE = 20_000
PAIRS_EACH = 8

_kinds = {
    "upper": [*range(65, 91)], "lower": [*range(97, 123)], "digit": [*range(48, 58)], "space": [0x20, *range(9, 14)],
    "line": [10], "stop": [ord(c) for c in ".?"], "bang": [ord("!")], "bar": [ord("|")], "comma": [ord(",")],
    "mark": [ord(c) for c in "#$%&*"], "tag": [ord(c) for c in "<>{}[]=\\/_"], "colon": [ord(c) for c in ":;@\"'()-+~^`"],
    "wide": [*range(0xC0, 256)],
}
_member = np.zeros((len(_kinds), 256), np.float32)
for _row, _bytes in enumerate(_kinds.values()):
    _member[_row, _bytes] = 1
NAMES = [*_kinds, "bytes", "words", "word_length", "repeated_neighbours", "distinct_words", "words_per_line"]


def features(texts: pa.Array) -> np.ndarray:
    """One row of features for each text."""
    out = [np.zeros((0, 2 * len(NAMES)))]
    for _, data, offsets in chunks(texts):
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        # byte counts of each text, then of each kind
        places = data if n == 1 else np.repeat(np.arange(n), sizes) * 256 + data
        counts = np.bincount(places, minlength=n * 256).reshape(n, 256)
        kinds = counts @ _member.T.astype(np.float64)
        hashes, of = word_hashes(data, offsets)
        words = np.bincount(of, minlength=n)
        same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        repeats = np.bincount(of[1:][same], minlength=n)
        order = np.lexsort((hashes, of))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
        distinct = np.bincount(of[order][new], minlength=n)
        size, some = np.maximum(sizes, 1)[:, None], np.maximum(words, 1)
        ratios = np.column_stack([
            kinds / size, np.log1p(sizes) / 10, np.log1p(words) / 10,
            (sizes - kinds[:, 3]) / some / 10, repeats / some, distinct / some, np.log1p(words / (kinds[:, 4] + 1)) / 10,
        ])
        # small shares matter most: each ratio also by its logarithm
        out.append(np.column_stack([ratios, np.log(ratios + 1e-3)]))
    return np.concatenate(out)


class Model:
    def __init__(self, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray, cut: float, cut_score: float):
        self.centre, self.spread, self.weights = centre, spread, weights
        self.cut, self.cut_score = cut, cut_score

    def strength(self, x: np.ndarray) -> np.ndarray:
        # row by row sums, so that a text's score does not depend on its neighbours
        return (((x - self.centre) / self.spread) * self.weights).sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.strength(x) - self.cut + np.log(self.cut_score / (1 - self.cut_score)))


def learn(labelled: DataFrame, cut_score: float = 0.3, seed: int = 7) -> Model:
    """Fit on a bounded frame with columns ``text`` and ``label`` (1 good, 0 bad)."""
    extract = F.arrow_udf(_feature_lists, "array<double>")
    rows = labelled.select("label", extract("text").alias("x")).toArrow()
    width = 2 * len(NAMES)
    y = rows["label"].to_numpy()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, width) if len(y) else np.zeros((0, width))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        # nothing to rank: all are what the sample has
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0 if len(good) else 20.0, cut_score)
    centre, spread = x.mean(0), x.std(0) + 1e-6
    scaled = (x - centre) / spread
    draw = np.random.default_rng(seed)
    pairs = max(len(good), len(bad), PAIRS_EACH * min(len(good), len(bad)))
    better, worse = (np.resize(draw.permutation(side), pairs) for side in (good, bad))
    draw.shuffle(worse)
    weights = fit_differences(scaled[better], scaled[worse], ridge=1.0)
    model = Model(centre, spread, weights, 0.0, cut_score)
    model.cut = float(np.quantile(model.strength(x), len(bad) / len(y)))
    return model


def _feature_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        x = features(texts)
        yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def score(text: Column, model: Model) -> Column:
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(shared.value.score(features(texts)))

    return run(text)


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``) where ``learn_from`` holds."""
    return learn(labelled_sample(docs, labels, "quality", learn_from, sample))
