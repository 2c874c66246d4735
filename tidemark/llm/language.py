"""Language identification by a string kernel.

The kernel of two texts is the mean, over n = 1, 2, 3, of the cosine of their
n-gram presence vectors (a blended spectrum). Symbols are bytes of the text with
A-Z in lower case; all other ASCII bytes count as one break. Only n-grams of the
landmark texts are looked at, so a text becomes a row of 0s and 1s.

Landmarks are a few texts of each language. Nystroem features, the kernel with
the landmarks times the inverse root of the landmarks' own kernel matrix, go
into one ridge regression for each language against the rest. A batch of texts
is scored by two matrix products: with the landmarks' presence vectors, and with
the regression's coefficients. As presence does not tell much from little, a
text is scored in blocks, whose margins are averaged by length: of a text in two
languages, the longer part decides.

The sample is bounded by ``sample`` texts in all and ``each`` a language: different
texts, chosen by a hash of the text, so ids play no part and copies count once.
Every language has its share of the sample and of the ``LANDMARK_ROWS`` landmarks,
one text at least; only of more languages than ``sample`` the most frequent are
learned. The model has a row a landmark of at most 128 + 128^2 + 128^3 columns (in
practice thousands).

NULL texts and texts without a letter are ``und`` with score 0. Rows that share an
id, or have none, are learned from and scored like all others; further columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.shingles import chunks
from tidemark.storage import materialize

EACH, SAMPLE = 400, 20_000
LANDMARKS, LANDMARK_ROWS = 40, 1_000
UNKNOWN = "und"
#: Bytes of a text that make a row, and rows in a matrix product.
BLOCK, ROWS = 1_500, 256

# 0: break; 1-26: a-z; 27-90: bytes of 0xC0 and over; 91-127: continuation bytes, folded
_symbols = np.zeros(256, np.int32)
_symbols[97:123] = _symbols[65:91] = np.arange(1, 27)
_symbols[0xC0:] = 27 + np.arange(64)
_symbols[0x80:0xC0] = 91 + np.arange(64) % 37
_STARTS = (0, 128, 128 + 128**2)
_SPAN = 128 + 128**2 + 128**3


def _codes(data: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code, text) of the 1-, 2- and 3-grams; none crosses texts."""
    s = _symbols[data]
    yield s, owner
    pairs = s[:-1] * 128 + s[1:]
    whole = owner[:-1] == owner[1:]
    yield pairs[whole] + _STARTS[1], owner[:-1][whole]
    triples = pairs[:-1] * 128 + s[2:]
    whole = owner[:-2] == owner[2:]
    yield triples[whole] + _STARTS[2], owner[:-2][whole]


def _groups(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, text of each byte, texts) of at most ROWS texts."""
    for first in range(0, len(texts), ROWS):
        for _, data, offsets in chunks(texts.slice(first, ROWS)):
            yield data, np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets)), len(offsets) - 1


def _gram_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        out: list[np.ndarray] = []
        for data, owner, n in _groups(texts):
            codes, of = map(np.concatenate, zip(*_codes(data, owner)))
            both = np.unique(of.astype(np.int64) * _SPAN + codes)
            cuts = np.searchsorted(both, np.arange(1, n) * _SPAN)
            out += np.split((both % _SPAN).astype(np.int32), cuts)
        yield pa.array(out, pa.list_(pa.int32()))


class Model:
    """Landmark rows over their own n-grams, and coefficients for each language."""

    def __init__(self, grams: np.ndarray, landmarks: np.ndarray, coefficients: np.ndarray, names: list[str]):
        self.grams, self.landmarks, self.coefficients, self.names = grams, landmarks, coefficients, names
        self.blocks = np.searchsorted(grams, _STARTS[1:])
        self._table: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_table": None}

    def presence(self, data: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        if self._table is None:
            self._table = np.full(_SPAN, -1, np.int32)
            self._table[self.grams] = np.arange(len(self.grams))
        x = np.zeros((n, len(self.grams)), np.float32)
        for codes, of in _codes(data, owner):
            at = self._table[codes]
            known = at >= 0
            x[of[known], at[known]] = 1
        return x

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return scaled(x, self.blocks)

    def decide(self, data: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language, score) of n texts: margins of their blocks, averaged by length."""
        sizes = np.bincount(owner, minlength=n)
        parts = np.maximum(1, -(-sizes // BLOCK))
        first, start = np.cumsum(parts) - parts, np.cumsum(sizes) - sizes
        block = first[owner] + (np.arange(len(data)) - start[owner]) // BLOCK
        total = np.zeros((n, len(self.names)))
        for low in range(0, int(parts.sum()), ROWS):
            high = min(low + ROWS, int(parts.sum()))
            cut = slice(*np.searchsorted(block, [low, high]))
            own = (block[cut] - low).astype(np.int32)
            margins = (self.scaled(self.presence(data[cut], own, high - low)) @ self.landmarks.T) @ self.coefficients
            text = np.searchsorted(first, np.arange(low, high), "right") - 1
            np.add.at(total, text, margins * np.bincount(own, minlength=high - low)[:, None])
        total /= np.maximum(sizes, 1)[:, None]
        best = total.argmax(1)
        chance = np.exp(5 * (total - total.max(1, keepdims=True)))
        return best, 1 / chance.sum(1)


def scaled(x: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Unit length in each block of equal n, a third each."""
    out = x.astype(np.float32)
    for part in np.split(np.arange(x.shape[1]), blocks):
        if len(part):
            block = out[:, part[0] : part[-1] + 1]
            block /= np.sqrt(np.maximum(block.sum(1, keepdims=True), 1) * 3)
    return out


def sampled(labelled: DataFrame, each: int, sample: int) -> DataFrame:
    """``lang``, ``text`` and ``rank`` (from 0, in the order of a hash) of at most ``each`` different texts a language."""
    usable = labelled.filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").select("lang", "text", F.xxhash64("text").alias("hash"))
    sizes = materialize(
        usable.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).orderBy(F.desc("n"), "lang").limit(sample),
        "languages",
    )
    each = max(1, min(each, sample // max(sizes.count(), 1)))
    # a text is taken with chance each / n by its hash; 40 % more and a few, as the number varies
    part = F.pmod("hash", F.lit(1_000_003)) / 1_000_003
    taken = usable.join(F.broadcast(sizes), "lang").filter(part * F.col("n") < 1.4 * each + 8)
    texts = taken.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(part, "hash")) - 1
    return texts.withColumn("rank", rank).filter(F.col("rank") < each).select("lang", "text", "rank")


def learn(
    labelled: DataFrame, each: int = EACH, landmarks: int = LANDMARKS, ridge: float = 0.1, sample: int = SAMPLE
) -> Model | None:
    """Fit on rows ``text``, ``lang``; None where there is nothing to learn from."""
    grams = F.arrow_udf(_gram_lists, "array<int>")
    rows = sampled(labelled, each, sample).select("lang", "rank", grams("text").alias("grams")).toArrow()
    if not len(rows):
        return None
    order = rows.sort_by([("lang", "ascending"), ("rank", "ascending")])
    langs, lists = order["lang"].to_pylist(), [np.asarray(g.values) for g in order["grams"].combine_chunks()]
    names = sorted(set(langs))
    landmarks = max(1, min(landmarks, LANDMARK_ROWS // len(names)))
    kept = range(len(langs))
    chosen = [i for i, r in enumerate(order["rank"].to_pylist()) if r < landmarks]
    dictionary = np.unique(np.concatenate([lists[i] for i in chosen]))
    blocks = np.searchsorted(dictionary, _STARTS[1:])

    def presence(which: Sequence[int]) -> np.ndarray:
        x = np.zeros((len(which), len(dictionary)), np.float32)
        for row, i in enumerate(which):
            at = np.searchsorted(dictionary, lists[i])
            at[at == len(dictionary)] = 0
            x[row, at[dictionary[at] == lists[i]]] = 1
        return scaled(x, blocks)

    marks = presence(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    place = {name: i for i, name in enumerate(names)}
    code = np.array([place[lang] for lang in langs])
    square, target = np.zeros((good.sum(),) * 2), np.zeros((good.sum(), len(names)))
    for first in range(0, len(kept), ROWS):
        phi = (presence(kept[first : first + ROWS]) @ marks.T).astype(np.float64) @ root
        own = code[first : first + ROWS]
        square += phi.T @ phi
        target += phi.T @ np.where(own[:, None] == np.arange(len(names)), 1.0, -1.0)
    weights = np.linalg.solve(square + ridge * np.eye(len(square)), target)
    return Model(dictionary, marks, (root @ weights).astype(np.float32), names)


PREDICTION = "lang_pred string, score double"


def predict(text: Column, model: Model | None) -> Column:
    """A struct of ``lang_pred`` and ``score``; all texts are ``und`` without a model."""
    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return nothing
    shared = SparkSession.active().sparkContext.broadcast(model)
    fields = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())]

    @F.arrow_udf(PREDICTION)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        names = pa.array(fitted.names)
        for texts in batches:
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for data, owner, n in _groups(texts):
                b, s = fitted.decide(data, owner, n)
                best.append(b)
                score.append(s)
            chosen = names.take(pa.array(np.concatenate(best)))
            yield pa.StructArray.from_arrays([chosen, pa.array(np.concatenate(score), pa.float64())], fields=fields)

    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), run(text)).otherwise(nothing)
