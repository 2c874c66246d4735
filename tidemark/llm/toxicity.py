"""Toxicity by noisy-channel restoration of words, then a linear score of the restored text.

Written words are taken as hidden words sent through a channel that swaps letters
for look-alikes, puts marks between letters, repeats letters, or sets blanks
inside words. The possible hidden texts form a lattice: each slot offers some
letters at a cost, a look-alike may also be a mark, and a blank between two
tokens may be none. A Viterbi search over the lattice under a character language
model (four letters, counted over all documents) finds the likeliest.

Tokens are decoded one by one, and stretches of tokens together where a blank may
have been set inside a word: beside letters that stand alone in a row or are no
likely word, and where the model, by the letters around a blank, prefers none by
``JOINED``. The latter test is the lattice's own cost for that blank, taken for
all blanks of a text at once, so blanks that fail it need no search. Tokens whose
lattice has one path are left as they are. Work is linear in the text.

The written words, the restored words and the first letters of both are features
of a logistic regression. It is fitted on at most ``sample`` labelled rows (a hash
of the id chooses them), on the features whose presence tells the labels apart best.

The language model has 27^4 numbers and the classifier ``features`` weights, so
what is broadcast does not grow with the data.

NULL and empty texts have the score of no evidence. Ids are used only to find
labels: rows without one, or that share one, are scored like all others. Further
columns of the documents are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import WORD_BREAKS, labelled_sample
from tidemark.llm.logistic import fit, sigmoid
from tidemark.llm.shingles import chunks
from tidemark.storage import materialize

#: What may stand for a letter.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", ")": "d", "€": "e", "£": "l",
}
#: Costs, as negative natural logarithms: a look-alike for a letter, a mark between letters, a look-alike that is
#: a mark, one of two equal letters too many, a longer run, and a blank between two letters alone, beside one, or
#: between pieces.
SWAPPED, MARKED, DROPPED, DOUBLED, REPEATED = 0.7, 0.7, 2.5, 2.5, 0.7
SPACED, BESIDE, JOINED = 0.5, 2.5, 5.0
#: Marks around words.
BEFORE, AFTER = "\"'#%&*([{.,;:?<>_~^-", "\"'#%&*)]}.,;:?!<>_~^-"
#: From this cost on, a letter alone is no likely word.
ODD = 3.5

OTHER = 26  # every character but a-z
BASE = 27
SAMPLE = 20_000
FEATURES = 4_096
#: Standard errors by which a feature's share must differ between the labels.
APART = 4.5
CACHE_WORDS = 250_000
TOGETHER = 1 << 18

_symbols = np.full(256, OTHER, np.int32)
_symbols[97:123] = np.arange(26)
_symbols[65:91] = np.arange(26)

_code = {chr(97 + i): i for i in range(26)}
_token = re.compile(rf"[^{WORD_BREAKS}]+")
_noisy = re.compile(r"([^\W\d_])\1|[\W\d_]")
# a letter that repeats, or a run of one character that is no letter
_special = re.compile(r"([a-z])\1+|([\W\d_])\2*", re.S)
_letter = re.compile(r"[^\W\d_]")

# bytes: word breaks, what may follow a letter alone, and look-alikes of one byte
_blank = np.zeros(256, bool)
_blank[[9, 10, 11, 12, 13, 32]] = True
_stop = np.zeros(256, bool)
_stop[list(b".,;:!?")] = True
_alike = np.zeros(256, bool)
_alike[[ord(c) for c in LOOK_ALIKES if c.isascii()]] = True


def letter_counts(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """How often each run of four symbols occurs in the texts, letters spaced apart left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BASE**4, np.int64)
        for batch in batches:
            for _, data, _ in chunks(batch.column(0)):
                s = _symbols[data]
                if len(s) > 3:
                    grams = ((s[:-3] * BASE + s[1:-2]) * BASE + s[2:-1]) * BASE + s[3:]
                    alone = (s[:-2] == OTHER) & (s[1:-1] != OTHER) & (s[2:] == OTHER)
                    apart = np.flatnonzero(alone[:-2] & alone[2:])  # two letters alone in a row
                    written = np.ones(len(grams), bool)
                    written[apart] = written[apart + 1] = False
                    total += np.bincount(grams[written], minlength=BASE**4)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["gram", "n"])

    counted = docs.select(text_column).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most 27^4 rows
    out = np.zeros(BASE**4, np.int64)
    out[table["gram"].to_numpy()] = table["n"].to_numpy()
    return out


class Restorer:
    """Most likely hidden texts of tokens, under a table of letter counts."""

    def __init__(self, counts: np.ndarray):
        grams = counts.reshape(BASE**3, BASE).astype(np.float64)
        shorter = grams.reshape(BASE, BASE**2, BASE).sum(0)  # two letters of context
        back = (shorter + 1) / (shorter.sum(1, keepdims=True) + BASE)
        #: The cost of each letter to stand alone, as one that begins a word and ends it.
        self.alone = -np.log(back[OTHER * BASE + np.arange(BASE), OTHER])
        back = np.tile(back, (BASE, 1))
        self.cost = (-np.log((grams + 5 * back) / (grams.sum(1, keepdims=True) + 5))).astype(np.float32)
        self.costs = self.cost.ravel().tolist()  # a list is read faster, one number at a time

    def slots(self, token: str) -> list[list[tuple[str, float]]]:
        out: list[list[tuple[str, float]]] = []
        # a token of look-alikes alone hides letters rather than marks
        dropped = DROPPED if _letter.search(token) else 4 * DROPPED
        at = 0
        for match in _special.finditer(token):
            if match.start() > at:
                out.append([(token[at : match.start()], 0.0)])
            at = match.end()
            run = match[0]
            c, k = run[0], len(run)
            if "a" <= c <= "z":
                out.append([(run, 0.0), (c, DOUBLED)] if k == 2 else [(c, REPEATED), (c * 2, REPEATED)])
            elif c in LOOK_ALIKES:
                letters = LOOK_ALIKES[c]
                once = SWAPPED if k != 2 else SWAPPED + DOUBLED
                out.append([(x, once) for x in letters] + [(x * 2, SWAPPED) for x in letters if k > 1] + [("", dropped)])
            else:
                out.append([("", MARKED)])
        if at < len(token):
            out.append([(token[at:], 0.0)])
        return out

    def lattice(self, tokens: list[str], joins: list[float]) -> list[list[tuple[str, float]]]:
        """Slots of tokens, and between them a blank that costs nothing or none at the price in ``joins``."""
        out = self.slots(tokens[0])
        for price, token in zip(joins, tokens[1:]):
            out.append([(" ", 0.0), ("", price)])
            out += self.slots(token)
        return out

    def likeliest(self, slots: list[list[tuple[str, float]]]) -> str:
        """The path of least cost; of equal ones the first in the order of the options."""
        costs = self.costs
        # state: the last three symbols; kept: cost and a chain of the letters chosen
        states: dict[int, tuple[float, tuple | None]] = {(OTHER * BASE + OTHER) * BASE + OTHER: (0.0, None)}
        for options in slots:
            after: dict[int, tuple[float, tuple | None]] = {}
            symbols = [(letters, price, [_code.get(c, OTHER) for c in letters]) for letters, price in options]
            for state, (total, chain) in states.items():
                for letters, price, codes in symbols:
                    at, sum_ = state, total + price
                    for s in codes:
                        at = at * BASE + s
                        sum_ += costs[at]
                        at %= BASE**3
                    known = after.get(at)
                    if known is None or sum_ < known[0]:
                        after[at] = (sum_, (chain, letters))
            states = after
        best = min((total + costs[at * BASE + OTHER], at) for at, (total, _) in states.items())[1]
        chain, out = states[best][1], []
        while chain is not None:
            chain, letters = chain
            out.append(letters)
        return "".join(reversed(out))

    def restore(self, token: str) -> str:
        """``token`` in lower case; what comes back has letters only."""
        return self.likeliest(self.slots(token))

    def restore_all(self, tokens: list[str]) -> list[str]:
        """The words behind tokens whose blanks may be none."""
        alone = [len(t) == 1 for t in tokens]
        joins = [(JOINED, BESIDE, SPACED)[a + b] for a, b in zip(alone, alone[1:])]
        return self.likeliest(self.lattice(tokens, joins)).split()

    def stretches(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Of each text the ranges of tokens, by number, whose blanks may be none."""
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(raw), np.uint8)
        blank = _blank[data]
        edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # of tokens
        if len(first) < 2:
            return found
        owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), first, "right")
        s = np.concatenate([[OTHER] * 2, _symbols[data], [OTHER] * 2]).astype(np.int64)
        size, lead = end - first, data[first]
        size = size - ((size > 1) & _stop[data[end - 1]])
        wide = 1 + (lead >= 0xC2).astype(np.int8) + (lead >= 0xE0) + (lead >= 0xF0)
        letter = s[first + 2]
        alone = (size == wide) & ((letter != OTHER) | (wide > 1) | _alike[lead])
        same = owner[1:] == owner[:-1]
        both = alone[1:] & alone[:-1] & same
        free = alone & (letter != OTHER) & (self.alone[letter] > ODD)
        free[1:] |= both
        free[:-1] |= both
        # what the model makes of the letters around each blank, with the blank and without
        a, b, c = (s[end[:-1] + k] for k in (-1, 0, 1))
        d, e, f = (s[first[1:] + k] for k in (2, 3, 4))

        def of(x, y, z, w):
            return self.cost[(x * BASE + y) * BASE + z, w]

        apart = of(a, b, c, OTHER) + of(b, c, OTHER, d) + of(c, OTHER, d, e) + of(OTHER, d, e, f)
        joined = of(a, b, c, d) + of(b, c, d, e) + of(c, d, e, f)
        likely = (c != OTHER) & (d != OTHER) & (joined + JOINED < apart)
        turns = np.diff(np.concatenate([[False], same & (free[:-1] | free[1:] | likely), [False]]).astype(np.int8))
        begins = np.searchsorted(owner, np.arange(len(texts)))
        for low, high in zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist()):
            text = owner[low]
            found[text].append((low - int(begins[text]), high + 1 - int(begins[text])))
        return found


def core(token: str) -> str:
    """A token in lower case without marks at its ends."""
    plain = token.lower().lstrip(BEFORE).rstrip(AFTER)
    return plain.rstrip("$") if plain.endswith("$$$") else plain


class Words:
    """Restored words and features of texts."""

    def __init__(self, counts: np.ndarray):
        self.restorer = Restorer(counts)
        self.known: dict[str, tuple[str, ...]] = {}

    def of_token(self, token: str) -> tuple[str, ...]:
        plain = core(token)
        if not plain:
            return ()
        if not _noisy.search(plain):
            return named(plain)
        return tuple(dict.fromkeys(named(plain) + named(self.restorer.restore(plain))))

    def of_stretch(self, tokens: list[str]) -> tuple[str, ...]:
        found = self.restorer.restore_all(tokens)
        return tuple(dict.fromkeys(f for word in set(found) - set(tokens) for f in named(word)))

    def of(self, unit: str) -> tuple[str, ...]:
        """Features of a token, or of the tokens of a stretch, set one blank apart."""
        return self.of_stretch(unit.split(" ")) if " " in unit else self.of_token(unit)

    def units(self, texts: list[str]) -> Iterator[set[str]]:
        """Of each text the different tokens, and stretches of tokens that may belong together."""
        for group in by_size(texts):
            for text, ranges in zip(group, self.restorer.stretches(group)):
                tokens = _token.findall(text)
                out = set(tokens)
                for first, end in ranges:
                    cores = [c for c in map(core, tokens[first:end]) if c]
                    if len(cores) > 1:
                        out.add(" ".join(cores))
                yield out

    def features(self, texts: list[str]) -> Iterator[set[str]]:
        for units in self.units(texts):
            out: set[str] = set()
            for unit in units:
                found = self.known.get(unit)
                if found is None:
                    found = self.of(unit)
                    keep(self.known, unit, found)
                out.update(found)
            yield out

    def restored(self, text: str) -> str:
        """The text with noisy tokens and stretches replaced by the words found in them."""
        tokens = list(_token.finditer(text))
        starts = dict(self.restorer.stretches([text])[0])
        out, at, i = [], 0, 0
        while i < len(tokens):
            end = starts.get(i, i + 1)
            cores = [c for c in map(core, (t[0] for t in tokens[i:end])) if c]
            if len(cores) > 1:
                new = " ".join(self.restorer.restore_all(cores))
            elif cores and _noisy.search(cores[0]):
                new = self.restorer.restore(cores[0])
            else:
                new = text[tokens[i].start() : tokens[end - 1].end()]
            out += [text[at : tokens[i].start()], new]
            at, i = tokens[end - 1].end(), end
        return "".join(out) + text[at:]


def by_size(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about ``TOGETHER`` characters; a longer text is one of its own."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def keep(cache: dict, unit: str, found: tuple[str, ...]) -> None:
    """Cache what was found, except for long stretches, within bounds."""
    if len(unit) <= 64:
        if len(cache) >= CACHE_WORDS:
            cache.clear()
        cache[unit] = found


def named(word: str) -> tuple[str, ...]:
    """Features of a word: itself and how it begins."""
    return (word, *[f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n])


class Model:
    def __init__(self, counts: np.ndarray, weights: dict[str, float], bias: float):
        self.counts, self.weights, self.bias = counts, weights, bias


def learn(labelled: DataFrame, counts: np.ndarray, features: int = FEATURES) -> Model:
    """Fit on a bounded frame with columns ``text`` and ``label`` (0 or 1)."""
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast(counts)

    @F.arrow_udf("array<string>")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words(shared.value)
        for texts in batches:
            found = words.features([t or "" for t in texts.to_pylist()])
            yield pa.array([sorted(f) for f in found], pa.list_(pa.string()))

    seen = materialize(labelled.select("label", extract("text").alias("found")), "toxic-features")
    n, positive = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    negative = n - positive
    if not positive or not negative:
        return Model(counts, {}, 20.0 if positive else -20.0)
    counted = seen.select("label", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")
    )
    share = (F.col("p") + F.col("q")) / n
    apart = F.col("p") / positive - F.col("q") / negative
    z = apart / F.sqrt(share * (1 - share + 1e-9) * (1 / positive + 1 / negative))
    best = counted.filter("p + q >= 3").withColumn("z", F.abs(z)).filter(f"z > {APART}").orderBy(F.desc("z"), "feature")
    names = [r.feature for r in best.limit(features).select("feature").collect()]
    place = {name: i for i, name in enumerate(names)}
    if not place:
        return Model(counts, {}, float(np.log(positive / negative)))
    index = spark.sparkContext.broadcast(place)

    @F.arrow_udf("array<int>")
    def indexed(found: pa.Array) -> pa.Array:
        at = index.value
        return pa.array([[at[f] for f in row if f in at] for row in found.to_pylist()], pa.list_(pa.int32()))

    rows = seen.select("label", indexed("found").alias("at")).toArrow()
    at = rows["at"].combine_chunks()
    sizes = np.diff(at.offsets.to_numpy())
    weights, bias = fit(
        np.repeat(np.arange(len(sizes)), sizes), at.flatten().to_numpy(), rows["label"].to_numpy(), len(names), ridge=0.1
    )
    return Model(counts, {name: float(weights[i]) for name, i in place.items()}, bias)


def score(text: Column, model: Model) -> Column:
    """Probability of toxicity; NULL and empty texts have the score of no evidence."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        words, weights = Words(fitted.counts), fitted.weights
        known: dict[str, tuple[str, ...]] = {}
        for texts in batches:
            totals = np.full(len(texts), fitted.bias)
            for i, units in enumerate(words.units([t or "" for t in texts.to_pylist()])):
                found: set[str] = set()
                for unit in units:
                    hits = known.get(unit)
                    if hits is None:
                        hits = tuple(f for f in words.of(unit) if f in weights)
                        keep(known, unit, hits)
                    if hits:
                        found.update(hits)
                # in one order, so that equal texts have equal scores
                totals[i] += sum(weights[f] for f in sorted(found))
            yield pa.array(sigmoid(totals))

    return run(text)


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``toxic``) where ``learn_from`` holds."""
    return learn(labelled_sample(docs, labels, "toxic", learn_from, sample), letter_counts(docs))
