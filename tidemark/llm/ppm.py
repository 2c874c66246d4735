"""Language-model scores of texts: prediction by partial matching over bytes, and a unigram base.

The model is a trie of byte contexts of up to ``ORDER`` symbols, counted over the
training texts. A text is its bytes and one end symbol; before its start stand
start symbols, which are never predicted. The chance of a symbol is taken from
the longest context that has it. A context that lacks it is left by an escape
whose chance is q / (n + q), with n its count and q the number of its symbols
(escape method C); the symbols of the context left are excluded below, so the
chances of all symbols sum to one. Below the empty context all symbols left are
alike.

Every node that was counted is kept, in stored tables: nodes, and contexts with
what an escape from them needs. What is broadcast has a fixed bound: the chances
of the most frequent grams (at most ``HOT``) and the nodes of up to one context
symbol. All other grams of a text are counted per text and meet their chances in
a join; grams that training lacks meet their contexts, from the longest down.
What is broadcast decides where a chance is looked up, never what it is.

The base is an additively smoothed unigram model of words. Counts of words with
at least a 2^-20 share are broadcast; all other words of a text are counted per
text and meet their counts in a join. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.shingles import U, chunks, mix, word_hashes
from tidemark.storage import materialize

ORDER = 5
#: Nodes with less than this share of all training symbols would be left out: none is.
SHARE = 0.0
#: Grams whose chances are broadcast, at most; share of all words from which a word's count is broadcast.
HOT, HOT_SHARE = 1 << 21, 2.0**-20
#: Depths below this are broadcast in full.
SHALLOW = 2
END, START = 256, 257
SYMBOLS = 257  # what can be predicted: bytes and the end
_BITS = U(9)
ALPHA = 0.1
#: Entries that a task adds up before it passes them on.
FLUSH = 3_000_000


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) of each predicted symbol: the symbol in the lowest 9 bits, its context above."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    width = sizes + order + 1
    ends = np.cumsum(width)
    symbols = np.full(ends[-1] if n else 0, START, np.uint64)
    if n:
        place = np.arange(len(data)) + np.repeat(ends - width + order - offsets[:-1], sizes)
        symbols[place] = data
        symbols[ends - 1] = END
    keys = symbols.copy()
    for k in range(1, order + 1):
        keys[k:] |= symbols[:-k] << U(9 * k)
    real = symbols != START
    return keys[real], np.repeat(np.arange(n), sizes + 1)


class Sums:
    """Counts of 64-bit keys, added up by sorting."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            found = np.unique(keys, return_counts=True)
            self.parts.append(found)
            self.size += len(found[0])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(self.parts) > 1:
            keys, counts = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[first], np.add.reduceat(counts, first))]
        self.size = len(self.parts[0][0])
        return self.parts[0]


class Table:
    """Values of 64-bit keys by open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1)))) + 2)
        self.shift, self.mask = U(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        self.keys, self.values = keys, values
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        self.reach = 0
        while len(left):
            free = self.slots[at] < 0
            slot, who = np.unique(at[free], return_index=True)
            placed = left[free][who]
            self.slots[slot] = placed
            stay = self.slots[at] != left
            left, at = left[stay], (at[stay] + 1) & self.mask
            self.reach += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in ``values``, -1 where a key is unknown."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        which, at, wanted = None, self._home(keys), keys
        for _ in range(self.reach):
            slot = self.slots[at]
            hit = (slot >= 0) & (self.keys[slot] == wanted)
            if which is None:
                out[hit] = slot[hit]
                which = np.flatnonzero(~hit & (slot >= 0))
                at, wanted = (at[which] + 1) & self.mask, wanted[which]
            else:
                out[which[hit]] = slot[hit]
                going = ~hit & (slot >= 0)
                which, at, wanted = which[going], (at[going] + 1) & self.mask, wanted[going]
            if not len(which):
                break
        return out


class Walk:
    """Log10 chances of symbols on the way from the longest context down."""

    def __init__(self, n: int):
        self.out, self.open = np.zeros(n), np.arange(n)
        self.held, self.kinds = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def down(self, known: np.ndarray, counts: np.ndarray, sums: np.ndarray, kinds: np.ndarray, held: np.ndarray) -> None:
        """One depth, for the symbols still open: whether their context is known, and their and its counts."""
        total, fresh = sums - self.held[self.open], kinds - self.kinds[self.open]
        bottom = np.maximum(total + fresh, 1)
        hit = known & (counts > 0)
        escape = known & ~hit & (fresh > 0)
        self.out[self.open[hit]] += np.log10(counts[hit] / bottom[hit])
        self.out[self.open[escape]] += np.log10(fresh[escape] / bottom[escape])
        self.held[self.open[known]] = held[known]
        self.kinds[self.open[known]] = kinds[known]
        self.open = self.open[~hit]

    def end(self) -> np.ndarray:
        self.out[self.open] -= np.log10(np.maximum(SYMBOLS - self.kinds[self.open], 1))
        return self.out


class Trie:
    """Counts of nodes by depth, and the log10 chance of any symbol in any context."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        """``levels[k]``: keys of k context symbols and the predicted one, ascending, and their counts."""
        self.levels = levels
        self._ready = False

    def __getstate__(self):
        return {"levels": self.levels, "_ready": False}

    def prepare(self) -> None:
        self.grams, self.contexts = [], []
        for k, (keys, counts) in enumerate(self.levels):
            first = np.flatnonzero(np.concatenate([[True], keys[1:] >> _BITS != keys[:-1] >> _BITS])) if len(keys) else []
            sums = np.add.reduceat(counts, first) if len(keys) else np.zeros(0, np.int64)
            kinds = np.diff(np.append(first, len(keys)))
            # of each context: what its symbols count for in the context one shorter
            below = np.zeros(len(keys), np.int64)
            if k and len(keys):
                at = self.grams[k - 1].find(keys & U((1 << 9 * k) - 1))
                below = np.where(at >= 0, self.levels[k - 1][1][at], 0)
            held = np.add.reduceat(below, first) if len(keys) else np.zeros(0, np.int64)
            self.grams.append(Table(keys, counts))
            self.contexts.append(Table(keys[first] >> _BITS if len(keys) else keys, np.stack([sums, kinds, held])))
        self._ready = True
        top = self.levels[-1][0]
        self.whole = Table(top, self.slow(top))

    def slow(self, keys: np.ndarray, walk: Walk | None = None) -> np.ndarray:
        """Log10 chances by walking down from the longest context, or on from where ``walk`` is."""
        if not self._ready:
            self.prepare()
        walk = walk or Walk(len(keys))
        for k in reversed(range(len(self.levels))):
            if not len(self.levels[k][0]):
                continue
            mine = keys[walk.open] & U((1 << 9 * (k + 1)) - 1)
            at = self.contexts[k].find(mine >> _BITS)
            found = self.grams[k].find(mine)
            counts = np.where(found >= 0, self.levels[k][1][np.maximum(found, 0)], 0)
            walk.down(at >= 0, counts, *self.contexts[k].values[:, np.maximum(at, 0)])
        return walk.end()

    def log10(self, keys: np.ndarray) -> np.ndarray:
        if not self._ready:
            self.prepare()
        at = self.whole.find(keys)
        out = self.whole.values[at] if len(self.whole.keys) else np.zeros(len(keys))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            distinct, back = np.unique(keys[missing], return_inverse=True)
            out[missing] = self.slow(distinct)[back]
        return out


def count(docs: DataFrame, train: Column, text_column: str = "text") -> DataFrame:
    """``kind`` ("gram" or "word"), ``key`` and ``n`` over the training texts; ends of texts are not among the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {"gram": Sums(), "word": Sums()}

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            for kind, own in sums.items():
                if own.size > least:
                    keys, counts = own.merge()
                    if own.size > least // 2:
                        for first in range(0, len(keys), 100_000):
                            part = slice(first, first + 100_000)
                            yield pa.RecordBatch.from_arrays([
                                pa.array([kind] * len(keys[part])), pa.array(keys[part].view(np.int64)),
                                pa.array(counts[part].astype(np.int64)),
                            ], names=["kind", "key", "n"])
                        sums[kind] = Sums()

        for batch in batches:
            for _, data, offsets in chunks(batch.column(0)):
                sums["gram"].add(gram_keys(data, offsets)[0])
                sums["word"].add(word_hashes(data, offsets)[0])
                yield from flush(FLUSH)
        yield from flush(0)

    texts = docs.filter(train).select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    counted = texts.mapInArrow(run, "kind string, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Model:
    """What is broadcast (``trie``, ``hot``, ``words``), and the stored ``nodes``, ``contexts`` and ``chances``."""

    def __init__(
        self, trie: Trie, hot: Table, words: Table, tokens: int, texts: int, distinct: int, tables: dict[str, DataFrame]
    ):
        self.trie, self.hot, self.words, self.tokens, self.texts = trie, hot, words, tokens, texts
        self.bottom = tokens + ALPHA * (distinct + 1)
        self.tables = tables

    def __getstate__(self):
        return self.__dict__ | {"tables": {}}

    def word_log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ALPHA) / self.bottom) if self.bottom > 0 else np.zeros(len(counts))


def _tail(symbols: Column) -> Column:
    """The last ``symbols`` symbols of ``key``."""
    return F.col("key").bitwiseAND(F.pow(F.lit(2.0), 9 * symbols).cast("long") - 1)  # 2^54 at most: exact


def _context() -> Column:
    return F.shiftright("key", 9)


def _tables(grams: DataFrame) -> dict[str, DataFrame]:
    """``nodes`` (``k``, ``key``, ``n``), ``contexts`` (``k``, ``context``, ``sums``, ``kinds``, ``held``), ``chances`` (``key``, ``n``, ``log10``).

    ``held`` is what the symbols of a context count for in the context one shorter.
    """
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels = [
        grams.groupBy(_tail(F.lit(k + 1)).alias("key")).agg(F.sum("n").alias("n")).select(F.lit(k).alias("k"), "key", "n")
        for k in range(ORDER)
    ]
    union = grams.select(F.lit(ORDER).alias("k"), "key", "n")
    for level in levels:
        union = union.unionByName(level)
    nodes = materialize(union.filter(F.col("n") >= total * SHARE), "ppm-nodes")
    shorter = nodes.select((F.col("k") + 1).alias("k"), F.col("key").alias("tail"), F.col("n").alias("below"))
    met = nodes.withColumn("tail", _tail(F.col("k"))).join(shorter, ["k", "tail"], "left")
    contexts = materialize(
        met.groupBy("k", _context().alias("context")).agg(
            F.sum("n").alias("sums"), F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("below"), F.lit(0)).alias("held")
        ), "ppm-contexts",
    )
    longest = contexts.filter(F.col("k") == ORDER).select("context", "sums", "kinds")
    chances = nodes.filter(F.col("k") == ORDER).withColumn("context", _context()).join(longest, "context").select(
        "key", "n", F.log10(F.col("n") / (F.col("sums") + F.col("kinds"))).alias("log10")
    )
    return {"nodes": nodes, "contexts": contexts, "chances": materialize(chances, "ppm-chances")}


def _hot(chances: DataFrame) -> DataFrame:
    """The most frequent grams, at most ``HOT``: all from some count on."""
    sized = chances.withColumn("size", F.floor(F.log2("n") * 16).cast("int"))
    held, least = 0, None
    for size, n in sorted(sized.groupBy("size").count().collect(), reverse=True):  # at most 16 * 64 rows
        if held + n > HOT:
            break
        held, least = held + n, size
    return sized.filter(F.lit(False) if least is None else F.col("size") >= least).select("key", "log10")


def train(docs: DataFrame, learn_from: Column, text_column: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the stored counts of all training words (``key``, ``n``)."""
    counted = materialize(count(docs, learn_from, text_column), "ppm-counts")
    words = counted.filter("kind = 'word'").select("key", "n")
    texts = docs.filter(learn_from).count()
    tables = _tables(counted.filter("kind = 'gram'").select("key", "n"))
    shallow = tables["nodes"].filter(F.col("k") < SHALLOW).toArrow()  # at most 257 + 257 * 258 rows
    depth, keys, counts = (shallow[c].to_numpy() for c in ("k", "key", "n"))
    levels = []
    for k in range(SHALLOW):
        mine = np.flatnonzero(depth == k)
        mine = mine[np.argsort(keys[mine])]
        levels.append((keys[mine].astype(np.uint64), counts[mine].astype(np.int64)))
    top = _hot(tables["chances"]).toArrow()  # at most HOT rows
    hot = Table(top["key"].to_numpy().astype(np.uint64), top["log10"].to_numpy())
    in_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens = in_words + texts
    frequent = words.filter(F.col("n") >= tokens * HOT_SHARE).toArrow()
    keys, counts = frequent["key"].to_numpy().view(np.uint64), frequent["n"].to_numpy().astype(np.int64)
    return Model(Trie(levels), hot, Table(keys, counts), tokens, texts, distinct + (texts > 0), tables), words


def _unseen(keys: DataFrame, model: Model, shared) -> DataFrame:
    """``key`` and ``log10`` of distinct grams that training lacks."""
    depths = range(ORDER, SHALLOW - 1, -1)
    each = keys.withColumn("k", F.explode(F.array(*[F.lit(k) for k in depths])))
    each = each.withColumns({"tail": _tail(F.col("k") + 1)}).withColumn("context", F.shiftright("tail", 9))
    nodes = model.tables["nodes"].select("k", F.col("key").alias("tail"), "n")
    met = each.join(nodes, ["k", "tail"], "left").join(model.tables["contexts"], ["k", "context"], "left")
    columns = {f"{c}_{k}": F.coalesce(F.max(F.when(F.col("k") == k, F.col(c))), F.lit(0))
               for k in depths for c in ("n", "sums", "kinds", "held")}
    wide = met.groupBy("key").agg(*[value.alias(name) for name, value in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            walk = Walk(batch.num_rows)
            for k in depths:
                n, sums, kinds, held = (batch.column(f"{c}_{k}").to_numpy()[walk.open] for c in ("n", "sums", "kinds", "held"))
                walk.down(sums > 0, n, sums, kinds, held)
            out = shared.value.trie.slow(batch.column("key").to_numpy().astype(np.uint64), walk)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out)], names=["key", "log10"])

    return materialize(wide.mapInArrow(run, "key long, log10 double"), "ppm-unseen")


def _per_text(keys: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    """For each of ``n`` texts the list of its distinct keys, and how often each occurs."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
                         if len(keys) else np.zeros(0, bool))
    times = np.diff(np.append(new, len(keys))).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [pa.array(keys[new].view(np.int64)), pa.array(times)], fields=[pa.field("key", pa.int64()), pa.field("times", pa.int32())]
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[new], np.arange(n + 1)).astype(np.int32)), pairs)


SCORED = (
    "n_tokens long, near_known long, near_base double, near_score double, rare array<struct<key: long, times: int>>, "
    "grams array<struct<key: long, times: int>>"
)


def score(
    docs: DataFrame, model: Model, words: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    NULL texts count as empty: one token, the end. Without training texts, the
    base score is 0 and the model's chances are uniform. Ids may repeat or be NULL.
    """
    shared = SparkSession.active().sparkContext.broadcast(model)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for first, data, offsets in chunks(batch.column("text")):
                n = len(offsets) - 1
                keys, of = gram_keys(data, offsets)
                at = fitted.hot.find(keys)
                hot = at >= 0
                scores = np.bincount(of[hot], weights=fitted.hot.values[at[hot]], minlength=n).astype(np.float64)
                grams = _per_text(keys[~hot], of[~hot], n)
                hashes, owner = word_hashes(data, offsets)
                at = fitted.words.find(hashes)
                seen = at >= 0
                logs = fitted.word_log10(fitted.words.values)[at[seen]] if seen.any() else np.zeros(0)
                base = np.bincount(owner[seen], weights=logs, minlength=n).astype(np.float64)
                base += fitted.word_log10(np.array([fitted.texts]))[0]
                known = np.bincount(owner[seen], minlength=n) + (fitted.texts > 0)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(first, n),
                    pa.array(np.bincount(owner, minlength=n) + 1), pa.array(known.astype(np.int64)),
                    pa.array(base), pa.array(scores), _per_text(hashes[~seen], owner[~seen], n), grams,
                ], names=["id", "n_tokens", "near_known", "near_base", "near_score", "rare", "grams"])

    near = materialize(
        source.mapInArrow(run, f"id {id_type}, {SCORED}").withColumn("row", F.monotonically_increasing_id()),
        "ppm-scores",
    )
    rare = near.select("row", F.explode("rare").alias("w")).select("row", "w.key", "w.times")
    counts = words.filter(F.col("n") < model.tokens * HOT_SHARE).withColumnRenamed("n", "c")
    bottom = model.bottom if model.bottom > 0 else 1.0
    seen = F.coalesce(F.col("c"), F.lit(0))
    far = rare.join(counts, "key", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((seen + ALPHA) / bottom)).alias("far_base"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("far_known"),
    )
    pairs = near.select("row", F.explode("grams").alias("g")).select("row", "g.key", "g.times")
    chances = model.tables["chances"].select("key", "log10")
    unseen = _unseen(pairs.select("key").distinct().join(chances, "key", "left_anti"), model, shared)
    chance = pairs.join(chances.unionByName(unseen), "key").groupBy("row").agg(
        F.sum(F.col("times") * F.col("log10")).alias("far_score")
    )
    joined = near.drop("rare", "grams").join(far, "row", "left").join(chance, "row", "left")
    base = F.col("near_base") + F.coalesce("far_base", F.lit(0.0))
    return joined.select(
        F.col("id").alias(id_column), "n_tokens",
        (F.col("near_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (base if model.tokens else F.lit(0.0)).alias("base_score"),
        (F.col("near_score") + F.coalesce("far_score", F.lit(0.0))).alias("score"),
    )
