"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Similarity is the probability Jaccard index of weighted word shingles,

    J(p, q) = sum over shared i of 1 / sum over j of max(p_j / p_i, q_j / q_i),

with a shingle's weight 1 + ln(occurrences). With equal weights it is the
Jaccard index of the sets.

Signature: each shingle is the source of a Poisson process whose rate is its
weight; every arrival falls on a random register, and a register keeps the
shingle that arrives first. Two texts agree in a register with probability J.
A source stops once its next arrival is later than all registers, so a long
text costs little more than one arrival for each shingle.

Classes, from texts that differ (exact copies share a digest and count once):

1. Bands of a signature are bucket keys. In each bucket the text that meets
   the most texts over all its buckets leads. Every other text is verified
   against it: at most ``bands`` pairs for each text, whatever the buckets hold.
2. Verified pairs are joined into components.
3. Where a bucket still holds several components, its texts outside the largest
   are verified against all others of the bucket, in blocks: a task gets two
   blocks of texts, bounds all their similarities by a matrix product, verifies
   what may reach the threshold, and returns links only.
4. Buckets with more such texts than a block holds first lose those that can meet
   no text of another component: of a text's shingles the rarest, its prefix,
   outweigh what two similar texts may differ in, so similar texts share one of
   them. Pages that have only common passages in common thus do not meet.

So no pair of texts that share a bucket and are similar is left out of a class.

Two texts are similar if the index is at least the threshold, less 1e-9 for the
rounding of sums: a tie counts as similar.

Groups are split into blocks by size and leaders are joined by key, so no group
has to fit one task. NULL and empty texts have no shingles and are in no class
with others. Ids may be NULL or repeat; a text's features are taken from one row,
and rows that repeat in full count as copies. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import batches_of, text_of
from tidemark.llm.shingles import U, chunks, mix, shingles
from tidemark.operators.skew import join_heavy
from tidemark.storage import materialize

WORDS = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
#: What rounding may take from a similarity that reaches the threshold.
TIE = 1e-9
#: Texts in a block of step 3, and counters of shingles by which prefixes are ordered.
BLOCK, COUNTERS = 32, 1 << 20
#: What a Python worker gets at a time; a pair of long texts is a large row.
BATCH = "8m"


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def signatures(
    owner: np.ndarray, elements: np.ndarray, weight: np.ndarray, texts: int, registers: int
) -> np.ndarray:
    """Registers of ``texts`` texts at once; the arrays name, for each shingle, its text, hash and weight.

    Every text must have a shingle.
    """
    first = np.full(texts * registers, np.inf)
    held = np.zeros(texts * registers, np.uint64)
    state = elements.copy()
    time = np.zeros(len(elements))
    while len(state):
        state = state + U(0x9E3779B97F4A7C15)
        bits = mix(state)
        time = time - np.log1p(-(bits >> U(11)).astype(np.float64) * 2.0**-53) / weight
        place = owner * registers + (mix(bits ^ U(0xD6E8FEB86659FD93)) % U(registers)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = first[place] == time
        held[place[won]] = elements[won]
        going = time < first.reshape(texts, registers).max(1)[owner]
        if not going.all():
            owner, elements, weight = owner[going], elements[going], weight[going]
            state, time = state[going], time[going]
    return held.reshape(texts, registers)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) keys; each depends on its band's number and registers."""
    cut = registers.reshape(len(registers), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for k in range(rows):
        keys = mix(keys * U(0x9E3779B97F4A7C15) + cut[:, :, k])
    return keys.view(np.int64)


def similarity(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> float:
    """Probability Jaccard index; ``a`` and ``b`` are ascending, ``p`` and ``q`` their weights."""
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    left, right = p[i], q[j]
    ratio = right / left
    order = np.argsort(ratio, kind="stable")
    left, right, ratio = left[order], right[order], ratio[order]
    below = 1.0 - p[i].sum() + np.cumsum(left)
    above = np.maximum(1.0 - np.cumsum(right), 0.0)  # what only the second has counts as above, too
    return float(min(1.0, (left / (below + above / ratio)).sum()))


FEATURES = "shingles binary, weights binary"


def _features(texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
    for _, data, offsets in chunks(texts):
        for found, counts in shingles(data, offsets, WORDS):
            heavy = weights(counts).astype("<f4").tobytes() if len(counts) and counts.max() > 1 else b""
            yield found.astype("<u8").tobytes(), heavy


def _load(raw: bytes, heavy: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(raw, "<u8")
    return found, np.frombuffer(heavy, "<f4").astype(np.float64) if heavy else np.ones(len(found))


def _column_rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of binary columns, as views of the batch."""
    return zip(*[(value.as_buffer() for value in batch.column(n)) for n in names])


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``id``, ``node`` and ``keys`` of rows with columns ``id``, ``node`` (identity of the text) and ``text``."""
    schema = docs.select("id", "node").schema
    head = f"id {schema['id'].dataType.simpleString()}, node binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list = []
            for first, data, offsets in chunks(batch.column("text")):
                found = list(shingles(data, offsets, WORDS))
                sizes = np.array([len(s) for s, _ in found])
                full = np.flatnonzero(sizes)
                here: list = [None] * len(found)
                if len(full):
                    owner = np.repeat(np.arange(len(full)), sizes[full])
                    elements = np.concatenate([found[i][0] for i in full])
                    weight = weights(np.concatenate([found[i][1] for i in full]))
                    got = band_keys(signatures(owner, elements, weight, len(full), bands * rows), bands, rows)
                    for i, row in zip(full, got):
                        here[i] = row
                keys += here
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("node"), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "node", "keys"],
            )

    return docs.select("id", "node", "text").mapInArrow(sign, f"{head}, keys array<bigint>")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node) of all nodes of undirected links ``a``, ``b``.

    Each round maps every node to its least neighbour and contracts the links;
    the maps are stored and composed at the end.
    """
    maps: list[DataFrame] = []
    links = materialize(links.filter("a != b").select("a", "b").distinct(), "links")
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        least = both.groupBy("node").agg(F.min("other").alias("other"))
        least = materialize(least.select("node", F.least("node", "other").alias("to")), "map")
        maps.append(least)
        moved = links.join(least.withColumnsRenamed({"node": "a", "to": "a2"}), "a").join(
            least.withColumnsRenamed({"node": "b", "to": "b2"}), "b"
        )
        links = materialize(moved.filter("a2 != b2").select(
            F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")
        ).distinct(), "links")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[-1].withColumnRenamed("to", "component")
    for earlier in reversed(maps[:-1]):
        later = found.withColumnsRenamed({"node": "to", "component": "last"})
        found = earlier.join(later, "to", "left").select(
            "node", F.coalesce("last", "to").alias("component")
        )
    return materialize(found, "components")


def _verified(pairs: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose similarity reaches the threshold."""
    sides = pairs.join(features.withColumnsRenamed({"node": "a", "shingles": "sa", "weights": "wa"}), "a").join(
        features.withColumnsRenamed({"node": "b", "shingles": "sb", "weights": "wb"}), "b"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                similarity(*_load(sa, wa), *_load(sb, wb)) >= threshold - TIE
                for sa, wa, sb, wb in _column_rows(batch, "sa", "wa", "sb", "wb")
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return sides.mapInArrow(verify, "a binary, b binary")


def _block_links(left: list, right: list, threshold: float) -> Iterator[tuple[bytes, bytes]]:
    """Links between two blocks of (node, component, shingles, weights); equal components are passed over.

    J is at most the weight, in either text, of what both hold. That bound is
    a matrix product over the block's shingles.
    """
    sides = []
    for rows in (left, right):
        loaded = [_load(r["shingles"], r["weights"]) for r in rows]
        sides.append([(s, w / w.sum()) for s, w in loaded])
    # only shingles that both blocks hold matter
    held = [np.unique(np.concatenate([s for s, _ in side])) for side in sides]
    shared = np.intersect1d(*held, assume_unique=True)
    if not len(shared):
        return
    mats = []
    for side in sides:
        share = np.zeros((len(side), len(shared)), np.float32)
        for row, (s, w) in enumerate(side):
            at = np.searchsorted(shared, s)
            at[at == len(shared)] = 0
            hit = shared[at] == s
            share[row, at[hit]] = w[hit]
        mats.append(share)
    bound = np.minimum(mats[0] @ (mats[1] > 0).T.astype(np.float32), (mats[0] > 0).astype(np.float32) @ mats[1].T)
    for i, j in np.argwhere(bound >= threshold - 1e-4):
        a, b = left[i], right[j]
        if a["component"] != b["component"] and similarity(*sides[0][i], *sides[1][j]) >= threshold - TIE:
            yield a["node"], b["node"]


def prefix(found: np.ndarray, weight: np.ndarray, often: np.ndarray, threshold: float) -> np.ndarray:
    """The rarest shingles of a text, as many as outweigh what similar texts may differ in.

    Similar texts share shingles of at least ``threshold`` of the weight of each.
    Let one's prefix end at an earlier place of the common order. If the other
    held a shingle of it, that would lie in its own prefix, too; so without a
    common shingle in both prefixes, the first's whole prefix is not shared.
    """
    order = np.lexsort((found, often[(found % U(len(often))).astype(np.int64)]))
    share = np.cumsum(weight[order]) / weight.sum()
    return found[order[: int(np.searchsorted(share, 1 - threshold + 1e-6, "right")) + 1]]


def _often(features: DataFrame) -> np.ndarray:
    """How many texts hold a shingle, by its remainder; collisions only make the order less apt."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for raw in batch.column("shingles"):
                total += np.bincount((np.frombuffer(raw.as_py(), "<u8") % U(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["at", "n"])

    counted = features.select("shingles").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most COUNTERS rows
    out = np.zeros(COUNTERS, np.int32)
    out[table["at"].to_numpy()] = np.minimum(table["n"].to_numpy(), 2**31 - 1)
    return out


def _prefixes(features: DataFrame, threshold: float) -> DataFrame:
    """``node`` and the ``prefix`` of its shingles."""
    shared = features.sparkSession.sparkContext.broadcast(_often(features))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                prefix(*_load(raw, heavy), shared.value, threshold).view(np.int64)
                for raw, heavy in _column_rows(batch, "shingles", "weights")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(out, pa.list_(pa.int64()))], names=["node", "prefix"]
            )

    return features.mapInArrow(cut, "node binary, prefix array<bigint>")


def _open_groups(placed: DataFrame) -> DataFrame:
    """``key``, rows ``n``, largest component ``top`` and rows outside it, of groups with several components."""
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("components"), F.sum("size").alias("n"),
        F.max(F.struct("size", "component")).alias("top"),
    ).filter("components > 1").select("key", "n", F.col("top.component").alias("top"), (F.col("n") - F.col("top.size")).alias("minors"))


def _able_to_meet(crowded: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """Rows ``key``, ``node``, ``component`` that share a shingle of their prefixes with another component of their bucket."""
    held = materialize(features.join(crowded.select("node").distinct(), "node", "left_semi"), "open-features")
    spread = crowded.join(_prefixes(held, threshold), "node").select(
        "key", "node", "component", F.explode("prefix").alias("shingle")
    ).withColumn("bucket", F.col("key")).withColumn("key", F.xxhash64("key", "shingle"))
    met = spread.join(_open_groups(spread).select("key"), "key", "left_semi")
    return met.select(F.col("bucket").alias("key"), "node", "component").distinct()


def _cross_links(members: DataFrame, found: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """Links between components that meet in a bucket."""
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # of two texts in a bucket, one led it and met the other
    met = placed.join(_open_groups(placed).filter("n > 2"), "key")
    met = materialize(met.select("node", "key", "component", "minors"), "open-buckets")
    left = met.drop("minors")
    crowded = met.filter(F.col("minors") > BLOCK).drop("minors")
    if not crowded.isEmpty():
        left = materialize(met.filter(F.col("minors") <= BLOCK).drop("minors").unionByName(
            _able_to_meet(crowded, features, threshold)
        ), "open-buckets")
    rows = left.join(_open_groups(left), "key").join(features, "node")
    blocks = rows.select(
        "key", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block"),
        (F.col("component") != F.col("top")).alias("minor"),
        F.struct("node", "component", "shingles", "weights").alias("row"),
    )
    side = lambda kept, name: kept.groupBy("key", "block").agg(
        F.collect_list("row").alias(name)
    )
    left, right = side(blocks.filter("minor"), "l"), side(blocks, "r").drop("block")
    paired = left.drop("block").join(right, "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                links = list(_block_links(batch.column("l")[k].as_py(), batch.column("r")[k].as_py(), threshold))
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]
                    )

    return paired.select("l", "r").mapInArrow(compare, "a binary, b binary").distinct()


def node_of(text_column: str) -> Column:
    """The identity of a text: half of its SHA-256."""
    return F.substring(F.unhex(F.sha2(text_of(text_column).cast("binary"), 256)), 1, 16)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id``, ``class_size``, ``kept``, ``node``.

    ``class_id`` is the least id in the class (NULL only if all are), and
    ``class_size`` counts its rows. ``kept`` is true for one row of the class,
    its least id's. ``node`` identifies the text.
    """
    with batches_of(docs.sparkSession, BATCH):
        return _near_duplicates(docs, id_column, text_column, threshold, bands, rows)


def _near_duplicates(
    docs: DataFrame, id_column: str, text_column: str, threshold: float, bands: int, rows: int
) -> DataFrame:
    source = docs.select(
        F.col(id_column).alias("id"), node_of(text_column).alias("node"), F.col(text_column).alias("text")
    )
    sigs = materialize(signed(source, bands, rows), "signatures")
    texts = sigs.groupBy("node").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")
    )
    texts = materialize(texts, "texts")
    placed = texts.filter("keys IS NOT NULL").select("node", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialize(placed.join(shared, "key"), "buckets")

    meets = members.groupBy("node").agg(F.sum("n").alias("meets"))
    ranked = members.join(meets, "node")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("meets", "node")).alias("lead")).select(
        "key", F.col("lead.node").alias("b")
    )
    pairs = materialize(
        members.join(leaders, "key").filter("node != b").select(F.col("node").alias("a"), "b").distinct(), "pairs"
    )
    # the features of texts in shared buckets; a text's least id speaks for its copies
    wanted = texts.join(meets.select("node"), "node", "left_semi").select("node", "id")
    chosen = join_heavy(source, wanted, ["node", "id"], null_safe=True, keys_from=sigs.select("node", "id"))
    # rows that repeat an id and its text are one node
    chosen = chosen.groupBy("node").agg(F.first("text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, heavy = zip(*_features(batch.column("text"))) if len(batch) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(raw, pa.binary()), pa.array(heavy, pa.binary())],
                names=["node", "shingles", "weights"],
            )

    features = materialize(chosen.mapInArrow(extract, f"node binary, {FEATURES}"), "features")
    links = materialize(_verified(pairs, features, threshold), "verified")
    found = components(links)
    more = materialize(_cross_links(members.select("node", "key"), found, features, threshold), "cross-links")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    return _classes(sigs, texts, found)


def _classes(sigs: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    members = texts.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = members.groupBy("component").agg(
        F.min("id").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("least"),
    )
    named = members.join(classes, "component").select(
        "node", "class_id", "class_size", F.col("least.id").alias("keep_id"), F.col("least.node").alias("keep_node")
    )
    counted = sigs.groupBy("node", "id").agg(F.count(F.lit(1)).alias("rows"))
    each = counted.join(named, "node").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select(
        F.col("id").alias("doc_id"), "class_id", "class_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("node") == F.col("keep_node")) & (F.col("i") == 1))
        .alias("kept"),
        "node",
    )
