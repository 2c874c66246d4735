"""Exact deduplication against an immutable snapshot, screened by binary-fuse filters.

A snapshot is a set of texts that no longer changes: its digests are stored in
shards by digest prefix, with one static binary-fuse filter (three probes, one
byte a slot) for each shard. A batch of incoming texts is handled in three steps:

1. Equal texts inside the batch are grouped, apart from the snapshot.
2. Each batch digest is probed in the filter of its shard. A filter has no false
   negatives, so what it denies is new. What it affirms (true members and about
   1 in 256 others) joins the exact digest buckets of the snapshot.
3. Texts of equal digest are compared byte by byte: the least and the greatest
   text of a group must be one. Groups that differ (a digest collision) are
   split by their whole text.

Of equal texts the row with the largest id stays, in whichever part it is. A
group may hold any share of all rows: digests are counted before they are
joined, and the byte check deals the rows of a large group over many parts.
Nothing is collected: filters are built one shard in a task.

NULL text counts as empty. NULL ids sort below all others. Rows that repeat in
full are separate members of their group, of which one stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import text_of
from tidemark.storage import materialize

#: Rows of a group that one part of the byte check compares.
CHECK_ROWS = 2_000
#: Digests a shard aims at.
SHARD_DIGESTS = 200_000
FILTER_SCHEMA = "shard long, seed long, segment long, segments long, slots binary"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64(seed)
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


def _places(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """The three slots of each key: the same offset rule in three neighbouring segments."""
    first = ((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    low = np.uint64(segment - 1)
    base = first * np.uint64(segment)
    return np.stack([
        base + (hashes & low),
        base + np.uint64(segment) + ((hashes >> np.uint64(10)) & low),
        base + np.uint64(2 * segment) + ((hashes >> np.uint64(21)) & low),
    ]).astype(np.int64)


def _print_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _M2) >> np.uint64(56)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, first segments, slots) of a set of distinct 64-bit keys.

    Slots that hold a single key are peeled in rounds, all such slots of a round
    at once, and filled in the reverse order. A seed that leaves keys unpeeled
    is replaced by the next.
    """
    n = len(keys)
    segment = 1 << max(2, min(14, int(np.log2(max(n, 1)) / np.log2(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, int(np.ceil(n * factor / segment)) - 2)
    for seed in range(1, 1000):
        if seed % 20 == 0:
            segments += max(1, segments // 10)
        hashes = _mix(keys, seed)
        places = _places(hashes, segment, segments)
        size = (segments + 2) * segment
        count = np.zeros(size, np.int64)
        owner = np.zeros(size, np.int64)  # xor of the keys' numbers: of a single key, its number
        number = np.arange(n)
        for p in places:
            np.add.at(count, p, 1)
            np.bitwise_xor.at(owner, p, number)
        order: list[tuple[np.ndarray, np.ndarray]] = []
        single, left = np.flatnonzero(count == 1), n
        while len(single):
            found, at = np.unique(owner[single], return_index=True)
            order.append((found, single[at]))
            left -= len(found)
            touched = places[:, found]
            for p in touched:
                np.subtract.at(count, p, 1)
                np.bitwise_xor.at(owner, p, found)
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if left == 0:
            slots = np.zeros(size, np.uint8)
            prints = _print_of(hashes)
            for found, at in reversed(order):
                a, b, c = places[:, found]
                # the key's own slot is still 0 here
                slots[at] = prints[found] ^ slots[a] ^ slots[b] ^ slots[c]
            return seed, segment, segments, slots
    raise ValueError("no filter found; are the keys distinct?")


def probe_filter(keys: np.ndarray, seed: int, segment: int, segments: int, slots: np.ndarray) -> np.ndarray:
    hashes = _mix(keys, seed)
    a, b, c = _places(hashes, segment, segments)
    return (slots[a] ^ slots[b] ^ slots[c]) == _print_of(hashes)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def shard_of(digest: Column, shards: int) -> Column:
    """Shard by the first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(shards)


def _key(digest: Column) -> Column:
    return F.xxhash64(digest)


def build_filters(digests: DataFrame, shards: int) -> DataFrame:
    """One filter row for each shard of a frame of distinct ``digest``."""

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(shard["key"].to_numpy(np.int64).view(np.uint64))
        seed, segment, segments, slots = build_filter(keys)
        row = {"shard": shard["shard"].iloc[0], "seed": seed, "segment": segment, "segments": segments}
        return pd.DataFrame([row | {"slots": slots.tobytes()}])

    keyed = digests.select(shard_of(F.col("digest"), shards).alias("shard"), _key(F.col("digest")).alias("key"))
    return keyed.groupBy("shard").applyInPandas(build, FILTER_SCHEMA)


def screen(digests: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """``digest`` and ``maybe``: false where the snapshot surely lacks the digest."""

    def probe(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        maybe = np.zeros(len(keys), bool)
        if len(found) and len(keys):
            row = found.iloc[0]
            slots = np.frombuffer(row["slots"], np.uint8)
            probes = keys["key"].to_numpy(np.int64).view(np.uint64)
            maybe = probe_filter(probes, int(row["seed"]), int(row["segment"]), int(row["segments"]), slots)
        return pd.DataFrame({"digest": keys["digest"], "maybe": maybe})

    keyed = digests.select(
        "digest", _key(F.col("digest")).alias("key"), shard_of(F.col("digest"), shards).alias("shard")
    )
    return keyed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(
        probe, "digest string, maybe boolean"
    )


def shards_for(rows: int) -> int:
    return max(1, -(-rows // SHARD_DIGESTS))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))


def dedup(
    docs: DataFrame,
    in_snapshot: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest_of=sha256,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``in_snapshot``.

    ``in_snapshot`` tells snapshot rows from those of the incoming batch.
    ``digest_of`` may be replaced by a weaker digest; the byte check mends what
    it confuses. Result columns are the operator's own, whatever else the input has.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), text_of(text_column).alias("text"),
        F.coalesce(in_snapshot, F.lit(False)).alias("old"),
    )
    light = materialize(
        rows.select("id", "old", digest_of(F.col("text")).alias("digest"), sha256(F.col("text")).alias("sha")),
        "digests",
    )
    old, new = _groups(light.filter("old")), _groups(light.filter("NOT old"))
    olds, news = light.agg(F.count_if("old"), F.count_if(~F.col("old"))).first()
    shards = shards_for(max(olds, news))
    filters = materialize(build_filters(old.select("digest"), shards), "filters")
    screened = screen(new.select("digest"), filters, shards)
    # exact buckets: what the filter affirms meets the snapshot's digests
    affirmed = new.join(screened.filter("maybe").select("digest"), "digest", "left_semi")
    met = affirmed.select("digest", "keep_id", "n").unionByName(old)
    merged = met.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    fresh = new.join(screened.filter("NOT maybe").select("digest"), "digest", "left_semi")
    groups = materialize(merged.unionByName(fresh), "groups")

    differing = materialize(_differing(rows, groups, olds + news, digest_of), "differing")
    out = light.join(groups, "digest").select(
        "id", "old", "sha", "digest", "keep_id", F.col("n").alias("group_size")
    )
    if not differing.isEmpty():
        out = _regroup(rows, out, differing, digest_of)
    # of rows that share the id that stays, one stays
    copies = out.groupBy("id", "old", "sha", "keep_id", "group_size").agg(F.count(F.lit(1)).alias("copies"))
    first_part = F.when(F.col("keep_id").eqNullSafe(F.col("id")), F.lit(1)).otherwise(F.lit(0))
    in_both = copies.groupBy("id", "sha", "keep_id", "group_size").agg(
        F.sum(F.when(F.col("old"), F.col("copies")).otherwise(0)).alias("olds"), F.sum("copies").alias("all")
    )
    each = in_both.select(
        "id", "sha", "keep_id", "group_size", "olds", first_part.alias("stays"),
        F.explode(F.sequence(F.lit(1), F.col("all").cast("int"))).alias("i"),
    )
    return each.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        ((F.col("stays") == 1) & (F.col("i") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        (F.col("i") <= F.col("olds")).alias("in_snapshot"),
    )


def _differing(rows: DataFrame, groups: DataFrame, total: int, digest_of) -> DataFrame:
    """Digests under which not all texts are the same bytes: the least text differs from the greatest.

    A group with more than a thousandth of all rows is dealt over parts of
    about CHECK_ROWS rows first; there are fewer than a thousand such groups,
    so their list is broadcast. The parts of a group meet as two texts each.
    """
    large = groups.filter(F.col("n") * 1000 > total).select(
        "digest", F.ceil(F.col("n") / CHECK_ROWS).cast("int").alias("parts")
    )
    dealt = rows.select("id", "text", digest_of(F.col("text")).alias("digest")).join(
        F.broadcast(large), "digest", "left"
    ).withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
    parts = dealt.groupBy("digest", "part").agg(
        F.min("text").alias("least"), F.max("text").alias("most"),
        F.max(F.col("parts").isNotNull()).alias("large"),
    )
    seen = materialize(
        parts.filter("large OR least <> most").select(
            "digest", "large", F.when(F.col("large"), F.col("least")).alias("least"), "most"
        ).withColumn("alike", F.col("large") & (F.col("least") == F.col("most"))), "byte-check",
    )
    across = seen.filter("large").groupBy("digest").agg((F.min("least") != F.max("most")).alias("differs"))
    return seen.filter("NOT alike").select("digest").unionByName(
        across.filter("differs").select("digest")
    ).distinct()


def _regroup(rows: DataFrame, out: DataFrame, differing: DataFrame, digest_of) -> DataFrame:
    """Group the rows under confused digests by their whole text."""
    confused = rows.select("id", "old", "text", digest_of(F.col("text")).alias("digest")).join(
        differing, "digest", "left_semi"
    )
    by_text = confused.groupBy("text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    mended = confused.join(by_text, "text").select(
        "id", "old", sha256(F.col("text")).alias("sha"), "digest", "keep_id", "group_size"
    )
    return out.join(differing, "digest", "left_anti").unionByName(mended.select(*out.columns))
