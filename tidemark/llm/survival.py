"""What filters remove alone, in any order and in interplay, from one pass over their verdicts.

With f filters, a document survives a set of filters if it fails none of them.
Its truth table over all 2^f sets is one word: bit s is set if it survives the
set whose members are the bits of s. Up to five filters make a word of 32 bits.

How many documents survive each set is the number of words with that bit set.
These positional popcounts are taken with carry-save adders over whole arrays: of
three words of equal weight, the bitwise sum stays and the bitwise carries have
twice the weight. Each step turns three words into two, for all 32 positions at
once, until each weight has two words at most.

Every count of an audit follows from these 2^f numbers a part and label: what a
step removes is the difference of the survivors of two sets.

Counts are added up a task, then over tasks, so a hot part has one row a task. A
NULL verdict counts as passing. An empty table has no parts and no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WIDTH = 5
#: Parts whose counts a task holds before it hands them on.
PARTS = 20_000


def truth_words(filters: int) -> np.ndarray:
    """For each set of failed filters, the word of the sets that survive it."""
    sets = np.arange(1 << filters)
    alive = (sets[:, None] & sets[None, :]) == 0
    return (alive.astype(np.uint32) << sets.astype(np.uint32)).sum(1, dtype=np.uint32)


def popcounts(words: np.ndarray) -> np.ndarray:
    """How often each of the 32 bits is set, by carry-save addition."""
    counts = np.zeros(32, np.int64)
    weight, level = 0, words.astype(np.uint32, copy=False)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            either = a ^ b
            carries.append((a & b) | (either & c))
            level = np.concatenate([either ^ c, level[3 * third :]])
        for word in level:  # two at most
            counts += ((word >> np.arange(32, dtype=np.uint32)) & 1).astype(np.int64) << weight
        level = np.concatenate(carries) if carries else np.zeros(0, np.uint32)
        weight += 1
    return counts


def survivors(verdicts: DataFrame, part: str, failed: list[str], labels: list[str]) -> DataFrame:
    """``part``, and arrays ``all_`` and one for each label: survivors of each set of filters.

    ``failed`` and ``labels`` name boolean columns.
    """
    if not 0 < len(failed) <= WIDTH:
        raise ValueError(f"one to {WIDTH} filters")
    words, sets = truth_words(len(failed)), 1 << len(failed)
    kinds = ["all_", *labels]
    bits = sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) * (1 << i) for i, c in enumerate(failed)), F.lit(0))
    marks = sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) * (1 << i) for i, c in enumerate(labels)), F.lit(0))
    slim = verdicts.select(F.col(part).alias("part"), bits.cast("int").alias("bits"), marks.cast("int").alias("marks"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush() -> pa.RecordBatch:
            flat = np.concatenate([np.concatenate(rows) for rows in held.values()])
            lists = pa.ListArray.from_arrays(np.arange(len(held) * len(kinds) + 1, dtype=np.int32) * sets, flat)
            columns = [lists.take(pa.array(np.arange(len(held)) * len(kinds) + k)) for k in range(len(kinds))]
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *columns], names=["part", *kinds])
            held.clear()
            return out

        for batch in batches:
            codes = batch.column("part").dictionary_encode()
            names = codes.dictionary.to_pylist()
            at = codes.indices.fill_null(len(names)).to_numpy(zero_copy_only=False)
            order = np.argsort(at, kind="stable")
            own, flags = words[batch.column("bits").to_numpy()[order]], batch.column("marks").to_numpy()[order]
            found, first = np.unique(at[order], return_index=True)
            for code, low, high in zip(found, first, [*first[1:], len(own)]):
                here, mark = own[low:high], flags[low:high]
                rows = [popcounts(here)] + [popcounts(here[(mark >> i) & 1 == 1]) for i in range(len(labels))]
                rows = [r[:sets] for r in rows]
                name = names[code] if code < len(names) else None
                held[name] = [x + y for x, y in zip(held[name], rows)] if name in held else rows
            if len(held) >= PARTS:
                yield flush()
        if held:
            yield flush()

    counted = slim.mapInArrow(count, "part string, " + ", ".join(f"{k} array<bigint>" for k in kinds))
    sums = [F.array(*[F.sum(F.col(k)[s]) for s in range(sets)]).alias(k) for k in kinds]
    return counted.groupBy("part").agg(*sums)


def shapley(alive: Column, filters: int, which: int) -> Column:
    """What a filter removes, summed over all orders of the filters.

    It meets each set of others as its predecessors in |set|! (f - 1 - |set|)! orders.
    """
    own, total = 1 << which, F.lit(0).cast("long")
    for s in range(1 << filters):
        if not s & own:
            size = s.bit_count()
            times = factorial(size) * factorial(filters - 1 - size)
            total = total + (alive[s] - alive[s | own]) * F.lit(times)
    return total


def audit(verdicts: DataFrame, part: str, filters: dict[str, str], labels: dict[str, str]) -> DataFrame:
    """One row for each part, order of the filters and step.

    ``filters`` gives the boolean column that marks a failure for each filter's
    letter, ``labels`` a label's column for each name. Columns: ``part``,
    ``filter_order``, ``step`` (its filter is the letter there), ``kept`` after
    the step, ``removed`` by it, ``redundant`` (failing, but removed before),
    ``unique_fails`` (failing this filter only), ``<name>_lost`` of each label,
    and ``shapley``, the filter's removals summed over all orders.
    """
    names, n = list(filters), len(filters)
    alive = survivors(verdicts, part, list(filters.values()), list(labels.values()))
    alive = alive.withColumn("shares", F.array(*[shapley(F.col("all_"), n, i) for i in range(n)]))
    full = (1 << n) - 1
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append({
                "filter_order": "".join(names[j] for j in order), "step": step, "i": i, "b": before, "a": before | 1 << i,
            })
            before |= 1 << i
    # f! * f steps, 600 for five filters, beside each part's arrays
    every = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,i:int,b:int,a:int>>")
    lost = lambda c: F.col(c)[F.col("b")] - F.col(c)[F.col("a")]
    fails = F.col("all_")[0] - F.col("all_")[F.expr("shiftleft(1, i)")]
    alone = F.col("all_")[F.expr(f"{full} - shiftleft(1, i)")] - F.col("all_")[full]
    return alive.select("*", F.inline(every)).select(
        "part", "filter_order", "step",
        F.col("all_")[F.col("a")].alias("kept"), lost("all_").alias("removed"),
        (fails - lost("all_")).alias("redundant"), alone.alias("unique_fails"),
        *[lost(column).alias(f"{name}_lost") for name, column in labels.items()],
        F.col("shares")[F.col("i")].alias("shapley"),
    )
