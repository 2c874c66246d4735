"""Keys that hold a large share of the rows: finding them, and joining by them.

Candidates come from a mergeable frequent-items sketch (``approx_top_k``): every
map task fills one of bounded size, and the sketches are merged. Of ``n`` rows a
sketch of 10 ``KEYS`` entries misses no key with ``n / KEYS`` rows or more, so at
most ``KEYS`` hashes reach the driver, whatever the data hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Keys found at most, and entries of the sketch for each of them.
KEYS, ENTRIES = 1_000, 10
#: Rows that a heavy key may have on the broadcast side.
PER_KEY = 64


def heavy_hashes(df: DataFrame, hashed: Column, share: float = 1 / KEYS) -> list[int]:
    """Values of ``hashed`` (a 64-bit hash) that hold about ``share`` of the rows or more."""
    if not 1 / KEYS <= share <= 1:
        raise ValueError(f"a share is from {1 / KEYS} to 1")
    sketch = F.call_function("approx_top_k", hashed, F.lit(KEYS), F.lit(KEYS * ENTRIES))
    rows, found = df.agg(F.count(F.lit(1)), sketch).first()
    # the sketch counts too much rather than too little
    return [r[0] for r in found if r[1] >= share * rows]


def split_heavy(
    stored: DataFrame, keys: list[str], rows: int, share: float = 1 / KEYS
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that one task can hold, and rows of keys with at least ``rows`` rows and ``share`` of all (or None).

    ``stored`` is read once more where it has ``rows`` rows or more.
    """
    total = stored.count()
    if total < rows:
        return stored, None
    hashed = F.xxhash64(*keys)
    heavy = heavy_hashes(stored, hashed, min(1.0, max(share, rows / total)))
    if not heavy:
        return stored, None
    return stored.filter(~hashed.isin(heavy)), stored.filter(hashed.isin(heavy))


def key_skew(df: DataFrame, column: str, share: float = 0.01) -> DataFrame:
    """Values of a column of any type that hold at least ``share`` of the rows: ``key`` (text), ``rows``, ``share``.

    The sketch only names candidates; they are counted exactly. NULL is a value.
    """
    hashed = F.xxhash64(column)
    candidates = heavy_hashes(df, hashed, share)
    total = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    counted = df.filter(hashed.isin(candidates)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") >= F.lit(share) * total).select(
        F.col(column).cast("string").alias("key"), "rows", (F.col("rows") / total).alias("share")
    )


def join_heavy(
    left: DataFrame,
    right: DataFrame,
    on: list[str] | list[tuple[str, str]],
    how: str = "inner",
    null_safe: bool = False,
    share: float = 1 / KEYS,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join in which keys that hold ``share`` of the left rows or more are not shuffled.

    Left rows of heavy keys meet the right rows of these keys by broadcast: at
    most ``KEYS`` keys of at most ``PER_KEY`` rows each. All others are joined as
    Spark plans it; so is a heavy key with more right rows, which is left to
    adaptive execution. ``left`` is read once more for its keys, so store it
    where that costs, or name a frame of the same key columns as ``keys_from``;
    it decides how rows travel, not which ones meet. ``on`` pairs left with right columns of one type; the
    result holds the left columns and, for 'inner' and 'left', the other right
    columns. ``null_safe`` lets NULL equal NULL.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a join of type {how}")
    pairs = [(p, p) if isinstance(p, str) else p for p in on]
    for l, r in pairs:
        if left.schema[l].dataType != right.schema[r].dataType:
            raise ValueError(f"{l} and {r} have different types")
    renamed = right.withColumnsRenamed({r: f"_on_{r}" for _, r in pairs})
    same = [F.col(l).eqNullSafe(F.col(f"_on_{r}")) if null_safe else F.col(l) == F.col(f"_on_{r}") for l, r in pairs]
    condition = reduce(lambda a, b: a & b, same)
    left_hash = F.xxhash64(*[l for l, _ in pairs])
    right_hash = F.xxhash64(*[f"_on_{r}" for _, r in pairs])

    heavy = heavy_hashes(left if keys_from is None else keys_from, left_hash, share)
    if heavy:
        many = renamed.filter(right_hash.isin(heavy)).groupBy(right_hash.alias("h")).count().filter(F.col("count") > PER_KEY)
        crowded = {r.h for r in many.collect()}
        heavy = [h for h in heavy if h not in crowded]
    if not heavy:
        joined = left.join(renamed, condition, how)
    else:
        rest = left.filter(~left_hash.isin(heavy)).join(renamed.filter(~right_hash.isin(heavy)), condition, how)
        few = F.broadcast(renamed.filter(right_hash.isin(heavy)))
        joined = rest.unionByName(left.filter(left_hash.isin(heavy)).join(few, condition, how))
    return joined.drop(*[f"_on_{r}" for _, r in pairs])
