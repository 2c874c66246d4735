"""Keeping one row per key, and loads that merge into an existing table.

``row_number() = 1`` and ``rank() = 1`` filters are planned with a group limit
before the shuffle: each map task sends one row per key (or the ties), so a hot
key does not collect its rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, key: list[str], order: list[Column], ties: bool = False) -> DataFrame:
    """First row of each key in ``order``; with ``ties`` all rows that come first."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", (F.rank() if ties else F.row_number()).over(w)).filter(F.col("_rank") == 1).drop("_rank")


def latest_with_ties(df: DataFrame, key: str, by: str) -> DataFrame:
    """All rows at the greatest ``by`` of their key; NULL counts as least.

    The keys' maxima are joined back by key and time. However many rows tie, no
    task has to hold them all: adaptive execution splits the rows' side.
    """
    latest = df.groupBy(F.col(key).alias("_key")).agg(F.max(by).alias("_latest"))
    on = F.col(key).eqNullSafe(F.col("_key")) & F.col(by).eqNullSafe(F.col("_latest"))
    return df.join(latest, on, "left_semi")


def overwrite_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last write wins: the row with the greatest ``order`` of each key."""
    return first_per_key(df, key, [F.col(c).desc_nulls_last() for c in order])


def insert_ignore(target: DataFrame | None, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First write wins: keys present in ``target`` keep their row.

    A key is not NULL in any of its columns, as a primary key forbids it; such
    rows of ``new`` are left out (``without_key`` returns them).
    """
    first = first_per_key(new.dropna(subset=key), key, [F.col(c).asc_nulls_last() for c in order])
    if target is None:
        return first
    return target.unionByName(first.select(*target.columns).join(target.select(*key), key, "left_anti"))


def without_key(new: DataFrame, key: list[str]) -> DataFrame:
    """Rows that loads by key leave out: those with a NULL in the key."""
    return new.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key]))


def upsert(
    target: DataFrame | None,
    new: DataFrame,
    key: str,
    order: list[str],
    keep_first: list[str],
    keep_last: list[str],
) -> DataFrame:
    """Insert unknown keys; for known ones replace only ``keep_last``.

    Within ``new`` the earliest row gives ``keep_first`` and the latest row
    gives ``keep_last``, as if the rows had been written one by one in ``order``.
    Rows without a key are left out (see ``without_key``).
    """
    at = F.struct(*order)
    reduced = new.dropna(subset=[key]).groupBy(key).agg(
        F.min_by(F.struct(*keep_first), at).alias("_first"),
        F.max_by(F.struct(*keep_last), at).alias("_last"),
    )
    if target is None:
        return reduced.select(key, "_first.*", "_last.*")
    known = target.withColumn("_known", F.lit(True)).alias("t")
    merged = known.join(reduced.alias("n"), key, "full_outer")
    columns = [F.when(F.col("t._known"), F.col(f"t.{c}")).otherwise(F.col(f"n._first.{c}")).alias(c) for c in keep_first]
    columns += [F.when(F.col("n._last").isNotNull(), F.col(f"n._last.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in keep_last]
    return merged.select(key, *columns)


def max_per_key(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Independent maximum of each column, so values may come from different rows."""
    return df.groupBy(*key).agg(*[F.max(c).alias(c) for c in columns])
