"""Ordered work on groups of any size.

A window over ``partitionBy(key)`` puts each group into one task. That is right
for groups that a task can hold, and they need one shuffle. Keys with a large
share of the rows are found first, by a mergeable sketch over the stored rows, and
go another way: they are range-partitioned by (key, order) into pieces, each piece
is processed on its own, and what a piece needs from its predecessors comes from a
table of one row per (key, piece).

Every piece boundary is crossed by at most one key, and there are at most a
thousand such keys, so that table has at most pieces + 1000 rows. It is stored, so
its size is known when the joins with it are planned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.skew import split_heavy
from tidemark.storage import materialize

#: Rows that one task may put in order; only larger groups are cut into pieces.
TASK_ROWS = 200_000
ROW = "_row"
PIECE = "_piece"


def _matched(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join a stored ``right`` on the named columns, NULL being equal to NULL."""
    renamed = right.withColumnsRenamed({n: f"_m_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_m_{n}")) for n in names])
    return left.join(renamed, on, how).drop(*[f"_m_{n}" for n in names])


def pieces(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partition by ``order``, sort, number the rows, and store.

    ``_piece`` is the partition and ``_row`` ascends with the order over the
    whole frame. The frame is stored because range bounds are sampled and would
    move if it were computed twice.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(ROW, F.monotonically_increasing_id())
    )
    # the upper bits of a monotonically increasing id hold the partition number
    return materialize(ranged, "pieces").withColumn(PIECE, F.shiftright(ROW, 33))


def join_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Attach each piece's carry row."""
    return _matched(rows, materialize(carry, "carry"), [*keys, PIECE], "left")


def running_sum(
    df: DataFrame, keys: list[str], order: list[Column], value: str, name: str, stored: bool = False
) -> DataFrame:
    """Per-key sum of ``value`` up to each row in ``order``; equal rows are peers.

    With no keys the whole frame is one group. Peers share a piece, so add up
    rows of equal key and order first where these may be many. ``stored`` tells
    that ``df`` is read from a stored table, and need not be stored again.
    """
    kept = df if stored else materialize(df, "running")
    rest, heavy = split_heavy(kept, keys, TASK_ROWS) if keys else _as_one(kept)
    upto = Window.partitionBy(*keys).orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    plain = None if rest is None else rest.withColumn(name, F.sum(value).over(upto))
    if heavy is None:
        return plain
    cut = _running_in_pieces(heavy, keys, order, value, name)
    return cut if plain is None else plain.unionByName(cut)


def _as_one(stored: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """A frame that is one group: for one task, or to be cut."""
    return (stored, None) if stored.count() < TASK_ROWS else (None, stored)


def _running_in_pieces(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    cut = pieces(df, [*[F.col(k) for k in keys], *order])
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(*keys, PIECE).agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    within = Window.partitionBy(*keys, PIECE).orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        join_carry(cut.withColumn(name, F.sum(value).over(within)), carry, keys)
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_before", ROW, PIECE)
    )


def dense_id(df: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers in ``order``, without a window over the rows.

    ``order`` should identify a row; equal rows are numbered arbitrarily.
    """
    cut = pieces(df, order)
    before = Window.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(PIECE).agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    position = F.col(ROW) - F.shiftleft(F.col(PIECE).cast("bigint"), 33)
    return (
        join_carry(cut, carry, [])
        .withColumn(name, position + F.col("_before") + F.lit(start))
        .drop(PIECE, ROW, "_before")
    )


def unique_id(df: DataFrame, name: str) -> DataFrame:
    """Unique but gapped numbers, at no cost.

    They depend on row order within tasks: store them before anything shuffles.
    """
    return df.withColumn(name, F.monotonically_increasing_id())
