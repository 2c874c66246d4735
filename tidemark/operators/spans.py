"""Subscription-level spans: runs of sessions at one level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.labels import changed, level_category
from tidemark.functions.time import calendar_days, elapsed_days
from tidemark.operators import ordered
from tidemark.operators.ordered import PIECE, join_carry, pieces
from tidemark.operators.skew import split_heavy
from tidemark.storage import materialize

SESSION_ORDER = ["start_time", "session_id"]


def session_summary(plays: DataFrame, plays_each: Column | None = None) -> DataFrame:
    """Per (user, session): lowest level, first play and number of plays.

    ``plays_each`` sums a prepared count instead of counting ``songplay_id``.

    A minimum over text cannot be kept in a hash aggregate. The level is therefore
    first a grouping column, so that the raw plays are hashed instead of sorted,
    and the few rows per session are merged afterwards.
    """
    count = F.count("songplay_id") if plays_each is None else F.sum(plays_each)
    at_level = plays.groupBy("user_id", "session_id", "level").agg(
        F.min("start_time").alias("start_time"), count.alias("play_count")
    )
    return at_level.groupBy("user_id", "session_id").agg(
        F.min("level").alias("level"),
        F.min("start_time").alias("start_time"),
        F.sum("play_count").alias("play_count"),
    )


def _sequence(sessions: DataFrame, group: list[str]) -> DataFrame:
    """Number the sessions of a group and compare each with its neighbours."""
    w = Window.partitionBy(*group).orderBy(*SESSION_ORDER)
    return (
        sessions.withColumn("user_session_id", F.row_number().over(w).cast("bigint"))
        .withColumn("level_previous", F.lag("level").over(w))
        .withColumn("level_next", F.lead("level").over(w))
        .withColumn("level_change", changed(F.col("level"), F.col("level_previous")).cast("bigint"))
    )


def _running(group: list[str]) -> Column:
    w = Window.partitionBy(*group).orderBy(*SESSION_ORDER)
    return F.sum("level_change").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _in_pieces(sessions: DataFrame) -> DataFrame:
    group = ["user_id", PIECE]
    cut = pieces(sessions, [F.col("user_id"), *[F.col(c) for c in SESSION_ORDER]])
    local = _sequence(cut, group)
    at = F.struct(*SESSION_ORDER)
    by_piece = Window.partitionBy("user_id").orderBy(PIECE)
    earlier = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        local.groupBy(*group).agg(
            F.min_by("level", at).alias("_first_level"),
            F.max_by("level", at).alias("_last_level"),
            F.count(F.lit(1)).alias("_rows"),
            F.sum("level_change").alias("_changes"),
        )
        .withColumn("_previous", F.lag("_last_level").over(by_piece))
        .withColumn("_next", F.lead("_first_level").over(by_piece))
        .withColumn("_changes", F.col("_changes") + changed(F.col("_first_level"), F.col("_previous")))
        .withColumn("_rows_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_changes_before", F.coalesce(F.sum("_changes").over(earlier), F.lit(0)))
        .withColumn("_last_id", F.sum("_changes").over(Window.partitionBy("user_id")))
        .drop("_first_level", "_last_level", "_changes")
    )
    is_first = F.col("user_session_id") == 1
    is_last = F.col("user_session_id") == F.col("_rows")
    return (
        join_carry(local, carry, ["user_id"])
        .withColumn("level_previous", F.when(is_first, F.col("_previous")).otherwise(F.col("level_previous")))
        .withColumn("level_next", F.when(is_last, F.col("_next")).otherwise(F.col("level_next")))
        .withColumn("level_change", changed(F.col("level"), F.col("level_previous")).cast("bigint"))
        .withColumn("user_level_id", _running(group) + F.col("_changes_before"))
        .withColumn("user_session_id", F.col("user_session_id") + F.col("_rows_before"))
    )


def _plain(sessions: DataFrame) -> DataFrame:
    """All of a user's sessions in one task, by one shuffle that the spans' grouping uses as well."""
    everything = Window.partitionBy("user_id")
    return _sequence(sessions, ["user_id"]).withColumn("user_level_id", _running(["user_id"])).withColumn(
        "_last_id", F.sum("level_change").over(everything)
    )


def _sequenced(plays: DataFrame, plays_each: Column | None) -> DataFrame:
    """The plays are read once: their sessions are stored, and all ordered work is done on these."""
    stored = materialize(session_summary(plays, plays_each), "sessions")
    rest, heavy = split_heavy(stored, ["user_id"], ordered.TASK_ROWS)
    found = _plain(rest)
    return found if heavy is None else found.unionByName(_in_pieces(heavy).select(*found.columns))


def session_sequence(plays: DataFrame, plays_each: Column | None = None) -> DataFrame:
    """Each session with its number, neighbouring levels, change flag and span id."""
    return _sequenced(plays, plays_each).select(
        "user_id", "session_id", "level", "start_time", "play_count", "user_session_id",
        "level_previous", "level_next", "level_change", "user_level_id",
    )


def _summarise(sequence: DataFrame) -> DataFrame:
    at = F.col("user_session_id")
    spans = sequence.groupBy("user_id", "user_level_id").agg(
        F.min_by("level", at).alias("level_current"),
        F.min_by("level_previous", at).alias("level_previous"),
        F.max_by("level_next", at).alias("level_next"),
        (F.max(at) - F.min(at) + 1).alias("level_sessions"),
        F.sum("play_count").alias("play_count"),
        F.min("start_time").alias("_from"),
        F.max("start_time").alias("_to"),
        F.max("_last_id").alias("_last_id"),
    )
    return spans.select(
        "user_id",
        # span ids are consecutive, so the rank from the end needs no window
        (F.col("_last_id") - F.col("user_level_id") + 1).alias("user_level_index"),
        "level_current",
        "level_previous",
        "level_next",
        "level_sessions",
        "play_count",
        calendar_days(F.col("_from"), F.col("_to")).alias("level_days"),
        elapsed_days(F.col("_from"), F.col("_to")).alias("level_days_elapsed"),
    )


def level_spans(plays: DataFrame, plays_each: Column | None = None) -> DataFrame:
    """One row per user and run of sessions at one level; index 1 is the latest run.

    Both day counts are given: ``level_days`` by calendar, ``level_days_elapsed``
    by whole 24-hour spans.
    """
    return _summarise(_sequenced(plays, plays_each))


def level_categories(spans: DataFrame) -> DataFrame:
    """Spans with their label."""
    return spans.withColumn("level_category", level_category(F.col("level_current"), F.col("level_next")))


def engagement_stats(spans: DataFrame) -> DataFrame:
    """One row: users, return, bounce and upgrade rates in percent, downgrades."""
    def current_at(index):
        return F.max(F.when(F.col("user_level_index") == index, F.col("level_current")))

    users = spans.groupBy("user_id").agg(
        F.sum("level_sessions").alias("sessions"),
        F.count(F.lit(1)).alias("spans"),
        current_at(1).alias("latest"),
        current_at(2).alias("before"),
        F.count_if(F.col("level_previous") == "paid").alias("downgrades"),
    )

    def rate(condition):
        return F.count_if(condition) * F.lit(100.0) / F.count(F.lit(1))

    return users.agg(
        F.count(F.lit(1)).alias("users"),
        rate(F.col("sessions") > 1).alias("return_rate"),
        rate((F.col("spans") == 1) & (F.col("latest") == "free") & (F.col("sessions") == 1)).alias("bounce_rate"),
        rate((F.col("latest") == "paid") & (F.col("before") == "free")).alias("upgrade_rate"),
        F.sum("downgrades").alias("downgrades"),
    )
