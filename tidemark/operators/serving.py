"""Query-first tables: deduplicated by key, stored in key order, read by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedup import overwrite_by_key


def song_by_session_item(events: DataFrame, order: list[str]) -> DataFrame:
    """Key (sessionId, itemInSession)."""
    key = ["sessionId", "itemInSession"]
    return overwrite_by_key(events, key, order).select(*key, "artist", "song", "length")


def songs_by_user_session(events: DataFrame, order: list[str]) -> DataFrame:
    """Key (userId, sessionId), clustered by itemInSession."""
    key = ["userId", "sessionId", "itemInSession"]
    return overwrite_by_key(events, key, order).select(*key, "artist", "song", "firstName", "lastName")


def users_by_song(events: DataFrame, order: list[str]) -> DataFrame:
    """Key song, clustered by userId; repeated plays collapse."""
    key = ["song", "userId"]
    return overwrite_by_key(events, key, order).select(*key, "firstName", "lastName")


def point_lookup(df: DataFrame, **key) -> DataFrame:
    """Rows whose columns equal the given values; reaches the scan as pushed filters."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in key.items()]))


def partition_lookup(df: DataFrame, key: dict, cluster: list[str]) -> DataFrame:
    """Rows of one partition key in clustering order."""
    return point_lookup(df, **key).orderBy(*cluster)
