"""Construction of the star schema from staged events and songs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.time import calendar_parts, epoch_to_timestamp
from tidemark.operators.dedup import first_per_key, latest_with_ties, max_per_key
from tidemark.operators.ordered import dense_id, unique_id
from tidemark.operators.skew import join_heavy

PLAY_PAGE = "NextSong"

# (song column, event column) pairs that identify a played song
MATCH = [("artist_name", "artist"), ("title", "song"), ("duration", "length")]


def song_plays(events: DataFrame) -> DataFrame:
    return events.filter(F.col("page") == PLAY_PAGE)


def match_songs(
    logs: DataFrame, songs: DataFrame, pairs: list[tuple[str, str]] = MATCH, split_hot: bool = False
) -> DataFrame:
    """Left join of log rows to songs; a row repeats if its song does.

    A popular song is a hot key on the log side only. Adaptive execution splits
    such partitions for left joins, and broadcasts ``songs`` by itself when its
    measured size allows. ``split_hot`` does not rely on that: songs with a large
    share of the rows are found first, at the price of a pass over the logs' keys,
    and their rows are not shuffled (see ``skew.join_heavy``).
    """
    if split_hot:
        kept = songs.withColumnsRenamed({s: f"_k_{s}" for s, _ in pairs})
        return join_heavy(logs, kept, [(e, f"_k_{s}") for s, e in pairs], "left")
    renamed = songs.withColumnsRenamed({s: f"_s_{s}" for s, _ in pairs})
    on = [F.col(f"_s_{s}") == F.col(e) for s, e in pairs]
    return logs.join(renamed, on, "left").drop(*[f"_s_{s}" for s, _ in pairs])


def play_facts(matched: DataFrame, precision: str = "s") -> DataFrame:
    """The columns of the fact table, of plays that have been matched with songs."""
    return matched.select(
        "song_id",
        "artist_id",
        epoch_to_timestamp(F.col("ts"), precision).alias("start_time"),
        F.col("userId").alias("user_id"),
        F.col("sessionId").alias("session_id"),
        "level",
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def build_songplay(
    events: DataFrame,
    songs: DataFrame,
    precision: str = "s",
    ids: str = "unique",
) -> DataFrame:
    """Fact table: one row per play, with song and artist where known.

    ``ids='unique'`` numbers rows with gaps at no cost, for use in one query
    (``write_lake`` numbers stored rows itself). ``ids='dense'`` numbers them from
    0 in time order, at the price of a range shuffle and a stored copy.
    """
    wanted = songs.select("song_id", "artist_id", "artist_name", "title", "duration")
    facts = play_facts(match_songs(song_plays(events), wanted), precision)
    names = facts.columns
    if ids == "unique":
        numbered = unique_id(facts, "songplay_id")
    elif ids == "dense":
        first = ["start_time", "user_id", "session_id"]
        order = first + [c for c in names if c not in first]
        numbered = dense_id(facts, [F.col(c) for c in order], "songplay_id")
    else:
        raise ValueError("ids is 'unique' or 'dense'")
    return numbered.select("songplay_id", *names)


def lookup_one(logs: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Attach at most one (song_id, artist_id) to each log row.

    Matches on title, artist name and duration; of several matches the smallest
    pair is taken, so log rows never multiply.
    """
    known = (
        songs.select("song_id", "artist_id", "title", "duration")
        .join(artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
        .groupBy("artist_name", "title", "duration")
        .agg(F.min(F.struct("song_id", "artist_id")).alias("_ids"))
        .select("artist_name", "title", "duration", "_ids.song_id", "_ids.artist_id")
    )
    return match_songs(logs, known)


def build_users(events: DataFrame, ties: str = "one") -> DataFrame:
    """Latest row of each user over all pages; with ``ties='all'`` every row of the latest time."""
    details = ["firstName", "lastName", "gender", "level"]
    users = events.filter(F.col("userId").isNotNull()).select("userId", *details, "ts")
    if ties == "one":
        order = [F.col("ts").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in details]]
        latest = first_per_key(users, ["userId"], order)
    elif ties == "all":
        latest = latest_with_ties(users, "userId", "ts")
    else:
        raise ValueError("ties is 'one' or 'all'")
    return latest.select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
    )


def build_songs(songs: DataFrame) -> DataFrame:
    """One row per song with the greatest value of each column."""
    return max_per_key(songs, ["song_id"], ["title", "artist_id", "year", "duration"])


def latest_artists(songs: DataFrame, plays: DataFrame, key: str, year: str, pairs, tie_break: list[str], nulls: str = "last") -> DataFrame:
    """Latest row of ``songs`` per ``key`` by year, then by the last play.

    ``plays`` holds the columns of ``pairs`` and ``ts``. It is reduced to the last
    time per song before the join: the same answer without fan-out, and the
    reduction starts in the map tasks. Only songs of a key's newest year need
    that time; songs that a newer one in their task rules out go first, and the
    names of the others go through the same grouping, so that it drops the times
    of all other songs before anything is joined.
    """
    def newest(name):
        return F.col(name).desc_nulls_last() if nulls == "last" else F.col(name).desc_nulls_first()

    # the newest of each task hold the newest of all, and many songs of one key and year stay spread over the tasks
    told_apart = songs.withColumn("_task", F.spark_partition_id())
    candidates = first_per_key(told_apart, [key, "_task"], [newest(year)], ties=True).drop("_task")
    names = [e for _, e in pairs]
    asked = candidates.select(*[F.col(s).alias(e) for s, e in pairs], F.lit(None).alias("ts"), F.lit(True).alias("_asked"))
    told = plays.select(*names, "ts", F.lit(False).alias("_asked")).unionByName(asked)
    last = told.groupBy(*names).agg(F.max("ts").alias("_last_ts"), F.bool_or("_asked").alias("_asked"))
    renamed = last.filter("_asked").drop("_asked").withColumnsRenamed({e: f"_e_{e}" for e in names})
    joined = candidates.join(renamed, [F.col(s) == F.col(f"_e_{e}") for s, e in pairs], "left")
    order = [newest(year), newest("_last_ts"), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return first_per_key(joined, [key], order).select(*songs.columns)


def build_artists(songs: DataFrame, events: DataFrame, nulls: str = "last") -> DataFrame:
    """One row per artist: latest song year, then latest play, then column order."""
    columns = ["artist_name", "artist_location", "artist_latitude", "artist_longitude"]
    wanted = songs.select("artist_id", *columns, "year", "title", "duration")
    plays = events.select("artist", "song", "length", "ts")
    latest = latest_artists(wanted, plays, "artist_id", "year", MATCH, columns, nulls)
    return latest.select("artist_id", *columns)


def build_time(events: DataFrame, weekday: str = "sunday0", precision: str = "s") -> DataFrame:
    """Distinct play times with their calendar parts."""
    when = epoch_to_timestamp(F.col("ts"), precision).alias("start_time")
    times = song_plays(events).select(when).distinct()
    return times.select("start_time", *calendar_parts(F.col("start_time"), weekday))
