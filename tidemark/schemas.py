"""Table contracts: types, nullability, declared lengths and key markers.

Spark enforces neither keys nor lengths, so both are kept in field metadata
(``max_len`` and ``primary_key``) and checked by ``operators.quality``.
"""

from __future__ import annotations

from pyspark.sql import types as T


def column(name, dtype, nullable=True, max_len=None, key=False) -> T.StructField:
    """A field whose metadata carries the declared length and the key marker."""
    meta = {}
    if max_len is not None:
        meta["max_len"] = max_len
    if key:
        meta["primary_key"] = True
    return T.StructField(name, dtype, nullable, meta)


def text(name, max_len=None, nullable=True, key=False) -> T.StructField:
    return column(name, T.StringType(), nullable, max_len, key)


def key_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.metadata.get("primary_key")]


def max_lengths(schema: T.StructType) -> dict[str, int]:
    return {f.name: f.metadata["max_len"] for f in schema if "max_len" in f.metadata}


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


# Names, order, types and declared lengths of the input files and of the star tables.

STAGING_EVENTS = T.StructType([
    text("artist", 256),
    text("auth", 256),
    text("firstName", 256),
    text("gender", 1),
    column("itemInSession", T.ShortType()),
    text("lastName", 256),
    column("length", T.DoubleType()),
    text("level", 4),
    text("location", 256),
    text("method", 3),
    text("page", 256),
    column("registration", T.LongType()),
    column("sessionId", T.LongType()),
    text("song", 256),
    column("status", T.ShortType()),
    column("ts", T.LongType()),
    text("userAgent", 256),
    column("userId", T.LongType()),
])

STAGING_SONGS = T.StructType([
    text("song_id", 18),
    text("artist_id", 18),
    text("title", 256),
    column("year", T.ShortType()),
    column("duration", T.DoubleType()),
    text("artist_name", 256),
    text("artist_location", 256),
    column("artist_latitude", T.DoubleType()),
    column("artist_longitude", T.DoubleType()),
])

USERS = T.StructType([
    column("user_id", T.LongType(), False, key=True),
    text("first_name", 256, False),
    text("last_name", 256, False),
    text("gender", 1, False),
    text("level", 4, False),
])

SONGS = T.StructType([
    text("song_id", 18, False, key=True),
    text("title", 256, False),
    text("artist_id", 18, False),
    column("year", T.ShortType()),
    column("duration", T.DoubleType(), False),
])

ARTISTS = T.StructType([
    text("artist_id", 18, False, key=True),
    text("artist_name", 256, False),
    text("artist_location", 256),
    column("artist_latitude", T.DoubleType()),
    column("artist_longitude", T.DoubleType()),
])

TIME = T.StructType([
    column("start_time", T.TimestampNTZType(), False, key=True),
    column("hour", T.ShortType(), False),
    column("day", T.ShortType(), False),
    column("week", T.ShortType(), False),
    column("month", T.ShortType(), False),
    column("year", T.ShortType(), False),
    column("weekday", T.ShortType(), False),
])

SONGPLAY = T.StructType([
    column("songplay_id", T.LongType(), False, key=True),
    text("song_id", 18),
    text("artist_id", 18),
    column("start_time", T.TimestampNTZType(), False),
    column("user_id", T.LongType(), False),
    column("session_id", T.LongType(), False),
    text("level", 4, False),
    text("location", 256),
    text("user_agent", 256, False),
])

STAR = {
    "songplay": SONGPLAY,
    "users": USERS,
    "songs": SONGS,
    "artists": ARTISTS,
    "time": TIME,
}

EVENT_CSV = T.StructType([
    text("artist"),
    text("firstName"),
    text("gender"),
    column("itemInSession", T.IntegerType()),
    text("lastName"),
    column("length", T.DoubleType()),
    text("level"),
    text("location"),
    column("sessionId", T.LongType()),
    text("song"),
    column("userId", T.LongType()),
])

STORM_CSV = T.StructType([
    column("EVENT_ID", T.LongType()),
    column("EPISODE_ID", T.LongType()),
    text("EVENT_TYPE"),
    column("YEAR", T.IntegerType()),
    text("BEGIN_DATE_TIME"),
    text("STATE"),
    column("STATE_FIPS", T.IntegerType()),
    text("CZ_TYPE"),
    column("CZ_FIPS", T.IntegerType()),
    text("CZ_NAME"),
    column("MAGNITUDE", T.DoubleType()),
    text("MAGNITUDE_TYPE"),
    column("BEGIN_LAT", T.DoubleType()),
    column("BEGIN_LON", T.DoubleType()),
    column("END_LAT", T.DoubleType()),
    column("END_LON", T.DoubleType()),
])

STATE_LOOKUP = T.StructType([
    column("id", T.IntegerType()),
    text("abbr"),
    text("state"),
])

LOAD_ERRORS = T.StructType([
    text("filename"),
    text("colname"),
    text("err_reason"),
    column("starttime", T.TimestampNTZType()),
])
