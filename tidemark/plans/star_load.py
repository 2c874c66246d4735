"""Loading batches of songs and logs into all star tables, as one commit a batch.

A batch of files changes songs, artists, users, times and plays together or not at
all. Songs of a batch are loaded first, so its plays find them, beside all songs
that earlier batches brought; a play that comes before its song stays unmatched,
as in a load file by file. Play ids go on from the last committed one, and are
given to stored rows, so a failed batch or a repeated task uses none up.

Beside the star, the store keeps what later batches need: the match columns of all
songs, and of the users' and artists' rows that won what they won by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.time import calendar_parts
from tidemark.operators import star
from tidemark.operators.dedup import first_per_key, max_per_key
from tidemark.operators.ordered import dense_id
from tidemark.storage import materialize
from tidemark.streaming.incremental import Choice, Store

#: Each table and its key; rows of the last two are appended.
TABLES = {
    "users": "userId", "songs": "song_id", "artists": "artist_id", "time": "start_time", "songplay": None, "catalog": None,
}
DETAILS = ["firstName", "lastName", "gender", "level"]
ARTIST = ["artist_name", "artist_location", "artist_latitude", "artist_longitude"]
CATALOG = ["song_id", "artist_id", *ARTIST, "title", "year", "duration"]
#: What is read of an event, beside its user's details.
PLAY = ["artist", "song", "length", "page", "ts", "userId", "sessionId", "level", "location", "userAgent"]


def star_store(spark: SparkSession, path: str, rows: int = 1_000_000, tables: tuple[str, ...] | None = None) -> Store:
    """A store of the star tables, or of those named and the catalog."""
    kept = TABLES if tables is None else {name: key for name, key in TABLES.items() if name in (*tables, "catalog")}
    return Store(spark, path, kept, rows)


def _first(rows: DataFrame, key: str, by: str, order: list[Column]) -> DataFrame:
    """First row of each key in ``order``, which begins with the greatest ``by``: only rows that have it are sorted."""
    most = materialize(rows.groupBy(F.col(key).alias("_key")).agg(F.max(by).alias("_most")), "most")
    on = F.col(key).eqNullSafe(F.col("_key")) & F.col(by).eqNullSafe(F.col("_most"))
    return first_per_key(rows.join(most, on, "left_semi"), [key], order)


def load_batch(store: Store, number: int, events: DataFrame, songs: DataFrame) -> bool:
    """Apply staged ``events`` and ``songs`` as batch ``number``; False if it has been applied before.

    Events are read once, into a join with all songs that is stored; the tables are made from that.
    """
    if number in store.versions():
        return False
    fresh = store.stage("catalog", number, songs.select(*CATALOG))
    known = store.read("catalog")
    catalog = fresh if known is None else known.unionByName(fresh)
    if {"users", "artists"} & set(store.keys):
        columns, of_song = list(dict.fromkeys(PLAY + DETAILS)), CATALOG
    else:
        events, columns, of_song = star.song_plays(events), PLAY, ["song_id", "artist_id", "artist_name", "title", "duration"]
    matched = star.match_songs(events.select(*columns), catalog.select(*of_song))
    met = materialize(matched.drop("song", "length"), "batch-events")

    def users():
        order = [F.col("ts").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in DETAILS]]
        rows = _first(met.select("userId", *DETAILS, "ts"), "userId", "ts", order)
        return rows, Choice(lambda df, keys: first_per_key(df, keys, order))

    def known_songs():
        values = ["title", "artist_id", "year", "duration"]
        return fresh.select("song_id", *values), Choice(lambda df, keys: max_per_key(df, keys, values))

    def artists():
        # an artist's row may change by a new song, or by a play of any known one
        order = [F.col("year").desc_nulls_last(), F.col("last_ts").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ARTIST]]
        row = ["artist_id", *ARTIST, "year", "last_ts"]
        played = met.filter("artist_id IS NOT NULL").withColumnsRenamed({"artist": "artist_name", "ts": "last_ts"})
        new = fresh.withColumn("last_ts", F.lit(None).cast(met.schema["ts"].dataType))
        rows = _first(played.select(*row).unionByName(new.select(*row)), "artist_id", "year", order)
        return rows, Choice(lambda df, keys: first_per_key(df, keys, order))

    def times():
        rows = star.song_plays(met).select(star.epoch_to_timestamp(F.col("ts")).alias("start_time")).distinct()
        return rows, Choice(lambda df, keys: df.dropDuplicates(keys))

    def plays():
        facts = star.play_facts(star.song_plays(met))
        first = ["start_time", "user_id", "session_id"]
        order = [F.col(c) for c in first + [c for c in facts.columns if c not in first]]
        return dense_id(facts, order, "songplay_id", start=store.count("songplay"))

    changes = {"songs": known_songs, "artists": artists, "users": users, "time": times, "songplay": plays, "catalog": lambda: fresh}
    return store.commit(
        number, {name: change() for name, change in changes.items() if name in store.keys}, stored=("songs", "catalog")
    )


def read_star(store: Store, version: int | None = None) -> dict[str, DataFrame]:
    """The star tables as of a commit, the last by default; none before the first."""
    tables = {name: store.read(name, version) for name in ("users", "songs", "artists", "time", "songplay") if name in store.keys}
    found = {name: df for name, df in tables.items() if df is not None}
    shaped = {
        "users": lambda df: df.select(
            F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"), "gender", "level"
        ),
        "artists": lambda df: df.select("artist_id", *ARTIST),
        "time": lambda df: df.select("start_time", *calendar_parts(F.col("start_time"))),
        "songplay": lambda df: df.select("songplay_id", *[c for c in df.columns if c != "songplay_id"]),
    }
    return {name: shaped[name](df) if name in shaped else df for name, df in found.items()}
