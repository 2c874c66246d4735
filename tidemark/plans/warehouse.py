"""End-to-end jobs: logs and songs to a lake of star tables, checks, and panels."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.operators import analytics, quality, spans, star
from tidemark.sinks.tables import write_partitioned, write_table
from tidemark.sources.json_files import by_name, map_paths, read_json_records
from tidemark.sources.staging import load_staging
from tidemark.storage import materialize


def stage_events(spark: SparkSession, path: str, paths: dict[str, str] | None = None, budget: int = 10):
    """(events, rejects) from log files, by JSONPath if a mapping is given, else by name."""
    records = read_json_records(spark, path)
    raw = map_paths(records, paths) if paths else by_name(records, schemas.STAGING_EVENTS)
    return load_staging(raw, schemas.STAGING_EVENTS, budget)


def stage_songs(spark: SparkSession, path: str, budget: int = 10, long_text: str = "truncate"):
    """(songs, rejects) from song files, by name."""
    raw = by_name(read_json_records(spark, path), schemas.STAGING_SONGS)
    return load_staging(raw, schemas.STAGING_SONGS, budget, long_text)


def build_star(events: DataFrame, songs: DataFrame) -> dict[str, DataFrame]:
    return {
        "songplay": star.build_songplay(events, songs),
        "users": star.build_users(events),
        "songs": star.build_songs(songs),
        "artists": star.build_artists(songs, events),
        "time": star.build_time(events),
    }


def write_lake(tables: dict[str, DataFrame], path: str, artist_directories: bool = False) -> None:
    """The given star tables as Parquet: songs by year, in artist order, time and plays by year and month.

    ``artist_directories`` lays songs out in a directory for each year and artist;
    with many artists that means many small files.
    """
    song_keys = ["year", "artist_id"] if artist_directories else ["year"]
    song_sort = ["song_id"] if artist_directories else ["artist_id", "song_id"]
    months, play_sort = ["year", "month"], ["start_time", "user_id", "session_id"]

    def plays() -> None:
        dated = tables["songplay"].drop("songplay_id").withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
        write_partitioned(dated, f"{path}/songplay", months, play_sort, number="songplay_id")

    writers = {
        "songplay": plays,
        "songs": lambda: write_partitioned(tables["songs"], f"{path}/songs", song_keys, song_sort),
        "artists": lambda: write_table(tables["artists"], f"{path}/artists"),
        "users": lambda: write_table(tables["users"], f"{path}/users"),
        "time": lambda: write_partitioned(tables["time"], f"{path}/time", months, ["start_time"]),
    }
    writes = [write for name, write in writers.items() if name in tables]
    # the tables are independent, so their jobs may share the cluster
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def read_lake(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Star tables as stored (all, or those named), with the columns and types of their contracts."""
    tables = {}
    for name in schemas.STAR if names is None else names:
        schema = schemas.STAR[name]
        stored = spark.read.parquet(f"{path}/{name}")
        tables[name] = stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])
    return tables


def check_star(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Key, null and reference reports of the star tables."""
    quality.require_keys(schemas.STAR)
    keyed = {n: (t, schemas.key_columns(schemas.STAR[n])) for n, t in tables.items()}
    references = {"users": "user_id", "songs": "song_id", "artists": "artist_id", "time": "start_time"}
    reports = {"keys": quality.key_report(keyed)}
    for name, table in tables.items():
        reports[f"nulls_{name}"] = quality.null_violations(table, schemas.STAR[name])
    for name, key in references.items():
        reports[f"orphans_{name}"] = quality.orphans(tables["songplay"], tables[name], [(key, key)])
    return reports


def panels(tables: dict[str, DataFrame], states: DataFrame) -> dict[str, DataFrame]:
    """The data behind each dashboard panel."""
    plays, users, time = tables["songplay"], tables["users"], tables["time"]
    # two panels use the spans
    levels = materialize(spans.level_categories(spans.level_spans(plays)), "levels")
    return {
        "user_stats": spans.engagement_stats(levels),
        "user_level": analytics.share_by(users, "level"),
        "play_level": analytics.share_by(plays, "level"),
        "play_trend": analytics.trend(plays, time),
        "play_hour": analytics.hourly(plays, time),
        "play_location": analytics.plays_by_region(plays, states),
        "user_prctile": analytics.top_users(plays, users),
        "user_agent": analytics.agent_matrix(plays),
        "user_comparison": analytics.box_summary(levels, "level_category", ["play_count", "level_sessions"]),
    }
