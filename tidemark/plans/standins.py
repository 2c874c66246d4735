"""Frames of the shapes the operators expect, taken from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_ms(when: Column) -> Column:
    """Milliseconds since 1970-01-01 of a time without zone, whatever the session's zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), when)


def order_level(priority: Column) -> Column:
    return F.when(priority.isin("1-URGENT", "2-HIGH"), "paid").otherwise("free")


def order_plays(spark: SparkSession, folder: str) -> DataFrame:
    """A customer's orders as sessions; ``n`` holds the plays (line items) of each."""
    items = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    orders = table(spark, folder, "orders")
    return orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("session_id"),
        order_level(F.col("o_orderpriority")).alias("level"),
        F.col("o_orderdate").alias("start_time"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


PLAYS_SQL = """
plays AS (
    SELECT o_custkey AS user_id, o_orderkey AS session_id,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'paid' ELSE 'free' END AS level,
           o_orderdate AS start_time, coalesce(n, 0) AS n
    FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
)"""

# Runs of one level are islands: a session's place among all of the user's sessions, less its place
# among those at its level, is constant within a run.
SPANS_SQL = PLAYS_SQL + """,
visits AS (
    SELECT user_id, session_id, min(level) AS level, min(start_time) AS began, sum(n) AS played
    FROM plays GROUP BY user_id, session_id
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY began, session_id) AS nth,
           row_number() OVER (PARTITION BY user_id, level ORDER BY began, session_id) AS nth_at_level
    FROM visits
),
islands AS (
    SELECT user_id, level, min(nth) AS from_nth, max(nth) AS to_nth, sum(played) AS played,
           min(began) AS first_day, max(began) AS last_day
    FROM placed GROUP BY user_id, level, nth - nth_at_level
),
in_order AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY from_nth) AS island,
           count(*) OVER (PARTITION BY user_id) AS islands
    FROM islands
),
spans AS (
    SELECT i.user_id, i.islands - i.island + 1 AS user_level_index, i.level AS level_current,
           earlier.level AS level_previous, later.level AS level_next,
           i.to_nth - i.from_nth + 1 AS level_sessions, CAST(i.played AS BIGINT) AS play_count,
           datediff('day', i.first_day, i.last_day) AS level_days,
           date_sub('day', i.first_day, i.last_day) AS level_days_elapsed
    FROM in_order i
    LEFT JOIN in_order earlier ON earlier.user_id = i.user_id AND earlier.island = i.island - 1
    LEFT JOIN in_order later ON later.user_id = i.user_id AND later.island = i.island + 1
),
labelled AS (
    SELECT *, CASE
        WHEN level_current = 'free' AND level_next = 'paid' THEN 'Free then Paid'
        WHEN level_current = 'paid' AND level_next = 'free' THEN 'Paid then Free'
        WHEN level_current = 'free' AND level_next IS NULL THEN 'Free Only'
        WHEN level_current = 'paid' AND level_next IS NULL THEN 'Paid Only'
    END AS level_category
    FROM spans
)"""


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a log: views are plays, sign-ups are home visits."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id"),
        F.col("user_id").alias("userId"),
        F.when(kind == "view", "NextSong").when(kind == "signup", "Home").otherwise(kind).alias("page"),
        epoch_ms(F.col("ts")).alias("ts"),
    )


def log_plays(log: DataFrame) -> DataFrame:
    """Play facts of an event log, as stored by the star schema."""
    from tidemark.functions.time import epoch_to_timestamp
    from tidemark.operators.star import song_plays

    return song_plays(log).select(
        F.col("event_id").alias("songplay_id"), epoch_to_timestamp(F.col("ts")).alias("start_time")
    )


LOG_PLAYS_SQL = "log_plays AS (SELECT event_id, date_trunc('second', ts) AS t FROM events WHERE event_type = 'view')"


def item_log(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a log: everything but returned items is a play."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("artist"),
        F.col("l_linenumber").cast("string").alias("song"),
        F.col("l_extendedprice").alias("length"),
        F.when(F.col("l_returnflag") == "R", "Home").otherwise("NextSong").alias("page"),
        epoch_ms(F.col("l_shipdate")).alias("ts"),
        F.col("l_suppkey").alias("userId"),
        F.col("l_partkey").alias("sessionId"),
        F.col("l_linestatus").alias("level"),
        F.col("l_returnflag").alias("location"),
        F.col("l_quantity").cast("bigint").cast("string").alias("userAgent"),
        F.col("l_returnflag").alias("gender"),
        F.col("l_linestatus").alias("firstName"),
        F.col("l_linenumber").cast("string").alias("lastName"),
    )


def item_songs(spark: SparkSession, folder: str) -> DataFrame:
    """Early shipments as the known songs."""
    return (
        table(spark, folder, "lineitem").filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("song_id"),
            F.col("l_suppkey").cast("string").alias("artist_id"),
            F.col("l_linenumber").cast("string").alias("title"),
            F.col("l_linenumber").cast("smallint").alias("year"),
            F.col("l_extendedprice").alias("duration"),
            F.col("l_orderkey").cast("string").alias("artist_name"),
            F.col("l_returnflag").alias("artist_location"),
            F.col("l_discount").alias("artist_latitude"),
            F.col("l_tax").alias("artist_longitude"),
        )
    )


ITEM_SONGS_SQL = """
songs AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS song_id, CAST(l_suppkey AS VARCHAR) AS artist_id,
           CAST(l_linenumber AS VARCHAR) AS title, CAST(l_linenumber AS SMALLINT) AS year,
           l_extendedprice AS duration, CAST(l_orderkey AS VARCHAR) AS artist_name,
           l_returnflag AS artist_location, l_discount AS artist_latitude, l_tax AS artist_longitude
    FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
)"""

FACTS_SQL = ITEM_SONGS_SQL + """,
facts AS (
    SELECT song_id, artist_id, l_shipdate AS start_time, l_suppkey AS user_id, l_partkey AS session_id,
           l_linestatus AS level, l_returnflag AS location, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS user_agent
    FROM lineitem
    LEFT JOIN songs ON artist_name = CAST(l_orderkey AS VARCHAR) AND title = CAST(l_linenumber AS VARCHAR)
        AND duration = l_extendedprice
    WHERE l_returnflag <> 'R'
)"""


SLOTS = 16


def label_points(spark: SparkSession, folder: str) -> DataFrame:
    """Begin and end points of each embedding: every four of its positions are one pair, keyed by label and slot."""
    from tidemark.operators.geo import unpivot_points

    slots = F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.slice(F.col("embedding"), i * 4 + 1, 4)
    )).alias("slot", "e")
    cut = table(spark, folder, "embeddings").select("label", slots)
    keyed = cut.select((F.col("label") * SLOTS + F.col("slot")).cast("bigint").alias("label"), "e")
    e = F.col("e")
    return unpivot_points(keyed, "label", [(e[0], e[1]), (e[2], e[3])])


POINTS_SQL = f"""
points AS (
    SELECT CAST(label * {SLOTS} + slot AS BIGINT) AS label, CAST(embedding[slot * 4 + part * 2 + 1] AS DOUBLE) AS lon,
           CAST(embedding[slot * 4 + part * 2 + 2] AS DOUBLE) AS lat
    FROM embeddings, range({SLOTS}) s(slot), range(2) p(part)
)"""


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as plays: the conversation is the session, the turn the item."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("sessionId"),
        F.col("turn").alias("itemInSession"),
        F.col("role").alias("artist"),
        F.col("text").alias("song"),
        F.length("text").cast("double").alias("length"),
        F.col("conv_id").alias("userId"),
        F.col("role").alias("firstName"),
        F.col("text").alias("lastName"),
    )
