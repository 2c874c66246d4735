import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import schemas
from tidemark.operators import dedup, serving, star

DAY = 1_541_000_000_000


def event(**given):
    base = {f.name: None for f in schemas.STAGING_EVENTS}
    base.update(page="NextSong", level="free", sessionId=1, userAgent="x", location="A, CA", itemInSession=0)
    return tuple({**base, **given}.values())


def events(spark, *given):
    return spark.createDataFrame([event(**g) for g in given], schemas.STAGING_EVENTS)


def songs(spark, *given):
    names = schemas.STAGING_SONGS.names
    return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], schemas.STAGING_SONGS)


SONG = dict(song_id="S1", artist_id="A1", title="Slow Harbour", artist_name="The Quays", duration=187.25, year=1987)
PLAY = dict(artist="The Quays", song="Slow Harbour", length=187.25, userId=8)


def test_songplay_keeps_unmatched_plays(spark):
    log = events(
        spark,
        dict(PLAY, ts=DAY + 796),
        dict(PLAY, length=187.2, ts=DAY + 5000),
        dict(userId=8, page="Home", ts=DAY),
    )
    facts = star.build_songplay(log, songs(spark, SONG))
    start = datetime(2018, 10, 31, 15, 33, 20)
    assert rows(facts, "start_time", "song_id", "artist_id", "user_id") == [
        (start, "S1", "A1", 8), (start.replace(second=25), None, None, 8),
    ]
    assert facts.select("songplay_id").distinct().count() == 2
    exact = star.build_songplay(log, songs(spark, SONG), precision="ms")
    assert rows(exact, "start_time")[0] == (start.replace(microsecond=796000),)


def test_songplay_repeats_with_its_song_and_dense_ids(spark):
    log = events(spark, *[dict(PLAY, ts=DAY + 1000 * i) for i in range(5)])
    facts = star.build_songplay(log, songs(spark, SONG, dict(SONG, song_id="S2")), ids="dense")
    assert rows(facts, "songplay_id") == [(i,) for i in range(10)]
    in_order = [r["start_time"] for r in facts.orderBy("songplay_id").collect()]
    assert in_order == sorted(in_order)


def test_lookup_takes_one_match(spark):
    log = events(spark, dict(PLAY, ts=DAY), dict(PLAY, artist="Other", ts=DAY))
    artists = spark.createDataFrame([("A1", "The Quays"), ("A2", "Someone")], "artist_id string, name string")
    found = star.lookup_one(log, songs(spark, dict(SONG, song_id="S9"), SONG), artists)
    assert rows(found, "artist", "song_id", "artist_id") == [("Other", None, None), ("The Quays", "S1", "A1")]


def test_users_latest_over_all_pages(spark):
    log = events(
        spark,
        dict(userId=1, ts=1, level="free", firstName="A"), dict(userId=1, ts=9, level="paid", firstName="A", page="Home"),
        dict(userId=2, ts=None, level="free", firstName="B"), dict(userId=2, ts=3, level="paid", firstName="B"),
        dict(userId=3, ts=5, level="free", firstName="C"), dict(userId=3, ts=5, level="paid", firstName="C"),
        dict(userId=None, ts=5, firstName="D"),
    )
    assert rows(star.build_users(log), "user_id", "level") == [(1, "paid"), (2, "paid"), (3, "free")]
    assert rows(star.build_users(log, ties="all"), "user_id", "level") == [
        (1, "paid"), (2, "paid"), (3, "free"), (3, "paid"),
    ]


def test_all_ties_of_a_hot_user_survive(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.when(F.col("id") < 400, 7).otherwise(3).alias("t"), "id")
    unknown = spark.range(5).select(F.lit(2).alias("k"), F.lit(None).cast("int").alias("t"), "id")
    found = dedup.latest_with_ties(df.union(unknown), "k", "t")
    assert rows(found.groupBy("k").count()) == [(1, 400), (2, 5)]


def test_songs_take_independent_maxima(spark):
    found = star.build_songs(songs(spark, dict(SONG, title="A", year=2000), dict(SONG, title="B", year=None)))
    assert rows(found) == [("S1", "B", "A1", 2000, 187.25)]


def test_artists_by_year_then_play(spark):
    catalogue = songs(
        spark,
        dict(SONG, artist_location="old", year=1980), dict(SONG, artist_location="new", year=1987),
        dict(SONG, artist_location="unknown year", year=None),
        dict(SONG, artist_id="A2", artist_location="silent", title="x", year=2000),
        dict(SONG, artist_id="A2", artist_location="played", year=2000),
    )
    log = events(spark, dict(PLAY, ts=5), dict(PLAY, ts=7))
    assert rows(star.build_artists(catalogue, log), "artist_id", "artist_location") == [("A1", "new"), ("A2", "played")]
    first = star.build_artists(catalogue, log, nulls="first")
    assert rows(first, "artist_id", "artist_location") == [("A1", "unknown year"), ("A2", "silent")]


def test_artists_join_only_songs_of_the_newest_year(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["A", "B", "C", None]), rnd.choice("xyz"), rnd.choice([None, "s", "t"]), rnd.choice([0.0, -0.0, 2.5]),
             rnd.choice([None, 1980, 1981, 1982]), str(i)) for i in range(60)]
    columns = "artist_id string, artist_name string, title string, duration double, year int, place string"
    told = [(rnd.choice("xyz"), rnd.choice([None, "s"]), rnd.choice([0.0, 2.5]), rnd.choice([None, 1, 2, 3])) for _ in range(9)]
    plays = spark.createDataFrame(told, "artist string, song string, length double, ts long")
    for nulls in ("last", "first"):
        def place(row, nulls=nulls):
            times = [t[3] for t in told if t[:3] == row[1:4] and None not in t[:2] and t[3] is not None]
            least = float("-inf" if nulls == "last" else "inf")
            found = max(times) if times else least
            return (-(least if row[4] is None else row[4]), -found, row[5])
        first = {k: min((r for r in data if r[0] == k), key=place)[5] for k in {r[0] for r in data}}
        latest = star.latest_artists(
            spark.createDataFrame(data, columns), plays, "artist_id", "year", star.MATCH, ["place"], nulls
        )
        assert {r.artist_id: r.place for r in latest.collect()} == first
    # what is joined has been reduced to the newest years on both sides
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("rank(") < plan.index("Union") and "AND _asked" in plan


def test_time_parts(spark):
    log = events(spark, dict(PLAY, ts=DAY + 1), dict(PLAY, ts=DAY + 2), dict(ts=DAY + 3000, page="Home"))
    start = datetime(2018, 10, 31, 15, 33, 20)
    assert rows(star.build_time(log)) == [(start, 15, 31, 44, 10, 2018, 3)]
    assert [r["weekday"] for r in star.build_time(log, weekday="monday0", precision="ms").collect()] == [2, 2]


def test_insert_ignore(spark):
    new = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "b")], "k string, o int, v string")
    assert rows(dedup.insert_ignore(None, new, ["k"], ["o"]), "k", "v") == [("a", "early"), ("b", "b")]
    target = spark.createDataFrame([("a", 0, "kept")], "k string, o int, v string")
    assert rows(dedup.insert_ignore(target, new, ["k"], ["o"]), "k", "v") == [("a", "kept"), ("b", "b")]


def test_upsert_replaces_only_the_level(spark):
    new = spark.createDataFrame(
        [(1, 1, "Ann", "free"), (1, 2, "Anna", "paid"), (2, 1, "Bob", None)], "u int, o int, name string, level string"
    )
    how = ("u", ["o"], ["name"], ["level"])
    first = dedup.upsert(None, new, *how)
    assert rows(first) == [(1, "Ann", "paid"), (2, "Bob", None)]
    later = spark.createDataFrame([(1, 3, "Other", "free"), (3, 3, "Cy", "paid")], new.schema)
    assert rows(dedup.upsert(first, later, *how)) == [(1, "Ann", "free"), (2, "Bob", None), (3, "Cy", "paid")]


def test_group_limit_is_planned_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.overwrite_by_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial") and "WindowGroupLimit" in plan
    assert rows(dedup.overwrite_by_key(df, ["k"], ["id"])) == [(0, 99), (1, 97), (2, 98)]


LISTENS = [
    # artist, song, length, session, item, user, first and last name
    ("Faithless", "Music Matters (Mark Knight Dub)", 495.3073, 338, 4, 50, "Ava", "Robinson"),
    ("Down To The Bone", "Keep On Keepin' On", 333.76608, 182, 0, 10, "Sylvie", "Cruz"),
    ("Sebastien Tellier", "Kilometer", 377.73016, 182, 2, 10, "Sylvie", "Cruz"),
    ("Three Drives", "Greece 2000", 411.6371, 182, 1, 10, "Sylvie", "Cruz"),
    ("Lonnie Gordon", "Catch You Baby (Steve Pitron & Max Sanna Radio Edit)", 181.21098, 182, 3, 10, "Sylvie", "Cruz"),
    ("The Black Keys", "All Hands Against His Own", 196.91057, 559, 25, 29, "Jacqueline", "Lynch"),
    ("The Black Keys", "All Hands Against His Own", 196.91057, 611, 2, 80, "Tegan", "Levine"),
    ("The Black Keys", "All Hands Against His Own", 196.91057, 612, 3, 80, "Tegan", "Levine"),
    ("The Black Keys", "All Hands Against His Own", 196.91057, 152, 5, 95, "Sara", "Johnson"),
]


@pytest.fixture
def listens(spark):
    return spark.createDataFrame(
        LISTENS,
        "artist string, song string, length double, sessionId bigint, itemInSession int, userId bigint, "
        "firstName string, lastName string",
    )


def test_serving_tables(listens):
    order = ["sessionId", "itemInSession"]
    one = serving.point_lookup(serving.song_by_session_item(listens, order), sessionId=338, itemInSession=4)
    assert rows(one, "artist", "song", "length") == [("Faithless", "Music Matters (Mark Knight Dub)", 495.3073)]
    session = serving.partition_lookup(
        serving.songs_by_user_session(listens, order), {"userId": 10, "sessionId": 182}, ["itemInSession"]
    )
    assert [(r["itemInSession"], r["artist"], r["lastName"]) for r in session.collect()] == [
        (0, "Down To The Bone", "Cruz"), (1, "Three Drives", "Cruz"),
        (2, "Sebastien Tellier", "Cruz"), (3, "Lonnie Gordon", "Cruz"),
    ]
    listeners = serving.partition_lookup(
        serving.users_by_song(listens, order), {"song": "All Hands Against His Own"}, ["userId"]
    )
    assert [(r["firstName"], r["lastName"]) for r in listeners.collect()] == [
        ("Jacqueline", "Lynch"), ("Tegan", "Levine"), ("Sara", "Johnson"),
    ]
