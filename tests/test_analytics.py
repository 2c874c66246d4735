import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.text import region_of
from tidemark.operators import analytics, ordered


@pytest.fixture(autouse=True)
def groups_of_any_size_are_cut(monkeypatch):
    monkeypatch.setattr(ordered, "TASK_ROWS", 1)


def test_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "level string")
    assert rows(analytics.share_by(df, "level")) == [(None, 0.25), ("a", 0.5), ("b", 0.25)]


TIME = "start_time timestamp_ntz, hour smallint, day smallint, weekday smallint"


def test_trend_and_hours(spark):
    saturday, later = datetime(2018, 11, 3, 5), datetime(2018, 12, 3, 7)
    plays = spark.createDataFrame(
        [(1, saturday), (2, saturday), (3, later), (4, datetime(2018, 11, 9))], "songplay_id bigint, start_time timestamp_ntz"
    )
    time = spark.createDataFrame([(saturday, 5, 3, 6), (later, 7, 3, 1)], TIME)
    # months merge, and a play without a time row has no day
    assert rows(analytics.trend(plays, time)) == [(None, None, 1, False, None), (3, 1, 3, False, None)]
    assert rows(analytics.trend(plays, time, "date")) == [
        (date(2018, 11, 3), 6, 2, True, date(2018, 11, 5)),
        (date(2018, 11, 9), None, 1, False, None),
        (date(2018, 12, 3), 1, 1, False, None),
    ]
    assert rows(analytics.hourly(plays, time)) == [(None, 1), (5, 2), (7, 1)]


def test_regions(spark):
    places = ["San Francisco-Oakland-Hayward, CA", "Minneapolis-St. Paul-Bloomington, MN-WI", "Fresno, CA", "Nowhere", None]
    df = spark.createDataFrame([(p,) for p in places], "location string")
    assert [r[0] for r in df.select(region_of(F.col("location"))).collect()] == ["CA", "MN", "CA", "", None]
    lookup = spark.createDataFrame([(6, "CA", "California"), (48, "TX", "Texas")], "id int, abbr string, state string")
    counts = analytics.plays_by_region(df, lookup)
    assert rows(counts, "abbr", "state", "play_count") == [(None, None, 0), ("", None, 1), ("CA", "California", 2), ("MN", None, 1)]
    every = analytics.all_regions(lookup, counts.select("abbr", "play_count"), "abbr")
    assert rows(every, "abbr", "play_count") == [("CA", 2), ("TX", None)]


def test_percent_rank(spark):
    pick = random.Random(4)
    values = [pick.choice([None, *range(20)]) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    order = sorted(values, key=lambda v: (v is None, v or 0))
    expected = sorted(
        ((v, order.index(v) / 199) for v in values), key=lambda r: [(x is not None, x) for x in r]
    )
    assert rows(analytics.percent_rank_by(df, "v", "p")) == expected
    assert analytics.percent_rank_by(df.limit(1), "v", "p").first()["p"] == 0.0


def test_top_users(spark):
    plays = spark.createDataFrame([(u, i) for u in range(1, 9) for i in range(u)], "user_id bigint, songplay_id bigint")
    users = spark.createDataFrame([(u, "free") for u in range(1, 9)] + [(8, "paid")], "user_id bigint, level string")
    found = [tuple(r) for r in analytics.top_users(plays, users).collect()]
    # user 8 is listed twice, so its plays count twice, as in a plain join
    assert found == [(8, "paid", 16, 1.0), (7, "free", 7, 6 / 7)]


def test_agents(spark):
    agents = [
        '"Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0 Safari/537.36"',
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10.9; rv:31.0) Gecko/20100101 Firefox/31.0",
        "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
        "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2) AppleWebKit/537.51.2 Version/7.0 Mobile/11D257 Safari/9537.53",
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.78.2 Version/7.0.6 Safari/537.78.2",
        "curl",
    ]
    plays = spark.createDataFrame(list(enumerate(agents)), "songplay_id bigint, user_agent string")
    assert rows(analytics.agent_matrix(plays)) == [
        (None, None, 1), ("Mac", "Firefox", 1), ("Mac", "Safari", 1), ("Windows", "Chrome", 1),
        ("Windows", "IE", 1), ("iPhone", "Mobile", 1),
    ]


def test_box_summary(spark):
    pick = random.Random(8)
    data = [(pick.choice(["a", "b", None]), int(pick.expovariate(0.1)), pick.randrange(9)) for _ in range(400)] + [("c", 7, 7)]
    df = spark.createDataFrame(data, "c string, x bigint, y bigint")
    found = {(r["c"], r["measure"]): r for r in analytics.box_summary(df, "c", ["x", "y"]).collect()}
    assert len(found) == 8
    for (c, measure), r in found.items():
        values = np.array([row["xy".index(measure) + 1] for row in data if row[0] == c], float)
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        expected = (len(values), q1, q2, q3, inside.min(), inside.max())
        assert tuple(r)[2:] == pytest.approx(expected)


def brute_between(events):
    counts = {}
    for user, page, ts in events:
        if page == "play":
            period = sum(1 for u, p, t in events if u == user and p == "home" and t >= ts)
            counts[user, period] = counts.get((user, period), 0) + 1
    return sum(counts.values()) / len(counts)


def test_count_between(spark):
    pick = random.Random(6)
    events = [(0 if pick.random() < 0.5 else pick.randrange(5), pick.choice(["play", "play", "home", "help"]), pick.randrange(80)) for _ in range(400)]
    df = spark.createDataFrame(events, "user bigint, page string, ts bigint")
    found = analytics.count_between(df, "user", "ts", F.col("page") == "play", F.col("page") == "home").first()
    assert found["average"] == pytest.approx(brute_between(events))
    assert found["average_rounded"] == int(found["average"] + 0.5)


def test_log_questions(spark):
    data = [("", "Home", "A", None), ("", "Login", None, None), ("1", "NextSong", "A", "F"), ("1", "NextSong", "B", "F"),
            ("2", "NextSong", "B", "F"), ("3", "About", None, "M")]
    df = spark.createDataFrame(data, "userId string, page string, artist string, gender string")
    assert rows(analytics.never_visited(df, "page", F.col("userID") == "")) == [("About",), ("NextSong",)]
    assert analytics.distinct_members(df, F.col("gender") == "F", ["userId", "gender"]).first()[0] == 2
    played = df.filter(F.col("page") == "NextSong")
    assert rows(analytics.most_frequent(played, "artist")) == [("B", 2)]
