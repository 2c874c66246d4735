import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import ordered, spans

PLAYS = "songplay_id bigint, user_id bigint, session_id bigint, level string, start_time timestamp_ntz"

# one user's sessions; times of day chosen so that session 764 precedes 818
SESSIONS = [
    (172, "paid", "2018-11-02 20:00", 74), (199, "paid", "2018-11-03 10:00", 27),
    (221, "paid", "2018-11-07 10:00", 101), (362, "paid", "2018-11-09 10:00", 9),
    (417, "paid", "2018-11-13 10:00", 2), (557, "paid", "2018-11-14 10:00", 18),
    (582, "paid", "2018-11-15 10:00", 5), (612, "paid", "2018-11-19 10:00", 10),
    (716, "paid", "2018-11-20 10:00", 59), (818, "paid", "2018-11-21 20:00", 70),
    (764, "free", "2018-11-21 08:00", 66), (834, "paid", "2018-11-26 10:00", 22),
]


@pytest.fixture(autouse=True)
def groups_of_any_size_are_cut(monkeypatch):
    monkeypatch.setattr(ordered, "TASK_ROWS", 1)


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M")


def golden_plays(spark):
    ids = iter(range(10_000))
    data = [(next(ids), 15, s, level, at(start) + timedelta(seconds=i)) for s, level, start, n in SESSIONS for i in range(n)]
    return spark.createDataFrame(data, PLAYS)


def test_published_sample(spark):
    found = spans.level_spans(golden_plays(spark))
    assert rows(found.drop("user_id")) == [
        (1, "paid", "free", None, 2, 92, 5, 4),
        (2, "free", "paid", "paid", 1, 66, 0, 0),
        (3, "paid", None, "free", 9, 305, 18, 17),
    ]


def random_plays(spark, seed, users=6, sessions=200):
    pick = random.Random(seed)
    data, number = [], 0
    for session in range(sessions):
        user = 0 if pick.random() < 0.4 else pick.randrange(users)
        # few distinct days, so that starts tie
        start = datetime(2020, 1, 1) + timedelta(days=pick.randrange(40))
        for _ in range(pick.randrange(1, 4)):
            level = pick.choice(["free", "paid", "paid", None])
            data.append((number, user, session, level, start))
            number += 1
    return spark.createDataFrame(data, PLAYS), data


def brute_spans(data):
    sessions = {}
    for _, user, session, level, start in data:
        levels, starts, n = sessions.setdefault((user, session), ([], [], 0))
        sessions[user, session] = (levels + [level], starts + [start], n + 1)
    per_user = {}
    for (user, session), (levels, starts, n) in sessions.items():
        known = [v for v in levels if v is not None]
        per_user.setdefault(user, []).append((min(starts), session, min(known) if known else None, n))
    result = []
    for user, seq in per_user.items():
        seq.sort(key=lambda s: s[:2])
        groups = []
        for i, s in enumerate(seq):
            before = seq[i - 1][2] if i else None
            if not groups or (None not in (before, s[2]) and before != s[2]):
                groups.append([])
            groups[-1].append((i, before, seq[i + 1][2] if i + 1 < len(seq) else None, *s))
        for g, members in enumerate(groups):
            first, last = members[0], members[-1]
            days = (last[3] - first[3]).days
            result.append((user, len(groups) - g, first[5], first[1], last[2], len(members), sum(m[6] for m in members), days, days))
    return sorted(result, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_match_brute_force(spark, seed):
    plays, data = random_plays(spark, seed)
    assert rows(spans.level_spans(plays.repartition(3))) == brute_spans(data)


def test_sequence_of_large_users_equals_plain_windows(spark):
    plays, _ = random_plays(spark, 5)
    plain = spans.session_sequence(plays)
    split = spans.session_sequence(plays)
    assert rows(split) == rows(plain)


def test_categories_and_stats(spark):
    data = [
        # user 1: one free session; 2: free then paid; 3: paid, free, paid; 4: two free sessions
        (0, 1, 1, "free", datetime(2020, 1, 1)),
        (1, 2, 2, "free", datetime(2020, 1, 1)), (2, 2, 3, "paid", datetime(2020, 1, 2)),
        (3, 3, 4, "paid", datetime(2020, 1, 1)), (4, 3, 5, "free", datetime(2020, 1, 2)), (5, 3, 6, "paid", datetime(2020, 1, 3)),
        (6, 4, 7, "free", datetime(2020, 1, 1)), (7, 4, 8, "free", datetime(2020, 1, 2)),
    ]
    found = spans.level_categories(spans.level_spans(spark.createDataFrame(data, PLAYS)))
    assert rows(found, "user_id", "user_level_index", "level_category") == [
        (1, 1, "Free Only"), (2, 1, "Paid Only"), (2, 2, "Free then Paid"),
        (3, 1, "Paid Only"), (3, 2, "Free then Paid"), (3, 3, "Paid then Free"), (4, 1, "Free Only"),
    ]
    stats = spans.engagement_stats(found).first().asDict()
    assert stats == {"users": 4, "return_rate": 75.0, "bounce_rate": 25.0, "upgrade_rate": 50.0, "downgrades": 1}


def test_sessions_take_the_lowest_level(spark):
    data = [(0, 1, 1, "paid", datetime(2020, 1, 2)), (1, 1, 1, "free", datetime(2020, 1, 1))]
    summary = spans.session_summary(spark.createDataFrame(data, PLAYS))
    assert rows(summary.drop("start_time")) == [(1, 1, "free", 2)]
    prepared = spark.createDataFrame(data, PLAYS).withColumn("n", F.lit(5))
    assert spans.session_summary(prepared, F.col("n")).first()["play_count"] == 10


def test_plays_are_read_once(spark, tmp_path):
    golden_plays(spark).write.parquet(str(tmp_path / "plays"))
    plan = spans.level_spans(spark.read.parquet(str(tmp_path / "plays")))._jdf.queryExecution().executedPlan().toString()
    # the sessions are stored while the plan is made; nothing reads the plays again
    assert str(tmp_path / "plays") not in plan
