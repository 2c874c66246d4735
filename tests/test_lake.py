import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from tidemark import schemas
from tidemark.operators import dedup, serving
from tidemark.plans import star_load, warehouse
from tidemark.sinks import tables
from tidemark.streaming.incremental import Choice, Snapshot, Store, append_to, ingest_new, upsert_into


def test_logs_to_lake_to_panels(spark, tmp_path):
    logs, songs = tmp_path / "logs", tmp_path / "songs" / "A"
    logs.mkdir()
    songs.mkdir(parents=True)
    base = dict(auth="In", firstName="K", lastName="S", gender="F", itemInSession=1, level="free", method="PUT",
                location="Oxbow-Teller, ND", registration=1.0, status=200, userAgent="Chrome on Windows")
    played = dict(base, page="NextSong", artist="The Quays", song="Slow Harbour", length=187.25, sessionId=139, userId="8")
    events = [dict(played, ts=1533000444555 + 1000 * i) for i in range(5)]
    events += [dict(played, ts=1543700000000, song="Other", level="paid", sessionId=140, userId="9"), dict(base, page="Home", ts=1, userId="")]
    (logs / "e.json").write_text("\n".join(json.dumps(e) for e in events))
    for i, year in enumerate([1987, 0]):
        song = dict(song_id=f"S{i}", artist_id="A1", title=["Slow Harbour", "Silent"][i], year=year, duration=187.25,
                    artist_name="The Quays", artist_location="London", artist_latitude=None, artist_longitude=None, num_songs=1)
        (songs / f"{i}.json").write_text(json.dumps(song, indent=2))
    paths = {n: f"$['{n}']" for n in schemas.STAGING_EVENTS.names}
    staged, bad = warehouse.stage_events(spark, str(logs), paths)
    assert (staged.count(), bad.count()) == (7, 0)
    catalogue, _ = warehouse.stage_songs(spark, str(tmp_path / "songs"))
    warehouse.write_lake(warehouse.build_star(staged, catalogue), str(tmp_path / "lake"), artist_directories=True)
    assert (tmp_path / "lake" / "songs" / "year=1987" / "artist_id=A1").is_dir()
    assert (tmp_path / "lake" / "songplay" / "year=2018" / "month=12").is_dir()

    star = warehouse.read_lake(spark, str(tmp_path / "lake"))
    assert {n: t.count() for n, t in star.items()} == {"songplay": 6, "users": 2, "songs": 2, "artists": 1, "time": 6}
    checks = warehouse.check_star(star)
    assert rows(checks.pop("keys")) == [("artists", 0, 1), ("songplay", 0, 6), ("songs", 0, 2), ("time", 0, 6), ("users", 0, 2)]
    assert all(report.isEmpty() for report in checks.values())

    states = spark.createDataFrame([(4, "ND", "North Dakota")], schemas.STATE_LOOKUP)
    panels = warehouse.panels(star, states)
    assert rows(panels["play_location"]) == [("ND", 4, "North Dakota", 6)]
    assert rows(panels["user_agent"]) == [("Windows", "Chrome", 6)]
    assert rows(panels["play_level"]) == [("free", 5 / 6), ("paid", 1 / 6)]
    assert panels["user_stats"].first()["users"] == 2
    assert rows(panels["user_prctile"], "user_id", "playcount") == [(8, 5)]
    assert all(p.count() > 0 for p in panels.values())


def test_partitioned_files_stay_few_and_whole(spark, tmp_path):
    # one directory holds most rows
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 5).alias("k"), "id").repartition(8)
    tables.write_partitioned(df, str(tmp_path / "t"), ["k"], ["id"], number="n")
    files = list((tmp_path / "t").glob("k=*/*.parquet"))
    assert len(files) <= 5 + 4
    assert len([f for f in files if f.parent.name == "k=0"]) > 1
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 4000 and stored.select("n").distinct().count() == 4000
    buckets = df.select(tables.bucket_of(F.col("id"), 7).alias("b")).distinct()
    assert rows(buckets) == [(i,) for i in range(7)]


def test_keyed_table_pushes_the_key_down(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 50).alias("session"), "id")
    tables.write_keyed(df, str(tmp_path / "t"), ["session"], ["id"])
    found = serving.partition_lookup(spark.read.parquet(str(tmp_path / "t")), {"session": 7}, ["id"])
    assert "EqualTo(session,7)" in found._jdf.queryExecution().executedPlan().toString()
    assert [r["id"] for r in found.collect()] == list(range(7, 1000, 50))


SCHEMA = T.StructType([
    T.StructField("u", T.LongType()), T.StructField("ts", T.LongType()), T.StructField("name", T.StringType()), T.StructField("level", T.StringType()),
])


def arrive(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(dict(zip(SCHEMA.names, r))) for r in records))


def test_files_are_ingested_once(spark, tmp_path):
    logs, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        ingest_new(spark, str(logs), SCHEMA, state, append_to(out)).awaitTermination()

    arrive(logs, "a", (1, 1, "n", "free"))
    run()
    run()
    arrive(logs, "b", (2, 2, "n", "paid"))
    run()
    assert rows(spark.read.parquet(out), "u") == [(1,), (2,)]


def test_snapshot_upsert(spark, tmp_path):
    snapshot = Snapshot(spark, str(tmp_path / "snapshot"), "u")
    assert snapshot.read() is None and snapshot.count("snapshot") == 0
    handler = upsert_into(snapshot, ["ts"], ["name"], ["level"])
    logs = tmp_path / "in"
    arrive(logs, "a", (1, 1, "Ann", "free"), (1, 2, "Anna", "paid"))
    ingest_new(spark, str(logs), SCHEMA, str(tmp_path / "state"), handler).awaitTermination()
    arrive(logs, "b", (1, 3, "X", "free"), (2, 3, "Bob", "paid"))
    ingest_new(spark, str(logs), SCHEMA, str(tmp_path / "state"), handler).awaitTermination()
    assert rows(snapshot.read()) == [(1, "Ann", "free"), (2, "Bob", "paid")]
    # a repeated batch changes nothing, one without its commit does not count, and none comes after a later one
    handler(spark.createDataFrame([(1, 4, "X", "other")], SCHEMA), 1)
    assert rows(snapshot.read()) == [(1, "Ann", "free"), (2, "Bob", "paid")]
    (tmp_path / "snapshot" / "data" / "snapshot" / "version=9" / "bucket=0-0").mkdir(parents=True)
    assert rows(snapshot.read()) == [(1, "Ann", "free"), (2, "Bob", "paid")]
    snapshot.merge(spark.createDataFrame([], SCHEMA), 5, lambda old, new: old)
    with pytest.raises(ValueError):
        handler(spark.createDataFrame([], SCHEMA), 4)


def test_snapshot_splits_and_expires(spark, tmp_path):
    snapshot = Snapshot(spark, str(tmp_path / "snapshot"), "u", rows=40)
    handler = upsert_into(snapshot, ["ts"], ["name"], ["level"])
    data = tmp_path / "snapshot" / "data" / "snapshot"

    def sizes():
        return {(e["depth"], e["bits"]): e["rows"] for e in snapshot._entries(snapshot.versions()[-1])}

    handler(spark.createDataFrame([(i, 1, f"n{i}", "free") for i in range(30)], SCHEMA), 0)
    assert sizes() == {(0, 0): 30}
    handler(spark.createDataFrame([(i, 1, f"n{i}", "free") for i in range(20, 300)], SCHEMA), 1)
    assert sum(sizes().values()) == 300 and max(sizes().values()) <= 40 and {d for d, _ in sizes()} == {4}
    # every bucket is written by one task, in one file
    assert all(len(list(b.glob("*.parquet"))) == 1 for b in (data / "version=1").glob("bucket=*"))
    handler(spark.createDataFrame([(7, 2, "x", "paid"), (None, 2, "lost", "paid")], SCHEMA), 2)
    assert len(list((data / "version=2").glob("bucket=*"))) == 1
    found = rows(snapshot.read())
    assert len(found) == 300 and (7, "n7", "paid") in found and (8, "n8", "free") in found
    # opened with another size, the same table goes on; one bucket grows and splits by itself
    again = Snapshot(spark, str(tmp_path / "snapshot"), "u", rows=10)
    again.merge(spark.createDataFrame([(8, 3, "y", "paid")], SCHEMA), 3, lambda old, new: dedup.upsert(old, new, "u", ["ts"], ["name"], ["level"]))
    assert len({d for d, _ in sizes()}) == 2 and rows(again.read()) == sorted([r for r in found if r[0] != 8] + [(8, "n8", "paid")])
    gone = again.expire()
    assert any("version=0" in p for p in gone) and not (data / "version=0" / "bucket=0-0").exists()
    assert again.versions() == [3] and len(rows(again.read())) == 300
    assert again.expire() == []


def scanned(df):
    """Rows that a query's scan hands on, and its answer."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan
    while scan.children().size():
        scan = scan.children().head()
    return scan.metrics().apply("numOutputRows").value(), found


def test_look_ups_by_another_column_pass_over_row_groups(spark, tmp_path):
    df = spark.range(60_000).select("id", F.sha2((F.col("id") * 7919 % 30_000).cast("string"), 256).alias("song"))
    wanted = df.filter("id = 777").first()["song"]
    read = {}
    for name, look_ups in (("plain", None), ("bloom", {"song": 1_000})):
        path = str(tmp_path / name)
        tables.write_keyed(df, path, ["id"], [], look_ups, 1 << 16)
        read[name], found = scanned(serving.point_lookup(spark.read.parquet(path), song=wanted))
        assert len(found) == 2
    assert read["bloom"] < read["plain"] / 10


def test_rows_without_a_key_stay_out(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(None, "x"), (None, "y"), (2, "b"), (1, "c")], "k int, v string")
    assert rows(dedup.insert_ignore(old, new, ["k"], ["v"])) == [(1, "a"), (2, "b")]
    assert rows(dedup.upsert(old, new, "k", ["v"], [], ["v"])) == [(1, "c"), (2, "b")]
    assert rows(dedup.without_key(new, ["k"]), "v") == [("x",), ("y",)]


def test_day_counts(spark):
    from tidemark.functions.time import calendar_days, day_text, elapsed_days

    df = spark.createDataFrame([(datetime(2018, 11, 2, 20), datetime(2018, 11, 20, 10))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(calendar_days(F.col("a"), F.col("b")), elapsed_days(F.col("a"), F.col("b")), day_text(F.col("a"))).first() == (18, 17, "2018-11-02")


EVENTS = ("userId long, firstName string, lastName string, gender string, level string, ts long, artist string, song string, "
          "length double, page string, sessionId long, location string, userAgent string")
SONGS = ("song_id string, artist_id string, artist_name string, artist_location string, artist_latitude double, "
         "artist_longitude double, title string, year short, duration double")


def batches(spark):
    def event(user, level, ts, song, page="NextSong"):
        return (user, f"f{user}", "l", "F", level, ts, f"A{song}", f"S{song}", 1.5, page, 9, "Town, ST", "agent")

    def song(number, year):
        return (f"s{number}", "X", f"A{number}", None, None, None, f"S{number}", year, 1.5)

    one = [event(1, "free", 1_000, 1), event(2, "paid", 2_000, 2), event(1, "paid", 3_000, 7)]
    two = [event(1, "free", 2_500, 1), event(2, "free", 9_000, 1), event(3, "free", 9_500, 3, "Home"), event(None, "free", 9_600, 2)]
    return [
        (spark.createDataFrame(one, EVENTS), spark.createDataFrame([song(1, 2000), song(2, 2000), song(2, 1999)], SONGS)),
        (spark.createDataFrame(two, EVENTS), spark.createDataFrame([song(3, 2000)], SONGS)),
    ]


def star_of(tables):
    return {name: rows(df.drop("songplay_id")) for name, df in tables.items()}


def test_batches_equal_a_full_build(spark, tmp_path):
    store = star_load.star_store(spark, str(tmp_path / "store"), rows=2)
    loads = batches(spark)
    for number, (events, songs) in enumerate(loads):
        assert star_load.load_batch(store, number, events, songs)
    events, songs = (a.unionByName(b) for a, b in zip(*loads))
    full = warehouse.build_star(events, songs)
    assert star_of(star_load.read_star(store)) == star_of({n: df for n, df in full.items()})
    ids = [r[0] for r in star_load.read_star(store)["songplay"].orderBy("songplay_id").select("songplay_id").collect()]
    assert ids == list(range(len(ids))) and len(ids) == full["songplay"].count()
    # the first commit is still there as it was, until it expires
    assert star_load.read_star(store, 0)["users"].count() == 2
    assert not star_load.load_batch(store, 1, *loads[1])
    store.expire()
    assert store.versions() == [1] and star_of(star_load.read_star(store)) == star_of(full)


def test_a_store_of_one_table_makes_no_other(spark, tmp_path):
    loads = batches(spark)
    plays = []
    for name, tables in (("all", None), ("one", ("songplay",))):
        store = star_load.star_store(spark, str(tmp_path / name), tables=tables)
        for number, (events, songs) in enumerate(loads):
            assert star_load.load_batch(store, number, events, songs)
        plays.append(rows(star_load.read_star(store)["songplay"]))
    assert plays[0] == plays[1] and set(star_load.read_star(store)) == {"songplay"}
    assert sorted(p.name for p in (tmp_path / "one" / "data").iterdir()) == ["catalog", "songplay"]


def test_a_choice_deals_rows_out_once(spark, tmp_path):
    chosen = []

    def greatest(df, keys):
        chosen.append(df)
        return dedup.max_per_key(df, keys, ["v"])

    store = Store(spark, str(tmp_path / "store"), {"t": "k"}, rows=20)
    frames = [[(i, 1) for i in range(100)], [(i, 2) for i in range(50, 150)], [(7, v) for v in range(500)]]
    for number, frame in enumerate(frames):
        made = len(chosen)
        assert store.commit(number, {"t": (spark.createDataFrame(frame, "k long, v long"), Choice(greatest))})
        # only rows that repeat a key far beyond a bucket's rows are reduced before
        assert len(chosen) - made == (2 if number == 2 else 1)
    # chosen where they were dealt out, without another shuffle
    plan = dedup.max_per_key(chosen[0], ["bucket", "k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    found = {**{i: 1 for i in range(50)}, **{i: 2 for i in range(50, 150)}, 7: 499}
    assert rows(store.read("t"), "k", "v") == sorted(found.items()) and store.count("t") == 150
    with pytest.raises(ValueError):
        store.stage("t", 1, chosen[0])


def test_a_batch_that_dies_between_tables_changes_nothing(spark, tmp_path, monkeypatch):
    store = star_load.star_store(spark, str(tmp_path / "store"))
    loads = batches(spark)
    star_load.load_batch(store, 0, *loads[0])
    before = star_of(star_load.read_star(store))
    merge = Store._merge

    def dies(self, table, *rest):
        if table == "users":
            raise RuntimeError("lost")
        return merge(self, table, *rest)

    monkeypatch.setattr(Store, "_merge", dies)
    with pytest.raises(RuntimeError):
        star_load.load_batch(store, 1, *loads[1])
    assert store.versions() == [0] and star_of(star_load.read_star(store)) == before
    assert store.expire() == []
    monkeypatch.undo()
    assert star_load.load_batch(store, 1, *loads[1])
    full = warehouse.build_star(*(a.unionByName(b) for a, b in zip(*loads)))
    assert star_of(star_load.read_star(store)) == star_of(full)
    assert sorted(r[0] for r in star_load.read_star(store)["songplay"].select("songplay_id").collect()) == list(range(full["songplay"].count()))
