import json
import time
from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import random

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from tidemark import schemas
from tidemark.functions.text import cut_to_length
from tidemark.plans.queries import QUERIES
from tidemark.sinks import reports, tables
from tidemark.streaming.incremental import newer_than
from tidemark.sources import csv_files, json_files, staging

AGENT = '"Mozilla/5.0 {Macintosh; \\ Intel}" }\n{'


def record(**given):
    base = {
        "artist": None, "auth": "Logged In", "firstName": "Odile", "gender": "F", "itemInSession": 0,
        "lastName": "Marsh", "length": None, "level": "free", "location": "Oxbow-Teller, ND",
        "method": "GET", "page": "Home", "registration": 1525000111222.0, "sessionId": 4711, "song": None,
        "status": 200, "ts": 1526000222333, "userAgent": AGENT, "userId": "57",
    }
    return {**base, **given}


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs" / "2018" / "11"
    folder.mkdir(parents=True)
    lines = [json.dumps(record(), indent=4)] + [json.dumps(record(ts=1526000222334 + i, userId=u)) for i, u in enumerate(["8", "", "x"])]
    (folder / "a-events.json").write_text("\n".join(lines) + "\n")
    (folder / "b-events.json").write_text(json.dumps(record(status="bad", ts=5)) + "\r\n \n  " + json.dumps(record(level="premium", ts=6)))
    (folder / "c-events.json").write_text('{"ts": 7, "nested": {"deep": {"k": 1}}}\n{"ts": 8, "nested": {"deep": {"k": 2}}}\n{"ts": 9,')
    (folder / "empty.json").write_text("")
    (folder / "notes.txt").write_text("not a log")
    return str(tmp_path / "logs")


def test_records_of_any_layout(spark, logs):
    found = json_files.read_json_records(spark, logs)
    texts = [r["value"] for r in found.collect()]
    assert len(texts) == 9
    parsed = [json.loads(t) for t in texts if t != '{"ts": 9,']
    assert sorted(p["ts"] for p in parsed) == [5, 6, 7, 8, 1526000222333, 1526000222334, 1526000222335, 1526000222336]
    assert all(p["userAgent"] == AGENT for p in parsed if "userAgent" in p)
    assert found.select(json_files.SOURCE).distinct().count() == 3


@pytest.mark.parametrize("size", ["64", "1000", "128MB"])
def test_records_survive_file_splits(spark, logs, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        assert json_files.read_json_records(spark, logs).count() == 9
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_ends_and_fragments(spark, tmp_path):
    (tmp_path / "w.json").write_bytes(b'\r\n{"a": {"b": 1}}\r\n{"a": 2}\r\n')
    # objects at line starts within a record, something after a record, and a cut-off number
    (tmp_path / "x.json").write_text('{"a": 3}\n{"a": [\n{"a": 4},\n{"a": 5}\n]}\n{"a": 6} x\n{"a": 154')
    found = json_files.map_paths(json_files.read_json_records(spark, str(tmp_path)), {"a": "$['a']"})
    assert rows(found.filter("_corrupt is null"), "a") == [("2",), ("3",), ('[{"a":4},{"a":5}]',), ('{"b":1}',)]
    assert rows(found.filter("_corrupt is not null"), "a") == [(None,)] * 2


def test_several_records_on_a_line(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}{"a": "}{"}\n{"a": 3} {"a": {"b": [{}, {}]}}\t{"a": 5}\n')
    found = json_files.map_paths(json_files.read_json_records(spark, str(tmp_path)), {"a": "$['a']"})
    assert found.filter("_corrupt is not null").count() == 0
    assert rows(found, "a") == [("1",), ("3",), ("5",), ('{"b":[{},{}]}',), ("}{",)]


def told(spark, folder):
    """Values of "a" of accepted records, and how many rejects there are."""
    found = json_files.map_paths(json_files.read_json_records(spark, str(folder)), {"a": "$['a']"})
    good = [r["a"] for r in found.filter("_corrupt is null").collect()]
    return sorted(good, key=lambda v: (v is None, len(v or ""), v or "")), found.filter("_corrupt is not null").count()


def nested(name):
    return f'{{"a": "{name}", "list": [\n{{"x": 1}},\n{{"y": 0}}\n]}}'


TORN = [
    '{"a": 99, "list": [', '{"a": 99, "list": [\n{"x": 1},\n{"y"', '{"a": 9', '{"a":', '{"a": 99,', '{"a": "unend', '{', '{"a": {"b": [',
    '{"a": 99, "list": [\n{"x": 1},\n{"y": 2}\n]',
]


def test_records_around_a_torn_one(spark, tmp_path):
    """In each file one record is torn, and one reject; all others are accepted."""
    for k, torn in enumerate(TORN):
        records = [nested(f"{k}-{i}") for i in range(30)]
        (tmp_path / f"{k}.json").write_text("\n".join([*records[:15], torn, *records[15:]]))
    good, bad = told(spark, tmp_path)
    assert sorted(good) == sorted(f"{k}-{i}" for k in range(len(TORN)) for i in range(30)) and bad == len(TORN)


def test_stray_braces_and_other_text(spark, tmp_path):
    good = "\n".join(f'{{"a": {i}}}' for i in range(2, 8))
    (tmp_path / "x.json").write_text('{"a": 2\n' + good + '\n{"a": 9}}\n' + nested(8) + '\n{"a": 1}}\n' + nested(9))
    (tmp_path / "y.json").write_text('"x": 3}\n{"a": 11}\nnoise\n{"a": 12}\n\n}\n{\n"a": 13,\n"b": [\n{\n}\n]\n}\n]\n{"a": 14}')
    (tmp_path / "z.json").write_text('\n{"a": 21}\n{"a": "tab\\t{"}\n{"a": "\\"}{"}\n')
    wanted = [str(i) for i in (*range(2, 10), *range(11, 15), 21)] + ['"}{', "tab\t{"]
    good, bad = told(spark, tmp_path)
    assert sorted(good) == sorted(wanted) and bad == 7


def test_a_list_of_records_is_no_record(spark, tmp_path):
    (tmp_path / "x.json").write_text("[\n" + ",\n".join(f'{{\n"a": {i}\n}}' for i in range(50)) + "\n]\n" + '{"a": 77}')
    good, bad = told(spark, tmp_path)
    assert good == ["49", "77"] and bad == 51


def test_torn_files_over_many_pieces(spark, tmp_path):
    """Every place of a tear, in files cut into small pieces; all untouched records are accepted."""
    rnd = random.Random(5)
    lost, wanted = 0, []
    for k in range(12):
        records = []
        for i in range(25):
            name = f"{k}-{i}"
            inner = ",\n".join(f'{{"x": "}}{{{j}"}}' for j in range(rnd.randrange(4)))
            text = f'{{"a": "{name}",\n"list": [\n{inner}\n]\n}}'
            if rnd.random() < 0.2:
                text = text[: rnd.randrange(1, len(text) - 1)].rstrip()
                lost += 1
            else:
                wanted.append(name)
            records.append(text)
        (tmp_path / f"{k}.json").write_text("\n".join(records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        good, bad = told(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # a tear may leave whole objects of the list behind, which have no "a"
    assert sorted(v for v in good if v is not None) == sorted(wanted) and bad >= lost - good.count(None)


def test_paths(spark):
    df = spark.createDataFrame([('{"a": "x", "b": {"c": [1, 2]}}', 1), ("oops", 2)], "value string, n int")
    found = json_files.map_paths(df, {"first": "$['a']", "again": "$.a", "deep": "$.b.c[1]"})
    assert rows(found, "n", "first", "again", "deep", "_corrupt") == [(1, "x", "x", "2", None), (2, None, None, None, "not an object: oops")]


def test_staging_types_and_rejects(spark, logs):
    raw = json_files.by_name(json_files.read_json_records(spark, logs), schemas.STAGING_EVENTS)
    good, bad = staging.load_staging(raw, schemas.STAGING_EVENTS, long_text="reject")
    # an empty number is unknown, not wrong; the decimal registration is a whole number
    assert rows(good, "ts", "userId", "registration") == [
        (7, None, None), (8, None, None),
        (1526000222333, 57, 1525000111222), (1526000222334, 8, 1525000111222), (1526000222335, None, 1525000111222),
    ]
    assert rows(bad, "colname", "err_reason") == [
        ("", staging.BAD_RECORD), ("level", staging.TOO_LONG), ("status", staging.BAD_VALUE), ("userId", staging.BAD_VALUE),
    ]
    assert all(r["filename"].endswith("events.json") for r in bad.collect())
    assert good.schema["level"].metadata == {"max_len": 4}
    cut, bad = staging.load_staging(raw, schemas.STAGING_EVENTS)
    assert bad.count() == 3 and cut.filter("level = 'prem'").count() == 1


def test_budget(spark, logs):
    raw = json_files.by_name(json_files.read_json_records(spark, logs), schemas.STAGING_EVENTS)
    with pytest.raises(staging.TooManyErrors) as caught:
        staging.load_staging(raw, schemas.STAGING_EVENTS, budget=3)
    assert caught.value.rejects.count() == 3
    staging.load_staging(raw, schemas.STAGING_EVENTS, budget=4)


def test_loads_are_recorded(spark, logs, tmp_path):
    raw = json_files.by_name(json_files.read_json_records(spark, logs), schemas.STAGING_EVENTS)
    history = str(tmp_path / "history")
    staging.load_staging(raw, schemas.STAGING_EVENTS, budget=4, history=history, load="one")
    with pytest.raises(staging.TooManyErrors):
        staging.load_staging(raw, schemas.STAGING_EVENTS, budget=3, history=history, load="two")
    staging.load_staging(raw.drop("_source").limit(0), schemas.STAGING_EVENTS, history=history, load="three")
    found = spark.read.schema(staging.HISTORY).parquet(history)
    assert rows(found, "load", "rejected", "errors", "files", "refused") == [
        ("one", 3, 3, 3, False), ("three", 0, 0, None, False), ("two", 3, 3, 3, True),
    ]


def test_long_location_is_cut_or_rejected(spark):
    raw = spark.createDataFrame([("S", "x" * 276)], "song_id string, artist_location string")
    contract = T.StructType([f for f in schemas.STAGING_SONGS if f.name in raw.columns])
    good, bad = staging.load_staging(raw, contract)
    assert len(good.first()["artist_location"]) == 256 and bad.count() == 0
    good, bad = staging.load_staging(raw, contract, long_text="reject")
    assert good.count() == 0 and rows(bad, "colname", "err_reason") == [("artist_location", staging.TOO_LONG)]


@pytest.mark.parametrize("text", ["plain", "éééé", "a€€€", "😀😀", "", "aé€😀z"])
def test_cut_to_bytes(spark, text):
    for limit in range(0, 9):
        found = spark.createDataFrame([(text,)], "v string").select(cut_to_length(F.col("v"), limit, "bytes")).first()[0]
        assert found == text.encode()[:limit].decode(errors="ignore")


def test_whole_numbers(spark):
    texts = ["38", "38.0", "38.0000001", "38.00000000000000000001", " 7 ", "", "x", "1.5", "1.525000111222E12", "9223372036854775808", "-9223372036854775808", "40000", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    longs = [r[0] for r in df.select(csv_files.typed(F.col("v"), T.LongType())).collect()]
    assert longs == [38, 38, None, None, 7, None, None, None, 1525000111222, None, -(2**63), 40000, None]
    shorts = [r[0] for r in df.select(csv_files.typed(F.col("v"), T.ShortType())).collect()]
    assert shorts == [38, 38, None, None, 7, None, None, None, None, None, None, None, None]


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"a,{k}\n" + "0,1\n" * 500)
    found = csv_files.headers(spark, str(tmp_path))
    assert sorted(r["header"] for r in found.collect()) == ["a,0", "a,1", "a,2"]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan


def test_csv_columns_and_clean_copy(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    header = "artist,auth,itemInSession,length,sessionId,userId\n"
    (folder / "1.csv").write_text(header + 'Northlight,In,4,211.5042,338,50.0\n,In,0,,338,\n')
    (folder / "2.csv").write_text(header + '"Weird ""Al"", X",In,0,333.7,182,10\n')
    wanted = ["artist", "itemInSession", "length", "sessionId", "userId"]
    found = csv_files.read_csv_columns(spark, str(folder / "*.csv"), schemas.EVENT_CSV, wanted)
    played = found.dropna(subset=["artist"])
    assert rows(played) == [("Northlight", 4, 211.5042, 338, 50), ('Weird "Al", X', 0, 333.7, 182, 10)]
    plan = found.select("sessionId")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<sessionId:string>" in plan
    tables.write_csv(played, str(tmp_path / "clean"))
    assert rows(csv_files.read_csv_columns(spark, str(tmp_path / "clean"), schemas.EVENT_CSV, wanted)) == rows(played)


def test_lookup_and_plain_json(spark, tmp_path):
    (tmp_path / "state.csv").write_text("id,abbr,state\n1,AL,Alabama\n2,AK,Alaska\n")
    assert rows(csv_files.read_lookup(spark, str(tmp_path / "state.csv"), schemas.STATE_LOOKUP)) == [(1, "AL", "Alabama"), (2, "AK", "Alaska")]
    (tmp_path / "song").mkdir()
    song = {"song_id": "S", "num_songs": 1, "year": 2007, "duration": 307.5, "artist_id": "A"}
    (tmp_path / "song" / "s.json").write_text(json.dumps(song))
    named = json_files.read_json_lines(spark, str(tmp_path / "song"), schemas.STAGING_SONGS)
    assert rows(named, "song_id", "year", "duration", "title") == [("S", 2007, 307.5, None)]
    assert "num_songs" not in named.columns and "num_songs" in json_files.read_json_inferred(spark, str(tmp_path / "song")).columns


def test_first_record_of_each_file(spark):
    df = spark.createDataFrame([("f", 2, "b"), ("f", 1, "a"), ("g", 1, "c")], "_source string, _place int, value string")
    assert rows(staging.first_record_per_file(df), "value") == [("a",), ("c",)]


def test_first_order_of_every_status(spark, tmp_path, monkeypatch):
    kinds = ["O", "F", None, "", "X/y", "P"]
    keys = list(range(600, 0, -1))
    table = [(key, kinds[(i // 7 + i) % 6]) for i, key in enumerate(keys)]
    (tmp_path / "orders.parquet").mkdir()
    for n in range(3):
        part = table[n * 200 : n * 200 + 200]
        pq.write_table(
            pa.table({"o_orderkey": pa.array([k for k, _ in part], pa.int64()), "o_orderstatus": pa.array([v for _, v in part], pa.string())}),
            tmp_path / "orders.parquet" / f"part-{n}.parquet",
        )
    expected = {}
    for key, kind in table:
        expected.setdefault(kind, key)
    taken = []
    first = staging.first_record_per_file
    monkeypatch.setattr(staging, "first_record_per_file", lambda df: taken.append((df, first(df))) or taken[0][1])
    found = QUERIES["first_record_per_file"](spark, str(tmp_path))
    assert {r.source: r.o_orderkey for r in found.collect()} == expected and found.count() == len(kinds)
    # file by file: the first record is the earliest of the file's orders, and a status has several files
    place = lambda df: df.selectExpr(
        "_source", "struct(get_json_object(value, '$.file') AS file, int(get_json_object(value, '$.nth')) AS nth) AS at"
    )
    earliest = {r._source: r.at for r in place(taken[0][0]).groupBy("_source").agg(F.min("at").alias("at")).collect()}
    assert {r._source: r.at for r in place(taken[0][1]).collect()} == earliest and len(earliest) > len(kinds)


def document(folder):
    """The parts of a written document, put together."""
    return json.loads("\n".join(p.read_text() for p in sorted(folder.glob("part-*"))))


def test_error_document(spark, tmp_path):
    reason, file = "String length exceeds DDL length", "s3://songs/A/T.json"
    log = spark.createDataFrame([(file + " ", "artist_location ", reason)] * 2, "filename string, colname string, err_reason string")
    reports.write_document(log, str(tmp_path / "all"))
    assert document(tmp_path / "all") == {"artist_location": [{"err_reason": reason, "filename": file}] * 2}
    reports.write_document(log, str(tmp_path / "once"), dedup=True)
    assert document(tmp_path / "once") == {"artist_location": [{"err_reason": reason, "filename": file}]}
    reports.write_document(log.limit(0), str(tmp_path / "none"))
    assert document(tmp_path / "none") == {}


def test_error_document_of_many_pieces(spark, tmp_path):
    """A column over several pieces, columns within one, and names that need escapes."""
    names = ["hot"] * 600 + ['q"uote\\', "", "é\n", "z"] * 3
    data = [(f"f{i:04d}", name, "r" if i % 2 else None) for i, name in enumerate(names)] + [("last", None, "r")]
    log = spark.createDataFrame(data, "filename string, colname string, err_reason string").repartition(7)
    lines = reports.document_lines(log)
    assert lines.select("piece").distinct().count() > 2
    reports.write_document(log, str(tmp_path / "r"))
    found = document(tmp_path / "r")
    wanted = {}
    for file, name, reason in sorted(data, key=lambda r: (r[2] is not None, r[2] or "", r[0])):
        wanted.setdefault((name or "").strip(" "), []).append({"err_reason": reason, "filename": file})
    assert found == wanted and list(found) == sorted(wanted, key=lambda n: n.encode())


def test_error_rows_hold_no_lists(spark, tmp_path, monkeypatch):
    log = spark.range(95).select(F.lit("f").alias("filename"), F.lit("c ").alias("colname"), F.lit("r").alias("err_reason"))
    assert rows(reports.error_rows(log)) == [("c", "r", "f", 95)] and rows(reports.error_rows(log, dedup=True)) == [("c", "r", "f", 1)]
    spark.range(50).selectExpr(
        "id AS o_orderkey", "id + 0.5D AS o_totalprice", "if(id % 2 = 0, '1-URGENT!', 'LOW') AS o_orderpriority"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    written = []
    write = reports.write_report
    monkeypatch.setattr(reports, "write_report", lambda df, path: (written.append(df), write(df, path)))
    found = rows(QUERIES["error_report"](spark, str(tmp_path)), "colname", "errors")
    assert found == [("o_orderpriority", 25), ("o_totalprice", 50)]
    assert not any(kind.startswith("array") for _, kind in written[0].dtypes)


def test_new_errors(spark):
    log = spark.createDataFrame(
        [("s3://a/x", "2020-01-01"), ("s3://a/y", "2020-01-02"), ("s3://b/z", "2020-01-03")], "filename string, starttime string"
    ).withColumn("starttime", F.col("starttime").cast("timestamp_ntz"))
    mark = reports.last_error_time(log, "s3://a")
    assert mark.first()["starttime"].day == 2
    assert reports.load_errors(log, "s3://a", mark).count() == 0
    assert reports.load_errors(log, "s3://a", mark.first()["starttime"]).count() == 0
    assert reports.load_errors(log, "s3://a", "2020-01-01 00:00:00").count() == 1
    assert reports.load_errors(log, "s3://a", reports.last_error_time(log, "s3://none")).count() == 2
    assert reports.load_errors(log, "s3://a").count() == 2
    assert reports.last_error_time(log, "s3://none").first()["starttime"] is None


def test_marks_do_not_depend_on_the_zone_of_python(spark, monkeypatch):
    log = spark.createDataFrame([(i, f"2020-01-01 {i:02}:00:00") for i in range(24)], "n int, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz")
    )
    for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        assert newer_than(log, "t", datetime(2020, 1, 1, 12)).count() == 11
    monkeypatch.undo()
    time.tzset()


def test_bound_values(spark):
    df = spark.createDataFrame([("it's",), ("x",)], "v string")
    assert rows(staging.sql_frame(spark, "SELECT v FROM {t} WHERE v = :v", {"v": "it's"}, t=df)) == [("it's",)]


def test_csv_files_of_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,text,other\n1,x,9\n2,\"y, \"\"z\"\"\",9\n3,short\n4,long,9,8\n")
    (tmp_path / "b.csv").write_bytes("\ufefftext,n\r\nq,5\r\n".encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text("text,n,n\nw,6,7\n\n")
    (tmp_path / "empty.csv").write_text("")
    contract = T.StructType([schemas.column("n", T.IntegerType()), schemas.text("text")])
    kept = csv_files.read_csv_columns(spark, str(tmp_path), contract)
    assert rows(kept) == [(1, "x"), (2, 'y, "z"'), (3, "short"), (4, "long"), (5, "q"), (6, "w")]
    dropped = csv_files.read_csv_columns(spark, str(tmp_path), contract, ["text"], ragged="drop")
    assert rows(dropped) == [("q",), ("w",), ("x",), ('y, "z"',)]
    ragged = csv_files.ragged_rows(spark, str(tmp_path), ["n"])
    assert {r["_corrupt"] for r in ragged.collect()} == {"3,short", "4,long,9,8"}
    assert all(r["_source"].endswith("a.csv") for r in ragged.collect())
    raw = csv_files.read_csv_records(spark, str(tmp_path), ["n", "text"])
    good, bad = staging.load_staging(raw, contract)
    assert good.count() == 4 and rows(bad, "err_reason") == [(staging.BAD_RECORD,)] * 2
    with pytest.raises(ValueError, match="no column absent"):
        csv_files.read_csv_records(spark, str(tmp_path), ["absent"])
    with pytest.raises(ValueError):
        csv_files.read_csv_columns(spark, str(tmp_path), contract, ragged="hide")
    only_empty = tmp_path / "none"
    only_empty.mkdir()
    (only_empty / "x.csv").write_text("")
    assert csv_files.read_csv_columns(spark, str(only_empty), contract).count() == 0


def test_one_header_makes_one_scan_in_small_splits(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text("a,b\n" + "\n".join(f"{k},{i}" for i in range(200)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        assert csv_files.plan(spark, str(tmp_path)) == [(["a", "b"], [str(tmp_path)])]
        contract = T.StructType([schemas.column("b", T.LongType())])
        assert csv_files.read_csv_columns(spark, str(tmp_path), contract).agg(F.count("b"), F.sum("b")).first() == (1000, 99500)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("kind", [T.ByteType(), T.LongType()])
def test_integers_are_exact(spark, kind):
    texts = ["38", "38.0", "38.5", "38.0000001", "1.0000000001e3", "1000e-1", "5.0E-0", "1e2", "1.5e1", "15e-1", "0e9", "0.000e-5",
             "-12e0", "+.5e1", ".e1", "e3", "1e", "1e99999999", "1e-99999999", "0e99999999", "9223372036854775807e0",
             "9223372036854775808e0", "92233720368547758070e-1", "127.000e0", "128e0", "1e1 ", "", None, "one", "1e2x"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", csv_files.typed(F.col("t"), kind).alias("v"))
    least, most = (-128, 127) if isinstance(kind, T.ByteType) else (-(2**63), 2**63 - 1)

    def exact(text):
        try:
            if len(text.lower().partition("e")[2]) > 5:
                return 0 if Decimal(text.lower().partition("e")[0]) == 0 else None
            value = Decimal(text.strip())
        except (AttributeError, ArithmeticError):
            return None
        return int(value) if value == value.to_integral_value() and least <= value <= most else None

    got = {r["t"]: r["v"] for r in found.collect()}
    assert got == {t: exact(t) for t in texts}
