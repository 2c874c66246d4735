"""Files handled once each, and tables kept up to date by them."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import upsert
from tidemark.storage import children, matching, materialize, remove


def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows after the mark; all rows if there is no mark yet.

    ``mark`` is a time without zone, its text, a Column, or a frame of one row
    and column, which stays in Spark. Times go as text to the column's type, so
    the zone of this Python process plays no part.
    """
    if mark is None:
        return df
    if isinstance(mark, DataFrame):
        bound = mark.scalar()
        return df.filter((F.col(column) > bound) | bound.isNull())
    if not isinstance(mark, Column):
        mark = F.lit(mark.isoformat(sep=" ") if isinstance(mark, datetime) else mark).cast(df.schema[column].dataType)
    return df.filter(F.col(column) > mark)


def ingest_new(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    handler: Callable[[DataFrame, int], None],
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Hand the JSON files that have appeared since the last run to ``handler``, then stop."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = reader.json(path).writeStream.foreachBatch(handler)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """Handler that adds each batch to a table; a repeated batch replaces itself."""
    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return handle


@dataclass(frozen=True)
class Choice:
    """A change by which old and new rows of a key are alike: ``of(rows, keys)`` makes one row of those equal in ``keys``.

    A store deals such rows out by bucket first, and chooses where they are written.
    """

    of: Callable[[DataFrame, list[str]], DataFrame]


class Store:
    """Tables below one folder that change together, by numbered batches.

    ``keys`` names the key column of each table, or None for one that rows are
    appended to. ``data/<table>/version=N`` holds what batch N wrote of a table;
    ``commits/version=N``, one small file written last, names for every table the
    versions that hold it. So a batch changes all tables or none: one that failed
    has no commit and is written again from the commit before it, and one that is
    handed over twice changes nothing.

    Keyed tables lie in buckets by extendible hashing: a bucket holds the keys
    whose hash ends in its bits. The commit is their directory. A batch rewrites
    the buckets that it has keys of, each in a task of its own; one that may grow
    beyond ``rows`` rows splits into two, four or more by further bits, and no
    other bucket is touched. The directory has a row for a bucket, and so grows
    with the data by a row for each ``rows / 2`` rows or so.
    """

    COMMIT = "table string, depth int, bits long, since long, rows long"

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str | None], rows: int = 1_000_000):
        self.spark, self.path, self.keys, self.rows = spark, path.rstrip("/"), keys, rows

    def versions(self) -> list[int]:
        """Batches that are committed, ascending."""
        files = matching(self.spark, f"{self.path}/commits/version=*/*.parquet")
        return sorted({int(f.rpartition("/version=")[2].partition("/")[0]) for f in files})

    def _entries(self, version: int) -> list[Row]:
        return self.spark.read.schema(self.COMMIT).parquet(f"{self.path}/commits/version={version}").collect()

    def _paths(self, entries: list[Row]) -> list[str]:
        held = [e for e in entries if e["rows"]]
        return sorted(
            f"{self.path}/data/{e['table']}/version={e['since']}" + (f"/bucket={_name(e)}" if self.keys[e["table"]] else "")
            for e in held
        )

    def _read(self, entries: list[Row]) -> DataFrame | None:
        paths = self._paths(entries)
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """A table as of a commit, the last by default; None if nothing has been written to it."""
        known = self.versions()
        if not known:
            return None
        return self._read([e for e in self._entries(known[-1] if version is None else version) if e["table"] == table])

    def count(self, table: str) -> int:
        """Rows of a table as of the last commit, by the commit alone."""
        known = self.versions()
        return sum(e["rows"] for e in self._entries(known[-1]) if e["table"] == table) if known else 0

    def stage(self, table: str, number: int, rows: DataFrame) -> DataFrame:
        """Write what batch ``number`` appends to a table, and return the stored rows; they count once it is committed."""
        self._is_next(number)
        path = f"{self.path}/data/{table}/version={number}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _is_next(self, number: int) -> None:
        known = self.versions()
        if known and number <= known[-1]:
            raise ValueError(f"batch {number} comes after batch {known[-1]}")

    def commit(
        self, number: int, changes: dict[str, DataFrame | tuple[DataFrame, Change | Choice]], stored: tuple[str, ...] = ()
    ) -> bool:
        """Apply a batch; False if it has been applied before.

        Of an appended table the change is a frame, or one that ``stage`` has
        returned. Of a keyed one it is a frame and either a ``Choice`` or a
        function of (the rows of the touched buckets or None, the frame's rows
        that have a key), which returns these buckets' new rows, one a key.
        ``stored`` names tables whose frames are read from stored ones: of keyed
        tables they need not be stored again, appended ones are in their place.
        """
        known = self.versions()
        if number in known:
            return False
        self._is_next(number)
        before = self._entries(known[-1]) if known else []
        entries = [e for e in before if e["table"] not in changes]
        for table, what in changes.items():
            own = [e for e in before if e["table"] == table]
            if self.keys[table] is None:
                staged = what if table in stored else self.stage(table, number, what)
                entries += [*own, _entry(table, 0, 0, number, staged.count())]
            else:
                entries += self._merge(table, *what, own, number, table in stored)
        found = self.spark.createDataFrame(entries, self.COMMIT).coalesce(1)
        found.write.mode("overwrite").parquet(f"{self.path}/commits/version={number}")
        return True

    def _merge(
        self, table: str, batch: DataFrame, change: Change | Choice, own: list[Row], number: int, stored: bool
    ) -> list[Row]:
        key = self.keys[table]
        keyed = batch.dropna(subset=[key])
        if not stored:
            keyed = materialize(keyed, "batch")
        buckets = {(e["depth"], e["bits"]): e for e in own or [_entry(table, 0, 0, number, 0)]}
        # the new keys of each bucket that the batch touches; there are at most as many as the directory has rows
        new_keys = {}
        if len(buckets) == 1:
            new_keys = {at: n for at in buckets if (n := keyed.count())}
        if len(buckets) > 1 or any(buckets[at]["rows"] + n > self.rows for at, n in new_keys.items()):
            found = _placed(keyed.select(key), key, [(d, b, d) for d, b in buckets], self.spark)
            counted = found.groupBy("depth", "bits").agg(
                F.approx_count_distinct(F.xxhash64(key)).alias("n"), F.count(F.lit(1)).alias("rows")
            ).collect()
            new_keys = {(r["depth"], r["bits"]): r["n"] for r in counted}
            if isinstance(change, Choice) and any(r["rows"] > max(self.rows, 1.25 * r["n"]) for r in counted):
                # rows that repeat keys are reduced before they travel
                keyed = materialize(change.of(keyed, [key]), "batch")
        if not new_keys:
            return own
        targets = []
        for (depth, bits), n in new_keys.items():
            most = buckets[depth, bits]["rows"] + n
            # three quarters, as hashes do not fall evenly
            more = max(0, ceil(log2(most / (0.75 * self.rows)))) if most > self.rows else 0
            targets.append((depth, bits, depth + more))
        old = self._read([buckets[at] for at in new_keys])
        places = {}
        for depth, bits, wanted in targets:
            for i in range(1 << (wanted - depth)):
                places[wanted, bits | i << depth] = len(places)
        path = f"{self.path}/data/{table}/version={number}"
        bucket = F.concat_ws("-", "depth", "bits").alias("bucket")
        if isinstance(change, Choice):
            rows = keyed if old is None else old.unionByName(keyed)
            # keys of a bucket lie together, so the choice needs no other shuffle
            dealt = _placed(rows, key, targets, self.spark).select(*rows.columns, bucket).repartition("bucket")
            written = change.of(dealt, ["bucket", key])
        else:
            written = _placed(change(old, keyed), key, targets, self.spark)
            if len(places) == 1:
                named = written.withColumn("_at", F.lit(0))
            else:
                numbers = _table(self.spark, [(d, b, i) for (d, b), i in places.items()], "depth int, bits long, _at int")
                named = written.join(numbers, ["depth", "bits"])
            named = named.withColumn("bucket", bucket).repartitionById(len(places), F.col("_at"))
            written = named.drop("depth", "bits", "_at")
        written.write.mode("overwrite").partitionBy("bucket").parquet(path)
        names = self.spark.read.schema(f"{key} {keyed.schema[key].dataType.simpleString()}, bucket string").parquet(path)
        sizes = {r["bucket"]: r["n"] for r in names.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        changed = [_entry(table, d, b, number, sizes.get(f"{d}-{b}", 0)) for d, b in places]
        return [e for at, e in buckets.items() if at not in new_keys] + changed

    def expire(self, keep: int = 1) -> list[str]:
        """Delete the commits before the last ``keep``, and data that no commit left names; the paths deleted."""
        known = self.versions()
        last = known[-keep:]
        alive = {p for v in last for p in self._paths(self._entries(v))}
        gone = [f"{self.path}/commits/version={v}" for v in known if v not in last]
        for table, key in self.keys.items():
            for version in children(self.spark, f"{self.path}/data/{table}"):
                # what is newer than the last commit may be a batch under way
                if last and int(version.rpartition("=")[2]) <= last[-1]:
                    held = children(self.spark, version) if key else [version]
                    gone += [p for p in held if (not key or "/bucket=" in p) and p not in alive]
        for path in gone:
            remove(self.spark, path)
        return gone


Change = Callable[[DataFrame | None, DataFrame], DataFrame]


def _entry(table: str, depth: int, bits: int, since: int, rows: int) -> Row:
    return Row(table=table, depth=depth, bits=bits, since=since, rows=rows)


def _name(entry: Row) -> str:
    return f"{entry['depth']}-{entry['bits']}"


def _placed(rows: DataFrame, key: str, buckets: list[tuple[int, int, int]], spark: SparkSession) -> DataFrame:
    """Rows with the ``depth`` and ``bits`` of their bucket, for buckets (depth, bits, depth that it takes on).

    A row's hash has one candidate for each depth in use, of which one is there.
    """
    hashed = F.xxhash64(key)
    mask = F.expr("shiftleft(1L, depth) - 1L")
    if len(buckets) == 1 and buckets[0][0] == 0:
        return rows.withColumn("depth", F.lit(buckets[0][2])).withColumn("bits", hashed.bitwiseAND(mask))
    depths = sorted({d for d, _, _ in buckets})
    low = lambda d: hashed.bitwiseAND(F.lit((1 << d) - 1).cast("long"))
    candidates = F.array(*[F.struct(F.lit(d).alias("d"), low(d).alias("b")) for d in depths])
    directory = _table(spark, buckets, "_d int, _b long, depth int")
    tried = rows.withColumn("_try", F.explode(candidates))
    met = tried.join(directory, (F.col("_try.d") == F.col("_d")) & (F.col("_try.b") == F.col("_b")))
    return met.withColumn("bits", hashed.bitwiseAND(mask)).drop("_try", "_d", "_b")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as a frame whose size Spark knows."""
    names = [field.split()[0] for field in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    shape = ", ".join(f"{n}:{t}" for n, t in (field.split() for field in schema.split(", ")))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{shape}>>")))


class Snapshot(Store):
    """A store of one keyed table."""

    def __init__(self, spark: SparkSession, path: str, key: str, rows: int = 1_000_000):
        super().__init__(spark, path, {"snapshot": key}, rows)
        self.key = key

    def read(self, table: str = "snapshot", version: int | None = None) -> DataFrame | None:
        """The table; None if nothing has been written."""
        return super().read(table, version)

    def merge(self, batch: DataFrame, version: int, change: Change) -> bool:
        """Replace the buckets that ``batch`` has keys of by ``change(their rows, batch)``; False if done before."""
        return self.commit(version, {"snapshot": (batch, change)})


def upsert_into(
    snapshot: Snapshot,
    order: list[str],
    keep_first: list[str],
    keep_last: list[str],
) -> Callable[[DataFrame, int], None]:
    """Handler that merges each batch into the snapshot (see ``dedup.upsert``)."""
    def handle(batch: DataFrame, number: int) -> None:
        snapshot.merge(
            batch, number, lambda old, new: upsert(old, new, snapshot.key, order, keep_first, keep_last)
        )
    return handle
