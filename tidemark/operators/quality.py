"""Quality checks: keys, lengths, nulls, references, distributions, load audit."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from tidemark.schemas import key_columns, max_lengths, required_columns


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: duplicated key values and key count. Rows with a NULL in the key do not count."""
    def one(name, df, key):
        keyed = df.dropna(subset=key)
        return keyed.agg(
            F.lit(name).alias("table_name"),
            (F.count(F.lit(1)) - F.count_distinct(*key)).alias("pks_duplicated"),
            F.count(F.lit(1)).alias("length"),
        )
    return _stack([one(name, df, key) for name, (df, key) in tables.items()])


def truncation_report(tables: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """Columns with values of exactly the declared length, as a percentage of known values.

    One scan per table: all columns are measured in one aggregate, then unpivoted.
    """
    def one(name, df, schema):
        lengths = max_lengths(schema)
        full = [
            (F.count_if(F.length(c) == n) * F.lit(100.0) / F.nullif(F.count(c), F.lit(0))).alias(c)
            for c, n in lengths.items()
        ]
        rows = df.agg(*full).unpivot([], list(lengths), "column_name", "col_percent")
        limits = F.create_map(*[F.lit(x) for pair in lengths.items() for x in pair])
        return rows.select(
            F.lit(name).alias("table_name"),
            "column_name",
            "col_percent",
            limits[F.col("column_name")].cast("int").alias("character_maximum_length"),
        ).filter(F.col("col_percent") > 0)
    return _stack([one(name, df, schema) for name, (df, schema) in tables.items()])


def missing_keys(schemas: dict[str, T.StructType], staging_prefix: str = "staging") -> list[str]:
    """Names of tables without a key column; staging tables need none."""
    return [n for n, s in schemas.items() if not n.startswith(staging_prefix) and not key_columns(s)]


def require_keys(schemas: dict[str, T.StructType]) -> None:
    missing = missing_keys(schemas)
    if missing:
        raise ValueError(f"no primary key declared for: {', '.join(missing)}")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULLs per column, in one pass."""
    names = df.columns if columns is None else columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "nulls")


def not_null_columns(df: DataFrame) -> DataFrame:
    """Columns without a NULL."""
    return null_counts(df).filter(F.col("nulls") == 0).select("column_name")


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULLs in columns declared as required."""
    return null_counts(df, required_columns(schema)).filter(F.col("nulls") > 0)


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values that occur more than once, with their counts."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def is_unique(df: DataFrame, columns: list[str]) -> bool:
    return repeated_keys(df, columns).isEmpty()


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins between the least and greatest value, empty bins included."""
    value = F.col(column).cast("double")
    edges = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    # the greatest value belongs to the last bin; equal bounds leave one bin
    bin_of = F.when(lo == hi, F.lit(1)).otherwise(F.least(F.width_bucket(value, lo, hi, F.lit(bins)), F.lit(bins)))
    counts = df.filter(value.isNotNull()).groupBy(bin_of.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    every = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select("bin", F.coalesce("_n", F.lit(0)).alias("count"))


def orphans(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Foreign key values absent from ``dim``, with their rows. Keys with a NULL are not checked.

    Counting per key first means that a hot key enters the join as one row.
    """
    names = [f for f, _ in on]
    keys = fact.dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(*[F.col(d).alias(f"_d_{d}") for _, d in on])
    return keys.join(known, [F.col(f) == F.col(f"_d_{d}") for f, d in on], "left_anti")


def summary_by(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Minimum, maximum and sum of each column per group."""
    picks = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max), ("sum", F.sum))]
    return df.groupBy(*by).agg(*picks)


def load_audit(df: DataFrame, write: Callable[[DataFrame], None], source: str = "_source") -> DataFrame:
    """Run a write and return one row of its files, rows and seconds, to be appended to an audit table.

    Rows are counted in the write itself; files, by ``source`` and exactly, in
    a pass over that column (NULL where there is none).
    """
    spark = df.sparkSession
    seen = Observation("load")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    files = df.select(source).distinct().count() if source in df.columns else None
    began = time.monotonic()
    write(watched)
    row = (files, seen.get["rows"], time.monotonic() - began)
    return spark.createDataFrame([row], "files long, rows long, seconds double")
