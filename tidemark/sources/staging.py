"""Tolerant loading: typed rows, rejected values with reasons, and an error budget."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.text import cut_to_length, too_long
from tidemark.schemas import max_lengths
from tidemark.sources.csv_files import typed
from tidemark.sources.json_files import CORRUPT, PLACE, SOURCE
from tidemark.storage import materialize

ERRORS = "_errors"

# The reasons recorded for a rejected value.
TOO_LONG = "String length exceeds DDL length"
BAD_VALUE = "Invalid value for type"
BAD_RECORD = "Invalid JSON format"


class TooManyErrors(RuntimeError):
    """The load produced as many errors as its budget, or more; ``rejects`` holds the stored errors."""

    def __init__(self, message: str, rejects: DataFrame):
        super().__init__(message)
        self.rejects = rejects


def truncate_strings(df: DataFrame, schema: T.StructType, unit: str = "chars") -> DataFrame:
    """Cut text columns to their declared lengths."""
    cuts = {c: cut_to_length(F.col(c), n, unit) for c, n in max_lengths(schema).items() if c in df.columns}
    return df.withColumns(cuts)


def coerce(df: DataFrame, schema: T.StructType, long_text: str = "truncate", unit: str = "chars") -> DataFrame:
    """Type the text columns of ``df`` and list what is wrong with each row in ``_errors``.

    Empty text is NULL for columns that are not text. Text over its declared
    length is cut, or with ``long_text='reject'`` an error. Store the result
    before taking both its rows and its errors (``load_staging`` does).
    """
    lengths = max_lengths(schema)
    values, checks, final = {}, [], []

    def error(name, reason, found):
        return F.when(found, F.struct(F.lit(name).alias("colname"), F.lit(reason).alias("err_reason")))

    for field in schema:
        name, raw = field.name, F.col(field.name)
        value: Column = F.col(f"_v_{name}")
        if isinstance(field.dataType, T.StringType):
            limit = lengths.get(name)
            values[f"_v_{name}"] = raw if limit is None or long_text == "reject" else cut_to_length(raw, limit, unit)
            if limit is not None and long_text == "reject":
                checks.append(error(name, TOO_LONG, too_long(raw, limit, unit)))
        else:
            values[f"_v_{name}"] = typed(raw, field.dataType)
            checks.append(error(name, BAD_VALUE, value.isNull() & (F.trim(raw) != "")))
        final.append(value.alias(name, metadata=field.metadata))
    if CORRUPT in df.columns:
        checks.append(error("", BAD_RECORD, F.col(CORRUPT).isNotNull()))
    kept = [F.col(SOURCE)] if SOURCE in df.columns else []
    errors = F.array_compact(F.array(*checks)).cast("array<struct<colname:string,err_reason:string>>")
    return df.withColumns(values).select(*final, *kept, errors.alias(ERRORS))


def accepted(coerced: DataFrame) -> DataFrame:
    """Rows without an error."""
    return coerced.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejects(coerced: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One row per error: file, column, reason and time of the load."""
    source = F.col(SOURCE) if SOURCE in coerced.columns else F.lit(None).cast("string")
    at = F.localtimestamp() if loaded_at is None else loaded_at
    return coerced.filter(F.size(ERRORS) > 0).select(source.alias("filename"), F.explode(ERRORS).alias("_e")).select(
        "filename", "_e.colname", "_e.err_reason", at.alias("starttime")
    )


def check_budget(rejected: DataFrame, limit: int = 10) -> None:
    """Raise when there are ``limit`` errors or more; counting stops there."""
    if rejected.limit(limit).count() >= limit:
        raise TooManyErrors(f"{limit} or more errors; see the exception's rejects", rejected)


#: An audit table has a row for each load, also for one that was refused.
HISTORY = "load string, rows long, rejected long, errors long, files long, seconds double, refused boolean"


def load_staging(
    raw: DataFrame,
    schema: T.StructType,
    budget: int | None = 10,
    long_text: str = "truncate",
    unit: str = "chars",
    history: str | None = None,
    load: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Parse once into a stored table; return (accepted rows, rejects).

    Raises when there are ``budget`` errors or more; None sets no budget. With
    ``history`` the load appends a row to the audit table there (``HISTORY``), under
    the name ``load``: rows, rejected rows and errors are counted by the job that
    stores the rows, so the source is read once, and files from the one stored
    column that names them (NULL where there is none).
    """
    coerced, seen = coerce(raw, schema, long_text, unit), Observation("load")
    found = F.size(ERRORS)
    began = time.monotonic()
    stored = materialize(coerced.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(found > 0).alias("rejected"),
        F.coalesce(F.sum(found), F.lit(0)).cast("long").alias("errors"),
    ), "staging")
    took = time.monotonic() - began
    refused = budget is not None and seen.get["errors"] >= budget
    if history is not None:
        files = stored.select(SOURCE).distinct().count() if SOURCE in stored.columns else None
        counts = [seen.get[c] for c in ("rows", "rejected", "errors")]
        row = raw.sparkSession.createDataFrame([(load, *counts, files, took, refused)], HISTORY)
        row.coalesce(1).write.mode("append").parquet(history)
    bad = materialize(rejects(stored), "rejects")
    if refused:
        check_budget(bad, budget)
    return accepted(stored).select(*schema.names), bad


def sql_frame(spark: SparkSession, query: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run a query over the given frames (named in braces) with bound values (named with a colon)."""
    return spark.sql(query, args=args, **tables)


def first_record_per_file(records: DataFrame) -> DataFrame:
    """Variant load: only the first record of each file, by its place there.

    ``records`` come from ``read_json_records`` with ``places``.
    """
    first = records.groupBy(SOURCE).agg(F.min(PLACE).alias("_first"))
    at = (F.col(f"r.{SOURCE}") == F.col(f"f.{SOURCE}")) & (F.col(f"r.{PLACE}") == F.col("f._first"))
    return records.alias("r").join(first.alias("f"), at, "left_semi").drop(PLACE)


