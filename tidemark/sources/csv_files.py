"""CSV logs and lookups.

Files are planned by their headers: the first lines of all files form a table of
path and header, found in one pass over the text that keeps one line a file. Files
of one header are read by one scan, whatever their folder; the scans are united by
name. Rows whose number of fields differs from their header's are told apart.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.json_files import CORRUPT, SOURCE
from tidemark.storage import materialize

# Fixed value: the mark that some writers set before a text in UTF-8.
BYTE_ORDER_MARK = "﻿"


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path`` and ``header`` (its first line) of every file that is not empty."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    # rows of a file's first block are read in order by one task
    first = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row")).filter("block = 0")
    # beside a set Spark aggregates by hash and holds a line a file; for the text alone it would sort all lines
    found = first.groupBy("path").agg(F.min_by("value", "row").alias("header"), F.collect_set("block").alias("blocks"))
    return found.filter(F.size("blocks") > 0).select("path", "header")


def header_names(line: str) -> list[str]:
    """Column names in a header line."""
    return next(csv.reader([line.removeprefix(BYTE_ORDER_MARK).rstrip("\r")]), [])


def plan(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], list[str]]]:
    """(names, paths) of each header; one header covers ``path`` as it was given, so no list of files is made."""
    # stored, as the text would be read for each use
    found = materialize(headers(spark, path).withColumn("header", F.rtrim("header")), "csv-headers")
    kinds = [r["header"] for r in found.select("header").distinct().orderBy("header").collect()]
    if len(kinds) == 1:
        return [(header_names(kinds[0]), [path] if isinstance(path, str) else list(path))]
    # as Spark's own listing, the driver holds the paths
    files = found.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect()
    return [(header_names(r["header"]), r["paths"]) for r in files]


def _scans(spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool, corrupt: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("recursiveFileLookup", True)
    reader = reader.option("quote", '"').option("escape", '"')
    if corrupt:
        # fields can only be counted where all are read
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    more = [CORRUPT, SOURCE] if corrupt else []
    parts = []
    for names, paths in plan(spark, path):
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {paths[0]}")
        # of columns that share a name the first is meant; the others are named by their places
        lower = [n.lower() for n in names]
        own = [n if lower.index(n.lower()) == i and n not in more else f"_c{i}" for i, n in enumerate(names)]
        fields = [T.StructField(n, T.StringType()) for n in [*own, *more[:1]]]
        raw = reader.schema(T.StructType(fields)).csv(paths)
        found = [F.col(f"`{own[names.index(c)]}`").alias(c) for c in columns]
        told = [F.col(CORRUPT), F.col("_metadata.file_path").alias(SOURCE)]
        parts.append(raw.select(*found, *(told if corrupt else [])))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *more)]))
    return reduce(DataFrame.unionByName, parts)


def read_csv_records(
    spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool = False
) -> DataFrame:
    """``columns`` as text, the file (``_source``), and in ``_corrupt`` a row that has too few or too many fields.

    Standard quoting: a quote within quotes is doubled. With ``multi_line`` values
    may hold line ends; such files cannot be split. Columns are found by header
    name, in any order and beside others. A file without one of them raises
    ValueError. Fields of a corrupt row are set as far as they go. ``coerce`` and
    ``load_staging`` turn corrupt rows into rejects.
    """
    return _scans(spark, path, columns, multi_line, corrupt=True)


def read_csv_columns(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    columns: list[str] | None = None,
    multi_line: bool = False,
    ragged: str = "keep",
) -> DataFrame:
    """Named columns of CSV files with a header, typed by ``schema``; unreadable values become NULL.

    Files are read as by ``read_csv_records``. Rows with too few or too many
    fields are kept as far as they go, or with ``ragged='drop'`` left out, which
    needs all columns to be read; ``ragged_rows`` returns them. Integers may be
    written with a zero fraction.
    """
    if ragged not in ("keep", "drop"):
        raise ValueError("ragged rows are kept or dropped")
    wanted = schema.names if columns is None else columns
    raw = _scans(spark, path, wanted, multi_line, corrupt=ragged == "drop")
    kept = raw if ragged == "keep" else raw.filter(F.col(CORRUPT).isNull())
    return kept.select(*[typed(F.col(c), schema[c].dataType).alias(c) for c in wanted])


def ragged_rows(spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool = False) -> DataFrame:
    """File (``_source``) and text (``_corrupt``) of rows that have too few or too many fields."""
    raw = read_csv_records(spark, path, columns, multi_line)
    # stored, as Spark reads corrupt texts only beside other columns
    stored = materialize(raw.select(*columns[:1], CORRUPT, SOURCE), "csv-ragged")
    return stored.filter(F.col(CORRUPT).isNotNull()).select(SOURCE, CORRUPT)


def typed(value: Column, dtype: T.DataType) -> Column:
    """Cast text, giving NULL where it does not fit; '38', '38.0' and '380e-1' are one integer, '38.5' is none."""
    if not isinstance(dtype, T.IntegralType):
        return value.try_cast(dtype)
    # text is read as a decimal, as a failing cast from text to integer is slow
    number = value.try_cast("decimal(38,6)")
    whole = number.try_cast(dtype)
    # the decimal rounds what is finer, so a fraction is looked for in the text as well
    fraction = value.rlike(r"\.\d*[1-9]\d*\s*$")
    plain = F.when((number == whole) & ~fraction, whole)
    return F.when(value.contains("e") | value.contains("E"), _scaled(value, dtype)).otherwise(plain)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once; not compiled, as it is rarely needed and would make long code."""
    return F.transform(F.array(value), use)[0]


def _scaled(value: Column, dtype: T.DataType) -> Column:
    """An integer written with an exponent, by its digits alone; NULL where digits are left behind the point."""
    form = r"^\s*([+-]?)(\d*)(?:\.(\d*))?[eE]([+-]?\d{1,9})\s*$"

    def parts(text: Column) -> Column:
        cut = {n: F.regexp_extract(text, form, i) for i, n in enumerate(("sign", "whole", "rest", "power"), 1)}
        return F.struct(*[c.alias(n) for n, c in cut.items()])

    def stripped(p: Column) -> Column:
        digits = F.ltrim(F.concat(p["whole"], p["rest"]), F.lit("0"))
        return F.struct(
            p["sign"].alias("sign"), F.rtrim(digits, F.lit("0")).alias("kept"),
            # the power of ten that the digits without their last zeros are multiplied by
            (p["power"].try_cast("int") - F.length(p["rest"]) + F.length(digits)).alias("end"),
        )

    def scaled(d: Column) -> Column:
        power = d["end"] - F.length(d["kept"])
        text = F.concat(d["sign"], d["kept"], F.repeat(F.lit("0"), F.greatest(power, F.lit(0))))
        return F.when(d["kept"] == "", F.lit(0).cast(dtype)).when((power >= 0) & (d["end"] <= 19), text.try_cast(dtype))

    # a number has a digit, before or behind the point
    written = value.rlike(r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)[eE][+-]?\d{1,9}\s*$")
    return F.when(written, _let(_let(_let(value, parts), stripped), scaled))


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small table with a header; Spark broadcasts it by its size."""
    return spark.read.option("header", True).schema(schema).csv(path)
