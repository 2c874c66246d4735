"""Load-error reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.ordered import PIECE, ROW, pieces
from tidemark.storage import materialize
from tidemark.streaming.incremental import newer_than


def _trimmed(rejected: DataFrame, dedup: bool) -> DataFrame:
    errors = rejected.select(*[F.trim(c).alias(c) for c in ("colname", "err_reason", "filename")])
    return errors.distinct() if dedup else errors


def document_lines(rejected: DataFrame, dedup: bool = False) -> DataFrame:
    """The lines of one JSON document, column to list of {err_reason, filename}, an error a line.

    Columns: ``value``, and the ``piece`` and place (``row``) that put the lines in
    order. Errors are put in order over pieces; a line opens or closes its column's
    list where its neighbours are of another column, and those across a piece's
    edge are known from a table of one row a piece. So a column may have any number
    of errors, and no list is ever built. Without errors there are no lines. An
    unknown column counts as empty text.
    """
    named = _trimmed(rejected, dedup).withColumn("colname", F.coalesce("colname", F.lit("")))
    cut = pieces(named, [F.col(c) for c in ("colname", "err_reason", "filename")])
    edges = cut.groupBy(PIECE).agg(F.min_by("colname", ROW).alias("_head"), F.max_by("colname", ROW).alias("_tail"))
    along = Window.orderBy(PIECE)
    known = materialize(edges.select(
        PIECE, F.lag("_tail").over(along).alias("_earlier"), F.lead("_head").over(along).alias("_later")
    ), "edges")
    here = Window.partitionBy(PIECE).orderBy(ROW)
    met = cut.withColumns({
        "_prior": F.lag("colname").over(here), "_next": F.lead("colname").over(here),
        "_starts": F.row_number().over(here) == 1,
    }).withColumn("_ends", F.col("_next").isNull()).join(known, PIECE)
    prior = F.when(F.col("_starts"), F.col("_earlier")).otherwise(F.col("_prior"))
    later = F.when(F.col("_ends"), F.col("_later")).otherwise(F.col("_next"))
    opens, closes = ~prior.eqNullSafe(F.col("colname")), ~later.eqNullSafe(F.col("colname"))
    # a name as JSON text, taken from an object that holds it alone
    name = F.regexp_extract(F.to_json(F.struct("colname")), r'(?s)^\{"colname":(.*)\}$', 1)
    error = F.to_json(F.struct("err_reason", "filename"), {"ignoreNullFields": "false"})
    text = F.concat(
        F.when(prior.isNull(), "{").otherwise(""), F.when(opens, F.concat(name, F.lit(": ["))).otherwise(""), error,
        F.when(~closes, ",").when(later.isNull(), "]}").otherwise("],"),
    )
    return met.select(text.alias("value"), F.col(PIECE).cast("int").alias("piece"), F.col(ROW).alias("row"))


def write_document(rejected: DataFrame, path: str, dedup: bool = False) -> None:
    """Write the report as one JSON document; its parts, in the order of their names, are the document's text."""
    lines = materialize(document_lines(rejected, dedup), "document")
    last = lines.agg(F.max("piece")).first()[0]
    if last is None:
        lines.sparkSession.range(1).select(F.lit("{}").alias("value")).coalesce(1).write.mode("overwrite").text(path)
        return
    placed = lines.repartitionById(last + 1, F.col("piece")).sortWithinPartitions("row")
    placed.select("value").write.mode("overwrite").text(path)


def error_rows(rejected: DataFrame, dedup: bool = False) -> DataFrame:
    """One row per distinct error and how many ``times`` it came (once with ``dedup``), laid out by column.

    No list is built, so a column may have any number of errors.
    """
    errors = _trimmed(rejected, dedup=False)
    times = F.lit(1).cast("long") if dedup else F.count(F.lit(1))
    layout = ["colname", "err_reason", "filename"]
    return errors.groupBy(*layout).agg(times.alias("times")).repartitionByRange(*layout).sortWithinPartitions(*layout)


def load_errors(log: DataFrame, folder: str, previous_max=None) -> DataFrame:
    """Errors of files below ``folder`` that are newer than the previous maximum."""
    return newer_than(log.filter(F.col("filename").startswith(folder)), "starttime", previous_max)


def last_error_time(log: DataFrame, folder: str) -> DataFrame:
    """The latest error time of a folder, in one row."""
    return log.filter(F.col("filename").startswith(folder)).agg(F.max("starttime").alias("starttime"))


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
