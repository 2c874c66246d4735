"""JSON logs: one record per line, or records laid out freely over lines.

Free layout is read in texts that begin at a brace at a line start, which mostly
are whole records. Files in which one is not (a record holds objects at line
starts, or is torn, or something stands between records) are taken line by line:

1. A string ends with its line, so a line's depth is its own. A line cannot go on
   from the one before if the last and the first character do not follow each
   other in JSON (a closing brace and an opening one, say). There a new run begins.
   Within a valid record all lines follow each other, so no record crosses runs.
2. The depth at each line is a running sum in the file's order, over pieces of any
   size. Where it falls back to the least depth of its run so far, no brace is open:
   the run is cut there.
3. A record ends where its stretch of lines does, and begins at the last line that
   starts from the depth to which the stretch returns, if that opens an object. So
   a stretch ends in a whole record, or in none, whatever was torn before it.
4. What is left of a stretch is a reject.

So a torn record costs no other, and lines are put together for one record at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.operators.ordered import PIECE, ROW, join_carry, pieces, running_sum
from tidemark.operators.skew import join_heavy
from tidemark.storage import materialize

SOURCE = "_source"
CORRUPT = "_corrupt"
PLACE = "_place"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed records of all ``*.json`` files below ``path``, one per line; other keys are dropped."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return reader.json(path)


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Records with the schema found in the data. Costs a pass; for exploration."""
    return spark.read.option("recursiveFileLookup", True).json(path)


def read_json_records(spark: SparkSession, path: str, glob: str = "*.json", places: bool = False) -> DataFrame:
    """Raw record texts (``value``) and their file, whether a record spans lines or lines hold several.

    A brace at the start of a line begins a text. Line end and brace are given to
    the reader as the line separator, so large files still split, and no file
    becomes one row. Texts are then cut between a closing and an opening brace
    outside of strings: in valid JSON these two meet only between records.
    In files where a text is not one object, records are put together from lines.
    What is part of no record comes as it is, for ``map_paths`` to tell.
    ``places`` adds the place of a record in its file (``_place``).
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    texts = reader.text(path, lineSep="\n{").select(
        "value", F.col("_metadata.file_path").alias(SOURCE), F.col("_metadata.file_block_start").alias("_block"),
        # rows of a block are read in order by one task
        F.monotonically_increasing_id().alias("_row"),
    )
    parts = texts.select(
        SOURCE, "_block", "_row", F.posexplode(F.split("value", r"(?<=\})\s*\n(?=\s*\{)")).alias("_part", "value")
    )
    trimmed = parts.withColumn("value", F.regexp_replace("value", r"^\s+|\s+$", ""))
    # the separator has taken the brace of all texts but the first of a file
    bare = (F.col("_part") == 0) & ~F.col("value").startswith("{")
    opened = F.when(bare, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    apart = F.regexp_replace(
        "value", r'\G((?:[^"}]++|"(?:\\.|[^"\\])*+"|\}(?!\s*\{))*+)\}\s*(?=\{)', "$1}\u001e"
    )
    single = F.when(F.col("value").rlike(r"\}\s*\{"), F.split(apart, "\u001e")).otherwise(F.array("value"))
    cut = trimmed.withColumn("_bare", bare).withColumn("value", opened).select(
        SOURCE, "_bare", F.struct("_block", "_row", "_part").alias("_at"), F.posexplode(single).alias("_i", "value")
    )
    stored = materialize(cut.select(
        SOURCE, F.struct("_at._block", "_at._row", "_at._part", "_i").alias(PLACE), "value",
        (F.col("_bare") & (F.col("_i") == 0)).alias("_bare"), _one_object(F.col("value")).alias("_whole"),
    ), "json-records")
    # a file's first text had no separator before it
    first = stored.groupBy(SOURCE).agg(F.min(F.struct(PLACE, "_bare")).alias("_first"), F.bool_and("_whole").alias("_whole"))
    open_files = materialize(
        first.filter("_first._bare OR NOT _whole").select(SOURCE, F.col(f"_first.{PLACE}").alias("_start"), "_first._bare"),
        "json-files",
    )
    found = stored if open_files.isEmpty() else _from_lines(stored, open_files)
    return found.select("value", SOURCE, *([PLACE] if places else []))


def _outside(value: Column) -> Column:
    """A text without its strings. A string that its line does not end is cut off there."""
    # without escapes a string ends at the next quote
    return F.regexp_replace(F.regexp_replace(value, r"\\.", ""), r'"[^"\n]*(?:"|$|(?=\n))', "")


def _depth(outside: Column) -> Column:
    """Opening less closing braces of a text without strings."""
    return F.length(F.replace(outside, F.lit("}"), F.lit(""))) - F.length(F.replace(outside, F.lit("{"), F.lit("")))


def _one_object(value: Column) -> Column:
    """True for a text that braces enclose, that closes as often as it opens, and goes on after none of its objects."""
    outside = _outside(value)
    return (
        value.startswith("{") & value.endswith("}") & (_depth(outside) == 0) & ~outside.rlike(r"\}\s*[^\s,\]}]")
    )


#: What may follow a character of JSON between two tokens; of what is not named, the last entry.
VALUE = '"{[-0123456789tfn'
FOLLOWS = {",": VALUE, ":": VALUE, "[": VALUE + "]", "{": '"}', '"': ",:]}", "": ",]}"}


def _follows(before: Column, first: Column) -> Column:
    """Whether a line may begin so after one that ends with ``before`` (NULL: none)."""
    allowed = reduce(
        lambda rest, c: F.when(before == c, F.lit(FOLLOWS[c])).otherwise(rest), [c for c in FOLLOWS if c], F.lit(FOLLOWS[""])
    )
    return F.coalesce(before.isNotNull() & (F.instr(allowed, first) > 0), F.lit(False))


def _placed_lines(texts: DataFrame) -> DataFrame:
    """Stored lines of texts: number (``_nth``), first character, run, and the depth before and after."""
    value = F.regexp_replace("value", r"^\s+|\s+$", "")
    lines = texts.select(SOURCE, PLACE, F.posexplode(F.split("value", "\n")).alias("_line", "value")).withColumn(
        "value", value
    ).filter("value != ''")
    cut = pieces(lines.withColumns({
        "_first": F.substring("value", 1, 1), "_last": F.substring("value", -1, 1), "_step": _depth(_outside(F.col("value"))),
    }), [F.col(SOURCE), F.col(PLACE), F.col("_line")])
    here = Window.partitionBy(SOURCE, PIECE).orderBy(ROW)
    # a piece's first line is judged by the last one of the piece before
    inner = cut.withColumn("_prior", F.lag("_last").over(here)).withColumn(
        "_cut", (F.col("_prior").isNotNull() & ~_follows(F.col("_prior"), F.col("_first"))).cast("bigint")
    )
    edges = inner.groupBy(SOURCE, PIECE).agg(
        F.min_by("_first", ROW).alias("_head"), F.max_by("_last", ROW).alias("_tail"),
        F.sum("_step").alias("_steps"), F.sum("_cut").alias("_cuts"),
    )
    along = Window.partitionBy(SOURCE).orderBy(PIECE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    begins = (~_follows(F.lag("_tail").over(along), F.col("_head"))).cast("bigint")
    carry = edges.withColumn("_begins", begins).select(
        SOURCE, PIECE, F.coalesce(F.sum("_steps").over(earlier), F.lit(0)).alias("_depths"),
        (F.coalesce(F.sum(F.col("_cuts") + F.col("_begins")).over(earlier), F.lit(0)) + F.col("_begins")).alias("_runs"),
    )
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = inner.withColumns({"_step_sum": F.sum("_step").over(upto), "_cut_sum": F.sum("_cut").over(upto)})
    return materialize(join_carry(summed, carry, [SOURCE]).select(
        SOURCE, PLACE, "value", F.col(ROW).alias("_nth"), "_first",
        (F.col("_cut_sum") + F.col("_runs")).alias("_run"), (F.col("_step_sum") + F.col("_depths")).alias("_depth"),
        (F.col("_step_sum") + F.col("_depths") - F.col("_step")).alias("_before"),
    ), "json-lines")


def _from_lines(stored: DataFrame, files: DataFrame) -> DataFrame:
    """``value``, source and place of the records and rejects of ``files``, with those of all others as they are."""
    plain = stored.join(files.select(SOURCE), SOURCE, "left_anti").select(SOURCE, PLACE, "value")
    added = F.col("f._bare") & (F.col(PLACE) == F.col("_start"))
    lines = _placed_lines(stored.alias("s").join(files.alias("f"), SOURCE).select(
        SOURCE, PLACE, F.when(added, F.expr("substr(value, 2)")).otherwise(F.col("value")).alias("value")
    ))
    lines = _stretches(lines)
    own = [SOURCE, "_run", "_closed"]
    ends = materialize(lines.groupBy(*own).agg(F.max_by("_depth", "_nth").alias("_before")), "json-stretches")
    # the last line that starts from the depth to which the stretch returns
    starts = join_heavy(lines.select(*own, "_before", "_nth", "_first"), ends, [*own, "_before"])
    begins = starts.groupBy(*own).agg(F.max(F.struct("_nth", "_first")).alias("_at"))
    known = materialize(begins.filter("_at._first = '{'").select(*own, F.col("_at._nth").alias("_begin")), "json-stretches")
    told = join_heavy(lines, known, own, "left").withColumn("_kept", F.coalesce(F.expr("_nth >= _begin"), F.lit(False)))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("_nth", "value"))), lambda x: x["value"])
    joined = told.groupBy(*own, "_kept").agg(F.min(PLACE).alias(PLACE), F.array_join(texts, "\n").alias("value"))
    return plain.unionByName(joined.select(SOURCE, PLACE, "value"))


def _stretches(lines: DataFrame) -> DataFrame:
    """Stored ``lines`` with the number of times (``_closed``) that their run had closed all it had opened before them."""
    run = [SOURCE, "_run"]
    cut = lines.withColumn(PIECE, F.shiftright("_nth", 33))
    here = Window.partitionBy(*run, PIECE).orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy(*run).orderBy(PIECE)
    edges = cut.groupBy(*run, PIECE).agg(F.min("_depth").alias("_low"), F.min_by("_before", "_nth").alias("_base"))
    carry = edges.select(
        *run, PIECE,
        F.least(F.first("_base").over(along), F.min("_low").over(along.rowsBetween(Window.unboundedPreceding, -1))).alias("_lows"),
    )
    met = join_carry(cut.withColumn("_low", F.min("_depth").over(here)), carry, run)
    closing = met.withColumn("_closes", (F.col("_depth") <= F.least("_low", "_lows")).cast("bigint"))
    slim = materialize(closing.select(*run, PLACE, "value", "_nth", "_first", "_depth", F.col("_before").alias("_from"), "_closes"), "json-lines")
    counted = running_sum(slim, run, [F.col("_nth")], "_closes", "_closed")
    return materialize(counted.select(
        *run, PLACE, "value", "_nth", "_first", "_depth", F.col("_from").alias("_before"),
        (F.col("_closed") - F.col("_closes")).alias("_closed"),
    ), "json-lines")


def is_whole_object(value: Column) -> Column:
    """True for a text whose braces match and enclose it; tells records from fragments and cut-off ends.

    The JSON reader alone accepts anything after the first object.
    """
    return _one_object(value)


def _top_level_name(path: str) -> str | None:
    for start, end in (("$['", "']"), ("$.", "")):
        name = path[len(start):len(path) - len(end)]
        if path.startswith(start) and path.endswith(end) and name and not set(name) & set(".[]'"):
            return name
    return None


def map_paths(records: DataFrame, paths: dict[str, str], value: str = "value") -> DataFrame:
    """Text columns taken from record texts by JSONPath.

    Top-level paths share one parse of the record. A record that is not an
    object is kept in ``_corrupt``.
    """
    top = {c: _top_level_name(p) for c, p in paths.items()}
    fields = T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(n for n in top.values() if n)])
    text = F.trim(F.col(value))
    # fragments are turned into text that no reader accepts
    parsed = F.from_json(
        F.when(text.isNull() | is_whole_object(text), text).otherwise(F.concat(F.lit("not an object: "), text)),
        fields.add(CORRUPT, T.StringType()),
        {"columnNameOfCorruptRecord": CORRUPT},
    )
    # a generator keeps the parse from being repeated for every column taken from it
    flat = records.select(*[F.col(c).alias(f"_in_{c}") for c in records.columns], F.inline(F.array(parsed)))
    whole = F.when(F.col(CORRUPT).isNull(), F.col(f"_in_{value}"))
    columns = [(F.col(top[c]) if top[c] else F.get_json_object(whole, p)).alias(c) for c, p in paths.items()]
    others = [F.col(f"_in_{c}").alias(c) for c in records.columns if c != value]
    return flat.select(*columns, CORRUPT, *others)


def by_name(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Text columns taken from record texts by the names in ``schema``."""
    return map_paths(records, {f.name: f"$['{f.name}']" for f in schema}, value)
