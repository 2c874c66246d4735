"""Near-duplicate lines by a deletion-neighbourhood join; the earliest stays.

Lines are compared as their words, set one blank apart, so white space makes no
difference at any length. Two lines are near if one becomes the other by
inserting, deleting or replacing at most one unit. What a unit is grows with the
line: a character in lines of fewer than ``min_words`` words, a word in longer
ones; lines of fewer than ``min_chars`` characters must be equal, and blank lines
are never dropped. Short and longer lines are not near each other. Lines are
ordered by (document id, place in the document). A line goes if an earlier line
is equal or near.

1. Equal lines are grouped by a digest; the earliest speaks for them.
2. If two lines are near, about half of the units of each, from the start or from the end, is
   equal. So lines that share no half with another line have no partner and are
   left out. This only saves work: it loses no pair.
3. All variants of the others within the bound, in the part that can differ, are
   emitted as hashed keys: the line without its i-th unit, as a deletion (met by
   the line that lacks it) and together with i (met by lines that have another
   unit there).
   Hashes are made of running XORs of unit-and-place hashes, so the variants of
   a line take time linear in its length.
4. Each key keeps its earliest line, and its earliest whole one for lines that
   lose a unit by it; each line keeps the earliest over its keys. No pairs are
   made within a key, so a key may hold any number of lines.
5. Each line is verified against that partner by its units; a line that fails
   (a hash collision) stays.

Texts are parted into lines in one pass, which stores each line's place, digest and
hashed halves but not the line; the texts of lines that are compared part again. Lines
learn what became of them by their digests; digests of many lines meet that by a
broadcast of their few rows, and blank lines need no join.

All steps are native expressions. NULL texts have no lines, empty ones a blank
one. Documents with equal ids or none are told apart by their texts' digests; rows
that repeat in full are as one. Further columns of the documents are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.quality_rules import without
from tidemark.operators.ordered import dense_id
from tidemark.operators.skew import join_heavy
from tidemark.storage import materialize

MIN_WORDS, MIN_CHARS = 5, 8


#: A line's place in the order: its document, what tells documents of equal ids apart, and its number.
PLACE = ["doc", "of", "line_no"]


def _parts(docs: DataFrame, id_column: str, text_column: str, blanks: bool = False) -> DataFrame:
    """The id, what tells equal ids apart, and the lines (``parts``) of all texts."""
    source = docs.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text")).filter("text IS NOT NULL")
    text = without(F.col("text"), "\x09\x0b\x0c\x0d", " ") if blanks else F.col("text")
    # what stands beside a generator is worked out for each of its rows, so the text is hashed before
    return source.select("doc", F.xxhash64("text").alias("of"), F.split(text, "\n").alias("parts"))


def _lines(docs: DataFrame, id_column: str, text_column: str, blanks: bool = False) -> DataFrame:
    """The place and the text (``line``) of all lines, with ``blanks`` all other white space a blank."""
    parts = _parts(docs, id_column, text_column, blanks)
    # no text is without a line; the plain generator would have each split twice, once to see that
    return parts.select("doc", "of", F.posexplode_outer("parts").alias("line_no", "line"))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _plain(line: Column) -> Column:
    """The line's words set one blank apart; most lines are so as they stand."""
    stands = ~(line.contains("  ") | line.startswith(" ") | line.endswith(" "))
    return F.when(stands, line).otherwise(F.array_join(_words(line), " "))


def _has_words(line: Column) -> Column:
    return F.trim(line) != ""


def _units(plain: Column, words: Column, min_words: int, min_chars: int) -> Column:
    """Words, or characters of a short line, or NULL; a character has a blank before it, which no word has."""
    characters = F.transform(F.split(plain, ""), lambda c: F.concat(F.lit(" "), c))
    return F.when(F.size(words) >= max(min_words, 2), words).when(F.length(plain) >= max(min_chars, 2), characters)


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _half(plain: Column, by_words: Column, h: Column, first: bool) -> Column:
    """A hash of the first or last ``h`` words, or else characters, taken from the text as it stands."""
    words = F.call_function("substring_index", plain, F.lit(" "), h if first else -h)
    characters = F.left(plain, h) if first else F.right(plain, h)
    return F.xxhash64(F.lit("first" if first else "last"), by_words, h, F.when(by_words, words).otherwise(characters))


def _with_halves(lines: DataFrame, min_words: int, min_chars: int) -> DataFrame:
    """``lines`` with ``units``, the number of units (NULL: none), and hashes of about half a ``plain`` line.

    Of two near lines of n and at most n units, those before the change or those
    after it are equal, and so are the first or the last h units for any
    h <= (n - 1) / 2 or, for two of n units, h <= n / 2. Lines of 4 k to
    4 k + 3 units take h = 2 k (``first`` and ``last``), and those of 4 k units
    h = 2 k - 2 as well (``first_less`` and ``last_less``), by which they meet
    lines of one unit less.
    """
    plain, by_words = F.col("plain"), F.col("words") >= max(min_words, 2)
    units = F.when(by_words, F.col("words")).when(F.length(plain) >= max(min_chars, 2), F.length(plain))
    counted = lines.withColumn("words", F.size(F.split(plain, " "))).withColumn("units", units)
    n, h = F.col("units"), _half_units(F.col("units"))
    return counted.withColumns({
        "first": F.when(n.isNotNull(), _half(plain, by_words, h, True)),
        "last": F.when(n.isNotNull(), _half(plain, by_words, h, False)),
        "first_less": F.when(n % 4 == 0, _half(plain, by_words, h - 2, True)),
        "last_less": F.when(n % 4 == 0, _half(plain, by_words, h - 2, False)),
    }).drop("words")


HALVES = ["units", "first", "last", "first_less", "last_less"]


def _half_units(n: Column) -> Column:
    return (F.floor(n / 4) * 2).cast("int")


def _keys_of_halves() -> Column:
    """The columns of ``_with_halves`` as rows (``half``, ``at_start``, ``h``)."""
    h = _half_units(F.col("units"))
    sides = [("first", True, h), ("last", False, h), ("first_less", True, h - 2), ("last_less", False, h - 2)]
    made = F.array(*[F.struct(F.col(c).alias("half"), F.lit(at).alias("at_start"), x.alias("h")) for c, at, x in sides])
    return F.when(F.col("units") % 4 == 0, made).when(F.col("units").isNotNull(), F.slice(made, 1, 2))


def _variants(lines: DataFrame) -> DataFrame:
    """(``line``, ``key``, ``at``) of all variants within the bound of rows ``line``, ``words``, ``after``, ``before``.

    ``line`` is a number that follows the order. The line shares its first
    ``after`` words with another, or its last ``before`` (NULL: none), so that
    only later, or earlier, words can differ. ``at`` is the place of a word that
    another takes, -1 for a whole line, -2 for one that loses a word.
    """
    total = lambda shift: F.aggregate(
        F.transform("words", lambda w, i: F.xxhash64(w, i - shift)), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x)
    )
    summed = lines.withColumns({"n": F.size("words"), "all_h": total(0), "all_g": total(1)})
    hashed = summed.select("line", "n", "after", "before", "all_g", F.posexplode("words").alias("i", "word")).select(
        "line", "n", "after", "before", "all_g", "i",
        F.xxhash64("word", "i").alias("h"), F.xxhash64("word", F.col("i") - 1).alias("g"),
    )
    upto = Window.partitionBy("line").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("line").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # XOR is its own inverse: what lies beyond a word is the whole without what came up to it
    earlier = F.coalesce(F.bit_xor("h").over(upto), F.lit(0).cast("long"))
    cut = hashed.withColumn("key", earlier.bitwiseXOR(F.col("all_g")).bitwiseXOR(F.bit_xor("g").over(here)))
    can_differ = (F.col("i") >= F.col("after")) | (F.col("i") < F.col("n") - F.col("before"))
    lost = cut.filter(F.coalesce(can_differ, F.lit(False))).select(
        "line", "key", F.explode(F.array(F.col("i"), F.lit(-2))).alias("at")
    )
    return lost.unionByName(summed.select("line", F.col("all_h").alias("key"), F.lit(-1).alias("at")))


def _near(a: Column, b: Column) -> Column:
    """Whether two word lists differ by at most one insertion, deletion or replacement."""
    longest = F.greatest(F.size(a), F.size(b))
    def agree(x: Column, y: Column) -> Column:
        at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(at == 0, longest).otherwise(at - 1)
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (agree(a, b) + agree(F.reverse(a), F.reverse(b)) >= longest - 1)


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per line: ``doc_id``, ``text_hash``, ``line_no``, ``keep_doc_id``, ``keep_line_no``, ``edits``, ``kept``.

    ``edits`` is 0 for a line that equals the one that stays in its place, 1 for
    a near one; a line that stays names itself. ``line_no`` counts from 0.
    """
    lines = _lines(docs, id_column, text_column, blanks=True)
    place = F.struct(*PLACE)
    plain = F.when(_has_words(F.col("line")), _plain(F.col("line"))).alias("plain")
    # the one pass that parts all texts; a blank line has no digest, and stays
    placed = materialize(
        _with_halves(lines.select(*PLACE, plain), min_words, min_chars)
        .select(*PLACE, _digest(F.col("plain")).alias("digest"), *HALVES), "placed-lines",
    )
    firsts = materialize(
        placed.filter("digest IS NOT NULL").groupBy("digest").agg(
            F.min(place).alias("place"), *[F.first(c).alias(c) for c in HALVES]
        ).select("digest", "place.*", *HALVES), "first-lines",
    )
    # halves that different lines share
    keyed = firsts.select(F.xxhash64("digest").alias("mark"), *PLACE, F.inline(_keys_of_halves()))
    shared = keyed.groupBy("half").agg(F.min("mark").alias("least"), F.max("mark").alias("most")).filter("least < most")
    wanted = keyed.drop("mark").join(shared.select("half"), "half", "left_semi").groupBy(*PLACE).agg(
        F.min(F.when(F.col("at_start"), F.col("h"))).alias("after"), F.min(F.when(~F.col("at_start"), F.col("h"))).alias("before")
    )
    # whole texts travel to the wanted lines, as they are fewer rows than all lines
    asked = wanted.groupBy("doc", "of").agg(F.collect_list(F.struct("line_no", "after", "before")).alias("asked"))
    same_text = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("doc", "of")]
    found = F.transform("asked", lambda x: F.struct(
        x["line_no"].alias("line_no"), F.get("parts", x["line_no"]).alias("line"), x["after"].alias("after"), x["before"].alias("before")
    ))
    met = _parts(docs, id_column, text_column, blanks=True).alias("a").join(asked.alias("b"), same_text).select(
        "a.doc", "a.of", F.inline(found)
    )
    # rows that repeat in full bring the same line more than once
    met = met.groupBy(*PLACE).agg(F.first("line").alias("line"), F.first("after").alias("after"), F.first("before").alias("before"))
    units = _units(F.col("plain"), F.split("plain", " "), min_words, min_chars)
    open_lines = materialize(
        dense_id(met, [F.col(c) for c in PLACE], "number").withColumn("plain", _plain(F.col("line"))).select(
            F.col("number").alias("line"), *PLACE, _digest(F.col("plain")).alias("digest"), units.alias("words"),
            "after", "before",
        ), "open-lines",
    )
    variants = materialize(_variants(open_lines), "variants")
    # a key holds lines that lose a word (-2), whole lines (-1), and lines alike but for the word at one place
    groups = variants.withColumn("whole", F.col("at") != -2).withColumn("at", F.greatest("at", F.lit(-1)))
    earliest = groups.groupBy("key", "at").agg(
        F.min("line").alias("any"), F.min(F.when(F.col("whole"), F.col("line"))).alias("near"),
        F.count(F.lit(1)).alias("lines"),
    ).filter("lines > 1").drop("lines")
    partners = groups.join(earliest, ["key", "at"]).withColumn(
        "partner", F.when(F.col("whole"), F.col("any")).otherwise(F.col("near"))
    ).filter("partner < line").groupBy("line").agg(F.min("partner").alias("partner"))
    sides = partners.join(open_lines.select("line", "digest", "words"), "line").join(
        open_lines.select(
            F.col("line").alias("partner"), F.col("words").alias("other"), F.struct(*PLACE).alias("earlier")
        ), "partner",
    )
    near = materialize(sides.filter(_near(F.col("words"), F.col("other"))).select("digest", "earlier"), "near-lines")
    known = firsts.select("digest", F.struct(*PLACE).alias("first")).join(near, "digest", "left")
    met = join_heavy(placed.filter("digest IS NOT NULL").select(*PLACE, "digest"), materialize(known, "known-lines"), ["digest"])
    keep = F.coalesce("earlier", "first")
    judged = met.select(
        *PLACE, keep.alias("keep"), F.col("earlier").isNotNull().alias("edited"),
        (F.col("earlier").isNull() & F.col("first").eqNullSafe(place)).alias("kept"),
    )
    blank = placed.filter("digest IS NULL").select(*PLACE, place.alias("keep"), F.lit(False).alias("edited"), F.lit(True).alias("kept"))
    return judged.unionByName(blank).select(
        F.col("doc").alias("doc_id"), F.col("of").alias("text_hash"), "line_no",
        F.col("keep")["doc"].alias("keep_doc_id"), F.col("keep")["line_no"].alias("keep_line_no"),
        F.col("edited").cast("int").alias("edits"), "kept",
    )


def kept_text(docs: DataFrame, judged: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the text that is left of each document, its lines in order."""
    lines = _lines(docs, id_column, text_column)
    stay = judged.filter("kept").select(F.col("doc_id").alias("doc"), F.col("text_hash").alias("of"), "line_no")
    same_place = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in PLACE]
    left = lines.alias("a").join(stay.alias("b"), same_place, "left_semi").groupBy("doc", "of").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]
        ), "\n").alias("text")
    )
    return left.select(F.col("doc").alias(id_column), F.col("text").alias(text_column))
