"""Quality rules: a table of thresholds compiled into one projection.

Everything is a native expression on the text. Words are runs of anything but
ASCII white space. Base counts of a text:

``n_words``         words
``word_chars``      code points in words
``n_symbols``       characters of ``#*$%&|<>``
``n_dup_lines``     lines with a word that equal an earlier line
``n_repeat_words``  words inside three-word windows that occur at least twice

``n_repeat_words`` is found per text: the windows' hashes are sorted with their
places, and neighbours of one hash and the same words mark the words they cover. So
the work of a text grows with n log n, and no row leaves its task.

A rule names a ratio and the range it must lie in. NULL counts as empty text. Each
row is judged by itself, so ids may be NULL or repeat; ``keep`` carries rows as one
struct, so that their columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import WORD

#: Frequent function words of the languages looked for.
STOP_WORDS = (
    "the of and to in that is was for with on as by it be this from are at or an "
    "der die und das den mit von zu auf ist ein für im "
    "de la le les et des que un en dans est pour qui par sur "
    "el los las una con por para del se"
).split()

#: The same as they are and as a sentence begins with them.
STOP_FORMS = [*dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize()))]

BREAKS = "\x20\x09\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class Rule:
    """A text passes if ``least`` <= ratio <= ``most``; an open side is None."""

    ratio: str
    least: float | None = None
    most: float | None = None


#: Thresholds of the ratios named in ``ratios``.
RULES = (
    Rule("words", 50, None),
    Rule("repeat_word_share", None, 0.5),
    Rule("mean_word_length", 2.0, 14.0),
    Rule("symbol_share", None, 0.1),
    Rule("stop_words", 2, None),
    Rule("dup_line_share", None, 0.5),
    Rule("bang_share", None, 0.1),
)


def without(text: Column, characters: str, instead: str = "") -> Column:
    """``text`` with each of some characters replaced; a search for one byte is cheaper than any pattern."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(instead)), characters, text)


def words_of(text: Column) -> Column:
    return F.filter(F.split(without(text, BREAKS[1:], " "), " "), lambda w: w != "")


def _windows(words: Column, size: Column) -> Column:
    """For each three-word window its hash and its place, ascending."""
    return F.sort_array(F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    ))


def _covered(ordered: Column, words: Column, size: Column) -> Column:
    """Places of the windows next to one of the same hash and words, ascending; a place may come twice."""
    def same(x: Column, y: Column) -> Column:
        equal = [F.get(words, x["i"] + k) == F.get(words, y["i"] + k) for k in range(3)]
        return reduce(lambda a, b: a & b, equal, x["h"] == y["h"])

    both = F.zip_with(
        F.slice(ordered, 1, size - 3), F.slice(ordered, 2, size - 3),
        lambda x, y: F.when(same(x, y), F.array(x["i"], y["i"])),
    )
    return F.sort_array(F.flatten(F.array_compact(both)))


def _union_length(places: Column) -> Column:
    """Length of the union of the intervals [p, p + 3) over ascending places."""
    n = F.size(places)
    steps = F.zip_with(
        F.slice(places, 1, F.greatest(n - 1, F.lit(0))), F.slice(places, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(3)),
    )
    return F.when(n > 0, F.aggregate(steps, F.lit(3).cast("long"), lambda s, x: s + x))


def counts(docs: DataFrame, text_column: str = "text", prefix: str = "_q_") -> DataFrame:
    """``docs`` with the base counts and what the ratios need, under ``prefix``; no row is added or dropped.

    The steps are separate projections, so each array is computed once.
    """
    p = lambda name: F.col(prefix + name)
    text = F.coalesce(F.col(text_column), F.lit(""))
    out = docs.withColumn(prefix + "words", words_of(text))
    out = out.withColumn(prefix + "n", F.size(p("words")))
    out = out.withColumn(prefix + "sorted", F.when(p("n") > 3, _windows(p("words"), p("n"))))
    out = out.withColumn(prefix + "places", F.when(p("n") > 3, _covered(p("sorted"), p("words"), p("n"))))
    has_word = lambda x: x.rlike(WORD)
    out = out.withColumn(prefix + "lines", F.filter(F.split(text, "\n"), has_word))
    stops = F.array(*[F.lit(w) for w in STOP_FORMS])
    removed = lambda characters: F.length(text) - F.length(without(text, characters))
    counted = {
        "n_words": p("n"),
        "word_chars": F.length(F.array_join(p("words"), "")),
        "n_symbols": removed("#*$%&|<>"),
        "n_bangs": removed("!"),
        "n_lines": F.size(p("lines")),
        "n_dup_lines": F.size(p("lines")) - F.size(F.array_distinct(p("lines"))),
        "n_repeat_words": F.coalesce(_union_length(p("places")), F.lit(0)),
        "n_stops": F.size(F.array_intersect(p("words"), stops)),
    }
    out = out.withColumns({prefix + name: column.cast("long") for name, column in counted.items()})
    return out.drop(*[prefix + x for x in ("words", "n", "sorted", "places", "lines")])


def ratios(prefix: str = "_q_") -> dict[str, Column]:
    c = lambda name: F.col(prefix + name).cast("double")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {
        "words": c("n_words"),
        "repeat_word_share": share(c("n_repeat_words"), c("n_words")),
        "mean_word_length": share(c("word_chars"), c("n_words")),
        "symbol_share": share(c("n_symbols"), c("n_words")),
        "stop_words": c("n_stops"),
        "dup_line_share": share(c("n_dup_lines"), c("n_lines")),
        "bang_share": share(c("n_bangs"), c("n_words")),
    }


def passes(rules: tuple[Rule, ...] = RULES, prefix: str = "_q_") -> Column:
    """One condition of all rules."""
    found = ratios(prefix)
    sides = [F.lit(True)]
    for rule in rules:
        if rule.least is not None:
            sides.append(found[rule.ratio] >= rule.least)
        if rule.most is not None:
            sides.append(found[rule.ratio] <= rule.most)
    return reduce(lambda a, b: a & b, sides)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: id, the base counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of them repeated.
    ``kept``: not ``base_failed``, and all rules hold.
    """
    counted = counts(docs.select(F.col(id_column).alias("_q_id"), F.col(text_column).alias("_q_text")), "_q_text")
    base = {name: F.col(f"_q_{name}") for name in BASE}
    failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
    return counted.select(
        F.col("_q_id").alias(id_column), *[column.alias(name) for name, column in base.items()],
        failed.alias("base_failed"), (~failed & passes(rules)).alias("kept"),
    )


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with its columns."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_q_record"), F.col(text_column).alias("_q_text")
    )
    # a filter would be pushed below the counts, which would then be worked out for each of its terms;
    # it stays above a column that is not deterministic
    counted = counts(rows, "_q_text").withColumn("_q_row", F.monotonically_increasing_id())
    failed = (F.col("_q_n_words") < 50) | (100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_n_words"))
    return counted.filter((F.col("_q_row") >= 0) & ~failed & passes(rules)).select("_q_record.*")
