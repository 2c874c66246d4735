import random
import re

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import line_dedup


def near(a, b):
    """Edit distance of units of at most one, by trying all edits."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def units(words, min_words, min_chars):
    """What an edit changes, and of which kind it is."""
    if len(words) >= min_words:
        return "words", tuple(words)
    line = " ".join(words)
    return ("characters", tuple(line)) if len(line) >= min_chars else ("none", ())


def brute(data, min_words=5, min_chars=8):
    lines = []
    for doc, text in data:
        if text is not None:
            for n, line in enumerate(text.split("\n")):
                words = tuple(re.findall(r"[^\x20\x09-\x0D]+", line))
                lines.append(((doc, n), words, units(words, min_words, min_chars)))
    lines.sort(key=lambda x: x[0])
    out = []
    for at, words, (kind, own) in lines:
        first = next(a for a, other, _ in lines if other == words)
        partner = None
        if kind != "none":
            for a, other, (kind2, others) in lines:
                if a < first and other != words and kind == kind2 and near(own, others):
                    partner = a
                    break
        if not words:
            out.append((*at, *at, 0, True))
        elif partner:
            out.append((*at, *partner, 1, False))
        else:
            out.append((*at, *first, 0, first == at))
    return sorted(out)


COLUMNS = ("doc_id", "line_no", "keep_doc_id", "keep_line_no", "edits", "kept")


def test_equals_brute_force(spark):
    rnd = random.Random(11)
    base = [[rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 14))] for _ in range(25)]
    data = []
    for doc in range(60):
        text = []
        for _ in range(rnd.randrange(1, 6)):
            words = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(words) + 1)
                kind = rnd.randrange(3)
                if kind == 0:
                    words.insert(at, rnd.choice("abcdefgh"))
                elif at < len(words):
                    words[at : at + 1] = [] if kind == 1 else [rnd.choice("abcdefgh")]
            text.append(rnd.choice([" ", "  "]).join(words))
        data.append((doc, "\n".join(text)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = rows(line_dedup.dedup_lines(df), *COLUMNS)
    assert found == brute(data)
    assert sum(r[4] for r in found) > 10


def test_one_common_line_with_many_variants(spark):
    words = [f"w{i}" for i in range(12)]
    data = [(0, " ".join(words))]
    for i in range(1, 120):
        changed = list(words)
        changed[7] = f"own{i}"
        data.append((i, " ".join(changed)))
    found = rows(line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")), *COLUMNS)
    assert found[0] == (0, 0, 0, 0, 0, True)
    assert all(r == (r[0], 0, 0, 0, 1, False) for r in found[1:])


def test_short_lines(spark):
    lines = ["Read more", "Read more ", "Read more\r", " Read\tmore", "Read moree", "Sign up for newsletter",
             "Sign up for newsletters", "Sign up for newsletters!!", "sign up for newsletter", "Page 1", "Page 2",
             "ééééééééé", "ééééèéééé", "a b c d e", "abcde fgh", "abcdX fgh", "𝒳y𝒳y𝒳y𝒳y𝒳y", "𝒳y𝒳y𝒳z𝒳y𝒳y", "x" * 5000, "x" * 5001]
    data = [(i, line) for i, line in enumerate(lines)]
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abc ") for _ in range(rnd.randrange(5, 16))) for _ in range(12)]
    for i in range(100, 260):
        line = list(rnd.choice(base))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(line))
            line[at : at + rnd.randrange(2)] = rnd.choice(["", "a", "b ", "c"])
        data.append((i, "".join(line)))
    found = rows(line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")), *COLUMNS)
    assert found == brute(data)
    kept = {r[0] for r in found if r[5]}
    assert kept & set(range(len(lines))) == {0, 5, 7, 9, 10, 11, 13, 14, 16, 18}


def test_a_line_of_most_documents(spark):
    data = [(i, f"Terms of use apply\n\nown{i} text{i * 7} of{i * 11} this document{i}") for i in range(400)]
    found = rows(line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")), *COLUMNS)
    assert found == brute(data)


def test_edge_cases(spark):
    data = [
        (1, "", "x", 1), (2, None, "x", 1), (3, "a b c\n\n \t\na b c", "x", 1), (4, "a b d", None, None),
        (5, "one two three four five six", "x", 1), (6, "one two three four five six\r", "x", 1),
        (7, "long " * 3000 + "end", "x", 1), (8, "long " * 3001 + "end", "x", 1),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, line string, first int")
    out = line_dedup.dedup_lines(df)
    assert rows(out, *COLUMNS) == brute([r[:2] for r in data])
    left = {r.doc_id: r.text for r in line_dedup.kept_text(df, out).collect()}
    assert left[3] == "a b c\n\n \t" and 8 not in left and left[4] == "a b d"
    assert line_dedup.dedup_lines(df.filter(F.lit(False))).count() == 0


def test_null_and_repeated_ids(spark):
    line = "one two three four five six"
    data = [(None, line), (1, line), (1, line), (1, line + " seven")]
    found = line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sum(r.kept for r in found) == 1 and len(found) == 4
    assert [r.doc_id for r in found if r.kept] == [None]


def test_a_text_is_hashed_once_and_not_for_each_line(spark):
    df = spark.createDataFrame([(1, " a  b\n\tc d \n \n" * 3)], "doc_id long, text string")
    lines = line_dedup._lines(df, "doc_id", "text", blanks=True)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    # what is printed below the generator runs before it
    assert plan.index("Generate") < plan.index("xxhash64") and plan.count("xxhash64") == 1
    found = lines.filter(line_dedup._has_words(F.col("line"))).select(line_dedup._plain(F.col("line")).alias("p")).distinct()
    assert rows(found) == [("a b",), ("c d",)]


def test_a_text_is_parted_once_and_halves_meet(spark):
    df = spark.createDataFrame([(1, "one two three four five\nsix")], "doc_id long, text string")
    plan = line_dedup._lines(df, "doc_id", "text", blanks=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    # a line and one with a unit changed, lost or added share a half, whatever their lengths
    rnd, data = random.Random(5), []
    for pair in range(300):
        chars = pair % 2
        a = [rnd.choice("abcdé𝒳") for _ in range(rnd.randrange(8, 20))] if chars else [rnd.choice(["a", "bc"]) for _ in range(rnd.randrange(5, 20))]
        at, b = rnd.randrange(len(a)), list(a)
        b[at : at + rnd.randrange(2)] = [] if len(a) > (8 if chars else 5) and rnd.random() < 0.5 else [rnd.choice("xyz")]
        data += [(pair, ("" if chars else " ").join(x)) for x in (a, b)]
    lines = spark.createDataFrame(data, "pair int, plain string")
    keyed = line_dedup._with_halves(lines, 5, 8).select("pair", "plain", F.inline(line_dedup._keys_of_halves()))
    met = keyed.alias("a").join(keyed.alias("b"), ["pair", "half"]).filter("a.plain <> b.plain").select("pair").distinct()
    assert rows(met) == [(p,) for p in sorted({p for p, _ in data}) if len({x for q, x in data if q == p}) > 1]
