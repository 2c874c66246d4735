"""Text expressions: regions, ordered pattern labels, length limits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and the text each one is recognised by, first match wins.
OS_RULES = [
    ("Windows", "Windows"),
    ("Linux", "Linux"),
    ("Mac", "Macintosh"),
    ("iPhone", "iPhone"),
]
BROWSER_RULES = [
    ("Chrome", "Chrome"),
    ("Firefox", "Firefox"),
    ("IE", "Trident"),
    ("Mobile", "Mobile"),
    ("Safari", "Safari"),
]


def region_of(location: Column) -> Column:
    """'City-City, AA-BB' to 'AA'; an absent part is ''."""
    after_comma = F.split_part(location, F.lit(","), F.lit(2))
    return F.trim(F.split_part(after_comma, F.lit("-"), F.lit(1)))


def first_match(value: Column, rules: list[tuple[str, str]]) -> Column:
    """Label of the first rule whose text occurs in ``value``; NULL if none does."""
    label = None
    for name, part in rules:
        label = F.when(value.contains(part), name) if label is None else label.when(value.contains(part), name)
    return label


def cut_to_length(value: Column, limit: int, unit: str = "chars") -> Column:
    """Cut text to ``limit`` characters, or to whole characters within ``limit`` UTF-8 bytes."""
    if unit == "chars":
        return F.left(value, F.lit(limit))
    if unit != "bytes":
        raise ValueError("unit is 'chars' or 'bytes'")
    raw = F.encode(value, "UTF-8")

    def starts_character(position: int) -> Column:
        byte = F.substring(raw, position, 1)
        return ~byte.between(F.unhex(F.lit("80")), F.unhex(F.lit("BF")))

    # a UTF-8 character has at most four bytes, so a cut falls within the last four
    keep = F.lit(max(limit - 3, 0))
    for size in range(max(limit - 2, 0), limit + 1):
        keep = F.when(starts_character(size + 1), size).otherwise(keep)
    cut = F.substring(raw, F.lit(1), keep).cast("string")
    return F.when(F.octet_length(value) <= limit, value).otherwise(cut)


def too_long(value: Column, limit: int, unit: str = "chars") -> Column:
    size = F.octet_length(value) if unit == "bytes" else F.length(value)
    return size > limit


def percent_text(value: Column) -> Column:
    """One decimal and a percent sign."""
    return F.format_string("%.1f%%", value)
