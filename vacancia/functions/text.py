"""Text helpers: slugs, HTML to text, skill text preparation."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.jsontext import literal_map


def keyword_slug(c: Column) -> Column:
    """'QA/QC Engineer' -> 'qa-qc-engineer'."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def archive_slug(c: Column) -> Column:
    """One '-' per character that is neither letter nor digit; 'kw' when nothing is left."""
    s = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "-")
    s = F.regexp_replace(s, "^-+|-+$", "")
    return F.when(s == "", F.lit("kw")).otherwise(s)


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def split_names(c: Column) -> Column:
    """Comma list to trimmed, non-empty names."""
    return F.filter(F.transform(F.split(c, ","), lambda s: strip(s)), lambda s: s != "")


def strip(c: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _entity_value(name: Column) -> Column:
    table = literal_map(name2codepoint | {"apos": 39})
    number = (
        F.when(name.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10).cast("bigint"))
        .when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 7).try_cast("bigint"))
        .otherwise(F.try_element_at(table, name).cast("bigint"))
    )
    # Outside Unicode, and surrogates: leave the entity as it stands.
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, _code_point(number))


def decode_entities(c: Column) -> Column:
    """Decode the entities that occur in the text, '&' itself last so nothing decodes twice."""
    names = F.array_distinct(F.regexp_extract_all(c, F.lit(r"&(#?\w+);"), F.lit(1)))
    pairs = F.filter(
        F.transform(names, lambda n: F.struct(n.alias("n"), _entity_value(n).alias("v"))),
        lambda p: p["v"].isNotNull(),
    )
    first = F.filter(pairs, lambda p: p["v"] != "&")
    last = F.filter(pairs, lambda p: p["v"] == "&")
    decoded = F.aggregate(
        F.concat(first, last),
        c,
        lambda acc, p: F.replace(acc, F.concat(F.lit("&"), p["n"], F.lit(";")), p["v"]),
    )
    return F.when(c.contains("&"), decoded).otherwise(c)


def html_to_text(c: Column) -> Column:
    """Readable text from an HTML fragment, line breaks and bullets kept.

    Works on well-formed markup; a real HTML parser repairs broken nesting
    differently (an unclosed block gets its newline at the parent's end).
    """
    t = F.regexp_replace(c, r"(?is)<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>", "")
    t = F.regexp_replace(t, r"(?i)<\s*br\s*/?\s*>", "\n")
    t = F.regexp_replace(t, r"(?i)<li\b[^>]*>", "- ")
    t = F.regexp_replace(t, r"(?i)</(?:li|p|div|h[1-4]|ul|ol|tr)\s*>", "\n")
    t = F.regexp_replace(t, r"(?s)<[/!?a-zA-Z][^>]*>", "")
    t = decode_entities(t)
    t = F.regexp_replace(t, r"\R", "\n")
    t = F.regexp_replace(t, r"(?U)[^\S\n]+\n", "\n")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    t = strip(t)
    return F.nullif(t, F.lit(""))


def joined_text(*parts: Column) -> Column:
    """Non-blank parts, stripped, joined by a blank line."""
    kept = F.filter(F.array(*[strip(p) for p in parts]), lambda s: F.coalesce(s != "", F.lit(False)))
    return F.array_join(kept, "\n\n")
