"""Clean-up of definitions, abstracts and markup, all as JVM expressions on whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A line holding one of these ends the usable part of an abstract.
STOP_WORDS = ("author", "pmid:", "doi:", "©", "copyright", "affiliat")


def strip(text: Column) -> Column:
    """Whitespace of any kind off both ends (``trim`` takes only blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_definition(text: Column) -> Column:
    """Bracketed citations out, whitespace collapsed, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\[.*?\]", ""), r"(?U)\s+", " "))


def first_definition(*fields: Column) -> Column:
    """First non-empty of several definition fields."""
    return F.coalesce(*[F.when(f != "", f) for f in fields], F.lit(""))


def joined_synonyms(*sources: Column, per_source: int = 3) -> Column:
    none = F.array().cast("array<string>")
    parts = [F.slice(F.coalesce(s, none), 1, per_source) for s in sources]
    return F.array_join(F.concat(*parts), "; ")


def abstract_definition(text: Column, width: int = 300) -> Column:
    """First two long lines not ending in a full stop, before author or identifier lines; null if none.

    The stop line is the first one matching; lines after it are never used.
    """
    lines = F.transform(F.split(text, "\n"), strip)
    stop = F.transform(lines, lambda s: F.lower(s).rlike("|".join(STOP_WORDS)))
    at = F.array_position(stop, True)
    before = F.when(at > 0, F.slice(lines, F.lit(1), F.greatest(at.cast("int") - 1, F.lit(0)))).otherwise(lines)
    kept = F.slice(F.filter(before, lambda s: (F.length(s) > 20) & ~s.endswith(".")), 1, 2)
    joined = F.array_join(kept, " ")
    return F.when(F.size(kept) > 0, F.when(
        F.length(joined) > width, F.concat(F.substring(joined, 1, width), F.lit("..."))).otherwise(joined))


def strip_markup(html: Column, width: int = 500) -> Column:
    """Tags out, trimmed, cut; empty becomes null."""
    plain = F.regexp_replace(html, r"<[^>]+>", "")
    plain = F.substring(strip(plain), 1, width)
    return F.when(plain != "", plain)


def clean_full_text(text: Column) -> Column:
    text = F.regexp_replace(text, r"\n+", "\n")
    text = F.regexp_replace(text, r"(?U)\s{2,}", " ")
    text = F.regexp_replace(text, r"(?U)(\w)\n(\w)", "$1 $2")
    text = F.regexp_replace(text, r"(\.|\;|\:)\n", "$1 ")
    return strip(text)


def extract_section(text: Column, section: str) -> Column:
    """Text from the section name up to the next line starting with a capital."""
    pattern = rf"(?s){section}\s*(.*?)\n[A-Z]"
    found = F.regexp_extract(text, pattern, 1)
    return F.when(text.rlike(pattern), strip(found)).otherwise(
        F.lit(f"Error: {section} section not found."))


def choose_gene_id(hits: Column) -> Column:
    """From an array of ids: the first all-digit one, else the first that is no ``ENSG`` id, else null."""
    usable = F.filter(hits, lambda x: ~x.startswith("ENSG"))
    return F.coalesce(F.get(F.filter(usable, lambda x: x.rlike(r"^\d+$")), F.lit(0)), F.get(usable, F.lit(0)))


def whitespace_tokens(text: Column) -> Column:
    trimmed = strip(text)
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"(?U)\s+")))


def split_symbols(text: Column) -> Column:
    return F.filter(F.split(text, r"[,\s;]+"), lambda s: s != "")

