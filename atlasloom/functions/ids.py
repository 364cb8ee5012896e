"""Hashes and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(seed: int | str, key: Column | str) -> Column:
    """``md5(seed || ':' || key)``: the random order used everywhere, the same on any partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stable_numeric_id(text: Column | str) -> Column:
    """First four bytes of the MD5 as an unsigned big-endian number."""
    text = F.col(text) if isinstance(text, str) else text
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_fraction(seed: int | str, key: Column | str) -> Column:
    """A repeatable number in [0, 1) from the leading 32 bits of the seeded hash."""
    return F.conv(F.substring(seeded_md5(seed, key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_bucket(seed: int | str, key: Column | str, n: int) -> Column:
    """A repeatable index in [0, n) from the trailing 32 bits of the seeded hash."""
    return (F.conv(F.substring(seeded_md5(seed, key), 25, 8), 16, 10).cast("bigint") % n).cast("int")


def strip_version(gene_id: Column | str) -> Column:
    return F.substring_index(F.col(gene_id) if isinstance(gene_id, str) else gene_id, ".", 1)


def is_gene_accession(gene_id: Column) -> Column:
    return F.coalesce(gene_id.startswith("ENS"), F.lit(False))
