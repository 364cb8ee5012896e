"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Row ``n`` of ``N`` goes to place ``p = permute(n)``; its shard is ``p mod shards`` and its slot ``p div shards``, so the
numbers of rows of two shards differ by one at most. Both can be computed for any row number without the table, and
inverted. The Feistel network works on pairs (left, right) below (a, b) with ``a * b`` just above ``N``; a value that
leaves ``[0, N)`` walks on along its cycle until it is back inside, which keeps the mapping one to one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.operators.positions import number_rows

ROUNDS = 6
_PRIME = 2_147_483_647


def sides(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _mix(value: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number below 2**31 - 1 from each value, the seed and the round; all products fit 63 bits."""
    t = (value % _PRIME * 1_103_515_245 + (seed * 97 + step * 12_345 + 1) % _PRIME) % _PRIME
    t = (t * t + t) % _PRIME
    return (t ^ (t >> 13)) * 69_069 % _PRIME


def _once(value: np.ndarray, a: int, b: int, seed: int) -> np.ndarray:
    left, right = value // b, value % b
    for step in range(0, ROUNDS, 2):
        left = (left + _mix(right, seed, step)) % a
        right = (right + _mix(left, seed, step + 1)) % b
    return left * b + right


def _back(value: np.ndarray, a: int, b: int, seed: int) -> np.ndarray:
    left, right = value // b, value % b
    for step in reversed(range(0, ROUNDS, 2)):
        right = (right - _mix(left, seed, step + 1)) % b
        left = (left - _mix(right, seed, step)) % a
    return left * b + right


def permute(numbers: np.ndarray, rows: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The place of each row number below ``rows`` (or, inverted, the row number of each place)."""
    (a, b), step = sides(rows), _back if inverse else _once
    out = step(np.asarray(numbers, "int64"), a, b, seed)
    while (outside := out >= rows).any():
        out[outside] = step(out[outside], a, b, seed)
    return out


def place(numbered: DataFrame, rows: int, shards: int, seed: int) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows with a global ``row_number``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = permute(batch.column("row_number").to_numpy(), rows, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((places % shards).astype("int32")), pa.array(places // shards)],
                names=[*batch.schema.names, "shard", "slot"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in numbered.dtypes)
    return numbered.mapInArrow(run, f"{kinds}, shard int, slot long")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 2024) -> DataFrame:
    """``doc_id, size, text_crc32, law, row_number, shard, slot, grown_shard`` for every row.

    Rows are numbered by ``doc_id`` (null first), then by checksum and size; equal rows are interchangeable. ``size`` is
    the text's UTF-8 bytes plus 16 (null: 16), ``text_crc32`` of null that of an empty text. Law ``rows``: the numbers
    of rows of two shards differ by one at most, so ``grown_shard`` is null. An empty table gives no rows.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    numbered, rows = number_rows(slim, [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")], "row_number")
    placed = place(numbered, rows, shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")
