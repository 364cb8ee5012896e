"""Exact duplicates by exchange of Golomb-coded fingerprints.

1. Every row gets a 64-bit hash of its normalised text. Each partition (sender) sorts the leading bits that the number
   of rows asks for and sends, to the owner of each range of values, one Golomb-Rice coded list of differences.
2. An owner decodes its lists, sees which values occur more than once, and answers each sender with one bitmap.
3. Senders lay the bitmaps over their sorted values. Rows without a mark are unique. The others are suspects: their
   texts alone are grouped byte by byte, which settles which rows are copies.

Texts are equal when identical after replacing each run of white space (space, U+0009 to U+000D) by one space; null counts as empty.
Of equal texts the row with the smallest ``doc_id`` stays (null only if all are null; of several rows with that id, one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import written
from atlasloom.sizing import broadcast_if_small

#: Fingerprint bits beyond those of the number of rows: of unequal rows one in 2**12 is a suspect.
SPARE_BITS = 12
ROWS_PER_OWNER = 2_000_000


def normalised(text: str = "text") -> Column:
    # only runs that change are matched; single spaces are left alone
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


# --- Golomb-Rice code --------------------------------------------------------


def rice_parameter(count: int, span: int) -> int:
    """Bits kept as they are of each difference when ``count`` values are spread over ``span``."""
    mean = max(1.0, span / max(1, count))
    return max(0, int(np.log2(mean * np.log(2)))) if mean > 1.5 else 0


def encode_sorted(values: np.ndarray, k: int) -> bytes:
    """Differences of sorted values: the quotient by ``2**k`` in unary, closed by a 0, then ``k`` bits of remainder."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.zeros(1, values.dtype))
    quotient = (steps >> k).astype("int64")
    sizes = quotient + 1 + k
    ends = np.cumsum(sizes)
    bits = np.zeros(int(ends[-1]), "uint8")
    starts = ends - sizes
    # ones of the unary part: +1 where it starts, -1 where it ends
    change = np.zeros(len(bits) + 1, "int32")
    np.add.at(change, starts, 1)
    np.add.at(change, starts + quotient, -1)
    bits[:] = np.cumsum(change[:-1])
    rest = steps & ((1 << k) - 1)
    for bit in range(k):
        bits[ends - 1 - bit] = (rest >> bit) & 1
    return np.packbits(bits).tobytes()


def decode_sorted(code: bytes, count: int, k: int) -> np.ndarray:
    """The ``count`` values that ``encode_sorted`` wrote."""
    bits = np.unpackbits(np.frombuffer(code, "uint8"))
    zeros = np.flatnonzero(bits == 0)
    quotient, at = np.zeros(count, "int64"), 0
    places = np.zeros(count, "int64")
    for i in range(count):
        end = zeros[np.searchsorted(zeros, at)]
        quotient[i] = end - at
        places[i] = end + 1
        at = end + 1 + k
    rest = np.zeros(count, "int64")
    for bit in range(k):
        rest = (rest << 1) | bits[places + bit]
    return np.cumsum((quotient << k) | rest)


# --- exchange ----------------------------------------------------------------


def _owner_of(values: np.ndarray, bits: int, owners: int) -> np.ndarray:
    return (values >> max(0, bits - 31)) * owners >> min(bits, 31)


def _coded(prints: DataFrame, bits: int, owners: int) -> DataFrame:
    """``sender, owner, n, k, code``: sorted fingerprints of one sender for one owner."""
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(frame["print"].to_numpy("int64"))
        to = _owner_of(values, bits, owners)
        rows = []
        for owner in np.unique(to):
            part = values[to == owner]
            lowest = int(part[0])
            k = rice_parameter(len(part), int(part[-1]) - lowest + 1)
            rows.append((key[0], int(owner), len(part), k, lowest, encode_sorted(part - lowest, k)))
        return pd.DataFrame(rows, columns=["sender", "owner", "n", "k", "lowest", "code"])

    return prints.select("sender", "print").groupBy("sender").applyInPandas(run, "sender long, owner int, n int, k int, lowest long, code binary")


def _answers(coded: DataFrame) -> DataFrame:
    """``sender, owner, n, marks``: a bitmap over a sender's sorted fingerprints, 1 where the value occurs more than once."""
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        lists = [decode_sorted(c, n, k) + low for c, n, k, low in zip(frame["code"], frame["n"], frame["k"], frame["lowest"], strict=True)]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        many = values[counts > 1]
        marks = [np.packbits(np.isin(x, many)).tobytes() for x in lists]
        return pd.DataFrame({"sender": frame["sender"], "owner": frame["owner"], "n": frame["n"], "marks": marks})

    return coded.groupBy("owner").applyInPandas(run, "sender long, owner int, n int, marks binary")


def _suspects(prints: DataFrame, answers: DataFrame) -> DataFrame:
    """The hashes of rows whose fingerprint another row has too, each once for a sender."""
    def run(rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("print", kind="stable")
        bitmaps = bitmaps.sort_values("owner")
        marks = [np.unpackbits(np.frombuffer(m, "uint8"), count=n) for m, n in zip(bitmaps["marks"], bitmaps["n"], strict=True)]
        marked = np.concatenate(marks).astype(bool) if marks else np.zeros(len(rows), bool)
        return pd.DataFrame({"hash": rows["hash"].to_numpy()[marked]}).drop_duplicates()

    by = prints.select("sender", "print", "hash").groupBy("sender")
    return by.cogroup(answers.groupBy("sender")).applyInPandas(run, "hash long").distinct()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_sha256, hash, sender`` of every row, written to the shared folder: senders stay as they are."""
    body = normalised().cast("binary")
    return written(docs.select("doc_id", F.sha2(body, 256).alias("text_sha256"), F.xxhash64(body).alias("hash"),
                               F.spark_partition_id().cast("long").alias("sender")), "fingerprints")


def suspect_hashes(prints: DataFrame, owners: int | None = None) -> DataFrame:
    """Distinct 64-bit hashes that may belong to several rows, by the exchange described above."""
    rows = prints.count()
    bits = min(62, max(16, rows.bit_length() + SPARE_BITS))
    owners = owners or max(8, -(-rows // ROWS_PER_OWNER))
    leading = F.shiftrightunsigned(F.col("hash"), 64 - bits)
    prints = prints.withColumn("print", leading)
    return _suspects(prints, _answers(_coded(prints, bits, owners)))


def groups(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row; of repeated equal rows with the kept id all are marked kept."""
    prints = fingerprints(docs)
    verified = _verified(docs, written(suspect_hashes(prints, owners), "suspects"))
    found = prints.join(verified, ["hash", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def _verified(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """Groups of suspects whose bytes are the same: grouped by the text itself, combined before the shuffle."""
    body = normalised()
    rows = docs.select("doc_id", body.alias("body")).withColumn("hash", F.xxhash64(F.col("body").cast("binary")))
    same = rows.join(suspects, "hash").groupBy("hash", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return same.select("hash", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts with all its columns; see ``groups`` for which.

    The groups of copies (two numbers a group, not texts) go to the rows, measured before they are broadcast; beyond the limit Spark joins by
    hash. Only rows that share both text and the kept id have to meet: whole rows of those alone are shuffled.
    """
    verified = written(_verified(docs, written(suspect_hashes(fingerprints(docs)), "suspects")).filter("group_size > 1"), "copies")
    body = normalised().cast("binary")
    tag = "__copies"
    many = broadcast_if_small(verified.select(F.col("hash").alias(f"{tag}_hash"), F.col("text_sha256").alias(f"{tag}_sha"), F.col("keep_id").alias(f"{tag}_id")))
    keyed = docs.withColumn(tag, F.struct(F.xxhash64(body).alias("hash"), F.sha2(body, 256).alias("sha")))
    same = (F.col(f"{tag}.hash") == F.col(f"{tag}_hash")) & (F.col(f"{tag}.sha") == F.col(f"{tag}_sha"))
    found = keyed.join(many, same, "left").filter(F.col(f"{tag}_hash").isNull() | F.col("doc_id").eqNullSafe(F.col(f"{tag}_id")))
    # texts whose kept id has several rows: as a rule none
    again = broadcast_if_small(written(found.filter(F.col(f"{tag}_hash").isNotNull()).groupBy(f"{tag}_sha").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(f"{tag}_sha").alias(f"{tag}_again")), "again"))
    marked = found.join(again, F.col(f"{tag}_sha") == F.col(f"{tag}_again"), "left")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = marked.filter(F.col(f"{tag}_again").isNotNull()).groupBy(f"{tag}_sha").agg(F.min_by(row, F.xxhash64(row)).alias("row")).select("row.*")
    return marked.filter(F.col(f"{tag}_again").isNull()).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(one)


GROUPS_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)"""
