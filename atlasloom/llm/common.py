"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasloom.sizing import broadcast_if_small, shared_folder

#: Bytes of rows that Spark hands to a Python worker at once in the pipeline (Spark's default is 64 MB, or 10,000 rows).
BATCH_BYTES = 4 * 1024 * 1024

#: Bytes of words after lower-casing A-Z: digits, a-z and everything outside ASCII; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The lower-cased words of UTF-8 bytes; A-Z only are lower-cased, any byte outside ASCII belongs to a word."""
    return text.translate(_WORD_BYTES).split()


def folder_for(spark: SparkSession, what: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (a temporary one in a local session without it)."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str = "table") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends there and survives lost executors."""
    path = folder_for(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on at most ``BATCH_BYTES`` of rows go to Python at once in this session, or fewer where that is set already.

    Buffers of whole batches are what tasks hold outside the heap, in the executor's JVM and in its Python workers; both keep
    much of what large ones took.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(key).lower())
    bytes_now = int(now[1]) << 10 * " kmg".index(now[2] or " ") if now else 0
    if not 0 < bytes_now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def raw_texts(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column; null counts as empty."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def texts(column: pa.Array) -> Iterator[str]:
    """Each text of an Arrow column; null counts as empty."""
    for value in column:
        yield value.as_py() or ""


def documents(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` and the further columns named; whatever else the table carries is not read."""
    return df.select("doc_id", "text", *more)


def text_key(text: str = "text"):
    """SHA-256 of a text's bytes, null as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def drop_listed(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """``docs`` without the rows whose pair of ``doc_id`` and ``text_key`` is in ``listed``, but with one row of each pair that is ``kept`` there.

    The list (pairs to drop, and pairs that several rows share) goes to the rows, measured before it is broadcast; beyond the limit
    the rows are shuffled once, by hash. Only rows that share a pair have to meet, and are combined before their shuffle.
    """
    tag = f"__{uuid.uuid4().hex[:8]}"
    mark, doc, key, stays = (f"{tag}_{n}" for n in ("mark", "doc_id", "text_key", "kept"))
    pairs = broadcast_if_small(listed.select(F.col("doc_id").alias(doc), F.unhex("text_key").alias(key), F.col("kept").alias(stays)))
    keyed = docs.withColumn(mark, F.unhex(text_key()))
    same = (F.col(mark) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*columns)
    several = keyed.join(pairs.filter(F.col(stays)), same).groupBy(mark, doc).agg(F.min_by(row, F.xxhash64(*columns)).alias("row")).select("row.*")
    return keyed.join(pairs, same, "left_anti").select(*columns).unionByName(several)
