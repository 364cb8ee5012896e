"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

Texts of more than ``chunk`` characters are cut into chunks that overlap by ``overlap`` characters and are dealt over the
cluster. Each chunk is pre-tokenised on its own. A pre-token depends on nothing before it, so where two neighbours have a
boundary in common inside their overlap they are in step from there on: the left chunk's pieces are used up to the first such
boundary, the right one's after it. Pieces are then encoded on their own and put together by number. A text with
neighbours that never come into step is encoded in one piece from the first such place on. Decoding concatenates the raw
bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlasloom.llm.common import documents, text_key, texts

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 2_048
#: At a chunk's end a pre-token may be cut; a boundary this near to it doesn't count.
UNSURE_CHARS = 4
#: Texts that a task turns into Python objects at once.
TEXTS_AT_ONCE = 512


def load(path: str, pattern: str):
    """The encoding of a file of base64 tokens and ranks, without special tokens."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pack(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def decode(encoding, ids: bytes) -> bytes:
    """The raw bytes of packed ids, one after the other."""
    return encoding.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
        yield batch.slice(at, TEXTS_AT_ONCE)


def _encode_whole(short: DataFrame, path: str, pattern: str, row: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for whole in batches:
            for batch in _slices(whole):
                ids = [pack(encoding.encode_ordinary(t)) for t in texts(batch.column("text"))]
                yield pa.RecordBatch.from_arrays([batch.column(row), pa.array(ids, pa.binary())], names=[row, "ids"])

    return short.select(row, "text").mapInArrow(run, f"{row} {dict(short.dtypes)[row]}, ids binary")


def _cut(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``text_key, k, last, text``: chunk ``k`` of each text with its overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column("text_key"), texts(batch.column("text")), strict=True):
                last = max(0, (len(value) - 1) // chunk)
                for k in range(last + 1):
                    yield pa.RecordBatch.from_pydict(
                        {"text_key": [key.as_py()], "k": pa.array([k], pa.int32()), "last": pa.array([last], pa.int32()),
                         "text": [value[k * chunk:(k + 1) * chunk + overlap]]})

    return long.select("text_key", "text").mapInArrow(run, "text_key string, k int, last int, text string")


def _boundaries(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Starts of pre-tokens in the overlap at each end of a chunk, as positions of the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for k, value in zip(batch.column("k").to_pylist(), texts(batch.column("text")), strict=True):
                starts = [m.start() for m in cut.finditer(value)]
                sure = len(value) - UNSURE_CHARS
                heads.append([k * chunk + s for s in starts if s < overlap])
                tails.append([k * chunk + s for s in starts if chunk <= s < sure])
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), batch.column("k"), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["text_key", "k", "heads", "tails"])

    return chunks.select("text_key", "k", "text").mapInArrow(
        run, "text_key string, k int, heads array<bigint>, tails array<bigint>")


def _stitched(bounds: DataFrame) -> DataFrame:
    """``text_key, k, piece, begin, end``: the piece each chunk belongs to; a piece begins where two chunks come into step.

    The window orders the chunks of one text, of which there are as many as the text is long.
    """
    by = Window.partitionBy("text_key").orderBy("k")
    met = F.array_min(F.array_intersect(F.lag("tails").over(by), F.col("heads")))
    at = F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(met)
    starts = bounds.select("text_key", "k", at.alias("begin"))
    lost = F.max(F.col("begin").isNull().cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    usable = starts.withColumn("begin", F.when(lost == 0, F.col("begin")))
    numbered = usable.withColumn("piece", (F.count("begin").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1).cast("int"))
    after = numbered.withColumn("end", F.lead("begin").over(by))
    return after.select("text_key", "k", "piece", "begin", "end")


def _encode_pieces(chunks: DataFrame, pieces: DataFrame, path: str, pattern: str, chunk: int) -> DataFrame:
    def whole_piece(frame: pd.DataFrame) -> str:
        frame = frame.sort_values("k")
        value = "".join([*(t[:chunk] for t in frame["text"].iloc[:-1]), frame["text"].iloc[-1]])
        first, begin, end = int(frame["k"].iloc[0]) * chunk, int(frame["begin"].iloc[0]), frame["end"].iloc[-1]
        return value[begin - first:None if pd.isna(end) else int(end) - first]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids = pack(_encoding_of(path, pattern).encode_ordinary(whole_piece(frame)))
        return pd.DataFrame({"text_key": [key[0]], "piece": [key[1]], "ids": [ids]})

    joined = chunks.join(pieces, ["text_key", "k"])
    return joined.groupBy("text_key", "piece").applyInPandas(run, "text_key string, piece int, ids binary")


_LOADED: dict[tuple[str, str], object] = {}


def _encoding_of(path: str, pattern: str):
    """One encoding for each file in a worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = load(path, pattern)
    return _LOADED[path, pattern]


def _put_together(parts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one long text at a time
                pieces = sorted(batch.column("parts")[row].as_py(), key=lambda p: p["piece"])
                ids = b"".join(p["ids"] for p in pieces)
                yield pa.RecordBatch.from_arrays([batch.column("text_key").slice(row, 1), pa.array([ids], pa.binary())], names=["text_key", "ids"])

    gathered = parts.groupBy("text_key").agg(F.collect_list(F.struct("piece", "ids")).alias("parts"))
    return gathered.mapInArrow(run, "text_key string, ids binary")


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers, one binary) for every row of ``docs``.

    Null and empty texts have no ids. Each distinct long text is encoded once, whatever the number of its rows.
    ``path`` is a file of ranks present on every executor.
    """
    docs = documents(docs)
    size = F.length(F.coalesce("text", F.lit("")))
    short = _encode_whole(docs.filter(size <= chunk), path, pattern, "doc_id")
    long = docs.filter(size > chunk).withColumn("text_key", text_key())
    distinct = long.groupBy("text_key").agg(F.first("text").alias("text"))
    chunks = _cut(distinct, chunk, overlap).repartition("text_key", "k")
    pieces = _stitched(_boundaries(chunks, pattern, chunk, overlap))
    encoded = _put_together(_encode_pieces(chunks, pieces, path, pattern, chunk))
    return short.unionByName(long.select("doc_id", "text_key").join(encoded, "text_key").select("doc_id", "ids"))


def digest(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded documents; the ids are decoded again for the last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for whole in batches:
            for batch in _slices(whole):
                ids = batch.column("ids").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                     pa.array([hashlib.sha256(decode(encoding, x)).hexdigest() for x in ids])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
