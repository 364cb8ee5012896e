"""Token ids of whole texts in Parquet files that can be read selectively.

File format: one row per document in ascending ``doc_id`` order (nulls first; rows of one id by text), columns

* ``doc_id``, ``n_tokens``, ``start_in_file`` - plain integers, delta encoded (format version 2 pages),
* ``token_ids`` - list of 32-bit ids, dictionary encoded: a vocabulary of 50,000 ids needs 16 bits an id,
* ``shard`` - number of the file's range of ids.

Row groups are limited in bytes and pages in rows; Parquet's column and offset indexes are written with each file, so a
reader of some documents touches only the pages that hold them, and a reader of metadata never touches ``token_ids``.
Where each document starts in the whole corpus is ``start_in_file`` plus what all earlier files hold, which needs only
one number per file.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasloom.llm.common import documents, texts

ROW_GROUP_BYTES = 64 << 20
PAGE_ROWS = 2_000
MEMO_ENTRIES = 1_000_000
SLICE_BYTES = 4 << 20
KEY_BYTES = 16
END_ID = 0

_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PAIRS = ("  ", " \n", "\n ", "\n\n")
#: Masks for the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], "<u8")
_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")


#: Words of Latin letters, which any version of Unicode knows, and a stop: one or two pre-tokens.
_WORD_AND_STOP = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([,.]?)")


def _byte_characters() -> dict[int, str]:
    """The character that byte-level tokenizers write for each byte: printable ones stay, the others follow from U+0100 on."""
    stay = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)}
    moved = iter(range(0x100, 0x200))
    return {b: chr(b) if b in stay else chr(next(moved)) for b in range(256)}


_BYTE_CHARS = _byte_characters()
_SPACE_CHAR, _LINE_FEED_CHAR = _BYTE_CHARS[0x20], _BYTE_CHARS[0x0A]


def _plain(text: str) -> bool:
    """Only single spaces and line feeds, none at an end, and no null character."""
    return not ("\0" in text or text[:1].isspace() or text[-1:].isspace() or any(p in text for p in _PAIRS) or _OTHER_SPACE.search(text))


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library, with a bounded memory of encoded pieces.

    Such a tokenizer encodes pre-tokens one by one, and a single space between two other characters always begins a
    pre-token, as a single line feed between two is one of its own. Texts are cut before these, in their bytes, by numpy. Pieces of up to
    ``KEY_BYTES`` bytes are keys of that width; Arrow tells the distinct ones of some megabytes of text and finds them
    among those met before, ids are gathered by the keys' places, and Python sees only keys never met. Longer pieces are
    encoded anew in each slice. A text with neighbouring white space is cut only where a space stands between two other characters.
    """

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = Tokenizer(self.tokenizer.model)
        self.entries = memo_entries
        self.keys = np.zeros(0, f"S{KEY_BYTES}")
        self.ends = np.zeros(1, "int64")  # where the ids of each key end; a key's begin where those of the one before end
        self.ids = np.zeros(0, "<u4")
        self.line_feed = self._one("\n")
        self.line_feed_id = int(np.frombuffer(self.line_feed, "<u4")[0])

    def _one(self, piece: str) -> bytes:
        return np.asarray(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def _split(self, ids: np.ndarray) -> list[bytes]:
        ends = np.append(np.flatnonzero(ids == self.line_feed_id), len(ids)) * 4
        data, begins = ids.tobytes(), np.concatenate([[0], ends[:-1] + 4])
        return [data[i:j] for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]

    def _words(self, words: list[re.Match]) -> list[bytes]:
        """Ids of words with a space before and perhaps a stop behind, given to the model as the pre-tokens that they are."""
        parts: list[str] = []
        for word in words:
            letters, stop = word.groups()
            parts.append(_SPACE_CHAR + (letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_CHARS)))
            if stop:
                parts.append(stop)
            parts.append(_LINE_FEED_CHAR)
        found = self.model.encode_batch_fast([parts[:-1]], is_pretokenized=True, add_special_tokens=False)
        return self._split(np.asarray(found[0].ids, "<u4"))

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without line feeds or white space at their ends: encoded as the lines of one text."""
        return self._split(np.asarray(self.tokenizer.encode_batch_fast(["\n".join(pieces)], add_special_tokens=False)[0].ids, "<u4"))

    def _encoded_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces: words after a space, what begins a line, other pieces of a line, and pieces with more white space."""
        found: dict[str, bytes] = {}
        words, lines, begins = [], [], []
        for k in pieces:
            if k[:1] == " " and (word := _WORD_AND_STOP.fullmatch(k, 1)):
                words.append(word)
            elif not k or k[-1].isspace() or "\n" in k[1:]:
                found[k] = self._one(k)
            elif k[0] == "\n" and not k[1].isspace():
                begins.append(k)
            elif k[0] == " " or not k[0].isspace():
                lines.append(k)
            else:
                found[k] = self._one(k)
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            found.update(zip((w.string for w in part), self._words(part), strict=True))
        for at in range(0, len(lines), 4096):
            part = lines[at:at + 4096]
            found.update(zip(part, self._lines(part), strict=True))
        for at in range(0, len(begins), 4096):
            part = begins[at:at + 4096]
            found.update(zip(part, (self.line_feed + x for x in self._lines([k[1:] for k in part])), strict=True))
        return [found[k] for k in pieces]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        """Places of distinct keys in the memory, where new ones are added; a full memory gives up its older half before."""
        if len(self.keys) > self.entries:
            half = len(self.keys) // 2
            self.ids = self.ids[self.ends[half]:].copy()
            self.ends = self.ends[half:] - self.ends[half]
            self.keys = self.keys[half:].copy()
        places = pc.index_in(_fixed(keys), value_set=_fixed(self.keys)).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.isnan(places)) if places.dtype.kind == "f" else np.zeros(0, "int64")
        if len(new):
            places[new] = np.arange(len(self.keys), len(self.keys) + len(new))
            made = self._encoded_pieces([k.decode() for k in keys[new].tolist()])
            sizes = np.fromiter((len(x) >> 2 for x in made), "int64", len(made))
            self.keys = np.concatenate([self.keys, keys[new]])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(made), "<u4")])
        return places.astype("int64")

    def _plain_ids(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, one after the other, and where each text's begin and end."""
        raw = [text.encode() for text in batch]
        offsets = np.cumsum([0, *map(len, raw)], dtype="int64")
        data = np.frombuffer(b"".join(raw) + bytes(KEY_BYTES), "u1")
        size = int(offsets[-1])
        cut = (data[:size] == 0x20) | (data[:size] == 0x0A)
        cut[offsets[:-1][offsets[:-1] < size]] = True
        begins = np.flatnonzero(cut)
        if not len(begins):
            return np.zeros(0, "<u4"), np.zeros(len(batch) + 1, "int64")
        lengths = np.diff(begins, append=size)
        eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (size + 8,), (1,))
        keys = np.empty((len(begins), 2), "<u8")
        keys[:, 0] = eight[begins] & _FIRST_BYTES[np.minimum(lengths, 8)]
        keys[:, 1] = eight[begins + 8 * (lengths > 8)] & _FIRST_BYTES[np.clip(lengths - 8, 0, 8)]
        long = np.flatnonzero(lengths > KEY_BYTES)
        keys[long] = 0  # the key of no piece: pieces have no null characters, and at least one byte
        told = _fixed(keys.view(f"S{KEY_BYTES}").ravel()).dictionary_encode()
        distinct = np.frombuffer(told.dictionary.buffers()[1], f"S{KEY_BYTES}", len(told.dictionary))
        short = np.flatnonzero(distinct != b"")
        places = np.zeros(len(distinct), "int64")
        places[short] = self._known(distinct[short])
        starts, sizes, store = self.ends[:-1][places], np.diff(self.ends)[places], self.ids
        codes = told.indices.to_numpy()
        starts, sizes = starts[codes], sizes[codes]
        if len(long):
            whole = data.tobytes()
            pieces = [whole[i:i + n].decode() for i, n in zip(begins[long].tolist(), lengths[long].tolist(), strict=True)]
            made = dict(zip(kinds := list(dict.fromkeys(pieces)), self._encoded_pieces(kinds), strict=True))
            found = [made[p] for p in pieces]
            sizes[long] = np.fromiter((len(x) >> 2 for x in found), "int64", len(found))
            starts[long] = len(store) + np.cumsum(sizes[long]) - sizes[long]
            store = np.concatenate([store, np.frombuffer(b"".join(found), "<u4")])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        taken = np.repeat(starts - ends[:-1], sizes)
        taken += np.arange(ends[-1])
        return store[taken], ends[np.searchsorted(begins, offsets)]

    def encode_all(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        plain = [_plain(text) for text in batch]
        ids, bounds = self._plain_ids([t for t, p in zip(batch, plain, strict=True) if p])
        if all(plain):
            return ids, np.diff(bounds)
        others = [_BEFORE_WORD.split(t) for t, p in zip(batch, plain, strict=True) if not p]
        kinds = list({piece: None for pieces in others for piece in pieces})
        found = dict(zip(kinds, self._encoded_pieces(kinds), strict=True))
        parts, at, rest = [], 0, iter(others)
        for p in plain:
            if p:
                parts.append(ids[bounds[at]:bounds[at + 1]])
                at += 1
            else:
                parts.append(np.frombuffer(b"".join(map(found.__getitem__, next(rest))), "<u4"))
        return np.concatenate(parts), np.fromiter(map(len, parts), "int64", len(parts))


def _fixed(keys: np.ndarray) -> pa.FixedSizeBinaryArray:
    return pa.Array.from_buffers(pa.binary(KEY_BYTES), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys))])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for each file in a worker, so that what one task learned serves the next."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about ``SLICE_BYTES`` of text at a time; a longer text is a slice of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), "int64")
    number = np.cumsum(sizes) // SLICE_BYTES
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [batch.num_rows]])
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield batch.slice(i, j - i)


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """The ids of each document with the end id behind, their lists and their numbers, a slice of documents at a time."""
    encoder = encoder_of(vocabulary)
    for whole in batches:
        for batch in _sliced(whole) if whole.num_rows else ():
            ids, sizes = encoder.encode_all(list(texts(batch.column("text"))))
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            flat = np.full(ends[-1], end_id, "<i4")
            own = np.ones(len(flat), bool)
            own[ends - 1] = False
            flat[own] = ids.view("<i4")
            offsets = pa.array(np.concatenate([[0], ends]).astype("int32"))
            yield batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(flat)), sizes


def encode(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``token_ids`` with ``end_id`` appended; a null text has the end id alone.

    ``vocabulary`` is the path of a tokenizer file present on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids, sizes in _encoded(batches, vocabulary, end_id):
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(sizes), ids], names=["doc_id", "n_tokens", "token_ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return documents(docs).mapInArrow(run, f"doc_id {kind}, n_tokens long, token_ids array<int>")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write them below ``path`` in the format above.

    Texts, which are smaller than their ids, are dealt by ranges of ``doc_id`` (rows of one id, or null, further by
    text and by where they were read, so that no id fills a task) and encoded where they are written. An empty table gives
    files without rows, repeated rows are all written, and further columns of ``docs``, whatever their names, are not read.
    """
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = documents(docs).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = 0, TaskContext.get().partitionId()
        for doc_id, ids, sizes in _encoded(batches, vocabulary, end_id):
            begin = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(sizes), pa.array(np.full(len(sizes), shard, "int32")), pa.array(begin), ids],
                names=["doc_id", "n_tokens", "shard", "start_in_file", "token_ids"])

    kind = dict(docs.dtypes)["doc_id"]
    out = ordered.mapInArrow(run, f"doc_id {kind}, n_tokens long, shard int, start_in_file long, token_ids array<int>")
    writer = out.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
    for column in ("doc_id", "n_tokens", "start_in_file"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.option("parquet.writer.version", "PARQUET_2_0").option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Documents of token files with ``start``: the ids of all documents before. Filters on ``doc_id`` reach the pages."""
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    # one row per file: bounded by the number of tasks that wrote
    found = stored.join(F.broadcast(offsets), "shard").withColumn("start", F.col("start_in_file") + F.col("offset"))
    return found.select(*(columns or ["doc_id", "start", "n_tokens", "token_ids"]))


def with_checksum(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` as read back, and the CRC-32 of the ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("token_ids")
            flat = np.asarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
            ends = ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), pa.array(np.diff(ends).astype("int64")), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "start", "token_ids").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
