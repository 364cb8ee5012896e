"""Token files, byte pairs and shards against plain encoding and counting."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from atlasloom.llm import byte_pairs, shards, token_files
from atlasloom.llm.queries import BYTE_BPE, MULTILINGUAL_BPE, PATTERN

PIECES = st.lists(st.sampled_from(["word", "Word,", "it's", " ", "  ", "\n", "\t", "12", "été.", "日本", "\xa0", "\x1c", "<|endoftext|>", "!?", "don't "]), max_size=30)


def plain(texts: list[str]) -> list[list[int]]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_token_files(spark, odd_documents, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(odd_documents, path, BYTE_BPE)
    got = token_files.with_checksum(token_files.read_tokens(spark, path)).collect()
    want = Counter()
    texts = [(r["doc_id"], r["text"] or "") for r in odd_documents.collect()]
    for (doc, _), ids in zip(texts, plain([t for _, t in texts]), strict=True):
        want[doc, len(ids) + 1, zlib.crc32(np.asarray([*ids, 0], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [sum(x["n_tokens"] for x in ordered[:i]) for i in range(len(ordered))]
    assert [r["doc_id"] or -1 for r in ordered] == sorted(r["doc_id"] or -1 for r in ordered)


def test_token_files_are_selective(spark, odd_documents, tmp_path):
    path = tmp_path / "tokens"
    token_files.write_tokens(odd_documents, str(path), BYTE_BPE)
    found = [pq.ParquetFile(f) for f in path.glob("*.parquet")]
    group = next(f for f in found if f.metadata.num_rows).metadata.row_group(0)
    by_name = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert all(c.has_offset_index and c.has_column_index for c in by_name.values())
    assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
    assert any("DICTIONARY" in e for e in next(c for n, c in by_name.items() if n.startswith("token_ids")).encodings)
    plan = spark.read.parquet(str(path)).filter("doc_id = 5").select("doc_id")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,5)" in plan


def test_no_documents(spark, no_documents, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(no_documents, path, BYTE_BPE)
    assert token_files.with_checksum(token_files.read_tokens(spark, path)).count() == 0
    assert byte_pairs.digest(byte_pairs.encode(no_documents, MULTILINGUAL_BPE, PATTERN), MULTILINGUAL_BPE, PATTERN).count() == 0
    assert shards.shard_documents(no_documents).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(PIECES.map("".join), max_size=5))
def test_encoder_equals_the_library(texts):
    assert _by_text(token_files.encoder_of(BYTE_BPE), texts) == plain(texts)


def _by_text(encoder, texts):
    ids, sizes = encoder.encode_all(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if len(texts) else []


def test_encoder_long_pieces_and_null_characters():
    texts = ["a" * 15, "a " + "b" * 15 + " " + "b" * 16 + " " + "b" * 17, "", "x\0 y", "x \0", "", "naïve " * 3 + "ü" * 9, "donaudampfschifffahrt, \nagain donaudampfschifffahrt,"]
    encoder = token_files.Encoder(BYTE_BPE)
    assert _by_text(encoder, texts) == plain(texts) == _by_text(encoder, texts)


def test_encoder_forgets():
    small = token_files.Encoder(BYTE_BPE, memo_entries=3)
    texts = ["one two three, four", "five six seven eight", "one two three, four"]
    assert [small.encode_all([t])[0].tolist() for t in texts] == plain(texts)
    assert len(small.keys) < 8


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 2_048), (64, 32), (7, 5)])
def test_byte_pairs(odd_documents, chunk, overlap):
    docs = odd_documents if chunk > 1000 else odd_documents.filter("length(text) < 60000 OR text IS NULL").withColumn("text", F.substring("text", 1, 600))
    encoding = byte_pairs.load(MULTILINGUAL_BPE, PATTERN)
    want = Counter()
    for r in docs.collect():
        ids = byte_pairs.pack(encoding.encode_ordinary(r["text"] or ""))
        want[r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    got = byte_pairs.digest(byte_pairs.encode(docs, MULTILINGUAL_BPE, PATTERN, chunk, overlap), MULTILINGUAL_BPE, PATTERN)
    assert Counter(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("rows", [1, 2, 3, 40, 41, 1000, 4097])
def test_permutation(rows):
    numbers = np.arange(rows)
    places = shards.permute(numbers, rows, 3)
    assert sorted(places) == list(range(rows))
    assert (shards.permute(places, rows, 3, inverse=True) == numbers).all()
    if rows > 100:
        assert abs(np.corrcoef(numbers, places)[0, 1]) < 0.1


def test_shards(odd_documents):
    got = shards.shard_documents(odd_documents, 4).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in odd_documents.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    again = shards.shard_documents(odd_documents.repartition(5), 4).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
