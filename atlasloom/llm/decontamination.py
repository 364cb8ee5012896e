"""Benchmark passages in documents, found by Wu-Manber search over words.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window. Windows
of one length share a shift table over blocks of consecutive words: how far the search may move on when it meets a block.
Where the shift is zero, the window's last block selects the windows to test, whose first words and then all words are compared.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import documents, raw_texts, words_of

WINDOW = 10
BLOCK = 3
MAX_TABLE_BYTES = 64 << 20

Window = tuple[bytes, ...]


class WuManber:
    """All windows of one length, in words."""

    def __init__(self, length: int, windows: dict[Window, frozenset]):
        self.length, self.block = length, min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[Window, int] = {}
        self.buckets: dict[Window, list[tuple[Window, frozenset]]] = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                block = window[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.default), length - end)
            self.buckets[window[length - self.block:]].append((window, items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, frozenset]]:
        """Where each window begins in ``words``, and the items that have it."""
        end, last, block, shift = self.length, len(words), self.block, self.shift
        while end <= last:
            key = tuple(words[end - block:end])
            move = shift.get(key, self.default)
            if move:
                end += move
                continue
            begin = end - self.length
            for window, items in self.buckets[key]:
                if words[begin] == window[0] and tuple(words[begin:end]) == window:
                    yield begin, items
            end += 1


def compile_windows(rows: list[tuple[object, bytes]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[Window, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in rows:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[at:at + size])].add(item)
    return [WuManber(n, {w: frozenset(i) for w, i in found.items()}) for n, found in sorted(by_length.items())]


def hits(words: list[bytes], tables: list[WuManber]) -> tuple[set[int], set]:
    """Positions of words inside any occurrence, and the items found."""
    inside: set[int] = set()
    items: set = set()
    for table in tables:
        for begin, found in table.occurrences(words):
            inside.update(range(begin, begin + table.length))
            items |= found
    return inside, items


def benchmark_blocks(benchmark: DataFrame, max_bytes: int = MAX_TABLE_BYTES) -> list[list[tuple[object, bytes]]]:
    """Items in blocks of ``max_bytes`` of text, read one block after the other; items without text have no window.

    The benchmark is a stated query set; a block is what one search table may hold in a worker.
    """
    blocks: list[list[tuple[object, bytes]]] = [[]]
    held = 0
    for item, text in benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct().toLocalIterator():
        body = text.encode()
        if held + len(body) > max_bytes and blocks[-1]:
            blocks, held = [*blocks, []], 0
        blocks[-1].append((item, body))
        held += len(body)
    return blocks


def _match(docs: DataFrame, rows: list[tuple[object, bytes]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)  # at most MAX_TABLE_BYTES of text, see benchmark_blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = compile_windows(shared.value, window)
        for batch in batches:
            out = {"n_words": [], "hit_positions": [], "item_ids": []}
            for text in raw_texts(batch.column("text")):
                words = words_of(text)
                inside, items = hits(words, tables)
                out["n_words"].append(len(words))
                out["hit_positions"].append(sorted(inside))
                out["item_ids"].append(sorted(str(i) for i in items))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["hit_positions"], pa.list_(pa.int32())), pa.array(out["item_ids"], pa.list_(pa.string()))],
                names=["doc_id", *out])

    kind = dict(docs.dtypes)["doc_id"]
    return documents(docs).mapInArrow(run, f"doc_id {kind}, n_words long, hit_positions array<int>, item_ids array<string>")


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_TABLE_BYTES) -> DataFrame:
    """``doc_id, n_words, hit_positions, item_ids`` for every row of ``docs``.

    Null and wordless texts have no words and no hits; an empty benchmark hits nothing; repeated rows are matched each.
    A benchmark of several blocks is searched block by block; what the blocks find of one text is put together.
    """
    blocks = benchmark_blocks(benchmark, max_bytes)
    if len(blocks) == 1:
        return _match(docs, blocks[0], window)
    numbered = docs.select("doc_id", "text").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = numbered.withColumn("key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    parts = [_match(keyed.select(F.struct("doc_id", "key", "copies").alias("doc_id"), "text"), rows, window) for rows in blocks]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = union.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_positions")))).alias("hit_positions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    return merged.select(F.col("doc_id.doc_id").alias("doc_id"), "n_words", "hit_positions", "item_ids",
                         F.explode(F.sequence(F.lit(1), F.col("doc_id.copies").cast("int"))).alias("copy")).drop("copy")


def digest(matches: DataFrame) -> DataFrame:
    ids = F.array_join("item_ids", ",")
    n = F.size("hit_positions").cast("long")
    return matches.select("doc_id", "n_words", n.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                          F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (n > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_TABLE_BYTES) -> DataFrame:
    """Rows of ``docs``, all columns as they are, without any benchmark window; tested one block after the other."""
    for rows in benchmark_blocks(benchmark, max_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables = compile_windows(shared.value, window)
            for batch in batches:
                clean = [not any(True for t in tables for _ in t.occurrences(w))
                         for w in map(words_of, raw_texts(batch.column("text")))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


# --- SQL of the digest -------------------------------------------------------

DIGEST_SQL = rf"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
item AS (SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM (
    SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM item WHERE len(w) > 0)),
cand AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS key FROM (
    SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc CROSS JOIN (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
found AS (SELECT rid, c.n, i, item_id FROM cand c JOIN win USING (n, key)),
word AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM found) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (rid) LEFT JOIN items USING (rid)"""
