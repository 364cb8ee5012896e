"""Near duplicates by ProbMinHash over weighted shingles of five words.

A text's shingles weigh ``1 + ln(times it occurs)``. Each shingle is a Poisson process whose rate is its weight: arrivals
come at exponential gaps and each names one of ``REGISTERS`` registers, which keeps the earliest arrival it has seen. The
registers of two texts agree with the probability Jaccard similarity of their weights. Arrivals of a shingle stop mattering once
they are later than every register, so most shingles are left after their first. Registers are banded; texts that share
a band are candidates, and the similarity of candidates is computed from their words.

Rows with the same words are one text from the start. Texts are compared with the leaders of their buckets and links are
joined into classes; whatever then still stands in a bucket with other classes is compared with all texts that share one of its
rarest shingles, which any similar text does. So no
candidate of two classes is left untested, and a bucket of copies costs as many comparisons as it has texts.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasloom.llm.common import documents, drop_listed, raw_texts, words_of, written
from atlasloom.sizing import broadcast_if_small

WORDS = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 a pair shares no band with probability (1 - 0.8**5)**26 = 3e-5.
BANDS, BAND_ROWS = 26, 5
REGISTERS = BANDS * BAND_ROWS
SHINGLES_AT_ONCE = 200_000
#: Bytes of words that a task hands on in one batch, if they are of more than one text.
WORD_BYTES_AT_ONCE = 4_000_000
#: 64-bit words of the bitmap that tells how many shingles of a text another one lacks at least, and bits of one of its places.
BITMAP_WORDS, BITMAP_DEPTH = 32, 2
#: Texts with one shingle that a task compares with each other; of more, each two blocks meet in a task.
MEETING_BLOCK = 2000
#: Pairs of texts that a task looks at together, and of those the pairs of bitmaps.
PAIRS_AT_ONCE, BITMAPS_AT_ONCE = 200_000, 20_000

_GOLDEN, _64_BITS = 0x9E3779B97F4A7C15, (1 << 64) - 1


def shingles(words: list[bytes], n: int = WORDS) -> Counter:
    """Runs of ``n`` words and how often each occurs; fewer words are one shingle, none have none."""
    if len(words) < n:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*[words[i:] for i in range(n)], strict=False))


def weight(times: int) -> float:
    return 1.0 + math.log(times)


def similarity(a: Counter, b: Counter) -> float:
    """Probability Jaccard: over shared shingles, the chance that one is the first arrival of both texts."""
    wa = {s: weight(c) for s, c in a.items()}
    wb = {s: weight(c) for s, c in b.items()}
    shared = wa.keys() & wb.keys()
    if not shared:
        return 0.0
    # for a shared shingle of ratio r, shingles of at least that ratio count by a's weights, the others by b's
    at_ratio: dict[float, list[float]] = {}
    for s in shared:
        sums = at_ratio.setdefault(wa[s] / wb[s], [0.0, 0.0])
        sums[0] += wa[s]
        sums[1] += wb[s]
    above = sum(wa.values())
    below = sum(w for s, w in wb.items() if s not in shared)
    total = 0.0
    for r in sorted(at_ratio):
        of_a, of_b = at_ratio[r]
        total += of_a / (above + r * below)
        above -= of_a
        below += of_b
    return total


# --- signatures --------------------------------------------------------------


def _draw(keys: np.ndarray, step: int) -> np.ndarray:
    """One 64-bit number for each key and step (SplitMix64)."""
    z = keys + np.uint64(_GOLDEN * (step + 1) & _64_BITS)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def signatures(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """For each text the key of the earliest arrival at each register. All texts advance together, one arrival at a step.

    ``keys`` and ``weights`` are those of all shingles, ``owner`` the text of each. A text without shingles has zeros.
    """
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, "uint64")
    live, now, step = np.arange(len(keys)), np.zeros(len(keys)), 0
    while len(live):
        bits = _draw(keys[live], step)
        gap = -np.log1p(-((bits >> np.uint64(11)).astype("float64") * 2.0**-53))
        now[live] += gap / weights[live]
        place = owner[live] * registers + (_draw(bits, 7) % np.uint64(registers)).astype("int64")
        better = now[live] < first[place]
        place, who = place[better], live[better]
        # later assignments win, so the earliest arrival of each place is written last
        order = np.argsort(-now[who], kind="stable")
        place, who = place[order], who[order]
        first[place] = now[who]
        winner[place] = keys[who]
        last = first.reshape(texts, registers).max(axis=1)
        live = live[now[live] < last[owner[live]]]
        step += 1
    return winner.reshape(texts, registers)


def bands(signature: np.ndarray, per_band: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit number for each band of each text."""
    parts = signature.reshape(len(signature), -1, per_band)
    out = np.broadcast_to(np.arange(parts.shape[1], dtype="uint64"), parts.shape[:2]).copy()
    for i in range(per_band):
        out = _draw(out ^ parts[:, :, i], i)
    return out.view("int64")


def _shingle_keys(words: list[bytes], seen: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of a text's shingles and how often each occurs."""
    ids = np.fromiter(map(seen.__getitem__, words), "uint64", len(words))
    n = min(WORDS, len(ids))
    mixed = np.zeros(len(ids) - n + 1 if n else 0, "uint64")
    for i in range(n):
        mixed = _draw(mixed ^ ids[i:len(ids) - n + 1 + i], i)
    return np.unique(mixed, return_counts=True)


class _WordKeys(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, words_key, bands`` of every row; null as empty. A text without words has no bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _WordKeys()

        def signatures_of(pending: list) -> list:
            full = [p for p in pending if len(p[3])]
            if not full:
                return [None] * len(pending)
            owner = np.repeat(np.arange(len(full)), [len(p[3]) for p in full])
            weights = 1.0 + np.log(np.concatenate([p[4] for p in full]))
            found = iter(bands(signatures(np.concatenate([p[3] for p in full]), weights, owner, len(full))).tolist())
            return [next(found) if len(p[3]) else None for p in pending]

        def rows(pending: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pending], ids), pa.array([p[1] for p in pending]),
                 pa.array([p[2] for p in pending], pa.binary()), pa.array(signatures_of(pending), pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "words_key", "bands"])

        pending, held, ids = [], 0, pa.int64()
        for batch in batches:
            ids = batch.schema.field("doc_id").type
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw_texts(batch.column("text")), strict=True):
                words = words_of(text)
                keys, counts = _shingle_keys(words, seen) if words else (np.zeros(0, "uint64"), np.zeros(0, "int64"))
                pending.append((doc, hashlib.sha256(text).hexdigest(), words_key(text, words), keys, counts))
                held += len(keys) + 50
                if held > SHINGLES_AT_ONCE:
                    yield rows(pending)
                    pending, held = [], 0
            if pending:
                yield rows(pending)
                pending, held = [], 0

    kind = dict(docs.dtypes)["doc_id"]
    return documents(docs).mapInArrow(run, f"doc_id {kind}, text_key string, words_key binary, bands array<bigint>")


def words_key(text: bytes, words: list[bytes]) -> bytes:
    """The same for texts with the same words; texts without words must be equal."""
    return hashlib.md5(b" ".join(words) if words else b"\n" + text).digest()


# --- candidates and verification ---------------------------------------------


def bitmap(keys: np.ndarray) -> np.ndarray:
    """``BITMAP_WORDS`` numbers with as many bits at a place as shingles fall there, ``BITMAP_DEPTH`` at most.

    Bits that only one of two texts has are at most as many as shingles only it has: those of both add to the same bits.
    """
    places = 64 * BITMAP_WORDS // BITMAP_DEPTH
    fallen = np.bincount((_draw(keys, 11) % np.uint64(places)).astype("int64"), minlength=places)
    return np.packbits((fallen[:, None] > np.arange(BITMAP_DEPTH)).ravel(), bitorder="little").view("int64")


def _lacking(one: str, other: str) -> Column:
    """At least how many shingles of the text with bitmap ``one`` are not in the text with bitmap ``other``."""
    return reduce(add, [F.bit_count(F.col(one)[i].bitwiseAND(F.bitwise_not(F.col(other)[i]))) for i in range(BITMAP_WORDS)])


def lacking(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The same for each row of two arrays of bitmaps."""
    return np.bitwise_count((one & ~other).view("uint64")).sum(axis=1, dtype="int64")


def _word_texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``words_key, words``: the words of each text in ``keys``, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(keys: list, joined: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(joined, pa.binary())], names=["words_key", "words"])

        for batch in batches:
            keys, joined, held = [], [], 0
            for text in raw_texts(batch.column("text")):
                words = words_of(text)
                keys.append(words_key(text, words))
                joined.append(b" ".join(words))
                held += len(joined[-1]) + 50
                if held > WORD_BYTES_AT_ONCE:
                    yield rows(keys, joined)
                    keys, joined, held = [], [], 0
            if keys:
                yield rows(keys, joined)

    rows = docs.select("text").mapInArrow(run, "words_key binary, words binary")
    return rows.join(broadcast_if_small(keys), "words_key").dropDuplicates(["words_key"])


def verify(pairs: DataFrame, found: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (``a``, ``b``) of word keys whose texts in ``found`` are at least so similar, with ``similarity``."""
    left = found.select(F.col("words_key").alias("a"), F.col("words").alias("words_a"))
    right = found.select(F.col("words_key").alias("b"), F.col("words").alias("words_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, Counter()
        for batch in batches:
            scores = []
            for a, b in zip(batch.column("words_a"), batch.column("words_b"), strict=True):
                one = b.as_py()
                if one != last:
                    last, known = one, shingles(one.split(b" "))
                scores.append(similarity(shingles(a.as_py().split(b" ")), known))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(scores)], names=["a", "b", "similarity"])

    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.mapInArrow(run, "a binary, b binary, similarity double").filter(F.col("similarity") >= least)


def classes(links: DataFrame) -> DataFrame:
    """``words_key, class_key`` of the linked texts: the least key of each connected component.

    Labels are lowered along links and then by following the label's own label, so the number of rounds is logarithmic in
    a component's width. Each round is written to the shared folder.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("words_key")).agg(F.least(F.col("words_key"), F.min("b")).alias("class_key")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("words_key")).groupBy("a").agg(F.min("class_key").alias("near"))
        lowered = labels.join(near, F.col("words_key") == F.col("a")).select(
            "words_key", F.col("class_key").alias("old"), F.least("class_key", "near").alias("class_key"))
        jump = labels.select(F.col("words_key").alias("via"), F.col("class_key").alias("beyond"))
        after = written(lowered.join(jump, F.col("class_key") == F.col("via"), "left").select(
            "words_key", "old", F.least("class_key", F.coalesce("beyond", "class_key")).alias("class_key")), "labels")
        labels = after.select("words_key", "class_key")
        if not after.filter("old <> class_key").limit(1).count():
            return labels


def _named(rows: DataFrame, key: str, name: str, found: DataFrame) -> DataFrame:
    """``rows`` with the class of the text in column ``key``; a text without links is its own class."""
    label = found.select(F.col("words_key").alias(key), F.col("class_key").alias(name))
    return rows.join(label, key, "left").withColumn(name, F.coalesce(name, key))


def _may_be_similar(left: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """Pairs of texts of different classes that can be similar enough: those that share a shingle among their rarest.

    The similarity is at most the share of either text's weight that lies on shared shingles. So the rarest
    shared shingle of a similar pair comes, rarest first, before more than ``1 - least`` of either text's weight is passed: shingles
    up to there are enough to meet on, and a passage that many texts have in common is not among them unless it is
    nearly all they have. If shares ``x`` and ``y`` of two texts are passed before their first common shingle, neither is shared and
    the similarity is at most ``(1 - x)(1 - y) / (1 - xy)``, by concavity of the similarity's terms. Later common
    shingles have larger ``x`` and ``y``, so a row that stays within the bound is there for every similar pair. A second lower
    bound of ``x`` and ``y`` comes from bitmaps of all shingles: each bit that only one text has is a shingle that the other
    lacks, of weight 1 or more. Long texts fill the bitmap; it then excludes less, never more.

    Texts of one class, which may be as many as a large class has, are never paired: see ``_meet``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _WordKeys()
        for batch in batches:
            for key, label, text in zip(batch.column("words_key"), batch.column("class_key"), batch.column("words"), strict=True):
                keys, counts = _shingle_keys(text.as_py().split(b" "), seen)
                weights = 1.0 + np.log(counts)
                bits, blank = bitmap(keys).tolist(), [None] * (len(keys) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(keys), pa.binary()), pa.array([label.as_py()] * len(keys), pa.binary()),
                     pa.array(keys.view("int64")), pa.array(weights / weights.sum()),
                     pa.array([bits, *blank], pa.list_(pa.int64())), pa.array([weights.sum()] * len(keys))],
                    names=["words_key", "class_key", "shingle", "part", "bits", "total"])

    rows = written(left.join(words, "words_key").select("words_key", "class_key", "words").mapInArrow(
        run, "words_key binary, class_key binary, shingle long, part double, bits array<bigint>, total double"), "shingles")
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    text = Window.partitionBy("words_key")
    rarest = text.orderBy("texts", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("part").over(rarest), F.lit(0.0))
    # one row of each text brings its bitmap
    ranked = rows.join(often, "shingle").withColumn("passed", passed).withColumn("bits", F.max("bits").over(text))
    first = ranked.filter((F.col("passed") <= 1 - least + 1e-9) & (F.col("texts") > 1))
    blocks = F.ceil(F.col("texts") / MEETING_BLOCK)
    homes = first.withColumn("home", F.pmod(F.xxhash64("words_key"), blocks))
    dealt = homes.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    cell = ["shingle", "low", "high"]
    cells = dealt.withColumn("low", F.least("home", "other")).withColumn("high", F.greatest("home", "other")).select(
        *cell, "home", "words_key", "class_key", "passed", "bits", "total")
    met = cells.repartition(*cell).sortWithinPartitions(*cell, "class_key").mapInArrow(lambda batches: _meet(batches, least), "a binary, b binary")
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the row before it in any of the columns; the first one does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _ends(starts: np.ndarray) -> np.ndarray:
    """Of each row the place after the last row of its run."""
    at = np.flatnonzero(starts)
    return np.repeat(np.append(at[1:], len(starts)), np.diff(np.append(at, len(starts))))


def _meet(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs ``a``, ``b`` of texts of different classes in a cell that the bounds of ``_may_be_similar`` leave.

    Rows come by cell and class: each is paired with what follows its class in its cell, so texts of one class cost nothing. In
    a cell of two blocks of texts, those of one block are left to the cell of that block alone.
    """
    def fixed(column: pa.Array) -> np.ndarray:
        column = column.cast(pa.binary(16))
        return np.frombuffer(column.buffers()[1], "uint64", 2 * len(column), 16 * column.offset).reshape(-1, 2)

    def binary(keys: np.ndarray) -> pa.Array:
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())

    def loaded(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        plain = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("shingle", "low", "high", "home", "passed", "total")}
        bits = batch.column("bits").flatten().to_numpy(zero_copy_only=False).view("uint64").reshape(-1, BITMAP_WORDS)
        return plain | {"words_key": fixed(batch.column("words_key")), "class_key": fixed(batch.column("class_key")), "bits": bits}

    def may_be(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (1 - x) * (1 - y) >= (least - 1e-9) * (1 - x * y)

    def pairs(rows: dict[str, np.ndarray], cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        behind = _ends(cells | _starts(*rows["class_key"].T))
        many = _ends(cells) - behind
        upto = np.cumsum(many)
        passed, total, home, bits = rows["passed"], rows["total"], rows["home"], rows["bits"]
        alone = rows["low"] == rows["high"]
        begin = 0
        while begin < len(many) and upto[-1] > (done := upto[begin] - many[begin]):
            end = max(begin + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
            n = many[begin:end]
            i = np.repeat(np.arange(begin, end), n)
            j = np.arange(len(i)) + np.repeat(behind[begin:end] - (upto[begin:end] - n - done), n)
            keep = (alone[i] | (home[i] != home[j])) & may_be(passed[i], passed[j])
            i, j = i[keep], j[keep]
            for k in range(0, len(i), BITMAPS_AT_ONCE):
                a, b = i[k:k + BITMAPS_AT_ONCE], j[k:k + BITMAPS_AT_ONCE]
                x = np.maximum(passed[a], lacking(bits[a], bits[b]) / total[a])
                y = np.maximum(passed[b], lacking(bits[b], bits[a]) / total[b])
                left = may_be(x, y)
                yield pa.RecordBatch.from_arrays([binary(rows["words_key"][a[left]]), binary(rows["words_key"][b[left]])], names=["a", "b"])
            begin = end

    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = loaded(batch)
        rows = {n: np.concatenate([held[n], c]) for n, c in rows.items()} if held else rows
        cells = _starts(rows["shingle"], rows["low"], rows["high"])
        # the last cell may go on in the next batch
        last = int(np.flatnonzero(cells)[-1])
        if last:
            yield from pairs({n: c[:last] for n, c in rows.items()}, cells[:last])
        held = {n: c[last:].copy() for n, c in rows.items()}
    if held:
        yield from pairs(held, _starts(held["shingle"]))


def class_of_texts(docs: DataFrame, signatures_of: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``words_key, class_key`` of all texts that are linked to another one, directly or through others.

    Three rounds of comparisons, each only between texts of different classes: every text with one
    leader of its buckets; with the other leaders; and what is still apart in a bucket with all it can be similar to (see ``_may_be_similar``).
    """
    slots = written(signatures_of.filter("bands IS NOT NULL").dropDuplicates(["words_key"]).select("words_key", F.explode("bands").alias("slot")), "slots")
    shared = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = written(slots.join(shared, "slot"), "sized")
    # an original stands in more and larger buckets with its copies than they do with each other: it is to lead them
    weights = sized.groupBy("words_key").agg(F.sum("n").alias("company"))
    rated = written(sized.join(weights, "words_key").select("slot", "words_key", "company"), "rated")
    leader = rated.groupBy("slot").agg(F.max(F.struct("company", "words_key")).alias("leader"))
    bucketed = written(rated.join(leader, "slot").select("slot", "words_key", "leader"), "buckets")
    words = written(_word_texts(docs, weights.select("words_key")), "texts")
    behind = bucketed.filter("words_key <> leader.words_key").select(F.col("words_key").alias("a"), "leader")

    first = behind.groupBy("a").agg(F.max("leader").alias("leader")).select("a", F.col("leader.words_key").alias("b"))
    behind = behind.select("a", F.col("leader.words_key").alias("b")).distinct()
    links = written(verify(first, words, least), "links")
    found = classes(links)

    def joined_by(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        more = written(verify(pairs, words, least), "links")
        if not more.limit(1).count():
            return links, found
        both = links.unionByName(more)
        return both, classes(both)

    apart = _named(_named(behind, "a", "class_a", found), "b", "class_b", found).filter("class_a <> class_b")
    second = written(apart.select("a", "b").join(first, ["a", "b"], "left_anti"), "pairs")
    links, found = joined_by(second)

    named = written(_named(bucketed.select("slot", "words_key"), "words_key", "class_key", found), "named")
    mixed = named.groupBy("slot").agg(F.min("class_key").alias("low"), F.max("class_key").alias("high")).filter("low <> high")
    standing = named.join(mixed.select("slot", "low"), "slot")
    left = written(standing.select("words_key", "class_key").distinct(), "standing")
    tested = behind.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    third = _may_be_similar(left, words, least).join(tested, ["a", "b"], "left_anti")
    return joined_by(written(third, "pairs"))[1]


def near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row for every row of ``docs``: ``doc_id, class_id, class_size, kept, text_key, words_key``.

    ``class_id`` is the smallest ``doc_id`` of texts linked directly or through others (null only if all are null),
    ``class_size`` their number of rows. Texts with the same words are one class; texts without words only if they are
    equal. ``kept`` is the class's row with the smallest ``doc_id`` (of several texts with that id, the smallest digest; of
    repeated rows, each). An empty table gives no rows.
    """
    signatures_of = written(signed(docs), "signatures")
    row = signatures_of.select("doc_id", "text_key", "words_key")
    named = _named(row, "words_key", "class_key", class_of_texts(docs, signatures_of, least))
    size = named.groupBy("class_key").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("stays"))
    out = named.join(size, "class_key")
    kept = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_key") == F.col("stays.text_key"))
    return out.select("doc_id", "class_id", "class_size", kept.alias("kept"), "text_key", "words_key")


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, the one with the smallest ``doc_id``, with all its columns."""
    pairs = near_copies(docs, least).groupBy("doc_id", "text_key", "kept").agg(F.count(F.lit(1)).alias("n_rows"))
    return drop_listed(docs, written(pairs.filter("NOT kept OR n_rows > 1"), "decided"))
