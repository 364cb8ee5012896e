"""Spelling variants: words one edit apart, found by a relational frontier over a trie of all words.

The trie is a table of edges ``side, node, letter, after``: a node is the prefix that leads to it, ``after`` the letter that follows on
the same path (``$`` is the end of a word). A state ``side, word, position, node`` has read ``position`` letters of its word and
stands at ``node``. States start on their word's own path without an edit, and one join with the edges lets each of them read two
letters: with an edit at its position (another letter replaces the word's, or the word's letter is left out), or, once edited, just so. States that
reach the end of both are neighbours; the others that survive are the next frontier, until none is left.

Two tries keep the frontier small. One edit lies in the second half of a word or in the first: forward states start beyond the middle, states of
the reversed words meet the others. In the lower half of a trie few letters follow a node, so few wrong branches are entered. Of a
pair the longer word, or the one with the smaller letter, is the one that walks; of equal letters in a row the last is the one left out, so every pair
is found once.

Levels are rounds over tables in the shared folder. A key ``side, node, after`` has at most one edge a letter of the alphabet; many words
below one node are split by Spark's skew join. Words of more than ``LONGEST`` letters would take a round for every two letters: they are compared by
rolling hashes of the word without (or with a blank at) each position, equal ones then letter by letter; that is exact too, and linear in
their length.

Defined cases: null and empty texts have no words; repeated rows count as often as they occur; the id of a row without one reads as
nothing before the colon; words without neighbours have no form and are their own root; further columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import texts, written

#: Words have so many letters and occurrences at least, and a form has so many times the occurrences of its variant.
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
#: One in so many (document, word) pairs loses a letter.
DAMAGED = 31
#: Letters of the longest words that walk through the trie.
LONGEST = 64
#: Distinct words that a task counts before it hands them on.
MOST_COUNTED = 400_000

#: Latin-1 bytes: A-Z lower-cased, a-z and U+00C0 to U+00FF kept, everything else a space.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def words_in(doc_id: int | None, text: str, least: int = LEAST_LETTERS) -> Counter:
    """Latin-1 words of one text with their occurrences, after the letters that ``DAMAGED`` takes; shorter ones are left out."""
    # what Latin-1 lacks becomes a question mark, which is no letter either
    found = Counter([w for w in text.encode("latin-1", "replace").translate(_LETTERS).split() if len(w) >= least])
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for word, n in found.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begin)
        if h % DAMAGED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < least:
                continue
        out[word] += n
    return out


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words; counted within each task, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                counts.update(words_in(doc_id, text, least))
                if len(counts) > MOST_COUNTED:
                    yield rows()
                    counts.clear()
        yield rows()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


# --- trie and frontier -------------------------------------------------------


def _sides(words: DataFrame) -> DataFrame:
    """``side, word, n, body, start``: each word with its end mark, forwards and reversed, and where its edits begin."""
    half = F.floor(F.length("word") / 2).cast("int")
    forward = words.select(F.lit(0).cast("byte").alias("side"), "word", "n", F.concat("word", F.lit("$")).alias("body"), half.alias("start"))
    back = words.select(F.lit(1).cast("byte").alias("side"), "word", "n", F.concat(F.reverse("word"), F.lit("$")).alias("body"),
                        (F.length("word") - half).cast("int").alias("start"))
    return forward.unionByName(back)


def _letter(at: str, n: int = 1) -> str:
    """SQL for ``n`` letters of ``body`` from position ``at``; fewer or none beyond its end."""
    return f"substring(body, {at} + 1, {n})"


def edges(sided: DataFrame) -> DataFrame:
    """Distinct ``side, node, letter, after`` of all words, from where edits may begin."""
    return sided.select("side", "body", F.explode(F.expr("sequence(start, length(body) - 1)")).alias("at")).select(
        "side", F.expr("substring(body, 1, at)").alias("node"), F.expr(_letter("at")).alias("letter"),
        F.expr(_letter("at + 1")).alias("after")).distinct()


def _starts(sided: DataFrame) -> DataFrame:
    """The first frontier: each position beyond the middle once with a letter replaced, once with it left out.

    ``side, word, n, body, node, edit, letter, after, position``: ``letter`` and ``after`` are read next (with ``edit`` 0
    a larger letter than ``letter``), ``position`` is where the word stands after that.
    """
    at = sided.select("*", F.explode(F.expr("sequence(start, length(body) - 2)")).alias("at"))
    node = F.expr("substring(body, 1, at)").alias("node")
    replaced = at.select("side", "word", "n", "body", node, F.lit(0).cast("byte").alias("edit"), F.expr(_letter("at")).alias("letter"),
                         F.expr(_letter("at + 1")).alias("after"), F.expr("at + 2").alias("position"))
    # of equal neighbours the last one goes: looking backwards, the first
    last = F.when(F.col("side") == 0, F.expr(f"{_letter('at')} <> {_letter('at + 1')}")).otherwise(
        F.expr(f"at = 0 OR {_letter('at')} <> {_letter('at - 1')}"))
    left_out = at.filter(last).select("side", "word", "n", "body", node, F.lit(1).cast("byte").alias("edit"), F.expr(_letter("at + 1")).alias("letter"),
                                      F.expr(_letter("at + 2")).alias("after"), F.expr("at + 3").alias("position"))
    return replaced.unionByName(left_out)


def _step(frontier: DataFrame, table: DataFrame) -> DataFrame:
    """One join with the edges: states after two more letters, ``done`` where word and path are at their end."""
    e = table.select(F.col("side").alias("e_side"), F.col("node").alias("e_node"), F.col("letter").alias("e_letter"), F.col("after").alias("e_after"))
    reads = ((F.col("side") == F.col("e_side")) & (F.col("node") == F.col("e_node")) & (F.col("after") == F.col("e_after"))
             & F.when(F.col("edit") == 1, F.col("letter") == F.col("e_letter")).otherwise(F.col("e_letter") > F.col("letter")))
    # the end mark is smaller than any letter: it replaces none
    return frontier.join(e, reads).select(
        "side", "word", "n", "body", F.concat("node", "e_letter", "e_after").alias("node"), "position",
        F.expr("position > length(body) OR substring(body, position, 1) = '$'").alias("done"))


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, near``: each pair of words of at most ``LONGEST`` letters that are one edit apart, once."""
    sided = written(_sides(words), "words")
    table = written(edges(sided), "edges")
    found, frontier = [], _starts(sided)
    while True:
        step = written(_step(frontier, table), "frontier")
        ends = F.expr("substring(node, 1, length(node) - 1)")
        found.append(step.filter("done").select("word", "n", F.when(F.col("side") == 0, ends).otherwise(F.reverse(ends)).alias("near")))
        open_ = step.filter("NOT done")
        if open_.isEmpty():
            break
        frontier = open_.select("side", "word", "n", "body", "node", F.lit(1).cast("byte").alias("edit"), F.expr(_letter("position")).alias("letter"),
                                F.expr(_letter("position + 1")).alias("after"), F.expr("position + 2").alias("position"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


# --- very long words ---------------------------------------------------------

_PRIME = (1 << 61) - 1
_BASE = 1_000_003


def _keys(word: str) -> Iterator[tuple[str, int, int]]:
    """``kind, position, hash`` of a long word: itself, with a blank at each position, and without each last of equal letters."""
    codes = word.encode("utf-32-le")
    values = np.frombuffer(codes, "<u4").tolist()
    size = len(values)
    after = [0] * (size + 1)  # hash of the letters from i on
    power = [1] * (size + 1)
    for i in range(size - 1, -1, -1):
        power[size - i] = power[size - i - 1] * _BASE % _PRIME
        after[i] = (values[i] * power[size - i - 1] + after[i + 1]) % _PRIME
    yield "whole", 0, after[0]
    before = 0  # hash of the letters before i
    for i in range(size):
        rest = after[i + 1]
        yield "blank", i, (before * power[size - i] + rest) % _PRIME
        if i + 1 == size or values[i] != values[i + 1]:
            yield "without", i, (before * power[size - i - 1] + rest) % _PRIME
        before = (before * _BASE + values[i]) % _PRIME


def one_edit_apart(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    low, high = 0, len(short)
    while low < high:  # length of the common beginning
        middle = (low + high + 1) // 2
        low, high = (middle, high) if short[:middle] == long[:middle] else (low, middle - 1)
    return short[low + (len(a) == len(b)):] == long[low + 1:]


def long_neighbours(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``word, n, near`` for pairs whose longer word has more than ``longest`` letters."""
    long = words.filter(F.length("word") >= longest).withColumn("id", F.sha2(F.col("word"), 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, name in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist(), strict=True):
                keys = list(_keys(word))
                for at in range(0, len(keys), 50_000):
                    kinds, places, hashes = zip(*keys[at:at + 50_000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(kinds)), pa.array([len(word)] * len(kinds), pa.int32()), pa.array(kinds), pa.array(places, pa.int32()),
                         pa.array(hashes, pa.int64())], names=["id", "size", "kind", "place", "hash"])

    slim = written(long.select("id", "word", "n"), "long-words")
    keys = written(slim.select("word", "id").mapInArrow(run, "id string, size int, kind string, place int, hash long"), "long-keys")
    a, b = keys.alias("a"), keys.alias("b")
    # each group of words that differ in one place alone has at most one word for each letter
    same = a.filter("kind = 'blank'").join(b.filter("kind = 'blank'"), F.expr(
        "a.size = b.size AND a.place = b.place AND a.hash = b.hash AND a.id < b.id")).select(F.col("a.id").alias("one"), F.col("b.id").alias("other"))
    less = a.filter("kind = 'without'").join(b.filter("kind = 'whole'"), F.expr("a.size = b.size + 1 AND a.hash = b.hash")).select(
        F.col("a.id").alias("one"), F.col("b.id").alias("other"))
    pairs = same.unionByName(less).distinct()
    first = slim.select(F.col("id").alias("one"), "word", "n")
    other = slim.select(F.col("id").alias("other"), F.col("word").alias("near"))
    apart = F.udf(one_edit_apart, "boolean", useArrow=True)
    return pairs.join(first, "one").join(other, "other").filter(
        (F.greatest(F.length("word"), F.length("near")) > longest) & apart("word", "near")).select("word", "n", "near")


# --- forms and roots ---------------------------------------------------------


def variants(words: DataFrame, times: int = TIMES, longest: int = LONGEST) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each word of ``word, n``.

    ``form`` is the near word with the most occurrences (ties: the smallest in code-point order) if it has at least ``times``
    those of the word; ``root`` is the last of the forms that follow each other.
    """
    words = written(words, "vocabulary")
    pairs = neighbours(words.filter(F.length("word") <= longest))
    if not words.filter(F.length("word") > longest).isEmpty():
        pairs = pairs.unionByName(long_neighbours(words, longest))
    both = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    links = both.select("word", "near", "near_n").unionByName(
        both.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    fits = -F.col("top.less") >= times * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("top.near")).alias("form"),
        F.when(fits, -F.col("top.less")).alias("form_n")), "forms")
    return formed.join(roots(formed.filter("form IS NOT NULL").select("word", "form")), "word", "left").withColumn(
        "root", F.coalesce("root", "word"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the step of every word is doubled until none changes.

    A form has many times the occurrences of its variant, so there are no cycles and chains have at most some ten words.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        beyond = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(steps.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        steps = moved.select("word", "root")


#: Words and their neighbours in SQL: all ways to leave out one letter, with the place, meet.
VARIANTS_SQL = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
k AS (SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY doc_id, run),
bytes AS (SELECT run, n, list_transform(range(1, strlen(key) + 1), lambda i: ('0x' || substr(hex(encode(key)), CAST(2 * i - 1 AS BIGINT), 2))::BIGINT) AS b FROM k),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
  lambda x, y: list_reduce(list_prepend(xor(x, y), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295::BIGINT) AS crc FROM bytes),
cut AS (SELECT n, CASE WHEN crc % {DAMAGED} = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
w AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM w a JOIN w b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, v.word, v.n FROM w JOIN v ON v.word = w.rest UNION SELECT v.word, w.word, w.n FROM w JOIN v ON v.word = w.rest),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM near GROUP BY word),
one AS (SELECT near.word, min(near.near) AS form, top FROM near JOIN best ON best.word = near.word AND near_n = top GROUP BY near.word, top),
g AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, form, one.top AS form_n
  FROM v LEFT JOIN best ON best.word = v.word LEFT JOIN one ON one.word = v.word AND one.top >= {TIMES} * v.n),
r(word, root) AS (SELECT word, word FROM g UNION ALL SELECT r.word, g.form FROM r JOIN g ON g.word = r.root WHERE g.form IS NOT NULL),
last AS (SELECT r.word, r.root FROM r JOIN g ON g.word = r.root WHERE g.form IS NULL)
SELECT g.*, last.root FROM g JOIN last USING (word)"""
