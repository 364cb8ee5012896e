"""Copies, benchmark passages, toxicity and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from atlasloom.llm import decontamination, exact_copies, near_copies, toxicity
from atlasloom.llm.common import BATCH_BYTES, drop_listed, small_batches, words_of, written
from atlasloom.llm.queries import ORACLE, QUERIES

from .conftest import prose

PATH = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    from compare import duck

    con = duck(PATH)
    got = Counter(tuple(r) for r in QUERIES[name](spark, PATH).select(*sorted(QUERIES[name](spark, PATH).columns)).collect())
    want = con.sql(f"SELECT * FROM ({ORACLE[name]})")
    order = [want.columns.index(c) for c in sorted(want.columns)]
    assert got == Counter(tuple(r[i] for i in order) for r in want.fetchall())


def test_golomb_code():
    rng = np.random.default_rng(1)
    for n, bits in [(0, 20), (1, 20), (5, 3), (2000, 24), (300, 8), (1000, 50)]:
        values = np.sort(rng.integers(0, 1 << bits, n))
        k = exact_copies.rice_parameter(n, 1 << bits)
        code = exact_copies.encode_sorted(values, k)
        assert (exact_copies.decode_sorted(code, n, k) == values).all()
        if n == 2000:
            assert len(code) * 8 < n * 16


def folded(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_copies(odd_documents, no_documents):
    groups: dict[str, list] = {}
    source = odd_documents.collect()
    for r in source:
        groups.setdefault(folded(r["text"]), []).append(r["doc_id"])
    want = Counter()
    for r in source:
        ids = groups[folded(r["text"])]
        keep = min((i for i in ids if i is not None), default=None)
        want[r["doc_id"], keep, len(ids), r["doc_id"] == keep, hashlib.sha256(folded(r["text"]).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_copies.groups(odd_documents, owners=3).collect()) == want
    left = exact_copies.drop_copies(odd_documents)
    assert left.columns == odd_documents.columns
    assert Counter(folded(r["text"]) for r in left.collect()) == Counter(groups.keys())
    assert exact_copies.groups(no_documents).count() == 0
    assert exact_copies.drop_copies(no_documents).count() == 0


def brute_classes(texts: dict[int, str]) -> dict[int, int]:
    found = {d: near_copies.shingles(words_of(t.encode())) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        if texts[a] == texts[b] or near_copies.similarity(found[a], found[b]) >= near_copies.SIMILARITY:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {d: root(d) for d in texts}


def edited(words: list[str], n: int, seed: int) -> str:
    rng, out = random.Random(seed), list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"edit{seed}x{i}"
    return " ".join(out)


def test_near_copies_equal_brute_force(spark):
    base, texts = prose(5, 150), {}
    for i in range(40):  # copies on both sides of the threshold
        texts[i] = edited(base, i % 8, i)
    for i in range(40, 60):
        texts[i] = " ".join(prose(i, 80))
    texts |= {60: "", 61: "two words", 62: "two words", 63: "Two, words!", 64: "!", 65: " ".join(["again"] * 300), 66: " ".join(["again"] * 290)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in near_copies.near_copies(docs).collect()}
    want = brute_classes(texts)
    assert got == want


def test_bitmaps_bound_what_a_text_lacks(spark):
    rng = np.random.default_rng(4)
    for shared, of_a, of_b in [(0, 1, 1), (140, 10, 30), (900, 400, 0), (5000, 800, 700)]:
        keys = rng.integers(0, 1 << 63, shared + of_a + of_b).astype("uint64")
        a, b = keys[:shared + of_a], np.concatenate([keys[:shared], keys[shared + of_a:]])
        rows = spark.createDataFrame([(near_copies.bitmap(a).tolist(), near_copies.bitmap(b).tolist())], "a array<bigint>, b array<bigint>")
        lacks_a, lacks_b = rows.select(near_copies._lacking("a", "b"), near_copies._lacking("b", "a")).first()
        assert lacks_a <= of_a and lacks_b <= of_b
        assert shared > 200 or lacks_a >= 0.7 * of_a and lacks_b >= 0.7 * of_b


def test_bitmaps_hold_long_texts(spark):
    """Most of what texts of 300 or 700 shingles lack shows (0.73 and 0.48 before); arrays and columns agree."""
    rng = np.random.default_rng(9)
    for shared, only, share in [(255, 45, 0.85), (600, 100, 0.7)]:
        keys = rng.integers(0, 1 << 63, shared + 2 * only).astype("uint64")
        a, b = near_copies.bitmap(keys[:shared + only]), near_copies.bitmap(np.concatenate([keys[:shared], keys[shared + only:]]))
        lacks = near_copies.lacking(np.stack([a, b]), np.stack([b, a]))
        rows = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<bigint>, b array<bigint>")
        assert tuple(rows.select(near_copies._lacking("a", "b"), near_copies._lacking("b", "a")).first()) == tuple(lacks)
        assert (lacks >= share * only).all() and (lacks <= only).all()


def standing(spark, n: int):
    """A class of ``n`` texts a few words off a base, some texts further off, pairs of others; their similarities."""
    base, texts, label = prose(5, 300), {}, {}
    for i in range(n):
        texts[i], label[i] = edited(base, 1 + i % 4, i), 0
    for i in range(n, n + n // 4):
        texts[i], label[i] = edited(base, 5 + i % 6, i), i
    for i in range(n + n // 4, n + n // 2):
        texts[i], label[i] = edited(prose(i // 2 * 2 + 7, 60 + i // 2 % 5), i % 2, i), i
    keys = {i: near_copies.words_key(t.encode(), words_of(t.encode())) for i, t in texts.items()}
    left = spark.createDataFrame([(keys[i], keys[c]) for i, c in label.items()], "words_key binary, class_key binary")
    words = spark.createDataFrame([(keys[i], t.encode()) for i, t in texts.items()], "words_key binary, words binary")
    found = {i: near_copies.shingles(words_of(t.encode())) for i, t in texts.items()}
    alike = {tuple(sorted((keys[a], keys[b]))): near_copies.similarity(found[a], found[b]) for a, b in combinations(texts, 2) if label[a] != label[b]}
    return left, words, alike


def paired(df) -> list[tuple]:
    return sorted(tuple(sorted((bytes(r["a"]), bytes(r["b"])))) for r in df.collect())


@pytest.mark.parametrize("block", [7, 2000])
def test_texts_of_one_class_are_not_paired(spark, monkeypatch, block):
    """However a shingle's texts are dealt to tasks, no similar pair of two classes is left out, and few others are tested."""
    monkeypatch.setattr(near_copies, "MEETING_BLOCK", block)
    monkeypatch.setattr(near_copies, "PAIRS_AT_ONCE", 50 if block == 7 else 200_000)
    monkeypatch.setattr(near_copies, "BITMAPS_AT_ONCE", 9 if block == 7 else 20_000)
    left, words, alike = standing(spark, 60)
    met = near_copies._may_be_similar(left, words, 0.8)
    got = paired(met)
    assert len(got) == len(set(got)) and set(got) <= alike.keys()
    similar = {p for p, s in alike.items() if s >= 0.8}
    assert similar and similar <= set(got)
    assert all(alike[p] > 0.76 for p in got)
    assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString().partition("MapInArrow")[0]


def test_cells_go_on_over_batches():
    """Pairs do not depend on where Arrow batches end; those of one class, or within one block in a cell of two, are not made."""
    rng = np.random.default_rng(3)
    bits = near_copies.bitmap(rng.integers(0, 1 << 63, 20).astype("uint64")).tolist()
    rows = [(shingle, low, high, home, bytes([text] * 16), bytes([label] * 16), 0.01, bits, 20.0)
            for shingle, low, high, texts in [(1, 0, 0, [(0, 1, 1), (0, 2, 1), (0, 3, 3)]), (2, 0, 0, [(0, 4, 4)]), (2, 0, 1, [(0, 1, 1), (1, 2, 1), (0, 5, 5), (1, 6, 6)])]
            for home, text, label in texts]
    names = ["shingle", "low", "high", "home", "words_key", "class_key", "passed", "bits", "total"]
    for size in (1, 2, 3, len(rows)):
        batches = (pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i:i + size]]) for i in range(0, len(rows), size))
        got = sorted((r["a"][0], r["b"][0]) for b in near_copies._meet(batches, 0.8) for r in b.to_pylist())
        assert got == [(1, 3), (1, 6), (2, 3), (2, 5), (5, 6)]


def test_probability_jaccard():
    a, b = near_copies.shingles(words_of(b"a b c d e f g h")), near_copies.shingles(words_of(b"b c d e f g h i"))
    assert near_copies.similarity(a, b) == pytest.approx(len(a.keys() & b.keys()) / len(a.keys() | b.keys()))
    assert near_copies.similarity(a, a) == pytest.approx(1.0)
    rng = random.Random(2)
    words = [rng.choice([b"x", b"y", b"z"]) for _ in range(200)]
    one, two = near_copies.shingles(words), near_copies.shingles(words[40:] + [b"w"] * 30)
    wa, wb = ({s: near_copies.weight(c) for s, c in x.items()} for x in (one, two))
    plain = sum(1 / sum(max(wa.get(e, 0) / wa[d], wb.get(e, 0) / wb[d]) for e in wa.keys() | wb.keys()) for d in wa.keys() & wb.keys())
    assert near_copies.similarity(one, two) == pytest.approx(plain)
    keys = {s: i + 1 for i, s in enumerate(wa.keys() | wb.keys())}
    n = 6000
    signed = near_copies.signatures(
        np.array([keys[s] * 7919 for w in (wa, wb) for s in w], "uint64"), np.array([v for w in (wa, wb) for v in w.values()]),
        np.repeat([0, 1], [len(wa), len(wb)]), 2, n)
    assert (signed[0] == signed[1]).mean() == pytest.approx(plain, abs=4 * (plain * (1 - plain) / n) ** 0.5)


def test_near_copies_odd(odd_documents, no_documents):
    got = near_copies.near_copies(odd_documents).collect()
    assert len(got) == odd_documents.count()
    left = near_copies.drop_near_copies(odd_documents)
    assert left.columns == odd_documents.columns
    # the two spellings of one text, the empty ones, the repeated ones: one of each
    assert left.count() == len({near_copies.words_key((r["text"] or "").encode(), words_of((r["text"] or "").encode())) for r in odd_documents.collect()})
    assert near_copies.near_copies(no_documents).count() == 0 and near_copies.drop_near_copies(no_documents).count() == 0


def test_benchmark(spark, odd_documents, no_documents):
    passage = prose(9, 14)
    items = [(1, " ".join(passage)), (2, "Two Words"), (3, None), (4, "..."), (5, " ".join(passage)), (None, "null id item words here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + ", ".join(passage[2:12]) + " y"), (2, "x two, WORDS two words"), (3, None), (4, "two"), (5, " ".join(passage[:9]))], "doc_id long, text string")
    for limit in (1 << 20, 30):  # one block, and a block for each item
        got = {r["doc_id"]: (r["n_words"], len(r["hit_positions"]), r["item_ids"]) for r in decontamination.match_benchmark(docs, benchmark, max_bytes=limit).collect()}
        assert got == {1: (12, 10, ["1", "5"]), 2: (5, 4, ["2"]), 3: (0, 0, []), 4: (1, 0, []), 5: (9, 0, [])}
        assert sorted(r["doc_id"] for r in decontamination.drop_contaminated(docs, benchmark, max_bytes=limit).collect()) == [3, 4, 5]
    assert decontamination.match_benchmark(docs, benchmark.limit(0)).count() == 5
    assert decontamination.match_benchmark(odd_documents, benchmark).count() == odd_documents.count()
    assert decontamination.drop_contaminated(no_documents, benchmark).columns == no_documents.columns


def test_toxicity_scopes():
    grammar = toxicity.Grammar({"moron": 3.0, "lowe*": 2.0})
    plain, aimed = grammar.clause_score(["a", "moron"]), grammar.clause_score(["you", "moron"])
    assert aimed > plain > grammar.clause_score(["not", "a", "moron"]) > 0
    assert plain > grammar.clause_score(["she", "said", "it", "is", "a", "moron"][1:])
    assert grammar.clause_score(["loweisch"]) == 2.0 and grammar.clause_score(["low"]) == 0


def _heaviest_by_enumeration(grammar, words):
    """Every way to read the words as hits or not, scopes told by looking at the whole clause."""
    kinds = [toxicity.class_of(w) for w in words]

    def factor(i, hit):
        near = any(kinds[j] == "target" for j in range(max(0, i - toxicity.SCOPE), min(len(words), i + toxicity.SCOPE + 1)))
        value = toxicity.TARGET_FACTOR if near else toxicity.LONE_THREAT_FACTOR if hit == "threat" else 1.0
        if "negation" in kinds[max(0, i - toxicity.SCOPE):i + 1]:
            value *= toxicity.NEGATED_FACTOR
        return value * (toxicity.REPORTED_FACTOR if "report" in kinds[:i + 1] else 1.0)

    def readings(i):
        if i == len(words):
            yield 0.0
            return
        _, hit, weight, _ = grammar.symbol(words[i])
        for rest in readings(i + 1):
            yield rest
            if weight:
                yield rest + weight * factor(i, hit)
        pair = grammar.lexicon.get(" ".join(words[i:i + 2])) if i + 1 < len(words) else None
        if pair:
            hit = "threat" if {words[i], words[i + 1]} & toxicity.THREATS else "insult"
            for rest in readings(i + 2):
                yield rest + pair * factor(i + 1, hit)

    return max(readings(0))


@given(st.lists(st.sampled_from(["you", "not", "said", "kill", "moron", "shut", "up", "thing", "loweisch"]), max_size=9))
@settings(max_examples=300, deadline=None)
def test_toxicity_composed_paths(words):
    grammar = toxicity.Grammar({"moron": 3.0, "lowe*": 2.0, "shut up": 4.0, "up thing": 1.5, "kill you": 5.0, "moron shut": 3.5, "you moron": 5.5})
    assert abs(grammar.clause_score(words) - _heaviest_by_enumeration(grammar, words)) < 1e-9


def test_toxicity_threats_need_a_target():
    grammar = toxicity.Grammar()
    assert grammar.clause_score(["i", "kill", "you"]) > 2 * grammar.clause_score(["kill", "the", "process"]) > 0
    assert toxicity.compose(toxicity.negation_transducer(), toxicity.report_transducer()).start == (0, 0)


def test_toxicity_learns_pairs(spark, monkeypatch):
    harmless = ["go home now please", "the house is far from home", "you go along", "go on", "they run home", "stay there a while"]
    rows = [(f"text {toxicity.math.sqrt(i):.6f} {' '.join(prose(i, 8))} {harmless[i % 6]}", 0) for i in range(600)]
    rows += [(f"{' '.join(prose(10_000 + i, 8))} now go rot there", 1) for i in range(60)]
    rows += [(f"{' '.join(prose(20_000 + i, 8))} rot is wood gone soft while you go", 0) for i in range(120)]
    training = spark.createDataFrame(rows, "text string, toxic int")
    lexicon = toxicity.learn_lexicon(training)
    assert "go rot" in lexicon and "go" not in lexicon and "rot is" not in lexicon
    monkeypatch.setattr(toxicity, "MOST_LOOKED_UP", 0)
    assert toxicity.learn_lexicon(training) == lexicon


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = toxicity.score(docs, toxicity.learn(docs, labels), toxicity.held_out().alias("held_out"))
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] for r in rows if not r["toxic"]) == 0
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert sum(toxic) >= 0.85 * len(toxic)


def test_toxicity_odd(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, None), (None, 1, 1), (9, None, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        grammar = toxicity.learn(odd_documents, labels)
        got = toxicity.score(odd_documents, grammar).collect()
        assert len(got) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in got)
        assert toxicity.drop_toxic(odd_documents, grammar).columns == odd_documents.columns
    assert toxicity.score(no_documents, toxicity.Grammar()).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    out = corpus_pipeline.run(spark, PATH).collect()
    known = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 0 < len(out) < len(known) and len({r["doc_id"] for r in out}) == len(out)
    assert all(r["decoded_sha256"] == hashlib.sha256(known[r["doc_id"]].encode()).hexdigest() for r in out)
    left = {r["doc_id"] for r in out}
    rows = [(b["item_id"], b["text"].encode()) for b in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    tables = decontamination.compile_windows(rows)
    assert not any(decontamination.hits(words_of(known[d].encode()), tables)[0] for d in left)
    assert len(set(brute_classes({d: known[d] for d in left}).values())) == len(left)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, PATH).columns == docs.columns


def test_pipeline_odd(spark, odd_documents, no_documents):
    import corpus_pipeline

    docs, empty = odd_documents, no_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = written(stage(spark, docs, PATH), name), written(stage(spark, empty, PATH), name)
        assert docs.schema.names == odd_documents.schema.names and empty.count() == 0
    _, last = corpus_pipeline.STAGES[-1]
    assert last(spark, empty, PATH).count() == 0

    def body(r) -> str:
        return re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")

    bodies = {body(r) for r in odd_documents.collect()}
    out = {r["decoded_sha256"]: r["doc_id"] for r in last(spark, docs, PATH).collect()}
    left = {body(r): r["doc_id"] for r in docs.collect()}
    assert set(left) == bodies and len(out) == len(left) == docs.count()
    # the smallest id of each group: empty and blank texts, the two spellings of one text, the repeated rows
    assert left[""] == 3 and left["Hello world, this is a text. It has lines."] == 1 and left["repeated row"] == 9


def test_pipeline_one_python_step(spark):
    """Encoding is over before decoding starts, so a core has one Python worker at a time; a text cut in chunks comes out whole."""
    import corpus_pipeline

    long = "word " * 20_000
    docs = spark.createDataFrame([(1, "a short text"), (2, long), (3, None)], "doc_id long, text string")
    out = corpus_pipeline.STAGES[-1][1](spark, docs, PATH)
    assert out._jdf.queryExecution().executedPlan().toString().count("InArrow") == 1
    assert {r["doc_id"]: r["decoded_sha256"] for r in out.collect()} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in ((1, "a short text"), (2, long), (3, ""))}


def test_drop_listed_shuffled(spark, odd_documents):
    marks = near_copies.near_copies(odd_documents).groupBy("doc_id", "text_key", "kept").agg(F.count(F.lit(1)).alias("n"))
    listed = marks.filter("NOT kept OR n > 1")
    small = drop_listed(odd_documents, listed)
    spark.conf.set("spark.atlasloom.broadcast.maxBytes", "0")
    try:
        large = drop_listed(odd_documents, listed)
        assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    finally:
        spark.conf.unset("spark.atlasloom.broadcast.maxBytes")


def test_stages_hand_rows_to_python_in_small_batches(spark, no_documents):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(30, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1_000_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    try:
        for given, kept in (("64m", str(BATCH_BYTES)), ("1g", str(BATCH_BYTES)), ("1m", "1m"), ("1000", "1000")):
            spark.conf.set(key, given)
            small_batches(spark)
            assert spark.conf.get(key).rstrip("b") == kept
        spark.conf.set(key, "64m")
        corpus_pipeline.without_copies(spark, no_documents, "")
        seen = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(seen) == 30
        assert max(seen) <= BATCH_BYTES // 1_000_000 + 1
    finally:
        spark.conf.set(key, before)
