"""Spelling variants, URL verdicts and the manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import Row

from atlasloom.llm import manifest, near_copies, spelling, url_filter
from atlasloom.llm.queries import URL_RULES

# --- spelling ----------------------------------------------------------------


def plain_words(docs: list[tuple]) -> Counter:
    found: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            found[word] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= 7 and n >= 2})


def near(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b) + 1 or (a[0] != b[0] and a[-1] != b[-1]):  # words of seven letters and more
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain_variants(words: Counter) -> dict[str, tuple]:
    out = {}
    links = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        best = min(links[w], key=lambda v: (-words[v], v), default=None)
        out[w] = (n, len(links[w]), best if best and words[best] >= 10 * n else None)
    def root(w):
        return root(out[w][2]) if out[w][2] else w
    return {w: (w, n, k, f, words[f] if f else None, root(w)) for w, (n, k, f) in out.items()}


def edited(rng: random.Random, word: str, letters: str) -> str:
    i, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:i] + (rng.choice(letters) if kind else "") + word[i + (kind != 1):]


def word_table(spark, words: Counter):
    return spark.createDataFrame([Row(word=w, n=n) for w, n in words.items()], "word string, n long")


def variant_rows(df) -> dict[str, tuple]:
    return {r.word: (r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize(("letters", "longest"), [("ab", 64), ("abcdeéÿ", 64), ("abcde", 8), ("ab", 9)])
def test_variants_equal_all_pairs(spark, letters, longest):
    """Few letters give long runs and dense neighbourhoods; a low limit sends words through the comparison of long ones too."""
    rng = random.Random(len(letters) * longest)
    words: Counter = Counter()
    for _ in range(30):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 11)))
        words[word] += rng.choice([2, 30, 500])
        for _ in range(6):
            other = edited(rng, rng.choice(list(words)), letters)
            if len(other) >= 7:
                words[other] += rng.choice([2, 3, 40])
    got = variant_rows(spelling.variants(word_table(spark, words), longest=longest))
    assert got == plain_variants(words)


def test_long_words(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdef") for _ in range(30_000)) + "f"
    words = Counter({base: 50, base[:11] + "x" + base[12:]: 2, base[:-1]: 3, base[1:] + "q": 4, "a" * 64: 9, "a" * 65: 2, "a" * 66: 100})
    got = variant_rows(spelling.variants(word_table(spark, words)))
    want = {w: (w, n, k, f, words.get(f), r) for w, n, k, f, r in [
        (base, 50, 2, None, base), (base[:11] + "x" + base[12:], 2, 1, base, base), (base[:-1], 3, 1, base, base),
        (base[1:] + "q", 4, 0, None, base[1:] + "q"), ("a" * 64, 9, 1, None, "a" * 64), ("a" * 65, 2, 2, "a" * 66, "a" * 66),
        ("a" * 66, 100, 1, None, "a" * 66)]}
    assert got == want


def test_spelling_on_odd_documents(spark, odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert variant_rows(spelling.variants(spelling.vocabulary(odd_documents))) == plain_variants(plain_words(docs))
    assert spelling.variants(spelling.vocabulary(no_documents)).collect() == []


def test_vocabulary(spark):
    texts = [(i, "École écoles ÉCOLES différent Différent×unteilbarŸabcdefgh İstanbullu STRASSEN " * (1 + i % 3)) for i in range(200)]
    got = {r.word: r.n for r in spelling.vocabulary(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == plain_words(texts)
    assert any(len(w) == 8 and n > 100 for w, n in got.items())


# --- URLs --------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/x?y#z", "http://example.net/de/", "http://net", "http://net/", "http://xnet/",
    "http://a.b.example.com/de/1", "http://notexample.com/de/1", "http://fr.org/fr/?a=/en/", "http://w.org#/fr/", "http://w.com/essex/sex",
    "http://w.com/Sex/POKER", "http://w.com/poker/poker?poker", "http://p%6frn.com/x", "http://w.com/%20porn%20", "http://w.com/éporn", "http://w.com/porn—x",
    "http://spam-farm.w.org/", "http://w.com/spam-farms", "javascript:porn", "http://user@w.com:80/x", "http://w.com/a\nporn\nb", "http://w.com/%41%%34%zz",
    "http://.net./x", "http://w.com/" + "x/" * 50_000 + "poker/casino", "ftp://example.net/EN/", "http://www.example.net/en", "http://w.com/xxx1 1xxx xxx",
]


def test_urls_equal_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    data = [*enumerate(URLS), (3, "http://net/x"), (None, "http://net/x"), (3, "http://net/x")]
    con.executemany("INSERT INTO pages VALUES (?, ?)", data)
    rules = [*URL_RULES, ("a.b.example.com", "/", "allow"), ("W.com", "/", "allow"), ("w.com", "/", "block"), ("com", "/es", "allow")]
    rules[-3:] = []  # the vocabulary has to decide on the others
    want = con.execute(url_filter.judge_sql(rules)).fetchall()
    names = [d[0] for d in con.description]
    pages = spark.createDataFrame([(*r, "x", "y") for r in data], "page_id long, url string, host string, rule string")
    got = [tuple(r) for r in url_filter.judge(pages, rules).select(*names).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_url_verdicts(spark):
    pages = spark.createDataFrame([Row(page_id=i, url=u) for i, u in enumerate(URLS)], "page_id long, url string")
    by_url = {u: r for u, r in zip(URLS, sorted(url_filter.judge(pages, URL_RULES).collect(), key=lambda r: r.page_id), strict=True)}
    assert by_url[None].verdict == "allow" and by_url[None].host == "" and by_url[None].path == ""
    assert (by_url["https://A.Example.NET/en/x?y#z"].rule, by_url["https://A.Example.NET/en/x?y#z"].verdict) == ("example.net/en/", "allow")
    assert by_url["http://net"].rule is None and by_url["http://net/"].verdict == "block"
    assert by_url["http://w.com/essex/sex"].soft_hits == 1 and by_url["http://w.com/essex/sex"].verdict == "allow"
    assert by_url["http://w.com/poker/poker?poker"].verdict == "allow" and by_url["http://w.com/Sex/POKER"].verdict == "block"
    assert by_url["http://p%6frn.com/x"].verdict == "block" and by_url["http://w.com/éporn"].verdict == "allow"
    assert url_filter.judge(pages.filter("1 = 0"), URL_RULES).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, [], {}).collect()} == {"allow"}
    with pytest.raises(ValueError):
        url_filter.judge(pages, [], {"Porn": 1.0})


def test_longest_rule_wins():
    rules = url_filter.Rules([("net", "/", "block"), ("a.net", "/", "allow"), ("net", "/aa", "block"), ("a.net", "/", "block"), ("a.net", "/x/", "allow")])
    assert rules.find("b.a.net", "/aa") == ("a.net/", "block")  # as long as net/aa, longer host; block before allow
    assert rules.find("a.net", "/x/y") == ("a.net/x/", "allow")
    assert rules.find("net", "/") == ("net/", "block")
    assert rules.find("xnet", "/") is None


# --- manifest ----------------------------------------------------------------


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes: list[str]) -> tuple[str, list[list[list[str]]]]:
    """Root, and for each leaf the (left, right) siblings of each level."""
    paths: list[list] = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = range(0, len(nodes), 3)
        for at in runs:
            run = nodes[at:at + 3]
            for j in range(len(run)):
                for leaf in below[at + j]:
                    paths[leaf].append((run[:j], run[j + 1:]))
        below = [sum(below[at:at + 3], []) for at in runs]
        nodes = [digest(*nodes[at:at + 3]) for at in runs]
    return nodes[0], paths


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = {}, []
    for source in sources:
        mine = []
        for doc_id, _, lang, n_chars, text in (r for r in rows if r[1] == source):
            head = "".join(map(enc, (doc_id, source, lang, n_chars)))
            cut = text if text is None or doc_id is None or zlib.crc32(str(doc_id).encode()) % 2 else text.replace("\n", "")
            mine.append((doc_id, digest(head, enc(text)), digest(head, enc(cut))))
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        subs[source] = (mine, *tree([m[1] for m in mine]))
    root, above = tree([subs[s][1] for s in sources])
    for place, source in enumerate(sources):
        mine, sub, paths = subs[source]
        for (doc_id, leaf, changed), path in zip(mine, paths, strict=True):
            node, proof = changed, []
            for left, right in [*path, *above[place]]:
                proof += left + right
                node = digest(*left, node, *right)
            out.append((doc_id, leaf, sub, root, digest(*proof), node, node == root))
    return out


def manifest_rows(df) -> list[tuple]:
    return sorted((tuple(r)[:7] for r in df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"hot": 800, None: 1, "a": 2, "é": 3, "z": 244, "": 9}, {"one": 1}, {"one": 3}, {f"s{i:03}": 1 + i % 2 for i in range(90)}, {None: 730}])
def test_manifest_equals_plain_trees(spark, sizes):
    """Sources beyond a block of 243 leaves, lone leaves, and more sources than a run of the upper tree."""
    rng, rows = random.Random(7), []
    for source, n in sizes.items():
        for i in range(n):
            rows.append((rng.choice([i, i, i - 1, None]) if n > 5 else i * 5, source, rng.choice(["en", None, ""]), rng.choice([i, None]),
                         rng.choice([None, "", f"line {i}\nother é\n", "plain", "\n"])))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = manifest_rows(manifest.manifest(docs))
    assert got == sorted(plain_manifest(rows), key=repr)
    assert len(rows) < 100 or {r[-1] for r in got} == {True, False}


def test_manifest_on_odd_documents(spark, odd_documents, no_documents):
    picked = [tuple(r) for r in odd_documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert manifest_rows(manifest.manifest(odd_documents)) == sorted(plain_manifest(picked), key=repr)
    assert manifest.manifest(no_documents).collect() == []


def test_copies_bound_the_leaves_of_a_key(spark):
    """No node of the stored levels is asked for by more leaves than a block has."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars", "'t' AS text")
    found, _ = manifest.leaves(docs)
    levels, roots = manifest.grow(found.selectExpr("tree", "first", "n", "row - first AS place", "leaf AS digest"), 3000)
    assert [(r.height, r.n) for r in roots.collect()] == [(8, 3000)]
    steps = manifest.climb(found.selectExpr("row", "changed AS digest"), manifest.linked(roots, levels, []), lambda steps: steps)
    assert steps.count() == 3000 * 9
    most = steps.filter(f"(node & 63) > {manifest.SHARED}").groupBy("node").count().agg({"count": "max"}).first()[0]
    assert most == 3 ** manifest.SHARED


def test_words_leave_a_task_in_small_batches(spark, monkeypatch):
    """A large batch of texts is not held a second and third time by the worker; every text's words still arrive once."""
    sizes = []
    of = near_copies.pa.RecordBatch.from_arrays
    texts = [f"{'word ' * 30}number {i % 90}" for i in range(100)] + ["", None]
    monkeypatch.setattr(near_copies, "WORD_BYTES_AT_ONCE", 1000)

    class Docs:
        def select(self, _):
            return self

        def mapInArrow(self, run, schema):
            batch = of([near_copies.pa.array(texts)], names=["text"])
            sizes.extend((b.num_rows, b.nbytes) for b in run(iter([batch])))
            rows = [tuple(bytes(v) for v in r) for b in run(iter([batch])) for r in zip(*b.to_pydict().values(), strict=True)]
            return spark.createDataFrame(rows, schema)

    keys = spark.createDataFrame([(near_copies.words_key(t.encode(), near_copies.words_of(t.encode())),) for t in set(texts) - {None}], "words_key binary")
    assert near_copies._word_texts(Docs(), keys).count() == 91
    assert sum(n for n, _ in sizes) == 102 and max(b for _, b in sizes) < 5000
