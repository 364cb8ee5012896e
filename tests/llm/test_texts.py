"""Personal data, language and main text."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from atlasloom.llm import language, main_text, private_data

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.findall("[0-9]", m)) <= 19 and private_data.luhn("".join(re.findall("[0-9]", m)))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.findall("[0-9]", m)) <= 15),
]


def plain(text: str) -> str:
    found = sorted((m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(m.group()))
    return ",".join(f"{k}:{i}:{j}" for i, _, k, j in found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", "@x.yz", "_", ".", "-", "+", "1", "22", "256", " ", "(", ")", "4111 1111 1111 1111", "+49 30 1234567", "1.2.3.4", "١", "é", "\n"]), max_size=25).map("".join))
def test_patterns(text):
    assert private_data.joined(private_data.base_spans(text)) == plain(text)


def test_field_carries_labels(spark):
    text = "call +49 30 1234567 now. Later: 030 1234567 again, not 555 0000 or 2024. mail ann.lee@mail.example.com, and again ann.lee@mail"
    docs = spark.createDataFrame([(1, text), (2, "number 030 1234567 alone")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in private_data.find_private(docs).collect()}
    spans = [text[int(i):int(j)] for _, i, j in (s.split(":") for s in found[1]["spans"].split(","))]
    assert "030 1234567" in spans and "555 0000" not in spans and "2024" not in " ".join(spans)
    assert found[1]["n_added"] >= 1 and found[1]["n_phone"] == 1 and found[1]["n_email"] == 1
    assert found[1]["base_sha256"] == hashlib.sha256(plain(text).encode()).hexdigest()
    assert found[2]["spans"] == "" and found[2]["n_added"] == 0


def test_field_carries_labels_in_a_large_corpus(spark):
    """One like mention is enough, however many units of its shape have no label."""
    text = "call +49 30 1234567 now, at 11 or 12, later 030 1234567, not 030 7654321"
    other = "host 10.0.0.12 is up, see ip-10-0-0-12, not 10-0-0-13 or 555 100 0012; 192.168.1.10 is not 02168110, and 256.1.1.1 256.1.1.1 is none"
    rows = [(1, text), (2, other), *((i, f"{i % 7}: 0{i % 90 + 10} {i * 977 % 9_000_000 + 1_000_000}, {i % 5} and x@y, 10-{i % 7}-0-{i % 90}") for i in range(3, 3000))]
    rows += [(i, f"+49 30 {i * 977 % 9_000_000 + 1_000_000} is not {i} 33; bob.{i}@mail.example.com is not x@y") for i in range(3000, 3500)]
    found = {r["doc_id"]: r for r in private_data.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    spans = lambda i, t: [(k, t[int(a):int(b)]) for k, a, b in (s.split(":") for s in found[i]["spans"].split(","))]
    assert spans(1, text) == [("phone", "+49 30 1234567"), ("phone", "030 1234567")]
    assert spans(2, other) == [("ip", "10.0.0.12"), ("ip", "10-0-0-12"), ("ip", "192.168.1.10")]
    assert all(found[i]["n_added"] == 0 for i, _ in rows[2:])


def test_field_runs_without_patterns(spark):
    """Shapes and likeness alone may tell a label."""
    import numpy as np

    phone = np.array([-2.5, -2.5, -2.5, 0.0, -2.5])
    docs = spark.createDataFrame([(1, "030 1234567 or 030 1234567"), (2, "030 1234567"), (3, None)], "doc_id long, text string")
    model = {"_9-11": phone, "0_9-11": phone}, np.zeros((5, 5))
    assert {r["doc_id"]: r["n_added"] for r in private_data.find_private(docs, model).collect()} == {1: 2, 2: 0, 3: 0}


def test_marginals_are_exact_on_a_tree():
    import numpy as np

    rng = np.random.default_rng(3)
    nodes, edges, tables = rng.normal(size=(3, 5)), np.array([(0, 1), (1, 2)]), rng.normal(size=(2, 5, 5))
    joint = np.exp(nodes[0][:, None, None] + nodes[1][None, :, None] + nodes[2] + tables[0][:, :, None] + tables[1][None])
    want = joint.sum((0, 2)) / joint.sum()
    assert private_data.marginals(nodes, edges, tables, rounds=60)[1] == pytest.approx(want)


def test_private_odd(odd_documents, no_documents):
    assert private_data.find_private(odd_documents).count() == odd_documents.count()
    assert private_data.find_private(no_documents).count() == 0
    dense = "1 " * 20_000 + "@" * 2_000 + "9" * 50_000 + "a" * 50_000 + "@"
    assert private_data.joined(private_data.base_spans(dense)) == ""


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = language.learn(docs.filter(~language.held_out()))
    got = language.identify(docs, learned, language.held_out().alias("held_out")).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 100 and sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd(odd_documents, no_documents):
    learned = language.learn(odd_documents)
    got = {(r["doc_id"], r["lang_pred"]) for r in language.identify(odd_documents, learned).collect()}
    assert {(3, "und"), (4, "und"), (8, "und"), (10, "und")} <= got and set(learned) == {"en", "fr", "de"}
    assert {r["lang_pred"] for r in language.identify(odd_documents, language.learn(no_documents)).collect()} == {"und"}
    assert language.identify(no_documents, learned).count() == 0


def test_kept_vectors_do_not_matter():
    grams = language.grams_of("some letters to bind")
    many, few = language.Profiles(), language.Profiles(kept=4)
    assert (many.vectors(grams) == few.vectors(grams)).all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">A</a></ul></nav><div class="ad">buy</div><article><h1>Title &amp; more</h1>
<p><b>First   line<br>goes on.<p>Second&nbsp;para.</p><form>sign up</form><div class="comments"><p>me too</p></div></article><footer>&copy;</footer></body></html>"""


def test_named_article():
    assert main_text.extract(PAGE) == "Title & more\nFirst line goes on.\nSecond para."


def test_style_tree_removes_what_a_site_repeats(spark, no_documents):
    page = "<html><body><div class='top'><span>Always the same words here</span></div><div class='body'><p>{}</p></div><div class='end'>Same old ending line</div></body></html>"
    pages = [(i, f"http://site.example/{i}", page.format(f"story number {i} tells of thing{i} and item{i * 7}")) for i in range(12)]
    pages += [(50, None, PAGE), (51, "not a url", None), (52, "http://[bad", ""), (52, "http://[bad", ""), (None, "http://other.example/", "<p>one &lt;b&gt; page"), (53, "http://x/", "<![odd <!-- <p>a</p")]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, low string")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in main_text.main_text(df).collect()}
    for i in range(12):
        want = f"story number {i} tells of thing{i} and item{i * 7}"
        assert got[i, f"http://site.example/{i}"] == (want, len(want))
    assert got[51, "not a url"] == ("", 0) and got[None, "http://other.example/"][0] == "one <b> page"
    assert main_text.main_text(df).count() == len(pages)
    assert main_text.main_text(df.limit(0)).count() == 0


def extracted(spark, page, n=12):
    df = spark.createDataFrame([(i, f"http://site.example/{i}", page(i)) for i in range(n)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in main_text.main_text(df).collect()}


def test_style_tree_decides_in_and_beside_articles(spark):
    """What all pages of a host repeat goes from an article too, and what is each page's own stays beside a teaser."""
    def page(i):
        return (f"<html><body><div class='x1'>Welcome to the same old site</div><article class='t'>teaser{i} of{i}</article><div class='x2'><p>body{i} has{i} words{i}</p>"
                f"<div class='x3'><i></i>Sign up for our letter <b>today</b></div></div><article><p>part{i} two{i}</p><div class='x3'><i></i>Sign up for our letter <b>today</b></div></article></body></html>")

    assert extracted(spark, page) == {i: f"teaser{i} of{i}\nbody{i} has{i} words{i}\npart{i} two{i}" for i in range(12)}
    # one article under many menus is still the text of its pages, and without other pages a name decides
    assert set(extracted(spark, lambda i: f"<nav>{i}</nav><article><p>one text</p></article>").values()) == {"one text"}
    assert extracted(spark, page, 1)[0] == "teaser0 of0\npart0 two0\nSign up for our letter today"


def test_all_words_of_an_element_count(spark):
    """Neither a common beginning nor an inserted word hides what the rest of an element is."""
    same, long = "these eight words begin all of the paragraphs", "c" * 60
    page = "<html><body><div class='x1'>{}</div><div class='x2'>{}</div><div class='{}'>{}</div><div class='{}'>{}</div><div class='a/b'>{}</div></body></html>"

    def parts(i):
        notice = "please do sign up here to get our weekly letter by mail today and save".split()
        notice.insert(i % 12, f"extra{i}")
        own = " ".join(f"own{k}of{i}" for k in range(7))
        return f"{same} {own}", " ".join(notice), long + "1", "nothing but the same here", long + "2", f"tail{i} of{i}", f"last{i} one{i}"

    want = {i: "\n".join(parts(i)[k] for k in (0, 5, 6)) for i in range(12)}
    assert extracted(spark, lambda i: page.format(*parts(i))) == want


def test_sample_pages(spark):
    """Pages of the tables hold one article of headings and paragraphs."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    import html

    for r in main_text.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
