"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: pages that have an element at the same path of tags and classes share its node.
A node knows in which styles (sequences of child elements) and with which contents its pages use it. Its importance is

* of an inner node: the entropy of its styles over its pages (1 if only one page has it), mixed with its children's,
* of a leaf: one minus the mean entropy of its content features over pages - what all pages repeat is worth nothing.

Branches of low importance are removed from each page, inside an ``article`` or ``main`` as elsewhere. Such a name, or a class
like it, is a prior only, worth a few pages: for what it holds, against what lies outside it. Much that pages of a site repeat is
removed from an article too, and what their other text is unique in is kept beside one. What an element says it is besides the
text (navigation, footer, form, script, advert, comment, ...) is taken at its word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import text_key, texts, written
from atlasloom.sizing import broadcast_if_small

LEAST_IMPORTANCE = 0.2
DAMPING = 0.9
#: Prior importance and the pages it counts for: of a branch inside a named article, on a page without one, and outside one.
INSIDE, NEUTRAL, OUTSIDE = (0.5, 2), (0.3, 2), (0.0, 5)

#: Elements by what they are for.
NOISE = frozenset("nav footer header aside form script style noscript template iframe svg canvas button select textarea input label menu dialog object embed head title meta link fieldset option audio video map".split())
CONTENT = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
NOISE_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|footer|header|masthead|sidebar|side-bar|aside|widget\w*|related|share|social|cookie\w*|consent|gdpr|notices?|popup|modal|newsletter|subscribe|signup|login|comments?|respond|disqus|replies|pagination|pager|skip-link|copyright|legal|toolbar)(?:$|[-_ 0-9])", re.I)
CONTENT_NAMES = re.compile(r"(?:^|[-_ ])(?:article(?:-?body|-?content|-?text)?|post-?(?:body|content|text)|entry-?(?:content|body)|story(?:-?body)?|main-?(?:content|text))(?:$|[-_ ])", re.I)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())


@dataclass
class Node:
    tag: str
    name: str = ""
    purpose: str = ""  # "noise", "content" or neither
    children: list = field(default_factory=list)  # nodes and strings


class _Builder(HTMLParser):
    """A tree of elements; end tags that are left out are closed as HTML does for blocks, items and cells."""

    _SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close("p", {"article", "section", "div", "td", "th", "li", "body", "blockquote", "main", "aside", "nav", "footer", "header"})
        for sibling in self._SIBLINGS.get(tag, ()):
            self._close(sibling, {"ul", "ol", "dl", "table", "select", "tbody", "thead"})
        given = {k: v or "" for k, v in attrs}
        words = f"{given.get('class', '')} {given.get('id', '')}".strip()
        node = Node(tag, ".".join(sorted(given.get("class", "").split())).replace("/", "%2F"), _purpose(tag, words, given))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._close(tag, set())

    def _close(self, tag, stop):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in stop:
                return

    def parse_marked_section(self, i, report=1):
        """What begins with ``<![`` is a comment up to the next ``>``; the parser would refuse unknown sections."""
        end = self.rawdata.find(">", i + 3)
        return len(self.rawdata) if end < 0 else end + 1

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _purpose(tag: str, words: str, attrs: dict[str, str]) -> str:
    if tag in ("html", "body"):
        return ""
    if tag in CONTENT:
        return "content" if not (words and NOISE_NAMES.search(words)) else "noise"
    if tag in NOISE or attrs.get("role", "").lower() in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return "noise"
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return "noise"
    if words and CONTENT_NAMES.search(words):
        return "content"
    return "noise" if words and NOISE_NAMES.search(words) else ""


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


# --- the tree ----------------------------------------------------------------


def _above_content(root: Node) -> set[int]:
    """Ids of the nodes that hold an article, each article not counted; none if the page names none."""
    above: set[int] = set()
    stack: list[tuple[Node, tuple]] = [(root, ())]
    while stack:
        node, parents = stack.pop()
        if node.purpose == "content":
            while parents and id(parents[0]) not in above:
                above.add(id(parents[0]))
                parents = parents[1]
            continue
        stack += [(c, (node, parents)) for c in node.children if isinstance(c, Node) and c.purpose != "noise"]
    return above


#: What a page tells of a node, by the letter it is counted under.
KINDS = {"page": "p", "style": "s", "word": "w", "beside": "b", "beside text": "t"}


def style_rows(root: Node) -> dict[tuple[str, str], set[str]]:
    """Values by ``path, kind``: the style and content features that a page gives to each node of its site's tree.

    All distinct words of a node are features. Runs of the same child count once; noise by name needs no statistics. ``beside`` marks the topmost branches outside a page's
    article, ``beside text`` the nodes above it that have text of their own.
    """
    rows: dict[tuple[str, str], set[str]] = {}
    above = _above_content(root)
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        elements = [c for c in node.children if isinstance(c, Node) and c.purpose != "noise" and c.tag not in VOID]
        signs = [f"{c.tag}.{c.name}" for c in elements]
        paths = [f"{path}/{s}" for s in signs]
        rows[path, "page"] = {""}
        rows.setdefault((path, "style"), set()).add(",".join(s for i, s in enumerate(signs) if i == 0 or signs[i - 1] != s))
        words = " ".join(c for c in node.children if isinstance(c, str)).lower().split()
        if words:
            rows.setdefault((path, "word"), set()).update(words)
        if id(node) in above:
            if words:
                rows[path, "beside text"] = {""}
            rows |= {(p, "beside"): {""} for p, c in zip(paths, elements, strict=True) if c.purpose != "content" and id(c) not in above}
        stack += zip(paths, elements, strict=True)
    return rows


def site_statistics(pages: DataFrame) -> DataFrame:
    """``host, path, pages, styles, words, beside, beside_text``: entropies of each node over the pages of its host with
    different html.

    Each of k rows with the same html counts a k-th, so that no html is shuffled unless very many are repeated. Counted by
    (host, path, value) first, so no task holds a host: a host's share of a node is a number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}  # by kind, host and path; a host has no slash, a path begins with one
        held = 0

        def rows() -> pa.RecordBatch:
            sizes = [len(c) for c in counts.values()]
            nodes = pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(sizes), dtype="int32"), sizes), pa.array(counts, pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [nodes, pa.array([v for c in counts.values() for v in c], pa.string()), pa.array([n for c in counts.values() for n in c.values()], pa.float64())],
                names=["node", "value", "n"])

        for batch in batches:
            for host, html, copies in zip(batch.column("host").to_pylist(), texts(batch.column("html")), batch.column("copies").to_pylist(), strict=True):
                for (path, kind), values in style_rows(parse(html)).items():
                    counter = counts.setdefault(f"{KINDS[kind]}{host}{path}", Counter())
                    held -= len(counter)
                    counter.update(values if copies == 1 else dict.fromkeys(values, 1 / copies))
                    held += len(counter)
                if held > 400_000:
                    yield rows()
                    counts.clear()
                    held = 0
        yield rows()

    keyed = pages.select(_host().alias("host"), "html", text_key("html").alias("html_key")).filter("html IS NOT NULL")
    repeated = keyed.groupBy("host", "html_key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    shares = keyed.join(broadcast_if_small(written(repeated, "repeated-pages"), keep=False), ["host", "html_key"], "left")
    counted = shares.select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies")).mapInArrow(run, "node string, value string, n double")
    values = counted.groupBy("node", "value").agg(F.round(F.sum("n"), 6).alias("n"))
    is_kind = lambda kind: F.substring("node", 1, 1) == KINDS[kind]
    of = lambda kind, x: F.sum(F.when(is_kind(kind), x))
    n = F.col("n")
    sums = values.groupBy(F.expr("substring(node, 2)").alias("place")).agg(
        F.round(of("page", n)).cast("long").alias("pages"), of("style", n).alias("style_n"), of("style", n * F.log("n")).alias("style_nlogn"),
        of("word", n).alias("word_n"), of("word", n * F.log("n")).alias("word_nlogn"),
        F.max(is_kind("beside")).alias("beside"), F.max(is_kind("beside text")).alias("beside_text"))
    m = F.log(F.greatest(F.col("pages"), F.lit(2)))
    # of styles, -sum p log_m p = (log N - sum n log n / N) / log m; a word on n of m pages has entropy log n / log m
    styles = F.least(F.lit(1.0), (F.log("style_n") - F.col("style_nlogn") / F.col("style_n")) / m)
    host = F.substring_index("place", "/", 1)
    return sums.select(host.alias("host"), F.col("place").substr(F.length(host) + 1, F.length("place")).alias("path"), "pages", styles.alias("styles"), (F.col("word_nlogn") / (F.col("word_n") * m)).alias("words"), "beside", "beside_text")


def _host():
    """The host of a url in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def importance(tree: dict[str, tuple[int, float, float | None]]) -> dict[str, float]:
    """Composite importance of each path of one site: a child's share counts through its parent, deepest first."""
    children: dict[str, list[str]] = {}
    for path in tree:
        if path:
            children.setdefault(path.rpartition("/")[0], []).append(path)
    out: dict[str, float] = {}
    for path in sorted(tree, key=lambda p: -p.count("/")):
        pages, styles, words = tree[path]
        own = 0.0 if words is None else 1.0 - words  # without text there is nothing to keep
        below = [out[c] for c in children.get(path, [])]
        if below:
            fade = DAMPING ** len(below)
            inner = (1 - fade) * (1.0 if pages == 1 else max(0.0, styles)) + fade * sum(below) / len(below)
            out[path] = max(inner, max(below), own) if own or any(below) else 0.0
        else:
            out[path] = own
    return out


def believed(measured: float, pages: int, prior: tuple[float, int]) -> float:
    """Importance as measured on so many pages, with the prior's pages beside them."""
    value, weight = prior
    return (weight * value + pages * measured) / (weight + pages)


# --- extraction --------------------------------------------------------------


class _Text:
    """Collects blocks: white space inside one is one space, empty blocks are none."""

    def __init__(self):
        self.blocks: list[str] = []
        self.parts: list[str] = []

    def end(self) -> None:
        block = " ".join("".join(self.parts).split())
        if block:
            self.blocks.append(block)
        self.parts = []


#: How a site's paths are marked: low anywhere, low but for an article's, worth keeping beside an article, whose own text is so.
LOW, LOW_OUTSIDE, BESIDE, BESIDE_TEXT = "-~+*"


def extract(html: str, marks: frozenset[str] = frozenset()) -> str:
    """The main text: branches of noise, and of the paths marked low, are left out; where the page names its article, of the
    rest only what is marked is kept. An article that would lose all its text, as all pages repeat it, keeps it.
    """
    root = parse(html)
    above = _above_content(root)
    text = _Text()
    kept = False
    stack: list = [(root, "", "outside" if above else "free")]
    while stack:
        item, path, where = stack.pop()
        if item is None:
            text.end()
        elif isinstance(item, str):
            if where != "outside" or BESIDE_TEXT + path in marks:
                text.parts.append(item)
                kept = kept or (where == "inside" and not item.isspace())
        elif item.tag == "br" or item.tag == "wbr":
            text.parts.append(" " if item.tag == "br" else "")
        elif item.purpose != "noise":
            if where == "outside":
                if id(item) not in above:
                    where = "inside" if item.purpose == "content" else "free" if BESIDE + path in marks else ""
            elif LOW + path in marks or (where == "free" and LOW_OUTSIDE + path in marks):
                where = ""
            if where:
                if item.tag in BLOCKS:
                    text.end()
                    stack.append((None, "", ""))
                stack += [(c, f"{path}/{c.tag}.{c.name}" if isinstance(c, Node) else path, where) for c in reversed(item.children)]
    text.end()
    if above and not kept and any(m[0] == LOW for m in marks):
        return extract(html, frozenset(m for m in marks if m[0] != LOW) | {LOW_OUTSIDE + m[1:] for m in marks if m[0] == LOW})
    return "\n".join(text.blocks)


def low_paths(statistics: DataFrame, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """``host, low``: the marked paths of pages of each host. A host's paths are those of its templates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, lows = [], []
            for host, nodes in zip(batch.column("host").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                tree = {n["path"]: (n["pages"], n["styles"], n["words"]) for n in nodes}
                found = importance(tree)
                marks = []
                for n in nodes:
                    path, m = n["path"], n["pages"]
                    if path and believed(found[path], m, NEUTRAL) < least:
                        marks.append((LOW if believed(found[path], m, INSIDE) < least else LOW_OUTSIDE) + path)
                    if n["beside"] and believed(found[path], m, OUTSIDE) >= least:
                        marks.append(BESIDE + path)
                    if n["beside_text"] and believed(1.0 - n["words"], m, OUTSIDE) >= least:
                        marks.append(BESIDE_TEXT + path)
                hosts.append(host)
                lows.append(sorted(marks))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(lows, pa.list_(pa.string()))], names=["host", "low"])

    trees = statistics.groupBy("host").agg(F.collect_list(F.struct("path", "pages", "styles", "words", "beside", "beside_text")).alias("nodes"))
    return trees.mapInArrow(run, "host string, low array<string>").filter(F.size("low") > 0)


def main_text(pages: DataFrame, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; null html has an empty text, pages without a url share one host."""
    low = broadcast_if_small(written(low_paths(site_statistics(pages), least), "marks"), keep=False)
    named = pages.select("page_id", "url", "html", _host().alias("host"))
    joined = named.join(low, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(h, frozenset(p or ())) for h, p in zip(texts(batch.column("html")), batch.column("low").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return joined.select("page_id", "url", "html", "low").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
