"""Verdicts on URLs: host rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

A rule is ``(host, path, verdict)`` and fits its host and all subdomains of it, where the URL's path starts with the rule's; of
several that fit, the longest (host and path together, then host) decides, ``block`` before ``allow`` between equal ones. URLs
without a rule are judged by their words: strict terms weigh 1 or more and reject alone, soft terms weigh less, each distinct one counts
once, and ``REJECT`` is reached by several. A hit has to stand by itself: neither neighbour may be a letter or a digit, so ``sex``
is not found in ``essex``. Percent escapes of ASCII are read as the characters that they stand for.

Null URLs have empty host and path, no hits, and are allowed; an empty table gives no rows; repeated rows give repeated results;
a URL of any length is read whole, once; further columns of the table are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from atlasloom.llm.common import texts

Rule = tuple[str, str, str]

#: Vocabulary of unwanted pages: one strict term rejects, soft ones only together.
STRICT = ("porn porno xxx hentai milf nsfw camgirls escorts warez keygen torrentz spam-farm link-farm linkfarm doorway-page "
          "viagra cialis malware phishing payday-loans casino-bonus").split()
SOFT = ("adult sex nude naked casino poker betting gambling slots jackpot pills pharmacy crack cracked serial torrent download "
        "free-download cheap discount replica loans bitcoin-doubler click-here buy-now seo backlinks spam scam hack dating").split()
VOCABULARY: dict[str, float] = {**dict.fromkeys(SOFT, 0.5), **dict.fromkeys(STRICT, 1.0)}
REJECT = 1.0
#: Rules and terms travel to every worker: more than this many are refused.
MOST_ENTRIES = 500_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ESCAPE = re.compile(r"%([0-7][0-9a-f])")
_PART_OF_WORD = re.compile(r"[a-z0-9À-\U0010FFFF]")


def parts(url: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = re.split(r"[?#]", url[at + 3:], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class Rules:
    """Rules by host; a URL looks up each ending of its host that starts at a label."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host.translate(_LOWER), []).append((path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        at = 0
        while at >= 0:
            ending = host[at:]
            for start, verdict in self.by_host.get(ending, ()):
                if path.startswith(start):
                    key = (len(ending) + len(start), len(ending), verdict == "block")
                    if best is None or key > best[0]:
                        best = (key, ending + start, verdict)
            at = host.find(".", at) + 1 or -1
        return best and best[1:]


class Vocabulary:
    """An Aho-Corasick automaton over the terms, with their weights."""

    def __init__(self, weights: dict[str, float]):
        self.machine = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.machine.add_word(term, (term, weight))
        if weights:
            self.machine.make_automaton()

    def hits(self, url: str) -> dict[str, float]:
        """Distinct terms that stand by themselves in a URL, with their weights."""
        if not len(self.machine):
            return {}
        text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), url.translate(_LOWER)).translate(_LOWER)
        found = {}
        for end, (term, weight) in self.machine.iter(text):
            if term not in found:
                before, after = text[end - len(term):end - len(term) + 1] if end >= len(term) else "", text[end + 1:end + 2]
                if not _PART_OF_WORD.match(before) and not _PART_OF_WORD.match(after):
                    found[term] = weight
        return found


def judge(pages: DataFrame, rules: Iterable[Rule] = (), vocabulary: dict[str, float] | None = None, reject: float = REJECT) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_hits, weight`` of every row.

    ``rule`` is the host and path of the deciding rule, or null where the vocabulary decides: ``block`` where the weights of the
    distinct terms add up to ``reject``, else ``allow``. One pass over the rows, no shuffle.
    """
    rules, weights = list(rules), dict(VOCABULARY if vocabulary is None else vocabulary)
    if len(rules) + len(weights) > MOST_ENTRIES:
        raise ValueError(f"{len(rules) + len(weights)} rules and terms, at most {MOST_ENTRIES} go to every worker")
    if any(not term or term != term.translate(_LOWER) for term in weights):
        raise ValueError("terms are not empty and have no capitals")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, words = Rules(rules), Vocabulary(weights)
        for batch in batches:
            out: list[tuple] = []
            for url in texts(batch.column("url")):
                host, path = parts(url)
                hits = words.hits(url)
                rule = listed.find(host, path)
                # strict terms alone reach the limit; sums of a few weights are exact to far more than nine places
                total = round(sum(hits.values()), 9)
                verdict = rule[1] if rule else "block" if total >= reject else "allow"
                strict = sum(w >= reject for w in hits.values())
                out.append((host, path, rule[0] if rule else None, verdict, strict, len(hits) - strict, total))
            kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.float64()]
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "weight"])

    slim = pages.select("page_id", "url")
    return slim.mapInArrow(run, f"page_id {dict(slim.dtypes)['page_id']}, host string, path string, rule string, verdict string, "
                                "strict_hits long, soft_hits long, weight double")


def judge_sql(rules: Iterable[Rule], vocabulary: dict[str, float] | None = None, reject: float = REJECT) -> str:
    """The same verdicts in SQL: every rule and every term held against every URL."""
    weights = VOCABULARY if vocabulary is None else vocabulary
    letter = r"a-z0-9\x{00C0}-\x{10FFFF}"
    rule_rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    term_rows = ", ".join(f"('{t}', {w})" for t, w in weights.items())
    return rf"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {rule_rows}), terms(term, w) AS (VALUES {term_rows}),
u AS (SELECT row_number() OVER () AS n, page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT *, CASE WHEN contains(url, '://') THEN split_part(regexp_replace(url, '(?s)^.*?://', ''), '#', 1) ELSE '' END AS rest FROM u),
q AS (SELECT *, split_part(rest, '?', 1) AS clean FROM p),
h AS (SELECT n, page_id, url, translate(split_part(clean, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  CASE WHEN contains(clean, '/') THEN substr(clean, strpos(clean, '/')) ELSE '' END AS path,
  translate(array_to_string(list_transform(
    regexp_extract_all(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?s)%[0-7][0-9a-f]|.'),
    lambda x: CASE WHEN length(x) = 3 THEN chr(CAST('0x' || x[2:3] AS INTEGER)) ELSE x END), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS words FROM q),
fit AS (SELECT n, arg_max(r_host || r_path, key) AS rule, arg_max(r_verdict, key) AS r_verdict
  FROM (SELECT h.n, r.*, (length(r_host || r_path) * 1000 + length(r_host)) * 2 + (r_verdict = 'block')::INTEGER AS key FROM h JOIN rules r
    ON (h.host = r_host OR ends_with(h.host, '.' || r_host)) AND starts_with(h.path, r_path)) GROUP BY n),
hit AS (SELECT n, sum(w) AS weight, count(*) FILTER (WHERE w >= {reject}) AS strict_hits, count(*) FILTER (WHERE w < {reject}) AS soft_hits
  FROM h JOIN terms ON regexp_matches(words, '(^|[^{letter}])' || term || '([^{letter}]|$)') GROUP BY n)
SELECT page_id, host, path, rule,
  coalesce(r_verdict, CASE WHEN coalesce(round(weight, 9), 0) >= {reject} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(strict_hits, 0) AS strict_hits, coalesce(soft_hits, 0) AS soft_hits, coalesce(CAST(round(weight, 9) AS DOUBLE), 0) AS weight
FROM h LEFT JOIN fit USING (n) LEFT JOIN hit USING (n)"""
