"""Personal data: fixed patterns, and a skip-chain conditional random field that carries their labels to like tokens.

Units of a text are its runs of digits with separators and its tokens with an at sign. Each takes a label: one of the four
kinds or none. Potentials are

* of a unit's shape: log odds of labels counted over the whole corpus (every unit that a pattern covers or leaves),
* of neighbouring units: log odds of label pairs, counted likewise,
* of distant like units (same address, same last digits, or same name before the at sign): ``SKIP_WEIGHT`` if their labels
  agree. One edge to a labelled unit outweighs shape and neighbours, however rare the label is for them in the corpus.

Units that a pattern covers keep its label. Loopy belief propagation passes messages over all edges of a document, whether or
not a pattern covers anything in it, and a unit left over becomes a span of its own if some kind is likely enough. Patterns' own
spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import documents, texts

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LIMIT = 2.5
LIKELY = 0.9
#: A shape and two neighbours tell labels apart by at most LIMIT each; beyond them four labels at e**-4 leave 0.93.
SKIP_WEIGHT = 3 * LIMIT + 4.0
ROUNDS = 10
KEY_DIGITS = 7

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]*[0-9])*")
_TO_SPACE = re.compile(r"\S*")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octets(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the name before it, back to the last match at most, and the domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """``start, end, kind`` of the fixed patterns, by start and kind."""
    found = [(i, j, 0) for i, j in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if _octets(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _at_tokens(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        begin, end = at, _TO_SPACE.match(text, at).end()
        while begin > 0 and not text[begin - 1].isspace():
            begin -= 1
        yield begin, end
        at = text.find("@", end)


def units(text: str) -> list[tuple[int, int]]:
    found = list(_at_tokens(text))
    if _DIGIT.search(text):
        taken = iter([*found, (len(text) + 1, len(text) + 1)])
        begin, end = next(taken)
        for m in _NUMBER.finditer(text):
            while end <= m.start():
                begin, end = next(taken)
            if m.end() <= begin:
                found.append(m.span())
    return sorted(found)


def _fails(value: str, digits: str) -> bool:
    """An address with a number over 255, or as many digits as a card without its check digit."""
    if "@" in value:
        return False
    if _IP.fullmatch(value):
        return not _octets(value)
    return not value.startswith("+") and 12 <= len(digits) <= 19 and not luhn(digits)


def shape(value: str) -> str:
    """What potentials may depend on: at sign, plus, dots, spaces or hyphens, the number of digits in classes, and failed checks."""
    digits = _digits(value)
    n = len(digits)
    size = "0" if not n else "1-3" if n < 4 else "4-6" if n < 7 else "7-8" if n < 9 else "9-11" if n < 12 else "12-19" if n < 20 else "20"
    return f"{'@' * ('@' in value)}{'+' * value.startswith('+')}{min(value.count('.'), 4)}{'-' * ('-' in value)}{'_' * (' ' in value)}{size}{'!' * _fails(value, digits)}"


def likeness(value: str) -> list[str]:
    """Units that share a key are joined by skip edges.

    An address counts as a whole, with dots or with other separators; only without dots may its last digits count too.
    """
    if "@" in value:
        name = value.split("@")[0].strip("<([{\"'").lower()
        return [f"@{name}"] if len(name) > 2 else []
    parts = _DIGITS.findall(value)
    keys = []
    if len(parts) == 4 and not value.startswith("+") and _octets(".".join(parts)):
        keys.append(".".join(p.lstrip("0") or "0" for p in parts))
        if _IP.fullmatch(value.lstrip("(")):
            return keys
    digits = "".join(parts)
    return [*keys, digits[-KEY_DIGITS:]] if len(digits) >= KEY_DIGITS else keys


def keys_of(text: str, found: list[tuple[int, int]], base: list[Span]) -> list[list[str]]:
    """The keys of each unit; of one that holds more than an address, the address's."""
    addresses = [(i, j) for i, j, k in base if k == 1]
    out, at = [], 0
    for begin, end in found:
        while at < len(addresses) and addresses[at][1] <= begin:
            at += 1
        i, j = addresses[at] if at < len(addresses) and addresses[at][0] < end and "@" not in text[begin:end] else (begin, end)
        out.append(likeness(text[i:j]))
    return out


def labels_of(found: list[tuple[int, int]], base: list[Span]) -> list[int]:
    """The kind of the first pattern span that overlaps each unit, or none."""
    out, at = [], 0
    for begin, end in found:
        while at < len(base) and base[at][1] <= begin:
            at += 1
        overlap = [k for i, j, k in base[at:at + 4] if i < end and j > begin]
        out.append(overlap[0] if overlap else NONE)
    return out


# --- counting potentials -----------------------------------------------------


def count_potentials(docs: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Log potentials of shapes and of neighbouring labels from every text.

    Shapes are few by construction (some hundred at most), so the counts that reach the driver are bounded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in texts(batch.column(0)):
                found = units(text)
                if found:
                    labels = labels_of(found, base_spans(text))
                    counts.update((shape(text[i:j]), k) for (i, j), k in zip(found, labels, strict=True))
                    counts.update((f"pair {a}", b) for a, b in zip(labels, labels[1:], strict=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            names=["what", "label", "n"])

    rows = docs.select("text").mapInArrow(run, "what string, label int, n long").groupBy("what", "label").agg(F.sum("n").alias("n")).collect()
    seen: dict[str, np.ndarray] = defaultdict(lambda: np.ones(NONE + 1))
    for r in rows:
        seen[r["what"]][r["label"]] += r["n"]
    pairs = np.stack([seen.pop(f"pair {a}", np.ones(NONE + 1)) for a in range(NONE + 1)])
    independent = pairs.sum(1, keepdims=True) * pairs.sum(0, keepdims=True) / pairs.sum()
    bound = lambda x: np.clip(x, -LIMIT, LIMIT)
    return {k: bound(np.log(v / v.sum())) for k, v in seen.items()}, bound(np.log(pairs / independent)) / 2


# --- inference ---------------------------------------------------------------


def skip_edges(keys: list[list[str]], labels: list[int]) -> list[tuple[int, int]]:
    """Each unit with the one before of each of its keys, and with the first labelled one of that key."""
    before: dict[str, int] = {}
    anchor: dict[str, int] = {}
    for i, (own, label) in enumerate(zip(keys, labels, strict=True)):
        if label != NONE:
            for key in own:
                anchor.setdefault(key, i)
    edges: set[tuple[int, int]] = set()
    for i, own in enumerate(keys):
        for key in own:
            if key in before:
                edges.add((before[key], i))
            if anchor.get(key, i) != i:
                edges.add(tuple(sorted((anchor[key], i))))
            before[key] = i
    return sorted(edges)


def marginals(nodes: np.ndarray, edges: np.ndarray, tables: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Approximate marginals by sum-product messages, all edges at once, damped by half.

    ``nodes`` (n, labels) and ``tables`` (edges, labels, labels) are log potentials.
    """
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.exp(np.concatenate([tables, tables.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(source), nodes.shape[1]))
    for _ in range(rounds):
        belief = nodes.copy()
        np.add.at(belief, target, messages)
        incoming = belief[source] - messages[back]
        incoming = np.exp(incoming - incoming.max(1, keepdims=True))
        new = np.log(np.einsum("ei,eij->ej", incoming, both))
        messages = 0.5 * messages + 0.5 * (new - new.max(1, keepdims=True))
    belief = nodes.copy()
    np.add.at(belief, target, messages)
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


def find_spans(text: str, shapes: dict[str, np.ndarray], pairs: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Spans of the patterns, and spans that the field adds."""
    base = base_spans(text)
    found = units(text)
    labels = labels_of(found, base)
    if all(k != NONE for k in labels):
        return base, []
    values = [text[i:j] for i, j in found]
    skips = skip_edges(keys_of(text, found, base), labels)
    nodes = np.stack([shapes.get(shape(v), np.zeros(NONE + 1)) for v in values])
    for i, k in enumerate(labels):
        if k != NONE:
            nodes[i] = np.where(np.arange(NONE + 1) == k, 0.0, -50.0)
    chain = [(i, i + 1) for i in range(len(found) - 1)]
    agree = np.eye(NONE + 1) * SKIP_WEIGHT
    edges = np.array([*chain, *skips], "int64").reshape(-1, 2)
    tables = np.concatenate([np.repeat(pairs[None], len(chain), 0), np.repeat(agree[None], len(skips), 0)])
    chance = marginals(nodes, edges, tables)
    added = []
    for (i, j), label, p in zip(found, labels, chance, strict=True):
        if label == NONE and (best := int(p.argmax())) != NONE and p[best] >= LIKELY:
            added.append((i, j, best))
    return base, added


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for i, j, k in sorted(spans, key=lambda s: (s[0], s[2])))


def find_private(docs: DataFrame, model: tuple[dict[str, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row; null counts as empty.

    Offsets are code points, ends exclusive. ``model`` is what ``count_potentials`` returns, by default of ``docs``.
    """
    shapes, pairs = model or count_potentials(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers: list[list[int]] = [[] for _ in KINDS]
            digests, spans, more = [], [], []
            for text in texts(batch.column("text")):
                base, added = find_spans(text, shapes, pairs)
                for k, column in enumerate(numbers):
                    column.append(sum(s[2] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined([*base, *added]))
                more.append(len(added))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in numbers], pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(more, pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    docs = documents(docs)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long")
