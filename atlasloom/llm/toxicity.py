"""Toxicity of clauses by a weighted finite-state pattern grammar.

Five weighted transducers read the words of a clause:

* *insult* and *threat* map words, word beginnings and pairs of neighbouring words to hits; their arcs carry weights learned from
  labelled rows (patterns with a word of threat are the threat transducer's),
* *target* scales hits near a person spoken to - one that came before, or one that a path bets will follow; a bet that is not kept
  has no final state -, *negation* scales hits behind a negation, *reported speech* those behind a verb of saying.

The three scope transducers read classes of words and hits; ``compose`` makes one arc table of them, whose factors are the
products of theirs. It is composed with the union of the two lexical transducers clause by clause, and the clause's score is the
weight of the heaviest path. A text's score is a logistic function of all its clauses.

Null and empty texts, and texts without a hit, have the features of no clause and so the lowest score; copies and repeated rows score
alike; an empty table gives an empty one, whatever further columns it has.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import texts, written
from atlasloom.sizing import broadcast_if_small

#: Fixed closed-class words of the four languages.
TARGETS = frozenset("you your yours yourself they them he she u du dich dir dein deine ihr euch euer tu toi te ton ta tes vous votre vos usted tú ti tus vosotros".split())
NEGATIONS = frozenset("not no never neither nor nobody nothing don't doesn't isn't aren't wasn't nicht kein keine keinen nie niemals ne pas jamais non aucun aucune ningún ninguna nunca jamás".split())
REPORTS = frozenset("said says say told tells wrote writes called calls quoted quote claimed sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt destroy beat shoot burn stab töten umbringen schlagen verletzen tuer frapper détruire matar golpear destruir".split())

#: How a hit's weight changes: an insult or a threat near a target, a threat without one, inside a negation, inside reported speech.
TARGET_FACTOR, LONE_THREAT_FACTOR, NEGATED_FACTOR, REPORTED_FACTOR = 1.25, 0.5, 0.4, 0.6
#: Words that a target or a negation reaches.
SCOPE = 3
CLASSES, HITS = ("target", "negation", "report", "other"), ("insult", "threat")
#: Patterns of the lexicon: so many times likelier in toxic texts, and with a likelihood ratio that chance does not reach among as
#: many patterns as there are (``MARGIN`` above the logarithm of their number). All that pass are kept.
LEAST_LOG_ODDS, MARGIN = 2.0, 3.0
#: A pair is a pattern only if it says this much more than its words do by themselves (log odds).
PAIR_GAIN = 0.5
BEGINNINGS = (4, 5, 6)
#: Pairs, at most, that tasks get as a set to look words up in; more are joined as a table, with the same result.
MOST_LOOKED_UP = 500_000
#: Rows that the logistic function is fitted on, about: those whose text's hash is under a threshold that leaves as many.
MOST_FITTED = 40_000
PREDICTED_FROM = 0.7

_CLAUSE = re.compile(r"[.!?;:,|\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def held_out(remainders: int = 3, of: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % remainders == of, F.lit(False))


#: An input symbol of the scope transducers: the class of a word, and what hit ends with it ("" for none).
Symbol = tuple[str, str]


@dataclass
class Transducer:
    """Arcs ``(state, symbol) -> [(next state, factor)]``; a path counts if it ends in a final state."""

    start: object
    final: set
    arcs: dict[tuple[object, Symbol], list[tuple[object, float]]]


SYMBOLS: list[Symbol] = [(c, h) for c in CLASSES for h in ("", *HITS)]


def target_transducer() -> Transducer:
    """State ``n > 0``: a target stands at most ``SCOPE`` words back. State ``-n``: one has to come within ``n`` words."""
    arcs: dict = {}
    for state in range(-SCOPE, SCOPE + 1):
        for word, hit in SYMBOLS:
            found = arcs.setdefault((state, (word, hit)), [])
            beside = TARGET_FACTOR if hit else 1.0
            alone = LONE_THREAT_FACTOR if hit == "threat" else 1.0
            if word == "target":
                found.append((SCOPE, beside))
            elif state < 0:
                if state < -1:
                    found.append((state + 1, beside))
            else:
                found.append((max(0, state - 1), beside if state else alone))
                if hit and not state:
                    found.append((-SCOPE, beside))
    return Transducer(0, set(range(SCOPE + 1)), arcs)


def negation_transducer() -> Transducer:
    """State: how many words a negation still reaches."""
    arcs = {
        (state, (word, hit)): [(SCOPE if word == "negation" else max(0, state - 1), NEGATED_FACTOR if hit and (state or word == "negation") else 1.0)]
        for state in range(SCOPE + 1) for word, hit in SYMBOLS}
    return Transducer(0, set(range(SCOPE + 1)), arcs)


def report_transducer() -> Transducer:
    """State 1: behind a verb of saying, up to the clause's end."""
    arcs = {
        (state, (word, hit)): [(int(state or word == "report"), REPORTED_FACTOR if hit and (state or word == "report") else 1.0)]
        for state in (0, 1) for word, hit in SYMBOLS}
    return Transducer(0, {0, 1}, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Both at once: pairs of states that the start reaches, arcs of one symbol, factors multiplied."""
    start = (first.start, second.start)
    arcs: dict = {}
    seen, todo = {start}, [start]
    while todo:
        a, b = state = todo.pop()
        for symbol in SYMBOLS:
            found = [((i, j), x * y) for i, x in first.arcs.get((a, symbol), ()) for j, y in second.arcs.get((b, symbol), ())]
            arcs[state, symbol] = found
            for nxt, _ in found:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
    return Transducer(start, {(a, b) for a, b in seen if a in first.final and b in second.final}, arcs)


SCOPES = compose(compose(target_transducer(), negation_transducer()), report_transducer())


def class_of(word: str) -> str:
    return "target" if word in TARGETS else "negation" if word in NEGATIONS else "report" if word in REPORTS else "other"


@dataclass
class Grammar:
    """Weights of patterns - words, beginnings (with a trailing ``*``), pairs of words with a space between - and the
    logistic function's coefficients."""

    lexicon: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-4.0, 1.0, 0.5, 0.0)

    def __post_init__(self):
        self._memo: dict[str, tuple] = {}
        self._pairs: dict[str, dict[str, float]] = {}
        for pattern, weight in self.lexicon.items():
            first, blank, second = pattern.partition(" ")
            if blank:
                self._pairs.setdefault(first, {})[second] = weight

    def __getstate__(self):
        return {"lexicon": self.lexicon, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def symbol(self, word: str) -> tuple[str, str, float, dict[str, float] | None]:
        """Class of a word, hit and weight of the lexical transducers' arc that reads it alone, and arcs of pairs that it opens."""
        known = self._memo.get(word)
        if known is None:
            weight = self.lexicon.get(word, 0.0)
            for n in BEGINNINGS:
                if len(word) > n:
                    weight = max(weight, self.lexicon.get(f"{word[:n]}*", 0.0))
            if word in THREATS:
                weight = max(weight, 0.5)
            hit = "" if not weight else "threat" if word in THREATS else "insult"
            if len(self._memo) > 100_000:
                self._memo.clear()
            known = self._memo[word] = (class_of(word), hit, weight, self._pairs.get(word))
        return known

    def clause_score(self, words: list[str]) -> float:
        """Weight of the heaviest path through the lexical transducers composed with the scopes.

        A composed state is a scope state and the pair arcs that the word before has opened; words read as an open
        pair's first half give no hit of their own.
        """
        if not words:
            return 0.0
        read = [self.symbol(w) for w in words]
        # an opened pair that the next word does not close leads nowhere: only those that it closes are followed
        closes = [bool(opens) and after in opens for (_, _, _, opens), after in zip(read, [*words[1:], None], strict=True)]
        if not any(closes) and not any(r[2] for r in read):
            return 0.0
        arcs = SCOPES.arcs
        paths: dict[tuple, float] = {(SCOPES.start, False): 0.0}
        for word, (kind, hit, weight, _), opens, before in zip(words, read, closes, [None, *words[:-1]], strict=True):
            after: dict[tuple, float] = {}
            for (state, opened), total in paths.items():
                if opened:
                    threat = word in THREATS or before in THREATS
                    ways = [("threat" if threat else "insult", self._pairs[before][word], False)]
                else:
                    ways = [("", 0.0, False)]
                    if weight:
                        ways.append((hit, weight, False))
                    if opens:
                        ways.append(("", 0.0, True))
                for made, gain, opening in ways:
                    for nxt, factor in arcs[state, (kind, made)]:
                        key, value = (nxt, opening), total + gain * factor
                        if value > after.get(key, -1.0):
                            after[key] = value
            paths = after
        return max((v for (state, opened), v in paths.items() if not opened and state in SCOPES.final), default=0.0)

    def features(self, text: str) -> tuple[float, float, float]:
        """The heaviest clause, what the others add, and how dense matches are."""
        lowered = text.lower()
        if not self.may_match(lowered):
            return 0.0, 0.0, 0.0
        scores = sorted((self.clause_score(_WORD.findall(c)) for c in _CLAUSE.split(lowered)), reverse=True)
        rest = sum(s / (i + 2) for i, s in enumerate(scores[1:]))
        dense = sum(scores) / (20.0 + len(lowered) / 6)
        return scores[0], math.log1p(rest), math.log1p(20 * dense)

    def may_match(self, lowered: str) -> bool:
        """False only for texts in which no word has a weight."""
        symbol = self.symbol
        return any(weight or opens for _, _, weight, opens in map(symbol, set(_WORD.findall(lowered))))

    def score(self, text: str) -> float:
        z = self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], self.features(text), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


# --- learning ----------------------------------------------------------------


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of each distinct labelled text of the training rows; a text with both labels is left out.

    Copies count once (of one id's repeated rows each): what a group of copies has in common must not look like evidence of toxicity.
    """
    named = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    rows = docs.filter(F.col("text").isNotNull() & ~held_out())
    # which rows to read is settled by digests; their texts are then picked where they lie
    prints = rows.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest")).join(named, "doc_id")
    same = prints.groupBy("digest").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"), F.min("doc_id").alias("doc_id"))
    picked = broadcast_if_small(written(same.filter("toxic = most").select(
        F.col("doc_id").alias("__doc_id"), "digest", F.col("toxic").cast("int").alias("toxic")), "labelled"))
    found = rows.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("__doc_id")).filter(
        F.sha2(F.col("text").cast("binary"), 256) == F.col("digest"))
    return found.select("text", "toxic")


def _counted(training: DataFrame, pairs: bool, among: frozenset[str] | None = None) -> DataFrame:
    """``pattern, toxic, clean``: texts with each word, or each pair of neighbouring words of a clause, summed per task.

    Of patterns outside ``among``, if given, nothing leaves the task.
    """
    def seen(text: str) -> set[str]:
        if not pairs:
            return set(_WORD.findall(text))
        clauses = (_WORD.findall(c) for c in _CLAUSE.split(text))
        found = {f"{a} {b}" for words in clauses for a, b in zip(words, words[1:], strict=False)}
        return found if among is None else found & among

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())],
                names=["pattern", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(texts(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                for pattern in seen(text.lower()):
                    counts.setdefault(pattern, [0, 0])[1 if toxic else 0] += 1
                if len(counts) > 300_000:
                    yield rows()
                    counts.clear()
        yield rows()

    return training.select("text", "toxic").mapInArrow(run, "pattern string, toxic long, clean long")


def learn_lexicon(training: DataFrame) -> dict[str, float]:
    """Log odds of words, word beginnings and pairs that pass their test. Counts are Spark's.

    Pairs are counted in toxic texts first: one that is too rare there passes no test whatever the others hold (its ratio
    is at most ``t * log(1 / share)``, and ``tested`` at least the number of pairs met), so only the rest is counted in clean texts.
    """
    texts_of = training.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_toxic, n_clean = int(texts_of[0] or 0), int(texts_of[1] or 0) - int(texts_of[0] or 0)
    if not n_toxic or not n_clean:
        return {}
    share = n_toxic / (n_toxic + n_clean)
    n = F.col("t") + F.col("c")
    ratio = F.col("t") * F.log(F.col("t") / (n * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - share)))).otherwise(0.0)
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("c") + 0.5) / (n_clean + 1.0))

    def strong(sums: DataFrame, tested: int) -> dict[str, float]:
        passing = sums.withColumn("weight", odds).filter((F.col("weight") >= LEAST_LOG_ODDS) & (ratio >= math.log(max(1, tested)) + MARGIN))
        return {r["pattern"]: min(6.0, r["weight"]) for r in passing.select("pattern", "weight").collect()}

    words = _counted(training, pairs=False).groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    forms = F.array(F.col("pattern"), *[F.when(F.length("pattern") > k, F.concat(F.substring("pattern", 1, k), F.lit("*"))) for k in BEGINNINGS])
    seen = words.select("toxic", "clean", F.explode(forms).alias("pattern")).filter("pattern IS NOT NULL")
    sums = written(seen.groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).filter("t > 0"), "patterns")
    lexicon = strong(sums, sums.count())

    toxic_pairs = written(_counted(training.filter("toxic = 1"), pairs=True).groupBy("pattern").agg(F.sum("toxic").alias("t")), "pairs")
    tested = toxic_pairs.count()
    frequent = toxic_pairs.filter(F.col("t") * math.log(1 / share) >= math.log(max(1, tested)) + MARGIN)
    if frequent.isEmpty():
        return lexicon
    # one more row than allowed tells that there are too many for a set
    listed = frequent.select("pattern").limit(MOST_LOOKED_UP + 1).collect()
    among = frozenset(r["pattern"] for r in listed) if len(listed) <= MOST_LOOKED_UP else None
    clean_pairs = _counted(training.filter("toxic = 0"), pairs=True, among=among).groupBy("pattern").agg(F.sum("clean").alias("c"))
    both = frequent.join(clean_pairs, "pattern", "left").select("pattern", "t", F.coalesce("c", F.lit(0)).alias("c"))
    alone = Grammar(lexicon)
    for pair, weight in strong(both, tested).items():
        first, _, second = pair.partition(" ")
        if weight >= alone.symbol(first)[2] + alone.symbol(second)[2] + PAIR_GAIN:
            lexicon[pair] = weight
    return lexicon


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps, classes weighted to count alike."""
    x = np.column_stack([np.ones(len(x)), x])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    """The grammar's weights from labelled rows outside the held-out third.

    Without rows of both classes nothing is learned, and only the fixed words carry weight.
    """
    training = written(labelled(docs, labels), "training")
    grammar = Grammar(learn_lexicon(training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([grammar.features(t) for t in texts(batch.column("text"))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*[pa.array(x[:, i]) for i in range(3)], batch.column("toxic")], names=["a", "b", "c", "toxic"])

    share = min(1.0, MOST_FITTED / max(1, training.count()))
    fitted = training.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    sample = fitted.mapInArrow(run, "a double, b double, c double, toxic int")
    rows = np.array([tuple(r) for r in sample.collect()]).reshape(-1, 4)
    if len(rows) and 0 < rows[:, 3].sum() < len(rows):
        grammar.coefficients = tuple(float(v) for v in fit_logistic(rows[:, :3], rows[:, 3]))
    return grammar


# --- scoring -----------------------------------------------------------------


def score(docs: DataFrame, grammar: Grammar, *more: Column) -> DataFrame:
    """``doc_id``, the columns ``more``, ``score`` (0 to 1) and ``predicted`` of every row; null counts as empty."""
    picked = docs.select("doc_id", "text", *more)
    extra = picked.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([grammar.score(t) for t in texts(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[batch.column(c) for c in extra], pa.array(found, pa.float64()), pa.array((found >= PREDICTED_FROM).astype("int32"))],
                names=["doc_id", *extra, "score", "predicted"])

    kinds = dict(picked.dtypes)
    return picked.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in ["doc_id", *extra]) + ", score double, predicted int")


def drop_toxic(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Rows that are not predicted toxic, with all their columns, whatever they are called; null and empty texts stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([grammar.score(t) < PREDICTED_FROM for t in texts(batch.column("text"))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
