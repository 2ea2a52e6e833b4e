"""Toxicity by a weighted finite-state pattern grammar (operator 10).

A text is cut into clauses (at sentence marks, semicolons and line ends) and each clause into words and quotation
marks.  Lexicon transducers map words to symbols: insult and threat words with weights, words of address (targets),
negations, verbs of speech.  The lexicon of insults is learnt: from a bounded sample of labelled
texts, words and word beginnings that toxic texts hold and hardly any clean one, in more (not near-copied)
texts than chance explains.

The grammar is the composition of small transducers over these symbols: an insult or threat adds its weight (a
threat only after a word of will or a target); a target a few words before or after raises it; a negation
just before it, and quotation marks after a verb of speech, lower it.  A clause's weight is what the composition puts out; a text's score is a logistic
curve of the sum over its matched clauses, fitted on the same sample.

Only clauses with an insult or threat are run: one multi-pattern search over the text finds them.

Edge cases: a null or empty text has weight 0; without labels of both classes the curve's fixed
defaults hold; labels that are null or not 0/1 are not used; an id with both labels counts for both, of rows
that repeat an id the least text is learnt from, once; a text of any length is searched in one pass; an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, doc_text, keep_rows
from .nbsvm import curve

SAMPLE = 8000
LEAST_TEXTS, MOST_ENTRIES = 3, 5000
BEGINNINGS = (4, 5, 6, 8)
PURE = 0.02  # share of a pattern's texts, weighted to classes of equal size, that may be clean
SCORES = "doc_id long, score double, clauses int"

NEGATIONS = frozenset("not no never neither nor isn't aren't wasn't don't nicht kein keine keinen nie pas jamais nunca tampoco ni".split())
SPEECH = frozenset("said says say called calls wrote writes claimed quoted sagte sagt schrieb dit écrit dijo dice escribió".split())
TARGETS = frozenset("you your you're yours yourself u ur du dich dir ihr euch dein deine tu toi te ton ta vous votre tú ti usted ustedes vosotros they them".split())
THREATS = {"kill": 1.0, "hurt": 0.6, "die": 0.8, "beat": 0.4, "shoot": 0.8, "stab": 0.9, "murder": 1.0}
WILL = frozenset("will gonna should must going i'll we'll".split())

CLAUSE = re.compile(r"[^.!?;\n]+")
WORD = re.compile(r"[\"“”«»„]|[^\W_]+(?:['’][^\W_]+)*", re.U)


Symbols = list[tuple[str, float]]


class Transducer:
    """A weighted finite-state transducer: symbols with weights to the same symbols with new weights."""

    start: object = 0

    def step(self, state, symbol: str, weight: float) -> tuple[object, float]:
        raise NotImplementedError

    def apply(self, symbols: Symbols) -> Symbols:
        state, out = self.start, []
        for symbol, weight in symbols:
            state, weight = self.step(state, symbol, weight)
            out.append((symbol, weight))
        return out


class Threat(Transducer):
    """A threat word counts only within four words after a word of will or a target."""

    def step(self, state, symbol, weight):
        if symbol in ("will", "target"):
            return 5, weight
        return max(0, state - 1), 0.0 if symbol == "threat" and not state else weight


class Target(Transducer):
    """A target raises the weight of insults and threats up to five words before or after it."""

    factor = 1.5

    def step(self, state, symbol, weight):
        if symbol == "target":
            return 6, weight
        state = max(0, state - 1)
        return state, weight * self.factor if state else weight

    def apply(self, symbols):
        after, before = super().apply(symbols), super().apply(symbols[::-1])[::-1]
        return [(s, max(x, y)) for (s, x), (_, y) in zip(after, before)]


class Negation(Transducer):
    """A negation at most two words before lowers the weight."""

    factor = 0.5

    def step(self, state, symbol, weight):
        if symbol == "negation":
            return 3, weight
        state = max(0, state - 1)
        return state, weight * self.factor if state else weight


class Speech(Transducer):
    """Between quotation marks after a verb of speech the weight is lowered."""

    start = (False, False)
    factor = 0.5

    def step(self, state, symbol, weight):
        said, inside = state
        if symbol == "speech":
            return (True, inside), weight
        if symbol == "quote":
            return (said, not inside), weight
        return state, weight * self.factor if said and inside else weight


class Composed(Transducer):
    """Each transducer reads what the one before it puts out."""

    def __init__(self, *parts: Transducer):
        self.parts = parts

    def apply(self, symbols):
        for p in self.parts:
            symbols = p.apply(symbols)
        return symbols


GRAMMAR = Composed(Threat(), Target(), Negation(), Speech())


class Model:
    """Learnt words and word beginnings with weights, the threat words kept, and the logistic curve."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float], threats: dict[str, float], slope: float = 6.0, bias: float = -2.0):
        self.words, self.beginnings, self.threats, self.slope, self.bias = words, beginnings, threats, slope, bias
        self.sizes = sorted({len(b) for b in beginnings})
        whole = "|".join(map(re.escape, sorted({*words, *threats})))
        begun = "|".join(map(re.escape, sorted(beginnings)))
        either = [f"(?:{whole})(?![^\\W_])"] * bool(whole) + [begun] * bool(begun)
        self.search = re.compile(r"(?<![^\W_])(?:" + "|".join(either) + ")" if either else r"(?!)")

    def weight(self, word: str) -> float:
        return max([self.words.get(word, 0.0), *(self.beginnings.get(word[:n], 0.0) for n in self.sizes if len(word) >= n)])

    def symbols(self, clause: str) -> Symbols:
        out = []
        for w in WORD.findall(clause):
            if insult := self.weight(w):
                out.append(("insult", insult))
            elif w in self.threats:
                out.append(("threat", self.threats[w]))
            else:
                kind = ("quote" if len(w) == 1 and not w.isalnum() else "negation" if w in NEGATIONS else "speech" if w in SPEECH
                        else "target" if w in TARGETS else "will" if w in WILL else "word")
                out.append((kind, 0.0))
        return out

    def clause_weight(self, clause: str) -> float:
        return sum(w for _, w in GRAMMAR.apply(self.symbols(clause)))

    def matched(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of every clause with an insult or threat."""
        low, out, end = text.lower(), [], 0
        for m in self.search.finditer(low):
            if m.start() >= end:
                # from the mark that ended the last clause on, so that all searches together read the text once a mark
                begin = max(end, max(low.rfind(c, end, m.start()) for c in ".!?;\n") + 1)
                clause = CLAUSE.match(low, begin)
                end = clause.end()
                w = self.clause_weight(clause.group())
                if w > 0:
                    out.append((begin, end, w))
        return out

    def score(self, weights: list[float]) -> float:
        x = self.slope * math.log1p(sum(weights)) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

    def dump(self) -> str:
        return json.dumps([self.words, self.beginnings, self.threats, self.slope, self.bias])

    @staticmethod
    def load(text: str) -> Model:
        return Model(*json.loads(text))


def patterns(text: str) -> set[str]:
    """A text's words and, marked by ``*``, word beginnings."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


def without_copies(rows: list[set[str]]) -> list[set[str]]:
    """Rows that share less than half of their patterns with each row kept before them: copies would make any word look toxic."""
    kept, holders = [], defaultdict(list)
    often = Counter(p for own in rows for p in own)
    for own in rows:
        rare = [p for p in own if often[p] <= 50]
        near = Counter(i for p in rare for i in holders[p])
        if not near or max(near.values()) < 0.5 * len(rare):
            for p in rare:
                holders[p].append(len(kept))
            kept.append(own)
    return kept


def fit(texts: list[str], labels: list[int]) -> Model:
    """Learn the lexicon, then the curve."""
    toxic = without_copies([patterns(t) for t, y in zip(texts, labels) if y == 1])
    n_clean = sum(1 for y in labels if y == 0)
    if not toxic or not n_clean:
        return Model({}, {}, THREATS)
    held = defaultdict(set)
    for i, own in enumerate(toxic):
        for p in own:
            held[p].add(i)
    held = {p: h for p, h in held.items() if len(h) >= LEAST_TEXTS}
    clean, threat_clean = Counter(), Counter()
    for t, y in zip(texts, labels):
        if y == 0:
            own = patterns(t)
            clean.update(p for p in own if p in held)
            threat_clean.update(p for p in own if p in THREATS)
    odds = {}
    for p, h in held.items():
        c = clean[p] / n_clean
        if c <= PURE * (len(h) / len(toxic) + c):
            odds[p] = math.log((len(h) + 0.5) / (len(toxic) + 1)) - math.log((clean[p] + 0.5) / (n_clean + 1))
    # so many toxic texts and hardly a clean one, by chance, for none of the patterns
    chance = len(toxic) / (len(toxic) + n_clean)
    enough = max(LEAST_TEXTS, math.ceil(math.log(0.01 / max(1, len(held))) / math.log(chance)))
    chosen: dict[str, float] = {}
    covered: set[int] = set()
    # the pattern of most texts first (clean ones count against it), of equal ones the most special; one that holds or
    # begins a chosen one must add texts
    order = sorted(odds, key=lambda p: (5 * clean[p] - len(held[p]), p.endswith("*"), -len(p), p))
    for least in (enough, LEAST_TEXTS):  # then for texts that nothing covers, less is enough
        for p in order:
            new = held[p] if least == enough else held[p] - covered
            if len(new) < least or p in chosen or len(chosen) >= MOST_ENTRIES:
                continue
            stem = p.rstrip("*")
            for q in chosen:
                if stem.startswith(q.rstrip("*")) or q.startswith(stem):
                    new = new - held[q]
            if len(new) >= LEAST_TEXTS:
                chosen[p] = odds[p]
                covered |= held[p]
    top = max(chosen.values(), default=1.0)
    m = Model({p: w / top for p, w in chosen.items() if not p.endswith("*")},
              {p[:-1]: w / top for p, w in chosen.items() if p.endswith("*")},
              {w: x for w, x in THREATS.items() if threat_clean[w] <= PURE * n_clean})
    x = np.array([math.log1p(sum(c[2] for c in m.matched(t))) for t in texts])
    m.slope, m.bias = curve(x, np.where(np.array(labels) == 1, 1.0, -1.0))
    return m


def train(sample_rows: DataFrame) -> Model:
    """Fit on (doc_id, text, label) rows, a bounded set, in one task."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        yield pa.RecordBatch.from_arrays([pa.array([fit([r[1] for r in rows], [r[2] for r in rows]).dump()], pa.string())], names=["model"])

    rows = sample_rows.select("doc_id", "text", "label").repartition(1)
    got = rows.mapInArrow(learn, "model string").collect()
    return Model.load(got[0].model) if got else Model({}, {}, THREATS)


def matcher(docs: DataFrame, model: Model):
    """A function from an Arrow text column to each text's (score, matched clauses); the model, at most ``MOST_ENTRIES``
    patterns, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model.dump())

    def found(texts: pa.Array) -> list[tuple[float, int]]:
        m = Model.load(shared.value)
        clauses = [[c[2] for c in m.matched(t)] for t in texts.to_pylist()]
        return [(m.score(c), len(c)) for c in clauses]
    return found


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, matched clauses, predicted) of every row."""
    bounded_batches(docs.sparkSession)
    found = matcher(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = found(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in got], pa.float64()),
                                              pa.array([n for _, n in got], pa.int32())], names=["doc_id", "score", "clauses"])

    return doc_text(docs).mapInArrow(run, SCORES).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows below ``threshold``, with all their columns."""
    found = matcher(docs, model)
    return keep_rows(docs, lambda texts: [s < threshold for s, _ in found(texts)])
