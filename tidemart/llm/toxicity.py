"""Toxicity by a weighted finite-state grammar over clauses.

Words of a clause are read as classes: insult, threat, modal, target, negation, report, other. Five
small transducers each keep one thing in mind and weigh what they read: insults and threats have a
weight of their own, a modal before makes a threat one, a target near by adds, a negation shortly
before and reported speech earlier in the clause take off. They are composed into one machine; a
clause's score is the sum of the weights along its path, and clauses without an insult or threat
score nothing. A document's score is a logistic function of the scores of its matched clauses.

Insults are learned: whole words and stems (word beginnings) that labelled toxic documents hold far
more often than others, with the log odds ratio as their weight. Grammar words are given below.
Both fits use at most ``LABELLED_ROWS`` labelled rows, those with the least hashes of their ids, and
keep every entry that parts toxic from other documents clearly. All documents are scored, over whole texts.

Defined results: a null text is an empty one, whose score is that of a document without matched
clauses. Labels that are null are not used; of several labels of an id the greatest counts; labels
without a document are ignored. Without a labelled row the score is 0.25. Repeated rows are scored
alike, each one; very long texts are scored whole, clause by clause. Of entries that part the labels
equally well all stay. Columns pass through; ``score`` replaces a column of that name. Empty tables
give empty tables.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import Workspace

LABELLED_ROWS = 20_000
# Entries must part toxic from other documents by this many standard errors.
LEAST_Z = 4.0
_STEMS = range(4, 9)

OTHER, INSULT, THREAT, MODAL, TARGET, NEGATION, REPORT = range(7)
_GRAMMAR = {
    TARGET: "you your yours yourself he she him her they them their these those people du dich dir ihr euch tu te toi "
            "vous vos tú usted ustedes vosotros ellos ils elles",
    NEGATION: "not no never neither nor isn't aren't wasn't don't doesn't didn't nicht kein keine nie pas jamais "
              "aucun nunca ningún",
    REPORT: "said says say called calls claims claimed wrote writes quoted quotes reported according sagte schrieb "
            "nannte dit disait écrit appelle dijo dice escribió llamó",
    MODAL: "will shall gonna going must should werde wird soll vais va doit voy va debe",
    THREAT: "kill hurt beat shoot stab burn destroy murder töten schlagen tuer frapper matar golpear",
}
_CLASS = {word: kind for kind, words in _GRAMMAR.items() for word in words.split()}

_CLAUSE_END = re.compile(r"[.!?;\n]")
_WORD = re.compile(r"\w+(?:['’]\w+)*")


class Transducer:
    """States with, for every class read, the next state and a factor for an insult or threat."""

    def __init__(self, moves: list[list[tuple[int, float]]]):
        self.moves = moves

    def compose(self, other: Transducer) -> Transducer:
        """The machine that runs both side by side and multiplies their factors."""
        width = len(other.moves)
        return Transducer([[(a[k][0] * width + b[k][0], a[k][1] * b[k][1]) for k in range(7)]
                           for a in self.moves for b in other.moves])


def _after(trigger: int, words: int, factors: dict[int, float], otherwise: dict[int, float] | None = None) -> Transducer:
    """Weigh classes by ``factors`` for so many words after a trigger, by ``otherwise`` outside."""
    moves = []
    for left in range(words + 1):
        weights = factors if left else otherwise or {}
        moves.append([(words if k == trigger else max(left - 1, 0), weights.get(k, 1.0)) for k in range(7)])
    return Transducer(moves)


def grammar() -> Transducer:
    threat = _after(MODAL, 3, {THREAT: 1.5}, {THREAT: 0.4})
    target = _after(TARGET, 5, {INSULT: 1.3, THREAT: 1.3})
    negation = _after(NEGATION, 3, {INSULT: 0.4, THREAT: 0.2})
    report = _after(REPORT, 40, {INSULT: 0.6, THREAT: 0.6})
    return threat.compose(target).compose(negation).compose(report)


class Lexicon:
    """Weights of whole words and of stems; finds clauses that may match."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.machine = grammar().moves
        self.finder = ahocorasick.Automaton()
        for entry in {*words, *stems, *_GRAMMAR[THREAT].split()}:
            self.finder.add_word(entry, len(entry))
        self.any = len(self.finder) > 0
        if self.any:
            self.finder.make_automaton()

    def weight(self, word: str) -> float:
        """Of the whole word or its longest stem; 0 if it is no insult."""
        found = self.words.get(word, 0.0)
        if not found and self.stems:
            for size in reversed(_STEMS):
                if size <= len(word) and (found := self.stems.get(word[:size], 0.0)):
                    break
        return found

    def clause(self, text: str) -> float:
        state, total = 0, 0.0
        for word in _WORD.findall(text):
            weight = self.weight(word)
            kind = INSULT if weight else _CLASS.get(word, OTHER)
            state, factor = self.machine[state][kind]
            if weight or kind == THREAT:
                total += (weight or 1.0) * factor
        return total

    def features(self, text: str | None) -> list[float]:
        """What the matched clauses of a text come to: number, sum, greatest, and share of the words."""
        if not text or not self.any:
            return [0.0] * 4
        text = text.lower()
        starts = {end - size + 1 for end, size in self.finder.iter(text)}
        starts = sorted(x for x in starts if x == 0 or not text[x - 1].isalnum())
        if not starts:
            return [0.0] * 4
        ends = [x.start() for x in _CLAUSE_END.finditer(text)] + [len(text)]
        scores = []
        for at in sorted({bisect_left(ends, x) for x in starts}):
            score = self.clause(text[ends[at - 1] + 1 if at else 0:ends[at]])
            if score:
                scores.append(score)
        if not scores:
            return [0.0] * 4
        words = text.count(" ") + text.count("\n") + 1
        total = sum(scores)
        return [math.log1p(len(scores)), math.log1p(total), min(max(scores), 20.0) / 5,
                math.log1p(100 * total / (words + 20))]


def _entries(text: str) -> set[str]:
    """Whole words (marked) and stems of a text."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(f"={word}")
        found.update(word[:size] for size in _STEMS if size <= len(word))
    return found


def _count(sample: DataFrame, known: frozenset[str] | None) -> DataFrame:
    """Documents that hold each entry, summed up in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held = _entries(text or "")
                counts.update(held if known is None else held & known)
        yield pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                              names=["entry", "n"])

    return sample.select("text").mapInArrow(run, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def _lexicon(sample: DataFrame, toxic: int, clean: int) -> Lexicon:
    least = max(3, math.ceil(0.004 * toxic))
    held = {r.entry: r.n for r in _count(sample.where("toxic = 1"), None).where(F.col("n") >= least).collect()}
    other = {r.entry: r.n for r in _count(sample.where("toxic = 0"), frozenset(held)).collect()}
    scored = []
    for entry, a in held.items():
        b = other.get(entry, 0)
        odds = math.log((a + 0.5) / (toxic - a + 0.5)) - math.log((b + 0.5) / (clean - b + 0.5))
        error = math.sqrt(1 / (a + 0.5) + 1 / (toxic - a + 0.5) + 1 / (b + 0.5) + 1 / (clean - b + 0.5))
        if odds >= 1.5 and odds / error >= LEAST_Z:
            scored.append((odds / error, odds, entry))
    best = sorted(scored, reverse=True)
    return Lexicon({e[1:]: odds for _, odds, e in best if e[0] == "="},
                   {e: odds for _, odds, e in best if e[0] != "="})


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton's method with a small ridge; the first weight is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    weights[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 1.5))
    if len(y) == 0:
        return weights
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty @ weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(weights)), slope)
        weights -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return weights


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, text: str | None) -> float:
        value = self.weights[0] + float(np.dot(self.weights[1:], self.lexicon.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def _rebuilt(words: dict, stems: dict, weights: list, held: dict = {}) -> ToxicityModel:  # noqa: B006
    """The model in a worker, made once for the same tables."""
    key = (len(words), len(stems), tuple(weights))
    if held.get("key") != key:
        held.update(key=key, model=ToxicityModel(Lexicon(words, stems), np.array(weights)))
    return held["model"]


def _column(frame: DataFrame, words: dict, stems: dict, weights: list, text: str) -> DataFrame:
    fields = [f for f in frame.schema if f.name != "score"]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        model = _rebuilt(words, stems, weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                scores = [model.score(x) for x in part.column(names.index(text)).to_pylist()]
                yield part.append_column("score", pa.array(scores, pa.float64()))

    return frame.select(*(F.col(f"`{n}`") for n in names)).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, work: Workspace, rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Fit to documents (doc_id, text) with labels (doc_id, toxic 0 or 1); only ``rows`` labels are used."""
    chosen = (labels.select("doc_id", "toxic").where("toxic IN (0, 1) AND doc_id IS NOT NULL")
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # At most ``rows`` pairs of numbers, whatever the number of labels.
    sample = work.save(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    numbers = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = numbers.get(1, 0), numbers.get(0, 0)
    lexicon = _lexicon(sample, toxic, clean) if toxic and clean else Lexicon({}, {})
    words, stems = lexicon.words, lexicon.stems

    def run(batches):
        made = Lexicon(words, stems)
        for batch in batches:
            found = [made.features(x) for x in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "x"])

    fitted = sample.select("text", "toxic").mapInArrow(run, "toxic int, x array<double>").collect()
    x = np.array([r.x for r in fitted]).reshape(len(fitted), 4)
    return ToxicityModel(lexicon, _logistic(x, np.array([r.toxic for r in fitted], float)))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``score``, from 0 to 1, to every document."""
    return _column(docs, model.lexicon.words, model.lexicon.stems, model.weights.tolist(), text)
