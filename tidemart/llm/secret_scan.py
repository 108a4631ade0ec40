"""Secret scan: rules for known forms, and character Markov models for the rest.

Base rules find assignments to names such as password, access keys, and long hexadecimal strings.
Beside them, runs of key characters that hold letters and digits are scored by two first-order
Markov models of characters, one of random strings and one of ordinary identifiers. A run whose
log-likelihood ratio per character reaches the margin is a span of kind ``markov``.

``train`` counts character pairs of labelled samples in a grouping, over all of them; a model is a
table of one row per pair of characters, whatever the number of samples. ``labelled_runs`` draws
samples out of documents: values found by the rules are random strings, all other runs are
ordinary. With no sample of a kind, its model is even over all characters.

Defined results: a null text is empty and has no spans. Offsets count code points, ends are
exclusive. Spans of one kind never overlap; a ``markov`` span touches no base span. All other
columns pass through, and ``spans`` replaces a column of that name. A run without an ASCII letter
and an ASCII digit, or shorter than ``LEAST_RUN``, is never scored. A run whose ratio is just the margin
is a span. Repeated rows get equal spans, each one; very long texts are read whole. Empty tables give
empty tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "markov")
LEAST_RUN = 16
# A sample of ordinary text is a run at least this long.
LEAST_SAMPLE = 8
# Nats per character by which the model of random strings must win.
MARGIN = 0.5

_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_START = len(_ALPHABET)
_STATES = _START + 1
_STATE = np.full(256, _START, np.int64)
_STATE[np.frombuffer(_ALPHABET, np.uint8)] = np.arange(_START)

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]+")
# Access keys and hexadecimal strings lie within such runs.
_RUN = re.compile(f"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")
_SAMPLE = re.compile(f"[A-Za-z0-9+/_=-]{{{LEAST_SAMPLE},}}")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")

_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
_SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[str], list[tuple[int, int]]]:
    """Spans of the rules, the secret values in them, and all long runs of key characters."""
    spans, values = [], []
    if ":" in text or "=" in text:
        for found in _ASSIGN.finditer(text):
            if len(found[2]) >= 8:
                spans.append(("assign", *found.span()))
                values.append(found[2])
    runs = [run.span() for run in _RUN.finditer(text)]
    for start, end in runs:
        for kind, pattern, least in (("access", _ACCESS, 16), ("hex", _HEX, 32)):
            for found in pattern.finditer(text, start, end):
                if found.end() - found.start() >= least:
                    spans.append((kind, *found.span()))
                    values.append(found[0])
    spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return spans, values, runs


def _pairs(samples: list[str]) -> np.ndarray:
    """Counts of character pairs, the start of a sample being a character of its own."""
    states = _STATE[np.frombuffer(("\n" + "\n".join(samples)).encode("ascii", "replace"), np.uint8)]
    codes = states[:-1] * _STATES + states[1:]
    return np.bincount(codes[states[1:] != _START], minlength=_STATES * _STATES)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, _STATES * _STATES), np.int64)
    for batch in batches:
        values, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for kind in (0, 1):
            totals[kind] += _pairs([v for v, k in zip(values, kinds, strict=True) if v and k == kind])
    yield _count_rows(totals)


def _count_rows(totals: np.ndarray) -> pa.RecordBatch:
    kind, pair = np.nonzero(totals)
    return pa.record_batch([kind.astype(np.int32), pair.astype(np.int32), totals[kind, pair]],
                           names=["random", "pair", "n"])


_COUNTS = "random int, pair int, n long"


class MarkovModels:
    """Log-likelihood ratios of character pairs.

    The model of random strings is mixed with an even one, as keys come in other alphabets than
    those of the samples too.
    """

    def __init__(self, counts: np.ndarray, smoothing: float = 0.5, even: float = 0.3):
        tables = counts.reshape(2, _STATES, _STATES)[:, :, :_START] + smoothing
        ordinary, random = tables / tables.sum(axis=2, keepdims=True)
        self.ratio = np.log((1 - even) * random + even / _START) - np.log(ordinary)

    def score(self, run: str) -> float:
        """Mean log-likelihood ratio per character; above 0 if the run looks random."""
        states = _STATE[np.frombuffer(run.encode("ascii", "replace"), np.uint8)]
        before = np.concatenate([[_START], states[:-1]])
        known = states != _START
        return float(self.ratio[before[known], states[known]].mean()) if known.any() else 0.0


def fit(counts: DataFrame) -> MarkovModels:
    """Sum counted pairs over all tasks; the sums are at most two rows per pair of characters."""
    totals = np.zeros((2, _STATES * _STATES), np.int64)
    for row in counts.groupBy("random", "pair").agg(F.sum("n").alias("n")).collect():
        totals[row.random, row.pair] = row.n
    return MarkovModels(totals)


def train(samples: DataFrame, value: str = "value", random: str = "random") -> MarkovModels:
    """Fit both models to labelled samples: ``random`` is 1 for random strings, 0 for ordinary ones."""
    return fit(samples.select(value, F.col(random).cast("int")).mapInArrow(_counted, _COUNTS))


def labelled_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counted character pairs of documents' runs, labelled by the rules; input of ``fit``."""
    def run(batches):
        totals = np.zeros((2, _STATES * _STATES), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                random, ordinary = [], []
                for content in batch.column(0).slice(start, 1000).to_pylist():
                    if not content:
                        continue
                    spans, values, _ = base_spans(content)
                    random += [v for v in values if v.isascii()]
                    for _, first, after in reversed(spans):
                        content = f"{content[:first]} {content[after:]}"
                    ordinary += _SAMPLE.findall(content)
                totals[0] += _pairs(ordinary)
                totals[1] += _pairs(random)
        yield _count_rows(totals)

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, _COUNTS)


def find_spans(text: str | None, models: MarkovModels, margin: float = MARGIN) -> list[dict]:
    if not text:
        return []
    base, _, runs = base_spans(text)
    spans = [(*x, None) for x in base]
    for start, end in runs:
        run = text[start:end]
        if (_DIGIT.search(run) and _LETTER.search(run)
                and not any(first < end and start < after for _, first, after in base)):
            score = models.score(run)
            if score >= margin:
                spans.append(("markov", start, end, score))
    spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in spans]


def scan(docs: DataFrame, models: MarkovModels, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """Add ``spans``: kind, start, end and (for markov) score of every secret in the whole text."""
    fields = [f for f in docs.schema if f.name != "spans"]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField("spans", T.ArrayType(_SPAN))])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = [find_spans(x, models, margin) for x in part.column(names.index(text)).to_pylist()]
                yield part.append_column("spans", pa.array(found, pa.list_(_SPAN_ARROW)))

    return docs.select(*(F.col(f"`{n}`") for n in names)).mapInArrow(run, schema)
