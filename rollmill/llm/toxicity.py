"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is logistic in its distinct words and their first four and five letters; a
document's score is the noisy-or of its sentences, 1 - prod(1 - p). Only that is compared with the
document's label in training, so the sentences that carry the label are found along the way.

The model is fitted on the driver from a bounded sample (``samples.labelled_sample``); features seen
in fewer than ``LEAST_DOCS`` of its documents, or about as often in both classes, have no weight. Scoring is one pass without a shuffle.

Results: null and empty texts have no sentence and score 0; each row is scored on its own, so rows
that repeat get equal scores; other columns are carried along; without labels of both classes every
score is 0.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rollmill.llm.base import fresh, texts_of, with_columns

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
LEAST_DOCS = 5
LEAST_Z = 4.0
START = -9.0
# Weight of the toxic documents in training; below one half, so that clean documents stay clean.
PRIOR = 0.15
EPOCHS = 300
RATE = 0.1
DECAY = 3e-5
MEMO = 500_000


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings; the marks keep them apart."""
    return (f"={word}", f"4{word[:4]}", f"5{word[:5]}")


def telling(seen: dict[int, Counter], docs: Counter) -> list[str]:
    """Features whose share of documents differs between the classes by LEAST_Z standard errors."""
    out = []
    for f in seen[0].keys() | seen[1].keys():
        a, b = seen[0][f], seen[1][f]
        p = (a + b) / (docs[0] + docs[1])
        error = (p * (1 - p) * (1 / docs[0] + 1 / docs[1])) ** 0.5
        if a + b >= LEAST_DOCS and abs(b / docs[1] - a / docs[0]) >= LEAST_Z * error:
            out.append(f)
    return sorted(out)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]


def fit(sample: list[tuple[str, int]]) -> Model:
    """Full-batch Adam on the noisy-or likelihood, the toxic class with weight PRIOR."""
    if len({y for _, y in sample}) < 2:
        return Model(-50.0, {})
    # Two passes over the texts, so that no word is held but those of one document.
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for text, label in sample:
        seen[label].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
    names = telling(seen, Counter(label for _, label in sample))
    seen.clear()
    place = {f: i for i, f in enumerate(names)}
    columns, rows, docs = array("l"), array("l"), array("l")
    n = 0
    for d, (text, _) in enumerate(sample):
        for sentence in SENTENCE.findall(text.lower()):
            words = set(WORD.findall(sentence))
            if words:
                own = {place[f] for w in words for f in features(w) if f in place}
                columns.extend(sorted(own))
                rows.extend([n] * len(own))
                docs.append(d)
                n += 1
    col, row, doc = (np.array(x, int) for x in (columns, rows, docs))
    y = np.array([y for _, y in sample], float)
    share = np.where(y == 1, PRIOR / max(y.sum(), 1), (1 - PRIOR) / max((1 - y).sum(), 1))
    theta = np.append(np.zeros(len(names)), START)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, EPOCHS + 1):
        z = np.bincount(row, weights=theta[col], minlength=n) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        clean = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        toxic = np.maximum(-np.expm1(clean), 1e-12)
        g_doc = share * np.where(y == 1, -np.exp(clean) / toxic, 1.0)
        g_sentence = g_doc[doc] * p
        grad = np.append(np.bincount(col, weights=g_sentence[row], minlength=len(names)), g_sentence.sum())
        grad[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(float(theta[-1]), {f: float(w) for f, w in zip(names, theta)})


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def word(self, word: str) -> tuple[str, ...]:
        """The features of a word that have a weight."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMO:
                self.known = {}
            found = self.known[word] = tuple(f for f in features(word) if f in self.model.weights)
        return found

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Begin, end and score of every sentence with a word. A feature that several words of a
        sentence share counts once, as in training."""
        bias, weights, out = self.model.bias, self.model.weights, []
        for found in SENTENCE.finditer(text):
            words = set(WORD.findall(found[0].lower()))
            if words:
                own = {f for w in words for f in self.word(w)}
                z = fsum([bias, *(weights[f] for f in own)])
                out.append((found.start(), found.end(), 1 / (1 + np.exp(-min(max(z, -40.0), 40.0)))))
        return out


def noisy_or(scores: list[float]) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum())) if scores else 0.0


def score_toxicity(docs: DataFrame, model: Model, at: float = 0.5, spans: bool = True) -> tuple[DataFrame, str, str]:
    """``docs`` with a score and, with ``spans``, the sentences of score ``at`` or more as
    (begin, end, score); also the names of the two columns."""
    name, where = fresh(docs, "toxicity"), fresh(docs, "offending")
    span = T.StructType(
        [T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
    fields = [T.StructField(name, T.DoubleType())] + [T.StructField(where, T.ArrayType(span))] * spans
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer.sentences(t) for t in texts_of(batch)]
            made = [pa.array([noisy_or([p for _, _, p in s]) for s in found], pa.float64())]
            if spans:
                hits = [[{"begin": a, "end": b, "score": p} for a, b, p in s if p >= at] for s in found]
                made.append(pa.array(hits, kind))
            yield made

    return with_columns(docs, fields, run), name, where
