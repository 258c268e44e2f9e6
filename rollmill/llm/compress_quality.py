"""Quality by compression: which of two dictionaries, of good or of bad text, shortens a text more.

zstandard dictionaries are trained on texts of each label. Every whole text is compressed in
independent pieces of ``PIECE`` bytes, once with each dictionary and once with none; the difference
of the two sizes over the length is the evidence. The three normalised sizes are made a probability
by logistic regression on labelled texts that no dictionary has seen; equal texts are on one side of
that split, and near copies with a probability of at least their similarity.

Fitted on the driver from a bounded sample (``samples.labelled_sample``); scoring is one pass without
a shuffle. Dictionaries are of fixed size.

Results: null and empty texts get the score of a text of length 0, the calibration's value for no
evidence; repeated rows get equal scores; other columns are carried along; without labels of both
classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rollmill.llm.base import fresh, texts_of, with_columns
from rollmill.llm.words import mix, shingle_set, word_hashes, words_of

PIECE = 1024
DICTIONARY = 112_640
LEVEL = 3
STEPS = 40
RIDGE = 1e-3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]


class Sizes:
    """Compressed sizes of texts by each dictionary and by none."""

    def __init__(self, good: bytes, bad: bytes):
        dictionaries = [zstandard.ZstdCompressionDict(d) if d else None for d in (good, bad, b"")]
        for d in dictionaries:
            if d:
                d.precompute_compress(level=LEVEL)
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.packers = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=d, **options)
            if d
            else zstandard.ZstdCompressor(level=LEVEL, **options)
            for d in dictionaries
        ]

    def evidence(self, text: str) -> list[float]:
        """(bad - good) / length, good / length, plain / length, and the logarithms of the last two."""
        raw = text.encode("utf-8", "surrogatepass")
        if not raw:
            return [0.0] * 5
        parts = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        good, bad, plain = (sum(len(p.compress(x)) for x in parts) / len(raw) for p in self.packers)
        return [bad - good, good, plain, float(np.log(good)), float(np.log(plain))]


def expand(x: np.ndarray) -> np.ndarray:
    """Values, squares and products, so that both very short and very long sizes may mean junk."""
    pairs = [x[:, i] * x[:, j] for i in range(x.shape[1]) for j in range(i, x.shape[1])]
    return np.column_stack([x, *pairs, np.ones(len(x))])


def train_dictionary(texts: list[str]) -> bytes:
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    pieces = [r[i : i + PIECE] for r in raws for i in range(0, len(r), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text for a dictionary with tables: use it as it is
        return b"".join(pieces)[-DICTIONARY:]


def sides(texts: list[str]) -> list[int]:
    """0 or 1 for each text, by its smallest shingle hash, so that copies go together; the different
    hashes are dealt in turn."""
    sets = [shingle_set(word_hashes(words_of(t)), 5) for t in texts]
    least = [int(mix(s).min()) if len(s) else -1 for s in sets]
    turn = {key: i % 2 for i, key in enumerate(sorted(set(least)))}
    return [turn[key] for key in least]


def fit(sample: list[tuple[str, int]]) -> Model | None:
    """Dictionaries from one half of the sample, calibration on the other."""
    side = sides([t for t, _ in sample])
    halves = [[pair for pair, s in zip(sample, side) if s == h] for h in (0, 1)]
    good, bad = (train_dictionary([t for t, y in halves[0] if y == want]) for want in (1, 0))
    y = np.array([y for _, y in halves[1]], float)
    if not good or not bad or len(set(y.tolist())) < 2:
        return None
    sizes = Sizes(good, bad)
    x = np.array([sizes.evidence(t) for t, _ in halves[1]])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = expand(np.clip((x - mean) / scale, -6, 6))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.zeros(z.shape[1])
    for _ in range(STEPS):  # Newton
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + RIDGE * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (share * (y - p)) - RIDGE * w)
    return Model(good, bad, tuple(w.tolist()), tuple(mean.tolist()), tuple(scale.tolist()))


def score_quality(docs: DataFrame, model: Model | None) -> tuple[DataFrame, str]:
    """``docs`` with a score between 0 and 1, and that column's name."""
    name = fresh(docs, "quality_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        sizes = model and Sizes(model.good, model.bad)
        for batch in batches:
            texts = texts_of(batch)
            if model is None or not texts:
                yield [pa.array([0.5] * len(texts), pa.float64())]
                continue
            x = np.array([sizes.evidence(t) for t in texts])
            z = expand(np.clip((x - np.array(model.mean)) / np.array(model.scale), -6, 6))
            yield [pa.array(1 / (1 + np.exp(-np.clip(z @ np.array(model.weights), -30, 30))))]

    return with_columns(docs, [T.StructField(name, T.DoubleType())], run), name
