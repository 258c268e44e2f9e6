"""Quality rules learnt as an ordered list of threshold conjunctions.

Every whole text becomes a row of statistics (``text_statistics``). On a bounded sample of labelled
rows sequential covering learns rules for bad text: a rule grows by the threshold of greatest gain
until it covers no good row, is pruned on rows held back for that, and is kept if it is still
``PRECISION`` precise there; the rows it covers are removed and the next rule is learnt. The list
comes out as one ordered Spark conditional expression, readable as such, over the columns.

Results: a null text counts as empty and has zeros everywhere; each row stands for itself; other
columns are carried along; without labels of both classes the list is empty and keeps everything
but what fails the base rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.llm.base import texts_of, with_columns

SYMBOL = re.compile(r"[#*$%&|<>]")
BLANK = re.compile(r"[\x20\x09-\x0D]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shout")
# What rules may ask: statistics that do not grow with the length of a text, and its length.
FEATURES = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "shout_rate": "n_shout / greatest(n_words, 1)",
}
SAMPLE = 20_000
MOST_RULES = 20
MOST_CONDITIONS = 4
THRESHOLDS = 64
PRECISION = 0.9
LEAST_COVER = 5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a run of three words which occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    base = len(number)
    pairs, two = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
    _, three, count = np.unique(two[:-1] * base + ids[2:], return_inverse=True, return_counts=True)
    hit = count[three] >= 2
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= hit
    return int(covered.sum())


def statistics(text: str) -> tuple[int, ...]:
    """Counts of a whole text, in the order of COUNTS."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = text.split("\n")
    seen: set[str] = set()
    repeated = filled = 0
    for line in lines:
        if line and not line.isspace() or BLANK.sub("", line):
            filled += 1
            repeated += line in seen
            seen.add(line)
    symbols = sum(map(text.count, "#*$%&|<>"))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    return len(words), chars, symbols, repeated, repeated_words(words), filled, upper, text.count("!")


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics as columns; it must not have columns of these names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            rows = [statistics(t) for t in texts_of(batch)]
            columns = zip(*rows) if rows else [[] for _ in COUNTS]
            yield [pa.array(c, pa.int64()) for c in columns]

    return with_columns(docs, [T.StructField(n, T.LongType()) for n in COUNTS], run)


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        x = rows[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, dtype=bool)
    for c in rule:
        hit &= c.holds(rows)
    return hit


def candidates(rows: dict[str, np.ndarray]) -> list[Condition]:
    out = []
    for f, x in rows.items():
        cuts = np.unique(np.quantile(x, np.linspace(0, 1, THRESHOLDS + 1), method="lower"))
        middles = (cuts[:-1] + cuts[1:]) / 2
        out += [Condition(f, above, float(c)) for c in middles for above in (True, False)]
    return out


def grow(rows: dict[str, np.ndarray], bad: np.ndarray, tests: list[tuple[Condition, np.ndarray]]) -> Rule:
    """Add the condition of greatest gain, in bits saved on the bad rows still covered."""
    rule: list[Condition] = []
    hit = np.ones(len(bad), dtype=bool)
    while len(rule) < MOST_CONDITIONS and (hit & ~bad).any():
        p0 = (hit & bad).sum()
        before = np.log2(p0 / hit.sum())
        best, gain = None, 1e-9
        for c, mask in tests:
            both = hit & mask
            p = (both & bad).sum()
            if p < LEAST_COVER:
                continue
            g = p * (np.log2(p / both.sum()) - before)
            if g > gain:
                best, gain = (c, mask), g
        if best is None:
            break
        rule.append(best[0])
        hit &= best[1]
    return tuple(rule)


def worth(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int, int]:
    hit = covers(rule, rows, len(bad))
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return ((p - n) / (p + n) if p + n else -1.0), p, n


def prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that is best on rows it was not grown on."""
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r, rows, bad)[0], -len(r)))


def learn(rows: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """An ordered list of rules for bad rows."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    third = np.arange(len(bad)) % 3 == 2
    tests = [(c, c.holds(rows)) for c in candidates(rows)] if len(bad) else []
    while len(rules) < MOST_RULES:
        growing, pruning = left & ~third, left & third
        if (bad & growing).sum() < LEAST_COVER or not (growing & ~bad).any():
            break
        own = {f: x[growing] for f, x in rows.items()}
        held = {f: x[pruning] for f, x in rows.items()}
        rule = grow(own, bad[growing], [(c, m[growing]) for c, m in tests])
        if not rule:
            break
        rule = prune(rule, held, bad[pruning])
        _, p, n = worth(rule, held, bad[pruning])
        if p + n == 0 or p / (p + n) < PRECISION:
            break
        rules.append(rule)
        left &= ~covers(rule, rows, len(bad))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False for rows that a rule calls bad, in the list's order, else true."""
    out = None
    for rule in rules:
        test = F.expr(" AND ".join(c.sql() for c in rule))
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit(stats: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[Rule]:
    """Rules from at most ``most`` labelled rows, picked by a hash of the id, that pass the base rules."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("y"), F.max("quality").alias("y2")
    )
    known = known.where("y = y2").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    ids = F.broadcast(known.select(F.col("doc_id").alias("__id"), "y"))  # at most ``most`` ids
    rows = stats.join(ids, F.col("doc_id") == F.col("__id")).where(~base_failed())
    shown = [F.expr(f"CAST({sql} AS double)").alias(f) for f, sql in FEATURES.items()]
    found = rows.orderBy(F.xxhash64("__id"), "__id").limit(most).select("y", *shown).collect()
    return learn({f: np.array([r[f] for r in found]) for f in FEATURES}, np.array([r["y"] == 0 for r in found], bool))
