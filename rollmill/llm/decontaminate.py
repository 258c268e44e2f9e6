"""Benchmark decontamination: an inverted BM25 index of test items, asked with every passage.

Passages are windows of ``passage`` words of whole documents, half overlapping; items longer than
half a passage are cut into segments of that length, so every copied segment lies whole in some
passage. A segment's weights are divided by its score against itself: a score is the share of the
segment's BM25 mass that a passage covers, and one threshold holds for all.

Retrieval is block-max WAND for many passages at once. Segments stand in blocks; each term keeps its
largest weight per block. The commonest terms of a segment, which together stay under
``COMMON_SHARE`` of the threshold, open no block; for the others the block maxima met in a passage
are summed, and a block is skipped unless that sum and the most its common terms could add reach the
threshold. Segments of the blocks that remain are scored in full, so nothing above the threshold is
missed. A hit counts if enough of the item's question (all but its last sentence) and of its answer
(its last sentence) is found near the passage, as runs of three words.

The index is built on the driver from blocks of at most ``INDEX_ITEMS`` items and ``INDEX_CHARS``
characters and sent to the tasks; a larger test set is searched index by index. BM25's document
frequencies come from all items. Documents are read once per index, without a shuffle.

Results: null and empty texts and items match nothing; repeated rows match each on its own; a null
doc_id or item_id is carried along; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.base import texts_of
from rollmill.llm.words import words_of

K1, B = 1.2, 0.75
BLOCK = 8
COMMON_SHARE = 0.5
INDEX_ITEMS = 20_000
INDEX_CHARS = 20_000_000
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
RUN = 3


@dataclass(frozen=True)
class Settings:
    passage: int = 128
    threshold: float = 0.6
    question: float = 0.6
    answer: float = 0.6

    @property
    def stride(self) -> int:
        return self.passage // 2


def runs(words: list[bytes]) -> set[tuple[bytes, ...]]:
    span = min(RUN, len(words))
    return {tuple(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of all sentences but the last, and of the last; a single sentence is cut in its middle."""
    parts = [p for p in SENTENCE_END.split(text.strip()) if p.split()]
    if len(parts) < 2:
        words = words_of(text)
        half = (len(words) + 1) // 2
        return words[:half], words[half:]
    return [w for p in parts[:-1] for w in words_of(p)], words_of(parts[-1])


def overlap(words: list[bytes], near: list[bytes]) -> float:
    """Share of the words' runs of three that occur in ``near``; 1 for no words."""
    own = runs(words)
    if not own:
        return 1.0
    span = len(next(iter(own)))
    there = {tuple(near[i : i + span]) for i in range(len(near) - span + 1)}
    return len(own & there) / len(own)


@dataclass
class Index:
    how: Settings
    items: list[tuple[int | None, list[bytes], list[bytes]]] = field(default_factory=list)
    segments: list[tuple[int, dict[bytes, float]]] = field(default_factory=list)
    # Terms that open blocks, and their postings: block numbers and largest weights.
    terms: dict[bytes, int] = field(default_factory=dict)
    first: np.ndarray | None = None
    blocks: np.ndarray | None = None
    maxima: np.ndarray | None = None
    common: np.ndarray | None = None

    def build(self, rows: list[tuple[int | None, str]], frequency: Counter, total: int, mean: float) -> Index:
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            self.items.append((item_id, *question_and_answer(text)))
            step = self.how.stride
            for at in range(0, len(words), step):
                part = words[max(0, min(at, len(words) - step)) : at + step]  # the last one is full, too
                counts = Counter(part)
                norm = K1 * (1 - B + B * len(part) / mean)
                raw = {
                    t: math.log(1 + (total - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1) / (n + norm)
                    for t, n in counts.items()
                }
                whole = sum(raw.values())
                self.segments.append((len(self.items) - 1, {t: w / whole for t, w in raw.items()}))
        limit = COMMON_SHARE * self.how.threshold
        opening: set[bytes] = set()
        for _, weights in self.segments:
            mass = 0.0
            for t in sorted(weights, key=lambda t: (-frequency[t], t)):
                mass += weights[t]
                if mass > limit:
                    opening.add(t)
        common = np.zeros(-(-len(self.segments) // BLOCK))
        best: dict[bytes, dict[int, float]] = defaultdict(dict)
        for s, (_, weights) in enumerate(self.segments):
            b = s // BLOCK
            common[b] = max(common[b], sum(w for t, w in weights.items() if t not in opening))
            for t, w in weights.items():
                if t in opening:
                    best[t][b] = max(best[t].get(b, 0.0), w)
        self.terms = {t: i for i, t in enumerate(sorted(best))}
        lists = [sorted(best[t].items()) for t in self.terms]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.blocks = np.array([b for x in lists for b, _ in x], dtype=np.int64)
        self.maxima = np.array([m for x in lists for _, m in x])
        self.common = common
        return self

    def open_blocks(self, texts: list[list[bytes]]) -> dict[int, dict[int, list[int]]]:
        """Blocks that may hold a hit, by text and first passage word: {text: {begin: blocks}}."""
        step, get = self.how.stride, self.terms.get
        passages, found, starts, n = [], [], [], 0
        for words in texts:
            ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
            at = np.flatnonzero(ids >= 0)
            # Word k lies in the passages that begin at its stride and at the one before.
            starts.append(n)
            passages += [n + 1 + at // step, n + at // step]
            found += [ids[at], ids[at]]
            n += len(words) // step + 2
        if not n:
            return {}
        passage, term = np.concatenate(passages), np.concatenate(found)
        # A term that comes again in a passage counts once.
        key = np.unique(passage * len(self.terms) + term)
        passage, term = key // max(len(self.terms), 1), key % max(len(self.terms), 1)
        size = self.first[term + 1] - self.first[term]
        place = np.repeat(self.first[term] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        pair, where = np.unique(
            np.repeat(passage, size) * len(self.common) + self.blocks[place], return_inverse=True
        )
        bound = np.bincount(where, weights=self.maxima[place], minlength=len(pair)) + self.common[pair % len(self.common)]
        out: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for key in pair[bound >= self.how.threshold - 1e-9].tolist():
            passage, block = divmod(key, len(self.common))
            text = int(np.searchsorted(starts, passage, side="right")) - 1
            out[text][(passage - starts[text] - 1) * step].append(block)
        return out

    def search(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int | None, float, float, float, int]]:
        """(text, item_id, score, question overlap, answer overlap, first word) of the best hit of
        every item in every text."""
        if not self.segments or not self.terms:
            return
        how = self.how
        for text, begins in self.open_blocks(texts).items():
            words, best = texts[text], {}
            for begin, blocks in begins.items():
                low = max(begin, 0)
                inside = set(words[low : begin + how.passage])
                for s in (s for b in blocks for s in range(b * BLOCK, min((b + 1) * BLOCK, len(self.segments)))):
                    item, weights = self.segments[s]
                    score = sum(w for t, w in weights.items() if t in inside)
                    if score < how.threshold - 1e-9:
                        continue
                    item_id, question, answer = self.items[item]
                    reach = how.passage + len(question) + len(answer)
                    near = words[max(0, low - reach) : begin + how.passage + reach]
                    q, a = overlap(question, near), overlap(answer, near)
                    if q >= how.question and a >= how.answer:
                        best[item] = max(best.get(item, (0.0,)), (score, q, a, -low))
            for item, (score, q, a, low) in sorted(best.items()):
                yield text, self.items[item][0], score, q, a, -low


def index_blocks(items: DataFrame, how: Settings) -> Iterator[Index]:
    """Indexes over all items; terms are counted over all of them first, in Spark."""
    own = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = own.withColumn("h", F.xxhash64("item_id", "text"))
    sizes = own.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    parts = max(1, -(-sizes["n"] // INDEX_ITEMS), -(-(sizes["chars"] or 0) // INDEX_CHARS))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_distinct(F.split(lowered, "[\\x20\\x09-\\x0D]+"))
    terms = numbered.select("h", F.explode(words).alias("t")).where("t <> ''")
    counts = terms.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    length = own.select(F.avg(F.size(F.split("text", "[\\x20\\x09-\\x0D]+")))).first()[0]
    for part in range(parts):
        in_part = F.pmod("h", F.lit(parts)) == part
        rows = [(r[0], r[1]) for r in numbered.where(in_part).select("item_id", "text").collect()]
        needed = terms.where(in_part).select("t").distinct()
        frequency = Counter({r["t"].encode(): r["n"] for r in counts.join(needed, "t", "left_semi").collect()})
        yield Index(how).build(sorted(rows, key=repr), frequency, sizes["n"], length or 1.0)


def contaminated(docs: DataFrame, items: DataFrame, how: Settings = Settings()) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, question_overlap,
    answer_overlap, first_word (where the best passage begins)."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"

    def hits(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[t], *rest) for t, *rest in index.search([words_of(t) for t in texts_of(batch)])]
                if rows:
                    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                    made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(made, names=names)

        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)

    found = None
    for index in index_blocks(items, how):
        found = hits(index) if found is None else found.union(hits(index))
    return found


def clean_only(docs: DataFrame, items: DataFrame, how: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` in which no test item is found, with all their columns."""
    for index in index_blocks(items, how):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = {t for t, *_ in index.search([words_of(t) for t in texts_of(batch)])}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
