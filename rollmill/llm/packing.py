"""Harmonic packing of documents into fixed-length training sequences.

A piece of ``length`` tokens belongs to class ``capacity // length``: class k holds lengths in
(capacity/(k+1), capacity/k], and each of its sequences takes exactly k pieces. What a document has
beyond full sequences is kept whole where k such pieces nearly fill a sequence, else cut at the next
smaller class's length, so that every sequence of a class is nearly full.

Workers fill the sequences of their own rows as they tokenise them; no text or token is shuffled.
Fewer than k pieces of each class are left per worker; those rows (their number depends on the
workers, not on the documents) go through the same step again by class, and what is then left, under
one sequence a class, is closed first-fit in one task.

Results: a null text counts as empty; every document, empty ones too, ends with ``end_id`` and so has
at least one piece; rows that repeat a doc_id are packed each on its own; a null doc_id is kept; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.base import texts_of
from rollmill.llm.bpe import WIDTH, encoder
from rollmill.session import scratch_path, stage

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "class int, ids array<long>"
)
# A piece is cut unless k of its like leave at most this share of a sequence empty.
SLACK = 1 / 64


def cut(tokens: int, capacity: int, slack: float = SLACK) -> list[int]:
    """Lengths of a document's pieces, in order."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        take = rest if k * rest >= (1 - slack) * capacity else capacity // (k + 1)
        lengths.append(take)
        rest -= take
    return lengths


class Bins:
    """The open sequence of each class, of one worker and round."""

    def __init__(self, capacity: int, round_: int):
        self.capacity = capacity
        self.open: dict[int, list[list]] = {}
        self.next_id = (round_ << 60) | (TaskContext.get().partitionId() << 32)

    def close(self, pieces: list[list]) -> list[list]:
        offset = 0
        for piece in pieces:
            piece[5], piece[6] = self.next_id, offset
            offset += piece[2]
        self.next_id += 1
        return pieces

    def add(self, piece: list) -> list[list]:
        """The pieces of the sequence that this piece completes, if any."""
        k = piece[7]
        held = self.open.setdefault(k, [])
        held.append(piece)
        return self.close(self.open.pop(k)) if len(held) == k else []

    def left(self) -> list[list]:
        return [piece for held in self.open.values() for piece in held]


def _batch(pieces: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*pieces) if pieces else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema() -> pa.Schema:
    longs = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.schema([*((n, pa.int64()) for n in longs), ("class", pa.int32()), ("ids", pa.list_(pa.int64()))])


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, with_ids: bool = False, slack: float = SLACK
) -> DataFrame:
    """One row per piece: where it is in its document and in its sequence; ``with_ids`` adds its tokens."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, bins, encode = _schema(), Bins(capacity, 0), encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch))):
                ids += end
                total, start = len(ids) // WIDTH, 0
                for length in cut(total, capacity, slack):
                    own = ids[start * WIDTH : (start + length) * WIDTH]
                    shown = np.frombuffer(own, dtype="<u4").tolist() if with_ids else None
                    piece = [doc_id, start, length, zlib.crc32(own), total, None, None, capacity // length, shown]
                    out += bins.add(piece)
                    start += length
            yield _batch(out, schema)
        yield _batch(bins.left(), schema)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, bins = _schema(), Bins(capacity, 1)
        for batch in batches:
            yield _batch([p for row in batch.to_pylist() for p in bins.add(list(row.values()))], schema)
        yield _batch(bins.left(), schema)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, bins = _schema(), Bins(capacity, 2)
        rows = sorted((list(r.values()) for b in batches for r in b.to_pylist()), key=lambda p: -p[2])
        held: list[list] = []
        for piece in rows:
            fits = next((h for h in held if sum(p[2] for p in h) + piece[2] <= capacity), None)
            if fits is None:
                held.append([piece])
            else:
                fits.append(piece)
        for pieces in held:
            yield _batch(bins.close(pieces), schema)

    spark = docs.sparkSession

    def run(df: DataFrame, step) -> DataFrame:
        return stage(df.mapInArrow(step, PIECES), scratch_path(spark, "packing"))

    one = run(docs.select(F.col("doc_id").cast("long"), "text"), first)
    left = F.col("sequence_id").isNull()
    two = run(one.where(left).repartition("class").sortWithinPartitions("class", "doc_id", "start"), again)
    three = run(two.where(left).coalesce(1), last)
    out = one.where(~left).unionByName(two.where(~left)).unionByName(three)
    return out.drop("class") if with_ids else out.drop("class", "ids")
