"""Distinct ids as bitmaps that can be merged: counted once, added up over any coarser key.

A ``bitset`` metric keeps its ids in the row key. Counting them per coarser key shuffles every distinct
(key, id). Here the ids of a key become bitmaps of 32,768 bits, one per range of ids; bitmaps of
several micro-batches, days or kinds are merged bit by bit, so a count over a coarser key moves at most
one bitmap per task, key and range, however many rows and ids there are.

Rows of bitmaps have the table's dimensions, ``metric``, ``bucket`` (the range of ids), ``bits`` and ``words``.
A range with many ids has the whole bitmap as ``bits``; one with ids in less than half of its words of 64
bits has those words in ``words`` only, so ids scattered over many ranges cost a word each, not 4 KB. Rows
can be stored and merged again in any order and any number of times: merging the same rows twice changes
nothing, unlike counts. Null ids are in none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.operators.chain import Processor
from rollmill.operators.rollup import aggregate_column
from rollmill.spec import TableSpec

METRIC, BUCKET, BITS, WORDS = "metric", "bucket", "bits", "words"
# A range has 512 words of 64 bits; from so many on that hold an id, it is kept as one bitmap.
RANGE_WORDS, DENSE = 512, 256
_PLACE, _WORD = "__place", "__word"


def _quoted(names: Sequence[str]) -> list:
    return [F.col(f"`{n}`") for n in names]


def _check(table: TableSpec) -> None:
    clash = sorted({METRIC, BUCKET, BITS, WORDS} & {d.name for d in table.dimensions})
    if clash:
        raise ValueError(f"table {table.name}: dimensions named as columns of bitmaps: {', '.join(clash)}")


def bitmaps(table: TableSpec, by: Sequence[str] | None = None) -> Processor:
    """Rolled-up rows to bitmaps, per ``by`` (default: all dimensions)."""
    _check(table)
    groups = [d.name for d in table.dimensions] if by is None else list(by)
    ids = [F.struct(F.lit(m.name).alias(METRIC), F.col(f"`{m.name}`").cast("bigint").alias("id")) for m in table.bitset_metrics]
    if not ids:
        raise ValueError(f"table {table.name} has no bitset metric")

    def run(df: DataFrame) -> DataFrame:
        found = df.select(*_quoted(groups), F.explode(F.array(*ids)).alias("__id")).where("__id.id IS NOT NULL")
        position = F.bitmap_bit_position("__id.id")
        # bit of a position as in the bytes of a bitmap: the first byte is the highest of its word
        shift = (F.lit(56) - position % 64 + position % 8 * 2).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
        words = found.select(
            *_quoted(groups),
            F.col(f"__id.{METRIC}").alias(METRIC),
            F.bitmap_bucket_number("__id.id").alias(BUCKET),
            F.floor(position / 64).cast("smallint").alias(_PLACE),
            bit.alias(_WORD),
        )
        return _packed(words, groups)

    return run


def _packed(words: DataFrame, by: Sequence[str]) -> DataFrame:
    """Words, any number of a place, to one row per key, metric and range."""
    keys = [*_quoted(by), METRIC, BUCKET]
    once = words.groupBy(*keys, _PLACE).agg(F.bit_or(_WORD).alias(_WORD))
    held = F.sort_array(F.collect_list(F.struct(F.col(_PLACE).alias("place"), F.col(_WORD).alias("word"))))
    found = once.groupBy(*keys).agg(held.alias(WORDS))
    full = F.map_from_entries(WORDS)
    places = F.sequence(F.lit(0), F.lit(RANGE_WORDS - 1))
    text = F.transform(places, lambda p: F.lpad(F.hex(F.coalesce(F.try_element_at(full, p.cast("smallint")), F.lit(0))), 16, "0"))
    dense = F.size(WORDS) >= DENSE
    bits = F.when(dense, F.unhex(F.array_join(text, ""))).alias(BITS)
    return found.select(*keys, bits, F.when(~dense, F.col(WORDS)).alias(WORDS))


def _words(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Words of bitmaps: whole ones are merged first, the others give their words as they are."""
    keys = [*_quoted(by), METRIC, BUCKET]
    whole = df.where(F.col(BITS).isNotNull()).groupBy(*keys).agg(F.bitmap_or_agg(BITS).alias(BITS))
    places = F.sequence(F.lit(0), F.lit(RANGE_WORDS - 1))

    def word(p: Column) -> Column:
        return F.conv(F.hex(F.substring(F.col(BITS), p * 8 + 1, F.lit(8))), 16, -10).cast("bigint")

    cut = F.explode(F.transform(places, lambda p: F.struct(p.cast("smallint").alias("place"), word(p).alias("word"))))
    few = df.where(F.col(BITS).isNull()).select(*keys, F.explode(WORDS).alias("w"))
    both = whole.select(*keys, cut.alias("w")).where("w.word <> 0").union(few)
    return both.select(*keys, F.col("w.place").alias(_PLACE), F.col("w.word").alias(_WORD))


def merge_bitmaps(by: Sequence[str]) -> Processor:
    """Bitmaps of several makings, or of finer keys, to one per key of ``by``, metric and range."""
    return lambda df: _packed(_words(df, by), by)


def size_of(bits: str = BITS, words: str = WORDS) -> Column:
    """Ids in a bitmap, whole or as words."""
    few = F.aggregate(words, F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w["word"]))
    return F.coalesce(F.bitmap_count(bits), few)


def count_ids(by: Sequence[str]) -> Processor:
    """Distinct ids per key of ``by`` and metric, from bitmaps."""

    def run(df: DataFrame) -> DataFrame:
        words = _words(df, by).groupBy(*_quoted(by), METRIC, BUCKET, _PLACE).agg(F.bit_or(_WORD).alias(_WORD))
        return words.groupBy(*_quoted(by), METRIC).agg(F.sum(F.bit_count(_WORD).cast("bigint")).alias("ids"))

    return run


def finalise_bitmaps(table: TableSpec, by: Sequence[str] | None = None) -> Processor:
    """As ``finalise``, by bitmaps that are made from the rolled-up rows; for stored ones see ``report``."""
    return lambda df: report(table, df, df.transform(bitmaps(table)), by)


def report(table: TableSpec, rows: DataFrame, maps: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Read-side view per ``by``: averages divided out, ids counted from ``maps``, all else from ``rows``.

    Both sides are small aggregates of the same keys; they are put together by one more aggregate, which
    keeps null keys, instead of a join.
    """
    groups = [d.name for d in table.dimensions] if by is None else list(by)
    plain = [m for m in table.metrics if not m.is_bitset]
    measures = [aggregate_column(m).alias(m.name) for m in plain]
    if not table.count_metrics:
        measures.append(F.sum(F.col(f"`{table.count_column}`")).alias(table.count_column))
    left = rows.groupBy(*_quoted(groups)).agg(*measures)
    counts = [
        F.max(F.when(F.col(METRIC) == m.name, F.col("ids"))).alias(m.name) for m in table.bitset_metrics
    ]
    right = maps.transform(count_ids(groups)).groupBy(*_quoted(groups)).agg(*counts)
    both = left.unionByName(right, allowMissingColumns=True)
    count = F.max(F.col(f"`{table.count_column}`"))
    shown = []
    for metric in table.metrics:
        held = F.max(F.col(f"`{metric.name}`"))
        if metric.is_bitset:
            held = F.coalesce(held, F.lit(0).cast("bigint"))
        elif metric.aggregate == "avg":
            held = held / F.nullif(count, F.lit(0))
        shown.append(held.alias(metric.name))
    if not table.count_metrics:
        shown.append(count.alias(table.count_column))
    return both.groupBy(*_quoted(groups)).agg(*shown)
