"""Spread rows over a fixed number of parts of about equal row count.

A row's bucket is a checksum of its partition key. Buckets are packed into parts by their row
counts, and every part becomes one or more sorted files. A part that is heavier than
``rows_per_file`` (one hot key may hold a third of all rows) is cut into several files, each
written by a task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.functions.text import clean_text
from rollmill.spec import Partitioning, TableSpec

BUCKET = "__bucket"
PART = "part"
SLOT = "__slot"
# The folder of a bucket inside a segment of a snapshot.
BUCKET_FOLDER = "bucket"
# One shuffle writes all files of a snapshot; Spark's driver can not follow more tasks than this.
MOST_SLOTS = 1_000_000


def bucket_column(table: TableSpec, partitioning: Partitioning) -> Column:
    """``crc32`` of the joined key columns, modulo the number of partitions."""
    kinds = {d.name: d.data_type for d in table.dimensions}

    def as_text(name: str) -> Column:
        col = F.col(f"`{name}`")
        if isinstance(kinds[name], T.StringType):
            text = clean_text(col)
        elif isinstance(kinds[name], T.TimestampType):
            text = col.cast("timestamp").cast("string")
        else:
            text = col.cast("string")
        return F.coalesce(text, F.lit(""))

    key = F.concat(*(as_text(c) for c in partitioning.columns))
    return F.pmod(F.crc32(key), F.lit(partitioning.partitions)).cast("int")


def bucket_weights(df: DataFrame) -> dict[int, int]:
    """Rows per bucket; at most one entry per partition, so it is safe to bring to the driver."""
    return {r[0]: r[1] for r in df.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows")).collect()}


def pack(weights: dict[int, int], bins: int) -> list[list[int]]:
    """Heaviest bucket first, into the first bin it fits under the mean, else the lightest bin."""
    room = [sum(weights.values()) // bins] * bins
    packed: list[list[int]] = [[] for _ in range(bins)]
    for bucket, weight in sorted(weights.items(), key=lambda item: (-item[1], item[0])):
        fits = (b for b in range(bins) if room[b] >= weight)
        target = next(fits, None)
        if target is None:
            target = max(range(bins), key=lambda b: room[b])
        packed[target].append(bucket)
        room[target] -= weight
    return packed


def part_of_bucket(weights: dict[int, int], partitions: int) -> list[int]:
    """Part number of every bucket; buckets without rows take the parts that stay unused, in order."""
    chosen = {b: part for part, members in enumerate(pack(weights, partitions)) for b in members}
    spare = iter(sorted(set(range(partitions)) - set(chosen.values())))
    return [chosen[b] if b in chosen else next(spare) for b in range(partitions)]


@dataclass(frozen=True)
class Layout:
    """Where every bucket goes: its part, and the run of output files that part owns."""

    parts: tuple[int, ...]
    first_slot: tuple[int, ...]
    slots: tuple[int, ...]

    @property
    def total_slots(self) -> int:
        return sum(self.slots)

    @classmethod
    def plan(cls, weights: dict[int, int], partitions: int, rows_per_file: int) -> Layout:
        parts = part_of_bucket(weights, partitions)
        rows = [0] * partitions
        for bucket, weight in weights.items():
            rows[parts[bucket]] += weight
        slots = [-(-r // rows_per_file) for r in rows]
        if sum(slots) > MOST_SLOTS:
            raise ValueError(
                f"{sum(rows)} rows at {rows_per_file} a file make {sum(slots)} files, more than one shuffle "
                f"can write ({MOST_SLOTS}); set rowsPerFile to {-(-sum(rows) // MOST_SLOTS)} or more"
            )
        first = [sum(slots[:p]) for p in range(partitions)]
        return cls(tuple(parts), tuple(first), tuple(slots))


def place(df: DataFrame, table: TableSpec, layout: Layout, sort_columns: tuple[str, ...] = ()) -> DataFrame:
    """Shuffle bucketed rows so that every output file is one task's, and sort inside each file.

    Files of one part share its rows by a hash of the row key, which is unique per row, so the cut
    is even whatever the partition key looks like, and a retried task sends rows the same way.
    """

    def lookup(values: tuple[int, ...], index: Column) -> Column:
        return F.element_at(F.lit(list(values)), index + 1)

    part = F.col(PART)
    key = F.xxhash64(*(F.col(f"`{k}`") for k in table.key_columns)) if table.key_columns else F.lit(0)
    cut = F.pmod(key, F.greatest(lookup(layout.slots, part), F.lit(1)).cast("bigint")).cast("int")
    return (
        df.withColumn(PART, lookup(layout.parts, F.col(BUCKET)))
        .withColumn(SLOT, lookup(layout.first_slot, part) + cut)
        .repartitionById(max(layout.total_slots, 1), F.col(SLOT))
        .sortWithinPartitions(PART, *(F.col(f"`{c}`") for c in sort_columns))
        .drop(BUCKET, SLOT)
    )
