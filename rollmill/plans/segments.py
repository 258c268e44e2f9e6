"""Snapshots as lists of segments: closing a period writes the period's own rows.

A segment is a folder of immutable files, ``batch/<table>/dt=<period>`` or, made of several,
``dt=<first>-<last>``, with a folder per bucket where the table is partitioned. A snapshot is the list of
segments in its manifest; the next one takes over the list and adds to it. Times and rows of every
segment stand beside it, so

* all periods of a backlog are closed by one aggregate over their new rows: where the time dimension of
  a row decides its period, rows of different periods have different keys, so one pass writes all
  segments and each period's manifest lists those up to its own;
* segments that an interval to keep leaves out are dropped unread, and only those across its ends are
  read and written again;
* parts are a matter of the manifest: it maps buckets to parts by the rows of all segments, and no row
  moves when the map changes.

Segments are put together by size: as soon as ``merge_after`` neighbours have come to one size class
(powers of ``merge_after``), they become one of the next class. So a row is written again once per class,
a logarithm of the history's size, and a snapshot has at most ``merge_after`` segments per class.

A key that may come again (no time column, lossy time format, own processor, rows outside their period)
cannot be appended; ``rollmill.plans.snapshot`` then makes one segment of everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rollmill import files
from rollmill.durations import interval_bounds
from rollmill.functions.periods import period_of
from rollmill.operators.balance import BUCKET, BUCKET_FOLDER, bucket_column, part_of_bucket
from rollmill.operators.rollup import keep_between, rerollup
from rollmill.session import scratch_path, stage
from rollmill.sinks.store import write_segments
from rollmill.sources.store import PERIOD, read_segments
from rollmill.spec import Dimension, IndexerSpec, TableSpec

# The name of a row's segment while it is on its way to its folder ``dt=``.
DT = "__dt"


@dataclass(frozen=True)
class Segment:
    """Rows of the periods from ``first`` to ``last``; ``bucket_rows`` where they lie in bucket folders."""

    path: str
    first: int
    last: int
    rows: int
    min_time: int | None = None
    max_time: int | None = None
    bucket_rows: tuple[int, ...] | None = None

    def to_dict(self) -> dict[str, Any]:
        return {
            "path": self.path,
            "first": self.first,
            "last": self.last,
            "recordCount": self.rows,
            "minTime": self.min_time,
            "maxTime": self.max_time,
            "bucketRows": list(self.bucket_rows) if self.bucket_rows is not None else None,
        }

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> Segment:
        buckets = doc.get("bucketRows")
        return cls(
            doc["path"],
            doc["first"],
            doc["last"],
            doc["recordCount"],
            doc.get("minTime"),
            doc.get("maxTime"),
            tuple(buckets) if buckets is not None else None,
        )


def as_dict(info: Row | Mapping[str, Any]) -> dict[str, Any]:
    return info.asDict(recursive=True) if isinstance(info, Row) else dict(info)


def segments_of(info: Row | Mapping[str, Any] | None) -> list[Segment] | None:
    """The segments a manifest entry lists; None for a snapshot of another making."""
    found = as_dict(info).get("segments") if info is not None else None
    return None if found is None else [Segment.from_dict(as_dict(s)) for s in found]


def entry_of(table: TableSpec, indexer: IndexerSpec, segments: Sequence[Segment]) -> dict[str, Any]:
    """The manifest entry of a snapshot that is made of these segments."""

    def over(pick, values: Iterable[int | None]) -> int | None:
        known = [v for v in values if v is not None]
        return pick(known) if known and len(known) == len(segments) else None

    entry: dict[str, Any] = {
        "paths": [s.path for s in segments],
        "columns": table.columns,
        "recordCount": sum(s.rows for s in segments),
        "minTime": over(min, (s.min_time for s in segments)),
        "maxTime": over(max, (s.max_time for s in segments)),
        "format": indexer.format_of(table),
        "segments": [s.to_dict() for s in segments],
    }
    partitioning = indexer.partitioning_of(table)
    if partitioning:
        n = partitioning.partitions
        rows = [sum((s.bucket_rows or (0,) * n)[b] for s in segments) for b in range(n)]
        entry["partitioning"] = part_of_bucket({b: r for b, r in enumerate(rows) if r}, n)
        entry["partitionConf"] = {"columns": list(partitioning.columns), "partitions": n}
        entry["bucketRows"] = rows
    return entry


def extendable(table: TableSpec, indexer: IndexerSpec, info: Row | Mapping[str, Any] | None) -> list[Segment] | None:
    """The segments that new ones can be put beside, or None if they lie in another layout or format."""
    if info is None:
        return []
    segments, entry = segments_of(info), as_dict(info)
    if segments is None or any(s.max_time is None for s in segments):
        return None
    if segments and (entry.get("format") or "tsv") != indexer.format_of(table):
        return None
    partitioning = indexer.partitioning_of(table)
    conf = entry.get("partitionConf")
    if partitioning is None:
        same = conf is None
    else:
        same = conf is not None and (tuple(conf["columns"]), conf["partitions"]) == (
            partitioning.columns,
            partitioning.partitions,
        )
    return segments if same else None


def size_class(rows: int, merge_after: int) -> int:
    """How often ``rows`` can be divided by ``merge_after``."""
    found = 0
    while rows >= merge_after:
        rows //= merge_after
        found += 1
    return found


def due_merges(segments: Sequence[Segment], merge_after: int) -> list[tuple[int, int]]:
    """Runs ``[begin, end)`` of neighbours to put together: of one size class at their ends, none above it
    between, and ``merge_after`` of it at least. Smallest class first, one class a call."""
    classes = [size_class(s.rows, merge_after) for s in segments]
    for level in sorted(set(classes)):
        runs, begin = [], None
        for at, found in enumerate([*classes, level + 1]):
            if found > level:
                if begin is not None and classes[begin:at].count(level) >= merge_after:
                    last = max(i for i in range(begin, at) if classes[i] == level)
                    runs.append((begin, last + 1))
                begin = None
            elif found == level and begin is None:
                begin = at
        if runs:
            return runs
    return []


def measured(
    spark: SparkSession, rows: DataFrame, table: TableSpec, indexer: IndexerSpec, time_column: str | None
) -> dict[str, Segment]:
    """Row counts and times per segment of rows about to be written; at most a row a segment and bucket
    comes to the driver."""
    partitioning = indexer.partitioning_of(table)
    measures = [F.count(F.lit(1)).alias("rows")]
    if time_column:
        millis = F.unix_millis(F.col(f"`{time_column}`").cast("timestamp"))
        measures += [F.min(millis).alias("first"), F.max(millis).alias("latest")]
    found: dict[str, Segment] = {}
    keys = [DT, BUCKET] if partitioning else [DT]
    for row in rows.groupBy(*keys).agg(*measures).collect():
        name, facts = row[DT], row.asDict()
        first, _, last = name.partition("-")
        empty = (0,) * partitioning.partitions if partitioning else None
        last = re.match(r"\d+", last or first)[0]
        known = found.get(name) or Segment(
            f"{indexer.batch_root}/{table.name}/dt={name}", int(first), int(last), 0, None, None, empty
        )
        times = [t for t in (known.min_time, facts.get("first")) if t is not None]
        latest = [t for t in (known.max_time, facts.get("latest")) if t is not None]
        buckets = known.bucket_rows
        if buckets is not None:
            buckets = tuple(n + (facts["rows"] if b == row[BUCKET] else 0) for b, n in enumerate(buckets))
        found[name] = replace(
            known,
            rows=known.rows + facts["rows"],
            min_time=min(times, default=None),
            max_time=max(latest, default=None),
            bucket_rows=buckets,
        )
    return found


def make_segments(
    spark: SparkSession,
    rows: DataFrame,
    table: TableSpec,
    indexer: IndexerSpec,
    time_column: str | None,
    names: Sequence[str],
) -> list[Segment]:
    """Write rows, which carry the name of their segment in ``DT``, and return the segments that have any,
    in the order of ``names``. The rows are read twice, to be counted and to be written."""
    partitioning = indexer.partitioning_of(table)
    if partitioning:
        rows = rows.withColumn(BUCKET, bucket_column(table, partitioning))
    found = measured(spark, rows, table, indexer, time_column)
    root = f"{indexer.batch_root}/{table.name}"
    for name in names:  # what an attempt that was never told of has left
        files.delete(spark, f"{root}/dt={name}")
    if found:
        write_segments(
            rows,
            table,
            root,
            {DT: "dt", BUCKET: BUCKET_FOLDER} if partitioning else {DT: "dt"},
            indexer.sort_of(table),
            indexer.batch.rows_per_file,
            indexer.format_of(table),
        )
    return [found[name] for name in names if name in found]


def make_staged(spark: SparkSession, rows: DataFrame, table: TableSpec, indexer: IndexerSpec, time_column: str | None, name: str) -> list[Segment]:
    """One segment of rows that are costly to read, or would be read from where they are written to."""
    scratch = scratch_path(spark, f"{table.name}-{name}")
    try:
        staged = stage(rows.withColumn(DT, F.lit(name)), scratch)
        return make_segments(spark, staged, table, indexer, time_column, [name])
    finally:
        files.delete(spark, scratch)


def merged(
    spark: SparkSession, table: TableSpec, indexer: IndexerSpec, segments: Sequence[Segment], time_column: str | None
) -> list[Segment]:
    """Put due neighbours together until none are due; keys differ, so rows are only brought together."""
    segments = list(segments)
    while runs := due_merges(segments, indexer.batch.merge_after):
        for begin, end in reversed(runs):
            group = segments[begin:end]
            name = f"{group[0].first}-{group[-1].last}"
            rows = read_segments(spark, table, [s.path for s in group], indexer.format_of(table))
            segments[begin:end] = make_staged(spark, rows, table, indexer, time_column, name)
    return segments


def retained(
    spark: SparkSession,
    table: TableSpec,
    indexer: IndexerSpec,
    segments: Sequence[Segment],
    time_column: str,
    bounds: tuple[datetime, datetime],
) -> list[Segment]:
    """Without the rows outside ``bounds``: by their times alone, but for segments across an end."""
    start, end = (int(t.timestamp() * 1000) for t in bounds)
    kept: list[Segment] = []
    for s in segments:
        if s.max_time < start or s.min_time >= end:
            continue
        if start <= s.min_time and s.max_time < end:
            kept.append(s)
            continue
        name = f"{s.first}-{s.last}~{start}-{end}"
        rows = read_segments(spark, table, [s.path], indexer.format_of(table))
        kept += make_staged(spark, keep_between(time_column, *bounds)(rows), table, indexer, time_column, name)
    return kept


def close_periods(
    spark: SparkSession,
    table: TableSpec,
    indexer: IndexerSpec,
    periods: Sequence[int],
    new_rows: DataFrame,
    previous: Row | Mapping[str, Any] | None,
    time_column: str,
) -> dict[int, dict[str, Any]] | None:
    """Close all ``periods`` (oldest first) in one pass over their new rows, which carry their period in
    ``PERIOD``; the manifest entries by period. None if it cannot be proved that no key comes again."""
    segments = extendable(table, indexer, previous)
    if segments is None or any(s.max_time >= periods[0] or s.last >= periods[0] for s in segments):
        return None
    time = F.col(f"`{time_column}`")
    # Where it holds that the time decides the period, the period as one more key changes no row.
    by_period = replace(
        table, dimensions=(*table.dimensions, Dimension(PERIOD, type="long")), sort_columns=None, partitioning=None
    )
    rolled = rerollup(by_period)(new_rows)
    bounds = interval_bounds(indexer.batch.keep) if indexer.batch.keep else None
    if bounds:
        rolled = keep_between(time_column, *bounds)(rolled)
    scratch = scratch_path(spark, f"{table.name}-new")
    try:
        rolled = stage(rolled, scratch)
        own = (period_of(time, indexer.batch.period_millis) == F.col(PERIOD)) & (
            time >= F.timestamp_millis(F.col(PERIOD))
        )
        if not rolled.where(~F.coalesce(own, F.lit(False))).isEmpty():
            return None
        named = rolled.withColumn(DT, F.col(PERIOD).cast("string")).drop(PERIOD)
        made = make_segments(spark, named, table, indexer, time_column, [str(p) for p in periods])
    finally:
        files.delete(spark, scratch)
    if bounds:
        segments = retained(spark, table, indexer, segments, time_column, bounds)
    segments = merged(spark, table, indexer, segments, time_column)
    fresh = {s.first: s for s in made}
    entries = {}
    for period in periods:
        segments = [*segments, fresh[period]] if period in fresh else segments
        entries[period] = entry_of(table, indexer, segments)
    return entries


def unused_folders(spark: SparkSession, table: TableSpec, indexer: IndexerSpec, entries: Iterable[Row | Mapping[str, Any]]) -> list[str]:
    """Folders of the table that none of these manifest entries names."""
    root = f"{indexer.batch_root}/{table.name}"
    named = {p.rstrip("/").rpartition("/")[2] for e in entries for p in as_dict(e)["paths"]}
    return [f"{root}/{n}" for n in files.names(spark, root) if n.startswith("dt=") and n not in named]


def part_paths(info: Row | Mapping[str, Any], part: int) -> list[str]:
    """The folders that hold a part of a partitioned snapshot: its buckets, in every segment that has them."""
    entry = as_dict(info)
    own = [b for b, p in enumerate(entry["partitioning"]) if p == part]
    return [
        f"{s.path}/{BUCKET_FOLDER}={b}"
        for s in segments_of(entry) or []
        for b in own
        if s.bucket_rows and s.bucket_rows[b]
    ]

