"""Building the whole snapshot of one table for one closed period.

This is the way of every period where snapshots are ``whole``, and of those that ``plans.segments`` can
not append to the history. A snapshot holds all history up to its period. The plain way is to union the previous snapshot
with the period's micro-batches and roll everything up again. Where it can be proved that no key of
the history can come again, the history is only passed on:

* the table's time dimension decides the period of a row, and it is part of the row key;
* the manifest of the previous snapshot says that all its times lie before this period;
* all new rows are checked to lie inside or after this period.

Then only the new rows are aggregated, and bucket row counts are those of the previous manifest
plus those of the new rows, so the history is read once and shuffled once (for the part layout)
or not at all. Anything that cannot be proved takes the plain way.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from rollmill import files
from rollmill.durations import interval_bounds
from rollmill.operators.balance import BUCKET, Layout, bucket_column, bucket_weights, place
from rollmill.operators.chain import Processor
from rollmill.operators.rollup import keep_between, rerollup
from rollmill.plans.segments import entry_of, make_staged
from rollmill.session import scratch_path, stage
from rollmill.sinks.store import write_snapshot
from rollmill.spec import IndexerSpec, Partitioning, TableSpec


@dataclass(frozen=True)
class History:
    """The previous snapshot and what its manifest says about it."""

    rows: DataFrame
    info: Row | Mapping[str, Any] | None = None

    def fact(self, name: str) -> Any:
        if self.info is None:
            return None
        info = self.info.asDict() if isinstance(self.info, Row) else self.info
        return info.get(name)


def time_column_of(table: TableSpec, indexer: IndexerSpec) -> str | None:
    """The time dimension that decides a row's period, if the table has it."""
    name = indexer.real_time.parse.time_column
    return name if name in {d.name for d in table.time_dimensions} else None


def kept_by(table: TableSpec, indexer: IndexerSpec) -> str | None:
    """The time dimension that an interval to keep looks at: the one of the period, else the only one."""
    if indexer.batch.keep is None:
        return None
    times = [d.name for d in table.time_dimensions]
    name = time_column_of(table, indexer) or (times[0] if len(times) == 1 else None)
    if name is None:
        raise ValueError(f"keepInterval: table {table.name} has no time column to keep rows by")
    return name


def drops_nothing(history: History, indexer: IndexerSpec) -> bool:
    """Whether the manifest proves that all of the history lies inside the interval to keep."""
    if indexer.batch.keep is None:
        return True
    first, last = history.fact("minTime"), history.fact("maxTime")
    start, end = (int(t.timestamp() * 1000) for t in interval_bounds(indexer.batch.keep))
    return first is not None and last is not None and start <= first and last < end


def provable(table: TableSpec, indexer: IndexerSpec, processor: Processor | None) -> str | None:
    """Time column by which old and new keys can be told apart, or None."""
    name = time_column_of(table, indexer)
    if name and processor is None and table.time_format(name).keeps(indexer.batch.period_millis):
        return name
    return None


def stray(column: str, period: int) -> Column:
    """Whether a new row lies before its period, or nowhere."""
    time = F.col(f"`{column}`")
    return time.isNull() | (time < F.timestamp_millis(F.lit(period)))


def keys_are_new(history: History, strays: int, period: int) -> bool:
    latest = history.fact("maxTime")
    return latest is not None and latest < period and strays == 0


def _same_layout(history: History, partitioning: Partitioning) -> bool:
    conf = history.fact("partitionConf")
    rows = history.fact("bucketRows")
    return (
        conf is not None
        and rows is not None
        and tuple(conf["columns"]) == partitioning.columns
        and conf["partitions"] == partitioning.partitions
        and len(rows) == partitioning.partitions
    )


def publish_snapshot(
    spark: SparkSession,
    table: TableSpec,
    indexer: IndexerSpec,
    period: int,
    new_rows: DataFrame,
    history: History | None = None,
    processor: Processor | None = None,
) -> dict[str, Any]:
    """Write the snapshot and return its manifest entry."""
    partitioning = indexer.partitioning_of(table)
    sort_columns = indexer.sort_of(table)
    certain = provable(table, indexer, processor)
    merge = processor or rerollup(table)
    keep: Processor = lambda df: df
    kept = kept_by(table, indexer)
    if kept:
        keep = keep_between(kept, *interval_bounds(indexer.batch.keep))

    scratch: list[str] = []

    def staged(df: DataFrame, name: str) -> DataFrame:
        scratch.append(scratch_path(spark, f"{table.name}-{period}-{name}"))
        return stage(df, scratch[-1])

    try:
        weights: dict[int, int] | None = None
        if history is None:
            merged = merge(keep(new_rows))
        elif certain and history.fact("maxTime") is not None:
            # strays are counted while the new rows are staged
            seen = Observation()
            counted = merge(keep(new_rows)).observe(seen, F.count_if(stray(certain, period)).alias("strays"))
            fresh = staged(counted, "new")
            if keys_are_new(history, seen.get["strays"], period):
                merged = keep(history.rows).unionByName(fresh)
                if partitioning and _same_layout(history, partitioning) and drops_nothing(history, indexer):
                    weights = bucket_weights(fresh.withColumn(BUCKET, bucket_column(table, partitioning)))
                    for bucket, rows in enumerate(history.fact("bucketRows")):
                        if rows:
                            weights[bucket] = weights.get(bucket, 0) + rows
                elif partitioning and indexer.batch.snapshots == "whole":  # counted by a read of its own; the history is not copied for it
                    weights = bucket_weights(merged.withColumn(BUCKET, bucket_column(table, partitioning)))
            else:
                merged = merge(keep(history.rows).unionByName(fresh))
        else:
            merged = merge(keep(history.rows.unionByName(new_rows)))

        if indexer.batch.snapshots == "segments":
            made = make_staged(spark, merged, table, indexer, certain, str(period))
            return entry_of(table, indexer, made)
        layout = None
        if partitioning:
            merged = merged.withColumn(BUCKET, bucket_column(table, partitioning))
            if weights is None:
                merged = staged(merged, "all")
                weights = bucket_weights(merged)
            layout = Layout.plan(weights, partitioning.partitions, indexer.batch.rows_per_file)
            merged = place(merged, table, layout, sort_columns)
        written = write_snapshot(merged, table, indexer.batch_root, period, certain)
    finally:
        for path in scratch:
            files.delete(spark, path)

    entry: dict[str, Any] = {
        "paths": list(written.paths),
        "columns": table.columns,
        "recordCount": written.rows,
        "minTime": written.min_time,
        "maxTime": written.max_time,
    }
    if partitioning and layout and weights is not None:
        entry["partitioning"] = list(layout.parts)
        entry["partitionConf"] = {
            "columns": list(partitioning.columns),
            "partitions": partitioning.partitions,
        }
        entry["bucketRows"] = [weights.get(b, 0) for b in range(partitioning.partitions)]
    return entry
