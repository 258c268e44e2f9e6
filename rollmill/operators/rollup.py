"""Select, truncate and aggregate: the rollup of raw rows, and the re-rollup of stored ones.

All expressions are built-in, so Spark plans each rollup as one partial and one final hash
aggregate. Rows of a hot key meet in the partial step, before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.operators.chain import Processor, chain
from rollmill.spec import Metric, TableSpec


def select_inputs(table: TableSpec) -> Processor:
    """Input fields under their output names; counts are made by the aggregation."""
    wanted = [*table.dimensions, *(m for m in table.metrics if not m.is_count)]
    return lambda df: df.select(*(F.col(f"`{c.input_field}`").alias(c.name) for c in wanted))


def _field_column(metric: Metric) -> str:
    return f"__field_{metric.input_field}"


def _select_fields(table: TableSpec) -> Processor:
    """As ``select_inputs``, but every metric field once, however many metrics read it. A sum and an
    average over one field are then the same aggregate to Spark, kept and shuffled once."""
    keys = [F.col(f"`{c.input_field}`").alias(c.name) for c in (*table.dimensions, *table.bitset_metrics)]
    read = {_field_column(m): m for m in table.metrics if not m.is_count and not m.is_bitset}
    fields = [F.col(f"`{m.input_field}`").alias(name) for name, m in read.items()]
    return lambda df: df.select(*keys, *fields)


def truncate_column(time: Column, granularity: str) -> Column:
    """Year, month and day give a DATE, hour and minute a TIMESTAMP; second changes nothing."""
    if granularity in ("year", "month"):
        return F.trunc(time, granularity)
    if granularity == "day":
        return F.to_date(time)
    if granularity in ("hour", "minute"):
        return F.date_trunc(granularity, time)
    if granularity == "second":
        return time
    raise ValueError(f"unknown granularity {granularity!r}")


def truncate_times(table: TableSpec) -> Processor:
    cut = {
        d.name: truncate_column(F.col(f"`{d.name}`"), d.granularity)
        for d in table.time_dimensions
        if d.granularity and d.granularity != "second"
    }
    return lambda df: df.withColumns(cut) if cut else df


def aggregate_column(metric: Metric, column: str | None = None) -> Column:
    """An average is kept as its sum, so that it can be added up again; ``finalise`` divides."""
    combine = {"sum": F.sum, "avg": F.sum, "min": F.min, "max": F.max, "count": F.sum}[metric.aggregate]
    return combine(F.col(f"`{column or metric.name}`"))


def aggregate(table: TableSpec, column_of: Callable[[Metric], str] = lambda m: m.name) -> Processor:
    """Group by dimensions and ids; add up stored counts, or count the rows where there are none."""

    def run(df: DataFrame) -> DataFrame:
        present = set(df.columns)
        merged = []
        for metric in table.metrics:
            if metric.is_bitset:
                continue
            if metric.is_count:
                counted = metric.name in present
                merged.append((aggregate_column(metric) if counted else F.count(F.lit(1))).alias(metric.name))
            else:
                merged.append(aggregate_column(metric, column_of(metric)).alias(metric.name))
        if not table.count_metrics:
            stored = table.count_column in present
            rows = F.sum(F.col(f"`{table.count_column}`")) if stored else F.count(F.lit(1))
            merged.append(rows.alias(table.count_column))
        keys = [F.col(f"`{k}`") for k in table.key_columns]
        return df.groupBy(*keys).agg(*merged)

    return run


def select_outputs(table: TableSpec) -> Processor:
    return lambda df: df.select(*(F.col(f"`{c}`") for c in table.columns))


def rollup(table: TableSpec) -> Processor:
    """Raw rows to rolled-up rows."""
    return chain(
        _select_fields(table),
        truncate_times(table),
        aggregate(table, _field_column),
        select_outputs(table),
    )


def rerollup(table: TableSpec) -> Processor:
    """Rolled-up rows of several batches to rolled-up rows; times are not truncated again."""
    return chain(aggregate(table), select_outputs(table))


def keep_between(column: str, start: datetime, end: datetime) -> Processor:
    """Drop rows outside ``[start, end)``."""
    time = F.col(f"`{column}`")
    return lambda df: df.where((time >= F.lit(start)) & (time < F.lit(end)))


def finalise(table: TableSpec, by: list[str] | None = None) -> Processor:
    """Read-side view: averages divided out and ids counted, per ``by`` (default: all dimensions).

    Ids are counted with one DISTINCT per bitset metric; Spark spreads that over (key, id) first, so
    a hot key does not land in one task.
    """
    groups = [d.name for d in table.dimensions] if by is None else list(by)

    def run(df: DataFrame) -> DataFrame:
        count = F.sum(F.col(f"`{table.count_column}`"))
        shown = []
        for metric in table.metrics:
            col = F.col(f"`{metric.name}`")
            if metric.is_bitset:
                shown.append(F.count_distinct(col).alias(metric.name))
            elif metric.aggregate == "avg":
                shown.append((F.sum(col) / F.nullif(count, F.lit(0))).alias(metric.name))
            else:
                shown.append(aggregate_column(metric).alias(metric.name))
        if not table.count_metrics:
            shown.append(count.alias(table.count_column))
        return df.groupBy(*(F.col(f"`{g}`") for g in groups)).agg(*shown)

    return run
