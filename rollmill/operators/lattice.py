"""Tables that follow from other tables: one pass over raw records for a whole family of cubes.

A table can be rolled up from another table's rolled-up rows instead of raw records where each of its
dimensions is one of the other's, at the same or a coarser granularity, and each of its metrics can be
had from the other's: sums (and averages, kept as sums) from a sum of the same field, extremes from
the same extremes, counts from the count, ids from the same ids. Rows of the other table are far fewer
than records, so a family of nested tables costs about as much as its finest one.

``plan`` picks for each table the smallest table it follows from: fewest keys, then the coarsest times.
Tables that follow from none are rolled up from records.

Sums of fractions are added in another order than from raw records, so their last digits can differ, as
they do between two runs of any distributed sum.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.operators.chain import Processor
from rollmill.operators.rollup import rollup, truncate_column
from rollmill.spec import Dimension, Metric, TableSpec

# Every unit is a whole number of those before it, in UTC. No granularity is that of the time itself, and
# "second" leaves it as it is.
FINENESS = {None: 0, "second": 0, "minute": 1, "hour": 2, "day": 3, "month": 4, "year": 5}


def _fineness(dimension: Dimension) -> int:
    return FINENESS[dimension.granularity] if dimension.is_time else 0


def source_dimension(child: Dimension, parent: TableSpec) -> Dimension | None:
    """The dimension of ``parent`` that ``child`` follows from, the coarsest there is."""
    found = [
        d
        for d in parent.dimensions
        if d.input_field == child.input_field
        and d.is_time == child.is_time
        and d.data_type == child.data_type
        and _fineness(d) <= _fineness(child)
    ]
    return max(found, key=_fineness, default=None)


def source_metric(child: Metric, parent: TableSpec) -> str | None:
    """The column of ``parent`` that ``child`` follows from."""
    if child.is_count:
        return parent.count_column
    kinds = {"avg": "sum"}
    for metric in parent.metrics:
        if metric.is_count or metric.input_field != child.input_field or metric.data_type != child.data_type:
            continue
        if metric.is_bitset != child.is_bitset:
            continue
        if kinds.get(metric.aggregate, metric.aggregate) == kinds.get(child.aggregate, child.aggregate):
            return metric.name
    return None


def follows(child: TableSpec, parent: TableSpec) -> bool:
    """Whether ``child`` can be rolled up from the rows of ``parent``."""
    return all(source_dimension(d, parent) for d in child.dimensions) and all(
        source_metric(m, parent) for m in child.metrics
    )


def _size(table: TableSpec) -> tuple[int, int]:
    """Order of tables by how many rows they can be expected to have."""
    return len(table.key_columns), -sum(_fineness(d) for d in table.dimensions)


def plan(tables: Sequence[TableSpec]) -> dict[str, str | None]:
    """For every table the one it is made from, or None for raw records. Tables that follow from each other
    are made from the first of them, so there is no circle."""
    chosen: dict[str, str | None] = {}
    for at, child in enumerate(tables):
        usable = [
            (_size(p), n, p.name)
            for n, p in enumerate(tables)
            if n != at and follows(child, p) and (n < at or not follows(p, child))
        ]
        chosen[child.name] = min(usable)[2] if usable else None
    return chosen


def levels(parents: Mapping[str, str | None]) -> list[list[str]]:
    """Tables in the order they can be made: first those from records, then those from these, ..."""
    out: list[list[str]] = []
    done: set[str | None] = {None}
    left = dict(parents)
    while left:
        ready = [n for n, p in left.items() if p in done]
        out.append(ready)
        done |= set(ready)
        left = {n: p for n, p in left.items() if n not in done}
    return out


def derived(child: TableSpec, parent: TableSpec) -> Processor:
    """Rolled-up rows of ``parent`` to those of ``child``."""
    combine = {"sum": F.sum, "avg": F.sum, "min": F.min, "max": F.max, "count": F.sum}

    def key(dimension: Dimension) -> Column:
        source = source_dimension(dimension, parent)
        column = F.col(f"`{source.name}`")
        unit = dimension.granularity if dimension.is_time else None
        if unit and unit != "second" and unit != source.granularity:
            column = truncate_column(column.cast(T.TimestampType()), unit)
        return column.alias(dimension.name)

    def run(df: DataFrame) -> DataFrame:
        keys = [key(d) for d in child.dimensions]
        keys += [F.col(f"`{source_metric(m, parent)}`").alias(m.name) for m in child.bitset_metrics]
        merged = [
            combine[m.aggregate](F.col(f"`{source_metric(m, parent)}`")).alias(m.name)
            for m in child.metrics
            if not m.is_bitset
        ]
        if not child.count_metrics:
            merged.append(F.sum(F.col(f"`{parent.count_column}`")).alias(child.count_column))
        return df.groupBy(*keys).agg(*merged).select(*(F.col(f"`{c}`") for c in child.columns))

    if not follows(child, parent):
        raise ValueError(f"table {child.name} does not follow from {parent.name}")
    return run


def rollup_family(
    tables: Sequence[TableSpec], records: DataFrame, keep: Callable[[str, DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    """All tables from one frame of records. ``keep`` stores the rows of a table that others are made
    from (a cache, or a written table) and returns what these read."""
    by_name = {t.name: t for t in tables}
    parents = plan(tables)
    needed = {p for p in parents.values() if p}
    made: dict[str, DataFrame] = {}
    for name in (n for level in levels(parents) for n in level):
        parent = parents[name]
        if parent is None:
            rows = rollup(by_name[name])(records)
        else:
            rows = derived(by_name[name], by_name[parent])(made[parent])
        made[name] = keep(name, rows) if name in needed else rows
    return made
