"""Writing rolled-up rows as gzip lines: ``realtime/<table>/dt=/mb=`` and ``batch/<table>/dt=[/part=]``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill import files
from rollmill.functions.periods import period_of, period_of_millis
from rollmill.functions.text import clean_text
from rollmill.operators.balance import PART
from rollmill.sources.records import VALUE
from rollmill.sources.store import NULL_TEXT, PERIOD, SEPARATOR
from rollmill.spec import ROLLUP_COUNT, TableSpec

_BATCH = "__batch"


def line_column(table: TableSpec, fields: list[T.StructField]) -> Column:
    """One store line: cells in output order, joined by tabs."""
    times = {d.name: table.time_format(d.name) for d in table.time_dimensions}

    def cell(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if field.name in times:
            return F.coalesce(times[field.name].format(col), F.lit(NULL_TEXT))
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(clean_text(col), F.lit(""))
        return F.coalesce(col.cast("string"), F.lit(NULL_TEXT))

    return F.concat_ws(SEPARATOR, *(cell(f) for f in fields))


def to_lines(df: DataFrame, table: TableSpec, *keep: str) -> DataFrame:
    """Rows as lines. Parsed rows that were not rolled up have no synthetic count yet; all else must be there."""
    uncounted = ROLLUP_COUNT not in df.columns
    fields = [f for f in table.store_schema.fields if not (uncounted and f.name == ROLLUP_COUNT)]
    return df.select(line_column(table, fields).alias(VALUE), *keep)


@dataclass(frozen=True)
class Written:
    rows: int
    paths: tuple[str, ...]
    min_time: int | None = None
    max_time: int | None = None


def write_micro_batch(
    df: DataFrame,
    table: TableSpec,
    root: str,
    period_millis: int,
    batch_millis: int,
    time_column: str | None = None,
) -> Written:
    """Write one micro-batch under its period(s).

    The period is that of the row's own (already truncated) time, or of the batch where no time
    column is set. Writing the same batch again replaces its files.
    """
    target = f"{root}/{table.name}"
    if time_column:
        timeless = F.raise_error(F.lit(f"{table.name}: a row without {time_column} has no period"))
        period = F.coalesce(period_of(F.col(f"`{time_column}`"), period_millis), timeless.cast("bigint"))
    else:
        period = period_of_millis(F.lit(batch_millis), period_millis)
    rows = df.withColumn(PERIOD, period).withColumn(_BATCH, F.lit(batch_millis))
    if time_column:
        # one or a few files per period: small periods are put together, heavy ones are split
        rows = rows.hint("rebalance", F.col(PERIOD))
    # observed in the writing stage itself, so a shuffle stage that runs twice does not count twice
    seen = Observation()
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(PERIOD).alias("periods"))
    (
        to_lines(observed, table, PERIOD, _BATCH)
        .withColumnsRenamed({PERIOD: "dt", _BATCH: "mb"})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("dt", "mb")
        .text(target)
    )
    found = seen.get
    paths = tuple(f"{target}/dt={p}/mb={batch_millis}" for p in sorted(found["periods"] or ()))
    return Written(found["rows"], paths)


def write_refused(df: DataFrame, root: str, batch_millis: int) -> int:
    """Write the bad records of a micro-batch as JSON lines below ``mb=``; how many there are. Writing the
    same batch again replaces its files; a batch without any leaves no folder."""
    target = f"{root}/mb={batch_millis}"
    if df.isEmpty():
        files.delete(df.sparkSession, target)
        return 0
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(target)
    return seen.get["rows"]


def write_snapshot(
    df: DataFrame, table: TableSpec, root: str, period: int, time_column: str | None = None
) -> Written:
    """Replace the snapshot of a period; rows that carry ``part`` go into a folder per part."""
    target = f"{root}/{table.name}/dt={period}"
    measures = [F.count(F.lit(1)).alias("rows")]
    if time_column:
        time = F.col(f"`{time_column}`").cast("timestamp")
        measures.append(F.min(F.unix_millis(time)).alias("first"))
        measures.append(F.max(F.unix_millis(time)).alias("latest"))
    seen = Observation()
    observed = df.observe(seen, *measures)
    parts = [PART] if PART in df.columns else []
    writer = to_lines(observed, table, *parts).write.mode("overwrite").option("compression", "gzip")
    if parts:
        writer = writer.partitionBy(PART).option("partitionOverwriteMode", "static")
    writer.text(target)
    found = seen.get
    return Written(found["rows"], (target,), found.get("first"), found.get("latest"))


def write_segments(
    df: DataFrame,
    table: TableSpec,
    root: str,
    folders: Mapping[str, str],
    sort_columns: tuple[str, ...],
    rows_per_file: int,
    format: str,
) -> None:
    """Write rows below ``root`` into the folders that ``folders`` (column -> name on disk) says, sorted
    inside files of at most ``rows_per_file`` rows. Heavy folders are cut into several tasks, light
    ones share a task."""
    clash = sorted(set(folders.values()) & set(table.columns))
    if format != "tsv" and clash:
        raise ValueError(f"table {table.name}: columns named as folders need snapshot format tsv: {', '.join(clash)}")
    rows = df.hint("rebalance", *(F.col(f) for f in folders))
    rows = rows.sortWithinPartitions(*folders, *(F.col(f"`{c}`") for c in sort_columns))
    rows = to_lines(rows, table, *folders) if format == "tsv" else rows.select(*(F.col(f"`{c}`") for c in table.columns), *folders)
    rows = rows.withColumnsRenamed(dict(folders))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("maxRecordsPerFile", rows_per_file).partitionBy(*folders.values())
    if format == "tsv":
        writer.option("compression", "gzip").text(root)
    else:
        writer.option("compression", "zstd").parquet(root)
