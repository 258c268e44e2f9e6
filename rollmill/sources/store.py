"""Reading rolled-up rows back from the store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.operators.balance import BUCKET_FOLDER, PART
from rollmill.sources.records import VALUE, convert_text
from rollmill.spec import TableSpec

SEPARATOR = "\t"
NULL_TEXT = "null"
_CELLS = "__cells"
# The period a stored row was found under; a table may have a column ``dt`` of its own.
PERIOD = "__period"


def parse_lines(df: DataFrame, table: TableSpec) -> DataFrame:
    """Store lines in ``value`` to typed rows; other columns pass through. A damaged line is an error.

    Cells are converted in one projection and checked in the next, so each is converted once.
    """
    times = {d.name: table.time_format(d.name) for d in table.time_dimensions}
    fields = table.store_schema.fields
    others = [F.col(c) for c in df.columns if c != VALUE]

    def cell(index: int) -> Column:
        return F.get(F.col(_CELLS), F.lit(index))

    def checked(index: int, field: T.StructField) -> Column:
        found = F.col(f"__typed_{index}")
        valid = found.isNotNull()
        if not isinstance(field.dataType, T.StringType):
            valid = valid | (cell(index) == NULL_TEXT)
        complaint = F.concat(F.lit(f"store line of {table.name}: cannot read {field.name}: "), F.col(VALUE))
        return F.when(valid, found).otherwise(F.raise_error(complaint).cast(field.dataType)).alias(field.name)

    typed = [
        convert_text(cell(i), f.dataType, times.get(f.name)).alias(f"__typed_{i}") for i, f in enumerate(fields)
    ]
    cells = df.withColumn(_CELLS, F.split(F.col(VALUE), SEPARATOR, -1))
    return cells.select(VALUE, _CELLS, *typed, *others).select(
        *(checked(i, f) for i, f in enumerate(fields)), *others
    )


def read_lines(spark: SparkSession, paths: str | list[str], base: str | None = None) -> DataFrame:
    """Text lines with the partition columns (``dt``, ``mb``, ``part``) found in their paths."""
    reader = spark.read.option("lineSep", "\n")
    if base:
        reader = reader.option("basePath", base)
    return reader.text(paths)


def read_micro_batches(
    spark: SparkSession, table: TableSpec, root: str, periods: Sequence[int], batches: DataFrame
) -> DataFrame:
    """Rows of some periods, with their period as ``PERIOD``, from the micro-batches that ``batches`` (period,
    micro_batch) names. Batches without a manifest are not read: their records come again under another
    manifest."""
    base = f"{root}/{table.name}"
    lines = read_lines(spark, [f"{base}/dt={p}" for p in periods], base)
    lines = lines.select(VALUE, F.col("dt").cast("bigint").alias(PERIOD), F.col("mb").cast("bigint").alias("mb"))
    told = batches.select(F.col("period").alias(PERIOD), F.col("micro_batch").alias("mb"))
    return parse_lines(lines.join(told, [PERIOD, "mb"], "left_semi").select(VALUE, PERIOD), table)


def read_snapshot(spark: SparkSession, table: TableSpec, root: str, period: int) -> DataFrame:
    """A whole snapshot by its folder."""
    base = f"{root}/{table.name}/dt={period}"
    return parse_lines(read_lines(spark, base, base).select(VALUE), table)


def read_segments(spark: SparkSession, table: TableSpec, paths: Sequence[str], format: str = "tsv") -> DataFrame:
    """Rows of the folders and all folders below them."""
    if not paths:
        return spark.createDataFrame([], table.store_schema)
    reader = spark.read.option("recursiveFileLookup", True)
    if format == "parquet":
        return reader.schema(table.store_schema).parquet(*paths)
    return parse_lines(reader.option("lineSep", "\n").text(list(paths)).select(VALUE), table)


def read_published(
    spark: SparkSession, table: TableSpec, entry: Mapping[str, Any] | Row, parts: bool = False
) -> DataFrame:
    """A snapshot by its manifest entry, of either making; with ``parts``, and the part every row is in."""
    info = entry.asDict(recursive=True) if isinstance(entry, Row) else dict(entry)
    paths, format = info["paths"], info.get("format") or "tsv"
    if not parts:
        return read_segments(spark, table, paths, format)
    if info.get("segments") is None:
        (path,) = paths
        return parse_lines(read_lines(spark, path, path).select(VALUE, F.col(PART).cast("int")), table)
    if not paths:
        return read_segments(spark, table, paths, format).withColumn(PART, F.lit(None).cast("int"))
    reader = spark.read.option("recursiveFileLookup", True)
    if format == "parquet":
        rows = reader.schema(table.store_schema).parquet(*paths)
    else:
        rows = reader.option("lineSep", "\n").text(list(paths))
    found = F.regexp_extract("_metadata.file_path", f"/{BUCKET_FOLDER}=(\\d+)/", 1).cast("int")
    part = F.element_at(F.lit(info["partitioning"]), found + 1).cast("int")
    rows = rows.select("*", part.alias(PART))
    return rows if format == "parquet" else parse_lines(rows, table)
