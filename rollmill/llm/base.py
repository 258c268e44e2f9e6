"""Shared pieces of the corpus operators.

Operators read the columns ``doc_id`` and ``text`` of a table and carry whatever other columns it
has; columns they add for their own use get names that the table does not have (``fresh``).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rollmill.session import configure

# Texts may be long: few rows per Arrow batch keep a Python worker's memory small.
BATCH_ROWS = "500"


def _reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did. A cluster whose machines do
    not share that folder gets it by ``--py-files``, as usual."""
    environment = spark.sparkContext.environment
    root, paths = str(Path(__file__).resolve().parents[2]), environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    _reach_workers(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def with_columns(
    df: DataFrame, fields: list[T.StructField], compute: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]]
) -> DataFrame:
    """Append columns that ``compute`` makes of each Arrow batch; rows keep their place and other columns."""
    schema = T.StructType([*df.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema.fields]
        held: list[pa.RecordBatch] = []

        def kept() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                yield batch

        for made in compute(kept()):
            yield pa.RecordBatch.from_arrays([*held.pop().columns, *made], names=names)

    return df.mapInArrow(run, schema)
