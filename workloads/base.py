"""Shared pieces of the queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.session import configure

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    run: Query
    sql: str | None = None


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table with its zone-less times as UTC timestamps."""
    df = configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in times}) if times else df


def shown(
    df: DataFrame, digits: int | None = None, dates: bool = False, finer: dict[str, int] | None = None
) -> DataFrame:
    """Times (and, unless asked for, dates) as times without zone, as the SQL side has them; doubles
    rounded where summing order shows (``finer``: columns with digits of their own)."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType) or (isinstance(f.dataType, T.DateType) and not dates):
            col = col.cast("timestamp_ntz")
        elif digits is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double"), (finer or {}).get(f.name, digits))
        out.append(col.alias(f.name))
    return df.select(*out)
