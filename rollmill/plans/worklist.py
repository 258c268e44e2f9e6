"""Which periods are closed and not yet published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.sources.manifests import PERIOD_IN_PATH


def period_entries(micro_manifests: DataFrame) -> DataFrame:
    """One row per written path: period, micro-batch, table."""
    return (
        micro_manifests.select(F.col("id").alias("micro_batch"), F.explode("tables").alias("table", "info"))
        .select("micro_batch", "table", F.explode("info.paths").alias("path"))
        .select(
            F.regexp_extract("path", PERIOD_IN_PATH, 1).try_cast("bigint").alias("period"),
            "micro_batch",
            "table",
            "path",
        )
    )


def open_periods(entries: DataFrame, last_done: int, current: int) -> DataFrame:
    """Periods after the last published one and before the running one, oldest first, with their
    micro-batches and tables. Paths without a period are an error."""
    period = F.coalesce(
        F.col("period"), F.raise_error(F.concat(F.lit("no period in path: "), F.col("path"))).cast("bigint")
    )
    return (
        entries.withColumn("period", period)
        .where((F.col("period") > last_done) & (F.col("period") < current))
        .groupBy("period")
        .agg(
            F.array_sort(F.collect_set("micro_batch")).alias("micro_batches"),
            F.array_sort(F.collect_set("table")).alias("tables"),
        )
        .orderBy("period")
    )


def published_entries(batch_manifests: DataFrame) -> DataFrame:
    """One row per micro-batch that a published period has taken in: period, micro_batch."""
    return batch_manifests.select(F.col("id").alias("period"), F.explode("microBatches").alias("micro_batch"))


def late_entries(entries: DataFrame, last_done: int, published: DataFrame) -> DataFrame:
    """Paths written for a period that had been published before, without them; they are never read."""
    return entries.where(F.col("period") <= last_done).join(published, ["period", "micro_batch"], "left_anti")
