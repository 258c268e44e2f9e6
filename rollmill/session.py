"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from rollmill import files

R = TypeVar("R")

# Results depend on these: UTC time, casts that fail instead of yielding NULL, last key wins in JSON.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


# What a byte of gzip text becomes in a shuffle, and what one shuffle partition should hold. Adaptive
# execution puts partitions together that turn out small, but cannot split those of an aggregate.
GZIP_TEXT_EXPANSION = 6
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, whose settings can change without touching other jobs."""
    child = spark.newSession()
    for key, value in spark.conf.getAll.items() - child.conf.getAll.items():
        if child.conf.isModifiable(key):
            child.conf.set(key, value)
    return child


def shuffle_partitions(store_bytes: int, least: int) -> int:
    wanted = -(-store_bytes * GZIP_TEXT_EXPANSION // SHUFFLE_PARTITION_BYTES)
    return max(least, wanted)


def size_shuffles(spark: SparkSession, *inputs: DataFrame) -> None:
    """Set the number of shuffle partitions by the size of the store files the inputs read."""
    total = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(total, least))


def side_by_side(spark: SparkSession, workers: int, tasks: Mapping[str, Callable[[], R]]) -> dict[str, R]:
    """Run Spark jobs of several tables at the same time; they keep the job group and pool of the caller."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(tasks)))) as pool:
        running = {name: pool.submit(inherit(task)) for name, task in tasks.items()}
        return {name: job.result() for name, job in running.items()}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one below the warehouse.

    A cluster session without the setting, whose warehouse is a folder of one machine, is an error:
    what is written there would be lost with its machine and be out of reach for the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith(("file:", "/")) or ":" not in warehouse
    if local and not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{warehouse.rstrip('/')}/_scratch"


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/rollmill/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def tidy(spark: SparkSession) -> None:
    """Delete what this process has put below the shared folder; results that read it are then gone."""
    while _made:
        files.delete(spark, _made.pop())


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write once and continue from the written table: later jobs neither recompute nor depend on
    blocks that die with an executor."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
