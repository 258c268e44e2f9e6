"""Batch job: publish a snapshot for every closed period, oldest first.

Only a handful of numbers pass through the driver (periods, bucket row counts, manifests). All due
periods of a table are closed in one pass (``plans.segments``); where that cannot be, they form a chain,
each building on the one before (``plans.snapshot``). Tables run side by side.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rollmill import files
from rollmill.operators.chain import Processor, load_hook
from rollmill.plans.segments import close_periods
from rollmill.plans.snapshot import History, kept_by, provable, publish_snapshot
from rollmill.plans.worklist import late_entries, open_periods, period_entries, published_entries
from rollmill.session import configure, own_session, scratch_path, side_by_side, size_shuffles, stage
from rollmill.sinks.manifests import send_manifest
from rollmill.sources.manifests import (
    BATCH_SCHEMA,
    MICRO_BATCH_SCHEMA,
    all_manifests,
    fold_manifests,
    last_message,
    manifests_of,
)
from rollmill.sources.store import PERIOD, read_micro_batches, read_published
from rollmill.spec import IndexerSpec, TableSpec

log = logging.getLogger(__name__)


class BatchJob:
    """``processors`` (or the batch ``processorClass``) replace the re-rollup of a table."""

    def __init__(
        self,
        spark: SparkSession,
        indexer: IndexerSpec,
        tables: list[TableSpec],
        processors: Mapping[str, Processor] | None = None,
        workers: int = 4,
    ) -> None:
        self.spark = configure(spark)
        self.indexer = indexer
        self.tables = {t.name: t for t in tables}
        for table in tables:
            kept_by(table, indexer)
        custom = indexer.batch.processor
        make: Callable[[TableSpec], Processor] | None = load_hook(custom) if custom else None
        self.processors: dict[str, Processor] = {t.name: make(t) for t in tables} if make else {}
        self.processors |= dict(processors or {})
        self.workers = workers
        # Paths that came after their period was published, as of the last run.
        self.late_paths = 0

    def published(self) -> tuple[int, dict[str, tuple[int, Any]]]:
        """The last published period, and the newest snapshot of every table with its manifest entry."""
        channel = self.indexer.batch.channel
        last = last_message(self.spark, channel, BATCH_SCHEMA)
        if last is None:
            return 0, {}
        found = {name: (last["id"], info) for name, info in (last["tables"] or {}).items()}
        if set(self.tables) - set(found):  # some table had nothing in that period
            newest = (
                all_manifests(self.spark, channel, BATCH_SCHEMA)
                .select("id", F.explode("tables").alias("table", "info"))
                .groupBy("table")
                .agg(F.max_by(F.struct("id", "info"), "id").alias("newest"))
            )
            found = {r["table"]: (r["newest"]["id"], r["newest"]["info"]) for r in newest.collect()}
        return last["id"], found

    def new_rows(self, spark: SparkSession, name: str, periods: list[int], told: str) -> DataFrame:
        """What the micro-batches that the messages in ``told`` name have stored for these periods, with the
        period as ``PERIOD``."""
        entries = period_entries(spark.read.schema(MICRO_BATCH_SCHEMA).parquet(told))
        own = entries.where(F.col("table") == name).select("period", "micro_batch")
        return read_micro_batches(spark, self.tables[name], self.indexer.realtime_root, periods, own)

    def close_table(
        self, name: str, periods: list[int], told: str, previous: tuple[int, Any] | None
    ) -> dict[int, dict[str, Any]] | None:
        """All due periods of a table in one pass, where none of its keys can come again; else None."""
        table, spark = self.tables[name], own_session(self.spark)
        certain = provable(table, self.indexer, self.processors.get(name))
        if certain is None or self.indexer.batch.snapshots != "segments":
            return None
        rows = self.new_rows(spark, name, periods, told)
        size_shuffles(spark, rows)
        return close_periods(spark, table, self.indexer, periods, rows, previous[1] if previous else None, certain)

    def publish_table(
        self, name: str, period: int, told: str, previous: tuple[int, Any] | None
    ) -> dict[str, Any]:
        """One period of a table, by the whole history where it must be."""
        table, spark = self.tables[name], own_session(self.spark)
        new_rows = self.new_rows(spark, name, [period], told).drop(PERIOD)
        history = None
        if previous:
            history = History(read_published(spark, table, previous[1]), previous[1])
        size_shuffles(spark, new_rows, *([history.rows] if history else []))
        return publish_snapshot(
            spark, table, self.indexer, period, new_rows, history, self.processors.get(name)
        )

    def run(self, now_millis: int | None = None) -> list[dict[str, Any]]:
        """Publish what is due and return the manifests sent; ``late_paths`` then tells what came too late.

        Messages whose periods are all published are folded away, so a run reads those since the last
        one, and a late path is counted until its message is folded.
        """
        now = int(time.time() * 1000) if now_millis is None else now_millis
        length = self.indexer.batch.period_millis
        current = now // length * length
        last_done, newest = self.published()
        # A message that arrives from here on is left to the next run, to be taken in or counted as late.
        scratch = scratch_path(self.spark, "messages")
        try:
            told = all_manifests(self.spark, self.indexer.real_time.channel, MICRO_BATCH_SCHEMA, after=last_done)
            told = stage(told, scratch)
            entries = period_entries(told)
            self.late_paths = self.count_late(entries, last_done)
            if self.late_paths:
                log.warning("%s micro-batch paths came after their period was published; skipped", self.late_paths)
            sent = self.publish(open_periods(entries, last_done, current).collect(), scratch, newest)
            done = sent[-1]["id"] if sent else last_done
            fold_manifests(self.spark, self.indexer.real_time.channel, MICRO_BATCH_SCHEMA, done, told.select("id"))
        finally:
            files.delete(self.spark, scratch)
        return sent

    def count_late(self, entries: DataFrame, last_done: int) -> int:
        """Paths of published periods that their manifests do not name; only those manifests are read."""
        before = entries.where(F.col("period") <= last_done)
        periods = [r["period"] for r in before.select("period").distinct().collect()]
        if not periods:
            return 0
        done = manifests_of(self.spark, self.indexer.batch.channel, BATCH_SCHEMA, periods)
        return late_entries(before, last_done, published_entries(done)).count()

    def publish(
        self, worklist: list[Row], told: str, newest: dict[str, tuple[int, Any]]
    ) -> list[dict[str, Any]]:
        due_of: dict[str, list[int]] = {}
        for due in worklist:
            for name in due["tables"]:
                due_of.setdefault(name, []).append(due["period"])
        unknown = sorted(set(due_of) - set(self.tables))
        if unknown:
            raise ValueError(f"no settings for tables: {', '.join(unknown)}")
        passes = {n: partial(self.close_table, n, p, told, newest.get(n)) for n, p in due_of.items()}
        closed = side_by_side(self.spark, self.workers, passes) if passes else {}
        sent = []
        for due in worklist:
            period, names = due["period"], due["tables"]
            tasks = {
                n: partial(self.publish_table, n, period, told, newest.get(n)) for n in names if closed[n] is None
            }
            infos = side_by_side(self.spark, self.workers, tasks) if tasks else {}
            infos |= {n: closed[n][period] for n in names if closed[n] is not None}
            manifest = {"id": period, "tables": infos, "microBatches": due["micro_batches"]}
            send_manifest(self.spark, self.indexer.batch.channel, manifest)
            newest |= {name: (period, info) for name, info in infos.items()}
            sent.append(manifest)
        return sent

