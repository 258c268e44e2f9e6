"""Real-time job: parse the stream once, roll every micro-batch up per table, write, then tell.

A table that follows from another one (``operators.lattice``) is rolled up from that one's rows, so the
parsed records are aggregated once per family of tables. Tables with a processor of their own, and jobs
that override ``process``, roll each table up from records.

Parsing is part of the streaming plan; ``foreachBatch`` does the rest. The batch time is the
stream's own ``current_timestamp``, which Spark keeps in the checkpoint: a batch that runs again
after a failure has the same time, hence the same ``mb=`` folder, and replaces what it wrote.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmill.operators import lattice
from rollmill.operators.chain import Processor, load_hook
from rollmill.operators.rollup import rollup
from rollmill.session import configure, side_by_side
from rollmill.sinks.manifests import send_manifest
from rollmill.sinks.store import Written, write_micro_batch, write_refused
from rollmill.sources import kafka
from rollmill.sources.manifests import MICRO_BATCH_SCHEMA, all_manifests, last_message
from rollmill.sources.records import BAD, RecordParser, explained, good_records, record_parser, refused_records
from rollmill.spec import IndexerSpec, TableSpec, input_schema

log = logging.getLogger(__name__)

BATCH_TIME = "__batch_millis"
METRICS = "records"


class StreamJob:
    """Override ``parse``, ``process``, ``save`` or ``notify`` to change one step."""

    def __init__(
        self,
        spark: SparkSession,
        indexer: IndexerSpec,
        tables: list[TableSpec],
        parser: RecordParser | None = None,
        processors: Mapping[str, Processor] | None = None,
        workers: int = 4,
    ) -> None:
        self.workers = workers
        self.spark = configure(spark)
        self.indexer = indexer
        self.tables = list(tables)
        column = indexer.real_time.parse.time_column
        timeless = [t.name for t in self.tables if column and column not in {d.name for d in t.time_dimensions}]
        if timeless:
            raise ValueError(f"tables without the time dimension {column}: {', '.join(timeless)}")
        self.quarantine = indexer.real_time.quarantine
        if parser is None:
            self.parser = record_parser(indexer.real_time.parse, input_schema(tables), self.quarantine)
        else:
            self.parser = explained(parser) if self.quarantine else parser
        custom = indexer.real_time.processor
        make: Callable[[TableSpec], Processor] = load_hook(custom) if custom else rollup
        self.processors = {t.name: make(t) for t in self.tables} | dict(processors or {})
        own = set(processors or {}) | ({t.name for t in self.tables} if custom else set())
        if type(self).process is not StreamJob.process:
            own = {t.name for t in self.tables}
        self.parents: dict[str, str | None] = {t.name: None for t in self.tables}
        self.parents |= lattice.plan([t for t in self.tables if t.name not in own])
        self.offsets: list[dict] | None = None  # of all partitions met, read from manifests at the first batch

    def parse(self, records: DataFrame) -> DataFrame:
        """Typed fields, the bad-record flag, the batch time, and both record counts as query metrics."""
        return (
            records.transform(self.parser)
            .withColumn(BATCH_TIME, F.unix_millis(F.current_timestamp()))
            .observe(METRICS, F.count(F.lit(1)).alias("read"), F.count_if(F.col(BAD)).alias("bad"))
        )

    def process(self, table: TableSpec, records: DataFrame) -> DataFrame:
        return records.transform(self.processors[table.name])

    def save(self, table: TableSpec, rows: DataFrame, batch_millis: int) -> Written:
        return write_micro_batch(
            rows,
            table,
            self.indexer.realtime_root,
            self.indexer.batch.period_millis,
            batch_millis,
            self.indexer.real_time.parse.time_column,
        )

    def _save_table(
        self, table: TableSpec, records: DataFrame, batch_millis: int, rolled: dict[str, DataFrame]
    ) -> Written:
        parent = self.parents[table.name]
        if parent is None:
            rows = self.process(table, records)
        else:
            by_name = {t.name: t for t in self.tables}
            rows = lattice.derived(table, by_name[parent])(rolled[parent])
        if table.name in self.parents.values():
            rolled[table.name] = rows = rows.persist()
        return self.save(table, rows, batch_millis)

    def notify(self, manifest: Mapping[str, Any]) -> None:
        send_manifest(self.spark, self.indexer.real_time.channel, manifest)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: every table reads the same parsed records, then one manifest names it all."""
        parsed = batch.persist()
        rolled: dict[str, DataFrame] = {}
        try:
            parse = self.indexer.real_time.parse
            records = good_records(parsed, replace(parse, skip_bad_rows=True) if self.quarantine else parse)
            # one parallel pass that fills the cache, and tells an empty batch
            batch_millis = records.agg(F.min(BATCH_TIME)).first()[0]
            if self.quarantine:
                self.save_refused(parsed)
            if kafka.OFFSET in parsed.columns:  # of a batch of bad records, too: the next manifest tells them
                self.offsets = kafka.carried(self.known_offsets(), kafka.end_offsets(parsed))
            if batch_millis is None:
                return
            by_name, written = {t.name: t for t in self.tables}, {}
            for level in lattice.levels(self.parents):
                tasks = {n: partial(self._save_table, by_name[n], records, batch_millis, rolled) for n in level}
                written |= side_by_side(self.spark, self.workers, tasks)
            manifest: dict[str, Any] = {
                "id": batch_millis,
                "tables": {
                    t.name: {
                        "paths": list(written[t.name].paths),
                        "columns": t.columns,
                        "recordCount": written[t.name].rows,
                    }
                    for t in self.tables
                },
            }
            if kafka.OFFSET in parsed.columns:
                manifest["offsets"] = self.offsets
        finally:
            for rows in rolled.values():
                rows.unpersist()
            parsed.unpersist()
        self.notify(manifest)
        log.info("micro-batch %s (%s) written", batch_id, batch_millis)

    def save_refused(self, parsed: DataFrame) -> None:
        """Bad records of a micro-batch, also of one that has no others."""
        batch_millis = parsed.agg(F.min(BATCH_TIME)).first()[0]
        if batch_millis is not None:
            carried = tuple(c for c in (kafka.TOPIC, kafka.PARTITION, kafka.OFFSET) if c in parsed.columns)
            write_refused(refused_records(parsed, carried), self.indexer.quarantine_root, batch_millis)

    def known_offsets(self) -> list[dict]:
        """Where every partition met so far goes on."""
        if self.offsets is None:
            channel = self.indexer.real_time.channel
            last = last_message(self.spark, channel, MICRO_BATCH_SCHEMA)
            if last is not None and last["offsets"]:  # every message carries the offsets of all partitions
                self.offsets = [o.asDict() for o in last["offsets"]]
            else:  # messages of another making
                self.offsets = kafka.newest_offsets(all_manifests(self.spark, channel, MICRO_BATCH_SCHEMA))
        return self.offsets

    def source(self, partitions: Mapping[str, int] | None = None) -> DataFrame:
        """The stream the settings name: a hook ``(spark, indexer) -> DataFrame``, or Kafka."""
        real_time = self.indexer.real_time
        if real_time.stream_source:
            return load_hook(real_time.stream_source)(self.spark, self.indexer)
        if real_time.kafka is None:
            raise ValueError("no real-time source is set")
        partitions = real_time.kafka.partitions if partitions is None else partitions
        offsets = kafka.starting_offsets(real_time.kafka, self.known_offsets(), partitions)
        return kafka.read_stream(self.spark, real_time.kafka, offsets)

    def start(
        self,
        checkpoint: str,
        records: DataFrame | None = None,
        available_now: bool = False,
    ) -> StreamingQuery:
        """Start on any streaming frame with a ``value`` column (default: the source of the settings)."""
        stream = self.parse(self.source() if records is None else records)
        writer = stream.writeStream.foreachBatch(self.handle).option("checkpointLocation", checkpoint)
        if available_now:
            return writer.trigger(availableNow=True).start()
        seconds = self.indexer.real_time.window_millis / 1000
        return writer.trigger(processingTime=f"{seconds} seconds").start()
