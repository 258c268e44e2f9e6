"""Periods, the store, part layout, and both jobs end to end.

Queries that need files keep them below the shared folder of the session (``rollmill.session``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollmill.functions.periods import period_of
from rollmill.operators.balance import (
    BUCKET,
    PART,
    Layout,
    bucket_column,
    bucket_weights,
    place,
)
from rollmill.operators.chain import chain
from rollmill.operators.lattice import rollup_family
from rollmill.operators.rollup import finalise, rerollup, rollup, truncate_column
from rollmill.plans.batch import BatchJob
from rollmill.plans.worklist import late_entries, open_periods, period_entries, published_entries
from rollmill.session import scratch_path, stage
from rollmill.sinks.manifests import send_manifest
from rollmill.sinks.store import Written, write_micro_batch, write_snapshot
from rollmill.sources import kafka
from rollmill.sources.manifests import BATCH_SCHEMA, MICRO_BATCH_SCHEMA, all_manifests, last_manifest
from rollmill.sources.store import parse_lines, read_lines, read_published
from rollmill.spec import (
    BatchSpec,
    Channel,
    Dimension,
    IndexerSpec,
    Metric,
    ParseSpec,
    Partitioning,
    RealTimeSpec,
    TableSpec,
)
from rollmill.streaming.job import StreamJob
from workloads.base import Workload, load, shown
from workloads.parsing import delimited
from workloads.rollups import LINE_CUBE, LINE_METRICS_SQL, VALUE_METRICS, event_cube

DAY = 86_400_000
WEEK = 7 * DAY
# 2024-03-01, when every event is history
LATER = 1_709_251_200_000

USER_CUBE = TableSpec(
    "user_cube",
    (
        Dimension("user_id", type="long"),
        Dimension("event_type"),
        Dimension("ts", type="time", granularity="hour"),
    ),
    VALUE_METRICS,
)
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def indexer(root: str, **batch) -> IndexerSpec:
    return IndexerSpec(
        store=f"{root}/store",
        real_time=RealTimeSpec(
            parse=ParseSpec("tsv", columns=EVENT_COLUMNS, time_column="ts", time_formats={"ts": "micros"}),
            channel=Channel("file", root, "realtime-manifests"),
        ),
        batch=BatchSpec(channel=Channel("file", root, "batch-manifests"), **batch),
    )


def period_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncation comes before the period: a month granularity moves rows to the period of the first."""
    events = load(spark, sf_dir, "events")
    by_day = period_of(truncate_column(F.col("ts"), "hour"), DAY)
    by_month = period_of(truncate_column(F.col("ts"), "month"), WEEK)
    return events.groupBy(by_day.alias("day_period"), by_month.alias("month_period")).agg(
        F.count(F.lit(1)).alias("events")
    )


def micro_batch_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one micro-batch by event time twice, and read all periods back with their folders."""
    root = scratch_path(spark, "micro-batch-store")
    table = event_cube("hour", "cube")
    rows = load(spark, sf_dir, "events").transform(rollup(table))
    for _ in range(2):
        write_micro_batch(rows, table, root, DAY, LATER, "ts")
    return shown(parse_lines(read_lines(spark, f"{root}/cube", f"{root}/cube"), table), 4)


def micro_batch_store_by_batch_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "micro-batch-store")
    table = event_cube("hour", "cube")
    write_micro_batch(load(spark, sf_dir, "events").transform(rollup(table)), table, root, WEEK, LATER + 5)
    return shown(parse_lines(read_lines(spark, f"{root}/cube", f"{root}/cube"), table), 4)


def _micro_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream with one micro-batch per user and hour would have told: ids and paths of days."""
    events = load(spark, sf_dir, "events").select(
        (F.unix_millis(F.date_trunc("hour", "ts")) + F.col("user_id")).alias("id"),
        F.concat(F.lit("events_"), F.col("event_type")).alias("table"),
        F.concat(F.lit("store/realtime/t/dt="), period_of(F.col("ts"), DAY), F.lit("/mb=1")).alias("path"),
    )
    per_table = events.groupBy("id", "table").agg(F.collect_set("path").alias("paths"), F.count("*").alias("n"))
    info = F.struct("paths", F.array().cast("array<string>").alias("columns"), F.col("n").alias("recordCount"))
    return per_table.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("table", info))).alias("tables")
    )


LAST_DONE, CURRENT = 1_704_326_400_000, 1_706_400_000_000  # 2024-01-04, 2024-01-28


def period_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = period_entries(_micro_manifests(spark, sf_dir))
    due = open_periods(entries, LAST_DONE, CURRENT)
    return due.select(
        "period",
        F.size("micro_batches").alias("micro_batches"),
        F.element_at("micro_batches", 1).alias("first_batch"),
        F.element_at("micro_batches", -1).alias("last_batch"),
        F.array_join("tables", ",").alias("tables"),
    )


def late_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came late if every period took in its micro-batches of even number."""
    entries = period_entries(_micro_manifests(spark, sf_dir))
    taken = entries.where(F.col("micro_batch") % 2 == 0).groupBy(F.col("period").alias("id"))
    taken = taken.agg(F.collect_set("micro_batch").alias("microBatches"))
    late = late_entries(entries, LAST_DONE, published_entries(taken))
    return late.groupBy("period", "table").agg(F.count(F.lit(1)).alias("paths"))


def tell(
    spark: SparkSession, job: IndexerSpec, table: TableSpec, events: DataFrame, batch_millis: int, period_millis: int
) -> None:
    """Store events as one micro-batch and send its manifest."""
    rows = events.transform(rollup(table))
    done = write_micro_batch(rows, table, job.realtime_root, period_millis, batch_millis, "ts")
    info = {"paths": list(done.paths), "columns": table.columns, "recordCount": done.rows}
    send_manifest(spark, job.real_time.channel, {"id": batch_millis, "tables": {table.name: info}})


def run_history(spark: SparkSession, sf_dir: str, name: str, table: TableSpec, **batch) -> tuple[IndexerSpec, list]:
    """Store all events as two micro-batches (mornings, afternoons), which meet in every period, and
    close all periods."""
    job = indexer(scratch_path(spark, name), period="P7D", **batch)
    events = load(spark, sf_dir, "events")
    morning = F.hour("ts") < 12
    for batch_millis, half in ((LATER, morning), (LATER + 1, ~morning)):
        tell(spark, job, table, events.where(half), batch_millis, WEEK)
    return job, BatchJob(spark, job, [table]).run(LATER)


def snapshot_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot of the chain: all history up to its period."""
    table = event_cube("hour", "cube")
    job, sent = run_history(spark, sf_dir, "snapshot-chain", table)
    rows = None
    for manifest in sent:
        snapshot = read_published(spark, table, manifest["tables"][table.name])
        per_type = snapshot.transform(finalise(table, by=["event_type"])).withColumn("period", F.lit(manifest["id"]))
        rows = per_type if rows is None else rows.unionByName(per_type)
    return shown(rows, 4)


def snapshot_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest snapshot of a partitioned, sorted table."""
    job, sent = run_history(
        spark,
        sf_dir,
        "snapshot-balanced",
        USER_CUBE,
        partitioning=Partitioning(("event_type",), 3),
        sort_columns=("user_id", "ts"),
    )
    return with_parts(spark, USER_CUBE, sent[-1])


def with_parts(spark: SparkSession, table: TableSpec, manifest: Mapping) -> DataFrame:
    """A partitioned snapshot with the part each row is in."""
    return shown(read_published(spark, table, manifest["tables"][table.name], parts=True), 4)


CLOSED = 1_705_536_000_000  # 2024-01-18, the begin of a week


def late_after_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches, a batch job, a late and a punctual micro-batch, two batch jobs: what the last
    snapshot holds, and how many paths each job found late (nothing new, nothing late)."""
    table = event_cube("hour", "cube")
    job = indexer(scratch_path(spark, "late-after-close"), period="P7D")
    events = load(spark, sf_dir, "events")
    old, turn = period_of(F.col("ts"), WEEK) < CLOSED, F.col("event_id") % 4
    tell(spark, job, table, events.where(old & (turn == 0)), LATER, WEEK)
    tell(spark, job, table, events.where(old & (turn == 1)), LATER + 1, WEEK)
    batch = BatchJob(spark, job, [table])
    first = batch.run(LATER)
    late = [batch.late_paths]
    tell(spark, job, table, events.where(old & (turn > 1)), LATER + 2, WEEK)
    tell(spark, job, table, events.where(~old), LATER + 3, WEEK)
    second = batch.run(LATER)
    late.append(batch.late_paths)
    third = batch.run(LATER)
    late.append(batch.late_paths)
    rows = read_published(spark, table, second[-1]["tables"]["cube"]).transform(finalise(table, by=["event_type"]))
    told = {"late_first": late[0], "late_second": late[1], "late_third": late[2]}
    told |= {"sent_first": len(first), "sent_second": len(second), "sent_third": len(third)}
    return shown(rows, 4).withColumns({n: F.lit(v).cast("bigint") for n, v in told.items()})


def kafka_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets after each of four batches, of which every one leaves some partitions idle."""
    events = load(spark, sf_dir, "events").withColumn("p", F.col("user_id") % 3)
    rows = events.withColumn("batch", F.col("p") + F.col("event_id") % 2)
    order = Window.partitionBy("event_type", "p").orderBy("batch", "event_id")
    rows = rows.select(
        "batch",
        F.col("event_type").alias(kafka.TOPIC),
        F.col("p").cast("int").alias(kafka.PARTITION),
        (F.row_number().over(order) - 1).cast("bigint").alias(kafka.OFFSET),
    )
    told, out = [], []
    for batch in range(4):
        told = kafka.carried(told, kafka.end_offsets(rows.where(F.col("batch") == batch)))
        out += [(batch, o["topic"], o["partition"], o["offset"]) for o in told]
    return spark.createDataFrame(out, "batch bigint, topic string, part int, next bigint")


def snapshot_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A granularity coarser than the period: all rows meet in the period of the first of the month."""
    table = event_cube("month", "cube")
    job, sent = run_history(spark, sf_dir, "snapshot-monthly", table)
    rows = read_published(spark, table, sent[-1]["tables"]["cube"])
    return shown(rows.withColumn("period", F.lit(sent[-1]["id"])), 4)


def snapshot_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only events inside the interval to keep stay in history."""
    table = event_cube("hour", "cube")
    job, sent = run_history(spark, sf_dir, "snapshot-kept", table, keep="2024-01-06T12:00:00/P10D")
    return shown(read_published(spark, table, sent[-1]["tables"]["cube"]), 4)


def snapshot_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batch job tells about every period."""
    table = event_cube("hour", "cube")
    job, _ = run_history(
        spark, sf_dir, "snapshot-manifests", table, partitioning=Partitioning(("event_type",), 2)
    )
    told = all_manifests(spark, job.batch.channel, BATCH_SCHEMA)
    return told.select("id", "microBatches", F.col("tables")["cube"].alias("info")).select(
        F.col("id").alias("period"),
        F.size("microBatches").alias("micro_batches"),
        F.col("info.recordCount").alias("record_count"),
        F.aggregate("info.bucketRows", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("bucket_rows"),
        F.size("info.partitioning").alias("buckets"),
        F.array_join("info.columns", ",").alias("columns"),
    )


CUSTOMERS = TableSpec(
    "customers",
    (Dimension("nation", field="c_nationkey", type="int"), Dimension("segment", field="c_mktsegment")),
    (Metric("balance", "double_sum", field="c_acctbal"), Metric("customers", "count")),
)
SIZES = TableSpec("sizes", (Dimension("p_size", type="int"), Dimension("p_brand")), (Metric("parts", "count"),))
PARTS = 5
ROWS_PER_FILE = BatchSpec().rows_per_file


def balance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket and part of every rolled-up part size, packed by row counts."""
    by_size = Partitioning(("p_size",), PARTS)
    rolled = load(spark, sf_dir, "part").transform(rollup(SIZES))
    bucketed = rolled.withColumn(BUCKET, bucket_column(SIZES, by_size))
    layout = Layout.plan(bucket_weights(bucketed), PARTS, ROWS_PER_FILE)
    bucket = F.col(BUCKET)
    placed = place(bucketed.withColumn("bucket", bucket), SIZES, layout, ("p_brand",))
    return placed.groupBy("bucket", PART).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("parts").alias("parts"), F.min("p_size").alias("first_size")
    )


def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksum bucket of every customer name."""
    table = TableSpec("names", (Dimension("c_name"), Dimension("c_nationkey", type="int")), ())
    keys = Partitioning(("c_name", "c_nationkey"), 7)
    return load(spark, sf_dir, "customer").select("c_custkey", bucket_column(table, keys).alias("bucket"))


def sorted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written parts, read back: the rows of every part and key, and how many stand out of order in
    their file."""
    root = scratch_path(spark, "sorted-parts")
    by_status = Partitioning(("linestatus", "returnflag"), 4)
    rolled = load(spark, sf_dir, "lineitem").transform(rollup(LINE_CUBE))
    bucketed = rolled.withColumn(BUCKET, bucket_column(LINE_CUBE, by_status))
    layout = Layout.plan(bucket_weights(bucketed), 4, ROWS_PER_FILE)
    placed = place(bucketed, LINE_CUBE, layout, ("shipdate", "returnflag"))
    write_snapshot(placed, LINE_CUBE, root, DAY)
    base = f"{root}/{LINE_CUBE.name}/dt={DAY}"
    lines = read_lines(spark, base, base).select(
        "value", "part", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    rows = parse_lines(lines, LINE_CUBE).withColumn("key", F.struct("shipdate", "returnflag"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("line"))
    wrong = F.when(F.col("key") < F.col("before"), 1).otherwise(0)
    return (
        rows.withColumn("before", before)
        .groupBy("linestatus", "returnflag", "part")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("lines").alias("lines"),
            F.sum(wrong).cast("bigint").alias("out_of_order"),
        )
    )


def event_stream(
    spark: SparkSession, sf_dir: str, name: str, tables: list[TableSpec], kind=StreamJob, change=lambda job: job, **batch
):
    """All events as text files through the streaming job."""
    root = scratch_path(spark, name)
    events = load(spark, sf_dir, "events")
    raw = delimited(events, EVENT_COLUMNS, "\t", ts=F.unix_micros("ts").cast("string"))
    raw.write.text(f"{root}/raw")
    job = change(indexer(root, **batch))
    records = spark.readStream.option("maxBytesPerTrigger", 256 * 1024**3).text(f"{root}/raw")
    query = kind(spark, job, tables).start(f"{root}/checkpoint", records, available_now=True)
    query.awaitTermination()
    return job


def _stored(spark: SparkSession, job: IndexerSpec, table: TableSpec) -> DataFrame:
    base = f"{job.realtime_root}/{table.name}"
    return parse_lines(read_lines(spark, base, base).select("value"), table).transform(rerollup(table))


def stream_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream in five micro-batches: good records, only bad ones, an empty file, good ones twice.
    Only those with good records are told of."""
    root, table = scratch_path(spark, "steps"), event_cube("hour", "cube")
    job = indexer(root)
    job = replace(job, real_time=replace(job.real_time, parse=replace(job.real_time.parse, skip_bad_rows=True)))
    events = load(spark, sf_dir, "events")
    good = [
        delimited(events.where(F.col("event_id") % 3 == k), EVENT_COLUMNS, "\t", ts=F.unix_micros("ts").cast("string"))
        for k in range(3)
    ]
    bad = delimited(events, EVENT_COLUMNS, "\t", ts=F.lit("never"))
    for step in (good[0], bad, bad.limit(0).coalesce(1), good[1], good[2]):
        step.write.mode("append").text(f"{root}/raw")
        records = spark.readStream.text(f"{root}/raw")
        StreamJob(spark, job, [table]).start(f"{root}/checkpoint", records, available_now=True).awaitTermination()
    told = all_manifests(spark, job.real_time.channel, MICRO_BATCH_SCHEMA).count()
    return shown(_stored(spark, job, table), 4).withColumn("manifests", F.lit(told).cast("bigint"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with bad records: what it stored, and what it put aside, for which reasons."""
    root, table = scratch_path(spark, "quarantine"), event_cube("hour", "cube")
    job = indexer(root)
    job = replace(job, real_time=replace(job.real_time, quarantine=True))
    events = load(spark, sf_dir, "events")
    late = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.unix_micros("ts").cast("string"))
    value = F.when(F.col("event_id") % 5 == 0, "much").otherwise(F.col("value").cast("string"))
    raw = delimited(events, EVENT_COLUMNS, "\t", ts=late, value=value)
    raw.write.text(f"{root}/raw")
    records = spark.readStream.text(f"{root}/raw")
    StreamJob(spark, job, [table]).start(f"{root}/checkpoint", records, available_now=True).awaitTermination()
    stored = _stored(spark, job, table).groupBy("event_type").agg(F.sum("events").alias("records"))
    stored = stored.select("event_type", F.lit("stored").alias("why"), "records")
    aside = spark.read.schema("value string, reasons array<struct<field: string, rule: string>>").json(job.quarantine_root)
    why = F.array_join(F.transform("reasons", lambda r: F.concat(r["field"], F.lit(": "), r["rule"])), ", ")
    aside = aside.select(F.split("value", "\t")[3].alias("event_type"), why.alias("why"))
    return stored.unionByName(aside.groupBy("event_type", "why").agg(F.count(F.lit(1)).alias("records")))


def doubled(table: TableSpec):
    """A real-time processor for settings to name."""
    return chain(lambda df: df.withColumn("value", F.col("value") * 2), rollup(table))


def raised(table: TableSpec):
    """A batch processor for settings to name."""
    return chain(rerollup(table), lambda df: df.withColumn("value_max", F.col("value_max") + 1))


def processors_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs with the processors that the settings name."""
    table = event_cube("hour", "cube")

    def named(job: IndexerSpec) -> IndexerSpec:
        real_time = replace(job.real_time, processor="workloads.store:doubled")
        return replace(job, real_time=real_time, batch=replace(job.batch, processor="workloads.store:raised"))

    # One period for all, so that the batch processor sees every row once.
    job = event_stream(spark, sf_dir, "named", [table], change=named, period="P9000D")
    (sent,) = BatchJob(spark, job, [table]).run(27_000 * DAY)
    return shown(read_published(spark, table, sent["tables"]["cube"]), 4)


class Mirrored(StreamJob):
    """Steps of one's own: events count for the day before, and every table is stored twice."""

    def process(self, table: TableSpec, records: DataFrame) -> DataFrame:
        return super().process(table, records.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY")))

    def save(self, table: TableSpec, rows: DataFrame, batch_millis: int) -> Written:
        super().save(replace(table, name=f"{table.name}_mirror"), rows, batch_millis)
        return super().save(table, rows, batch_millis)


def overridden_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = event_cube("hour", "cube")
    job = event_stream(spark, sf_dir, "mirrored", [table], kind=Mirrored)
    mirror = _stored(spark, job, replace(table, name="cube_mirror"))
    both = _stored(spark, job, table).withColumn("copy", F.lit(1)).unionByName(mirror.withColumn("copy", F.lit(2)))
    return shown(both, 4)


def table_layout_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's own partitioning and order against the indexer's, seen in the written parts."""
    own = replace(USER_CUBE, partitioning=Partitioning(("user_id",), 4), sort_columns=("ts",))
    job, sent = run_history(
        spark, sf_dir, "own-layout", own, partitioning=Partitioning(("event_type",), 2), sort_columns=("user_id",)
    )
    return with_parts(spark, own, sent[-1])


def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = event_cube("hour", "cube")
    job = event_stream(spark, sf_dir, "stream", [table])
    return shown(_stored(spark, job, table), 4)


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parse feeds two tables of different shape."""
    daily = TableSpec("daily", (Dimension("ts", type="time", granularity="day"),), VALUE_METRICS)
    kinds = TableSpec("kinds", (Dimension("event_type"), Dimension("ts", type="time", granularity="month")), VALUE_METRICS)
    job = event_stream(spark, sf_dir, "fan-out", [daily, kinds])
    left = _stored(spark, job, daily).withColumn("event_type", F.lit("*"))
    return shown(left.unionByName(_stored(spark, job, kinds)), 4)


LATTICE = (
    TableSpec(
        "fine",
        (Dimension("user_id", type="long"), Dimension("event_type"), Dimension("ts", type="time", granularity="minute")),
        VALUE_METRICS,
    ),
    TableSpec("hours", (Dimension("event_type"), Dimension("ts", type="time", granularity="hour")), VALUE_METRICS),
    TableSpec("months", (Dimension("event_type"), Dimension("ts", type="time", granularity="month")), VALUE_METRICS),
)


def cube_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nested tables: the finest is rolled up from records, the others each from the one before."""
    kept = {t.name: scratch_path(spark, f"lattice-{t.name}") for t in LATTICE}
    made = rollup_family(LATTICE, load(spark, sf_dir, "events"), lambda name, rows: stage(rows, kept[name]))
    out = None
    for table in LATTICE:
        rows = made[table.name].withColumn("cube", F.lit(table.name)).withColumn("ts", F.col("ts").cast("timestamp"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return shown(out, 4)


def stream_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables through the streaming job and its store."""
    job = event_stream(spark, sf_dir, "lattice", list(LATTICE))
    out = None
    for table in LATTICE:
        rows = _stored(spark, job, table).withColumn("cube", F.lit(table.name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return shown(out, 4)


def stream_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs in a row: text files to the newest balanced snapshot."""
    job = event_stream(
        spark, sf_dir, "both", [USER_CUBE], period="P7D", partitioning=Partitioning(("user_id",), 4)
    )
    sent = BatchJob(spark, job, [USER_CUBE]).run(LATER)
    return with_parts(spark, USER_CUBE, sent[-1])


def manifest_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifests of two micro-batches say, and which of them is the last."""
    table, job = event_cube("hour", "cube"), indexer(scratch_path(spark, "manifests"))
    events = load(spark, sf_dir, "events")
    # Ids of different length: the last is that by number.
    for batch, own in ((999, F.hour("ts") < 12), (1000, F.hour("ts") >= 12)):
        tell(spark, job, table, events.where(own), batch, DAY)
    told = all_manifests(spark, job.real_time.channel, MICRO_BATCH_SCHEMA)
    info = F.col("tables")["cube"]
    per_batch = told.select(
        F.col("id").alias("micro_batch"),
        info["recordCount"].alias("record_count"),
        F.array_join(info["columns"], ",").alias("columns"),
        (F.col("id") == last_manifest(told)["id"]).alias("is_last"),
    )
    return period_entries(told).select("period", "table", "micro_batch").join(per_batch, "micro_batch")


# crc32 of a text, bit by bit.
def _crc32(text: str) -> str:
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: unicode({text}[i])::BIGINT)"
    one_byte = (
        "list_reduce(list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    )
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, code: {one_byte}), 4294967295::BIGINT)"
    )


_BALANCE_SQL = f"""
WITH RECURSIVE rolled AS (SELECT p_size, p_brand, count(*) AS parts FROM part GROUP BY 1, 2),
sizes AS (SELECT DISTINCT p_size, CAST(p_size AS VARCHAR) AS t FROM rolled),
keyed AS (SELECT p_size, CAST({_crc32('t')} % {PARTS} AS INTEGER) AS bucket FROM sizes),
weights AS (SELECT bucket, count(*) AS weight, CAST(sum(parts) AS BIGINT) AS parts, min(p_size) AS first_size
            FROM rolled JOIN keyed USING (p_size) GROUP BY 1),
queue AS (SELECT *, row_number() OVER (ORDER BY weight DESC, bucket) AS turn,
                 CAST(sum(weight) OVER () AS BIGINT) // {PARTS} AS most FROM weights),
packed(turn, bucket, bin, totals) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), [0, 0, 0, 0, 0]::BIGINT[]
  UNION ALL
  SELECT turn, bucket, bin,
         list_transform(range(1, {PARTS} + 1), lambda j: totals[j] + CASE WHEN j = bin THEN weight ELSE 0 END)
  FROM (SELECT q.turn, q.bucket, q.weight, p.totals,
               CAST(coalesce(list_filter(range(1, {PARTS} + 1), lambda j: p.totals[j] + q.weight <= q.most)[1],
                             list_position(p.totals, list_min(p.totals))) AS BIGINT) AS bin
        FROM packed p JOIN queue q ON q.turn = p.turn + 1)
)
SELECT w.bucket, CAST(p.bin - 1 AS INTEGER) AS part, w.weight AS rows, w.parts, w.first_size
FROM weights w JOIN packed p ON p.bucket = w.bucket"""

_CUBE = """round(sum(value), 4) AS value_sum, round(min(value), 4) AS value_min,
           round(max(value), 4) AS value_max, round(sum(value), 4) AS value_avg, count(*) AS events"""
_DAY_PERIOD = f"epoch_us(ts) // 1000 // {DAY} * {DAY}"
_WEEK_PERIOD = f"epoch_us(ts) // 1000 // {WEEK} * {WEEK}"
_MICRO_SQL = f"""
    SELECT epoch_us(date_trunc('hour', ts)) // 1000 + user_id AS id, 'events_' || event_type AS t,
           {_DAY_PERIOD} AS period FROM events"""

_LATTICE_SQL = f"""
    SELECT user_id, event_type, date_trunc('minute', ts) AS ts, {_CUBE}, 'fine' AS cube FROM events GROUP BY 1, 2, 3
    UNION ALL
    SELECT NULL, event_type, date_trunc('hour', ts) AS ts, {_CUBE}, 'hours' FROM events GROUP BY 2, 3
    UNION ALL
    SELECT NULL, event_type, CAST(date_trunc('month', ts) AS TIMESTAMP) AS ts, {_CUBE}, 'months'
    FROM events GROUP BY 2, 3"""

_USER_SQL = f"SELECT user_id, event_type, date_trunc('hour', ts) AS ts, {_CUBE} FROM events GROUP BY 1, 2, 3"


def _with_parts_sql(rolled: str, key: str, parts: int, columns: str = "* EXCLUDE (bucket)", rest: str = "") -> str:
    """Rolled-up rows with the part that the checksum of their key is packed into, heaviest bucket first."""
    zeros = "[" + ", ".join(["0"] * parts) + "]::BIGINT[]"
    return f"""
WITH RECURSIVE rolled AS ({rolled}),
keys AS (SELECT DISTINCT {key} AS t FROM rolled),
keyed AS (SELECT t, CAST({_crc32('t')} % {parts} AS INTEGER) AS bucket FROM keys),
bucketed AS (SELECT rolled.*, bucket FROM rolled JOIN keyed ON t = {key}),
weights AS (SELECT bucket, count(*) AS weight FROM bucketed GROUP BY 1),
queue AS (SELECT *, row_number() OVER (ORDER BY weight DESC, bucket) AS turn,
                 CAST(sum(weight) OVER () AS BIGINT) // {parts} AS most FROM weights),
packed(turn, bucket, bin, totals) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), {zeros}
  UNION ALL
  SELECT turn, bucket, bin,
         list_transform(range(1, {parts} + 1), lambda j: totals[j] + CASE WHEN j = bin THEN weight ELSE 0 END)
  FROM (SELECT q.turn, q.bucket, q.weight, p.totals,
               CAST(coalesce(list_filter(range(1, {parts} + 1), lambda j: p.totals[j] + q.weight <= q.most)[1],
                             list_position(p.totals, list_min(p.totals))) AS BIGINT) AS bin
        FROM packed p JOIN queue q ON q.turn = p.turn + 1)
),
placed AS (SELECT b.*, CAST(p.bin - 1 AS INTEGER) AS part FROM bucketed b JOIN packed p ON p.bucket = b.bucket)
SELECT {columns} FROM placed {rest}"""


WORKLOADS = {
    "period_event_time": Workload(
        period_event_time,
        f"""SELECT {_DAY_PERIOD} AS day_period,
                   epoch_us(date_trunc('month', ts)) // 1000 // {WEEK} * {WEEK} AS month_period, count(*) AS events
            FROM events GROUP BY 1, 2""",
    ),
    "micro_batch_store": Workload(
        micro_batch_store,
        f"""SELECT event_type, date_trunc('hour', ts) AS ts, {_CUBE}, {_DAY_PERIOD} AS dt,
                   CAST({LATER} AS BIGINT) AS mb
            FROM events GROUP BY 1, 2, dt""",
    ),
    "micro_batch_store_by_batch_time": Workload(
        micro_batch_store_by_batch_time,
        f"""SELECT event_type, date_trunc('hour', ts) AS ts, {_CUBE},
                   CAST({LATER + 5} // {WEEK} * {WEEK} AS BIGINT) AS dt, CAST({LATER + 5} AS BIGINT) AS mb
            FROM events GROUP BY 1, 2""",
    ),
    "period_worklist": Workload(
        period_worklist,
        f"""SELECT period, CAST(count(DISTINCT id) AS INTEGER) AS micro_batches, min(id) AS first_batch,
                   max(id) AS last_batch, string_agg(DISTINCT t, ',' ORDER BY t) AS tables
            FROM ({_MICRO_SQL}) WHERE period > {LAST_DONE} AND period < {CURRENT} GROUP BY 1""",
    ),
    "late_paths": Workload(
        late_paths,
        f"""SELECT period, t AS "table", count(*) AS paths
            FROM (SELECT DISTINCT id, t, period FROM ({_MICRO_SQL})) WHERE period <= {LAST_DONE} AND id % 2 = 1 GROUP BY 1, 2""",
    ),
    "snapshot_chain": Workload(
        snapshot_chain,
        f"""SELECT p.period, event_type, round(sum(value), 4) AS value_sum, round(min(value), 4) AS value_min,
                   round(max(value), 4) AS value_max, round(sum(value) / count(*), 4) AS value_avg, count(*) AS events
            FROM (SELECT DISTINCT {_WEEK_PERIOD} AS period FROM events) p
            JOIN events e ON {_WEEK_PERIOD} <= p.period GROUP BY 1, 2""",
    ),
    "snapshot_balanced": Workload(snapshot_balanced, _with_parts_sql(_USER_SQL, "event_type", 3)),
    "late_after_close": Workload(
        late_after_close,
        f"""WITH e AS (SELECT *, {_WEEK_PERIOD} AS period, {_WEEK_PERIOD} < {CLOSED} AS old FROM events)
            SELECT event_type, round(sum(value), 4) AS value_sum, round(min(value), 4) AS value_min,
                   round(max(value), 4) AS value_max, round(sum(value) / count(*), 4) AS value_avg, count(*) AS events,
                   CAST(0 AS BIGINT) AS late_first, late AS late_second, CAST(0 AS BIGINT) AS late_third, sent AS sent_first,
                   fresh AS sent_second, CAST(0 AS BIGINT) AS sent_third
            FROM e, (SELECT count(DISTINCT period) FILTER (old AND event_id % 4 > 1) AS late,
                            count(DISTINCT period) FILTER (old AND event_id % 4 <= 1) AS sent,
                            count(DISTINCT period) FILTER (NOT old) AS fresh FROM e)
            WHERE NOT old OR event_id % 4 <= 1 GROUP BY event_type, late, sent, fresh""",
    ),
    "kafka_offsets": Workload(
        kafka_offsets,
        """WITH e AS (SELECT event_type AS topic, user_id % 3 AS p, user_id % 3 + event_id % 2 AS batch FROM events),
                b AS (SELECT unnest(range(4)) AS batch)
           SELECT b.batch, topic, CAST(p AS INTEGER) AS part, count(*) AS next
           FROM e JOIN b ON e.batch <= b.batch GROUP BY 1, 2, 3""",
    ),
    "snapshot_monthly": Workload(
        snapshot_monthly,
        f"""SELECT event_type, date_trunc('month', ts) AS ts, {_CUBE},
                   max(max(epoch_us(date_trunc('month', ts)) // 1000 // {WEEK} * {WEEK})) OVER () AS period
            FROM events GROUP BY 1, 2""",
    ),
    "snapshot_kept": Workload(
        snapshot_kept,
        f"""SELECT event_type, date_trunc('hour', ts) AS ts, {_CUBE} FROM events
            WHERE date_trunc('hour', ts) >= TIMESTAMP '2024-01-06 12:00:00'
              AND date_trunc('hour', ts) < TIMESTAMP '2024-01-16 12:00:00' GROUP BY 1, 2""",
    ),
    "snapshot_manifests": Workload(
        snapshot_manifests,
        f"""WITH cube AS (SELECT event_type, date_trunc('hour', ts) AS hour, min({_WEEK_PERIOD}) AS period
                          FROM events GROUP BY 1, 2),
                 halves AS (SELECT {_WEEK_PERIOD} AS period,
                                   count(DISTINCT hour(ts) < 12) AS n
                            FROM events GROUP BY 1)
            SELECT period, CAST(n AS INTEGER) AS micro_batches, total AS record_count, total AS bucket_rows,
                   CAST(2 AS INTEGER) AS buckets,
                   'event_type,ts,value_sum,value_min,value_max,value_avg,events' AS columns
            FROM (SELECT h.period, h.n, (SELECT count(*) FROM cube c WHERE c.period <= h.period) AS total
                  FROM halves h)""",
    ),
    "balance_rows": Workload(balance_rows, _BALANCE_SQL),
    "buckets": Workload(
        buckets,
        f"""SELECT c_custkey, CAST({_crc32('t')} % 7 AS INTEGER) AS bucket
            FROM (SELECT c_custkey, c_name || CAST(c_nationkey AS VARCHAR) AS t FROM customer)""",
    ),
    "sorted_parts": Workload(
        sorted_parts,
        _with_parts_sql(
            """SELECT l_linestatus AS linestatus, l_returnflag AS returnflag, date_trunc('day', l_shipdate) AS d,
                      count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
            "linestatus || returnflag",
            4,
            """linestatus, returnflag, part, count(*) AS rows, CAST(sum(n) AS BIGINT) AS lines,
               CAST(0 AS BIGINT) AS out_of_order""",
            "GROUP BY 1, 2, 3",
        ),
    ),
    "stream_equals_batch": Workload(
        stream_equals_batch,
        f"SELECT event_type, date_trunc('hour', ts) AS ts, {_CUBE} FROM events GROUP BY 1, 2",
    ),
    "fan_out": Workload(
        fan_out,
        f"""SELECT '*' AS event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, {_CUBE} FROM events GROUP BY 2
            UNION ALL
            SELECT event_type, CAST(date_trunc('month', ts) AS TIMESTAMP) AS ts, {_CUBE} FROM events GROUP BY 1, 2""",
    ),
    "cube_lattice": Workload(cube_lattice, _LATTICE_SQL),
    "stream_lattice": Workload(stream_lattice, _LATTICE_SQL),
    "stream_then_batch": Workload(stream_then_batch, _with_parts_sql(_USER_SQL, "CAST(user_id AS VARCHAR)", 4)),
    "table_layout_wins": Workload(table_layout_wins, _with_parts_sql(_USER_SQL, "CAST(user_id AS VARCHAR)", 4)),
    "stream_in_steps": Workload(
        stream_in_steps,
        f"""SELECT event_type, date_trunc('hour', ts) AS ts, {_CUBE}, CAST(3 AS BIGINT) AS manifests
            FROM events GROUP BY 1, 2""",
    ),
    "stream_quarantine": Workload(
        stream_quarantine,
        """SELECT event_type,
                  CASE WHEN event_id % 35 = 0 THEN 'ts: not timestamp, value: not double'
                       WHEN event_id % 7 = 0 THEN 'ts: not timestamp'
                       WHEN event_id % 5 = 0 THEN 'value: not double' ELSE 'stored' END AS why,
                  count(*) AS records
           FROM events GROUP BY 1, 2""",
    ),
    "processors_by_name": Workload(
        processors_by_name,
        """SELECT event_type, date_trunc('hour', ts) AS ts, round(sum(value * 2), 4) AS value_sum,
                  round(min(value * 2), 4) AS value_min, round(max(value * 2) + 1, 4) AS value_max,
                  round(sum(value * 2), 4) AS value_avg, count(*) AS events
           FROM events GROUP BY 1, 2""",
    ),
    "overridden_steps": Workload(
        overridden_steps,
        f"""SELECT event_type, date_trunc('hour', ts - INTERVAL 1 DAY) AS ts, {_CUBE}, copy
            FROM events, (SELECT unnest([1, 2])::INTEGER AS copy) GROUP BY 1, 2, copy""",
    ),
    "manifest_contents": Workload(
        manifest_contents,
        f"""WITH e AS (SELECT *, CASE WHEN hour(ts) < 12 THEN 999 ELSE 1000 END::BIGINT AS micro_batch FROM events),
                 n AS (SELECT micro_batch, count(DISTINCT (event_type, date_trunc('hour', ts))) AS record_count
                       FROM e GROUP BY 1)
            SELECT DISTINCT {_DAY_PERIOD} AS period, 'cube' AS "table", micro_batch, record_count,
                   'event_type,ts,value_sum,value_min,value_max,value_avg,events' AS columns,
                   micro_batch = 1000 AS is_last
            FROM e JOIN n USING (micro_batch)""",
    ),
}
