"""Snapshots: the short way must give what the plain way gives, and be taken only when proved."""

import glob
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollmill import files
from rollmill.operators import rollup as rollup_module
from rollmill.plans import snapshot as snapshot_module
from rollmill.plans.batch import BatchJob
from rollmill.plans.snapshot import History, keys_are_new, stray
from rollmill.sinks.manifests import send_manifest
from rollmill.sinks.store import write_micro_batch
from rollmill.sources.manifests import (
    BATCH_SCHEMA,
    MICRO_BATCH_SCHEMA,
    all_manifests,
    fold_manifests,
    last_id,
    last_manifest,
)
from rollmill.spec import Channel, Dimension, Metric, TableSpec
from tests import stock

DAY = 86_400_000
FIRST = stock.PERIODS[0]
TABLE = TableSpec(
    "t",
    (Dimension("company"), Dimension("timestamp", type="time", granularity="hour")),
    (Metric("s", "long_sum"), Metric("hi", "int_max"), Metric("n", "count")),
)


def raw_days(spark, days, rows=400):
    """Rows spread over some days; a third of them have one company."""
    return spark.range(0, rows * days, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 17)).alias("company"),
        F.timestamp_millis(F.lit(FIRST) + (F.col("id") * 7919 % (days * 24)) * 3_600_000).alias("timestamp"),
        (F.col("id") % 101).alias("s"),
        (F.col("id") % 103).cast("int").alias("hi"),
    )


def feed(spark, indexer, table, df, batch_millis):
    rows = df.transform(rollup_module.rollup(table))
    column = indexer.real_time.parse.time_column
    done = write_micro_batch(rows, table, indexer.realtime_root, DAY, batch_millis, column)
    info = {"paths": list(done.paths), "columns": table.columns, "recordCount": done.rows}
    send_manifest(spark, indexer.real_time.channel, {"id": batch_millis, "tables": {table.name: info}})


def count_plain(monkeypatch):
    """How many times a snapshot asked for the proof, and what it got."""
    answers = []

    def watched(*args):
        answers.append(keys_are_new(*args))
        return answers[-1]

    monkeypatch.setattr(snapshot_module, "keys_are_new", watched)
    return answers


@pytest.mark.parametrize("partitions", [4, None])
def test_short_way_equals_plain_way(spark, tmp_path, monkeypatch, partitions):
    table = replace(TABLE, sort_columns=("timestamp", "company"))
    results, manifests = {}, {}
    for way in ("short", "plain"):
        indexer = stock.indexer(tmp_path / way, partitions, rows_per_file=60)
        feed(spark, indexer, table, raw_days(spark, 3), FIRST + 5 * DAY)
        feed(spark, indexer, table, raw_days(spark, 3, rows=90), FIRST + 5 * DAY + 1)
        with monkeypatch.context() as patched:
            if way == "plain":
                patched.setattr(snapshot_module, "provable", lambda *args: None)
            answers = count_plain(patched)
            sent = BatchJob(spark, indexer, [table]).run(FIRST + 9 * DAY)
        assert answers == ([True, True] if way == "short" else [])
        assert len(sent) == 3
        results[way] = [
            stock.store_lines(spark, f"{indexer.batch_root}/t/dt={m['id']}") for m in sent
        ]
        manifests[way] = [
            {k: m["tables"]["t"].get(k) for k in ("partitioning", "bucketRows", "recordCount")} for m in sent
        ]
        scratch = f"{spark.conf.get('spark.checkpoint.dir')}/rollmill"
        assert not files.exists(spark, scratch) or not [
            p for p in __import__("os").listdir(scratch) if p.startswith("t-")
        ]
    assert results["short"] == results["plain"]
    assert manifests["short"] == manifests["plain"]
    assert len(results["plain"][2]) > len(results["plain"][0]) > 0


def test_history_is_shuffled_once_or_never(spark, tmp_path):
    """The short way adds no aggregate over the history."""
    plans = []

    def watch(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    write = snapshot_module.write_snapshot
    for partitions in (3, None):
        indexer = stock.indexer(tmp_path / str(partitions), partitions)
        feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
        snapshot_module.write_snapshot = watch
        try:
            BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
        finally:
            snapshot_module.write_snapshot = write
        assert "HashAggregate" not in plans[-1]
        assert plans[-1].count("Exchange") == (1 if partitions else 0)


def test_manifest_without_proof_takes_the_plain_way(spark, tmp_path, monkeypatch):
    """Snapshots of unknown making may hold anything: same keys must still meet."""
    indexer = stock.indexer(tmp_path, None)
    feed(spark, indexer, TABLE, raw_days(spark, 1), FIRST + 5 * DAY)
    (sent,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    assert sent["tables"]["t"]["maxTime"] < FIRST + DAY
    # the same rows again, under the next period, by batch time: keys of the history come again
    again = replace(indexer, real_time=replace(indexer.real_time, parse=replace(indexer.real_time.parse, time_column=None)))
    feed(spark, again, TABLE, raw_days(spark, 1), FIRST + DAY)
    answers = count_plain(monkeypatch)
    (second,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + 3 * DAY)
    assert answers == [False]
    assert second["tables"]["t"]["recordCount"] == sent["tables"]["t"]["recordCount"]
    lines = [l.split("\t") for l in stock.store_lines(spark, f"{indexer.batch_root}/t/dt={FIRST + DAY}")]
    assert sum(int(l[-1]) for l in lines) == 800


def test_proof(spark):
    rows = spark.createDataFrame([(5,), (7,)], "ms BIGINT").select(F.timestamp_millis("ms").alias("t"))
    nulls = rows.union(spark.sql("SELECT CAST(null AS TIMESTAMP)"))

    def new(history, new_rows, period):
        return keys_are_new(history, new_rows.where(stray("t", period)).count(), period)

    assert new(History(rows, {"maxTime": 4}), rows, 5)
    assert not new(History(rows, {"maxTime": 5}), rows, 5)
    assert not new(History(rows, {"maxTime": 4}), rows, 6)
    assert not new(History(rows, {"maxTime": 4}), nulls, 5)
    assert not new(History(rows, {"maxTime": None}), rows, 5)
    assert not new(History(rows), rows, 5)


def test_own_batch_processor(spark, tmp_path):
    """A processor of one's own sees history and new rows together."""
    indexer = stock.indexer(tmp_path, 2)
    feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
    standard = rollup_module.rerollup(TABLE)
    only_hot = {"t": lambda df: standard(df.where("company = 'hot'"))}
    sent = BatchJob(spark, indexer, [TABLE], processors=only_hot).run(FIRST + 9 * DAY)
    assert sent[-1]["tables"]["t"].get("maxTime") is None
    lines = stock.store_lines(spark, f"{indexer.batch_root}/t/dt={FIRST + DAY}")
    assert {l.split("\t")[0] for l in lines} == {"hot"}


def test_running_a_period_again_changes_nothing(spark, tmp_path):
    indexer = stock.indexer(tmp_path, 3)
    feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
    job = BatchJob(spark, indexer, [TABLE])
    first = job.run(FIRST + 9 * DAY)
    path = f"{indexer.batch_root}/t/dt={FIRST + DAY}"
    lines = stock.store_lines(spark, path)
    files.delete(spark, f"{tmp_path}/b/{FIRST + DAY}.msg")  # as if lost before the manifest was sent
    second = job.run(FIRST + 9 * DAY)
    assert second == first[1:]
    assert stock.store_lines(spark, path) == lines


def test_legacy_manifest_and_unknown_table(spark, tmp_path):
    """A manifest with relative paths and neither columns nor offsets is read."""
    table, indexer = stock.table(), stock.indexer(tmp_path)
    folder = tmp_path / "rt"
    folder.mkdir()
    doc = {
        "id": 1511871925000,
        "tables": {
            "foo": {"paths": [f"realtime/foo/dt={p}/mb=1511871925000" for p in stock.PERIODS], "recordCount": 6}
        },
    }
    (folder / "1511871925000.msg").write_text(json.dumps(doc, indent=2))
    for period in stock.PERIODS:
        day = f"2016-05-{10 + stock.PERIODS.index(period)}"
        lines = [l for l in stock.GOLDEN if f"\t{day}\t" in l]
        target = f"{indexer.realtime_root}/foo/dt={period}/mb=1511871925000"
        spark.createDataFrame([(l,) for l in lines], "value STRING").coalesce(1).write.option(
            "compression", "gzip"
        ).text(target)
    with pytest.raises(ValueError, match="foo"):
        BatchJob(spark, indexer, [TABLE]).run()
    sent = BatchJob(spark, indexer, [table]).run()
    assert [m["id"] for m in sent] == stock.PERIODS
    newest = f"{indexer.batch_root}/foo/dt={stock.PERIODS[-1]}"
    assert stock.store_lines(spark, newest) == stock.GOLDEN


def test_manifest_order(spark, tmp_path):
    channel = Channel("file", str(tmp_path), "q")
    assert all_manifests(spark, channel, BATCH_SCHEMA).collect() == []
    assert last_manifest(all_manifests(spark, channel, BATCH_SCHEMA)) is None
    for number in (9, 10, 2):
        send_manifest(spark, channel, {"id": number, "tables": {}, "microBatches": [number]})
    send_manifest(spark, channel, {"id": 2, "tables": {}, "microBatches": [7]})
    found = all_manifests(spark, channel, BATCH_SCHEMA)
    assert sorted(tuple(r) for r in found.select("id", "microBatches").collect()) == [(2, [7]), (9, [9]), (10, [10])]
    assert last_manifest(found)["id"] == 10
    for wrong in (Channel(), Channel("post", "x", "y")):
        with pytest.raises(ValueError, match="unsupported"):
            send_manifest(spark, wrong, {"id": 1})
        with pytest.raises(ValueError, match="unsupported"):
            all_manifests(spark, wrong, BATCH_SCHEMA)


def test_published_messages_are_folded(spark, tmp_path):
    """Files of published micro-batches become one table, read by partition; nothing is told twice."""
    indexer = stock.indexer(tmp_path, None)
    channel = indexer.real_time.channel
    for batch in range(4):
        feed(spark, indexer, TABLE, raw_days(spark, 2, rows=50), FIRST + 5 * DAY + batch)
    everything = sorted(r["id"] for r in all_manifests(spark, channel, MICRO_BATCH_SCHEMA).collect())
    sent = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    left = [p for p in glob.glob(f"{tmp_path}/rt/*.msg")]
    assert len(left) == 1 and last_id(spark, channel) == FIRST + 5 * DAY + 3
    again = all_manifests(spark, channel, MICRO_BATCH_SCHEMA)
    assert sorted(r["id"] for r in again.collect()) == everything
    late = all_manifests(spark, channel, MICRO_BATCH_SCHEMA, after=sent[-1]["id"])
    assert "PartitionFilters: [isnotnull(newest" in late._jdf.queryExecution().executedPlan().toString()
    assert [r["id"] for r in late.collect()] == [FIRST + 5 * DAY + 3]
    # an interrupted fold leaves a message in both places
    with open(f"{tmp_path}/rt/{FIRST + 5 * DAY}.msg", "w") as out:
        out.write(json.dumps({"id": FIRST + 5 * DAY, "tables": {}}))
    assert sorted(r["id"] for r in all_manifests(spark, channel, MICRO_BATCH_SCHEMA).collect()) == everything
    assert fold_manifests(spark, channel, MICRO_BATCH_SCHEMA, sent[-1]["id"]) == 1
    assert BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY) == []
