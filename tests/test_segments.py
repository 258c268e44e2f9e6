"""Snapshots as lists of segments: the same rows as whole snapshots, written once."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollmill import files
from rollmill.operators.rollup import rerollup, rollup
from rollmill.plans import batch as batch_module
from rollmill.plans import segments as segments_module
from rollmill.plans.batch import BatchJob
from rollmill.plans.segments import (
    Segment,
    close_periods,
    due_merges,
    entry_of,
    part_paths,
    segments_of,
    size_class,
    unused_folders,
)
from rollmill.sinks.store import write_micro_batch
from rollmill.sources.manifests import BATCH_SCHEMA, all_manifests, last_message
from rollmill.sources.store import PERIOD, read_published, read_segments
from rollmill.spec import BatchSpec, Dimension, Metric, Partitioning, TableSpec
from rollmill.streaming.job import StreamJob
from tests import stock
from tests.test_snapshot import DAY, FIRST, TABLE, feed, raw_days


def segment(rows, at=0, **kwargs):
    return Segment(f"s{at}", at * DAY, at * DAY, rows, at * DAY, at * DAY + 1, **kwargs)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_size_classes():
    assert [size_class(n, 4) for n in (0, 1, 3, 4, 15, 16, 64, 1000)] == [0, 0, 0, 1, 1, 2, 3, 4]


@pytest.mark.parametrize(
    "rows, runs",
    [
        ([], []),
        ([1, 1, 1], []),
        ([1, 1, 1, 1], [(0, 4)]),
        ([100, 1, 1, 1, 1], [(1, 5)]),
        ([1, 1, 100, 1, 1], []),
        ([20, 20, 2, 20, 1, 20, 3], [(0, 6)]),  # smaller ones between go along, one after them stays
        ([1, 1, 1, 1, 100, 1, 2, 3, 1, 2], [(0, 4), (5, 10)]),
    ],
)
def test_due_merges(rows, runs):
    assert due_merges([segment(n, i) for i, n in enumerate(rows)], 4) == runs


def rolled_days(spark, table, begin, count, rows=40):
    """Stored rows of some days with their period, as the job reads them."""
    df = raw_days(spark, count, rows).withColumn("timestamp", F.col("timestamp") + F.expr(f"INTERVAL {begin} DAYS"))
    df = df.transform(rollup(table))
    return df.withColumn(PERIOD, F.unix_millis("timestamp") - F.unix_millis("timestamp") % DAY)


def bytes_below(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".gz"))


@pytest.mark.parametrize("partitions", [None, 2])
def test_thirty_periods_write_their_own_rows(spark, tmp_path, partitions):
    indexer = stock.indexer(tmp_path, partitions, snapshots="segments", merge_after=4)
    entry, written, all_rows, root = None, [], None, f"{indexer.batch_root}/t"
    for day in range(30):
        rows = rolled_days(spark, TABLE, day, 1)
        before = bytes_below(root)
        (entry,) = close_periods(spark, TABLE, indexer, [FIRST + day * DAY], rows, entry, "timestamp").values()
        written.append(bytes_below(root) - before)
        own = f"{root}/dt={FIRST + day * DAY}"
        assert bytes_below(own) < 2 * bytes_below(f"{root}/dt={FIRST}")
        all_rows = rows if all_rows is None else all_rows.unionByName(rows)
    # most periods write a day; a row is written again at most once a size class
    small = 2 * written[0]
    assert sum(w <= small for w in written) >= 22
    assert sum(written) < 4 * 30 * written[0]
    assert len(entry["segments"]) <= 9 and entry["recordCount"] == sum(s["recordCount"] for s in entry["segments"])
    assert rows_of(read_published(spark, TABLE, entry)) == rows_of(all_rows.drop(PERIOD))
    if partitions:
        parts = read_published(spark, TABLE, entry, parts=True).groupBy("company").agg(F.collect_set("part").alias("p"))
        assert all(len(r["p"]) == 1 for r in parts.collect())
        for part in range(partitions):
            own = read_segments(spark, TABLE, part_paths(entry, part))
            want = read_published(spark, TABLE, entry, parts=True).where(F.col("part") == part).drop("part")
            assert rows_of(own) == rows_of(want)
    # what the last manifest does not name may go
    unused = unused_folders(spark, TABLE, indexer, [entry])
    assert len(unused) > 20
    for path in unused:
        files.delete(spark, path)
    assert rows_of(read_published(spark, TABLE, entry)) == rows_of(all_rows.drop(PERIOD))


@pytest.mark.parametrize("partitions", [3, None])
def test_backlog_in_one_pass_equals_the_chain(spark, tmp_path, monkeypatch, partitions):
    table = replace(TABLE, sort_columns=("timestamp", "company"))
    found, sent = {}, {}
    for way in ("segments", "whole"):
        indexer = stock.indexer(tmp_path / way, partitions, snapshots=way, rows_per_file=60)
        feed(spark, indexer, table, raw_days(spark, 5), FIRST + 6 * DAY)
        feed(spark, indexer, table, raw_days(spark, 5, rows=90), FIRST + 6 * DAY + 1)
        aggregates = []
        with monkeypatch.context() as patched:
            patched.setattr(
                segments_module, "rerollup", lambda t: lambda df: aggregates.append(1) or rerollup(t)(df)
            )
            sent[way] = BatchJob(spark, indexer, [table]).run(FIRST + 9 * DAY)
        assert len(aggregates) == (1 if way == "segments" else 0)
        found[way] = [rows_of(read_published(spark, table, m["tables"]["t"], parts=bool(partitions))) for m in sent[way]]
        if way == "segments":
            folders = os.listdir(f"{indexer.batch_root}/t")
            assert sorted(f for f in folders if f.startswith("dt=")) == [f"dt={FIRST + d * DAY}" for d in range(5)]
            for m in sent[way]:
                assert m["tables"]["t"]["paths"] == [
                    f"{indexer.batch_root}/t/dt={p}" for p in range(FIRST, m["id"] + DAY, DAY)
                ]
    assert found["segments"] == found["whole"]
    for key in ("recordCount", "minTime", "maxTime", "partitioning", "bucketRows", "partitionConf"):
        assert [m["tables"]["t"].get(key) for m in sent["segments"]] == [m["tables"]["t"].get(key) for m in sent["whole"]]
    # files are sorted and bounded
    some = f"{tmp_path}/segments/store/batch/t"
    lines = spark.read.option("recursiveFileLookup", True).text(some).select("value", "_metadata.file_path").collect()
    per_file = {}
    for r in lines:
        cells = r[0].split("\t")
        per_file.setdefault(r[1], []).append((cells[1], cells[0]))
    assert all(rows == sorted(rows) and len(rows) <= 60 for rows in per_file.values())


def test_next_run_adds_to_what_is_there(spark, tmp_path):
    indexer = stock.indexer(tmp_path, 2, snapshots="segments")
    rows = raw_days(spark, 4)
    feed(spark, indexer, TABLE, rows, FIRST + 6 * DAY)
    first = BatchJob(spark, indexer, [TABLE]).run(FIRST + 2 * DAY)
    second = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    assert [m["id"] for m in first + second] == [FIRST + d * DAY for d in range(4)]
    told = last_message(spark, indexer.batch.channel, BATCH_SCHEMA)["tables"]["t"]
    assert [s.path for s in segments_of(told)] == second[-1]["tables"]["t"]["paths"]
    assert rows_of(read_published(spark, TABLE, told)) == rows_of(rows.transform(rollup(TABLE)))
    # told again after its manifest was lost, a period is the same
    files.delete(spark, f"{tmp_path}/b/{FIRST + 3 * DAY}.msg")
    again = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    assert again == second[-1:]


def test_keys_that_come_again_make_one_segment(spark, tmp_path):
    indexer = stock.indexer(tmp_path, 2, snapshots="segments")
    feed(spark, indexer, TABLE, raw_days(spark, 1), FIRST + 5 * DAY)
    (sent,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    assert len(sent["tables"]["t"]["segments"]) == 1
    parse = replace(indexer.real_time.parse, time_column=None)
    again = replace(indexer, real_time=replace(indexer.real_time, parse=parse))
    feed(spark, again, TABLE, raw_days(spark, 1), FIRST + DAY)  # the same times, under the next period
    (second,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + 3 * DAY)
    entry = second["tables"]["t"]
    assert [s["path"] for s in entry["segments"]] == [f"{indexer.batch_root}/t/dt={FIRST + DAY}"]
    assert entry["recordCount"] == sent["tables"]["t"]["recordCount"]
    counts = read_published(spark, TABLE, entry).agg(F.sum("n")).first()[0]
    assert counts == 800


def test_tables_without_a_time_and_own_processors(spark, tmp_path):
    indexer = stock.indexer(tmp_path, 2, snapshots="segments")
    feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
    own = {"t": lambda df: rerollup(TABLE)(df.where("company = 'hot'"))}
    sent = BatchJob(spark, indexer, [TABLE], processors=own).run(FIRST + 9 * DAY)
    assert [len(m["tables"]["t"]["segments"]) for m in sent] == [1, 1]
    found = read_published(spark, TABLE, sent[-1]["tables"]["t"])
    assert {r["company"] for r in found.select("company").distinct().collect()} == {"hot"}


def test_other_layout_or_format_starts_anew(spark, tmp_path):
    indexer = stock.indexer(tmp_path, 2, snapshots="segments")
    rows = raw_days(spark, 4)
    feed(spark, indexer, TABLE, rows, FIRST + 6 * DAY)
    BatchJob(spark, indexer, [TABLE]).run(FIRST + DAY)
    changes = [{"partitioning": Partitioning(("company",), 3)}, {"snapshot_format": "parquet"}, {"snapshots": "whole"}]
    for day, change in enumerate(changes, 2):
        indexer = replace(indexer, batch=replace(indexer.batch, **change))
        (sent,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + day * DAY)
        assert len(sent["tables"]["t"]["paths"]) == 1
        want = rows.where(F.col("timestamp") < F.timestamp_millis(F.lit(FIRST + day * DAY))).transform(rollup(TABLE))
        assert rows_of(read_published(spark, TABLE, sent["tables"]["t"])) == rows_of(want)


def test_retention_reads_only_segments_across_its_ends(spark, tmp_path, monkeypatch):
    indexer = stock.indexer(tmp_path, 2, snapshots="segments")
    rows = raw_days(spark, 6)
    feed(spark, indexer, TABLE, rows, FIRST + 7 * DAY)
    job = BatchJob(spark, indexer, [TABLE])
    job.run(FIRST + 5 * DAY)
    # from the middle of the second day on
    keep = "2016-05-11T12:00:00/P9D"
    indexer = replace(indexer, batch=replace(indexer.batch, keep=keep))
    read = []
    monkeypatch.setattr(
        segments_module, "read_segments", lambda s, t, paths, f: read.extend(paths) or read_segments(s, t, paths, f)
    )
    (sent,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + 6 * DAY)
    root = f"{indexer.batch_root}/t"
    assert read == [f"{root}/dt={FIRST + DAY}"]
    entry = sent["tables"]["t"]
    assert entry["paths"][1:] == [f"{root}/dt={FIRST + d * DAY}" for d in (2, 3, 4, 5)]
    kept = rows.where("timestamp >= TIMESTAMP'2016-05-11 12:00:00'").transform(rollup(TABLE))
    assert rows_of(read_published(spark, TABLE, entry)) == rows_of(kept)
    assert entry["recordCount"] == kept.count()


def test_nothing_kept(spark, tmp_path):
    indexer = stock.indexer(tmp_path, 2, snapshots="segments", keep="2030-01-01/P1D")
    feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
    sent = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    assert [m["tables"]["t"]["recordCount"] for m in sent] == [0, 0]
    assert read_published(spark, TABLE, sent[-1]["tables"]["t"], parts=True).collect() == []


ALL_TYPES = TableSpec(
    "all",
    (
        Dimension("s"),
        Dimension("n", type="int"),
        Dimension("u", type="long"),
        Dimension("t", type="time", granularity="minute"),
    ),
    (
        Metric("a", "int_sum"),
        Metric("b", "double_avg"),
        Metric("c", "float_max"),
        Metric("d", "ulong_min"),
        Metric("ids", "bitset"),
    ),
    snapshot_format="parquet",
)


def test_parquet_round_trip_and_pruning(spark, tmp_path):
    table = replace(ALL_TYPES, sort_columns=("u",))
    indexer = stock.indexer(tmp_path, None, snapshots="segments", rows_per_file=500)
    raw = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("a\tb\n"), F.col("id") % 5)).alias("s"),
        (F.col("id") % 3).cast("int").alias("n"),
        F.col("id").alias("u"),
        F.timestamp_millis(F.lit(FIRST) + F.col("id") * 20_000).alias("t"),
        F.col("id").cast("int").alias("a"),
        (F.col("id") / 7).alias("b"),
        (F.col("id") / 3).cast("float").alias("c"),
        F.col("id").cast("decimal(20,0)").cast(ALL_TYPES.store_schema["d"].dataType).alias("d"),
        (F.col("id") % 11).cast(ALL_TYPES.store_schema["ids"].dataType).alias("ids"),
    )
    rolled = raw.transform(rollup(table))
    (entry,) = close_periods(
        spark, table, indexer, [FIRST], rolled.withColumn(PERIOD, F.lit(FIRST)), None, "t"
    ).values()
    assert entry["format"] == "parquet" and entry["recordCount"] == 4000
    found = read_published(spark, table, entry)
    assert found.schema.simpleString() == table.store_schema.simpleString()
    assert rows_of(found) == rows_of(rolled)  # times, tabs and line breaks too: nothing is printed
    few = found.where("u BETWEEN 100 AND 200")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(u), GreaterThanOrEqual(u,100), LessThanOrEqual(u,200)]" in plan
    # files are runs of the sort column, so a range of it lies in few of them
    spans = found.groupBy("_metadata.file_path").agg(F.min("u"), F.max("u"), F.count("*")).collect()
    assert all(r[3] <= 500 for r in spans)
    assert sum(r[1] <= 200 and r[2] >= 100 for r in spans) <= len(spans) // 2


@pytest.mark.parametrize("wrong", [{"snapshots": "none"}, {"snapshot_format": "csv"}, {"merge_after": 1}])
def test_settings_are_checked(wrong):
    with pytest.raises(ValueError):
        BatchSpec(**wrong)
    with pytest.raises(ValueError, match="snapshot format"):
        replace(TABLE, snapshot_format="csv")
    assert BatchSpec.from_dict({}).snapshots == "segments"
    assert BatchSpec.from_dict({"snapshots": "whole", "mergeAfter": 3, "snapshotFormat": "parquet"}) == BatchSpec(
        snapshots="whole", merge_after=3, snapshot_format="parquet"
    )


def test_message_that_arrives_while_a_run_publishes(spark, tmp_path, monkeypatch):
    """It is neither folded away unread nor forgotten: the next run counts it as late."""
    indexer = stock.indexer(tmp_path, None, snapshots="segments")
    feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
    job = BatchJob(spark, indexer, [TABLE])
    publish = job.publish

    def slow(*args):
        sent = publish(*args)
        feed(spark, indexer, TABLE, raw_days(spark, 2, rows=30), FIRST + 5 * DAY + 1)
        feed(spark, indexer, TABLE, raw_days(spark, 1, rows=30), FIRST + 5 * DAY + 2)
        return sent

    monkeypatch.setattr(job, "publish", slow)
    assert len(job.run(FIRST + 9 * DAY)) == 2 and job.late_paths == 0
    monkeypatch.setattr(job, "publish", publish)
    assert job.run(FIRST + 9 * DAY) == [] and job.late_paths == 3


def test_start_and_runs_read_new_messages_only(spark, tmp_path, monkeypatch):
    indexer = stock.indexer(tmp_path, None, snapshots="segments")
    folder = tmp_path / "rt"
    folder.mkdir()
    for n in range(20):
        offsets = '[{"topic": "x", "partition": 0, "offset": %d}, {"topic": "x", "partition": 1, "offset": 3}]' % n
        (folder / f"{n}.msg").write_text('{"id": %d, "tables": {}, "offsets": %s}' % (n, offsets))
    (folder / "5.msg").write_text("not read")
    found = StreamJob(spark, indexer, [stock.table()]).known_offsets()
    assert [(o["partition"], o["offset"]) for o in found] == [(0, 19), (1, 3)]
    # the batch job opens the newest manifest of its own
    for n in range(5):
        (folder / f"{n}.msg").unlink()
    for n in range(5, 20):
        (folder / f"{n}.msg").unlink()
    feed(spark, indexer, TABLE, raw_days(spark, 2), FIRST + 5 * DAY)
    BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    (tmp_path / "b" / "3.msg").write_text("not read")
    monkeypatch.setattr(batch_module, "all_manifests", _only_real_time(indexer))
    assert BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY) == []


def _only_real_time(indexer):
    def read(spark, channel, schema, after=None):
        assert channel == indexer.real_time.channel
        return all_manifests(spark, channel, schema, after)

    return read


def test_entry_without_segments_has_no_times():
    entry = entry_of(TABLE, stock.indexer("x", None), [])
    assert entry["paths"] == [] and entry["recordCount"] == 0 and entry["minTime"] is None


def test_micro_batches_outside_the_manifest_are_not_read(spark, tmp_path):
    indexer = stock.indexer(tmp_path, None, snapshots="segments")
    feed(spark, indexer, TABLE, raw_days(spark, 1), FIRST + 5 * DAY)
    rows = raw_days(spark, 1, rows=10).transform(rollup(TABLE))
    write_micro_batch(rows, TABLE, indexer.realtime_root, DAY, FIRST + 5 * DAY + 1, "timestamp")
    (sent,) = BatchJob(spark, indexer, [TABLE]).run(FIRST + 9 * DAY)
    assert read_published(spark, TABLE, sent["tables"]["t"]).agg(F.sum("n")).first()[0] == 400


@pytest.mark.parametrize("snapshots", ["segments", "whole"])
def test_table_with_a_column_named_as_a_folder(spark, tmp_path, snapshots):
    table = replace(TABLE, dimensions=(*TABLE.dimensions, Dimension("dt"), Dimension("bucket", type="int")))
    indexer = stock.indexer(tmp_path, 2, snapshots=snapshots)
    rows = raw_days(spark, 2).withColumn("dt", F.col("company")).withColumn("bucket", F.lit(7))
    feed(spark, indexer, table, rows, FIRST + 5 * DAY)
    sent = BatchJob(spark, indexer, [table]).run(FIRST + 9 * DAY)
    assert rows_of(read_published(spark, table, sent[-1]["tables"]["t"])) == rows_of(rows.transform(rollup(table)))
    if snapshots == "segments":
        columnar = replace(indexer, batch=replace(indexer.batch, snapshot_format="parquet"))
        with pytest.raises(ValueError, match="named as folders"):
            close_periods(
                spark, table, columnar, [FIRST], rows.transform(rollup(table)).withColumn(PERIOD, F.lit(FIRST)).where(f"timestamp < '{'2016-05-11'}'"), None, "timestamp"
            )
