"""Tables made from other tables equal those made from records."""

import itertools
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollmill.operators.lattice import derived, follows, levels, plan, rollup_family
from rollmill.operators.rollup import rollup
from rollmill.session import stage
from rollmill.sources.store import read_lines
from rollmill.spec import Dimension, Metric, TableSpec
from rollmill.streaming.job import StreamJob
from tests import stock
from tests.test_jobs import write_raw


def time(granularity=None, name="at", field="t"):
    return Dimension(name, field=field, type="time", granularity=granularity)


KIND, CITY = Dimension("kind"), Dimension("town", field="city")
VALUES = (
    Metric("total", "int_sum", field="v"),
    Metric("least", "int_min", field="v"),
    Metric("most", "int_max", field="v"),
    Metric("n", "count"),
)
FINE = TableSpec("fine", (KIND, CITY, time("minute")), VALUES)


@pytest.mark.parametrize(
    "dimensions, metrics, can",
    [
        ((KIND,), VALUES, True),
        ((), (), True),
        ((KIND, time("hour", "hour")), VALUES[:1], True),
        ((time("year"), time("month", "m")), (), True),
        ((time("second"),), (), False),  # finer than a minute
        ((time(),), (), False),
        ((time("hour", field="other"),), (), False),
        ((Dimension("v", type="int"),), (), False),
        ((Dimension("kind", type="int"),), (), False),
        ((KIND,), (Metric("mean", "int_avg", field="v"),), True),  # an average is kept as a sum
        ((KIND,), (Metric("total", "long_sum", field="v"),), False),
        ((KIND,), (Metric("ids", "bitset", field="v"),), False),
    ],
)
def test_what_follows(dimensions, metrics, can):
    child = TableSpec("child", dimensions, metrics)
    assert follows(child, FINE) is can
    if not can:
        with pytest.raises(ValueError, match="does not follow"):
            derived(child, FINE)


def test_averages_do_not_give_extremes_and_ids_stay_ids():
    parent = TableSpec("p", (KIND,), (Metric("mean", "int_avg", field="v"), Metric("ids", "bitset", field="u")))
    assert follows(TableSpec("c", (), (Metric("s", "int_sum", field="v"), Metric("u", "bitset"))), parent)
    assert not follows(TableSpec("c", (), (Metric("s", "int_max", field="v"),)), parent)
    assert not follows(TableSpec("c", (), (Metric("u", "bitset", max=2**40),)), parent)


def test_plan_takes_the_smallest_and_has_no_circles():
    hours = TableSpec("hours", (KIND, time("hour")), VALUES)
    days = TableSpec("days", (KIND, time("day")), VALUES)
    same = replace(days, name="same")
    towns = TableSpec("towns", (CITY,), VALUES[:2])
    other = TableSpec("other", (Dimension("elsewhere"),), ())
    for tables in itertools.permutations([FINE, hours, days, towns, other, same]):
        parents = plan(tables)
        assert parents["fine"] is None and parents["other"] is None
        assert parents["hours"] == "fine" and parents["towns"] == "fine"
        first, second = sorted(("days", "same"), key=[t.name for t in tables].index)
        assert parents[first] == "hours" and parents[second] == first
        order = [n for level in levels(parents) for n in level]
        assert sorted(order) == sorted(parents)
        assert all(p is None or order.index(p) < order.index(n) for n, p in parents.items())


def records(spark):
    # null keys, null values, times before 1970, a kind with a third of all rows
    return spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 7)).alias("kind"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("city"),
        F.timestamp_millis((F.col("id") - 500) * 7_777_777).alias("t"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 101 - 50).cast("int")).alias("v"),
        (F.col("id") % 13).cast("int").alias("u"),
    )


UNITS = [None, "second", "minute", "hour", "day", "month", "year"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("fine, coarse", [(a, b) for i, a in enumerate(UNITS) for b in UNITS[max(i, 1):]])
def test_every_granularity_from_every_finer_one(spark, fine, coarse):
    ids = Metric("ids", "bitset", field="u")
    parent = TableSpec("p", (KIND, CITY, time(fine)), (*VALUES, ids))
    child = TableSpec("c", (time(coarse, "when"), KIND), (VALUES[2], Metric("users", "bitset", field="u"), Metric("mean", "int_avg", field="v")))
    df = records(spark)
    got, want = derived(child, parent)(rollup(parent)(df)), rollup(child)(df)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows_of(got) == rows_of(want)


def test_family_reads_records_once(spark, tmp_path):
    tables = [FINE, TableSpec("days", (KIND, time("day")), VALUES), TableSpec("all", (), VALUES[:1])]
    plans = {}

    def keep(name, rows):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return stage(rows, f"{tmp_path}/{name}")

    made = rollup_family(tables, records(spark), keep)
    for table in tables:
        assert rows_of(made[table.name]) == rows_of(rollup(table)(records(spark)))
    plans["all"] = made["all"]._jdf.queryExecution().optimizedPlan().toString()
    assert [n for n, p in plans.items() if "Range (" in p] == ["fine"]
    assert "/fine" in plans["days"] and "Relation" in plans["all"]


def test_stream_aggregates_records_once(spark, tmp_path, monkeypatch):
    fine = stock.table("fine")
    coarse = replace(fine, name="coarse", dimensions=(replace(fine.dimensions[1], granularity="month"),))
    own = replace(fine, name="own", dimensions=(fine.dimensions[1],))
    indexer = stock.indexer(tmp_path, None)
    write_raw(tmp_path / "raw", stock.RAW_LINES)
    from_records = []
    process = StreamJob.process

    def watched(job, table, df):
        from_records.append(table.name)
        return process(job, table, df)

    hook = {"own": lambda df: rollup(own)(df.where("company = 'Tern'"))}
    job = StreamJob(spark, indexer, [coarse, own, fine], processors=hook)
    monkeypatch.setattr(job, "process", lambda table, df: watched(job, table, df))
    query = job.start(str(tmp_path / "cp"), spark.readStream.text(str(tmp_path / "raw")), available_now=True)
    query.awaitTermination()
    assert sorted(from_records) == ["fine", "own"]
    assert stock.store_lines(spark, f"{indexer.realtime_root}/fine") == stock.GOLDEN
    (line,) = stock.store_lines(spark, f"{indexer.realtime_root}/coarse")
    cells = line.split("\t")
    assert cells[0] == "2016-05-01" and cells[-1] == "10" and float(cells[1]) == pytest.approx(235.5)
    assert len(stock.store_lines(spark, f"{indexer.realtime_root}/own")) == 3


class Doubling(StreamJob):
    def process(self, table, records):
        return super().process(table, records.union(records))


def test_overridden_steps_see_every_table(spark, tmp_path):
    fine = stock.table("fine")
    coarse = replace(fine, name="coarse", dimensions=fine.dimensions[:1])
    indexer = stock.indexer(tmp_path, None)
    indexer = replace(indexer, real_time=replace(indexer.real_time, parse=replace(indexer.real_time.parse, time_column=None)))
    write_raw(tmp_path / "raw", stock.RAW_LINES)
    job = Doubling(spark, indexer, [fine, coarse])
    assert set(job.parents.values()) == {None}
    assert StreamJob(spark, indexer, [fine, coarse]).parents == {"fine": None, "coarse": "fine"}
    run = job.start(str(tmp_path / "cp"), spark.readStream.text(str(tmp_path / "raw")), available_now=True)
    run.awaitTermination()
    base = f"{indexer.realtime_root}/coarse"
    counts = [r["value"].split("\t")[-1] for r in read_lines(spark, base, base).collect()]
    assert sorted(counts) == ["10", "10"]
