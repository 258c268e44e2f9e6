"""Rollup, truncation, re-rollup: golden values and algebra."""

import random
from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollmill.operators.chain import chain, load_hook
from rollmill.operators.rollup import (
    aggregate,
    finalise,
    rerollup,
    rollup,
    select_inputs,
    select_outputs,
    truncate_times,
)
from rollmill.sinks.store import to_lines
from rollmill.sources.records import parse_records
from rollmill.spec import AGGREGATES, NUMBER_TYPES, ROLLUP_COUNT, Dimension, Metric, ParseSpec, TableSpec, input_schema
from tests import stock


def values(df):
    return sorted(tuple(r) for r in df.collect())


def matrix(with_count):
    metrics = [Metric(f"{w}_{a}", f"{w}_{a}") for w in NUMBER_TYPES for a in ("sum", "max", "min", "avg")]
    if with_count:
        metrics.insert(0, Metric("count", "count"))
    return TableSpec("m", (Dimension("country"),), tuple(metrics))


@pytest.mark.parametrize("with_count", [True, False])
def test_metric_matrix(spark, with_count):
    table = matrix(with_count)
    assert {m.aggregate for m in table.metrics} - {"count"} == set(AGGREGATES)
    names = [m.name for m in table.metrics if not m.is_count]
    rows = [("PE", 5), ("NO", 4), ("PE", 2), ("PE", 8), ("NO", 9), ("PE", 2)]
    raw = spark.createDataFrame([("\t".join([c] + [str(v)] * 40),) for c, v in rows], "value STRING")
    parse = ParseSpec("tsv", columns=("country", *names))
    rolled = parse_records(raw, parse, input_schema([table])).transform(rollup(table))
    assert rolled.schema.simpleString() == table.store_schema.simpleString()
    no, pe = (13, 9, 4, 13) * 10, (17, 8, 2, 17) * 10
    golden = [("NO", 2, *no), ("PE", 4, *pe)] if with_count else [("NO", *no, 2), ("PE", *pe, 4)]
    assert values(rolled) == golden
    # stored rows with a count of one each roll up to the same
    single = parse_records(raw, parse, input_schema([table]))
    stored = single.withColumn(table.count_column, F.lit(1).cast("bigint"))
    assert values(stored.transform(rerollup(table))) == golden
    # and so does the result itself, whose sums have widened
    assert values(rolled.union(rolled).transform(rerollup(table)).select("country", table.count_column)) == [
        ("NO", 4),
        ("PE", 8),
    ]


def test_synthetic_count_is_added_up(spark):
    table = TableSpec("t", (Dimension("a"),), ())
    rows = spark.createDataFrame([("x", 5), ("x", 7)], f"a STRING, {ROLLUP_COUNT} BIGINT")
    assert values(rows.transform(rerollup(table))) == [("x", 12)]


def test_truncation(spark):
    units = {"y": "year", "m": "month", "d": "day", "h": "hour", "min": "minute", "s": "second"}
    table = TableSpec("t", tuple(Dimension(n, type="time", granularity=g) for n, g in units.items()), ())
    millis = [951_867_309_000, -86_399_000, 1_735_689_599_000, 4_102_444_800_000]
    df = spark.createDataFrame([(v,) for v in millis], "v BIGINT").select(
        *(F.timestamp_millis("v").alias(n) for n in units)
    )
    cut = df.transform(truncate_times(table))
    assert [t for _, t in cut.dtypes] == ["date"] * 3 + ["timestamp"] * 3
    got = [tuple(r) for r in cut.select(*(F.col(n).cast("string") for n in units)).collect()]
    assert got == [
        ("2000-01-01", "2000-02-01", "2000-02-29", "2000-02-29 23:00:00", "2000-02-29 23:35:00", "2000-02-29 23:35:09"),
        ("1969-01-01", "1969-12-01", "1969-12-31", "1969-12-31 00:00:00", "1969-12-31 00:00:00", "1969-12-31 00:00:01"),
        ("2024-01-01", "2024-12-01", "2024-12-31", "2024-12-31 23:00:00", "2024-12-31 23:59:00", "2024-12-31 23:59:59"),
        ("2100-01-01", "2100-01-01", "2100-01-01", "2100-01-01 00:00:00", "2100-01-01 00:00:00", "2100-01-01 00:00:00"),
    ]


def test_second_keeps_fractions(spark):
    table = TableSpec("t", (Dimension("t", type="time", granularity="second"),), ())
    df = spark.sql("SELECT timestamp_micros(1500000) AS t")
    assert df.transform(truncate_times(table)).select(F.unix_micros("t")).first()[0] == 1500000


DIMENSION_KINDS = (
    "string", "numeric", "time", "microtime", "byte", "ubyte", "short", "ushort", "int", "uint", "long", "ulong",
    "float", "double",
)


def test_dimension_matrix(spark):
    table = TableSpec("d", tuple(Dimension(k, type=k) for k in DIMENSION_KINDS), (Metric("count", "count"),))
    row = "A\t123\t2019-01-05T01:02:03+0000\t2019-01-05T01:02:03.123+0000\t-10\t10\t5\t5\t-120\t120\t-123456\t123456\t1.23456\t1.23456"
    other = row.replace("01:02:03", "01:02:04")[: -len("1.23456")] + "1.23457"
    raw = spark.createDataFrame([(row,), (row,), (other,)], "value STRING")
    rolled = parse_records(raw, ParseSpec("tsv", columns=DIMENSION_KINDS), input_schema([table])).transform(rollup(table))
    shown = rolled.withColumns({c: F.unix_millis(c) for c in ("time", "microtime")})
    first, second = values(shown)
    assert first[2:4] == (1546650123000, 1546650123123) and first[-1] == 2
    assert second[2:4] == (1546650124000, 1546650124123) and second[-1] == 1
    assert first[:2] == ("A", 123) and first[4:12] == (-10, 10, 5, 5, -120, 120, -123456, 123456)
    assert first[13] == 1.23456 and second[13] == 1.23457


def test_string_date_dimension(spark):
    table = TableSpec(
        "t", (Dimension("company"), Dimension("dt")), (Metric("s", "double_sum", field="stock_price"), Metric("count", "count"))
    )
    raw = spark.createDataFrame([(l,) for l in stock.RAW_LINES], "value STRING")
    parse = ParseSpec("tsv", columns=("company", "dt", "stock_price"))
    rolled = parse_records(raw, parse, input_schema([table])).transform(rollup(table))
    golden = ["\t".join(g.split("\t")[i] for i in (0, 1, 2, 5)) for g in stock.GOLDEN]
    assert sorted(r[0] for r in to_lines(rolled, table).collect()) == golden


def test_no_dimensions(spark):
    table = TableSpec("t", (), (Metric("n", "count"), Metric("x", "int_max")))
    df = spark.createDataFrame([(1,), (5,)], "x INT")
    assert values(df.transform(rollup(table))) == [(2, 5)]
    empty = df.where("x > 9").transform(rollup(table)).collect()
    assert [tuple(r) for r in empty] == [(0, None)]


def test_distinct_ids(spark):
    table = TableSpec("t", (Dimension("a"), Dimension("b")), (Metric("u", "bitset"), Metric("v", "bitset"), Metric("p", "int_avg")))
    raw = [("x", "1", 1, 7, 10), ("x", "1", 1, 8, 20), ("x", "2", 2, 7, 30), ("x", "2", 1, 7, 30), ("y", "1", 1, 1, 4)]
    rolled = spark.createDataFrame(raw, "a STRING, b STRING, u INT, v INT, p INT").transform(rollup(table))
    assert rolled.count() == 5
    assert values(rolled.transform(finalise(table, by=["a"]))) == [("x", 2, 2, 22.5, 4), ("y", 1, 1, 4.0, 1)]
    assert values(rolled.transform(finalise(table))) == [("x", "1", 1, 2, 15.0, 2), ("x", "2", 2, 1, 30.0, 2), ("y", "1", 1, 1, 4.0, 1)]


def test_chain_order_and_hooks(spark):
    df = spark.createDataFrame([(2,)], "x INT")
    double = lambda d: d.withColumn("x", F.col("x") * 2)
    add = lambda d: d.withColumn("x", F.col("x") + 1)
    assert chain(double, add)(df).first()[0] == 5
    assert chain(add, double)(df).first()[0] == 6
    assert load_hook("rollmill.operators.rollup:rollup") is rollup
    assert load_hook("rollmill.operators.rollup.rollup") is rollup
    with pytest.raises(ValueError):
        load_hook("rollup")


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "", "é"]),
        st.integers(0, 10**12),
        st.integers(-128, 127),
        st.integers(0, 5),
        st.integers(0, 2),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_any_split_rolls_up_to_the_same(spark, rows):
    """Roll the pieces of any split up, union, roll up again: as if rolled up at once, and as brute force."""
    table = TableSpec(
        "t",
        (Dimension("k"), Dimension("t", type="time", granularity="hour")),
        (
            Metric("s", "byte_sum", field="x"),
            Metric("lo", "byte_min", field="x"),
            Metric("hi", "byte_max", field="x"),
            Metric("u", "bitset"),
        ),
    )
    df = spark.createDataFrame(rows, "k STRING, ms BIGINT, x INT, u INT, piece INT").select(
        "k", F.timestamp_millis("ms").alias("t"), F.col("x").cast("tinyint").alias("x"), "u", "piece"
    )
    whole = df.transform(rollup(table))
    pieces = [df.where(F.col("piece") == p).transform(rollup(table)) for p in range(3)]
    merged = pieces[0].unionByName(pieces[1]).unionByName(pieces[2]).transform(rerollup(table))
    brute = {}
    for k, ms, x, u, _ in rows:
        hour = datetime.fromtimestamp(ms // 3_600_000 * 3600, timezone.utc)
        s, lo, hi, n = brute.get((k, hour, u), (0, 127, -128, 0))
        brute[(k, hour, u)] = (s + x, min(lo, x), max(hi, x), n + 1)
    expected = sorted((k, int(t.timestamp() * 1000), s, lo, hi, u, n) for (k, t, u), (s, lo, hi, n) in brute.items())
    for result in (whole, merged):
        assert values(result.withColumn("t", F.unix_millis("t"))) == expected


def test_hot_key_meets_before_the_shuffle(spark):
    """A key with most of the rows leaves every scan task as one row."""
    random.seed(1)
    table = TableSpec("t", (Dimension("k"),), (Metric("n", "count"),))
    rows = spark.range(0, 30000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 as string)) AS k")
    rolled = rows.transform(rollup(table))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert dict(values(rolled))["hot"] == 10000


def test_one_field_is_aggregated_once(spark):
    """Sum and average over one field share an aggregate; the steps one by one give the same rows."""
    rows = spark.createDataFrame(stock.RAW, "company STRING, timestamp STRING, stock_price STRING").select(
        "company", F.to_timestamp("timestamp").alias("timestamp"), F.col("stock_price").cast("double").alias("stock_price")
    )
    table = stock.table()
    rolled = rows.transform(rollup(table))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum(") == 1 and plan.count("partial_max(") == 1
    steps = chain(select_inputs(table), truncate_times(table), aggregate(table), select_outputs(table))
    assert values(rolled) == values(steps(rows))
    assert sorted(r[0] for r in to_lines(rolled, table).collect()) == stock.GOLDEN
