"""Rollup, truncation, metrics, re-rollup and the read side."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.operators.bitmaps import bitmaps, merge_bitmaps, report, size_of
from rollmill.operators.chain import chain
from rollmill.operators.rollup import finalise, keep_between, rerollup, rollup
from rollmill.session import scratch_path
from rollmill.spec import AGGREGATES, NUMBER_TYPES, ROLLUP_COUNT, Dimension, Metric, TableSpec
from workloads.base import Workload, load, shown

VALUE_METRICS = (
    Metric("value_sum", "double_sum", field="value"),
    Metric("value_min", "double_min", field="value"),
    Metric("value_max", "double_max", field="value"),
    Metric("value_avg", "double_avg", field="value"),
    Metric("events", "count"),
)


def event_cube(granularity: str, name: str = "event_cube") -> TableSpec:
    return TableSpec(
        name,
        (Dimension("event_type"), Dimension("ts", type="time", granularity=granularity)),
        VALUE_METRICS,
    )


def rollup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(load(spark, sf_dir, "events").transform(rollup(event_cube("hour"))), 4)


def _event_sql(time: str) -> str:
    return f"""
    SELECT event_type, {time} AS ts, round(sum(value), 4) AS value_sum, round(min(value), 4) AS value_min,
           round(max(value), 4) AS value_max, round(sum(value), 4) AS value_avg, count(*) AS events
    FROM events GROUP BY 1, 2"""


def rollup_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(load(spark, sf_dir, "events").transform(rollup(event_cube("minute"))), 4)


def rollup_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(load(spark, sf_dir, "events").transform(rollup(event_cube("second"))), 4)


def _order_cube(granularity: str) -> TableSpec:
    return TableSpec(
        "order_cube",
        (
            Dimension("status", field="o_orderstatus"),
            Dimension("day", field="o_orderdate", type="time", granularity=granularity),
        ),
        (
            Metric("price_sum", "double_sum", field="o_totalprice"),
            Metric("price_max", "double_max", field="o_totalprice"),
        ),
    )


def rollup_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(load(spark, sf_dir, "orders").transform(rollup(_order_cube("year"))), 2, dates=True)


def rollup_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(load(spark, sf_dir, "orders").transform(rollup(_order_cube("month"))), 2, dates=True)


def _order_sql(unit: str) -> str:
    return f"""
    SELECT o_orderstatus AS status, CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS day,
           round(sum(o_totalprice), 2) AS price_sum, round(max(o_totalprice), 2) AS price_max,
           count(*) AS {ROLLUP_COUNT}
    FROM orders GROUP BY 1, 2"""


LINE_CUBE = TableSpec(
    "line_cube",
    (
        Dimension("returnflag", field="l_returnflag"),
        Dimension("linestatus", field="l_linestatus"),
        Dimension("shipdate", field="l_shipdate", type="time", granularity="day"),
    ),
    (
        Metric("quantity_sum", "double_sum", field="l_quantity"),
        Metric("price_sum", "double_sum", field="l_extendedprice"),
        Metric("price_min", "double_min", field="l_extendedprice"),
        Metric("price_max", "double_max", field="l_extendedprice"),
        Metric("discount_avg", "double_avg", field="l_discount"),
        Metric("lines", "count"),
    ),
)


def rollup_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(load(spark, sf_dir, "lineitem").transform(rollup(LINE_CUBE)), 2, dates=True)


LINE_METRICS_SQL = """
           round(sum(l_quantity), 2) AS quantity_sum, round(sum(l_extendedprice), 2) AS price_sum,
           round(min(l_extendedprice), 2) AS price_min, round(max(l_extendedprice), 2) AS price_max,
           round(sum(l_discount), 2) AS discount_avg, count(*) AS lines"""


def rollup_synthetic_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No count metric: rows are counted under the synthetic name, also when rolled up again."""
    by_priority = TableSpec("t", (Dimension("o_orderpriority"), Dimension("o_orderstatus")), ())
    by_status = TableSpec("t", (Dimension("o_orderstatus"),), ())
    orders = load(spark, sf_dir, "orders")
    return orders.transform(rollup(by_priority)).transform(rerollup(by_status))


def rollup_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = TableSpec("all_lines", (), LINE_CUBE.metrics)
    return shown(load(spark, sf_dir, "lineitem").transform(rollup(table)), 2)


USERS = TableSpec(
    "users",
    (Dimension("event_type"), Dimension("ts", type="time", granularity="day")),
    (
        Metric("users", "bitset", field="user_id", max=2**40),
        Metric("value", "double_sum"),
        Metric("events", "count"),
    ),
)


def rollup_bitset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids stay in the row key, so that distinct ids can be counted exactly later."""
    return shown(load(spark, sf_dir, "events").transform(rollup(USERS)), 4)


def bitset_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = load(spark, sf_dir, "events").transform(rollup(USERS))
    return shown(rolled.transform(finalise(USERS)), 4)


def wide_ids(events: DataFrame) -> DataFrame:
    """User ids spread over many ranges of a bitmap, negative ones among them."""
    return events.withColumn("user_id", F.col("user_id") * 9_973 - 200_000)


def bitset_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of three micro-batches as stored bitmaps, merged and counted over a coarser key."""
    events = load(spark, sf_dir, "events").transform(wide_ids)
    rows, maps, folder = None, None, scratch_path(spark, "bitmaps")
    for turn in range(3):
        rolled = events.where(F.col("event_id") % 3 == turn).transform(rollup(USERS))
        rolled.transform(bitmaps(USERS)).write.parquet(f"{folder}/mb={turn}")
        rows = rolled if rows is None else rows.unionByName(rolled)
    maps = spark.read.parquet(folder).drop("mb")
    return shown(report(USERS, rows, maps, by=["event_type"]), 4)


def bitset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many ids every day and range of ids has, from merged bitmaps."""
    rolled = load(spark, sf_dir, "events").transform(wide_ids).transform(rollup(USERS))
    merged = rolled.transform(bitmaps(USERS)).transform(merge_bitmaps(["ts"]))
    merged = merged.withColumn("ts", F.col("ts").cast("timestamp"))
    return shown(merged.select("ts", "metric", "bucket", size_of().alias("ids")))


def bitset_distinct_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids over fewer dimensions than were stored."""
    rolled = load(spark, sf_dir, "events").transform(rollup(USERS))
    return shown(rolled.transform(finalise(USERS, by=["event_type"])), 4)


# Source column of every width in the metric matrix.
WIDTH_SOURCES = {
    "byte": "l_linenumber",
    "ubyte": "l_quantity",
    "short": "l_quantity",
    "ushort": "l_suppkey",
    "int": "l_partkey",
    "uint": "l_orderkey",
    "long": "l_orderkey",
    "ulong": "l_partkey",
    "float": "l_quantity",
    "double": "l_extendedprice",
}
MATRIX = TableSpec(
    "matrix",
    (Dimension("l_returnflag"),),
    tuple(
        Metric(f"{width}_{agg}", f"{width}_{agg}", field=f"f_{width}")
        for width in NUMBER_TYPES
        for agg in AGGREGATES
    ),
)


def metric_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        *(F.col(c).cast(NUMBER_TYPES[w]).alias(f"f_{w}") for w, c in WIDTH_SOURCES.items()),
    )
    return shown(lines.transform(rollup(MATRIX)), 2)


def _matrix_sql() -> str:
    parts = []
    for width, column in WIDTH_SOURCES.items():
        for agg in AGGREGATES:
            call = f"{'sum' if agg == 'avg' else agg}({column})"
            if width in ("float", "double"):
                parts.append(f"round(CAST({call} AS DOUBLE), 2) AS {width}_{agg}")
            else:
                kind = MATRIX.store_schema[f"{width}_{agg}"].dataType.simpleString()
                parts.append(f"CAST({call} AS {kind.upper()}) AS {width}_{agg}")
    return f"SELECT l_returnflag, {', '.join(parts)}, count(*) AS {ROLLUP_COUNT} FROM lineitem GROUP BY 1"


NUMBER_DIMENSIONS = TableSpec(
    "numbers",
    (
        Dimension("flag", field="l_returnflag"),
        Dimension("b", field="l_linenumber", type="byte"),
        Dimension("i", field="i_quantity", type="numeric"),
        Dimension("l", field="l_suppkey", type="numeric", max=2**33),
        Dimension("d", field="l_discount", type="double"),
    ),
    (Metric("n", "count"),),
)


def rollup_number_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").withColumns(
        {"l_linenumber": F.col("l_linenumber").cast("tinyint"), "i_quantity": F.col("l_quantity").cast("int")}
    )
    return lines.transform(rollup(NUMBER_DIMENSIONS))


def rerollup_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll the lines of every supplier up on their own, then roll the union of them up again."""
    batches = TableSpec("batches", (Dimension("l_suppkey", type="long"), *LINE_CUBE.dimensions), LINE_CUBE.metrics)
    pieces = load(spark, sf_dir, "lineitem").transform(rollup(batches)).drop("l_suppkey")
    return shown(pieces.transform(rerollup(LINE_CUBE)), 2)


def rerollup_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollups of two halves of the lines, whose keys meet, rolled up again."""
    lines = load(spark, sf_dir, "lineitem")
    odd = F.col("l_orderkey") % 2 == 1
    halves = [lines.where(half).transform(rollup(LINE_CUBE)) for half in (odd, ~odd)]
    return shown(halves[0].unionByName(halves[1]).transform(rerollup(LINE_CUBE)), 2)


def avg_finalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = load(spark, sf_dir, "lineitem").transform(rollup(LINE_CUBE))
    view = rolled.transform(finalise(LINE_CUBE, by=["returnflag", "linestatus"]))
    return shown(view, 2, finer={"discount_avg": 6})


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = (datetime(2024, 1, d, tzinfo=timezone.utc) for d in (10, 20))
    events = load(spark, sf_dir, "events").transform(keep_between("ts", start, end))
    return shown(events.transform(rollup(event_cube("hour"))), 4)


def processor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A custom processor before and after the standard rollup."""
    halved = lambda df: df.withColumn("value", F.col("value") / 2)
    per_event = lambda df: df.withColumn("value_sum", F.col("value_sum") * 100)
    steps = chain(halved, rollup(event_cube("hour")), per_event)
    return shown(steps(load(spark, sf_dir, "events")), 4)


WORKLOADS = {
    "rollup_hour": Workload(rollup_hour, _event_sql("date_trunc('hour', ts)")),
    "rollup_minute": Workload(rollup_minute, _event_sql("date_trunc('minute', ts)")),
    "rollup_second": Workload(rollup_second, _event_sql("ts")),
    "rollup_year": Workload(rollup_year, _order_sql("year")),
    "rollup_month": Workload(rollup_month, _order_sql("month")),
    "rollup_day": Workload(
        rollup_day,
        f"""SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
                   CAST(date_trunc('day', l_shipdate) AS DATE) AS shipdate, {LINE_METRICS_SQL}
            FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "rollup_synthetic_count": Workload(
        rollup_synthetic_count,
        f"SELECT o_orderstatus, count(*) AS {ROLLUP_COUNT} FROM orders GROUP BY 1",
    ),
    "rollup_global": Workload(rollup_global, f"SELECT {LINE_METRICS_SQL} FROM lineitem"),
    "rollup_bitset": Workload(
        rollup_bitset,
        """SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, user_id AS users,
                  round(sum(value), 4) AS value, count(*) AS events
           FROM events GROUP BY 1, 2, 3""",
    ),
    "bitset_distinct": Workload(
        bitset_distinct,
        """SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(DISTINCT user_id) AS users,
                  round(sum(value), 4) AS value, count(*) AS events
           FROM events GROUP BY 1, 2""",
    ),
    "bitset_distinct_coarse": Workload(
        bitset_distinct_coarse,
        """SELECT event_type, count(DISTINCT user_id) AS users, round(sum(value), 4) AS value,
                  count(*) AS events
           FROM events GROUP BY 1""",
    ),
    "bitset_merged": Workload(
        bitset_merged,
        """SELECT event_type, count(DISTINCT user_id) AS users, round(sum(value), 4) AS value,
                  count(*) AS events
           FROM events GROUP BY 1""",
    ),
    "bitset_ranges": Workload(
        bitset_ranges,
        """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, 'users' AS metric,
                  CASE WHEN id > 0 THEN 1 + (id - 1) // 32768 ELSE id // 32768 END AS bucket,
                  count(DISTINCT id) AS ids
           FROM (SELECT ts, user_id * 9973 - 200000 AS id FROM events) GROUP BY 1, 3""",
    ),
    "metric_matrix": Workload(metric_matrix, _matrix_sql()),
    "rollup_number_dimensions": Workload(
        rollup_number_dimensions,
        """SELECT l_returnflag AS flag, CAST(l_linenumber AS TINYINT) AS b, CAST(l_quantity AS INTEGER) AS i,
                  l_suppkey AS l, l_discount AS d, count(*) AS n
           FROM lineitem GROUP BY 1, 2, 3, 4, 5""",
    ),
    "rerollup_batches": Workload(
        rerollup_batches,
        f"""SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
                   CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS shipdate, {LINE_METRICS_SQL}
            FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "rerollup_union": Workload(
        rerollup_union,
        f"""SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
                   CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS shipdate, {LINE_METRICS_SQL}
            FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "avg_finalise": Workload(
        avg_finalise,
        """SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
                  round(sum(l_quantity), 2) AS quantity_sum, round(sum(l_extendedprice), 2) AS price_sum,
                  round(min(l_extendedprice), 2) AS price_min, round(max(l_extendedprice), 2) AS price_max,
                  round(sum(l_discount) / count(*), 6) AS discount_avg, count(*) AS lines
           FROM lineitem GROUP BY 1, 2""",
    ),
    "retention": Workload(
        retention,
        """SELECT event_type, date_trunc('hour', ts) AS ts, round(sum(value), 4) AS value_sum,
                  round(min(value), 4) AS value_min, round(max(value), 4) AS value_max,
                  round(sum(value), 4) AS value_avg, count(*) AS events
           FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2""",
    ),
    "processor_chain": Workload(
        processor_chain,
        """SELECT event_type, date_trunc('hour', ts) AS ts, round(sum(value / 2) * 100, 4) AS value_sum,
                  round(min(value / 2), 4) AS value_min, round(max(value / 2), 4) AS value_max,
                  round(sum(value / 2), 4) AS value_avg, count(*) AS events
           FROM events GROUP BY 1, 2""",
    ),
}
