"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs three times and the best run counts: the first ones pay for code generation and
class loading. Results go to Spark's ``noop`` sink or, where writing is the point, to files. Raw text
is printed from the tables beforehand.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollmill.operators.balance import BUCKET, Layout, bucket_column, bucket_weights, place  # noqa: E402
from rollmill.operators.rollup import rollup  # noqa: E402
from rollmill.session import configure, scratch_path, stage, tidy  # noqa: E402
from rollmill.sinks.store import write_snapshot  # noqa: E402
from rollmill.sources.records import parse_records  # noqa: E402
from rollmill.spec import ParseSpec, Partitioning, input_schema  # noqa: E402
from workloads import parsing, rollups, store  # noqa: E402
from workloads.base import load  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LINES = Partitioning(("linestatus", "returnflag"), 8)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def drain(query):
    return lambda spark: noop(query(spark, SF_DIR))


@cache
def text_of(spark, name):
    """Raw records of a table as text files, printed once."""
    path = scratch_path(spark, f"bench-{name}")
    if name == "tsv":
        df = parsing.line_text(spark, SF_DIR)
    elif name == "json":
        df = load(spark, SF_DIR, "orders").select(F.to_json(F.struct("*")).alias("value"))
    else:
        df = parsing.event_docs(spark, SF_DIR)
    df.repartition(int(CPUS)).write.text(path)
    return spark.read.text(path)


def parse_and_roll(name, parse, table):
    def run(spark):
        rows = parse_records(text_of(spark, name), parse, input_schema([table]))
        noop(rows.transform(rollup(table)))

    return run


def balanced_write(spark):
    rolled = load(spark, SF_DIR, "lineitem").transform(rollup(rollups.LINE_CUBE))
    bucketed = stage(rolled.withColumn(BUCKET, bucket_column(rollups.LINE_CUBE, LINES)), scratch_path(spark, "bench"))
    layout = Layout.plan(bucket_weights(bucketed), LINES.partitions, 1_000_000)
    placed = place(bucketed, rollups.LINE_CUBE, layout, ("shipdate",))
    write_snapshot(placed, rollups.LINE_CUBE, scratch_path(spark, "bench"), store.DAY)


def stream_drain(spark):
    store.event_stream(spark, SF_DIR, "bench-stream", [store.USER_CUBE])


def period_close(spark):
    """All weeks closed one after the other, each on top of the snapshot before."""
    store.run_history(spark, SF_DIR, "bench-close", store.USER_CUBE, partitioning=Partitioning(("user_id",), 8))


QUERIES = {
    "rollup_day": drain(rollups.rollup_day),
    "rollup_hour": drain(rollups.rollup_hour),
    "bitset_distinct": drain(rollups.bitset_distinct),
    "rerollup_batches": drain(rollups.rerollup_batches),
    "tsv_parse": parse_and_roll("tsv", parsing.LINE_PARSE, rollups.LINE_CUBE),
    "json_flat": parse_and_roll("json", ParseSpec("json"), parsing.ORDERS),
    "json_path": parse_and_roll("docs", parsing.NESTED_PARSE, parsing.NESTED),
    "line_roundtrip": drain(parsing.line_roundtrip),
    "balanced_write": balanced_write,
    "stream_drain": stream_drain,
    "period_close": period_close,
}


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(QUERIES)
    took = {}
    for name in wanted:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark)
            runs.append(time.perf_counter() - start)
        took[name] = round(min(runs), 3)
    tidy(spark)
    print(
        json.dumps(
            {
                "metric": "headline query seconds",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
