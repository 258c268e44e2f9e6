"""Why records are bad, and where they go."""

import glob
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollmill.sources.records import parse_records, record_parser, refused_records
from rollmill.spec import Dimension, Metric, ParseSpec, RealTimeSpec, TableSpec, input_schema
from rollmill.streaming.job import StreamJob
from tests import stock
from tests.test_jobs import manifests, run_stream, write_raw

TABLE = TableSpec(
    "t", (Dimension("s"), Dimension("at", type="time", format="%Y-%m-%d")), (Metric("v", "byte_sum"), Metric("n", "count"))
)
SCHEMA = input_schema([TABLE])


def reasons(spark, lines, parse):
    raw = spark.createDataFrame([(l, i) for i, l in enumerate(lines)], "value string, line int")
    parsed = raw.transform(record_parser(parse, SCHEMA, reasons=True))
    found = refused_records(parsed, ("line",)).collect()
    plain = raw.drop("line").transform(lambda d: parse_records(d, replace(parse, skip_bad_rows=True), SCHEMA))
    assert plain.count() == len(lines) - len(found)
    for row in found:
        assert row["value"] == lines[row["line"]]
    return {r["line"]: [tuple(x) for x in r["reasons"]] for r in found}


def test_delimited(spark):
    parse = ParseSpec("tsv", columns=("s", "v", "at"), time_formats={"at": "%Y-%m-%d"})
    lines = ["a\t1\t2020-01-02", "a\t1000\tsoon", "a\t\t2020-01-02", "a\t1", "a", "", None, "b\t7\t2020-02-30\tmore"]
    assert reasons(spark, lines, parse) == {
        1: [("at", "not timestamp"), ("v", "not tinyint")],
        2: [("v", "not tinyint")],
        3: [("at", "absent")],
        4: [("at", "absent"), ("v", "absent")],
        5: [("at", "absent"), ("v", "absent")],
        6: [("s", "absent"), ("at", "absent"), ("v", "absent")],
        7: [("at", "not timestamp")],
    }


def test_json(spark):
    parse = ParseSpec("json", time_formats={"at": "%Y-%m-%d"}, null_string_as_empty=False, null_numeric_as_zero=False)
    lines = [
        '{"s": "a", "at": "2020-01-02", "v": 5}',
        '{"s": null, "at": "2020-01-02"}',
        '{"s": "a", "at": [1], "v": true}',
        '{"s": "a", "at": "2020-01-02", "v": 500}',
        "{",
        "[1]",
        None,
    ]
    assert reasons(spark, lines, parse) == {
        1: [("s", "absent"), ("v", "absent")],
        2: [("at", "not timestamp"), ("v", "not tinyint")],
        3: [("v", "not tinyint")],
        4: [(None, "not an object")],
        5: [(None, "not an object")],
        6: [(None, "not an object")],
    }


def own(parse, schema):
    def run(df):
        cells = df.select(F.col("value").alias("s"), F.lit(None).cast("timestamp").alias("at"), F.lit(1).cast("byte").alias("v"), *[c for c in df.columns if c != "value"])
        return cells.withColumn("__bad", F.col("s") == "no")

    return run


def test_own_parser(spark):
    parse = ParseSpec(record_parser="tests.test_quarantine:own")
    assert reasons(spark, ["yes", "no"], parse) == {1: [(None, "refused by the parser")]}


def aside(indexer):
    out = {}
    for path in glob.glob(f"{indexer.quarantine_root}/mb=*"):
        for name in glob.glob(f"{path}/*.gz"):
            import gzip

            with gzip.open(name, "rt") as lines:
                out.setdefault(os.path.basename(path), []).extend(json.loads(l) for l in lines)
    return out


@pytest.mark.parametrize("own_parser", [False, True])
def test_stream_puts_bad_records_aside(spark, tmp_path, own_parser):
    """Also those of a batch without good ones, and once if a batch runs again."""
    indexer = stock.indexer(tmp_path)
    indexer = replace(indexer, real_time=replace(indexer.real_time, quarantine=True))
    raw, bad = tmp_path / "raw", ["Tern\t2016-05-10\tdear", "Tern"]
    write_raw(raw, [*stock.RAW_LINES, *bad], "a.txt")
    parser = record_parser(indexer.real_time.parse, input_schema([stock.table()])) if own_parser else None
    run_stream(spark, indexer, [stock.table()], raw, tmp_path / "cp", parser=parser)
    assert stock.store_lines(spark, f"{indexer.realtime_root}/foo") == stock.GOLDEN
    (micro,) = manifests(tmp_path, "rt")
    found = aside(indexer)
    assert list(found) == [f"mb={micro['id']}"]
    told = {r["value"]: [(x["field"], x["rule"]) for x in r["reasons"]] for r in found[f"mb={micro['id']}"]}
    if own_parser:
        assert told == {b: [(None, "refused by the parser")] for b in bad}
    else:
        assert told == {
            bad[0]: [("stock_price", "not double")],
            bad[1]: [("timestamp", "absent"), ("stock_price", "absent")],
        }
    write_raw(raw, ["all\tbad"], "b.txt")
    run_stream(spark, indexer, [stock.table()], raw, tmp_path / "cp", parser=parser)
    assert sorted(map(len, aside(indexer).values())) == [1, 2] and len(manifests(tmp_path, "rt")) == 1

    # a batch that failed after it had written, and runs again
    class Failing(StreamJob):
        failed = False

        def notify(self, manifest):
            if not Failing.failed:
                Failing.failed = True
                raise RuntimeError("lost")
            super().notify(manifest)

    write_raw(raw, [*stock.RAW_LINES, "one\tmore"], "c.txt")
    for _ in range(2):
        query = Failing(spark, indexer, [stock.table()], parser=parser).start(
            str(tmp_path / "cp"), spark.readStream.text(str(raw)), available_now=True
        )
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001
            assert "lost" in str(error)
    assert sorted(map(len, aside(indexer).values())) == [1, 1, 2]


def test_setting():
    assert RealTimeSpec.from_dict({"quarantine": True}).quarantine and not RealTimeSpec.from_dict({}).quarantine
