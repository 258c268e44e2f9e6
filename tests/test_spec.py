"""Settings: durations, types, checks, JSON documents."""

from datetime import datetime, timezone

import pytest

from rollmill.durations import duration_millis, interval_bounds
from rollmill.functions.timefmt import TimeFormat, print_pattern, read_pattern
from rollmill.spec import (
    ROLLUP_COUNT,
    BatchSpec,
    Dimension,
    IndexerSpec,
    Metric,
    ParseSpec,
    Partitioning,
    TableSpec,
    input_schema,
    read_settings,
)


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "text,millis",
    [("PT1M", 60_000), ("P1D", 86_400_000), ("PT5S", 5_000), ("P1W", 604_800_000), ("P1DT2H3M4S", 93_784_000)],
)
def test_durations(text, millis):
    assert duration_millis(text) == millis


@pytest.mark.parametrize("text", ["P1M", "P1Y", "P", "PT", "1D", "", "P1DT"[:-1] + "X"])
def test_durations_without_length(text):
    with pytest.raises(ValueError):
        duration_millis(text)


def test_intervals():
    assert interval_bounds("2017-01-01/P1M") == (utc(2017, 1, 1), utc(2017, 2, 1))
    assert interval_bounds("P1M/2017-03-31") == (utc(2017, 2, 28), utc(2017, 3, 31))
    assert interval_bounds("2017-01-01T00:00:00Z/2017-01-02T01:00:00+01:00") == (utc(2017, 1, 1), utc(2017, 1, 2))
    with pytest.raises(ValueError):
        interval_bounds("2017-01-01")


def test_indexer_document():
    indexer = IndexerSpec.from_dict(
        {
            "deepStorePath": "",
            "realTime": {
                "windowDuration": "PT1M",
                "parseSpec": {"format": "tsv", "columns": ["first", "second"]},
            },
            "batch": {
                "keepInterval": "2017-01-01/P1M",
                "partitioning": {"columns": ["app_id"], "partitions": 1},
            },
            "tables": ["foo"],
        }
    )
    assert indexer.real_time.window_millis == 60_000
    assert interval_bounds(indexer.batch.keep)[1] == utc(2017, 2, 1)
    assert len(indexer.real_time.parse.columns) == 2
    assert indexer.batch.partitioning == Partitioning(("app_id",), 1)
    assert indexer.batch.period_millis == 86_400_000
    assert IndexerSpec.from_dict({"deepStorePath": "x"}).real_time.window_millis == 5_000


def test_full_document():
    indexer, (table,) = read_settings(
        """{"indexer": {"tables": ["events"], "deepStorePath": "/s", "id": "i",
              "realTime": {"windowDuration": "PT1S", "kafkaSource": {"topics": ["t"], "brokers": ["b:1"]},
                 "parseSpec": {"format": "json", "timeColumn": "timestamp", "fieldMapping": {"a": "$.a"},
                    "timeFormats": {"timestamp": "%Y-%m-%d"}, "nullNumericAsZero": false},
                 "notifier": {"type": "file", "channel": "/c", "queue": "rt"}},
              "batch": {"batchDuration": "PT1H", "sortColumns": ["company"],
                 "notifier": {"type": "kafka", "channel": "b:1", "queue": "q"}}},
            "tables": {"events": {"name": "events", "sortColumns": ["timestamp"],
              "dimensions": [{"name": "company"}, {"name": "timestamp", "type": "time", "format": "%Y-%m-%d"}],
              "metrics": [{"name": "s", "field": "stock_price", "type": "double_sum"}, {"name": "count", "type": "count"}]}}}"""
    )
    assert indexer.real_time.kafka.earliest
    assert not indexer.real_time.parse.null_numeric_as_zero and indexer.real_time.parse.drops_bad_rows
    assert indexer.batch.channel.type == "kafka" and indexer.batch.period_millis == 3_600_000
    assert indexer.sort_of(table) == ("timestamp",)
    assert indexer.partitioning_of(table) is None
    assert table.columns == ["company", "timestamp", "s", "count"]


def test_types():
    kinds = {
        "string": "string", "numeric": "int", "time": "timestamp", "microtime": "timestamp", "byte": "tinyint",
        "ubyte": "smallint", "short": "smallint", "ushort": "int", "int": "int", "uint": "bigint",
        "long": "bigint", "ulong": "bigint", "float": "float", "double": "double",
    }
    for kind, spark_type in kinds.items():
        assert Dimension("d", type=kind).data_type.simpleString() == spark_type
    assert Dimension("d", type="numeric", max=2**31 - 2).data_type.simpleString() == "int"
    assert Dimension("d", type="numeric", max=2**31 - 1).data_type.simpleString() == "bigint"
    assert Metric("m", "bitset", max=2**40).data_type.simpleString() == "bigint"
    assert Metric("m", "bitset").data_type.simpleString() == "int"
    assert Metric("m", "byte_sum").store_type.simpleString() == "bigint"
    assert Metric("m", "byte_max").store_type.simpleString() == "tinyint"
    assert Metric("m", "float_avg").store_type.simpleString() == "double"


def test_refused_settings():
    for wrong in (
        lambda: Dimension("d", type="decimal"),
        lambda: Dimension("d", type="time", granularity="week"),
        lambda: Dimension("d", type="time", format="%Y %w"),
        lambda: Metric("m", "int_median"),
        lambda: Metric("m", "decimal_sum"),
        lambda: Metric("m", "sum"),
        lambda: ParseSpec(delimiter=""),
        lambda: ParseSpec(time_formats={"t": "%U"}),
        lambda: BatchSpec(period="P1M"),
        lambda: Partitioning((), 1),
        lambda: Partitioning(("a",), 0),
        lambda: TableSpec("t", (Dimension("a"),), (Metric("a", "count"),)),
        lambda: TableSpec("t", (Dimension("a"),), (Metric("b", "int_sum"),), Partitioning(("b",), 2)),
        lambda: TableSpec("t", (Dimension("a"),), (), sort_columns=("z",)),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_synthetic_count_column():
    assert TableSpec("t", (Dimension("a"),), ()).columns == ["a", ROLLUP_COUNT]
    assert TableSpec("t", (Dimension("a"),), (Metric("n", "count"), Metric("s", "int_sum"))).columns == ["a", "n", "s"]


def test_input_schema():
    one = TableSpec("one", (Dimension("a"), Dimension("b", type="int")), (Metric("n", "count"),))
    two = TableSpec("two", (Dimension("a"),), (Metric("x", "int_sum", field="b"), Metric("y", "int_max", field="b")))
    assert input_schema([one, two]).simpleString() == "struct<a:string,b:int>"
    with pytest.raises(ValueError, match="b"):
        input_schema([one, TableSpec("three", (), (Metric("b", "long_sum"),))])


def test_time_patterns():
    assert print_pattern("%Y-%m-%dT%H:%M:%S%z") == "yyyy-MM-dd'T'HH:mm:ssZ"
    assert print_pattern("%Y-%m-%dT%H:%M:%S.%f%z") == "yyyy-MM-dd'T'HH:mm:ss.SSSZ"
    assert print_pattern("it's %Y") == "'it''s' yyyy"
    assert print_pattern("[%Y]") == "'['yyyy']'"
    assert print_pattern("%c") == "EEE MMM dd HH:mm:ss yyyy"
    assert read_pattern("%Y%m%d") == "yyyyMMdd"
    assert read_pattern("%Y-%m-%d %H") == "yyyy-M-d H"
    for wrong in ("%Y %m %d %w", "%U", "%W", "%Q", "%Y %"):
        with pytest.raises(ValueError):
            print_pattern(wrong)


def test_formats_that_keep_a_period():
    day, hour = 86_400_000, 3_600_000
    for spec in (None, "posix", "millis", "micros", "%Y-%m-%d", "%d %B %Y", "%Y%j"):
        assert TimeFormat.of(spec).keeps(day)
    for spec in ("%Y-%m", "%m-%d", "%y-%m-%d", "%H:%M"):
        assert not TimeFormat.of(spec).keeps(day)
    assert not TimeFormat.of("%Y-%m-%d").keeps(hour)
    assert not TimeFormat.of("%Y-%m-%d %I").keeps(hour)
    assert TimeFormat.of("%Y-%m-%d %I %p").keeps(hour)
    assert not TimeFormat.of("%Y-%m-%d %H").keeps(60_000)
    assert TimeFormat.of("%Y-%m-%d %H:%M").keeps(60_000)
    assert TimeFormat.of("%c").keeps(1_000)
    assert not TimeFormat.of("posix").keeps(1_500)
