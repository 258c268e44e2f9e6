"""Delimited and JSON records, times, the line format."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rollmill.functions.text import clean_text
from rollmill.functions.timefmt import TimeFormat
from rollmill.sinks.store import to_lines
from rollmill.sources.records import BAD, parse_records, record_parser
from rollmill.sources.store import parse_lines
from rollmill.spec import Dimension, Metric, ParseSpec, TableSpec, input_schema

CLOCK = "%d.%m.%Y %H:%M"
METERS = (Dimension("meter", type="int"), Dimension("seen", type="time", format=CLOCK), Dimension("zone"))
FLOW = TableSpec("flow", METERS, (Metric("litres", "double_sum"), Metric("alarms", "short_max")))
# meter, time, zone, litres, alarms
READINGS = [
    (17, "2021-06-30 23:59:00", "harbour", 0.125, 0),
    (17, "2021-07-01 00:00:00", "harbour", 18.0, 3),
    (204, "2021-06-30 06:07:00", "", 2.5, 1),
    (204, "2021-07-01 06:07:00", "old town", 1e6, -2),
    (9000, "2020-02-29 12:30:00", "old town", -4.75, 0),
]


def clock(time):
    day, hour = time.split(" ")
    return ".".join(reversed(day.split("-"))) + " " + hour[:5]


def text(spark, lines):
    return spark.createDataFrame([(l,) for l in lines], "value STRING")


def parsed(spark, lines, table, parse):
    rows = parse_records(text(spark, lines), parse, input_schema([table]))
    times = [d.input_field for d in table.time_dimensions]
    return sorted(tuple(r) for r in rows.withColumns({t: F.col(t).cast("string") for t in times}).collect())


def test_tsv_readings(spark):
    """Columns in another order than fields, one of them unused."""
    lines = [f"{clock(t)}\t{z}\tserial-{m}\t{a}\t{v}\t{m}" for m, t, z, v, a in READINGS]
    columns = ("seen", "zone", "serial", "alarms", "litres", "meter")
    parse = ParseSpec("tsv", columns=columns, time_formats={"seen": CLOCK})
    assert parsed(spark, lines, FLOW, parse) == READINGS
    rows = parse_records(text(spark, lines), parse, input_schema([FLOW]))
    assert sorted(r[0] for r in to_lines(rows, FLOW).collect()) == [
        "17\t01.07.2021 00:00\tharbour\t18.0\t3",
        "17\t30.06.2021 23:59\tharbour\t0.125\t0",
        "204\t01.07.2021 06:07\told town\t1000000.0\t-2",
        "204\t30.06.2021 06:07\t\t2.5\t1",
        "9000\t29.02.2020 12:30\told town\t-4.75\t0",
    ]


def test_json_flat(spark):
    docs = [
        json.dumps({"litres": v, "meter": str(m), "seen": clock(t), "zone": z or None, "alarms": a, "unused": [1, {}]}, indent=a)
        for m, t, z, v, a in READINGS
        if a >= 0
    ]
    want = [r for r in READINGS if r[-1] >= 0]
    assert parsed(spark, docs, FLOW, ParseSpec("json", time_formats={"seen": CLOCK})) == want


def test_json_paths_and_a_broken_document(spark):
    nested = [
        json.dumps({"who": [{"meter": m}, {"zone": {"name": z}}], "clock": {"day": {"seen": clock(t)}}, "sum": [[v, a]]})
        for m, t, z, v, a in READINGS
    ]
    broken = nested[0][:-9]
    mapping = {
        "meter": "$.who[0].meter",
        "seen": "$.clock.day['seen']",
        "zone": "$.who[1].zone.name",
        "litres": "$.sum[0][0]",
        "alarms": '$["sum"][0][1]',
    }
    parse = ParseSpec("json", field_mapping=mapping, time_formats={"seen": CLOCK})
    assert parsed(spark, [*nested, broken], FLOW, parse) == READINGS
    strict = ParseSpec("json", field_mapping=mapping, time_formats={"seen": CLOCK}, skip_bad_rows=False)
    with pytest.raises(Exception, match="could not be parsed"):
        parsed(spark, [*nested, broken], FLOW, strict)
    for wrong in ({"meter": "$.a"}, {**mapping, "zone": "$..zone["}, {**mapping, "zone": "$.a[?(x)]"}):
        with pytest.raises(ValueError):
            record_parser(ParseSpec("json", field_mapping=wrong), input_schema([FLOW]))


KINDS = ("string", "numeric", "time", "microtime", "byte", "ubyte", "short", "ushort", "int", "uint", "long", "ulong", "float", "double")


def test_json_types(spark):
    widths = KINDS[4:]
    table = TableSpec(
        "t",
        tuple(Dimension(k, type=k) for k in KINDS),
        (Metric("count", "count"), *(Metric(f"{w}_sum", f"{w}_sum") for w in widths)),
    )
    numbers = [-77, 201, -3021, 60123, -70001, 3_100_000_000, -88_000_000_001, 9_000_000_001, 0.75, 2.71875]
    cells = [f'"{k}": {v}' for k, v in zip([*widths, *(f"{w}_sum" for w in widths)], numbers * 2)]
    head = '"string": "zinc", "numeric": 41, "time": "2022-11-30T22:15:45+0100", "microtime": "2022-11-30T22:15:45.678-0230"'
    for quoted in (False, True):
        body = [c.replace(": ", ': "') + '"' for c in cells] if quoted else cells
        rows = parse_records(text(spark, ["{" + ", ".join([head, *body]) + "}"]), ParseSpec("json"), input_schema([table]))
        assert [t for _, t in rows.dtypes] == [
            "string", "int", "timestamp", "timestamp",
            *(["tinyint", "smallint", "smallint", "int", "int", "bigint", "bigint", "bigint", "float", "double"] * 2),
        ]
        row = rows.withColumns({c: F.unix_millis(c) for c in ("time", "microtime")}).first()
        assert tuple(row)[:12] == ("zinc", 41, 1669842945000, 1669855545678, *numbers[:8])
        assert row["double"] == 2.71875 and row["float"] == 0.75


def one(spark, doc, kind="int", **parse):
    table = TableSpec("t", (Dimension("x", type=kind),), ())
    rows = text(spark, [doc]).transform(record_parser(ParseSpec("json", **parse), input_schema([table]))).collect()
    assert len(rows) == 1
    return "bad" if rows[0][BAD] else rows[0]["x"]


def test_json_values(spark):
    assert one(spark, '{"x": 3.7}') == 3
    assert one(spark, '{"x": "15"}') == 15
    assert one(spark, '{"x": "3.7"}') == "bad"
    assert one(spark, '{"x": true}') == "bad"
    assert one(spark, '{"x": [1]}') == "bad"
    assert one(spark, '{"x": 300}', "byte") == "bad"
    assert one(spark, '{"x": 1e1}', "byte") == 10
    assert one(spark, '{"x": null}') == 0 and one(spark, "{}") == 0
    assert one(spark, "{}", null_numeric_as_zero=False) == "bad"
    assert one(spark, '{"x": 1, "x": 2}') == 2
    assert one(spark, '{"x": 1} trailing') == 1
    assert one(spark, " \n{}") == 0
    for broken in ("[1]", "null", "", "7", "{"):
        assert one(spark, broken) == "bad"


def test_json_strings(spark):
    assert one(spark, '{"x": null}', "string") == "" and one(spark, "{}", "string") == ""
    assert one(spark, "{}", "string", null_string_as_empty=False) == "bad"
    for held, shown in (("12", "12"), ("1.5", "1.5"), ("2.0", "2.0"), ("true", "true"), ("1e10", "1.0E10"), ("12345678901234567890123", "12345678901234567890123")):
        assert one(spark, '{"x": %s}' % held, "string") == shown


def test_json_times(spark):
    def millis(doc, **parse):
        found = one(spark, doc, "time", **parse)
        return found if found == "bad" else int(found.timestamp() * 1000)

    posix = {"time_formats": {"x": "posix"}}
    assert millis('{"x": 1700000007891}') == 1700000007891
    assert millis('{"x": 1700000007891}', **posix) == 1700000007891  # a number is millis whatever the format
    assert millis('{"x": "1700000007"}', **posix) == 1700000007000
    assert millis('{"x": "1700000007891"}') == 1700000007891
    assert millis('{"x": "2019-01-05T01:02:03.123Z"}') == 1546650123123
    for wrong in ('{"x": true}', '{"x": null}', "{}", '{"x": "soon"}'):
        assert millis(wrong) == "bad"


def flags(spark, lines, **parse):
    table = TableSpec("t", (Dimension("s"), Dimension("n", type="byte")), ())
    spec = ParseSpec("tsv", columns=("s", "n"), **parse)
    return [tuple(r) for r in text(spark, lines).transform(record_parser(spec, input_schema([table]))).collect()]


def test_delimited_lines(spark):
    assert flags(spark, ["a\t1", "\t-7", "a\t300", "a\tx", "a\t", "a", None, "b\t2\tmore"]) == [
        ("a", 1, False), ("", -7, False), ("a", None, True), ("a", None, True), ("a", None, True), ("a", None, True),
        (None, None, True), ("b", 2, False),
    ]
    for delimiter in ("|", ".", "||", ",", "\\", "^", "\\E"):
        assert flags(spark, [f"a{delimiter}1"], delimiter=delimiter) == [("a", 1, False)]
    with pytest.raises(ValueError, match="missing"):
        record_parser(ParseSpec("tsv", columns=("a",)), input_schema([FLOW]))
    with pytest.raises(ValueError, match="no parser"):
        record_parser(ParseSpec(), input_schema([FLOW]))


def test_parse_runs_once(spark):
    """Selecting good records must not repeat the parse in a pushed-down filter."""
    for parse in (ParseSpec("json"), ParseSpec("tsv", columns=tuple(input_schema([FLOW]).names))):
        rows = parse_records(text(spark, ["{}"]), parse, input_schema([FLOW]))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") + plan.count("split(") == 1
        assert "Filter" not in plan


def test_epoch_formats(spark):
    row = spark.sql("SELECT '1700000007' AS s, '1700000007891' AS m, '1700000007891234' AS u").select(
        F.unix_micros(TimeFormat.of("posix").parse(F.col("s"))),
        F.unix_micros(TimeFormat.of("millis").parse(F.col("m"))),
        F.unix_micros(TimeFormat.of("micros").parse(F.col("u"))),
    )
    assert tuple(row.first()) == (1700000007000000, 1700000007891000, 1700000007891234)


def test_time_texts(spark):
    def read(spec, value):
        df = text(spark, [value]).select(TimeFormat.of(spec).parse(F.col("value")).cast("string"))
        return df.first()[0]

    assert read("%Y-%m-%dT%H:%M:%S.%f%z", "2019-01-05T01:02:03.123+0000") == "2019-01-05 01:02:03.123"
    assert read("%Y-%m-%dT%H:%M:%S.%f%z", "2019-01-05T01:02:03.123456+0000") == "2019-01-05 01:02:03.123456"
    assert read("%Y-%m-%dT%H:%M:%S.%f%z", "2019-01-05T01:02:03.123+0200") == "2019-01-04 23:02:03.123"
    assert read("%Y-%m-%d", "2015-1-1") == "2015-01-01 00:00:00"
    assert read("%Y%m%d", "20150102") == "2015-01-02 00:00:00"
    assert read("%Y-%m-%d", "2015-13-01") is None
    assert read("%Y-%m-%d", "2015-01-02T10:11:12Z") == "2015-01-02 00:00:00"
    assert read("%Y-%m-%d %H:%M:%S", "2015-1-2 10:11:12.345") == "2015-01-02 10:11:12"
    assert read("%d.%m.%Y %I %p", "02.01.2015 10 pm sharp") == "2015-01-02 22:00:00"
    assert read("%Y%m%d.%f", "20150102.123456789") == "2015-01-02 00:00:00.123456"
    with pytest.raises(ValueError, match="separator"):
        TimeFormat.of("%Y%m%d%f")
    assert read("%b %d %Y (%z)", "Jan 02 2015 (+0100) x") == "2015-01-01 23:00:00"
    for wrong in ("x2015-01-02", "2015-01", "", "2015/01/02"):
        assert read("%Y-%m-%d", wrong) is None
    assert read("%A %d %b %Y", "Wednesday 07 Jan 2015") == "2015-01-07 00:00:00"
    assert read("%a, %d %b %Y", "Wed, 07 Jan 2015") == "2015-01-07 00:00:00"
    assert read("%y-%m-%d", "97-02-03") == "1997-02-03 00:00:00"
    assert read("%y-%m-%d", "17-02-03") == "2017-02-03 00:00:00"
    assert read("%I:%M %p %d.%m.%Y", "12:05 PM 01.02.2003") == "2003-02-01 12:05:00"
    assert read("%Y-%m-%d %H:%M:%S %Z", "1969-12-31 23:59:59 UTC") == "1969-12-31 23:59:59"


def test_clean_text(spark):
    lines = ["a\tb\nc\rd\x00e\\f", "\x01\x1f hello \x7f ", " ", "", "\\ x", " é "]
    assert [r[0] for r in text(spark, lines).select(clean_text(F.col("value"))).collect()] == [
        "abcdef", "hello \x7f", "", "", "x", " é",
    ]


def test_store_lines(spark):
    table = TableSpec(
        "t",
        (Dimension("s"), Dimension("t", type="time"), Dimension("d", type="time", format="%Y-%m", granularity="month")),
        (Metric("f", "float_max"), Metric("x", "double_sum"), Metric("n", "count")),
    )
    df = spark.sql(
        "SELECT ' a\\tb ' AS s, timestamp_millis(-1) AS t, DATE'2020-02-01' AS d, float(0.1) AS f, 1e10D AS x, 3L AS n "
        "UNION ALL SELECT null, timestamp_micros(1500), null, float('NaN'), null, 4L"
    )
    lines = sorted(r[0] for r in to_lines(df, table).collect())
    assert lines == ["\t1\tnull\tNaN\tnull\t4", "ab\t-1\t2020-02\t0.1\t1.0E10\t3"]
    again = parse_lines(text(spark, lines), table)
    assert again.schema.simpleString() == table.store_schema.simpleString()
    assert sorted(r[0] for r in to_lines(again, table).collect()) == lines
    for damaged in ("ab\t-1\t2020-02\t0.1\t1.0E10", "ab\t-1\t2020-02\t0.1\t1.0E10\tx", "ab\tx\t2020-02\t0.1\t1.0\t3"):
        with pytest.raises(Exception, match="cannot read"):
            parse_lines(text(spark, [damaged]), table).collect()


WEEK_FORMATS = ["%Y-%U-%w", "%Y-%W-%w", "%Y %U, %A", "%a %W of %Y", "%H:%M week %W day %w in %Y", "%Y%m%d %U %W %w", "%j/%Y w%W"]


def test_weeks_of_thirty_years(spark):
    """Every day printed as strftime does, and read back."""
    days = spark.sql(
        "SELECT explode(sequence(TIMESTAMP'2000-01-01 07:45:00', TIMESTAMP'2030-12-31 07:45:00', INTERVAL 1 DAY)) AS t"
    )
    shown = [TimeFormat.of(f).format(F.col("t")).alias(f"p{i}") for i, f in enumerate(WEEK_FORMATS)]
    printed = days.select("t", *shown)
    read = [TimeFormat.of(f).parse(F.col(f"p{i}")).alias(f"r{i}") for i, f in enumerate(WEEK_FORMATS)]
    rows = printed.select("*", *read).select(*(F.col(c).cast("string") for c in [*printed.columns, *(f"r{i}" for i in range(len(read)))])).collect()
    assert len(rows) == 11323
    for row in rows:
        time = datetime.fromisoformat(row["t"])
        for i, spec in enumerate(WEEK_FORMATS):
            assert row[f"p{i}"] == time.strftime(spec)
            back = time if "%H" in spec else datetime(time.year, time.month, time.day)
            assert row[f"r{i}"] == str(back)


@pytest.mark.parametrize(
    "spec, text, want",
    [
        ("%Y-%U-%w", "2021-00-6", "2021-01-02 00:00:00"),
        ("%Y-%U-%w", "2021-7-0", "2021-02-14 00:00:00"),
        ("%Y-%W-%w", "2021-07-0 and more", "2021-02-21 00:00:00"),
        ("%Y-%W", "2021-07", "2021-02-15 00:00:00"),
        ("%Y-%W", "2021-00", "2021-01-01 00:00:00"),
        ("%Y-%U", "2023-01", "2023-01-01 00:00:00"),
        ("%Y %U %a", "2021 07 Wednes", "2021-02-17 00:00:00"),
        ("%Y %U %a", "2021 07 noday", None),
        ("%Y-%U-%w", "2021-54-1", None),
        ("%Y-%U-%w", "2021-10-7", None),
        ("%Y-%U-%w", "week", None),
        ("%Y-%U-%w", "", None),
        ("%Y-%U-%w %I:%M %p", "2021-07-0 11:05 PM", "2021-02-14 23:05:00"),
        ("%Y-%U-%w %H.%f %z", "2021-07-0 11.250 +0200", "2021-02-14 09:00:00.25"),
        ("%d.%m.%Y (%w)", "14.2.2021 (3)", "2021-02-14 00:00:00"),
    ],
)
def test_reading_weeks(spark, spec, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(TimeFormat.of(spec).parse(F.col("t")).cast("string")).first()[0]
    assert got == want


def test_weeks_that_decide_nothing():
    for wrong in ("%Y %w", "%U", "%y %U %w", "%Y %U %U", "%U %w"):
        with pytest.raises(ValueError):
            TimeFormat.of(wrong)
    assert TimeFormat.of("%Y-%U-%w").keeps(86_400_000) and not TimeFormat.of("%Y-%U").keeps(86_400_000)
