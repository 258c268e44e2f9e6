"""Parsing of delimited and JSON records, times, clean-up and the line format.

The raw text of every query is printed by Spark from a whole test table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.text import clean_text
from rollmill.functions.timefmt import TimeFormat
from rollmill.operators.rollup import rerollup, rollup
from rollmill.sinks.store import to_lines
from rollmill.sources.records import good_records, parse_records, record_parser, refused_records
from rollmill.sources.store import parse_lines
from rollmill.spec import Dimension, Metric, ParseSpec, TableSpec, input_schema
from workloads.base import Workload, load, shown
from workloads.rollups import LINE_CUBE, LINE_METRICS_SQL

LINE_COLUMNS = (
    "l_orderkey",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)


def delimited(df: DataFrame, columns: tuple[str, ...], separator: str, **texts: Column) -> DataFrame:
    cells = (F.coalesce(texts.get(c, F.col(c).cast("string")), F.lit("")) for c in columns)
    return df.select(F.concat_ws(separator, *cells).alias("value"))


def line_text(spark: SparkSession, sf_dir: str, separator: str = "\t") -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return delimited(lines, LINE_COLUMNS, separator, l_shipdate=F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


LINE_PARSE = ParseSpec("tsv", columns=LINE_COLUMNS, time_formats={"l_shipdate": "%Y-%m-%d %H:%M:%S"})


def tsv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_records(line_text(spark, sf_dir), LINE_PARSE, input_schema([LINE_CUBE]))
    return shown(rows.transform(rollup(LINE_CUBE)), 2)


def other_delimiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delimiter that would be special in a pattern."""
    parse = ParseSpec(
        "tsv", columns=LINE_COLUMNS, delimiter="||", time_formats={"l_shipdate": "%Y-%m-%d %H:%M:%S"}
    )
    rows = parse_records(line_text(spark, sf_dir, "||"), parse, input_schema([LINE_CUBE]))
    return shown(rows.transform(rollup(LINE_CUBE)), 2)


# Dimension of every type: source expression of the raw text.
KIND_SOURCES = {
    "string": "l_returnflag",
    "numeric": "l_linenumber",
    "time": "l_shipdate",
    "microtime": "l_shipdate",
    "byte": "l_linenumber",
    "ubyte": "cast(l_quantity as int)",
    "short": "-l_linenumber",
    "ushort": "l_suppkey",
    "int": "l_partkey",
    "uint": "l_orderkey",
    "long": "-l_orderkey",
    "ulong": "l_partkey",
    "float": "l_discount",
    "double": "l_tax",
}
ALL_KINDS = TableSpec(
    "kinds",
    tuple(Dimension(f"d_{k}", type=k) for k in KIND_SOURCES),
    (Metric("price", "double_sum"), Metric("n", "count")),
)


def _kind_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return lines.select(
        *(F.expr(e).alias(f"d_{k}") for k, e in KIND_SOURCES.items()), F.col("l_extendedprice").alias("price")
    )


def tsv_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _kind_source(spark, sf_dir)
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxx") for c in ("d_time", "d_microtime")}
    raw = delimited(source, tuple(source.columns), "\t", **iso)
    rows = parse_records(raw, ParseSpec("tsv", columns=tuple(source.columns)), input_schema([ALL_KINDS]))
    return shown(rows.transform(rollup(ALL_KINDS)), 2)


def json_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as numbers, one of them as text, and one time as epoch millis."""
    source = _kind_source(spark, sf_dir).withColumns(
        {"d_microtime": F.unix_millis("d_microtime"), "d_int": F.col("d_int").cast("string")}
    )
    raw = source.select(F.to_json(F.struct("*")).alias("value"))
    rows = parse_records(raw, ParseSpec("json"), input_schema([ALL_KINDS]))
    return shown(rows.transform(rollup(ALL_KINDS)), 2)


EVENTS = TableSpec(
    "events",
    (Dimension("event_type"), Dimension("event_id", type="long")),
    (Metric("value", "double_sum"), Metric("n", "count")),
)


def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken numbers, short lines and bad times are dropped; the rest is kept."""
    events = load(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    whole = F.concat_ws("\t", F.col("event_id").cast("string"), value, "event_type")
    text = F.when(F.col("user_id") == 7, F.concat_ws("\t", F.col("event_id").cast("string"), value)).otherwise(whole)
    parse = ParseSpec("tsv", columns=("event_id", "value", "event_type"), skip_bad_rows=True)
    rows = parse_records(events.select(text.alias("value")), parse, input_schema([EVENTS]))
    return shown(rows.transform(rollup(EVENTS)), 4)


def pairs_parser(parse: ParseSpec, schema) -> object:
    """A custom parser: ``name=value`` pairs."""

    def run(df: DataFrame) -> DataFrame:
        pairs = df.select(F.str_to_map("value", F.lit(";"), F.lit("=")).alias("pairs"))
        return pairs.select(*(F.col("pairs")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields))

    return run


def custom_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    columns = ("event_id", "event_type", "value")
    text = F.concat_ws(";", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns))
    parse = ParseSpec(record_parser="workloads.parsing:pairs_parser")
    rows = parse_records(events.select(text.alias("value")), parse, input_schema([EVENTS]))
    return shown(rows.transform(rollup(EVENTS)), 4)


ORDERS = TableSpec(
    "orders",
    (
        Dimension("o_orderkey", type="long"),
        Dimension("o_orderstatus"),
        Dimension("o_orderdate", type="time"),
    ),
    (Metric("o_custkey", "int_sum"), Metric("o_totalprice", "double_sum"), Metric("n", "count")),
)


def json_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-level keys; times as ISO text."""
    orders = load(spark, sf_dir, "orders")
    docs = orders.select(F.to_json(F.struct("*")).alias("value"))
    rows = parse_records(docs, ParseSpec("json"), input_schema([ORDERS]))
    return shown(rows.transform(rollup(ORDERS)), 2)


def json_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent strings become empty and absent numbers zero, which the minimum shows."""
    table = TableSpec(
        "absent",
        (Dimension("o_orderstatus"),),
        (
            Metric("low", "double_min", field="o_totalprice"),
            Metric("total", "double_sum", field="o_totalprice"),
            Metric("n", "count"),
        ),
    )
    orders = load(spark, sf_dir, "orders").withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_totalprice")),
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("F")),
        }
    )
    absent = orders.select(F.to_json(F.struct("o_orderstatus", "o_totalprice")).alias("value"))
    rows = parse_records(absent, ParseSpec("json"), input_schema([table]))
    return shown(rows.transform(rollup(table)), 2)


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents around the JSON text of ``props``."""
    head = F.concat(F.lit('{"meta": {"type": "'), F.col("event_type"), F.lit('", "tags": ["x", "y"]}, "payload": '))
    tail = F.concat(F.col("props"), F.lit(', "value": '), F.col("value").cast("string"), F.lit("}"))
    return load(spark, sf_dir, "events").select(F.concat(head, tail).alias("value"))


NESTED = TableSpec(
    "nested",
    (Dimension("type"), Dimension("tag")),
    (
        Metric("k_sum", "int_sum", field="k"),
        Metric("k_max", "int_max", field="k"),
        Metric("value", "double_sum"),
        Metric("n", "count"),
    ),
)
NESTED_PARSE = ParseSpec(
    "json",
    field_mapping={"type": "$.meta.type", "tag": "$.meta.tags[1]", "k": "$.payload.k", "value": "$.value"},
)


def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_records(event_docs(spark, sf_dir), NESTED_PARSE, input_schema([NESTED]))
    return shown(rows.transform(rollup(NESTED)), 4)


ORDER_LISTS = {
    "parts": "$.lines[*].part",
    "quantities": "$..qty",
    "large": "$.lines[?(@.qty > 30 && @.flag != 'R')].no",
    "last": "$.lines[-1].no",
    "first_two": "$.lines[:2].no",
    "shipped": "$['lines'][*].ship.by",
}
ORDER_LINES = TableSpec(
    "order_lines",
    (Dimension("order", type="long"), *(Dimension(n) for n in ORDER_LISTS)),
    (Metric("orders", "count"),),
)


def json_path_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of values that paths find in orders with their lines; some lines lack a member, some orders
    have a null for their lines."""
    line = F.struct(
        F.col("l_linenumber").alias("no"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("qty"),
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linestatus") == "O", F.struct(F.col("l_suppkey").alias("by"))).alias("ship"),
    )
    lines = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order"))
    lines = lines.agg(F.array_sort(F.collect_list(line)).alias("lines"))
    some = F.when(F.col("order") % 10 > 0, F.col("lines")).alias("lines")
    docs = lines.select(F.to_json(F.struct("order", some), {"ignoreNullFields": "true"}).alias("value"))
    parse = ParseSpec("json", field_mapping={"order": "$.order", **ORDER_LISTS})
    return parse_records(docs, parse, input_schema([ORDER_LINES])).transform(rollup(ORDER_LINES))


WEEK_TEXTS = {"sunday": "%Y-%U-%w", "monday": "%Y/%W/%A", "start": "%Y w%W", "both": "%Y%m%d %U %W %w"}


BROKEN_PARSE = ParseSpec("json", null_string_as_empty=False, null_numeric_as_zero=False)


def broken_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents: some whole, some without a field, with one of another kind, or no document."""
    kind = F.col("event_id") % 10
    fields = F.struct(
        F.when(kind != 1, F.col("event_id")).alias("event_id"),
        F.when(kind == 2, "many").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(~kind.isin(1, 3), F.col("event_type")).alias("event_type"),
    )
    doc = F.when(kind == 4, F.lit("{ no end")).when(kind == 5, F.lit("[]")).otherwise(F.to_json(fields))
    return load(spark, sf_dir, "events").select(doc.alias("value"))


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records broke each rule, by field, beside what the good ones roll up to."""
    parsed = broken_docs(spark, sf_dir).transform(record_parser(BROKEN_PARSE, input_schema([EVENTS]), reasons=True))
    reasons = refused_records(parsed).select(F.explode("reasons").alias("r")).select("r.field", "r.rule")
    broken = reasons.groupBy("field", "rule").agg(F.count(F.lit(1)).alias("n"))
    good = good_records(parsed, BROKEN_PARSE).transform(rollup(EVENTS)).groupBy("event_type")
    good = good.agg(F.sum("n").alias("n")).select(F.col("event_type").alias("field"), F.lit("good").alias("rule"), "n")
    return broken.unionByName(good)


def week_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ship date printed by weeks, and read back from that."""
    days = load(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("lines"))
    printed = days.select("*", *(TimeFormat.of(f).format(F.col("day")).alias(n) for n, f in WEEK_TEXTS.items()))
    read = [TimeFormat.of(f).parse(F.col(n)).alias(f"{n}_read") for n, f in WEEK_TEXTS.items()]
    return shown(printed.select("*", *read))


def json_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a byte field holds: numbers are cut, text is read, null is zero; a number out of range,
    a boolean and broken JSON drop the record."""
    table = TableSpec("kinds", (Dimension("event_type"),), (Metric("b", "byte_sum"), Metric("n", "count")))
    held = (
        F.when(F.col("event_type") == "view", F.lit("3.7"))
        .when(F.col("event_type") == "click", F.lit('"15"'))
        .when(F.col("event_type") == "purchase", F.when(F.col("user_id") > 50, "300").otherwise("null"))
        .when(F.col("event_type") == "error", F.when(F.col("user_id") > 50, "true").otherwise("-7"))
        .otherwise(F.when(F.col("user_id") > 50, F.lit("{broken")).otherwise(F.lit("1e1")))
    )
    docs = load(spark, sf_dir, "events").select(
        F.concat(F.lit('{"event_type": "'), F.col("event_type"), F.lit('", "b": '), held, F.lit("}")).alias("value")
    )
    return parse_records(docs, ParseSpec("json"), input_schema([table])).transform(rollup(table))


# Field -> (job time format, Spark expression that prints the raw text, unit it keeps in DuckDB).
TIME_TEXTS = {
    "t_iso": (None, "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")", "microsecond"),
    "t_epoch": (None, "cast(unix_millis(ts) as string)", "millisecond"),
    "t_posix": ("posix", "cast(unix_seconds(ts) as string)", "second"),
    "t_millis": ("millis", "cast(unix_millis(ts) as string)", "millisecond"),
    "t_micros": ("micros", "cast(unix_micros(ts) as string)", "microsecond"),
    "t_text": ("%Y-%m-%d %H:%M:%S", "date_format(ts, 'yyyy-M-d H:m:s')", "second"),
    "t_milli_text": ("%Y-%m-%dT%H:%M:%S.%f%z", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSxx\")", "millisecond"),
    "t_micro_text": ("%Y%m%d%H%M%S.%f", "date_format(ts, 'yyyyMMddHHmmss.SSSSSS')", "microsecond"),
    "t_clock": ("%d %b %y %I:%M %p", "date_format(ts, 'dd MMM yy hh:mm a')", "minute"),
    "t_named": ("%A, %B %d, %Y", "date_format(ts, 'EEEE, MMMM dd, yyyy')", "day"),
    "t_day_of_year": ("%Y/%j", "date_format(ts, 'yyyy/DDD')", "day"),
    "t_ctime": ("%c", "date_format(ts, 'EEE MMM dd HH:mm:ss yyyy')", "second"),
    "t_us": ("%x %X", "date_format(ts, 'MM/dd/yy HH:mm:ss')", "second"),
}


def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = TableSpec(
        "times",
        (Dimension("event_id", type="long"), *(Dimension(n, type="microtime") for n in TIME_TEXTS)),
        (),
    )
    parse = ParseSpec(
        "tsv",
        columns=("event_id", *TIME_TEXTS),
        time_formats={n: f for n, (f, _, _) in TIME_TEXTS.items() if f},
    )
    texts = {n: F.expr(text) for n, (_, text, _) in TIME_TEXTS.items()}
    raw = delimited(load(spark, sf_dir, "events"), ("event_id", *TIME_TEXTS), "\t", **texts)
    return shown(parse_records(raw, parse, input_schema([table])))


# Format -> DuckDB expression that prints the same text.
TIME_PRINTS = {
    "p_none": (None, "CAST(epoch_us(ts) // 1000 AS VARCHAR)"),
    "p_posix": ("posix", "CAST(epoch_us(ts) // 1000000 AS VARCHAR)"),
    "p_micros": ("micros", "CAST(epoch_us(ts) AS VARCHAR)"),
    "p_full": ("%Y-%m-%dT%H:%M:%S.%f%z", "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+0000')"),
    "p_literal": ("day %d of '%b' %Y", "strftime(ts, 'day %d of ''%b'' %Y')"),
    "p_named": ("%a %A %B %y %j %I %p", "strftime(ts, '%a %A %B %y %j %I %p')"),
    "p_ctime": ("%c", "strftime(ts, '%a %b %d %H:%M:%S %Y')"),
    "p_us": ("%x %X%%", "strftime(ts, '%m/%d/%y %H:%M:%S%%')"),
}


def time_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return events.select(
        "event_id", *(TimeFormat.of(f).format(F.col("ts")).alias(n) for n, (f, _) in TIME_PRINTS.items())
    )


def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    return documents.select("doc_id", clean_text(F.col("text")).alias("text"))


def line_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolled-up rows to store lines and back, exactly."""
    rows = load(spark, sf_dir, "orders").transform(rollup(ORDERS))
    return shown(parse_lines(to_lines(rows, ORDERS), ORDERS))


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text as a dimension: stored lines never break, empty strings stay."""
    table = TableSpec("texts", (Dimension("source"), Dimension("text")), (Metric("n", "count"),))
    rows = load(spark, sf_dir, "documents").transform(rollup(table))
    again = parse_lines(to_lines(rows, table), table)
    return again.transform(rerollup(table))


def _all_kinds_sql() -> str:
    kinds = {
        "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "bigint": "BIGINT", "string": "VARCHAR",
        "timestamp": "TIMESTAMP", "float": "DOUBLE", "double": "DOUBLE",
    }
    shown_as = {f"d_{k}": kinds[d.data_type.simpleString()] for k, d in zip(KIND_SOURCES, ALL_KINDS.dimensions)}
    columns = ", ".join(f"CAST({KIND_SOURCES[n[2:]]} AS {t}) AS {n}" for n, t in shown_as.items())
    return f"SELECT {columns}, round(sum(l_extendedprice), 2) AS price, count(*) AS n FROM lineitem GROUP BY ALL"


_CLEAN = r"""regexp_replace(regexp_replace(text, '[\t\n\r\x00\\]', '', 'g'), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"""

WORKLOADS = {
    "tsv_parse": Workload(
        tsv_parse,
        f"""SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
                   CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS shipdate, {LINE_METRICS_SQL}
            FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "other_delimiter": Workload(
        other_delimiter,
        f"""SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
                   CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS shipdate, {LINE_METRICS_SQL}
            FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "tsv_all_types": Workload(tsv_all_types, _all_kinds_sql()),
    "json_all_types": Workload(json_all_types, _all_kinds_sql()),
    "bad_records": Workload(
        bad_records,
        """SELECT event_type, event_id, round(sum(value), 4) AS value, count(*) AS n FROM events
           WHERE event_type <> 'error' AND user_id <> 7 GROUP BY 1, 2""",
    ),
    "custom_parser": Workload(
        custom_parser,
        "SELECT event_type, event_id, round(sum(value), 4) AS value, count(*) AS n FROM events GROUP BY 1, 2",
    ),
    "json_flat": Workload(
        json_flat,
        """SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(sum(o_custkey) AS BIGINT) AS o_custkey,
                  round(sum(o_totalprice), 2) AS o_totalprice, count(*) AS n
           FROM orders GROUP BY 1, 2, 3""",
    ),
    "json_absent": Workload(
        json_absent,
        """SELECT coalesce(nullif(o_orderstatus, 'F'), '') AS o_orderstatus,
                  round(min(CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice ELSE 0 END), 2) AS low,
                  round(sum(CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice ELSE 0 END), 2) AS total,
                  count(*) AS n
           FROM orders GROUP BY 1""",
    ),
    "quarantine_reasons": Workload(
        quarantine_reasons,
        """WITH e AS (SELECT *, event_id % 10 AS kind FROM events),
                b AS (SELECT CASE WHEN kind IN (4, 5) THEN [{'f': NULL, 'r': 'not an object'}]
                                  WHEN kind = 1 THEN [{'f': 'event_type', 'r': 'absent'}, {'f': 'event_id', 'r': 'absent'}]
                                  WHEN kind = 2 THEN [{'f': 'value', 'r': 'not double'}]
                                  WHEN kind = 3 THEN [{'f': 'event_type', 'r': 'absent'}] END AS reasons FROM e)
           SELECT x.f AS field, x.r AS rule, count(*) AS n FROM (SELECT unnest(reasons) AS x FROM b) GROUP BY 1, 2
           UNION ALL
           SELECT event_type, 'good', count(*) FROM e WHERE kind NOT IN (1, 2, 3, 4, 5) GROUP BY 1""",
    ),
    "week_dates": Workload(
        week_dates,
        """WITH d AS (SELECT date_trunc('day', l_shipdate)::DATE AS day, count(*) AS lines FROM lineitem GROUP BY 1)
           SELECT CAST(day AS TIMESTAMP) AS day, lines, strftime(day, '%Y-%U-%w') AS sunday, strftime(day, '%Y/%W/%A') AS monday,
                  strftime(day, '%Y w%W') AS start, strftime(day, '%Y%m%d %U %W %w') AS "both",
                  CAST(day AS TIMESTAMP) AS sunday_read, CAST(day AS TIMESTAMP) AS monday_read,
                  greatest(date_trunc('year', day), CAST(day - CAST(isodow(day) - 1 AS INTEGER) AS TIMESTAMP)) AS start_read,
                  CAST(day AS TIMESTAMP) AS both_read
           FROM d""",
    ),
    "json_path_wildcards": Workload(
        json_path_wildcards,
        """WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS place,
                             count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
                found AS (
             SELECT l_orderkey AS "order",
               string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY place) AS parts,
               string_agg(CAST(l_quantity AS VARCHAR), ', ' ORDER BY place) AS quantities,
               string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY place)
                 FILTER (l_quantity > 30 AND l_returnflag <> 'R') AS large,
               string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY place) FILTER (place = n) AS last,
               string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY place) FILTER (place <= 2) AS first_two,
               string_agg(CAST(l_suppkey AS VARCHAR), ', ' ORDER BY place) FILTER (l_linestatus = 'O') AS shipped
             FROM l GROUP BY 1)
           SELECT "order",
             '[' || CASE WHEN "order" % 10 > 0 THEN coalesce(parts, '') ELSE '' END || ']' AS parts,
             '[' || CASE WHEN "order" % 10 > 0 THEN coalesce(quantities, '') ELSE '' END || ']' AS quantities,
             '[' || CASE WHEN "order" % 10 > 0 THEN coalesce(large, '') ELSE '' END || ']' AS large,
             '[' || CASE WHEN "order" % 10 > 0 THEN coalesce(last, '') ELSE '' END || ']' AS last,
             '[' || CASE WHEN "order" % 10 > 0 THEN coalesce(first_two, '') ELSE '' END || ']' AS first_two,
             '[' || CASE WHEN "order" % 10 > 0 THEN coalesce(shipped, '') ELSE '' END || ']' AS shipped,
             count(*) AS orders
           FROM found GROUP BY ALL""",
    ),
    "json_path": Workload(
        json_path,
        """SELECT event_type AS type, 'y' AS tag, CAST(sum(k) AS BIGINT) AS k_sum, max(k) AS k_max,
                  round(sum(value), 4) AS value, count(*) AS n
           FROM (SELECT event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
           GROUP BY 1""",
    ),
    "json_kinds": Workload(
        json_kinds,
        """SELECT event_type, CAST(sum(b) AS BIGINT) AS b, count(*) AS n
           FROM (SELECT event_type, CASE event_type WHEN 'view' THEN 3 WHEN 'click' THEN 15
                                                    WHEN 'purchase' THEN 0 WHEN 'error' THEN -7 ELSE 10 END AS b
                 FROM events WHERE event_type IN ('view', 'click') OR user_id <= 50)
           GROUP BY 1""",
    ),
    "time_formats": Workload(
        time_formats,
        "SELECT event_id, "
        + ", ".join(f"CAST(date_trunc('{u}', ts) AS TIMESTAMP) AS {n}" for n, (_, _, u) in TIME_TEXTS.items())
        + " FROM events",
    ),
    "time_prints": Workload(
        time_prints,
        "SELECT event_id, " + ", ".join(f"{sql} AS {n}" for n, (_, sql) in TIME_PRINTS.items()) + " FROM events",
    ),
    "clean_strings": Workload(clean_strings, f"SELECT doc_id, {_CLEAN} AS text FROM documents"),
    "line_roundtrip": Workload(
        line_roundtrip,
        """SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(sum(o_custkey) AS BIGINT) AS o_custkey,
                  sum(o_totalprice) AS o_totalprice, count(*) AS n
           FROM orders GROUP BY 1, 2, 3""",
    ),
    "text_roundtrip": Workload(
        text_roundtrip,
        f"SELECT source, {_CLEAN} AS text, count(*) AS n FROM documents GROUP BY 1, 2",
    ),
}
