"""Raw text records to typed input fields, as column expressions only.

A parser turns a DataFrame with a ``value`` column (batch or streaming) into the input fields plus
the flag ``__bad``; other columns pass through. A field that cannot be converted is NULL, and a
record with a NULL field is bad. Asked for reasons, a parser also tells which fields made a record bad
and by which rule (``__reasons``), and keeps the raw text of bad records (``__raw``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.functions.jsonpath import DEFINITE, compile_path, depth_of, split_head
from rollmill.functions.timefmt import TimeFormat
from rollmill.operators.chain import load_hook
from rollmill.spec import ParseSpec

BAD = "__bad"
REASONS = "__reasons"
RAW = "__raw"
REASONS_TYPE = "array<struct<field: string, rule: string>>"
# Rules a record can break; a value that does not fit breaks ``not <type>``.
ABSENT, NO_OBJECT, OWN_PARSER = "absent", "not an object", "refused by the parser"
VALUE = "value"
_DOC = "__doc"
_DEPTH = "__depth"
_CELLS = "__cells"
_TOP = "__top"
_KEPT = "__kept"

_TOP_KEY = re.compile(r"""^\$(?:\.([A-Za-z_][\w\-]*)|\['([^']+)'\]|\["([^"]+)"\])$""")
# Keys asked for, from which one pass over all keys of a document is read; a wide one with few is searched.
STRUCT_FROM = 8

RecordParser = Callable[[DataFrame], DataFrame]

_REGEX_META = set(".$|()[{^?*+\\")


def split_pattern(delimiter: str) -> str:
    """Pattern for a literal delimiter. One character, escaped or not, is split without a regex engine."""
    return "".join(f"\\{c}" if c in _REGEX_META else c for c in delimiter)


def convert_text(text: Column, kind: T.DataType, fmt: TimeFormat) -> Column:
    """STRING to the field type; NULL where it does not fit."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampType):
        return fmt.parse(text)
    return text.try_cast(kind)


def _flag(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = reduce(lambda a, b: a | b, (F.isnull(f"`{n}`") for n in schema.names), F.lit(False))
    return df.withColumn(BAD, missing)


def _others(df: DataFrame, schema: T.StructType) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c != VALUE and c not in schema.names]


def _reason(field: str | None, rule: Column) -> Column:
    return F.struct(F.lit(field).cast("string").alias("field"), rule.alias("rule"))


def _reasons(schema: T.StructType, absent: Callable[[int], Column], whole: Column | None = None) -> Column:
    """What is wrong with a record: ``absent`` tells of a field whether the record has nothing for it, ``whole``
    that the record cannot be read at all."""
    found = [
        F.when(
            F.isnull(f"`{f.name}`"),
            _reason(f.name, F.when(absent(i), ABSENT).otherwise(f"not {f.dataType.simpleString()}")),
        )
        for i, f in enumerate(schema.fields)
    ]
    by_field = F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array()
    by_field = by_field.cast(REASONS_TYPE)
    if whole is None:
        return by_field
    return F.when(whole, F.array(_reason(None, F.lit(NO_OBJECT))).cast(REASONS_TYPE)).otherwise(by_field)


def delimited_parser(parse: ParseSpec, schema: T.StructType, reasons: bool = False) -> RecordParser:
    """Fields by the position of their name in ``parse.columns``; empty cells are kept."""
    columns = parse.columns or ()
    unknown = [n for n in schema.names if n not in columns]
    if unknown:
        raise ValueError(f"fields missing from the column list: {', '.join(unknown)}")

    def run(df: DataFrame) -> DataFrame:
        cells = F.split(F.col(VALUE), split_pattern(parse.delimiter), -1)
        typed = [
            convert_text(
                F.get(F.col(_CELLS), F.lit(columns.index(f.name))),
                f.dataType,
                TimeFormat.of(parse.time_formats.get(f.name)),
            ).alias(f.name)
            for f in schema.fields
        ]
        cut = df.withColumn(_CELLS, cells)
        if not reasons:
            return _flag(cut.select(*typed, *_others(df, schema)), schema)
        out = _flag(cut.select(*typed, F.size(_CELLS).alias(_CELLS), *_others(df, schema)), schema)
        places = [columns.index(n) for n in schema.names]
        # a null record has no cells
        missing = lambda i: F.coalesce(F.col(_CELLS) <= places[i], F.lit(True))
        return out.withColumn(REASONS, _reasons(schema, missing)).drop(_CELLS)

    return run


def json_paths(parse: ParseSpec, schema: T.StructType) -> dict[str, str]:
    """Path of every input field: its mapping, or the top-level key of its own name."""
    if parse.field_mapping is None:
        return {n: f'$["{n}"]' if "'" in n else f"$['{n}']" for n in schema.names}
    unmapped = [n for n in schema.names if n not in parse.field_mapping]
    if unmapped:
        raise ValueError(f"fields without a path: {', '.join(unmapped)}")
    paths = {n: parse.field_mapping[n] for n in schema.names}
    for path in paths.values():
        if not DEFINITE.match(path):
            compile_path(path)  # complains of what it cannot read
    return paths


def _as_text(held: Column, kind: Column) -> Column:
    """A single value as text: fractions print as Java doubles do (2 -> 2.0); only 19 and more digits can
    be a whole number."""
    fraction = kind.startswith("DECIMAL") & ~kind.rlike(r"^DECIMAL\((?:19|[23]\d),0\)$")
    return F.when(fraction, F.try_variant_get(held, "$", "double").cast("string")).otherwise(
        F.try_variant_get(held, "$", "string")
    )


def list_text(values: Column) -> Column:
    """Values found by a path, as text: ``[a, 2.5, null]``; arrays and objects inside as JSON."""

    def shown(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
        whole = kind == "BIGINT"  # prints as JSON, too, which is the cheaper way
        text = F.when(whole | nested, F.to_json(value)).otherwise(_as_text(value, kind))
        return F.coalesce(text, F.lit("null"))

    return F.concat(F.lit("["), F.array_join(F.transform(values, shown), ", "), F.lit("]"))


def _json_field(held: Column, kind: Column, field: T.StructField, parse: ParseSpec) -> Column:
    """Typed value of what the document holds at a path; ``kind`` is the name of its type there."""
    absent = F.col(_DOC) & (kind.isNull() | (kind == "VOID"))

    def read(as_type: str) -> Column:
        return F.try_variant_get(held, "$", as_type)

    if isinstance(field.dataType, T.StringType):
        text = _as_text(held, kind)
        return F.when(absent, F.lit("")).otherwise(text) if parse.null_string_as_empty else text
    if isinstance(field.dataType, T.TimestampType):
        # a number is epoch millis whatever the format says
        number = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
        fmt = TimeFormat.of(parse.time_formats.get(field.name))
        return F.when(number, F.timestamp_millis(read("bigint"))).when(
            kind == "STRING", fmt.parse(read("string"))
        )
    value = F.when(kind != "BOOLEAN", read(field.dataType.simpleString()))
    if parse.null_numeric_as_zero:
        value = F.when(absent, F.lit(0).cast(field.dataType)).otherwise(value)
    return value


def _list_field(text: Column, field: T.StructField) -> Column:
    return text if isinstance(field.dataType, T.StringType) else F.lit(None).cast(field.dataType)


def top_keys(paths: dict[str, str]) -> dict[str, str]:
    """Path to key, for paths that are one key of the document: those read as one struct, whose names must
    differ by more than case. Few keys are searched, as documents may have many more."""
    keys: dict[str, str] = {}
    for path in dict.fromkeys(paths.values()):
        found = _TOP_KEY.match(path)
        key = found and next(filter(None, found.groups()))
        if key and key.upper().lower() not in (k.upper().lower() for k in keys.values()):
            keys[path] = key
    return keys if len(keys) >= STRUCT_FROM else {}


def json_parser(parse: ParseSpec, schema: T.StructType, reasons: bool = False) -> RecordParser:
    """One variant parse per document, one pass over its keys, then one typed read per field.

    A path that may lead to several values gives a list of them: text for a field of type string, and no
    value for any other type, so its record is bad.
    """
    paths = json_paths(parse, schema)
    split = {n: split_head(p) for n, p in paths.items() if not DEFINITE.match(p)}
    many = {n: compile_path(rest) for n, (_, rest) in split.items()}
    tops = top_keys({n: p for n, p in paths.items() if n not in many})
    in_top = ", ".join(f"`{k.replace('`', '``')}`: variant" for k in tops.values())
    heads = {head: f"__head_{i}" for i, head in enumerate(dict.fromkeys(head for head, _ in split.values())) if head != "$"}

    def run(df: DataFrame) -> DataFrame:
        text = F.col(VALUE)
        # anything but an object is no record, and must not count as one with all fields absent
        whole = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
        others = _others(df, schema)
        depth = [depth_of(text).alias(_DEPTH)] if any(".." in paths[n] for n in many) else []
        docs = df.select(F.when(whole, F.try_parse_json(text)).alias(_DOC), *depth, *others)
        doc, deep = F.col(_DOC), F.col(_DEPTH) if depth else F.lit(1)
        top = [F.try_variant_get(doc, "$", f"struct<{in_top}>").alias(_TOP)] if tops else []
        docs = docs.select("*", *top, *(F.try_variant_get(doc, h, "variant").alias(c) for h, c in heads.items()))
        # each path is walked once; kind and typed value are read from what it leads to
        places = range(len(schema.fields))
        held = [
            (
                F.when(doc.isNotNull(), list_text(many[n](F.col(heads.get(split[n][0], _DOC)), deep)))
                if n in many
                else F.col(_TOP).getField(tops[paths[n]])
                if paths[n] in tops
                else F.try_variant_get(doc, paths[n], "variant")
            ).alias(f"__held_{i}")
            for i, n in enumerate(schema.names)
        ]
        found = docs.select(F.col(_DOC).isNotNull().alias(_DOC), *held, *others)
        kinds = [
            (F.lit("LIST") if n in many else F.schema_of_variant(f"__held_{i}")).alias(f"__kind_{i}")
            for i, n in enumerate(schema.names)
        ]
        found = found.select(_DOC, *(f"__held_{i}" for i in places), *kinds, *others)
        typed = [
            (
                _list_field(F.col(f"__held_{i}"), f)
                if f.name in many
                else _json_field(F.col(f"__held_{i}"), F.col(f"__kind_{i}"), f, parse)
            ).alias(f.name)
            for i, f in enumerate(schema.fields)
        ]
        if not reasons:
            return _flag(found.select(*typed, *others), schema)
        out = _flag(found.select(*typed, _DOC, *(f"__kind_{i}" for i in places), *others), schema)
        nothing = lambda i: F.coalesce(F.col(f"__kind_{i}") == "VOID", F.lit(True))
        out = out.withColumn(REASONS, _reasons(schema, nothing, ~F.col(_DOC)))
        return out.drop(_DOC, *(f"__kind_{i}" for i in places))

    return run


def record_parser(parse: ParseSpec, schema: T.StructType, reasons: bool = False) -> RecordParser:
    """The parser the settings ask for. A custom one is a factory ``(parse, schema) -> parser`` whose
    result may leave out the flag when it has dropped bad records itself."""
    if parse.record_parser:
        custom = load_hook(parse.record_parser)(parse, schema)

        def run(df: DataFrame) -> DataFrame:
            out = custom(df)
            return out if BAD in out.columns else out.withColumn(BAD, F.lit(False))

        parser: RecordParser = run
    elif parse.format == "tsv":
        parser = delimited_parser(parse, schema, reasons)
    elif parse.format == "json":
        parser = json_parser(parse, schema, reasons)
    else:
        raise ValueError(f"no parser for format {parse.format!r}")
    return explained(parser) if reasons else parser


def explained(parser: RecordParser) -> RecordParser:
    """A parser that keeps the raw text of bad records, and tells of those it gives no reasons for that it
    has refused them. It must let other columns pass through."""

    def run(df: DataFrame) -> DataFrame:
        out = df.withColumn(RAW, F.col(VALUE)).transform(parser)
        if REASONS not in out.columns:
            refused = F.array(_reason(None, F.lit(OWN_PARSER))).cast(REASONS_TYPE)
            out = out.withColumn(REASONS, F.when(F.col(BAD), refused).otherwise(F.array().cast(REASONS_TYPE)))
        return out.withColumn(RAW, F.when(F.col(BAD), F.col(RAW)))

    return run


def refused_records(parsed: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Raw text and reasons of the bad records, with columns ``carried`` through the parser."""
    found = F.explode(F.when(F.col(BAD), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))).alias(_KEPT)
    return parsed.select("*", found).select(F.col(RAW).alias(VALUE), F.col(REASONS).alias("reasons"), *(f"`{c}`" for c in carried))


def good_records(df: DataFrame, parse: ParseSpec) -> DataFrame:
    """Drop bad records, or fail on the first one, as the settings say.

    A plain filter would be pushed below the parse and repeat it for every field it looks at.
    Exploding one element for a good record and none for a bad one selects the same rows, and the
    parse below it runs once.
    """
    none = F.array().cast("array<int>")
    if not parse.drops_bad_rows:
        stop = F.lit("a record could not be parsed; set skipBadRows to drop such records")
        none = F.raise_error(stop).cast("array<int>")
    kept = F.explode(F.when(F.col(BAD), none).otherwise(F.array(F.lit(0)))).alias(_KEPT)
    return df.select("*", kept).drop(BAD, REASONS, RAW, _KEPT)


def parse_records(df: DataFrame, parse: ParseSpec, schema: T.StructType) -> DataFrame:
    return df.transform(record_parser(parse, schema)).transform(lambda d: good_records(d, parse))
