"""JSON paths against a plain walk over Python values."""

import json

import pytest
from pyspark.sql import functions as F

from rollmill.functions.jsonpath import compile_path, depth_of, parse_condition
from rollmill.sources.records import list_text, parse_records
from rollmill.spec import Dimension, Metric, ParseSpec, TableSpec, input_schema

SHOP = {
    "shop": {
        "shelves": [
            {"no": 1, "items": [{"kind": "mug", "price": 4.5, "tags": ["blue", "old"]}, {"kind": "jug", "price": 12}]},
            {"no": 2, "items": [], "note": None},
            {"no": 3, "items": [{"kind": "pot", "price": 30, "seller": {"name": "Ida", "price": 1}}, "loose", None, 7]},
        ],
        "closed": False,
        "a b": {"price": 2},
    },
    "price": "none",
}

# Worked out by hand.
GOLDEN = {
    "$.shop.shelves[*].no": [1, 2, 3],
    "$.shop.shelves[*].items[*].kind": ["mug", "jug", "pot"],
    "$.shop.shelves[*].note": [None],
    "$.shop.shelves[0].items[*].price": [4.5, 12],
    "$.shop.shelves[-1].no": [3],
    "$.shop.shelves[0,2].no": [1, 3],
    "$.shop.shelves[2,-3, 9].no": [3, 1],
    "$.shop.shelves[1:].no": [2, 3],
    "$.shop.shelves[:2].no": [1, 2],
    "$.shop.shelves[-2:].no": [2, 3],
    "$.shop.shelves[:-1].no": [1, 2],
    "$.shop.shelves[2:1].no": [],
    "$.shop.shelves[:].no": [1, 2, 3],
    "$.shop.shelves[2].items[*]": [{"kind": "pot", "price": 30, "seller": {"name": "Ida", "price": 1}}, "loose", None, 7],
    "$..kind": ["mug", "jug", "pot"],
    "$..price": ["none", 2, 4.5, 12, 30, 1],
    "$..seller.name": ["Ida"],
    "$..tags[*]": ["blue", "old"],
    "$..tags[0]": ["blue"],
    "$..['a b'].price": [2],
    "$.shop['a b'].*": [2],
    "$.shop.*.price": [2],
    "$.missing[*]": [],
    "$.price[*]": [],
    "$.shop.shelves[*].items[?(@.price > 10)].kind": ["jug", "pot"],
    "$.shop.shelves[*].items[?(@.price >= 4.5 && @.price < 30)].kind": ["mug", "jug"],
    "$.shop.shelves[*].items[?(@.kind == 'pot' || @.kind == \"mug\")].price": [4.5, 30],
    "$..items[?(@.seller)].kind": ["pot"],
    "$..items[?(@.seller.name != 'Ida')].kind": [],
    "$..items[?(@.tags[0] == 'blue')].kind": ["mug"],
    "$.shop.shelves[?(@.note == null)].no": [2],
    "$.shop[?(@.closed == false)].closed": [False],
    "$.shop.shelves[?(@.no == '1')].no": [],
    "$..[?(@.price == 2)].price": [2],
    "$.shop.shelves[?(@.no < 'x')].no": [],
}


def found(spark, path, doc):
    text = doc if isinstance(doc, str) else json.dumps(doc)
    df = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v"), depth_of(F.col("t")).alias("d"))
    row = df.select(F.transform(compile_path(path)(F.col("v"), F.col("d")), lambda v: F.to_json(v)).alias("found")).first()
    return [json.loads(x) for x in row["found"]]


@pytest.mark.parametrize("path", GOLDEN)
def test_golden(spark, path):
    assert found(spark, path, SHOP) == GOLDEN[path]


def below(value):
    """Every value and all inside it; members by name."""
    yield value
    inside = value if isinstance(value, list) else [value[k] for k in sorted(value)] if isinstance(value, dict) else []
    for v in inside:
        yield from below(v)


def test_all_below(spark):
    containers = [v for v in below(SHOP) if isinstance(v, (list, dict))]
    want = [x for v in containers for x in (v if isinstance(v, list) else [v[k] for k in sorted(v)])]
    assert found(spark, "$..*", SHOP) == want
    assert found(spark, "$..[*]", SHOP) == want


def test_deep_and_wide_documents(spark):
    deep = "[" * 300 + '{"a": 1}' + "]" * 300
    assert found(spark, "$..a", deep) == [1]
    wide = json.dumps([{"a": i} for i in range(3000)])
    assert found(spark, "$[*].a", wide) == list(range(3000))
    assert found(spark, "$..a", wide) == list(range(3000))


@pytest.mark.parametrize(
    "path", ["", "$", "a.b", "$..", "$.a..", "$.a[", "$.a[?(@.b)", "$.a[?(b == 1)]", "$['a','b']", "$.a.length()", "$a", "$.a[1:2:3]"]
)
def test_paths_that_cannot_be_read(path):
    with pytest.raises(ValueError):
        compile_path(path)


def test_conditions_keep_quotes():
    (both,) = parse_condition("@.a == 'x && y || z' && @.b")
    assert [(t.path, t.op, t.literal) for t in both] == [(".a", "==", "x && y || z"), (".b", None, None)]


def test_list_text(spark):
    df = spark.createDataFrame([('[1, 2.0, 1e30, "a, b", null, true, {"k": [1]}, [], ""]',)], "t string")
    text = df.select(list_text(compile_path("$[*]")(F.parse_json("t"), F.lit(1)))).first()[0]
    assert text == '[1, 2.0, 1.0E30, a, b, null, true, {"k":[1]}, [], ]'


def test_records(spark):
    """Lists are text; numbers and times cannot be read from them; nothing found is an empty list."""
    table = TableSpec("t", (Dimension("tags"), Dimension("names"), Dimension("id", type="int")), (Metric("n", "count"),))
    parse = ParseSpec("json", field_mapping={"tags": "$.tags[*]", "names": "$..name", "id": "$.id"})
    docs = [
        '{"id": 1, "tags": ["x", 2], "by": {"name": "Bo", "of": {"name": "Cy"}}}',
        '{"id": 2}',
        '{"id": 3, "tags": "x"}',
        '{"id": "no number"}',
        "{broken",
        '["no object"]',
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "value string")
    got = sorted(map(tuple, parse_records(raw, parse, input_schema([table])).select("id", "tags", "names").collect()))
    assert got == [(1, "[x, 2]", "[Bo, Cy]"), (2, "[]", "[]"), (3, "[]", "[]")]
    number = ParseSpec("json", field_mapping={"tags": "$.a", "names": "$.b", "id": "$.tags[*]"})
    assert parse_records(raw, number, input_schema([table])).collect() == []
    with pytest.raises(ValueError, match="cannot read"):
        parse_records(raw, ParseSpec("json", field_mapping={"tags": "$.a[(", "names": "$.b", "id": "$.c"}), input_schema([table]))
