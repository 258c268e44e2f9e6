"""Buckets, packing, layout and placement."""

import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollmill.operators.balance import (
    BUCKET,
    PART,
    Layout,
    bucket_column,
    bucket_weights,
    pack,
    part_of_bucket,
    place,
)
from rollmill.sinks.store import write_snapshot
from rollmill.spec import Dimension, Metric, Partitioning, TableSpec

TABLE = TableSpec("t", (Dimension("a"), Dimension("b", type="int")), (Metric("n", "count"),))


def test_bucket_is_crc32(spark):
    rows = [("x", 1), ("é\t", 2), (" y ", -3), (None, None), ("", 0)]
    df = spark.createDataFrame(rows, "a STRING, b INT")
    got = df.select("a", "b", bucket_column(TABLE, Partitioning(("a", "b"), 7))).collect()

    def text(a, b):
        clean = "" if a is None else a.replace("\t", "").strip()
        return clean + ("" if b is None else str(b))

    assert [r[2] for r in got] == [zlib.crc32(text(a, b).encode()) % 7 for a, b in rows]


def test_packing():
    assert part_of_bucket({0: 10, 1: 1, 2: 1}, 3) == [0, 1, 1]
    assert [sorted(b) for b in pack({0: 10, 1: 1, 2: 1}, 3)] == [[0], [1, 2], []]
    assert part_of_bucket({2: 5}, 4) == [1, 2, 0, 3]
    assert part_of_bucket({}, 3) == [0, 1, 2]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 12), st.data())
def test_packing_by_brute_force(bins, data):
    weights = data.draw(st.dictionaries(st.integers(0, bins - 1), st.integers(1, 100), max_size=bins))
    totals = [0] * bins
    expected = {}
    for bucket in sorted(weights, key=lambda b: (-weights[b], b)):
        limit = sum(weights.values()) // bins
        fitting = [i for i, t in enumerate(totals) if t + weights[bucket] <= limit]
        chosen = fitting[0] if fitting else totals.index(min(totals))
        totals[chosen] += weights[bucket]
        expected[bucket] = chosen
    parts = part_of_bucket(weights, bins)
    assert {b: parts[b] for b in weights} == expected
    assert len(parts) == bins
    spare = [parts[b] for b in range(bins) if b not in weights]
    assert spare == sorted(spare) and not set(spare) & set(expected.values())


def test_layout_cuts_heavy_parts():
    layout = Layout.plan({0: 95, 1: 3, 2: 2}, 3, 10)
    assert layout.parts == (0, 1, 1)
    assert layout.slots == (10, 1, 0)
    assert layout.first_slot == (0, 10, 11)
    assert layout.total_slots == 11


def test_layout_of_very_many_rows():
    """The bound on a file holds for any number of rows, or the layout is refused."""
    layout = Layout.plan({0: 10**12, 1: 2 * 10**12}, 2, 5_000_000)
    assert layout.slots == (400_000, 200_000) and layout.total_slots == 600_000
    with pytest.raises(ValueError, match="set rowsPerFile to 3000000 or more"):
        Layout.plan({0: 10**12, 1: 2 * 10**12}, 2, 10)


@pytest.mark.parametrize("rows_per_file", [50, 10_000])
def test_hot_key_is_cut_and_nothing_is_lost(spark, tmp_path, rows_per_file):
    """A third of all rows share a key: its part is written by several tasks, every row once, each
    file in order."""
    random.seed(3)
    rows = [("hot" if i % 3 == 0 else f"k{random.randint(0, 40)}", i, 1) for i in range(1500)]
    df = spark.createDataFrame(rows, "a STRING, b INT, n BIGINT")
    keys = Partitioning(("a",), 6)
    bucketed = df.withColumn(BUCKET, bucket_column(TABLE, keys))
    weights = bucket_weights(bucketed)
    layout = Layout.plan(weights, 6, rows_per_file)
    placed = place(bucketed, TABLE, layout, ("a", "b"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1

    written = write_snapshot(placed, TABLE, str(tmp_path), 1)
    assert written.rows == 1500
    files = {}
    base = f"{tmp_path}/t/dt=1"
    for r in spark.read.text(base).select("value", PART, "_metadata.file_path").collect():
        files.setdefault((r[PART], r["file_path"]), []).append(r["value"].split("\t"))
    for lines in files.values():
        assert len(lines) <= rows_per_file * 1.6
        assert [(l[0], int(l[1])) for l in lines] == sorted((l[0], int(l[1])) for l in lines)
    assert sorted(int(l[1]) for lines in files.values() for l in lines) == list(range(1500))
    parts = {}
    for (part, _), lines in files.items():
        for line in lines:
            assert parts.setdefault(line[0], part) == part
            assert layout.parts[zlib.crc32(line[0].encode()) % 6] == part
    hot = sum(1 for part, _ in files if part == parts["hot"])
    assert hot >= 8 if rows_per_file == 50 else hot == 1
