"""Merged bitmaps count what DISTINCT counts."""

import pytest
from pyspark.sql import functions as F

from rollmill.operators.bitmaps import bitmaps, count_ids, finalise_bitmaps, merge_bitmaps, report, size_of
from rollmill.operators.rollup import finalise, rollup
from rollmill.spec import Dimension, Metric, TableSpec

TABLE = TableSpec(
    "t",
    (Dimension("a"), Dimension("b", type="int")),
    (Metric("u", "bitset", max=2**40), Metric("w", "bitset"), Metric("mean", "int_avg", field="v"), Metric("hi", "int_max", field="v")),
)


def records(spark):
    ids = F.col("id") * 7919 % 1000
    return spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 4)).alias("a"),
        (F.col("id") % 5).cast("int").alias("b"),
        # both sides of the ends of ranges, negative, far apart, null
        F.when(F.col("id") % 7 > 0, (ids - 500) * 4096 + F.col("id") % 2).alias("u"),
        F.when(F.col("a") != "hot", ids % 50).cast("int").alias("w"),
        (F.col("id") % 101).cast("int").alias("v"),
    )


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("by", [None, ["a"], ["b"], []])
def test_counts_equal_distinct(spark, by):
    rolled = records(spark).transform(rollup(TABLE))
    got, want = rolled.transform(finalise_bitmaps(TABLE, by)), rolled.transform(finalise(TABLE, by))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows_of(got) == rows_of(want)


def test_bitmaps_of_batches_are_merged_in_any_order_and_twice(spark):
    rows = records(spark)
    batches = [rows.where(F.col("v") % 3 == k).transform(rollup(TABLE)) for k in range(3)]
    maps = None
    for batch in (*batches, batches[1]):
        made = batch.transform(bitmaps(TABLE))
        maps = made if maps is None else maps.unionByName(made)
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    want = rows.transform(rollup(TABLE)).transform(finalise(TABLE, ["a"]))
    assert rows_of(report(TABLE, everything, maps, ["a"])) == rows_of(want)
    # finer merges first, then coarser ones
    step = maps.transform(merge_bitmaps(["a", "b"])).transform(merge_bitmaps(["a"]))
    assert rows_of(step.transform(count_ids(["a"]))) == rows_of(maps.transform(count_ids(["a"])))
    # one bitmap a key, metric and range
    assert step.groupBy("a", "metric", "bucket").count().where("count > 1").isEmpty()


def test_no_id_is_shuffled(spark):
    made = records(spark).transform(rollup(TABLE)).transform(bitmaps(TABLE))
    maps = spark.createDataFrame(made.collect(), made.schema)
    plan = maps.transform(count_ids(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan and "distinct" not in plan.lower()


def test_empty_and_unusable_tables(spark):
    rolled = records(spark).limit(0).transform(rollup(TABLE))
    assert rolled.transform(finalise_bitmaps(TABLE)).collect() == []
    with pytest.raises(ValueError, match="no bitset"):
        bitmaps(TableSpec("x", (Dimension("a"),), ()))
    with pytest.raises(ValueError, match="bucket"):
        bitmaps(TableSpec("x", (Dimension("bucket"),), (Metric("u", "bitset"),)))


def test_ranges_with_few_ids_cost_words_and_mix_with_full_ones(spark):
    """Scattered ids do not take a bitmap of 4 KB each; a range is full in one batch and not in the other."""
    scattered = spark.range(0, 3000).select(F.lit("s").alias("a"), ((F.col("id") - 1500) * 9_973).alias("u"))
    full = spark.range(1, 32_769).select(F.lit("f").alias("a"), F.col("id").alias("u"))
    some = spark.range(-70_000, 70_000, 997).select(F.lit("f").alias("a"), F.col("id").alias("u"))
    table = TableSpec("t", (Dimension("a"),), (Metric("u", "bitset", max=2**40),))
    batches = [b.transform(rollup(table)) for b in (scattered, full.where("u % 3 > 0"), full.where("u % 3 = 0"), some)]
    maps = None
    for batch in batches:
        made = batch.transform(bitmaps(table))
        maps = made if maps is None else maps.unionByName(made)
    assert maps.where("a = 's' AND bits IS NOT NULL").isEmpty() and maps.where("bits IS NOT NULL").count() == 2
    merged = maps.transform(merge_bitmaps(["a"]))
    got = merged.select("a", "bucket", size_of().alias("n"))
    ids = scattered.union(full).union(some)
    want = ids.groupBy("a", F.bitmap_bucket_number("u").alias("bucket")).agg(F.count_distinct("u").alias("n"))
    assert rows_of(got) == rows_of(want)
    # a whole bitmap holds the bits that Spark's own function sets
    own = full.union(some).where("u BETWEEN 1 AND 32768").agg(F.bitmap_construct_agg(F.bitmap_bit_position("u")))
    assert merged.where("a = 'f' AND bucket = 1").select("bits").first()[0] == own.first()[0]
    assert rows_of(merged.transform(count_ids(["a"]))) == rows_of(ids.groupBy("a", F.lit("u")).agg(F.count_distinct("u")))
