"""Kafka options; the package itself is not needed for these."""

import json

from pyspark.sql import functions as F

from rollmill.sources.kafka import (
    carried,
    end_offsets,
    newest_offsets,
    producer_options,
    starting_offsets,
    stream_options,
    topic_options,
)
from rollmill.spec import Channel, KafkaSource

SOURCE = KafkaSource(("a", "b"), ("h1:9092", "h2:9092"))


def test_starting_offsets():
    assert starting_offsets(SOURCE) == "earliest"
    assert starting_offsets(KafkaSource(("a",), ("h",), earliest=False)) == "latest"
    stored = [
        {"topic": "a", "partition": 0, "offset": 5},
        {"topic": "a", "partition": 1, "offset": 7},
        {"topic": "gone", "partition": 0, "offset": 1},
    ]
    assert json.loads(starting_offsets(SOURCE, stored)) == {"a": {"0": 5, "1": 7}, "b": {}}
    counts = {"a": 3, "b": 1}
    assert json.loads(starting_offsets(SOURCE, stored, counts)) == {"a": {"0": 5, "1": 7, "2": -2}, "b": {"0": -2}}
    late = KafkaSource(("a",), ("h",), earliest=False)
    assert json.loads(starting_offsets(late, stored, {"a": 3})) == {"a": {"0": 5, "1": 7, "2": -1}}


def test_options():
    assert stream_options(SOURCE, "earliest") == {
        "maxOffsetsPerTrigger": "50000000",
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
    }
    own = KafkaSource(("a",), ("h",), options={"maxOffsetsPerTrigger": "10", "kafka.security.protocol": "SSL"})
    assert stream_options(own, "latest")["maxOffsetsPerTrigger"] == "10"
    assert stream_options(own, "latest")["kafka.security.protocol"] == "SSL"
    channel = Channel("kafka", "h:1", "topic")
    assert topic_options(channel)["endingOffsets"] == "latest"
    assert producer_options(channel)["kafka.acks"] == "all"


def test_offsets_are_carried_over_idle_partitions(spark):
    def at(partition, offset):
        return {"topic": "a", "partition": partition, "offset": offset}

    first = carried([], [at(1, 7), at(0, 5)])
    assert first == [at(0, 5), at(1, 7)]
    assert carried(first, [at(0, 11)]) == [at(0, 11), at(1, 7)]
    assert carried(first, []) == first
    # manifests of other making name only the partitions that had rows
    rows = [(1, [("a", 0, 5), ("a", 1, 7)]), (2, [("a", 0, 11)]), (3, []), (4, None)]
    told = spark.createDataFrame(
        rows, "id bigint, offsets array<struct<topic: string, partition: int, offset: bigint>>"
    )
    assert newest_offsets(told) == [at(0, 11), at(1, 7)]
    assert json.loads(starting_offsets(SOURCE, newest_offsets(told), {"a": 3})) == {
        "a": {"0": 11, "1": 7, "2": -2},
        "b": {},
    }


def test_end_offsets(spark):
    df = spark.range(0, 10).select(
        F.lit("a").alias("__topic"), (F.col("id") % 2).cast("int").alias("__partition"), F.col("id").alias("__offset")
    )
    assert end_offsets(df) == [
        {"topic": "a", "partition": 0, "offset": 9},
        {"topic": "a", "partition": 1, "offset": 10},
    ]
