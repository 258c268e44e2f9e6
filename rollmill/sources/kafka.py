"""Kafka as a stream of records and as a manifest channel.

Needs the ``spark-sql-kafka`` package on the cluster; this module only builds its options.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rollmill.spec import Channel, KafkaSource

TOPIC, PARTITION, OFFSET = "__topic", "__partition", "__offset"
# Fixed values of the Kafka source for "from the end" and "from the start".
LATEST, EARLIEST = -1, -2
# Records of a micro-batch unless the source's options say otherwise; the rest waits for the next one.
MOST_OFFSETS = "50000000"


def starting_offsets(
    source: KafkaSource,
    stored: Iterable[Row | Mapping] | None = None,
    partitions: Mapping[str, int] | None = None,
) -> str:
    """Where to start when there is no checkpoint yet.

    Partitions that manifests name go on from there. The source wants every partition of a
    topic named, so ``partitions`` (topic -> number of partitions) adds those the manifest lacks.
    """
    default = EARLIEST if source.earliest else LATEST
    found: dict[str, dict[str, int]] = {}
    for entry in stored or ():
        if entry["topic"] in source.topics:
            found.setdefault(entry["topic"], {})[str(entry["partition"])] = int(entry["offset"])
    if not found:
        return "earliest" if source.earliest else "latest"
    for topic in source.topics:
        known = found.setdefault(topic, {})
        for number in range((partitions or {}).get(topic, 0)):
            known.setdefault(str(number), default)
    return json.dumps(found, sort_keys=True)


def stream_options(source: KafkaSource, offsets: str) -> dict[str, str]:
    """Without a bound of the user's, the first micro-batch takes at most MOST_OFFSETS records."""
    return {
        "maxOffsetsPerTrigger": MOST_OFFSETS,
        **source.options,
        "kafka.bootstrap.servers": ",".join(source.brokers),
        "subscribe": ",".join(source.topics),
        "startingOffsets": offsets,
    }


def read_stream(spark: SparkSession, source: KafkaSource, offsets: str) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**stream_options(source, offsets)).load()
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias(TOPIC),
        F.col("partition").alias(PARTITION),
        F.col("offset").alias(OFFSET),
    )


def end_offsets(records: DataFrame) -> list[dict]:
    """Next offset per topic and partition of a batch; one row per Kafka partition."""
    ends = records.groupBy(TOPIC, PARTITION).agg((F.max(OFFSET) + 1).alias("offset"))
    return [
        {"topic": r[TOPIC], "partition": r[PARTITION], "offset": r["offset"]}
        for r in ends.orderBy(TOPIC, PARTITION).collect()
    ]


def newest_offsets(manifests: DataFrame) -> list[dict]:
    """The newest offset of every partition over all manifests: the last one may lack partitions."""
    told = manifests.select("id", F.explode("offsets").alias("o")).groupBy("o.topic", "o.partition")
    newest = told.agg(F.max_by("o.offset", F.struct("id", "o.offset")).alias("offset"))
    return [r.asDict() for r in newest.orderBy("topic", "partition").collect()]


def carried(before: Iterable[Mapping], now: Iterable[Mapping]) -> list[dict]:
    """Offsets of a batch, with those of partitions that had no row in it carried forward."""
    merged = {(o["topic"], o["partition"]): o["offset"] for o in (*before, *now)}
    return [{"topic": t, "partition": p, "offset": o} for (t, p), o in sorted(merged.items())]


def topic_options(channel: Channel) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": channel.channel,
        "subscribe": channel.queue,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def producer_options(channel: Channel) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": channel.channel,
        "topic": channel.queue,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }
