"""Manifests: the small JSON messages by which the two jobs tell what they have written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rollmill import files
from rollmill.sources.kafka import topic_options
from rollmill.spec import Channel

MICRO_BATCH_SCHEMA = (
    "id BIGINT, "
    "tables MAP<STRING, STRUCT<paths: ARRAY<STRING>, columns: ARRAY<STRING>, recordCount: BIGINT>>, "
    "offsets ARRAY<STRUCT<topic: STRING, partition: INT, offset: BIGINT>>"
)
# minTime, maxTime, bucketRows and segments are only there when the next period may build on them (plans.snapshot).
BATCH_SCHEMA = (
    "id BIGINT, "
    "tables MAP<STRING, STRUCT<paths: ARRAY<STRING>, columns: ARRAY<STRING>, partitioning: ARRAY<INT>, "
    "partitionConf: STRUCT<columns: ARRAY<STRING>, partitions: INT>, recordCount: BIGINT, "
    "minTime: BIGINT, maxTime: BIGINT, bucketRows: ARRAY<BIGINT>, format: STRING, "
    "segments: ARRAY<STRUCT<path: STRING, first: BIGINT, last: BIGINT, recordCount: BIGINT, minTime: BIGINT, "
    "maxTime: BIGINT, bucketRows: ARRAY<BIGINT>>>>>, "
    "microBatches ARRAY<BIGINT>"
)


# Of folded messages: the newest period they name.
NEWEST = "newest"


# The period in the path of a micro-batch.
PERIOD_IN_PATH = r"(?:^|.*/)dt=(\d+)(?:/|$)"


def _folder(channel: Channel) -> str:
    return f"{channel.channel}/{channel.queue}"


def _folded_path(channel: Channel) -> str:
    return f"{channel.channel}/{channel.queue}.folded"


def _loose(spark: SparkSession, channel: Channel, schema: str) -> DataFrame:
    folder = _folder(channel)
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.msg")
        .json(folder)
    )


def _folded(spark: SparkSession, channel: Channel, schema: str) -> DataFrame | None:
    path = _folded_path(channel)
    return spark.read.schema(f"{schema}, {NEWEST} BIGINT").parquet(path) if files.exists(spark, path) else None


def all_manifests(spark: SparkSession, channel: Channel, schema: str, after: int | None = None) -> DataFrame:
    """Every message in the channel; with ``after``, of the folded ones only those that name a later
    period, which leaves all other partitions of the folded table unread."""
    if channel.type == "file":
        loose, folded = _loose(spark, channel, schema), _folded(spark, channel, schema)
        if folded is None:
            return loose
        if after is not None:
            folded = folded.where(F.col(NEWEST) > after)
        # A message may be in both places if folding was interrupted.
        return folded.drop(NEWEST).join(loose.select("id"), "id", "left_anti").unionByName(loose)
    if channel.type == "kafka":
        raw = spark.read.format("kafka").options(**topic_options(channel)).load()
        doc = F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"})
        return raw.select(doc.alias("doc")).select("doc.*")
    raise ValueError(f"unsupported manifest channel {channel.type!r}")


def fold_manifests(
    spark: SparkSession, channel: Channel, schema: str, done: int, among: DataFrame | None = None
) -> int:
    """Move messages that name only periods up to ``done`` from files of their own into a table
    partitioned by the newest period they name; returns how many. ``among`` (id) are the messages the
    caller has seen: one that arrived since must not be put away unread. The newest message stays a file,
    so the last one is found by its name. A Kafka channel is left to the broker's retention."""
    if channel.type != "file":
        return 0
    last = last_id(spark, channel)
    if last is None:
        return 0
    periods = F.flatten(F.transform(F.map_values("tables"), lambda info: info["paths"]))
    newest = F.array_max(F.transform(periods, lambda p: F.regexp_extract(p, PERIOD_IN_PATH, 1).try_cast("bigint")))
    due = _loose(spark, channel, schema).withColumn(NEWEST, F.coalesce(newest, F.lit(0).cast("bigint")))
    due = due.where((F.col(NEWEST) <= done) & (F.col("id") < last))
    if among is not None:
        due = due.join(among, "id", "left_semi")
    folded = _folded(spark, channel, schema)
    if folded is not None:
        due = due.join(folded.select("id"), "id", "left_anti")
    due.repartition(NEWEST).write.mode("append").partitionBy(NEWEST).parquet(_folded_path(channel))
    # At most the messages since the last fold: their ids, to delete their files.
    there = _folded(spark, channel, schema).select("id").join(_loose(spark, channel, schema).select("id"), "id", "left_semi")
    moved = [r["id"] for r in there.collect()]
    for number in moved:
        files.delete(spark, f"{_folder(channel)}/{number}.msg")
    return len(moved)


def last_id(spark: SparkSession, channel: Channel) -> int | None:
    """Id of the last message of a file channel, from file names only."""
    numbers = [int(n[:-4]) for n in files.names(spark, _folder(channel)) if n.endswith(".msg") and n[:-4].isdigit()]
    return max(numbers, default=None)


def manifests_of(spark: SparkSession, channel: Channel, schema: str, ids: Sequence[int]) -> DataFrame:
    """The messages of these ids; of a channel of files, only their files are opened."""
    if channel.type != "file":
        return all_manifests(spark, channel, schema).where(F.col("id").isin([int(i) for i in ids]))
    there = [p for i in ids if files.exists(spark, p := f"{_folder(channel)}/{i}.msg")]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(there)


def last_message(spark: SparkSession, channel: Channel, schema: str) -> Row | None:
    """The newest message; of a channel of files, only its file is opened."""
    if channel.type != "file":
        return last_manifest(all_manifests(spark, channel, schema))
    number = last_id(spark, channel)
    return None if number is None else manifests_of(spark, channel, schema, [number]).first()


def last_manifest(manifests: DataFrame) -> Row | None:
    """The message with the highest id, by number."""
    return manifests.orderBy(F.col("id").desc()).limit(1).first()
