"""Declarative settings: tables, parsing, real-time and batch jobs.

Every class is a frozen dataclass that checks itself when built, so a wrong
setting fails on the driver before any job starts. ``from_dict`` accepts the
camelCase JSON documents that rollup deployments already keep.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from rollmill.durations import duration_millis, interval_bounds
from rollmill.functions.timefmt import TimeFormat

# How segments of snapshots are stored.
SNAPSHOT_FORMATS = ("tsv", "parquet")
# Name of the row count that tables without a count metric carry.
ROLLUP_COUNT = "__rollup_count"

# Width name -> Spark type.
NUMBER_TYPES: dict[str, T.DataType] = {
    "byte": T.ByteType(),
    "ubyte": T.ShortType(),
    "short": T.ShortType(),
    "ushort": T.IntegerType(),
    "int": T.IntegerType(),
    "uint": T.LongType(),
    "long": T.LongType(),
    "ulong": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}
TIME_TYPES = ("time", "microtime")
AGGREGATES = ("sum", "min", "max", "avg")
GRANULARITIES = ("year", "month", "day", "hour", "minute", "second")
INT_MAX = 2**31 - 1


def _id_type(largest: int | None) -> T.DataType:
    return T.LongType() if largest is not None and largest >= INT_MAX else T.IntegerType()


def _pick(doc: Mapping[str, Any], names: Iterable[str]) -> dict[str, Any]:
    return {n: doc[n] for n in names if doc.get(n) is not None}


@dataclass(frozen=True)
class Dimension:
    name: str
    field: str | None = None
    type: str = "string"
    max: int | None = None
    format: str | None = None
    granularity: str | None = None

    def __post_init__(self) -> None:
        self.data_type  # noqa: B018  (raises on an unknown type)
        if self.is_time:
            if self.granularity is not None and self.granularity not in GRANULARITIES:
                raise ValueError(f"dimension {self.name}: unknown granularity {self.granularity!r}")
            TimeFormat.of(self.format)

    @property
    def input_field(self) -> str:
        return self.field or self.name

    @property
    def is_time(self) -> bool:
        return self.type in TIME_TYPES

    @property
    def data_type(self) -> T.DataType:
        if self.type == "string":
            return T.StringType()
        if self.type == "numeric":
            return _id_type(self.max)
        if self.is_time:
            return T.TimestampType()
        if self.type in NUMBER_TYPES:
            return NUMBER_TYPES[self.type]
        raise ValueError(f"dimension {self.name}: unknown type {self.type!r}")

    @property
    def store_type(self) -> T.DataType:
        return self.data_type

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> Dimension:
        return cls(**_pick(doc, ("name", "field", "type", "max", "format", "granularity")))


@dataclass(frozen=True)
class Metric:
    """``count``, ``bitset`` or ``<width>_<sum|min|max|avg>``."""

    name: str
    type: str
    field: str | None = None
    max: int | None = None

    def __post_init__(self) -> None:
        if self.type in ("count", "bitset"):
            return
        width, _, aggregate = self.type.partition("_")
        if width not in NUMBER_TYPES or aggregate not in AGGREGATES:
            raise ValueError(f"metric {self.name}: unknown type {self.type!r}")

    @property
    def input_field(self) -> str:
        return self.field or self.name

    @property
    def is_count(self) -> bool:
        return self.type == "count"

    @property
    def is_bitset(self) -> bool:
        return self.type == "bitset"

    @property
    def aggregate(self) -> str:
        return self.type if self.is_count or self.is_bitset else self.type.partition("_")[2]

    @property
    def data_type(self) -> T.DataType:
        if self.is_count:
            return T.LongType()
        if self.is_bitset:
            return _id_type(self.max)
        return NUMBER_TYPES[self.type.partition("_")[0]]

    @property
    def store_type(self) -> T.DataType:
        """Type after aggregation: sums widen, so they can be read back and added again."""
        if self.aggregate in ("sum", "avg"):
            fractional = isinstance(self.data_type, (T.FloatType, T.DoubleType))
            return T.DoubleType() if fractional else T.LongType()
        return self.data_type

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> Metric:
        return cls(**_pick(doc, ("name", "type", "field", "max")))


@dataclass(frozen=True)
class Partitioning:
    columns: tuple[str, ...]
    partitions: int

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))
        if not self.columns:
            raise ValueError("partitioning needs at least one column")
        if self.partitions < 1:
            raise ValueError("partitioning needs at least one partition")

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> Partitioning:
        return cls(tuple(doc["columns"]), int(doc["partitions"]))


@dataclass(frozen=True)
class TableSpec:
    name: str
    dimensions: tuple[Dimension, ...]
    metrics: tuple[Metric, ...]
    partitioning: Partitioning | None = None
    sort_columns: tuple[str, ...] | None = None
    snapshot_format: str | None = None

    def __post_init__(self) -> None:
        if self.snapshot_format not in (None, *SNAPSHOT_FORMATS):
            raise ValueError(f"table {self.name}: unknown snapshot format {self.snapshot_format!r}")
        object.__setattr__(self, "dimensions", tuple(self.dimensions))
        object.__setattr__(self, "metrics", tuple(self.metrics))
        if self.sort_columns is not None:
            object.__setattr__(self, "sort_columns", tuple(self.sort_columns))
        names = [c.name for c in (*self.dimensions, *self.metrics)]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"table {self.name}: columns named twice: {', '.join(twice)}")
        if self.partitioning:
            self.check_partitioning(self.partitioning)
        self.check_sort(self.sort_columns or ())

    def check_partitioning(self, partitioning: Partitioning) -> None:
        known = {d.name for d in self.dimensions}
        wrong = [c for c in partitioning.columns if c not in known]
        if wrong:
            raise ValueError(f"table {self.name}: partition keys must be dimensions: {', '.join(wrong)}")

    def check_sort(self, columns: Iterable[str]) -> None:
        wrong = [c for c in columns if c not in self.columns]
        if wrong:
            raise ValueError(f"table {self.name}: unknown sort columns: {', '.join(wrong)}")

    @property
    def count_metrics(self) -> tuple[Metric, ...]:
        return tuple(m for m in self.metrics if m.is_count)

    @property
    def count_column(self) -> str:
        return self.count_metrics[0].name if self.count_metrics else ROLLUP_COUNT

    @property
    def bitset_metrics(self) -> tuple[Metric, ...]:
        return tuple(m for m in self.metrics if m.is_bitset)

    @property
    def key_columns(self) -> tuple[str, ...]:
        """What one rolled-up row is unique by: the dimensions and the ids kept for distinct counts."""
        return tuple(c.name for c in (*self.dimensions, *self.bitset_metrics))

    @property
    def time_dimensions(self) -> tuple[Dimension, ...]:
        return tuple(d for d in self.dimensions if d.is_time)

    @property
    def store_schema(self) -> T.StructType:
        """Columns of the rolled-up table in output order."""
        fields = [T.StructField(c.name, c.store_type) for c in (*self.dimensions, *self.metrics)]
        if not self.count_metrics:
            fields.append(T.StructField(ROLLUP_COUNT, T.LongType()))
        return T.StructType(fields)

    @property
    def columns(self) -> list[str]:
        return self.store_schema.names

    def time_format(self, column: str) -> TimeFormat:
        return next(TimeFormat.of(d.format) for d in self.time_dimensions if d.name == column)

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> TableSpec:
        part = doc.get("partitioning")
        return cls(
            name=doc["name"],
            dimensions=tuple(Dimension.from_dict(d) for d in doc.get("dimensions", ())),
            metrics=tuple(Metric.from_dict(m) for m in doc.get("metrics", ())),
            partitioning=Partitioning.from_dict(part) if part else None,
            sort_columns=doc.get("sortColumns"),
            snapshot_format=doc.get("snapshotFormat"),
        )


def input_schema(tables: Iterable[TableSpec]) -> T.StructType:
    """Union of the input fields of all tables, so that one parse feeds every table."""
    found: dict[str, T.DataType] = {}
    clash = set()
    for table in tables:
        for col in (*table.dimensions, *(m for m in table.metrics if not m.is_count)):
            if found.setdefault(col.input_field, col.data_type) != col.data_type:
                clash.add(col.input_field)
    if clash:
        raise ValueError(f"fields read with different types: {', '.join(sorted(clash))}")
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


@dataclass(frozen=True)
class ParseSpec:
    """How raw text becomes input fields.

    ``skip_bad_rows`` left unset keeps the habit of each format: a JSON document that cannot be
    read is dropped, a delimited line that cannot be read fails the batch.
    """

    format: str = "unknown"
    columns: tuple[str, ...] | None = None
    delimiter: str = "\t"
    time_column: str | None = None
    field_mapping: Mapping[str, str] | None = None
    time_formats: Mapping[str, str] = field(default_factory=dict)
    skip_bad_rows: bool | None = None
    null_numeric_as_zero: bool = True
    null_string_as_empty: bool = True
    record_parser: str | None = None

    def __post_init__(self) -> None:
        if self.columns is not None:
            object.__setattr__(self, "columns", tuple(self.columns))
        if not self.delimiter:
            raise ValueError("delimiter must not be empty")
        for text in self.time_formats.values():
            TimeFormat.of(text)

    @property
    def drops_bad_rows(self) -> bool:
        return self.format == "json" if self.skip_bad_rows is None else self.skip_bad_rows

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> ParseSpec:
        names = {
            "format": "format",
            "columns": "columns",
            "delimiter": "delimiter",
            "timeColumn": "time_column",
            "fieldMapping": "field_mapping",
            "timeFormats": "time_formats",
            "skipBadRows": "skip_bad_rows",
            "nullNumericAsZero": "null_numeric_as_zero",
            "nullStringAsEmpty": "null_string_as_empty",
            "recordParserClass": "record_parser",
        }
        return cls(**{ours: doc[theirs] for theirs, ours in names.items() if doc.get(theirs) is not None})


@dataclass(frozen=True)
class Channel:
    """Where manifests go: ``file`` (base path + sub-directory) or ``kafka`` (brokers + topic)."""

    type: str = "unknown"
    channel: str = ""
    queue: str = ""

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> Channel:
        return cls(**_pick(doc, ("type", "channel", "queue")))


@dataclass(frozen=True)
class KafkaSource:
    """``options`` go to the Kafka source as they are: security, ``maxOffsetsPerTrigger``,
    ``minPartitions``. ``partitions`` (topic -> number of partitions) names those that may not have had
    a row yet; the source wants all of them named when it starts from a manifest."""

    topics: tuple[str, ...]
    brokers: tuple[str, ...]
    earliest: bool = True
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, int] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> KafkaSource:
        earliest = doc.get("earliest")
        return cls(
            tuple(doc["topics"]),
            tuple(doc["brokers"]),
            True if earliest is None else bool(earliest),
            {k: str(v) for k, v in (doc.get("options") or {}).items()},
            {k: int(v) for k, v in (doc.get("partitions") or {}).items()},
        )


@dataclass(frozen=True)
class RealTimeSpec:
    parse: ParseSpec = ParseSpec()
    window: str = "PT5S"
    kafka: KafkaSource | None = None
    channel: Channel = Channel()
    processor: str | None = None
    stream_source: str | None = None
    # Bad records go to ``quarantine/mb=<batch>`` of the store, with their reasons, instead of failing the
    # batch or being dropped.
    quarantine: bool = False

    def __post_init__(self) -> None:
        duration_millis(self.window)

    @property
    def window_millis(self) -> int:
        return duration_millis(self.window)

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> RealTimeSpec:
        kafka, channel = doc.get("kafkaSource"), doc.get("notifier")
        return cls(
            parse=ParseSpec.from_dict(doc.get("parseSpec") or {}),
            window=doc.get("windowDuration") or "PT5S",
            kafka=KafkaSource.from_dict(kafka) if kafka else None,
            channel=Channel.from_dict(channel) if channel else Channel(),
            processor=doc.get("processorClass"),
            stream_source=doc.get("streamingProcessClass"),
            quarantine=bool(doc.get("quarantine")),
        )


@dataclass(frozen=True)
class BatchSpec:
    """``rows_per_file`` bounds one output file: a heavier part is cut into several files.

    ``snapshots`` is ``segments`` (a snapshot is a list of folders in its manifest, of which a period adds
    its own) or ``whole`` (``dt=<period>[/part=N]`` holds all history again). ``merge_after`` segments of
    one size are put together. ``snapshot_format`` is that of segments.
    """

    period: str = "P1D"
    keep: str | None = None
    partitioning: Partitioning | None = None
    sort_columns: tuple[str, ...] | None = None
    channel: Channel = Channel()
    processor: str | None = None
    rows_per_file: int = 5_000_000
    snapshots: str = "segments"
    merge_after: int = 8
    snapshot_format: str = "tsv"

    def __post_init__(self) -> None:
        if self.snapshots not in ("segments", "whole"):
            raise ValueError(f"snapshots are segments or whole, not {self.snapshots!r}")
        if self.snapshot_format not in SNAPSHOT_FORMATS:
            raise ValueError(f"unknown snapshot format {self.snapshot_format!r}")
        if self.merge_after < 2:
            raise ValueError("merge_after must be two at least")
        if self.sort_columns is not None:
            object.__setattr__(self, "sort_columns", tuple(self.sort_columns))
        if self.period_millis <= 0:
            raise ValueError(f"period must be positive: {self.period!r}")
        if self.keep is not None:
            interval_bounds(self.keep)
        if self.rows_per_file < 1:
            raise ValueError("rows_per_file must be positive")

    @property
    def period_millis(self) -> int:
        return duration_millis(self.period)

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> BatchSpec:
        part, channel = doc.get("partitioning"), doc.get("notifier")
        return cls(
            period=doc.get("batchDuration") or "P1D",
            keep=doc.get("keepInterval"),
            partitioning=Partitioning.from_dict(part) if part else None,
            sort_columns=doc.get("sortColumns"),
            channel=Channel.from_dict(channel) if channel else Channel(),
            processor=doc.get("processorClass"),
            rows_per_file=doc.get("rowsPerFile") or 5_000_000,
            snapshots=doc.get("snapshots") or "segments",
            merge_after=doc.get("mergeAfter") or 8,
            snapshot_format=doc.get("snapshotFormat") or "tsv",
        )


@dataclass(frozen=True)
class IndexerSpec:
    store: str
    real_time: RealTimeSpec = RealTimeSpec()
    batch: BatchSpec = BatchSpec()
    tables: tuple[str, ...] = ()
    id: str = "rollmill-indexer"

    @property
    def realtime_root(self) -> str:
        return f"{self.store}/realtime"

    @property
    def quarantine_root(self) -> str:
        return f"{self.store}/quarantine"

    @property
    def batch_root(self) -> str:
        return f"{self.store}/batch"

    def partitioning_of(self, table: TableSpec) -> Partitioning | None:
        """The table's own setting wins over the indexer's."""
        chosen = table.partitioning or self.batch.partitioning
        if chosen:
            table.check_partitioning(chosen)
        return chosen

    def sort_of(self, table: TableSpec) -> tuple[str, ...]:
        chosen = table.sort_columns if table.sort_columns is not None else self.batch.sort_columns
        table.check_sort(chosen or ())
        return chosen or ()

    def format_of(self, table: TableSpec) -> str:
        return table.snapshot_format or self.batch.snapshot_format

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> IndexerSpec:
        return cls(
            store=doc["deepStorePath"],
            real_time=RealTimeSpec.from_dict(doc.get("realTime") or {}),
            batch=BatchSpec.from_dict(doc.get("batch") or {}),
            tables=tuple(doc.get("tables") or ()),
            id=doc.get("id") or "rollmill-indexer",
        )


def read_settings(text: str) -> tuple[IndexerSpec, list[TableSpec]]:
    """One JSON document ``{"indexer": {...}, "tables": {name: {...}}}`` with both kinds of settings."""
    doc = json.loads(text)
    indexer = IndexerSpec.from_dict(doc["indexer"])
    return indexer, [TableSpec.from_dict(doc["tables"][name]) for name in indexer.tables]
