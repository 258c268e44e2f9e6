"""Rollup analytics on PySpark: parse, pre-aggregate, merge, balance and publish event data."""

from rollmill.spec import (
    BatchSpec,
    Channel,
    Dimension,
    IndexerSpec,
    KafkaSource,
    Metric,
    ParseSpec,
    Partitioning,
    RealTimeSpec,
    TableSpec,
)

__all__ = [
    "BatchSpec",
    "Channel",
    "Dimension",
    "IndexerSpec",
    "KafkaSource",
    "Metric",
    "ParseSpec",
    "Partitioning",
    "RealTimeSpec",
    "TableSpec",
]
