"""Sending manifests. A manifest is sent last, so it is the commit mark of the data it names."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from rollmill import files
from rollmill.sources.kafka import producer_options
from rollmill.spec import Channel


def _present(value: Any) -> Any:
    if isinstance(value, Mapping):
        return {k: _present(v) for k, v in value.items() if v is not None}
    return value


def send_manifest(spark: SparkSession, channel: Channel, manifest: Mapping[str, Any]) -> None:
    text = json.dumps(_present(manifest))
    key = str(manifest["id"])
    if channel.type == "file":
        files.write_text(spark, f"{channel.channel}/{channel.queue}", f"{key}.msg", text)
    elif channel.type == "kafka":
        message = spark.createDataFrame([(key, text)], "key STRING, value STRING")
        message.write.format("kafka").options(**producer_options(channel)).save()
    else:
        raise ValueError(f"unsupported manifest channel {channel.type!r}")
