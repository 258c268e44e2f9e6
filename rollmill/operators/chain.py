"""Processors: any callable from DataFrame to DataFrame, and chains of them."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

Processor = Callable[[DataFrame], DataFrame]


def chain(*steps: Processor) -> Processor:
    """Apply the steps in the order given."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def load_hook(path: str) -> Any:
    """Object named ``package.module:attribute`` (or ``package.module.attribute``)."""
    module, _, attribute = path.partition(":") if ":" in path else path.rpartition(".")
    if not module or not attribute:
        raise ValueError(f"not an importable name: {path!r}")
    return getattr(importlib.import_module(module), attribute)
