"""Small file-system chores on the store, through the Hadoop API Spark itself uses."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if there is no such folder."""
    fs, where = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a small file under a hidden name and move it into place, so readers see all of it or nothing."""
    fs, hidden = _open(spark, f"{folder}/_{name}.tmp")
    _, final = _open(spark, f"{folder}/{name}")
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    fs.delete(final, False)
    if not fs.rename(hidden, final):
        raise OSError(f"cannot move {hidden} to {final}")
