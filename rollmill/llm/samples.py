"""Bounded samples of labelled documents for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bounds of one class's training sample: documents, and characters of all their texts.
MOST_DOCS = 2000
MOST_CHARS = 8_000_000


def folded(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, most_docs: int = MOST_DOCS, most_chars: int = MOST_CHARS
) -> list[tuple[str, int]]:
    """(text, label) of at most ``most_docs`` documents and about ``most_chars`` characters a class,
    picked by a hash of the id. ``keep`` says which labels may be learnt from; labels other than 0
    and 1, and labelled ids that differ in their label, are left out; of an id's texts one is taken."""
    known = labels.where(keep & F.col(label).isin(0, 1)).groupBy("doc_id")
    known = known.agg(F.min(label).alias("y"), F.max(label).alias("y2")).where("y = y2").select("doc_id", "y")
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs) for y in (0, 1)]
    # At most 2 * most_docs ids.
    ids = F.broadcast(picked[0].union(picked[1]).select(F.col("doc_id").alias("__id"), "y"))
    own = docs.select(F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("text"))
    # One text an id, however often it comes, before anything is gathered.
    text = F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("n"), "text")
    rows = own.join(ids, F.col("__doc") == F.col("__id")).groupBy("__id", "y").agg(F.min(text).alias("t"))
    rows = rows.select("__id", "y", "t.text", "t.n")
    by_class = Window.partitionBy("y").orderBy(F.xxhash64("__id"), "__id")
    rows = rows.withColumn("before", F.sum("n").over(by_class) - F.col("n"))
    rows = rows.withColumn("place", F.row_number().over(by_class))
    found = rows.where((F.col("before") < most_chars) & (F.col("place") <= most_docs)).where(F.col("n") <= most_chars)
    return sorted((r["text"], r["y"]) for r in found.select("text", "y").collect())
