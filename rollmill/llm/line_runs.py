"""Repeated runs of lines, by a suffix array over line numbers; later copies are deleted.

1. Lines are hashed to 128 bits; a line that occurs once ends every run. What is left are islands:
   stretches of repeated lines within a document, of ``min_words`` words or more. All their lines, in
   order of (doc_id, text hash, line), are one sequence of places.
2. Suffix ranks by prefix doubling: first a line's rank among all lines, then round by round the
   rank of (rank here, rank 2^k lines on) within its group, by counts of distinct pairs that are
   summed up before anything is shuffled. A suffix that leaves its island sorts first in its group.
   Ranks equal at 2^k mean: the longest common prefix has 2^k lines or more.
3. A shortest run of ``min_words`` words from a place on, or up to a place, is a prefix of suffixes
   that form one longest-common-prefix interval; two overlapping ranks of 2^k lines name it. If the
   interval holds an earlier place, this run is a later copy. Every repeated run of enough words is the
   union of such runs, so the lines they cover are exactly those of later copies of maximal runs.
   Doubling stops at the length of the longest such run.

Functions of SQL only. Texts are shuffled once, at the end, to their removed line ranges.

Results: null and empty texts come back as they are; rows that repeat doc_id and text count as one
document, and get the same result; rows with the same doc_id and different texts are ordered by a
hash of the text, a null doc_id comes first; blank lines belong to the runs around them; other
columns are carried along; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmill.llm.base import fresh
from rollmill.session import scratch_path, stage

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    return stage(df, scratch_path(df.sparkSession, f"lines-{name}"))


def ordinals(df: DataFrame, order: list[str], size: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``size`` over all rows before, in order; no task sees all rows."""
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = staged(ranged.withColumn("__size", size), "order")
    totals = ranged.groupBy("__part").agg(F.sum("__size").alias("__total"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    base = totals.select("__part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("__in", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(base), "__part")
    return placed.withColumn(name, F.col("__base") + F.col("__in")).drop("__part", "__size", "__base", "__in")


def islands(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, version, line, h1, h2, w, place, begin and stop of each repeated line in a long enough stretch."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("line", "s"))
    lines = lines.select(
        "doc_id",
        "version",
        "line",
        F.xxhash64("s").alias("h1"),
        F.xxhash64(F.lit("second"), "s").alias("h2"),
        F.regexp_count("s", F.lit(WORD)).alias("w"),
    )
    often = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    found = lines.join(often, ["h1", "h2"]).dropDuplicates(["doc_id", "version", "line"])
    in_doc = Window.partitionBy("doc_id", "version").orderBy("line")
    found = found.withColumn("island", F.col("line") - F.row_number().over(in_doc))
    whole = Window.partitionBy("doc_id", "version", "island")
    found = found.withColumn("words", F.sum("w").over(whole)).where(F.col("words") >= min_words).drop("words")
    placed = ordinals(found, ["doc_id", "version", "line"], F.lit(1), "place")
    return staged(
        placed.withColumn("begin", F.min("place").over(whole))
        .withColumn("stop", F.max("place").over(whole) + 1)
        .drop("island"),
        "islands",
    )


def shortest_runs(rows: DataFrame, min_words: int) -> DataFrame:
    """(side, begin, stop) of the shortest run of enough words from every place on, and up to every
    place, inside its island."""
    so_far = Window.partitionBy("begin").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("begin", "stop", "place", "w", F.coalesce(F.sum("w").over(so_far), F.lit(0)).alias("c"))
    rows = staged(rows, "words")  # c: words of the island before this line
    at = rows.select("begin", F.col("c").alias("v"), F.lit(0).alias("asks"), "place")
    # The island's end counts as a place where a run can stop.
    end = rows.where(F.col("place") + 1 == F.col("stop"))
    end = end.select("begin", (F.col("c") + F.col("w")).alias("v"), F.lit(0), F.col("stop"))
    ahead = at.union(end).union(rows.select("begin", F.col("c") + min_words, F.lit(1), "place"))
    down = Window.partitionBy("begin").orderBy(F.desc("v"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.min(F.when(F.col("asks") == 0, F.col("place"))).over(down)
    ahead = ahead.select("begin", "asks", "place", stop.alias("to")).where("asks = 1 AND to IS NOT NULL")
    behind = at.union(rows.select("begin", F.col("c") + F.col("w") - min_words, F.lit(1), F.col("place")))
    up = Window.partitionBy("begin").orderBy("v", "asks").rowsBetween(Window.unboundedPreceding, 0)
    start = F.max(F.when(F.col("asks") == 0, F.col("place"))).over(up)
    behind = behind.select("asks", "place", start.alias("from")).where("asks = 1 AND from IS NOT NULL")
    return staged(
        ahead.select(F.lit("on").alias("side"), F.col("place").alias("begin"), F.col("to").alias("stop")).union(
            behind.select(F.lit("up"), F.col("from"), F.col("place") + 1)
        ),
        "runs",
    )


def suffix_ranks(rows: DataFrame, levels: int) -> DataFrame:
    """(place, k, rank) for k up to ``levels``: ranks of the suffixes by their first 2^k lines."""
    counts = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    first = ordinals(counts, ["h1", "h2"], F.col("n"), "rank").select("h1", "h2", (F.col("rank") + 1).alias("rank"))
    now = staged(rows.join(first, ["h1", "h2"]).select("place", "begin", "rank"), "rank-0")
    out = now.select("place", F.lit(0).alias("k"), "rank")
    for k in range(1, levels + 1):
        ahead = F.lead("rank", 2 ** (k - 1), 0).over(Window.partitionBy("begin").orderBy("place"))
        pairs = staged(now.withColumn("next", ahead), f"pairs-{k}")
        moved = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))
        # A rank is one more than the places ranked before, so the sum over all pairs before gives it.
        moved = ordinals(moved, ["rank", "next"], F.col("n"), "before")
        moved = moved.select("rank", "next", (F.col("before") + 1).alias("to")).where("to > rank")
        now = pairs.join(moved, ["rank", "next"], "left")
        now = now.select("place", "begin", F.coalesce("to", "rank").alias("rank"))
        now = staged(now, f"rank-{k}")
        out = out.union(now.select("place", F.lit(k).alias("k"), "rank"))
    return out


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, version and the removed line ranges of every document that has some, as ``cuts``, an
    array of (first, last)."""
    rows = islands(docs, min_words)
    runs = shortest_runs(rows, min_words)
    longest = runs.agg(F.max(F.col("stop") - F.col("begin"))).first()[0] or 1
    ranks = suffix_ranks(rows, longest.bit_length() - 1)
    level = sum(((F.col("stop") - F.col("begin")) >= 2**k).cast("int") for k in range(1, longest.bit_length()))
    named = runs.withColumn("k", level if longest > 1 else F.lit(0))
    named = named.withColumn("tail", F.expr("stop - CAST(power(2, k) AS bigint)"))
    one = ranks.select(F.col("place").alias("begin"), "k", F.col("rank").alias("head_rank"))
    two = ranks.select(F.col("place").alias("tail"), "k", F.col("rank").alias("tail_rank"))
    named = named.join(one, ["begin", "k"]).join(two, ["tail", "k"])
    named = staged(named.withColumn("length", F.col("stop") - F.col("begin")), "named")
    name = ["side", "length", "head_rank", "tail_rank"]
    first = named.groupBy(*name).agg(F.min("begin").alias("first"), F.max("begin").alias("last")).where("first < last")
    copies = named.join(first, name).where("begin > first").groupBy("begin").agg(F.max("stop").alias("to"))

    reach = Window.partitionBy("begin").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    covered = rows.join(copies.select(F.col("begin").alias("place"), "to"), "place", "left")
    covered = covered.withColumn("to", F.max("to").over(reach)).where("to > place")
    in_doc = Window.partitionBy("doc_id", "version").orderBy("line")
    cuts = covered.withColumn("cut", F.col("line") - F.row_number().over(in_doc))
    cuts = cuts.groupBy("doc_id", "version", "cut").agg(F.min("line").alias("first"), F.max("line").alias("last"))
    return cuts.groupBy("doc_id", "version").agg(F.collect_list(F.struct("first", "last")).alias("cuts"))


def drop_later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines of later copies, and how many lines went, as ``n_removed``."""
    name, version, own, cuts = (fresh(docs, n) for n in ("n_removed", "version", "own_id", "cuts"))
    found = staged(later_copies(docs.select("doc_id", "text"), min_words), "cuts")
    found = found.select(F.col("doc_id").alias(own), F.col("version").alias(version), F.col("cuts").alias(cuts))
    # Always shuffled: what is cut grows with the documents, so no size of it may decide the plan.
    joined = docs.join(
        found.hint("merge"), docs["doc_id"].eqNullSafe(found[own]) & (F.xxhash64(docs["text"]) == found[version]), "left"
    )

    def stays(line: Column, i: Column) -> Column:
        return ~F.exists(F.col(cuts), lambda cut: i.between(cut["first"], cut["last"]))

    kept = F.array_join(F.filter(F.split(docs["text"], "\n"), stays), "\n")
    gone = F.aggregate(F.col(cuts), F.lit(0).cast("long"), lambda n, cut: n + cut["last"] - cut["first"] + 1)
    text = F.when(F.col(cuts).isNull(), docs["text"]).otherwise(kept)
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    return joined.select(*columns, F.coalesce(gone, F.lit(0)).cast("long").alias(name))
