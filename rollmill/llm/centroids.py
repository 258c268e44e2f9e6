"""Centroid clustering over exact integers, with dot products kept per vector and updated.

A vector's components become integers, so every distance is exact and no result depends on the order of
summing. Each vector is kept with its squared length and its dot product with every centroid. A round

1. adds, for the components of a centroid that changed, change times component to the vector's dot
   product with that centroid (unchanged components and centroids cost nothing);
2. takes the centroid with the smallest |c|^2 - 2 v.c, which is the distance less |v|^2; ties go to the
   smaller number;
3. writes the vectors with their new dot products, and beside them one row a task and cluster with the
   count and the componentwise sum, so the means need neither a shuffle nor a second look at vectors.

A round is one pass without a shuffle, written to the shared folder; the table before it is deleted once
it stands. Only the sums, at most a row a task and cluster before and a row a cluster after their
aggregate, are shuffled; only the centroids, ``k`` times ``size`` numbers, come to the driver and go out
with the next round's function. No key is shuffled, so a cluster with most of the vectors is no hot spot.

Results: vectors of another length, null ones and ones with a null or non-finite component are left out.
Rows that repeat an id are vectors of their own; the centroids start with the smallest hashes, then the
smallest components; rows without an id are clustered but never start a centroid. Fewer vectors than
centroids make fewer centroids; no vectors, no rows. Empty clusters keep their centroid. Other columns
are carried along, names that clash get underscores before them. Components beyond 2^26 in size are an
error that names the value, as squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill import files
from rollmill.llm.base import fresh
from rollmill.session import scratch_path, stage

LARGEST = 1 << 26
# Vectors an Arrow batch is worked on at a time: bounds the arrays of a task.
BATCH_VECTORS = 4096


def scaled(vector: Column, factor: int) -> Column:
    """Components times ``factor``, rounded down; an error beyond ``LARGEST``."""

    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * F.lit(float(factor)))
        complaint = F.concat(F.lit(f"component times {factor} beyond {LARGEST}: "), x.cast("string"))
        fits = F.abs(x.cast("double") * F.lit(float(factor))) <= F.lit(float(LARGEST))
        return F.when(fits, value).otherwise(F.raise_error(complaint).cast("bigint"))

    return F.transform(vector, whole)


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` components, none of them null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def sha256_of(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1)))


def starting_dots(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return vectors @ centroids.T


def updated_dots(vectors: np.ndarray, dots: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Dot products after ``changes`` were added to the centroids; only nonzero ones are looked at."""
    dots = dots.copy()
    for number in np.flatnonzero(changes.any(axis=1)):
        touched = np.flatnonzero(changes[number])
        dots[:, number] += vectors[:, touched] @ changes[number, touched]
    return dots


def cluster_sums(vectors: np.ndarray, nearest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros((k, vectors.shape[1]), dtype=np.int64)
    np.add.at(sums, nearest, vectors)
    return np.bincount(nearest, minlength=k), sums


# Columns of the working table: a row of a vector has all but the last two, a row of sums the cluster
# and these.
COMPONENTS, SQUARE, DOTS, CLUSTER, DISTANCE, COUNT, SUMS = (
    "components",
    "square",
    "dots",
    "cluster",
    "distance",
    "members",
    "sums",
)


def assign(
    table: DataFrame, names: dict[str, str], centroids: np.ndarray, changes: np.ndarray | None
) -> DataFrame:
    """One round over vectors: dot products (anew where ``changes`` is None), cluster, distance; then the sums."""
    k, size = centroids.shape
    lengths = (centroids * centroids).sum(axis=1)
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    made = {DOTS: longs, CLUSTER: T.IntegerType(), DISTANCE: long, COUNT: long, SUMS: longs}
    made_names = {names[n] for n in made}
    kept = table.select(*(f"`{c}`" for c in table.columns if c not in made_names or c == names[DOTS]))
    plain = [f for f in kept.schema.fields if f.name != names[DOTS]]
    schema = T.StructType([*plain, *(T.StructField(names[n], t) for n, t in made.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=np.int64)
        arrow = None
        for whole in batches:
            for begin in range(0, whole.num_rows, BATCH_VECTORS):
                batch = whole.slice(begin, BATCH_VECTORS)
                vectors = matrix(batch.column(names[COMPONENTS]), size)
                square = batch.column(names[SQUARE]).to_numpy(zero_copy_only=False)
                if changes is None:
                    dots = starting_dots(vectors, centroids)
                else:
                    dots = updated_dots(vectors, matrix(batch.column(names[DOTS]), k), changes)
                away = lengths - 2 * dots
                nearest = np.argmin(away, axis=1)
                distance = square + away[np.arange(len(away)), nearest]
                found = cluster_sums(vectors, nearest, k)
                counts += found[0]
                sums += found[1]
                n = batch.num_rows
                columns = [batch.column(f.name) for f in plain] + [
                    lists(dots),
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distance),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.list_(pa.int64())),
                ]
                out = pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])
                arrow = out.schema
                yield out
        full = np.flatnonzero(counts)
        if arrow is not None:
            columns = [pa.nulls(len(full), arrow.field(f.name).type) for f in plain] + [
                pa.nulls(len(full), pa.list_(pa.int64())),
                pa.array(full.astype(np.int32)),
                pa.nulls(len(full), pa.int64()),
                pa.array(counts[full]),
                lists(sums[full]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)


def means(table: DataFrame, names: dict[str, str], centroids: np.ndarray) -> np.ndarray:
    """The rounded-down mean of every cluster that has vectors, from the rows of sums; the others stay."""
    sums = table.where(F.col(names[COUNT]).isNotNull()).select(
        F.col(names[CLUSTER]).alias("c"), F.col(names[COUNT]).alias("n"), F.posexplode(names[SUMS]).alias("j", "s")
    )
    total = (F.sum(F.col(x).cast("decimal(38,0)")).alias(x) for x in ("n", "s"))
    moved = centroids.copy()
    for row in sums.groupBy("c", "j").agg(*total).collect():  # at most a row a component of a centroid
        moved[row["c"], row["j"]] = int(row["s"]) // int(row["n"])
    return moved


def first_centroids(table: DataFrame, id_column: str, components: str, k: int, seed: int, size: int) -> np.ndarray:
    """Vectors of the ``k`` smallest hashes of ``seed:id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_column}`").cast("string")), 256)
    hashed = table.select(name.alias("hash"), F.col(f"`{components}`").alias("vector")).where("hash IS NOT NULL")
    rows = hashed.orderBy("hash", "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], dtype=np.int64).reshape(len(rows), size)


def cluster(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    k: int,
    rounds: int,
    size: int,
    factor: int = 256,
    seed: int = 0,
) -> tuple[DataFrame, dict[str, str]]:
    """Appends cluster, distance, cluster_inertia, inertia and centroid_sha256; their names in the result."""
    spark = vectors.sparkSession
    names = {n: fresh(vectors, n) for n in (COMPONENTS, SQUARE, DOTS, CLUSTER, DISTANCE, COUNT, SUMS)}
    vector = F.col(f"`{vector_column}`")
    own = [c for c in vectors.columns if c != vector_column]
    whole = F.col(names[COMPONENTS])
    table = vectors.where(usable(vector, size)).withColumn(names[COMPONENTS], scaled(vector, factor))
    table = table.withColumn(names[SQUARE], F.aggregate(whole, F.lit(0).cast("bigint"), lambda s, x: s + x * x))
    folders = [scratch_path(spark, "vectors")]
    table = stage(table, folders[0])

    centroids = first_centroids(table, id_column, names[COMPONENTS], k, seed, size)
    if len(centroids) == 0 and not table.isEmpty():
        raise ValueError(f"no vector with an id in {id_column} to start a centroid")
    changes = None
    if len(centroids):
        for number in range(rounds + 1):
            folders.append(scratch_path(spark, f"assigned-{number}"))
            rows = table if changes is None else table.where(F.col(names[COUNT]).isNull())
            table = stage(assign(rows, names, centroids, changes), folders[-1])
            if number < rounds:
                moved = means(table, names, centroids)
                changes, centroids = moved - centroids, moved
            # the vectors with their new dot products are written: what they were made of can go
            files.delete(spark, folders[-2])
        table = table.where(F.col(names[COUNT]).isNull())
    else:
        table = table.withColumns({names[CLUSTER]: F.lit(None).cast("int"), names[DISTANCE]: F.lit(None).cast("bigint")})

    made = {n: fresh(vectors, n) for n in ("cluster_inertia", "inertia", "centroid_sha256")}
    number = fresh(vectors, "number")
    # at most a row a centroid
    sums = table.groupBy(names[CLUSTER]).agg(F.sum(F.col(names[DISTANCE]).cast("decimal(38,0)"))).collect()
    total = sum(int(inertia) for _, inertia in sums)
    facts = [(n, int(inertia), total, sha256_of(centroids[n].tolist())) for n, inertia in sums]
    types = ("int", "bigint", "bigint", "string")
    schema = ", ".join(f"`{n}` {t}" for n, t in zip((number, *made.values()), types))
    result = table.select(*(f"`{c}`" for c in own), names[CLUSTER], names[DISTANCE])
    known = F.broadcast(spark.createDataFrame(facts, schema))
    joined = result.join(known, result[names[CLUSTER]] == known[number]).drop(number)
    return joined, {n: names.get(n, made.get(n)) for n in (CLUSTER, DISTANCE, *made)}
