"""Centroid clustering against plain integers."""

import hashlib
import math

import numpy as np
import pytest

from rollmill.llm import centroids, queries


def expected(rows, k, rounds, size, factor, seed):
    """id -> list of (cluster, distance, cluster_inertia, inertia, sha), from all distances anew each round."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(factor * x) for x in v]))
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    means = [v for _, v in sorted(named)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in means]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(means)):
            own = [v for (_, v), (n, _) in zip(kept, found) if n == c]
            if own:
                means[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total, out = sum(d for _, d in found), []
    for (i, _), (c, d) in zip(kept, found):
        own = sum(x for n, x in found if n == c)
        out.append((i, c, d, own, total, hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()))
    return sorted(out, key=repr)


def clustered(df, **settings):
    found, names = centroids.cluster(df, "vec_id", "v", **settings)
    made = ["vec_id", *(names[n] for n in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))]
    return sorted((tuple(r) for r in found.select(*made).collect()), key=repr)


def vectors(n, size, seed):
    made = np.random.default_rng(seed).normal(size=(n, size)).round(2)
    return [(i, [float(x) for x in v]) for i, v in enumerate(made)]


def test_dots_are_updated_by_changed_components_only():
    rng = np.random.default_rng(3)
    v, old = rng.integers(-300, 300, (50, 8)), rng.integers(-300, 300, (5, 8))
    new = old.copy()
    new[1, 3] += 7
    new[4] = rng.integers(-300, 300, 8)
    dots = centroids.starting_dots(v, old)
    dots[:, 0] = 0  # an unchanged centroid is not looked at
    got = centroids.updated_dots(v, dots, new - old)
    assert (got[:, 1:] == centroids.starting_dots(v, new)[:, 1:]).all() and not got[:, 0].any()


ODD = [
    (None, [0.5, 0.25, 0.0]),
    (1000, None),
    (1001, [1.0, 2.0]),
    (1002, [1.0, None, 2.0]),
    (1003, [float("nan"), 0.0, 0.0]),
    (1004, [float("-inf"), 0.0, 0.0]),
    (1005, []),
    (7, [9.0, 9.0, 9.0]),  # an id twice
    (1006, [-0.001, 0.001, -0.0]),
    (1006, [-0.001, 0.001, -0.0]),
]


@pytest.mark.parametrize("k, rounds", [(1, 3), (6, 4), (400, 2)])
def test_odd_vectors_ties_and_clashing_names(corpus, k, rounds):
    rows = vectors(150, 3, 1) + ODD
    schema = "vec_id long, v array<float>, Cluster int, distance string, inertia int, components int, number int"
    df = corpus.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], schema).repartition(3)
    as_floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert clustered(df, k=k, rounds=rounds, size=3, factor=256, seed=2) == expected(as_floats, k, rounds, 3, 256, 2)


def test_hot_cluster_and_empty_clusters(corpus):
    rows = [(i, [1.0, 1.0]) for i in range(400)] + [(i, [float(i), -float(i)]) for i in range(400, 420)]
    df = corpus.createDataFrame(rows, "vec_id long, v array<double>")
    assert clustered(df, k=8, rounds=3, size=2, factor=4, seed=0) == expected(rows, 8, 3, 2, 4, 0)


def test_large_components(corpus):
    rows = [(i, [float(2**17 * (i % 3)), -(2.0**17)]) for i in range(20)]
    df = corpus.createDataFrame(rows, "vec_id long, v array<double>")
    assert clustered(df, k=3, rounds=2, size=2, factor=256, seed=0) == expected(rows, 3, 2, 2, 256, 0)
    too_large = corpus.createDataFrame([(1, [1e30, 0.0])], "vec_id long, v array<double>")
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(too_large, "vec_id", "v", k=1, rounds=1, size=2)


def test_no_vectors(corpus):
    df = corpus.createDataFrame([(1, [1.0])], "vec_id long, v array<double>")
    assert clustered(df, k=3, rounds=2, size=2, factor=256, seed=0) == []
    assert clustered(df.limit(0), k=3, rounds=2, size=1, factor=256, seed=0) == []


def test_query_against_plain_integers(corpus):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in corpus.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.op13_centroids(corpus, sf_dir)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, 40, 5, 64, 256, 2)
