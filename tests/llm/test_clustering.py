"""Pivot-table clustering against plain rounds and SQL, and hard tables."""

import hashlib
import math

import numpy as np
import pytest
from comparing import compare

from traitrank.llm import clustering
from traitrank.llm.queries import llm_oracles, op11_clustering

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(given, clusters=8, rounds=10):
    """(vec_id, cluster, distance) and centroid hashes in plain Python integers."""
    kept = [
        (i, [math.floor(1024 * float(x)) for x in v]) for i, v, _ in given
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "none", r[1]))
    centroids = [v for _, v in start[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = []
    for (i, _), (d, k) in zip(kept, found):
        rows.append((i, k, d, sum(a for a, b in found if b == k), sum(a for a, _ in found), hashes[k]))
    return sorted(rows, key=repr)


def result(spark, given, schema=SCHEMA, **options):
    df = clustering.cluster_vectors(spark.createDataFrame(given, schema), **options)
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def test_given_vectors_against_sql(spark, duck):
    df = op11_clustering(spark, "/root/testdata/sf0.001")
    assert compare(df, duck, llm_oracles()["op11_clustering"]) is None


def test_hard_table(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 64))
    given = [(i, (centres[i % 9] + rng.normal(size=64) / 4).tolist(), i % 3) for i in range(300)]
    given += [(1000 + i, given[0][1], 0) for i in range(200)]  # ties and copies
    given += [(7, given[1][1], 1), (7, given[1][1], 1), (None, given[2][1], 1), (None, [0.0] * 64, None)]
    given += [(2000, None, 1), (2001, [], 1), (2002, [0.5] * 63, 1), (2003, [float("nan")] * 64, 1)]
    given += [(2004, [float("inf")] + [0.0] * 63, 1), (2005, [None] + [0.0] * 63, 1), (2006, [-0.0] * 64, 1)]
    given = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in given]
    assert result(spark, given) == plain(given)
    assert result(spark, given, clusters=3, rounds=2) == plain(given, 3, 2)


@pytest.mark.parametrize("given", [[], [(1, None, 1)], [(1, [0.25] * 64, 1)], [(i, [i / 8] * 64, 1) for i in range(5)]])
def test_tiny_tables_and_other_columns(spark, given):
    assert result(spark, [(*g, "x") for g in given], SCHEMA + ", cluster string") == plain(given)


def test_pivots_spare_distances(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 64)) * 4
    given = [(i, (centres[i % 8] + rng.normal(size=64) / 8).tolist(), 0) for i in range(400)]
    spent = [r["n_compared"] for r in clustering.cluster_vectors(spark.createDataFrame(given, SCHEMA)).collect()]
    assert sum(spent) < 400 * 8 / 2


def test_bounds_never_shut_out_the_nearest():
    rng = np.random.default_rng(2)
    for scale in (1, 1 << 10, 1 << 26):
        rows = rng.integers(-scale, scale + 1, (500, 64))
        pivots = clustering.choose_pivots(rows[:50], 16)
        centroids = rng.integers(-scale, scale + 1, (8, 64))
        centroids[5] = centroids[2]
        cluster, best, _ = clustering.nearest(rows, clustering.pivot_distances(rows, pivots), centroids, pivots)
        far = np.stack([clustering._square_distances(rows, c) for c in centroids], axis=1)
        assert (cluster == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
