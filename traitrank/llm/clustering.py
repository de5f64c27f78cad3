"""Lloyd's rounds on whole-number vectors with a LAESA pivot table.

The distances of every vector to a few fixed pivots are worked out once and stored with it. In a
round, the centroids' distances to the same pivots come from the driver; by the triangle inequality
the largest difference over the pivots bounds a vector's distance to a centroid from below. The
centroid with the lowest bound gets its exact distance first, and only those whose bound does not
exceed it get theirs. Bounds are in double precision with slack, distances and sums exact.

A round reads the table once and gives a sum and a count per task and cluster, so a cluster may
hold any share of the vectors. The driver sees the centroids, never the vectors.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitrank.llm.common import shuffle_partitions
from traitrank.llm.vectors import packed, whole_numbers
from traitrank.sources.staging import Staging

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
DIMS = 64
# Pivots, and the vectors that they are chosen from, by a hash of the id.
PIVOTS = 16
PIVOT_SAMPLE = 1024
_SLACK = 1e-9


def _square_distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    rest = rows.astype(np.int64) - point.astype(np.int64)
    return np.einsum("ij,ij->i", rest, rest)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows far from each other: each next one is the farthest from those before."""
    at = [0]
    far = _square_distances(sample, sample[0])
    while len(at) < min(n, len(sample)) and far.max() > 0:
        at.append(int(far.argmax()))
        far = np.minimum(far, _square_distances(sample, sample[at[-1]]))
    return sample[at]


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_square_distances(rows, p) for p in pivots], axis=1).astype(np.float64))


def nearest(rows: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple:
    """Cluster, exact squared distance and number of distances worked out, for each row.

    ``table`` holds the rows' distances to the pivots. Ties go to the smaller number.
    """
    theirs = pivot_distances(centroids, pivots)
    bounds = np.abs(table[:, None, :] - theirs[None, :, :]).max(axis=2)
    slack = _SLACK * (1 + table.max(initial=0) + theirs.max(initial=0))
    floors = np.maximum(bounds - slack, 0) ** 2
    first = floors.argmin(axis=1)
    cluster, best = first.astype(np.int32), np.empty(len(rows), np.int64)
    compared = np.ones(len(rows), np.int32)
    for c, centroid in enumerate(centroids):
        own = np.flatnonzero(first == c)
        best[own] = _square_distances(rows[own], centroid)
    for c, centroid in enumerate(centroids):
        left = np.flatnonzero((first != c) & (floors[:, c] <= best * (1 + _SLACK)))
        far = _square_distances(rows[left], centroid)
        better = (far < best[left]) | ((far == best[left]) & (c < cluster[left]))
        cluster[left[better]], best[left[better]] = c, far[better]
        compared[left] += 1
    return cluster, best, compared


def _pivot_table(pivots: np.ndarray):
    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = packed(batch["ints"])
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"].astype("Int64"), "vector": [r.tobytes() for r in rows],
                    "pivots": [d.tobytes() for d in pivot_distances(rows, pivots)],
                })

    return table


def _assigned(batches: Iterator[pd.DataFrame], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple]:
    for batch in batches:
        if len(batch):
            rows = packed(batch["vector"])
            table = np.frombuffer(b"".join(batch["pivots"]), np.float64).reshape(len(batch), -1)
            yield batch, rows, nearest(rows, table, centroids, pivots)


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """Per task: count and componentwise sum of each cluster that has vectors."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(centroids), centroids.shape[1]), np.int64)
        n = np.zeros(len(centroids), np.int64)
        for _, rows, (cluster, _, _) in _assigned(batches, centroids, pivots):
            n += np.bincount(cluster, minlength=len(centroids))
            for c in range(len(centroids)):
                total[c] += rows[cluster == c].sum(axis=0, dtype=np.int64)
        held = np.flatnonzero(n)
        if len(held):
            yield pd.DataFrame({"cluster": held.astype(np.int32), "n": n[held], "sums": [total[c].tolist() for c in held]})

    return sums


def _labels(centroids: np.ndarray, pivots: np.ndarray):
    def labels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, _, (cluster, best, compared) in _assigned(batches, centroids, pivots):
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cluster": cluster, "distance": best, "n_compared": compared})

    return labels


def _next(index: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round. An empty cluster keeps its own."""
    parts = index.mapInPandas(_sums(centroids, pivots), "cluster int, n long, sums array<long>")
    added = (
        parts.select("cluster", "n", F.posexplode("sums").alias("dim", "part")).groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    )
    moved = centroids.copy()
    for r in added.collect():  # clusters x components
        moved[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_compared).

    One row per row of ``vectors`` with exactly ``DIMS`` components, none null or non-finite; other
    rows are left out, as are those with a component of 2**27 / ``SCALE`` or more, whose squared
    distances would not fit 63 bits. Rows that repeat an id are vectors of their own, rows without id are last
    in the choice of first centroids. Fewer rows than ``clusters`` give as many clusters, an empty
    table an empty result. An inertia beyond 63 bits is null. ``n_compared`` says how many of the
    centroids the last round worked out for the vector. Further columns are not looked at.
    """
    staging = Staging.of(vectors)
    given = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    kept = whole_numbers(given.filter(F.size("embedding") == DIMS), "embedding", SCALE).select("vec_id", "ints")
    kept = staging.write(kept, "vectors")

    def by_hash(salt: str):
        return F.coalesce(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256), F.lit("none"))

    seeds = kept.orderBy(by_hash("3"), "ints").limit(clusters).select("ints").collect()
    if not seeds:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_compared int"
        )
    centroids = np.array([r["ints"] for r in seeds], np.int64)
    sample = kept.orderBy(by_hash("pivot"), "ints").limit(PIVOT_SAMPLE).select("ints").collect()
    pivots = choose_pivots(np.array([r["ints"] for r in sample], np.int64), PIVOTS)
    index = staging.write(
        kept.repartition(shuffle_partitions(vectors.sparkSession)).mapInPandas(
            _pivot_table(pivots), "vec_id long, vector binary, pivots binary"
        ),
        "pivot_table",
    )
    for _ in range(rounds):
        moved = _next(index, centroids, pivots)
        if np.array_equal(moved, centroids):
            break  # further rounds would change nothing
        centroids = moved
    labelled = staging.write(
        index.mapInPandas(_labels(centroids, pivots), "vec_id long, cluster int, distance long, n_compared int"), "clusters"
    )
    sums = {r["cluster"]: int(r["d"]) for r in labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def long(n: int):
        return n if n < 1 << 63 else None

    each = F.from_json(F.lit(json.dumps([long(sums.get(c, 0)) for c in range(len(centroids))])), "array<bigint>")
    place = F.col("cluster") + 1
    return labelled.select(
        "vec_id", "cluster", "distance",
        F.element_at(each, place).alias("cluster_inertia"),
        F.lit(long(sum(sums.values()))).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, hashes)), place).alias("centroid_sha256"),
        "n_compared",
    )


def _oracle() -> str:
    """The same rounds as plain joins, one pair of tables a round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMS}
)""",
        "x AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS d, unnest(v) AS x FROM kept)",
        f"""c0 AS MATERIALIZED (
  SELECT k, unnest(range(64)) AS d, unnest(v) AS c FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM kept
    QUALIFY k < {CLUSTERS}
  )
)""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT vec_id, min(far * {CLUSTERS} + k) AS best FROM (
    SELECT vec_id, k, sum((x - c) * (x - c))::BIGINT AS far FROM x JOIN c{i} USING (d) GROUP BY vec_id, k
  ) GROUP BY vec_id
)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT k, d, coalesce((s - ((s % n) + n) % n) // n, c)::BIGINT AS c FROM c{i} LEFT JOIN (
    SELECT best % {CLUSTERS} AS k, d, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN x USING (vec_id) GROUP BY ALL
  ) USING (k, d)
)"""
            )
    return f"""WITH {", ".join(steps)},
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY d)) AS sha FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, far AS distance, (sum(far) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(far) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM (SELECT vec_id, best % {CLUSTERS} AS k, best // {CLUSTERS} AS far FROM a{ROUNDS}) JOIN h USING (k)"""


ORACLE = _oracle()
