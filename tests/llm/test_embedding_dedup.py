import numpy as np
import pytest
from pyspark.sql import functions as F

from traitrank.llm import embedding_dedup
from traitrank.llm.embedding_dedup import vector_classes
from traitrank.llm.queries import llm_queries


def brute_force(rows, threshold=0.93):
    """(id, links, component) of every row by comparing all pairs."""
    usable = {}
    for n, (key, vector, label) in enumerate(rows):
        if key is None or label is None or not vector or any(v is None or not np.isfinite(v) for v in vector) or not any(vector):
            continue
        usable.setdefault((label, len(vector)), []).append((n, np.array(vector, float)))
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for group in usable.values():
        at = [n for n, _ in group]
        unit = np.stack([v / np.linalg.norm(v) for _, v in group])
        near = unit @ unit.T >= threshold
        for i, j in zip(*np.nonzero(near)):
            if i != j:
                links[at[i]] += 1
                parent[root(at[i])] = root(at[j])
    least = {}
    for n, row in enumerate(rows):
        if row[0] is not None:
            least[root(n)] = min(least.get(root(n), row[0]), row[0])
    return sorted((row[0] if row[0] is not None else -1, links[n], least.get(root(n), -1)) for n, row in enumerate(rows))


def found(df):
    for r in df.collect():
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
    return sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in df.collect())


def planted(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dims))
    rows = []
    for i in range(n):
        v = centres[i % len(centres) if i % 3 else 0] + rng.normal(size=dims) * rng.choice([0.1, 0.3, 3])
        rows.append((i, v.astype(np.float32).tolist(), int(i % 4 == 0)))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block", [32, 1024])
def test_few_lists_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "PROBES", 24)
    rows = planted(600, 0)
    assert found(vector_classes(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute_force(rows)


def test_vectors_of_all_lengths(spark, monkeypatch):
    """Shorter and longer vectors than most link among themselves, and with no other length."""
    monkeypatch.setattr(embedding_dedup, "PROBES", 24)
    rows = planted(300, 3)
    for start, dims in ((1000, 5), (2000, 40)):
        rows += [(start + i, v, label) for i, v, label in planted(90, dims, dims)]
    rows += [(3000, rows[0][1] + [0.0], 1)]
    expected = brute_force(rows)
    assert sum(n for key, n, _ in expected if 2000 <= key < 3000) and sum(n for key, n, _ in expected if 1000 <= key < 2000)
    assert found(vector_classes(spark.createDataFrame(rows, SCHEMA).repartition(5))) == expected


def test_recall(spark):
    rows = planted(3000, 1)
    monkey = brute_force(rows)
    got = found(vector_classes(spark.createDataFrame(rows, SCHEMA)))
    assert sum(min(a[1], b[1]) for a, b in zip(got, monkey)) >= 0.9 * sum(b[1] for b in monkey) > 0
    assert all(a[1] <= b[1] for a, b in zip(got, monkey))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = planted(40, 2, 3) + [
        (100, None, 1), (101, [], 1), (102, [0.0, 0.0, 0.0], 1), (103, [nan, 1.0, 1.0], 1), (104, [inf, 1.0, 1.0], 1),
        (105, [None, 1.0, 1.0], 1), (106, [1.0, 2.0, 3.0], None), (107, [1.0, 2.0, 3.0], None), (None, [1.0, 2.0, 3.0], 1),
        (108, [5.0, 0.0, -0.0], 9), (109, [5.0, -0.0, 0.0], 9), (110, [1e-30, 0.0, 0.0], 9), (108, [5.0, 0.0, 0.0], 9),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x"))
    assert found(vector_classes(df)) == brute_force(rows)
    assert vector_classes(df.limit(0)).collect() == []
    assert found(vector_classes(df.filter("label IS NULL"))) == [(106, 0, 106), (107, 0, 107)]


def test_query(spark, given):
    rows = [(r.vec_id, r.embedding, r.label) for r in given("embeddings")]
    assert found(llm_queries()["op8_embeddings"](spark, "/root/testdata/sf0.001")) == brute_force(rows)
