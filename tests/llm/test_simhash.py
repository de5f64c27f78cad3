import random

import numpy as np
import pytest
import xxhash

from traitrank.llm.simhash import drop_near_copies, fingerprint_of, hamming_links, near_pairs, simhash_classes
from traitrank.llm.components import components
from traitrank.sources.staging import Staging


def slow_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "One two", "a B\x0bc d\x0ce Ünï x y", "w " * 999])
def test_fingerprint_equals_definition(text):
    assert fingerprint_of(None if text is None else text.encode()) == slow_fingerprint(text)


def reach(codes, distance):
    """node -> smallest node reachable, by trying all pairs."""
    parent = {n: n for _, n in codes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (x, a) in enumerate(codes):
        for y, b in codes[:i]:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= distance:
                a_, b_ = root(a), root(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {n: root(n) for _, n in codes}


def planted(n, seed):
    rng = random.Random(seed)
    codes = {rng.getrandbits(64) for _ in range(n)}
    for centre in list(codes)[: n // 4] + [0] * (n // 2):
        for _ in range(rng.randint(1, 4)):
            code = centre
            for _ in range(rng.randint(1, 4)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    return [(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(sorted(codes, key=hash))]


def test_near_pairs_finds_all():
    codes = np.array(sorted(c & (1 << 64) - 1 for c, _ in planted(300, 1)), dtype=np.uint64)
    i, j = near_pairs(codes, codes, 3)
    expected = {(x, y) for x in range(len(codes)) for y in range(len(codes)) if int(codes[x] ^ codes[y]).bit_count() <= 3}
    assert set(zip(i.tolist(), j.tolist())) == expected


@pytest.mark.parametrize("leaf", [8, 1024])
def test_links_connect_like_all_pairs(spark, leaf):
    codes = planted(400, 2)
    staging = Staging(spark)
    df = spark.createDataFrame(codes, "code long, node long").repartition(5)
    got = {r.node: r.component for r in components(hamming_links(df, staging, leaf=leaf), staging).collect()}
    expected = reach(codes, 3)
    assert {n: got.get(n, n) for n in expected} == expected


def test_classes_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (5, None, "x"), (3, "", "x"), (9, long, None), (7, long.upper(), "y"), (7, long.upper(), "y"),
        (None, long, "z"), (None, "alone here", "z"), (8, "quite another text", "z"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = [((r.doc_id or -1), (r.component_id or -1)) for r in simhash_classes(df).collect()]
    assert sorted(got) == [(-1, -1), (-1, 7), (3, 3), (5, 3), (7, 7), (7, 7), (8, 8), (9, 7)]
    kept = drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 3, 7, 7, 8]
    assert simhash_classes(df.limit(0)).collect() == []


def test_query_equals_all_pairs(spark):
    from traitrank.llm.queries import llm_queries

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    expected = reach([(p, i) for i, p in prints.items()], 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in llm_queries()["op6_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", expected[i]) for i in texts}
