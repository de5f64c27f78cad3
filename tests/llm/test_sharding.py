"""Shards by bytes: gapless slots, sizes, equal texts, and hard tables."""

import zlib
from collections import Counter, defaultdict

import pytest

from traitrank.llm import sharding

SCHEMA = "doc_id long, text string"


def check(rows, given, shards):
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in given)
    texts = defaultdict(Counter)
    for d, t in given:
        t = (t or "").encode()
        texts[d][(len(t) + 16, zlib.crc32(t))] += 1
    got = defaultdict(Counter)
    for r in rows:
        got[r["doc_id"]][(r["size"], r["text_crc32"])] += 1
    assert got == texts
    sizes, slots = [0] * shards, defaultdict(list)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    mean, most = sum(sizes) / shards, max((r["size"] for r in rows), default=0)
    room = max(most - mean, 0) + 3 * mean / sharding.FINE + 1
    assert max(sizes, default=0) - mean <= room
    return sizes


@pytest.mark.parametrize("table", ["documents"])
def test_given_documents(spark, given, table):
    from traitrank.llm.queries import op12_sharding

    docs = [(r["doc_id"], r["text"]) for r in given(table)]
    check(op12_sharding(spark, "/root/testdata/sf0.001").collect(), docs, 40)


def test_hot_text_large_records_and_repeated_rows(spark):
    given = [(i, "copy of one text " * 3) for i in range(3000)]
    given += [(10_000 + i, f"text {i} " * (i % 40)) for i in range(4000)]
    given += [(20_000 + i, "x" * 40_000) for i in range(7)]
    given += [(30_000, "the same row")] * 2000
    given += [(None, None), (None, ""), (40_000, None), (40_001, "")]
    rows = sharding.shard_by_bytes(spark.createDataFrame(given, SCHEMA), shards=5).collect()
    sizes = check(rows, given, 5)
    assert max(sizes) - min(sizes) < 0.1 * sum(sizes) / 5
    homes = defaultdict(set)
    for r in rows:
        if 10_000 <= (r["doc_id"] or 0) < 20_000:
            homes[r["text_crc32"]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


@pytest.mark.parametrize("given", [[], [(1, "a")], [(1, None)], [(1, "z" * 100_000), (2, "b"), (3, "b")]])
def test_tiny_tables(spark, given):
    rows = sharding.shard_by_bytes(spark.createDataFrame(given, SCHEMA), shards=4).collect()
    check(rows, given, 4)


def test_reruns_agree_and_columns_are_kept(spark):
    given = [(i, f"t{i % 50}" * (i % 9), f"s{i}") for i in range(500)]
    docs = spark.createDataFrame(given, SCHEMA + ", __size string")
    one, two = (
        sorted(map(tuple, sharding.shard_by_bytes(d, shards=3, keep=("__size", "text")).collect()), key=repr)
        for d in (docs, docs.repartition(7))
    )
    assert one == two
    assert {(r[0], r[8], r[7]) for r in one} == {tuple(g) for g in given}
    with pytest.raises(ValueError, match="size"):
        sharding.shard_by_bytes(docs.withColumn("size", docs.doc_id), keep=("size",))


def test_written_shards(spark, tmp_path):
    given = [(i, f"text {i} " * (i % 17)) for i in range(300)]
    back = sharding.write_shards(spark.createDataFrame(given, SCHEMA), f"{tmp_path}/shards", shards=6, keep=("text",))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == given
    assert back.select("shard").distinct().count() == 6


def test_levels():
    shares = sharding._shares([10, 0, 4], 11)
    assert [round(s, 6) for s in shares] == [0, 7.5, 3.5]
    assert sharding._shares([5, 0], 2) == [0, 2]
    assert sharding._quantiles([((1, 0), 3), ((2, 0), 9), ((3, 0), 1)], 4) == [(2, 0)]
