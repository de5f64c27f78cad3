import re

import pytest
from pyspark.sql import functions as F

from traitrank.llm.mixing import mix, plan_mix
from traitrank.llm.queries import llm_queries


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above a cap is shared again by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: most * sizes[s] for s in above}


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] = sizes.get(source, 0) + n
    goals = slow_targets(sizes)
    of = {i: s for i, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[of[r.doc_id]]
        assert r.target == pytest.approx(goals[of[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0)
        taken[of[r.doc_id]] += r.taken
    return {s: (taken[s], goals[s]) for s in sizes}


def test_query_meets_targets(spark, given):
    rows = [(r.doc_id, r.text, r.source) for r in given("documents")]
    query = llm_queries()["op5_mixing"]
    got = query(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(rows)
    for taken, goal in check(rows, got).values():
        assert taken == pytest.approx(goal, rel=0.02)
    assert sorted(got) == sorted(query(spark, "/root/testdata/sf0.001").collect())


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 40 + 1), "big") for i in range(400)] + [
        (500, "a b\x0bc", None), (501, None, "void"), (502, "", "void"), (503, "one", "tiny"), (503, "one", "tiny"),
        (504, "w " * 9000, "big"), (None, "x y", "big"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    plan = plan_mix(df).collect()
    assert sum(r.m for r in plan) == len(rows)
    by = {(r.doc_id, r.src): r for r in plan}
    assert by[501, "avoid"].copies == 0 and by[501, "avoid"].target == 0
    assert by[503, "atiny"].m == 2 and by[503, "atiny"].copies == 6 and by[503, "atiny"].target == 6
    big = sum(r.copies * r.size for r in plan if r.src == "abig")
    assert big == pytest.approx(by[504, "abig"].target, rel=0.01)
    out = mix(df)
    assert out.columns == df.columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert n == {r.doc_id: r.copies for r in plan if r.copies}
    assert plan_mix(df.limit(0)).collect() == [] and mix(df.limit(0)).collect() == []
    assert {r.copies for r in plan_mix(df.filter("source = 'void'")).collect()} == {0}
