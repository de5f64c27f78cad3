"""Properties of the score and rank, against a plain Python computation."""

import random
from collections import Counter, defaultdict

import pytest
from comparing import rows
from pyspark.sql import functions as F

from traitrank.operators import joins, ordering, rarity
from traitrank.sources.staging import Staging

TRAITS = "collection_id string, token_id string, trait_type string, trait_value string"
BASE = "collection_id string, token_id string"


def expected_ranks(traits, base):
    usable = [t for t in traits if None not in t]
    n = Counter((c, t, v) for c, _, t, v in usable)
    total = Counter((c, t) for c, _, t, _ in usable)
    score = defaultdict(int)
    for c, token, t, v in usable:
        rest = total[c, t] - n[c, t, v]
        score[c, token] += int(n[c, t, v] / rest * 100) if rest else 0
    out = []
    for collection in {c for c, _ in base}:
        tokens = {t for c, t in base if c == collection and t is not None}
        ordered = sorted((score[collection, t], t) for t in tokens)
        out += [(collection, t, s, i + 1) for i, (s, t) in enumerate(ordered)]
    return sorted(out, key=repr)


def sample(seed, hot=0.0):
    """Collections of uneven size; with ``hot``, that share of the rows in one value."""
    rng = random.Random(seed)
    base, traits = [], []
    for i in range(400):
        c = "1" if rng.random() < max(hot, 0.4) else str(rng.randint(2, 5))
        token = str(rng.randint(0, 250))
        base += [(c, token)] * rng.choice([1, 1, 2])
        if rng.random() < 0.2:
            continue
        for t in ("hat", "eyes", "fur", "one"):
            v = "only" if t == "one" else "plain" if rng.random() < hot else str(rng.randint(0, 9))
            traits.append((c, token, t, v))
    traits += [("1", "9", "hat", None), ("1", "9", None, "x"), ("1", None, "hat", "0"), ("1", "withdrawn", "hat", "0")]
    return traits, base + [("1", None)]


def ranked(spark, traits, base):
    return rarity.trait_rarity(spark.createDataFrame(traits, TRAITS), spark.createDataFrame(base, BASE))


@pytest.mark.parametrize("seed, hot", [(1, 0.0), (2, 0.0), (3, 0.7)])
def test_ranks(spark, seed, hot):
    traits, base = sample(seed, hot)
    assert rows(ranked(spark, traits, base)) == expected_ranks(traits, base)


def test_ranks_beyond_all_bounds(spark, monkeypatch):
    """Same result when nothing may be broadcast, every value is hot and no window is trusted."""
    traits, base = sample(4, 0.5)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_SHARE", 0.05)
    monkeypatch.setattr(ordering, "WINDOW_ROWS", 0)
    assert rows(ranked(spark, traits, base)) == expected_ranks(traits, base)


def test_result_types(spark):
    traits, base = sample(5)
    assert dict(ranked(spark, traits, base).dtypes) == {
        "collection_id": "string",
        "token_id": "string",
        "rarity_score": "int",
        "rank": "int",
    }


def test_ties_rank_by_text(spark):
    base = [("1", "9"), ("1", "10")]
    assert rows(ranked(spark, [], base)) == [("1", "10", 0, 1), ("1", "9", 0, 2)]


def test_batch_equals_single_collections(spark):
    traits, base = sample(6)
    together = rows(ranked(spark, traits, base))
    one_by_one = []
    for c in {c for c, _ in base}:
        one_by_one += rows(ranked(spark, [t for t in traits if t[0] == c], [b for b in base if b[0] == c]))
    assert together == sorted(one_by_one, key=repr)


def test_row_order_does_not_matter(spark):
    traits, base = sample(7)
    assert rows(ranked(spark, traits, base)) == rows(ranked(spark, traits[::-1], base[::-1]))


def test_repeated_traits_multiply_scores(spark):
    traits, base = sample(8)
    once = {r[:2]: r[2] for r in rows(ranked(spark, traits, base))}
    thrice = {r[:2]: r[2] for r in rows(ranked(spark, traits * 3, base * 2))}
    assert thrice == {k: 3 * v for k, v in once.items()}


def test_no_tokens(spark):
    assert rows(ranked(spark, [], [])) == []


def test_value_lookup_runs_in_the_jvm_and_does_not_shuffle_traits(spark):
    traits, base = sample(9)
    folder = Staging(spark)
    metadata = folder.write(spark.createDataFrame(traits, TRAITS), "traits")
    listed = folder.write(spark.createDataFrame(base, BASE), "base")
    frequency = folder.write(rarity.trait_frequency(rarity.usable_traits(metadata)), "frequency")
    scored = rarity.scored_traits(rarity.usable_traits(metadata), rarity.trait_scores(frequency))
    plan = rarity.base_token_scores(listed, scored)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    # Value totals and token sums; the trait rows themselves are joined in place.
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("bytes_allowed", [0, 1 << 20])
def test_lookup_join_equals_join(spark, monkeypatch, how, bytes_allowed):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", bytes_allowed)
    facts = spark.createDataFrame([(k % 7, i) for i, k in enumerate([0] * 90 + list(range(60)))], "k int, i int")
    keyed = spark.createDataFrame([(k, str(k)) for k in range(0, 10, 2)], "k int, name string")
    got = joins.lookup_join(facts, keyed, ["k"], how=how, spread=["i"])
    assert rows(got) == rows(facts.join(keyed, ["k"], how))


def test_cold_keys_are_shuffled_and_hot_keys_are_not(spark):
    facts = spark.createDataFrame([(0 if i % 2 else i, i) for i in range(100)], "k int, i int")
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = joins.split_hot_join(facts, counts, ["k"], "n", 10)
    assert rows(got.select("k", "i")) == rows(facts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.rfind("Initial Plan") :] if "Initial Plan" in plan else plan
    assert (initial.count("SortMergeJoin"), initial.count("BroadcastHashJoin")) == (1, 2)


def test_hot_keys_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_SHARE", 0.1)
    counts = spark.createDataFrame([(i, 50 if i < 3 else 1) for i in range(100)], "k int, n bigint")
    size = joins.measure(counts, "n")
    assert (size.rows, size.weight, size.largest, size.has_hot_keys) == (100, 247, 50, True)
    assert counts.filter(F.col("n") >= size.hot_from).count() == 3


@pytest.mark.parametrize("values", [2, 1000])
def test_restrict(spark, monkeypatch, values):
    monkeypatch.setattr(joins, "FILTER_VALUES", values)
    df = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, i int")
    keyed = spark.createDataFrame([(1,), (3,), (4,), (4,)], "k int")
    assert rows(joins.restrict(df, keyed, "k", ["i"])) == rows(df.filter("k in (1, 3, 4)"))
    assert rows(joins.restrict(df, keyed.limit(0), "k", ["i"])) == []


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranged_positions_equal_window(spark, groups):
    rng = random.Random(1)
    data = [(None if i % 11 == 0 else "a" if i % 3 else str(i % 7), str(i), rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, t string, s int").repartition(7)
    order = [F.col("s").desc(), F.col("t")]
    ranged = ordering.ranged_positions(df, groups, order)
    assert rows(ranged.withColumn("position", F.col("position").cast("int"))) == rows(
        ordering.window_positions(df, groups, order)
    )


def test_top_k_per_group_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([(str(i % 3), i) for i in range(60)], "g string, s int")
    top = ordering.top_k_per_group(df, ["g"], 2, [F.col("s")])
    assert rows(top) == [(g, int(g) + 3 * i, i + 1) for g in "012" for i in range(2)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_too_large_to_broadcast(spark, monkeypatch):
    """Only hashes of the hot keys are broadcast; every row meets its key once."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    known = spark.createDataFrame([("hot" * 50, 90, "a"), ("cold", 3, "b"), ("unused", 5, "c")], "k string, n long, v string")
    found = spark.createDataFrame([("hot" * 50, i) for i in range(90)] + [("cold", i) for i in range(3)] + [("none", 0), (None, 1)], "k string, i int")
    joined = joins.split_hot_join(found, known, ["k"], "n", 50, ["i"])
    assert sorted(rows(joined.select("i", "v"))) == sorted([(i, "a") for i in range(90)] + [(i, "b") for i in range(3)])
    assert joined.columns == ["k", "i", "n", "v"]
