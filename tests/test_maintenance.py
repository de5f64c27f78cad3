"""Ranks kept up to date by changes, ranks of given tokens, and bitmap differences, against full computations."""

import random

import pytest
from comparing import rows
from pyspark.sql import functions as F

from traitrank.operators import audit, joins, rank_lookup
from traitrank.operators.maintenance import MaintainedRarity
from traitrank.operators.rarity import rank_tokens, score_and_rank
from traitrank.sources.staging import Staging

TRAITS = "collection_id string, token_id string, trait_type string, trait_value string"
TOKENS = "collection_id string, token_id string"


@pytest.fixture
def kept(spark, database):
    maintained = MaintainedRarity(spark, database)
    maintained.create_tables()
    return maintained


def ranked(kept):
    return rows(kept.table("rarity").select("collection_id", "token_id", "rarity_score", "rank"))


def full(spark, traits, base):
    ranks, _ = score_and_rank(spark.createDataFrame(traits, TRAITS), spark.createDataFrame(base, TOKENS))
    return rows(ranks)


def change(kept, spark, traits, base):
    kept.apply(spark.createDataFrame(traits, TRAITS + ", sign int"), spark.createDataFrame(base, TOKENS + ", sign int"))


def test_changes_add_up_to_a_full_computation(spark, kept, database):
    rng = random.Random(1)
    traits = [(c, str(t), k, rng.choice("abcd")) for c in "xyz" for t in range(12) for k in ("hat", "eye")]
    traits += traits[:5] + [("x", None, "hat", "a"), ("x", "1", None, "a"), ("x", "1", "hat", None), ("x", "unlisted", "hat", "a")]
    base = [(c, str(t)) for c in "xyz" for t in range(14)] + [("x", "1"), ("x", None)]
    change(kept, spark, [(*t, 1) for t in traits], [(*b, 1) for b in base])
    assert ranked(kept) == full(spark, traits, base)

    def files(collection):
        return {f for f in kept.table("tokens").filter(F.col("collection_id") == collection).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}

    untouched = files("y")
    gone, new = [t for t in traits if t[0] == "x" and t[3] == "b"], [("x", "3", "hat", "new"), ("q", "7", "hat", "a")]
    off = [b for b in base if b[0] == "z"]
    change(
        kept, spark,
        [(*t, -1) for t in gone] + [(*t, 1) for t in new] + [(*t, -1) for t in traits if t[0] == "z"],
        [(*b, -1) for b in [*off, ("x", "1")]] + [("q", "7", 1), ("x", "unlisted", 1)],
    )
    traits = [t for t in traits if t not in gone and t[0] != "z"] + new
    base = [b for b in base if b[0] != "z"] + [("q", "7"), ("x", "unlisted")]
    base.remove(("x", "1"))
    assert ranked(kept) == full(spark, traits, base)
    assert files("y") == untouched
    assert kept.table("traits").filter("collection_id = 'z'").isEmpty()

    before = ranked(kept)
    with pytest.raises(ValueError, match="not there"):
        change(kept, spark, [("x", "3", "hat", "never", -1)], [])
    change(kept, spark, [], [])
    assert ranked(kept) == before


def test_a_score_beyond_int_costs_its_collection_the_ranks_until_it_is_gone(spark, kept):
    flood = [("x", "1", "hat", "a", 1_000_000_000), ("x", "2", "hat", "b", 1), ("y", "1", "hat", "a", 1), ("y", "2", "hat", "b", 1)]
    base = [("x", "1", 1), ("x", "2", 1), ("y", "1", 1), ("y", "2", 1)]
    change(kept, spark, flood, base)
    assert {r[0] for r in ranked(kept)} == {"y"}
    change(kept, spark, [("x", "1", "hat", "a", -999_999_999)], [])
    assert ranked(kept) == [("x", "1", 100, 1), ("x", "2", 100, 2), ("y", "1", 100, 1), ("y", "2", 100, 2)]


@pytest.mark.parametrize("broadcast", [joins.BROADCAST_BYTES, 0])
def test_rank_lookup(spark, monkeypatch, broadcast):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
    scores = [("x", f"{n}", n % 3) for n in range(1500)] + [("y", "é", 5), ("y", "z", 5), ("z", "1", 1)]
    df = spark.createDataFrame(scores, TOKENS + ", rarity_score int")
    wanted = [("x", f"{n}") for n in range(0, 1500, 2)] + [("y", "é"), ("y", "z"), ("y", "none"), ("q", "1"), ("x", None), ("x", "4")]
    got = rank_lookup.rank_lookup(df, spark.createDataFrame(wanted, TOKENS))
    expected = [r for r in rows(rank_tokens(df)) if (r[0], r[1]) in wanted]
    assert rows(got) == expected
    assert rows(rank_lookup.rank_of(df, "y", ["z"])) == [("y", "z", 5, 1)]
    assert rows(rank_lookup.rank_lookup(df.limit(0), spark.createDataFrame(wanted, TOKENS))) == []


@pytest.mark.parametrize("broadcast", [joins.BROADCAST_BYTES, 0])
def test_rank_lookup_places_a_token_once(spark, monkeypatch, broadcast):
    """A score shared by all is bisected level by level: no token meets more than a list per level."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(rank_lookup, "LIST", 8)
    met = []
    write = Staging.write_counted

    def counting(self, df, label, counts):
        written, seen = write(self, df, label, counts)
        met.append((written.count(), seen["m"]))
        return written, seen

    monkeypatch.setattr(Staging, "write_counted", counting)
    scores = [("x", f"{n}", 1) for n in range(900)] + [("x", f"a{n}", n % 2) for n in range(20)] + [("x", None, 1), ("x", "0", None)]
    scores += [("x", "17", 1)] * 3
    df = spark.createDataFrame(scores, TOKENS + ", rarity_score int")
    got = rows(rank_lookup.rank_lookup(df, df.filter("token_id NOT LIKE '%3'")))
    ids = sorted(t for _, t, s in scores if s == 1 and t is not None)
    low = sorted(t for _, t, s in scores if s == 0)
    nulls = 1
    expected = [("x", t, 1, 1 + 1 + len(low) + nulls + ids.index(t)) for t in ids if not t.endswith("3")]
    expected += [("x", t, 0, 1 + 1 + low.index(t)) for t in low if not t.endswith("3")]
    assert got == sorted(expected, key=repr)
    # Four levels of cuts, and lists that stay short whatever the score holds.
    assert len(met) == 5 and max(m for _, m in met) < 64 and met[-1][0] > 100


def test_bitmaps(spark):
    def tokens(data):
        return spark.createDataFrame(data, TOKENS)

    odd = ["007", "0", "-4", "abc", "", str(2**63), str(2**200), None, " 5", "1.0"]
    base = tokens([("x", str(n)) for n in range(1, 900)] + [("x", o) for o in odd] + [("far", "1"), ("far", str(2**62))] + [("x", "5")] * 9)
    rarity = tokens([("x", str(n)) for n in range(500, 40_000, 3)] + [("x", "abc"), ("far", "1"), ("only", "3")])
    metadata = tokens([("x", "1"), ("x", "abc"), ("far", "2")])
    assert rows(audit.audit_by_bitmaps(base, rarity, metadata)) == rows(audit.audit_tokens(base, rarity, metadata))
    assert rows(audit.audit_by_bitmaps(rarity, base)) == rows(audit.audit_tokens(rarity, base))
    assert rows(audit.audit_by_bitmaps(base.limit(0), rarity.limit(0))) == []


def test_documents_are_parsed_above_the_joins_only(spark):
    """No filter of the plan holds the parse of a body, and none lies below the choice of documents."""
    from traitrank.plans.queries import all_queries

    for name in ("enrich_metadata", "explode_outer_attributes", "quarantine_bad_records"):
        plan = all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "from_json" in line], name
