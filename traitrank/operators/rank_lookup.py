"""Ranks of given tokens, by counting in place of sorting.

A token's rank is the number of tokens of its collection with a lower score, plus those of the same
score whose id comes before its own, plus one. The first number comes from a histogram of scores
with running sums. For the second, the asked tokens of a score form a tree of short sorted lists:
those that a hash chooses cut the others into ranges, level by level, until a range holds few. Every
token of that score goes down the tree by bisection, one list per level, and is counted where it
arrives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitrank.operators.joins import Size, lookup_join
from traitrank.operators.rarity import COLLECTION, TOKEN
from traitrank.sources.staging import Staging

# Asked tokens of one score in a list, on average at most half of it.
LIST = 256
_GROUP = [COLLECTION, "rarity_score"]
_ELEMENT_OVERHEAD = 16


def _at_or_before(listed: str, token: Column, longest: int) -> Column:
    """How many of the ascending ``listed``, at most ``longest``, are not above ``token``."""
    steps = [F.lit(1 << k) for k in reversed(range(max(1, longest.bit_length())))]

    def forward(at: Column, step: Column) -> Column:
        there = F.try_element_at(F.col(listed), at + step)
        return F.when(there.isNotNull() & (there <= token), at + step).otherwise(at)

    return F.aggregate(F.array(*steps), F.lit(0), forward)


def _lists(staging: Staging, asked: DataFrame, path: list[str]) -> tuple[DataFrame, Size, int]:
    """The ``asked`` tokens as a sorted list per range, its measured size and the longest list."""
    text = F.octet_length(F.array_join("tokens", "")) + _ELEMENT_OVERHEAD * (F.size("tokens") + len(path) + 2)
    lists, seen = staging.write_counted(
        asked.groupBy(*path).agg(F.sort_array(F.collect_list(TOKEN)).alias("tokens")),
        "lists",
        {"n": F.count(F.lit(1)), "b": F.sum((text + F.octet_length(COLLECTION)).cast("long")), "m": F.max(F.size("tokens"))},
    )
    return lists, Size(seen.get("n") or 0, seen.get("b") or 0), seen.get("m") or 0


def rank_lookup(scores: DataFrame, wanted: DataFrame, staging: Staging | None = None) -> DataFrame:
    """(collection_id, token_id, rarity_score, rank) of the ``wanted`` tokens that have a score.

    ``scores`` holds one row per token of whole collections, ``wanted`` any tokens, repeated or not.
    The ranks are those of ``rank_tokens``, without sorting a collection.
    """
    staging = staging or Staging.of(scores)
    asked = staging.write(wanted.select(COLLECTION, TOKEN).dropna().distinct(), "asked")
    collections = asked.select(COLLECTION).distinct()
    theirs = lookup_join(scores.select(COLLECTION, TOKEN, "rarity_score"), collections, [COLLECTION], how="left_semi", spread=[TOKEN])
    met = lookup_join(theirs.dropna(subset=["rarity_score"]), asked, [COLLECTION, TOKEN], how="left_semi")
    # A token that has several rows of a score is ranked once and given as often.
    found = staging.write(met.groupBy(*_GROUP, TOKEN).agg(F.count(F.lit(1)).alias("copies")), "found")
    most = found.groupBy(*_GROUP).count().agg(F.max("count")).first()[0] or 0

    # One row per distinct score of a collection.
    lower = Window.partitionBy(COLLECTION).orderBy("rarity_score").rowsBetween(Window.unboundedPreceding, -1)
    histogram = theirs.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"))
    below = staging.write(histogram.select(*_GROUP, F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before")), "below")

    # Of every list's tokens, one in ``share`` cuts the level above.
    share, levels = LIST // 2, 0
    while share ** (levels + 1) < most:
        levels += 1
    path, placed, counted = list(_GROUP), found, theirs
    for level in reversed(range(levels)):
        chosen = F.pmod(F.xxhash64(F.lit("cut"), TOKEN), F.lit(share ** (level + 1))) == 0
        cuts, size, longest = _lists(staging, placed.filter(chosen), path)
        at = F.coalesce(_at_or_before("tokens", F.col(TOKEN), longest), F.lit(0)).alias(f"range{level}")
        placed, counted = (
            lookup_join(df, cuts, path, how="left", size=size, spread=[TOKEN]).select(*df.columns, at) for df in (placed, counted)
        )
        path = [*path, f"range{level}"]

    lists, size, longest = _lists(staging, placed, path)
    at = F.coalesce(_at_or_before("tokens", F.col(TOKEN), longest), F.lit(0)).alias("slot")
    arrived = lookup_join(counted, lists, path, how="left", size=size, spread=[TOKEN]).groupBy(*path, at)
    slots = staging.write(arrived.agg(F.count(F.lit(1)).alias("n")), "slots")
    # What lies before a range: what lies before the one around it, and the ranges before it in there.
    for depth in range(len(_GROUP) + 1, len(path) + 1):
        around, own = path[: depth - 1], path[depth - 1]
        former = Window.partitionBy(*around).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
        ranges = slots.groupBy(*path[:depth]).agg(F.sum("n").alias("n"))
        inside = ranges.select(*path[:depth], F.coalesce(F.sum("n").over(former), F.lit(0)).alias("inside"))
        before = lookup_join(inside, below, around).select(*path[:depth], (F.col("before") + F.col("inside")).alias("before"))
        below = staging.write(before, "below")

    asked_at = lists.select(*path, F.posexplode("tokens").alias("slot", TOKEN))
    # A token counts for every asked one behind it; the asked one itself lies in the next slot.
    both = asked_at.withColumn("n", F.lit(0).cast("long")).unionByName(slots.withColumn(TOKEN, F.lit(None).cast("string")))
    upto = Window.partitionBy(*path).orderBy("slot").rangeBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("within", F.sum("n").over(upto)).filter(F.col(TOKEN).isNotNull())
    ranked = lookup_join(within, below, path, spread=[TOKEN]).select(
        *_GROUP, TOKEN, (F.col("before") + F.col("within") + 1).cast("int").alias("rank")
    )
    repeated = found.filter("copies > 1").select(*_GROUP, TOKEN, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return lookup_join(ranked, repeated, [*_GROUP, TOKEN], how="left").select(COLLECTION, TOKEN, "rarity_score", "rank")


def rank_of(scores: DataFrame, collection_id: str, token_ids: Sequence[str]) -> DataFrame:
    """``rank_lookup`` of some tokens of one collection."""
    wanted = scores.sparkSession.createDataFrame([(collection_id, t) for t in token_ids], f"{COLLECTION} string, {TOKEN} string")
    return rank_lookup(scores.filter(F.col(COLLECTION) == collection_id), wanted)
