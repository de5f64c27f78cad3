"""Trait frequencies, trait scores, token scores and ranks.

All collections are handled in one job: every key holds the collection, so the result is
the union of what the collections give one by one.

    traits (c, token, type, value) --> frequencies --> scores per value --+
                                                                          v
    base (c, token) -----------------------------------> score per token --> rank
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank.functions import odds_score
from traitrank.operators.joins import Size, lookup_join, measure, row_bytes
from traitrank.operators.ordering import positions
from traitrank.sources.staging import Staging

COLLECTION = "collection_id"
TOKEN = "token_id"
TYPE = "trait_type"
VALUE = "trait_value"

_TYPE_KEYS = [COLLECTION, TYPE]
_VALUE_KEYS = [COLLECTION, TYPE, VALUE]
_TOKEN_KEYS = [COLLECTION, TOKEN]


def usable_traits(metadata: DataFrame, weight: str | None = None) -> DataFrame:
    """Trait rows that count: token, type and value present. Repeated rows stay."""
    return metadata.select(COLLECTION, TOKEN, TYPE, VALUE, *([weight] if weight else [])).filter(
        F.col(TOKEN).isNotNull() & F.col(TYPE).isNotNull() & F.col(VALUE).isNotNull()
    )


def trait_frequency(traits: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per (collection, type, value). Counted before the shuffle, so hot values are cheap.

    With ``weight`` a row stands for as many.
    """
    count = F.sum(F.col(weight).cast("long")) if weight else F.count(F.lit(1))
    return traits.groupBy(*_VALUE_KEYS).agg(count.alias("trait_count"))


def trait_totals(frequency: DataFrame) -> DataFrame:
    """Rows and distinct values per (collection, type)."""
    return frequency.groupBy(*_TYPE_KEYS).agg(
        F.sum("trait_count").alias("total_trait_count"), F.count(F.lit(1)).alias("n_values")
    )


def trait_scores(frequency: DataFrame, totals_size: Size | None = None) -> DataFrame:
    """Score of each trait value within its type.

    ``frequency`` is read once for the totals and once for the join, so pass it staged.
    """
    totals = trait_totals(frequency)
    joined = lookup_join(
        frequency,
        totals,
        _TYPE_KEYS,
        weight="n_values",
        spread=[VALUE],
        size=totals_size or measure(totals, "n_values"),
    )
    return joined.select(
        *_VALUE_KEYS,
        "trait_count",
        "total_trait_count",
        odds_score(F.col("trait_count"), F.col("total_trait_count")).alias("rarity_score"),
    )


def measure_vocabulary(frequency: DataFrame) -> tuple[Size, Size]:
    """Sizes of the value table and of the type table, from one pass over ``frequency``."""
    per_type = frequency.groupBy(*_TYPE_KEYS).agg(
        F.count(F.lit(1)).alias("v"),
        F.sum(row_bytes(frequency)).alias("b"),
        F.sum("trait_count").alias("w"),
        F.max("trait_count").alias("m"),
    )
    row = per_type.agg(
        F.count(F.lit(1)).alias("types"),
        F.sum(row_bytes(per_type)).alias("type_bytes"),
        F.max("v").alias("most_values"),
        F.sum("v").alias("values"),
        F.sum("b").alias("value_bytes"),
        F.sum("w").alias("rows"),
        F.max("m").alias("most_rows"),
    ).first()
    values = Size(row["values"] or 0, row["value_bytes"] or 0, row["rows"] or 0, row["most_rows"] or 0)
    types = Size(row["types"], row["type_bytes"] or 0, row["values"] or 0, row["most_values"] or 0)
    return values, types


def scored_traits(traits: DataFrame, scores: DataFrame, size: Size | None = None) -> DataFrame:
    """Score of every trait row: the value table looked up per row."""
    lookup = scores.select(*_VALUE_KEYS, "trait_count", "rarity_score")
    return lookup_join(
        traits,
        lookup,
        _VALUE_KEYS,
        weight="trait_count",
        spread=["token_id"],
        size=size or measure(lookup, "trait_count"),
    ).select(*_TOKEN_KEYS, "rarity_score")


def _token_sum() -> Column:
    """Sum of trait scores; NULL if one of them is, or if the sum does not fit INT."""
    unknown = F.bool_or(F.col("rarity_score").isNull())
    return F.when(~unknown, F.sum("rarity_score").try_cast("int")).alias("rarity_score")


def token_scores(scored: DataFrame) -> DataFrame:
    """Sum of trait scores per token, for tokens that have a trait."""
    return scored.groupBy(*_TOKEN_KEYS).agg(_token_sum())


def base_token_scores(base: DataFrame, scored: DataFrame) -> DataFrame:
    """Score of every distinct base token; 0 for a token without traits.

    Stands for "distinct base, left join the token sums, fill 0", but base and trait rows
    meet in one aggregation, so there is one shuffle on the token key and no join.
    """
    listed = base.filter(F.col(TOKEN).isNotNull()).select(
        *_TOKEN_KEYS, F.lit(0).alias("rarity_score"), F.lit(True).alias("listed")
    )
    found = scored.select(*_TOKEN_KEYS, "rarity_score", F.lit(False).alias("listed"))
    return (
        listed.unionByName(found)
        .groupBy(*_TOKEN_KEYS)
        .agg(
            _token_sum(),
            F.bool_or("listed").alias("listed"),
        )
        .filter("listed")
        .drop("listed")
    )


def rank_order() -> list:
    """Rarest first; equal scores by token id as text, so "10" comes before "9"."""
    return [F.col("rarity_score").asc(), F.col(TOKEN).asc()]


def rank_tokens(
    scores: DataFrame, group_rows: int | None = None, staging: Staging | None = None
) -> DataFrame:
    """Rank per collection, 1 for the lowest score."""
    return positions(
        scores, [COLLECTION], rank_order(), "rank", group_rows=group_rows, staging=staging
    )


def trait_rarity(
    metadata: DataFrame, base: DataFrame, staging: Staging | None = None
) -> DataFrame:
    """``(collection_id, token_id, rarity_score, rank)`` for all base tokens.

    Collections with a score beyond INT are left out, see ``score_and_rank``.
    """
    return score_and_rank(metadata, base, staging)[0]


def score_and_rank(
    metadata: DataFrame, base: DataFrame, staging: Staging | None = None, weight: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ranks of all base tokens, and the collections (collection_id) that could not be ranked.

    A score that does not fit INT costs its own collection the ranks and no other one. The
    token scores are staged, since whether there is such a collection decides how to go on.
    The value frequencies are staged: they are read three times, and their size decides
    whether the trait rows have to be shuffled for the score lookup.
    """
    staging = staging or Staging.of(metadata)
    traits = usable_traits(metadata, weight)
    frequency = staging.write(trait_frequency(traits, weight), "frequency")
    values_size, types_size = measure_vocabulary(frequency)
    scores = trait_scores(frequency, types_size)
    scored = staging.write(base_token_scores(base, scored_traits(traits, scores, values_size)), "scored")
    per_collection = scored.groupBy(COLLECTION).agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("rarity_score").isNull()).alias("overflow")
    )
    overflowing = per_collection.filter("overflow").select(COLLECTION)
    found = per_collection.agg(F.max("n").alias("most"), F.count_if("overflow").alias("bad")).first()
    sound = lookup_join(scored, overflowing, [COLLECTION], how="left_anti", spread=[TOKEN]) if found["bad"] else scored
    ranks = rank_tokens(sound, found["most"] or 0, staging).select(COLLECTION, TOKEN, "rarity_score", "rank")
    return ranks, overflowing
