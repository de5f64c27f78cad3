"""Reports over the registry, base, metadata and rarity tables. All return DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitrank.functions import numeric_order
from traitrank.operators.joins import restrict
from traitrank.operators.ordering import positions, top_k, top_k_per_group
from traitrank.operators.registry import find_by_address


def registry_listing(registry: DataFrame) -> DataFrame:
    return registry.select("collection_name", "contract_address", "status")


def of_collections(df: DataFrame, collection_ids: Sequence[str]) -> DataFrame:
    """Rows of the given collections; prunes a table partitioned by collection."""
    return df.filter(F.col("collection_id").isin([str(i) for i in collection_ids]))


def of_contract(df: DataFrame, registry: DataFrame, contract_address: str) -> DataFrame:
    """Rows of a contract in any spelling, found by its id: prunes a table partitioned by collection."""
    ids = find_by_address(registry, contract_address).select(F.col("id").cast("string").alias("collection_id"))
    return restrict(df, ids, "collection_id", ["token_id"])


def top_common(rarity: DataFrame, k: int = 10) -> DataFrame:
    """Highest scores over all collections: the tokens with the most common traits."""
    order = [F.col("rarity_score").desc(), F.col("collection_id"), F.col("token_id")]
    return top_k(rarity, k, order, "position")


def top_rare(rarity: DataFrame, collection_id: str, k: int = 10) -> DataFrame:
    """Lowest ranks of one collection."""
    return top_k(of_collections(rarity, [collection_id]), k, [F.col("rank")])


def top_rare_per_collection(scores: DataFrame, k: int) -> DataFrame:
    """Lowest ``k`` scores of every collection, straight from unranked scores."""
    order = [F.col("rarity_score"), F.col("token_id")]
    return top_k_per_group(scores, ["collection_id"], k, order, "rank")


def first_by_token(base: DataFrame, collection_id: str, k: int = 10) -> DataFrame:
    """First ``k`` tokens of one collection, ids compared as text."""
    return top_k(of_collections(base, [collection_id]), k, [F.col("token_id")], "position")


def by_rank(rarity: DataFrame) -> DataFrame:
    return rarity.orderBy("collection_id", "rank")


def by_token_number(df: DataFrame) -> DataFrame:
    """All rows in numeric order of the token id, whatever its width."""
    return df.orderBy("collection_id", *numeric_order(F.col("token_id")))


def token_number_positions(df: DataFrame) -> DataFrame:
    """Place of every token within its collection in numeric order of the id."""
    return positions(df, ["collection_id"], list(numeric_order(F.col("token_id"))), "position")


def rank_positions(rarity: DataFrame) -> DataFrame:
    """Place of every token within its collection by rank, then by id as text."""
    return positions(rarity, ["collection_id"], [F.col("rank"), F.col("token_id")], "position")


def contract_report(
    registry: DataFrame, base: DataFrame, metadata: DataFrame, rarity: DataFrame, contract_address: str
) -> dict[str, DataFrame]:
    """The three tables of a contract, each in its reading order."""
    return {
        "base": by_token_number(of_contract(base, registry, contract_address)),
        "metadata": by_token_number(of_contract(metadata, registry, contract_address)),
        "rarity": by_rank(of_contract(rarity, registry, contract_address)),
    }


def collection_report(
    base: DataFrame, metadata: DataFrame, rarity: DataFrame, collection_ids: Sequence[str]
) -> dict[str, DataFrame]:
    """The three tables for several collections at once."""
    return {
        "base": of_collections(base, collection_ids),
        "metadata": of_collections(metadata, collection_ids),
        "rarity": by_rank(of_collections(rarity, collection_ids)),
    }


def side_by_side(base: DataFrame, rarity: DataFrame, collection_id: str, k: int = 10) -> DataFrame:
    """First base tokens by id and first ranked tokens by rank, in one listing."""
    listed = first_by_token(base, collection_id, k).select(
        F.lit("base").alias("side"), "position", "token_id"
    )
    ranked = top_k(of_collections(rarity, [collection_id]), k, [F.col("rank")], "position").select(
        F.lit("rarity").alias("side"), "position", "token_id"
    )
    return listed.unionByName(ranked)
