"""The given tables in the roles the operators expect.

part        tokens of six collections (p_type) with four traits; 'Brand#13' publishes none
documents   tokens of a source, with the labels as traits; unlabelled ones have none
events      tokens (user_id) with a repeated JSON trait
lineitem    two overlapping token listings
supplier    contracts and their registry
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.functions import collection_label, stringify_or_null, variant_at
from traitrank.sources.tables import traits_from_columns


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# -- part -------------------------------------------------------------------------------


def part_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_type").alias("collection_id"), F.col("p_partkey").cast("string").alias("token_id")
    )


def part_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    def published(column: str) -> Column:
        return F.when(F.col("p_brand") != "Brand#13", F.col(column))

    return traits_from_columns(
        read(spark, sf_dir, "part"),
        F.col("p_type"),
        F.col("p_partkey"),
        {
            "brand": published("p_brand"),
            "size": published("p_size"),
            "name": published("p_name"),
            "type": published("p_type"),
        },
    )


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages: a contract per p_type, at most 1000 tokens per page.

    A page is a range of 1000 part keys, so its list is bounded. 'Brand#7' has token ids
    that are no numbers, sizes decide which of the text fallbacks are filled.
    """
    key, size = F.col("p_partkey"), F.col("p_size")
    token = (
        F.when(F.col("p_brand") == "Brand#7", F.concat(F.lit("token-"), key.cast("string")))
        .when(size % 2 == 0, F.concat(F.lit("0x"), F.lower(F.hex(key))))
        .otherwise(key.cast("string"))
    )
    record = F.struct(
        token.alias("tokenId"),
        F.concat_ws(" ", "p_type", "p_name").alias("title"),
        F.col("p_type").alias("description"),
        F.struct(F.concat(F.lit("cache/"), key.cast("string")).alias("cachedUrl")).alias("image"),
        F.struct(
            F.when(size <= 10, F.col("p_name")).otherwise("").alias("name"),
            F.when(size <= 20, F.col("p_brand")).alias("description"),
            F.when(size <= 5, F.lit("meta/image")).alias("image"),
        ).alias("metadata"),
        F.struct(
            F.struct(
                F.when(size <= 30, F.col("p_brand")).alias("name"),
                F.lit("").alias("description"),
                F.when(size > 40, F.lit("raw/image")).alias("image"),
            ).alias("metadata")
        ).alias("raw"),
    )
    page_no = F.floor(key / 1000).cast("long")
    listed = (
        read(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("contract_address"), page_no.alias("page_no"))
        .agg(F.sort_array(F.collect_list(F.struct(key.alias("key"), record.alias("record")))).alias("rows"))
    )
    return listed.select(
        "contract_address",
        "page_no",
        F.lit(200).alias("http_status"),
        F.to_json(
            F.struct(
                F.col("rows.record").alias("nfts"),
                (F.col("page_no") + 1).cast("string").alias("pageKey"),
            )
        ).alias("body"),
    )


def part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents per part, most brands sound, six of them each bad in another way."""
    brand = F.col("p_brand")
    attributes = F.concat(
        F.lit('[{"trait_type":"brand","value":"'),
        brand,
        F.lit('"},{"trait_type":"size","value":'),
        (F.col("p_size") - 1).cast("string"),
        F.lit('},{"trait_type":"price","value":'),
        F.col("p_retailprice").cast("string"),
        F.lit('},{"trait_type":"large","value":'),
        (F.col("p_size") > 25).cast("string"),
        F.lit("}]"),
    )
    chosen = (
        F.when(brand == "Brand#7", '[{"trait_type":"brand","value":"x"},"oops"]')
        .when(brand == "Brand#12", '{"trait_type":"brand"}')
        .when(brand == "Brand#13", "[]")
        .otherwise(attributes)
    )
    sound = F.concat(
        F.lit('{"raw":{"metadata":{"name":"'),
        F.col("p_name"),
        F.lit('","description":0,"attributes":'),
        chosen,
        F.lit("}}}"),
    )
    body = (
        F.when(brand == "Brand#9", '{"raw":{"metadata"')
        .when(brand == "Brand#10", '{"raw":null}')
        .when(brand == "Brand#11", '{"raw":{"metadata":"text"}}')
        .otherwise(sound)
    )
    return read(spark, sf_dir, "part").select(
        F.col("p_type").alias("contract_address"),
        F.col("p_partkey").cast("string").alias("token_id"),
        F.lit(1).cast("long").alias("landed_no"),
        F.when(brand == "Brand#8", 500).otherwise(200).alias("http_status"),
        body.alias("body"),
    )


def part_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per p_type, in order of its first part."""
    return (
        read(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("contract_address"))
        .agg(F.min("p_partkey").alias("ordinal"))
    )


def with_part_collection(df: DataFrame) -> DataFrame:
    """Pages or documents with the contract itself as collection id and name."""
    return df.select(
        "*",
        F.col("contract_address").alias("collection_id"),
        F.col("contract_address").alias("collection_name"),
    )


# -- documents and labels, events ---------------------------------------------------------


def document_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(
        F.col("source").alias("collection_id"), F.col("doc_id").cast("string").alias("token_id")
    )


def document_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = (
        read(spark, sf_dir, "documents")
        .select("doc_id", "source", "lang")
        .join(read(spark, sf_dir, "labels"), "doc_id")
    )
    return traits_from_columns(
        labelled,
        F.col("source"),
        F.col("doc_id"),
        {"lang": F.col("lang"), "quality": F.col("quality"), "toxic": F.col("toxic")},
    )


def event_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON member ``k`` of each event as a trait; the number 0 is no value."""
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("collection_id"),
        F.col("user_id").cast("string").alias("token_id"),
        F.lit("k").alias("trait_type"),
        stringify_or_null(variant_at(F.try_parse_json("props"), "$.k")).alias("trait_value"),
    )


# -- lineitem -------------------------------------------------------------------------------


def line_tokens(spark: SparkSession, sf_dir: str, kept: Column) -> DataFrame:
    """Parts by return flag, for the lines that ``kept`` selects. Tokens repeat."""
    return (
        read(spark, sf_dir, "lineitem")
        .filter(kept)
        .select(
            F.col("l_returnflag").alias("collection_id"),
            F.col("l_partkey").cast("string").alias("token_id"),
        )
    )


def line_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_tokens(spark, sf_dir, F.col("l_quantity") > 45)


def line_rarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_tokens(spark, sf_dir, F.col("l_discount") < 0.03)


def line_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked tokens of suppliers: the lines, scored by quantity."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("collection_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "token_id"
        ),
        F.col("l_quantity").cast("int").alias("rarity_score"),
        F.col("l_linenumber").alias("rank"),
    )


# -- supplier -------------------------------------------------------------------------------


def supplier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of nations below 12 as known collections, in all states."""
    nation = F.col("s_nationkey")
    status = (
        F.when(nation < 3, schemas.NOT_FETCHED)
        .when(nation < 5, schemas.FETCHING)
        .when(nation < 7, schemas.FETCHED)
        .when(nation < 9, schemas.METADATA_FETCHING)
        .when(nation < 11, schemas.METADATA_FETCHED)
    )
    return (
        read(spark, sf_dir, "supplier")
        .filter(nation < 12)
        .select(
            (F.col("s_suppkey") + 1).cast("int").alias("id"),
            F.concat(F.lit("name of "), "s_name").alias("collection_name"),
            F.col("s_name").alias("contract_address"),
            status.alias("status"),
        )
    )


def supplier_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers as contracts, and all of them again later, in upper case."""
    once = read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("contract_address"), F.col("s_suppkey").alias("ordinal")
    )
    again = once.select(F.upper("contract_address").alias("contract_address"), F.col("ordinal") + 1_000_000_000)
    return once.union(again)


def supplier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("name of "), "s_name").alias("collection_name"),
        F.col("s_suppkey").alias("ordinal"),
    )


def supplier_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as base rows: contract address and collection id."""
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("collection_id"),
        F.col("s_name").alias("contract_address"),
        collection_label(F.col("s_name")).alias("collection_name"),
    )


# -- orders ---------------------------------------------------------------------------------


def order_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ranked tokens of their status; the customer key stands for the rank."""
    return _order_columns(read(spark, sf_dir, "orders").filter("o_orderpriority <> '1-URGENT'"), 0)


def changed_order_ranks(orders: DataFrame) -> DataFrame:
    """Expensive orders with a changed score: some known, the urgent ones new."""
    return _order_columns(orders.filter("o_totalprice > 200000"), 7)


def _order_columns(orders: DataFrame, shift: int) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("token_id"),
        (F.col("o_totalprice").cast("int") + shift).alias("rarity_score"),
        F.col("o_custkey").cast("int").alias("rank"),
        F.col("o_orderstatus").alias("collection_id"),
    )
