"""Registered queries: every operator on the given tables, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.functions import (
    collection_label,
    fallback_text,
    first_truthy,
    parse_token_id,
    stringify_or_null,
    variant_at,
)
from traitrank.operators import audit, ingest, joins, ordering, rarity, registry, reports, upsert
from traitrank.operators.maintenance import MaintainedRarity
from traitrank.operators.rank_lookup import rank_lookup
from traitrank.plans import inputs, sql_functions
from traitrank.plans.rarity_run import RarityRun
from traitrank.sources.paged import PUSHDOWN, Marks, folder_fetch, land_pages, paged_source, paged_stream
from traitrank.sources.staging import Staging
from traitrank.sources.tables import read_merged
from traitrank.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    """Registers ``build`` under its name; ``query_`` in front keeps it apart from an operator."""
    _QUERIES[build.__name__.removeprefix("query_")] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables lie in the shared folder."""
    name = f"traitrank_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{Staging(spark).folder}'")
    return name


def _staged_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    traits = rarity.usable_traits(inputs.part_traits(spark, sf_dir))
    return Staging(spark).write(rarity.trait_frequency(traits), "frequency")


def _part_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    traits = rarity.usable_traits(inputs.part_traits(spark, sf_dir))
    frequency = Staging(spark).write(rarity.trait_frequency(traits), "frequency")
    values, types = rarity.measure_vocabulary(frequency)
    return rarity.scored_traits(traits, rarity.trait_scores(frequency, types), values)


def _part_token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rarity.base_token_scores(inputs.part_base(spark, sf_dir), _part_scored(spark, sf_dir))


def _part_rarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rarity.trait_rarity(inputs.part_traits(spark, sf_dir), inputs.part_base(spark, sf_dir))


# -- rarity -----------------------------------------------------------------------------


@_query
def rarity_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_rarity(spark, sf_dir)


@_query
def rarity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rarity.trait_rarity(
        inputs.document_traits(spark, sf_dir), inputs.document_base(spark, sf_dir)
    )


@_query
def rarity_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    traits = inputs.event_traits(spark, sf_dir)
    return rarity.trait_rarity(traits, traits.select("collection_id", "token_id"))


@_query
def trait_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rarity.trait_frequency(rarity.usable_traits(inputs.part_traits(spark, sf_dir)))


@_query
def trait_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    frequency = rarity.trait_frequency(rarity.usable_traits(inputs.part_traits(spark, sf_dir)))
    return rarity.trait_totals(frequency)


@_query
def trait_scores_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rarity.trait_scores(_staged_frequency(spark, sf_dir))


@_query
def trait_scores_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score join with salts, as for a lookup whose rows per key are not known."""
    frequency = _staged_frequency(spark, sf_dir)
    totals = rarity.trait_totals(frequency)
    joined = joins.salted_join(frequency, totals, ["collection_id", "trait_type"], ["trait_value"])
    return joined.select(
        "collection_id",
        "trait_type",
        "trait_value",
        "trait_count",
        "total_trait_count",
        rarity.odds_score(F.col("trait_count"), F.col("total_trait_count")).alias("rarity_score"),
    )


@_query
def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rarity.token_scores(_part_scored(spark, sf_dir))


@_query
def token_scores_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score lookup in the form it takes when hot values are split off."""
    traits = rarity.usable_traits(inputs.part_traits(spark, sf_dir))
    frequency = Staging(spark).write(rarity.trait_frequency(traits), "frequency")
    values, types = rarity.measure_vocabulary(frequency)
    lookup = rarity.trait_scores(frequency, types).drop("total_trait_count")
    keys = ["collection_id", "trait_type", "trait_value"]
    return rarity.token_scores(
        joins.split_hot_join(traits, lookup, keys, "trait_count", values.hot_from)
    )


@_query
def token_scores_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_token_scores(spark, sf_dir)


@_query
def token_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.window_positions(
        _part_token_scores(spark, sf_dir), ["collection_id"], rarity.rank_order(), "rank"
    )


@_query
def token_rank_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank in the form it takes when a collection is too large for one task."""
    return ordering.ranged_positions(
        _part_token_scores(spark, sf_dir), ["collection_id"], rarity.rank_order(), "rank"
    ).withColumn("rank", F.col("rank").cast("int"))


@_query
def rank_after_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts added in three changes, the second of which is withdrawn by a fourth."""
    kept = MaintainedRarity(spark, scratch_database(spark))
    kept.create_tables()
    third = F.col("token_id").cast("long") % 3
    traits, base = inputs.part_traits(spark, sf_dir), inputs.part_base(spark, sf_dir)
    for number, sign in ((0, 1), (1, 1), (2, 1), (1, -1)):
        kept.apply(*[df.filter(third == number).withColumn("sign", F.lit(sign)) for df in (traits, base)])
    return kept.table("rarity")


@_query
def query_rank_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of every seventh part, without sorting a collection."""
    scores = Staging(spark).write(_part_token_scores(spark, sf_dir), "scores")
    return rank_lookup(scores, scores.filter(F.col("token_id").cast("long") % 7 == 0))


# -- reports ----------------------------------------------------------------------------


@_query
def top_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_common(_part_rarity(spark, sf_dir), 10)


@_query
def top_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_rare(_part_rarity(spark, sf_dir), "ECONOMY", 20)


@_query
def top_k_per_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_rare_per_collection(_part_token_scores(spark, sf_dir), 20)


@_query
def tokens_string_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.first_by_token(inputs.part_base(spark, sf_dir), "ECONOMY", 10)


@_query
def tokens_numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.token_number_positions(inputs.part_base(spark, sf_dir))


@_query
def rank_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rank_positions(_part_rarity(spark, sf_dir))


@_query
def collection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, traits = inputs.part_base(spark, sf_dir), inputs.part_traits(spark, sf_dir)
    listing = reports.collection_report(base, traits, _part_rarity(spark, sf_dir), ["ECONOMY", "PROMO"])
    per_token = listing["metadata"].groupBy("collection_id", "token_id").agg(
        F.count("trait_value").alias("n_traits")
    )
    ranked = listing["base"].distinct().join(listing["rarity"], ["collection_id", "token_id"], "left")
    return ranked.join(per_token, ["collection_id", "token_id"])


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.supplier_contracts(spark, sf_dir).select(
        F.col("collection_id").cast("int").alias("id"), "collection_name", "contract_address"
    )


def _contract_report(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lines as ranked tokens of suppliers; their address is asked for in another spelling."""
    ranks, known = inputs.line_ranks(spark, sf_dir), _suppliers(spark, sf_dir)
    named = ranks.select("collection_id", "token_id", (F.col("rank") % 3).alias("n"))
    return reports.contract_report(known, named, named.filter("n > 0"), ranks, "SUPPLIER#000000001")


@_query
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract_report(spark, sf_dir)["rarity"]


@_query
def contract_report_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract_report(spark, sf_dir)["base"]


@_query
def contract_report_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract_report(spark, sf_dir)["metadata"]


def _with_functions(spark: SparkSession, base: DataFrame, metadata: DataFrame, rarity_: DataFrame, known: DataFrame) -> str:
    """Installs the SQL functions over views of these tables; returns the prefix of their names."""
    prefix = f"f{uuid.uuid4().hex}_"
    views = sql_functions.Relations(*[f"{prefix}{k}" for k in ("registry", "base", "metadata", "rarity")])
    for df, view in ((known, views.registry), (base, views.base), (metadata, views.metadata), (rarity_, views.rarity)):
        df.createOrReplaceTempView(view)
    sql_functions.install(spark, views, prefix)
    return prefix


def _filled(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def _line_functions(spark: SparkSession, ranks: DataFrame, known: DataFrame) -> str:
    listed = ranks.select("collection_id", "token_id")
    enriched = _filled(ranks.filter("rank % 3 > 0"), schemas.METADATA)
    return _with_functions(spark, _filled(listed, schemas.BASE), enriched, ranks, _filled(known, schemas.REGISTRY))


@_query
def sql_contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of a contract by a function in SQL, its address bound as an argument."""
    prefix = _line_functions(spark, inputs.line_ranks(spark, sf_dir), _suppliers(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {prefix}contract_rarity(:address)", args={"address": "SUPPLIER#000000001"})


@_query
def sql_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the collections that wait for metadata, and have none, in SQL."""
    prefix = _line_functions(spark, inputs.line_ranks(spark, sf_dir), inputs.supplier_registry(spark, sf_dir))
    return spark.sql(
        f"""SELECT p.id, t.token_id FROM {prefix}pending_collections(:stage) p
            JOIN {prefix}pending_tokens(NULL) t ON t.collection_id = CAST(p.id AS STRING)""",
        args={"stage": "metadata"},
    )


@_query
def find_by_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.find_by_address(_suppliers(spark, sf_dir), "sUPPLIER#000000001")


@_query
def rank_with_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as collections, one of them with counts whose odds do not fit INT."""
    traits = inputs.read(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("collection_id"),
        F.col("l_partkey").cast("string").alias("token_id"),
        F.lit("flag").alias("trait_type"),
        F.col("l_returnflag").alias("trait_value"),
        F.when((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "N"), 1_000_000_000).otherwise(1).alias("weight"),
    )
    ranks, overflowing = rarity.score_and_rank(traits, traits, weight="weight")
    return ranks.unionByName(overflowing, allowMissingColumns=True)


@_query
def sample_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.side_by_side(inputs.part_base(spark, sf_dir), _part_rarity(spark, sf_dir), "PROMO", 10)


# -- audit ------------------------------------------------------------------------------


@_query
def audit_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.only_in(inputs.line_base(spark, sf_dir), inputs.line_rarity(spark, sf_dir))


@_query
def audit_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.only_in(inputs.line_rarity(spark, sf_dir), inputs.line_base(spark, sf_dir))


@_query
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = inputs.line_tokens(spark, sf_dir, F.col("l_linestatus") == "O")
    return audit.audit_tokens(
        inputs.line_base(spark, sf_dir), inputs.line_rarity(spark, sf_dir), metadata
    )


@_query
def audit_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``audit_summary`` from bitmaps of the part keys."""
    metadata = inputs.line_tokens(spark, sf_dir, F.col("l_linestatus") == "O")
    return audit.audit_by_bitmaps(inputs.line_base(spark, sf_dir), inputs.line_rarity(spark, sf_dir), metadata)


@_query
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.token_counts(
        base=inputs.line_base(spark, sf_dir), rarity=inputs.line_rarity(spark, sf_dir)
    )


@_query
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``token_counts``, taken while the tokens are written."""
    base, rarity_ = inputs.line_base(spark, sf_dir), inputs.line_rarity(spark, sf_dir)
    return audit.observed_counts(Staging(spark), base=base, rarity=rarity_)[0]


@_query
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tokens(table: str) -> DataFrame:
        return inputs.read(spark, sf_dir, table).select(
            F.lit("documents").alias("collection_id"), F.col("doc_id").cast("string").alias("token_id")
        )

    return audit.only_in(tokens("documents"), tokens("labels"))


# -- functions --------------------------------------------------------------------------


@_query
def query_parse_token_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    decimal, digits = key.cast("string"), F.lower(F.hex(key))
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("0x"), digits))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("0x"), digits, F.repeat(F.lit("0"), 20)))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit(" -00"), decimal))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("0X"), digits))
        .when(F.col("o_orderstatus") == "O", F.concat(decimal, F.lit(".0")))
        .otherwise(F.concat(F.lit("+0"), decimal, F.lit("\t")))
    )
    return inputs.read(spark, sf_dir, "orders").select(
        "o_orderkey", parse_token_id(raw).alias("token_id")
    )


@_query
def query_first_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    record = F.try_parse_json(
        F.concat(
            F.lit('{"metadata":{"name":'),
            F.when(size <= 10, F.to_json(F.array("p_name"))).when(size <= 20, "0").otherwise('""'),
            F.lit('},"raw":{"metadata":'),
            F.when(size <= 30, F.concat(F.lit('{"name":'), size.cast("string"), F.lit("}"))).otherwise("null"),
            F.lit('},"title":'),
            F.when(size <= 40, "true").otherwise("false"),
            F.lit("}"),
        )
    )
    return inputs.read(spark, sf_dir, "part").select(
        "p_partkey",
        first_truthy(
            variant_at(record, "$.metadata.name"),
            variant_at(record, "$.raw.metadata.name"),
            variant_at(record, "$.title"),
        ).alias("name"),
        fallback_text(
            F.when(size <= 10, F.col("p_name")), F.when(size <= 30, F.lit("")), F.col("p_brand")
        ).alias("plain_name"),
    )


@_query
def query_stringify_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    value = (
        F.when(size <= 5, "0")
        .when(size <= 10, '"0"')
        .when(size <= 15, "false")
        .when(size <= 20, "true")
        .when(size <= 25, F.concat(size.cast("string"), F.lit(".50")))
        .when(size <= 30, F.concat(size.cast("string"), F.lit("e2")))
        .when(size <= 35, "{}")
        .when(size <= 40, F.concat(F.lit("[1, "), size.cast("string"), F.lit("]")))
        .when(size <= 45, "null")
        .otherwise(F.concat(F.lit('"'), F.col("p_name"), F.lit('"')))
    )
    parsed = F.try_parse_json(F.concat(F.lit('{"value":'), value, F.lit("}")))
    return inputs.read(spark, sf_dir, "part").select(
        "p_partkey", stringify_or_null(variant_at(parsed, "$.value")).alias("trait_value")
    )


@_query
def collection_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.read(spark, sf_dir, "supplier").select(
        "s_suppkey", collection_label(F.col("s_name")).alias("collection_name")
    )


# -- ingest -----------------------------------------------------------------------------


@_query
def flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.with_part_collection(inputs.part_pages(spark, sf_dir))
    return ingest.first_listing(ingest.flatten_pages(pages))


@_query
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.with_part_collection(inputs.part_pages(spark, sf_dir))
    return ingest.rejected_records(ingest.page_records(pages)).select(
        "collection_id",
        "page_no",
        "reject_reason",
        F.get_json_object("body", "$.tokenId").alias("raw_token_id"),
    )


@_query
def attach_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = inputs.line_ranks(spark, sf_dir).select("collection_id", F.col("token_id").alias("page_no"))
    suppliers = inputs.supplier_contracts(spark, sf_dir).select(
        F.col("collection_id"), F.upper("contract_address").alias("contract_address")
    )
    pages = landed.join(suppliers, "collection_id").drop("collection_id")
    attached = ingest.attach_collection(pages, inputs.supplier_registry(spark, sf_dir))
    return attached.groupBy("collection_id", "collection_name", "contract_address").agg(
        F.count(F.lit(1)).alias("n_pages")
    )


def _part_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = inputs.part_base(spark, sf_dir).select(
        "*",
        F.col("collection_id").alias("contract_address"),
        F.col("collection_id").alias("collection_name"),
    )
    return ingest.join_documents(base, inputs.part_documents(spark, sf_dir))


@_query
def enrich_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_metadata(_part_joined(spark, sf_dir)).drop("attributes_json", "metadata_json")


@_query
def explode_outer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.read(spark, sf_dir, "part")
    pair = F.struct(F.lit("size").alias("trait_type"), F.col("p_size").alias("value"))
    attributes = F.when(F.col("p_brand") != "Brand#13", F.array(pair, pair)).otherwise(F.array())
    body = F.to_json(F.struct(F.struct(F.struct(attributes.alias("attributes")).alias("metadata")).alias("raw")))
    joined = part.select(
        F.col("p_type").alias("collection_id"),
        F.col("p_type").alias("collection_name"),
        F.col("p_type").alias("contract_address"),
        F.col("p_partkey").cast("string").alias("token_id"),
        F.lit(200).alias("http_status"),
        body.alias("body"),
    )
    return ingest.flatten_metadata(joined).select(
        "token_id", "attributes_json", "metadata_json", "trait_type", "trait_value"
    )


@_query
def wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and trait values that are whole numbers of more than sixty digits."""
    part = inputs.read(spark, sf_dir, "part")
    wide = F.concat((F.col("p_partkey") + 1).cast("string"), F.repeat(F.lit("7"), 60))
    body = F.format_string(
        '{"raw":{"metadata":{"name":%1$s,"image":[],"attributes":[{"trait_type":"plain","value":%1$s},'
        '{"trait_type":"minus","value":-%1$s},{"trait_type":"text","value":"%1$s"},{"trait_type":%1$s,"value":%2$s}]}}}',
        wide, F.col("p_size").cast("string"),
    )
    joined = part.select(
        *[F.col("p_type").alias(c) for c in ("collection_id", "collection_name", "contract_address")],
        F.col("p_partkey").cast("string").alias("token_id"),
        F.lit(200).alias("http_status"),
        body.alias("body"),
    )
    return ingest.flatten_metadata(joined).select("token_id", "name", "image_url", "trait_type", "trait_value")


@_query
def quarantine_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejected_documents(_part_joined(spark, sf_dir)).select(
        "collection_id", "token_id", "reject_reason"
    )


def _landed_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the part pages as files, to be fetched page by page."""
    root = Staging(spark).path("landed")
    pages = inputs.part_pages(spark, sf_dir).select("contract_address", "page_no", "body")
    # A contract may lack a key range, so its pages are numbered anew; each names the next
    # one, and the last names a page that is not there.
    placed = ordering.positions(pages, ["contract_address"], [F.col("page_no")], "place")
    next_key = F.concat(F.lit('"pageKey":"'), F.col("place").cast("string"), F.lit('"'))
    (
        placed.select(
            "contract_address",
            (F.col("place") - 1).alias("page_no"),
            F.regexp_replace("body", F.lit(r'"pageKey":"\d+"'), next_key).alias("value"),
        )
        .repartition("contract_address", "page_no")
        .write.partitionBy("contract_address", "page_no")
        .text(root)
    )
    return root


def _names_listed(pages: DataFrame) -> DataFrame:
    listed = ingest.first_listing(ingest.flatten_pages(inputs.with_part_collection(pages)))
    return listed.select("collection_id", "token_id", "name")


@_query
def query_paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as files, read back through the paged data source and flattened.

    The source takes its contracts as an option, so it is for lists that fit one.
    """
    source = paged_source(folder_fetch(_landed_folder(spark, sf_dir)))
    spark.dataSource.register(source)
    contracts = [r[0] for r in inputs.part_contracts(spark, sf_dir).select("contract_address").collect()]
    return _names_listed(spark.read.format(source.name()).option("contracts", json.dumps(contracts)).load())


@_query
def paged_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract of the paged source: the filter reaches it, so no page of another one is fetched."""
    source = paged_source(folder_fetch(_landed_folder(spark, sf_dir)), "paged_listing_of_one", pushdown=True)
    spark.dataSource.register(source)
    contracts = [r[0] for r in inputs.part_contracts(spark, sf_dir).select("contract_address").collect()]
    before = spark.conf.get(PUSHDOWN)
    spark.conf.set(PUSHDOWN, "true")
    try:
        read = spark.read.format(source.name()).option("contracts", json.dumps(contracts)).load()
        pages = Staging(spark).write(read.filter(F.col("contract_address") == "ECONOMY"), "pages")
    finally:
        spark.conf.set(PUSHDOWN, before)
    return _names_listed(pages)


@_query
def query_land_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages fetched for a table of contracts, which stays on the executors."""
    landed = land_pages(inputs.part_contracts(spark, sf_dir), folder_fetch(_landed_folder(spark, sf_dir)))
    return _names_listed(Staging(spark).write(landed, "pages"))


@_query
def query_paged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages as a stream, three of a contract in a round, started anew for every batch.

    A batch is as many rounds as lie behind it, so that long chains do not take a start per three pages.
    """
    source = paged_stream(folder_fetch(_landed_folder(spark, sf_dir)))
    spark.dataSource.register(source)
    contracts = [r[0] for r in inputs.part_contracts(spark, sf_dir).select("contract_address").collect()]
    staging = Staging(spark)
    marks, seen, landed = (staging.path(k) for k in ("marks", "seen", "pages"))
    while Marks(marks).any_open(contracts):
        read = spark.readStream.format(source.name()).options(
            contracts=json.dumps(contracts), marks=marks, pages="3", growing="true"
        ).load()
        write = read.writeStream.format("parquet").option("checkpointLocation", seen).trigger(availableNow=True)
        write.start(landed).awaitTermination()
    return _names_listed(spark.read.schema(schemas.PAGES).parquet(landed))


@_query
def merged_schema_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts landed in three folders of other columns, types, spellings and partitions."""
    part, staging = inputs.read(spark, sf_dir, "part"), Staging(spark)
    third = F.col("p_partkey") % 3
    folders = {
        "first": part.filter(third == 0).select(F.col("p_partkey").cast("int"), "p_name", "p_type"),
        "second": part.filter(third == 1).select(F.col("p_partkey").cast("long"), "p_size", "p_type"),
        "third": part.filter(third == 2).select(
            F.col("p_partkey").cast("int").alias("P_PartKey"), F.concat(F.lit("no. "), "p_size").alias("p_size"), "p_brand"
        ),
    }
    paths = [staging.path(name) for name in folders]
    for path, df in zip(paths, folders.values()):
        df.write.partitionBy(*[c for c in df.columns if c == "p_type"]).parquet(path)
    return read_merged(spark, paths).withColumn("p_partkey", F.col("p_partkey").cast("long"))


# -- registry ---------------------------------------------------------------------------


@_query
def register_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.register_collections(
        inputs.supplier_registry(spark, sf_dir), inputs.supplier_incoming(spark, sf_dir)
    )


@_query
def get_or_create_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.get_or_create(
        inputs.supplier_registry(spark, sf_dir), inputs.supplier_names(spark, sf_dir)
    )


@_query
def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.find(
        inputs.supplier_registry(spark, sf_dir),
        inputs.supplier_names(spark, sf_dir).select("collection_name"),
    )


@_query
def registry_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.registry_listing(inputs.supplier_registry(spark, sf_dir))


@_query
def status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = schemas.TableNames(prefix=scratch_database(spark))
    table = names.full("registry")
    upsert.create_table(spark, table, schemas.REGISTRY)
    upsert.append(inputs.supplier_registry(spark, sf_dir), table)
    # Names beyond the registry match nothing; a NULL status is written as well.
    updates = inputs.read(spark, sf_dir, "supplier").filter("s_nationkey > 5").select(
        F.concat(F.lit("name of "), "s_name").alias("collection_name"),
        F.when(F.col("s_nationkey") != 8, schemas.FETCHED).alias("status"),
    )
    upsert.merge_update(updates, table, ["collection_name"], ["status"])
    return spark.table(table)


@_query
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.supplier_registry(spark, sf_dir)
    stages = [registry.pending(known, s).withColumn("stage", F.lit(s)) for s in registry.AWAITING]
    return stages[0].unionByName(stages[1]).select("stage", "id", "collection_name")


@_query
def pending_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.pending_tokens(
        inputs.line_base(spark, sf_dir).distinct(), inputs.line_rarity(spark, sf_dir)
    )


# -- writes -----------------------------------------------------------------------------


@_query
def upsert_rarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = schemas.TableNames(prefix=scratch_database(spark)).full("rarity")
    upsert.create_if_missing(inputs.order_ranks(spark, sf_dir), table, schemas.PARTITION)
    changed = inputs.changed_order_ranks(inputs.read(spark, sf_dir, "orders"))
    # The table exists by now, so a second create changes nothing.
    upsert.create_if_missing(changed, table, schemas.PARTITION)
    upsert.merge_upsert(changed, table, schemas.TOKEN_KEYS, schemas.PARTITION)
    return spark.table(table)


@_query
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``upsert_rarity`` on a table in buckets of the token."""
    table = schemas.TableNames(prefix=scratch_database(spark)).full("rarity")
    upsert.create_bucketed(spark, table, schemas.RARITY, schemas.PARTITION, "token_id", 8)
    upsert.append_bucketed(inputs.order_ranks(spark, sf_dir), table)
    changed = inputs.changed_order_ranks(inputs.read(spark, sf_dir, "orders"))
    upsert.merge_upsert_bucketed(changed, table, schemas.TOKEN_KEYS, schemas.PARTITION)
    return spark.table(table)


@_query
def insert_missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = schemas.TableNames(prefix=scratch_database(spark)).full("rarity")
    upsert.create_table(spark, table, schemas.RARITY, schemas.PARTITION)
    upsert.append(inputs.order_ranks(spark, sf_dir), table, schemas.PARTITION)
    changed = inputs.changed_order_ranks(inputs.read(spark, sf_dir, "orders"))
    upsert.insert_missing(changed, table, schemas.TOKEN_KEYS, schemas.PARTITION)
    return spark.table(table)


@_query
def schema_evolving_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = schemas.TableNames(prefix=scratch_database(spark)).full("base")
    part = inputs.read(spark, sf_dir, "part").withColumnRenamed("p_type", "collection_id")
    narrow = part.select("p_partkey", "p_name", "collection_id")
    upsert.create_table(spark, table, narrow.schema, schemas.PARTITION)
    upsert.append(narrow, table, schemas.PARTITION)
    upsert.append(part.select("collection_id", "p_size", "p_partkey"), table, schemas.PARTITION)
    return spark.table(table)


@_query
def end_to_end_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = RarityRun(spark, schemas.TableNames(prefix=scratch_database(spark)))
    run.run(
        inputs.part_contracts(spark, sf_dir),
        inputs.part_pages(spark, sf_dir),
        inputs.part_documents(spark, sf_dir),
    )
    return _ranked_with_status(run)


@_query
def resume_after_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the pages and documents fail in the first landing and are sound in the second."""
    run = RarityRun(spark, schemas.TableNames(prefix=scratch_database(spark)))
    contracts = inputs.part_contracts(spark, sf_dir)
    pages, documents = inputs.part_pages(spark, sf_dir), inputs.part_documents(spark, sf_dir)

    def landing(df: DataFrame, number: int, failed: Column) -> DataFrame:
        numbered = df.withColumn("landed_no", F.lit(number).cast("long"))
        return numbered.withColumn("http_status", F.when(failed, 500).otherwise(F.col("http_status")))

    first_pages = landing(pages, 1, F.col("page_no") % 2 == 1)
    first_documents = landing(documents, 1, F.col("token_id").cast("long") % 3 == 0)
    run.run(contracts, first_pages, first_documents)
    none = F.lit(False)
    for _ in range(2):
        run.run(
            contracts,
            first_pages.unionByName(landing(pages, 2, none)),
            first_documents.unionByName(landing(documents, 2, none)),
        )
    return _ranked_with_status(run)


def _ranked_with_status(run: RarityRun) -> DataFrame:
    return run.table("rarity").join(
        run.table("registry").select(
            F.col("id").cast("string").alias("collection_id"), "contract_address", "status"
        ),
        "collection_id",
    )


# -- streaming --------------------------------------------------------------------------


@_query
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = schemas.TableNames(prefix=scratch_database(spark)).full("rarity")
    upsert.create_if_missing(inputs.order_ranks(spark, sf_dir), table, schemas.PARTITION)
    schema = inputs.read(spark, sf_dir, "orders").schema
    orders = incremental.file_stream(
        spark, sf_dir, schema, "parquet", pathGlobFilter="orders.parquet"
    )
    incremental.drain_into(
        inputs.changed_order_ranks(orders),
        table,
        schemas.TOKEN_KEYS,
        schemas.PARTITION,
        Staging(spark).path("stream"),
    )
    return spark.table(table)


@_query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents landed as JSON files, drained into base and metadata tables."""
    run = RarityRun(spark, schemas.TableNames(prefix=scratch_database(spark)))
    run.create_tables()
    run.register(inputs.part_contracts(spark, sf_dir))
    staging = Staging(spark)
    pages, documents = staging.path("pages"), staging.path("documents")
    inputs.part_pages(spark, sf_dir).write.json(pages)
    inputs.part_documents(spark, sf_dir).write.json(documents)
    incremental.drain_pages(
        incremental.file_stream(spark, pages, schemas.PAGES), run.names, staging.path("stream")
    )
    incremental.drain_documents(
        incremental.file_stream(spark, documents, schemas.DOCUMENTS),
        run.names,
        staging.path("stream"),
    )
    run.rank()
    return audit.audit_tokens(run.table("base"), run.table("rarity"), run.table("metadata"))


@_query
def waiting_in_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents before their pages and pages before their contract, each landing in two portions
    with a drain between, so that what waits in the streams' state is let go in several batches."""
    run = RarityRun(spark, schemas.TableNames(prefix=scratch_database(spark)))
    run.create_tables()
    staging = Staging(spark)
    paths = {k: staging.path(k) for k in ("pages", "documents", "pages_seen", "documents_seen")}
    pages, documents = inputs.part_pages(spark, sf_dir), inputs.part_documents(spark, sf_dir)
    contracts = inputs.part_contracts(spark, sf_dir)
    even = {"pages": F.col("page_no") % 2 == 0, "documents": F.col("token_id").cast("long") % 2 == 0}

    def land(first: bool) -> None:
        for name, df in (("pages", pages), ("documents", documents)):
            df.filter(even[name] == F.lit(first)).write.mode("append").json(paths[name])

    def drain() -> None:
        stream = incremental.file_stream(spark, paths["documents"], schemas.DOCUMENTS)
        incremental.drain_documents(stream, run.names, paths["documents_seen"])
        stream = incremental.file_stream(spark, paths["pages"], schemas.PAGES)
        incremental.drain_pages(stream, run.names, paths["pages_seen"])

    land(True)
    drain()
    run.register(contracts)
    land(False)
    for _ in range(2):
        drain()
    run.rank()
    return _ranked_with_status(run)


@_query
def late_arrivals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drained before their pages, and pages before their contract is registered."""
    run = RarityRun(spark, schemas.TableNames(prefix=scratch_database(spark)))
    run.create_tables()
    staging = Staging(spark)
    paths = {k: staging.path(k) for k in ("pages", "documents", "pages_seen", "documents_seen")}
    inputs.part_pages(spark, sf_dir).write.json(paths["pages"])
    inputs.part_documents(spark, sf_dir).write.json(paths["documents"])

    def drain() -> None:
        documents = incremental.file_stream(spark, paths["documents"], schemas.DOCUMENTS)
        incremental.drain_documents(documents, run.names, paths["documents_seen"])
        pages = incremental.file_stream(spark, paths["pages"], schemas.PAGES)
        incremental.drain_pages(pages, run.names, paths["pages_seen"])

    drain()
    run.register(inputs.part_contracts(spark, sf_dir))
    for _ in range(2):
        drain()
    run.rank()
    return _ranked_with_status(run)
