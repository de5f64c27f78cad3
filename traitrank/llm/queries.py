"""One registered query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank.llm import clustering, embedding_dedup, fingerprints, line_dedup, mixing, negatives, packing, quality, quotations, sharding, simhash, toxicity, warc
from traitrank.llm.common import crc_remainder, table
from traitrank.sources.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.compare_with_neighbours(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a model that never saw a fifth of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(crc_remainder("doc_id", 5) != 0))
    scored = docs.select(
        "doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"),
        toxicity.toxicity_score(spark, model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotations, and its place in reply order."""
    return quotations.reply_order(table(spark, sf_dir, "conversations"))


def op4_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shown text of every page without the lines that stand on too many pages of its host."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        line_dedup.url_host(F.col("url")).alias("host"),
        line_dedup.html_text(F.col("html")).alias("text"),
    )
    return line_dedup.drop_boilerplate(pages, text="text", host="host", counts=("n_lines", "n_dropped"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and the target of its source."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    rows = plan.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    taken = mixing.own_share("nth", "copies", "m") * F.col("size")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of near copies of every document."""
    classes = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return classes.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into WARC archives and read back from them."""
    staging = Staging(spark)
    folder = staging.path("archive")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder, staging)
    return warc.read_archives(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector among those of its label."""
    return embedding_dedup.vector_classes(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every token of every document lies in windows of 1024."""
    return packing.pack_by_retrieval(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by neighbours among two thirds of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(crc_remainder("doc_id", 3) != 1))
    scored = docs.select(
        "doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"),
        quality.quality_score(spark, model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds, and what the clustering came to."""
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("n_compared")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by bytes."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector for each of its positives."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_spotsigs": op1_spotsigs,
        "op2_toxicity": op2_toxicity,
        "op3_quotations": op3_quotations,
        "op4_site_lines": op4_site_lines,
        "op5_mixing": op5_mixing,
        "op6_simhash": op6_simhash,
        "op7_warc": op7_warc,
        "op8_embeddings": op8_embeddings,
        "op9_packing": op9_packing,
        "op10_quality": op10_quality,
        "op11_clustering": op11_clustering,
        "op12_sharding": op12_sharding,
        "op13_negatives": op13_negatives,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op3_quotations": quotations.ORACLE,
        "op4_site_lines": line_dedup.ORACLE,
        "op11_clustering": clustering.ORACLE,
        "op13_negatives": negatives.ORACLE,
    }
