"""From raw documents to packed sequences, stage by stage.

Each stage applies one operator to everything its predecessor kept. What a stage returns is
written to the shared folder and read again by the next one, so a lost executor never costs
more than the stage that was running. A source counts as the site of its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank.llm import line_dedup, mixing, packing, quality, simhash
from traitrank.llm.common import crc_remainder, table
from traitrank.sources.staging import Staging


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; a third of the labels is held out."""
    labels = table(spark, sf_dir, "labels").filter(crc_remainder("doc_id", 3) != 1)
    score = quality.quality_score(spark, quality.train(docs, labels), F.col("text"))
    return docs.withColumn("__score", score).filter("__score >= 0.5").select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand in too many documents of their source."""
    cleaned = line_dedup.drop_boilerplate(docs, text="text", host="source")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of every copy lie in windows of 1024."""
    return packing.pack_by_retrieval(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

# A trained classifier and a tokenizer are beyond SQL; tests hold every stage against a plain loop.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
