"""Scans: catalog tables, files with a known schema, and wide rows turned into trait rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank import schemas


def read_table(spark: SparkSession, name: str, collection_ids: Sequence[str] = ()) -> DataFrame:
    """A catalog table, pruned to the partitions of ``collection_ids`` if any are given.

    Ids are compared as text: a number literal would cast the partition column and fail
    on ids that are not numbers.
    """
    df = spark.table(name)
    if collection_ids:
        df = df.filter(F.col(schemas.PARTITION).isin([str(i) for i in collection_ids]))
    return df


def fresh_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as it is now. Without this a session may use the list of files it
    has kept, and miss what another session - a stream's, say - has written since.
    """
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages (JSON lines with the response body as text)."""
    return spark.read.schema(schemas.PAGES).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed metadata documents (JSON lines with the response body as text)."""
    return spark.read.schema(schemas.DOCUMENTS).json(path)


def read_merged(spark: SparkSession, paths: Sequence[str], file_format: str = "parquet") -> DataFrame:
    """Folders of several schemas as one relation, each read with its own schema and partitions.

    Columns are matched by name in any spelling and keep the order and spelling in which they first
    appear; a folder without a column gives NULL. A column of several types gets the type that Spark
    widens them to, and text where one of them is text and another is not. Filters and the choice
    of columns reach every folder. No path: a ValueError.
    """
    if not paths:
        raise ValueError("no path to read")
    folders = [spark.read.format(file_format).load(path) for path in paths]
    kinds: dict[str, set[str]] = {}
    for df in folders:
        for name, kind in df.dtypes:
            kinds.setdefault(name.lower(), set()).add(kind)
    mixed = {name for name, found in kinds.items() if len(found) > 1 and "string" in found}

    def as_text(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c.lower() in mixed else F.col(f"`{c}`") for c in df.columns])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(as_text, folders))


def use_namespace(spark: SparkSession, catalog: str | None = None, database: str | None = None) -> None:
    """Make a catalog and a database current."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)


def traits_from_columns(
    df: DataFrame, collection: Column, token: Column, traits: Mapping[str, Column]
) -> DataFrame:
    """One trait row per (row, column): a wide table in the long form the score works on."""
    return df.select(
        collection.cast("string").alias("collection_id"),
        token.cast("string").alias("token_id"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("trait_type"),
                        value.cast("string").alias("trait_value"),
                    )
                    for kind, value in traits.items()
                ]
            )
        ).alias("trait"),
    ).select("collection_id", "token_id", "trait.trait_type", "trait.trait_value")
