"""Registry of collections: ids, labels, contract addresses and processing status.

Contracts are the same if their addresses agree in lower case. Reading never writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.functions import collection_label
from traitrank.operators.joins import lookup_join
from traitrank.operators.ordering import positions
from traitrank.sources.staging import Staging

# States in which a collection still waits for a stage.
AWAITING = {
    "base": (schemas.NOT_FETCHED, schemas.FETCHING),
    "metadata": (schemas.FETCHED, schemas.METADATA_FETCHING),
}

_ADDRESS_KEY = "__address"


def highest_id(registry: DataFrame) -> int:
    return registry.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]


def _numbered(registry: DataFrame, fresh: DataFrame, order: list[Column], staging: Staging) -> DataFrame:
    """Registry rows for ``fresh`` (collection_name, contract_address), ids from the highest on."""
    start = highest_id(registry)
    # Staged, because numbering counts the rows before it reads them.
    placed = positions(staging.write(fresh, "fresh"), [], order, "place", staging=staging)
    return placed.select(
        (F.col("place") + F.lit(start)).cast("int").alias("id"),
        "collection_name",
        "contract_address",
        F.lit(schemas.NOT_FETCHED).alias("status"),
    )


def register_collections(
    registry: DataFrame, incoming: DataFrame, staging: Staging | None = None
) -> DataFrame:
    """Registry rows to append for ``incoming`` (contract_address, ordinal[, collection_name]).

    Known addresses are skipped, repeated ones keep their first entry, and ids follow the
    order of ``ordinal``. Without a name the label is made from the address.
    """
    staging = staging or Staging.of(incoming)
    if "collection_name" not in incoming.columns:
        incoming = incoming.withColumn("collection_name", collection_label(F.col("contract_address")))
    first = (
        incoming.groupBy(F.lower("contract_address").alias(_ADDRESS_KEY))
        .agg(F.min(F.struct("ordinal", "collection_name", "contract_address")).alias("row"))
        .select(_ADDRESS_KEY, "row.*")
    )
    known = registry.select(F.lower("contract_address").alias(_ADDRESS_KEY)).filter(
        F.col(_ADDRESS_KEY).isNotNull()
    )
    fresh = lookup_join(first, known, [_ADDRESS_KEY], how="left_anti")
    return _numbered(registry, fresh, [F.col("ordinal"), F.col(_ADDRESS_KEY)], staging)


def by_name(registry: DataFrame) -> DataFrame:
    """One row per collection name: the lowest id, where a label is not unique."""
    return (
        registry.groupBy("collection_name")
        .agg(F.min(F.struct("id", "contract_address", "status")).alias("row"))
        .select("collection_name", "row.*")
    )


def find(registry: DataFrame, names: DataFrame) -> DataFrame:
    """Id, address and status for each of ``names``; NULL where a name is unknown."""
    return lookup_join(names, by_name(registry), ["collection_name"], how="left")


def find_by_address(registry: DataFrame, address: str) -> DataFrame:
    return registry.filter(F.lower("contract_address") == address.lower())


def missing_names(
    registry: DataFrame, names: DataFrame, staging: Staging | None = None
) -> DataFrame:
    """Registry rows to append for unknown ``names`` (collection_name, ordinal), without address."""
    staging = staging or Staging.of(names)
    first = names.groupBy("collection_name").agg(F.min("ordinal").alias("ordinal"))
    known = registry.select("collection_name").filter(F.col("collection_name").isNotNull()).distinct()
    fresh = lookup_join(first, known, ["collection_name"], how="left_anti").withColumn(
        "contract_address", F.lit(None).cast("string")
    )
    return _numbered(registry, fresh, [F.col("ordinal"), F.col("collection_name")], staging)


def get_or_create(registry: DataFrame, names: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Registry rows for all ``names``: the known ones and the ones to append (``created``)."""
    known = by_name(
        lookup_join(registry, names.select("collection_name").distinct(), ["collection_name"], how="left_semi")
    ).withColumn("created", F.lit(False))
    created = missing_names(registry, names, staging).withColumn("created", F.lit(True))
    return known.unionByName(created)


def collections_of(registry: DataFrame, contracts: DataFrame) -> DataFrame:
    """Collection ids, as text, of ``contracts`` (contract_address)."""
    wanted = contracts.select(F.lower("contract_address").alias(_ADDRESS_KEY)).distinct()
    keyed = registry.withColumn(_ADDRESS_KEY, F.lower("contract_address"))
    return keyed.join(wanted, _ADDRESS_KEY, "left_semi").select(
        F.col("id").cast("string").alias("collection_id")
    )


def pending(registry: DataFrame, stage: str) -> DataFrame:
    """Collections that still wait for ``stage`` ("base" or "metadata")."""
    status = F.coalesce(F.col("status"), F.lit(schemas.NOT_FETCHED))
    return registry.filter(status.isin(*AWAITING[stage]))


def pending_tokens(base: DataFrame, metadata: DataFrame) -> DataFrame:
    """Base tokens without any metadata row. Copies on both sides meet before the join."""
    done = metadata.select(*schemas.TOKEN_KEYS).distinct()
    return base.filter(F.col("token_id").isNotNull()).join(done, list(schemas.TOKEN_KEYS), "left_anti")
