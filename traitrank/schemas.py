"""Table schemas, table names and collection states."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Column names, column order and types of the four tables. Readers of
# existing tables rely on them.
REGISTRY = T.StructType(
    [
        T.StructField("id", T.IntegerType(), True),
        T.StructField("collection_name", T.StringType(), True),
        T.StructField("contract_address", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)
BASE = _strings(
    "collection_id",
    "collection_name",
    "contract_address",
    "token_id",
    "name",
    "description",
    "image_url",
)
METADATA = T.StructType(
    BASE.fields
    + _strings("attributes_json", "metadata_json", "trait_type", "trait_value").fields
)
RARITY = T.StructType(
    [
        T.StructField("collection_id", T.StringType(), True),
        T.StructField("token_id", T.StringType(), True),
        T.StructField("rarity_score", T.IntegerType(), True),
        T.StructField("rank", T.IntegerType(), True),
    ]
)

# Ours: input that could not be used, per stage and page, record or token.
REJECTS = _strings("collection_id", "stage", "item", "reject_reason", "body")

# Ours: what became of the landings of each page and document that gave no rows for good.
LEDGER = T.StructType(
    _strings("collection_id", "stage", "item").fields
    + [T.StructField("landed_no", T.LongType(), True), T.StructField("ok", T.BooleanType(), True)]
)

# The states a collection passes through, in this order.
NOT_FETCHED = "NOT_FETCHED"
FETCHING = "FETCHING"
FETCHED = "FETCHED"
METADATA_FETCHING = "METADATA_FETCHING"
METADATA_FETCHED = "METADATA_FETCHED"

PARTITION = "collection_id"
TOKEN_KEYS = ("collection_id", "token_id")

# Landed input: one row per listing response, one row per metadata response. Listing responses
# may have a LONG ``landed_no`` as well, which tells a later response of a page from an earlier one.
PAGES = T.StructType(
    [
        T.StructField("contract_address", T.StringType(), True),
        T.StructField("page_no", T.LongType(), True),
        T.StructField("http_status", T.IntegerType(), True),
        T.StructField("body", T.StringType(), True),
    ]
)
DOCUMENTS = T.StructType(
    [
        T.StructField("contract_address", T.StringType(), True),
        T.StructField("token_id", T.StringType(), True),
        T.StructField("landed_no", T.LongType(), True),
        T.StructField("http_status", T.IntegerType(), True),
        T.StructField("body", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class TableNames:
    """Names of the tables; ``prefix`` may hold a catalog, a database or both."""

    # The names existing reports use.
    prefix: str = ""
    registry: str = "collection_reference"
    base: str = "nft_base_table"
    metadata: str = "nft_metadata_table"
    rarity: str = "nft_rarity_table"
    rejects: str = "ingest_rejects"
    ledger: str = "ingest_ledger"

    def full(self, kind: str) -> str:
        name = getattr(self, kind)
        return f"{self.prefix}.{name}" if self.prefix else name

    def schemas(self) -> dict[str, T.StructType]:
        return {
            self.full("registry"): REGISTRY,
            self.full("base"): BASE,
            self.full("metadata"): METADATA,
            self.full("rarity"): RARITY,
            self.full("rejects"): REJECTS,
            self.full("ledger"): LEDGER,
        }
