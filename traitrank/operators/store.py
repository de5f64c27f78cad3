"""Parsed input into the tables: usable rows to base and metadata, the rest to quarantine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.operators import ingest
from traitrank.operators.upsert import append, insert_missing, merge_upsert

_REJECT_KEYS = ["collection_id", "stage", "item", "reject_reason"]


# Taken for granted where the records were not counted.
_SOME = {"usable": 1, "rejected": 1}


def store_records(records: DataFrame, names: schemas.TableNames, counts: Mapping[str, int] = _SOME) -> None:
    """Add the tokens among ``page_records`` to the base table. Pass the records staged.

    ``counts`` of usable and rejected records spare the jobs for those there are none of.
    """
    if counts["usable"]:
        listed = ingest.first_listing(ingest.listed_tokens(records))
        insert_missing(listed, names.full("base"), schemas.TOKEN_KEYS, schemas.PARTITION)
    if counts["rejected"]:
        place = F.concat_ws("/", "page_no", "record_no")
        _quarantine(ingest.rejected_records(records), "base", place, names)


def store_documents(records: DataFrame, names: schemas.TableNames, counts: Mapping[str, int] = _SOME) -> None:
    """Append the traits among ``document_records``. Pass the records staged, of tokens that have
    no metadata yet. ``counts`` as for ``store_records``."""
    if counts["usable"]:
        append(ingest.trait_rows(records), names.full("metadata"), schemas.PARTITION)
    if counts["rejected"]:
        _quarantine(ingest.bad_documents(records), "metadata", F.col("token_id"), names)


def note_pages(records: DataFrame, names: schemas.TableNames) -> None:
    """Keep in the ledger which pages among ``page_records`` were answered."""
    item = F.col("page_no").cast("string")
    _note(records, "base", item, ~F.col("reject_reason").eqNullSafe(F.lit("http_status")), names)


def note_documents(records: DataFrame, names: schemas.TableNames) -> None:
    """Keep in the ledger which documents among ``document_records`` gave no rows, and why."""
    unused = records.filter(F.col("reject_reason").isNotNull())
    _note(unused, "metadata", F.col("token_id"), F.col("reject_reason") != "http_status", names)


def reject_collections(collections: DataFrame, reason: str, names: schemas.TableNames) -> None:
    """Keep the collections (collection_id) that could not be ranked."""
    described = collections.withColumn("reject_reason", F.lit(reason)).withColumn("body", F.lit(None).cast("string"))
    _quarantine(described, "rank", F.col("collection_id"), names)


def _note(records: DataFrame, stage: str, item: Column, ok: Column, names: schemas.TableNames) -> None:
    entries = records.groupBy("collection_id", F.lit(stage).alias("stage"), item.alias("item")).agg(
        F.max("landed_no").alias("landed_no"), F.bool_and(ok).alias("ok")
    )
    merge_upsert(entries, names.full("ledger"), ["collection_id", "stage", "item"], schemas.PARTITION)


def _quarantine(rejects: DataFrame, stage: str, item: Column, names: schemas.TableNames) -> None:
    """Keep each reject once, however often its input lands or a batch is replayed."""
    described = rejects.select(
        "collection_id", F.lit(stage).alias("stage"), item.alias("item"), "reject_reason", "body"
    )
    once = described.groupBy(*_REJECT_KEYS).agg(F.min("body").alias("body"))
    insert_missing(once, names.full("rejects"), _REJECT_KEYS, schemas.PARTITION)
