"""The whole run for any number of contracts at once: register, list, enrich, rank.

Every stage is one set of Spark jobs over all collections that wait for it. A stage can be
run again at any time: registration skips known addresses, listing adds unknown tokens,
enrichment skips enriched tokens, ranking merges by key. Work is what is missing and has landed:
a page or document that failed is taken up as soon as a newer landing is there, whatever the
state of its collection. A state says done only if nothing stands failed or is still to come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.operators import ingest, registry
from traitrank.operators.joins import restrict
from traitrank.operators.rarity import score_and_rank
from traitrank.operators.store import note_documents, note_pages, reject_collections, store_documents, store_records
from traitrank.operators.upsert import append, create_table, drop_table, merge_update, merge_upsert
from traitrank.sources.staging import Staging
from traitrank.sources.tables import fresh_table


class RarityRun:
    """Binds the stages to a session and a set of tables.

    ``location`` places the table files; by default they go to the session's warehouse.
    """

    def __init__(
        self,
        spark: SparkSession,
        names: schemas.TableNames | None = None,
        location: str | None = None,
    ):
        self.spark = spark
        self.names = names or schemas.TableNames()
        self.location = location
        # What the last run of a stage opened, counted while it was written.
        self.counts: dict[str, dict[str, int]] = {}

    def table(self, kind: str) -> DataFrame:
        return fresh_table(self.spark, self.names.full(kind))

    def create_tables(self) -> None:
        for name, schema in self.names.schemas().items():
            create_table(
                self.spark,
                name,
                schema,
                partition=schemas.PARTITION if schemas.PARTITION in schema.names else None,
                location=f"{self.location}/{name}" if self.location else None,
            )

    def reset(self) -> None:
        """Drop all tables. Files at an explicit ``location`` stay in place."""
        for name in self.names.schemas():
            drop_table(self.spark, name)

    def register(self, contracts: DataFrame) -> None:
        """Add unknown ``contracts`` (contract_address, ordinal[, collection_name])."""
        fresh = registry.register_collections(self.table("registry"), contracts)
        append(fresh, self.names.full("registry"))

    def _set_status(self, status: DataFrame) -> None:
        """Write the states (id, status) that differ from the registry's, if any do."""
        known = self.table("registry").select("id", F.col("status").alias("old"))
        changed = Staging.of(status).write(
            known.join(status, "id").filter(~F.col("old").eqNullSafe(F.col("status"))).drop("old"), "status"
        )
        if not changed.isEmpty():
            merge_update(changed, self.names.full("registry"), ["id"], ["status"])

    def _counted(self, stage: str, staging: Staging, records: DataFrame, usable: Column) -> DataFrame:
        """The records written; how many, and how many of them usable or rejected, is in ``counts``."""
        tests = {"usable": usable, "rejected": F.col("reject_reason").isNotNull()}
        counts = {name: F.count_if(test) for name, test in tests.items()}
        written, self.counts[stage] = staging.write_counted(
            records, "records", {"records": F.count(F.lit(1)), **counts}
        )
        return written

    def ingest_base(self, pages: DataFrame) -> None:
        """List the tokens of all landed pages that are new, or that failed and landed again.

        A collection is FETCHED once no page of it stands failed, else FETCHING.
        """
        attached = ingest.attach_collection(ingest.with_landing(pages), self.table("registry"))
        wanted = ingest.wanted_pages(attached, self.table("ledger"))
        # Staged: every page is opened once, and what is wanted changes with the ledger below.
        usable = F.col("reject_reason").isNull() & F.col("token_id").isNotNull()
        records = self._counted("base", Staging.of(pages), ingest.page_records(wanted), usable)
        if not self.counts["base"]["records"]:
            return
        store_records(records, self.names, self.counts["base"])
        note_pages(records, self.names)
        touched = records.select("collection_id").distinct()
        ledger = self._of(self.table("ledger"), touched).filter("stage = 'base'")
        done = F.when(F.bool_and("ok"), schemas.FETCHED).otherwise(schemas.FETCHING)
        self._set_status(
            ledger.groupBy(F.col("collection_id").cast("int").alias("id")).agg(done.alias("status"))
        )

    def ingest_metadata(self, documents: DataFrame) -> None:
        """Enrich the tokens without metadata that have a new document.

        A listed collection is METADATA_FETCHED once each of its tokens is enriched or has a
        document that cannot be used, else METADATA_FETCHING.
        """
        states = (schemas.FETCHING, *registry.AWAITING["metadata"])
        waiting = self.table("registry").filter(F.col("status").isin(*states)).select(
            F.col("id").cast("string").alias("collection_id")
        )
        staging = Staging.of(documents)
        ids = staging.write(waiting, "waiting")
        if ids.isEmpty():
            return
        tokens = staging.write(self._unenriched(ids), "tokens")
        if not tokens.isEmpty():
            joined = ingest.wanted_documents(tokens, documents, self._of(self.table("ledger"), ids))
            usable = F.col("reject_reason").isNull()
            records = self._counted("metadata", staging, ingest.document_records(joined), usable)
            if self.counts["metadata"]["records"]:
                store_documents(records, self.names, self.counts["metadata"])
                if self.counts["metadata"]["rejected"]:
                    note_documents(records, self.names)
                tokens = self._unenriched(ids)
        left = tokens.select("collection_id").distinct().withColumn("left", F.lit(True))
        done = F.when(F.col("left"), schemas.METADATA_FETCHING).otherwise(schemas.METADATA_FETCHED)
        listed = registry.pending(self.table("registry"), "metadata").select(
            "id", F.col("id").cast("string").alias("collection_id")
        )
        seen = self._of(self.table("base"), ids).select("collection_id").distinct()
        self._set_status(
            listed.join(seen, "collection_id").join(left, "collection_id", "left").select("id", done.alias("status"))
        )

    def _unenriched(self, ids: DataFrame) -> DataFrame:
        """Tokens of the collections that have neither metadata nor an unusable document."""
        base, metadata = self._of(self.table("base"), ids), self._of(self.table("metadata"), ids)
        unusable = self._of(self.table("ledger"), ids).filter("stage = 'metadata' AND ok").select(
            "collection_id", F.col("item").alias("token_id")
        )
        return ingest.enrichable_tokens(registry.pending_tokens(base, metadata)).join(
            unusable, list(schemas.TOKEN_KEYS), "left_anti"
        )

    def rank(self, collection_ids: DataFrame | None = None) -> None:
        """Score and rank the given collections (collection_id), or all, and merge the result.

        A collection with a score beyond INT is rejected, keeps its earlier ranks and stops no other.
        """
        base, metadata = self.table("base"), self.table("metadata")
        if collection_ids is not None:
            base, metadata = self._of(base, collection_ids), self._of(metadata, collection_ids)
        ranks, overflowing = score_and_rank(metadata, base)
        if not overflowing.isEmpty():
            reject_collections(overflowing, "score_overflow", self.names)
        merge_upsert(
            ranks,
            self.names.full("rarity"),
            schemas.TOKEN_KEYS,
            schemas.PARTITION,
        )

    def run(self, contracts: DataFrame, pages: DataFrame, documents: DataFrame) -> None:
        """Everything for ``contracts``, from registration to ranks."""
        self.create_tables()
        self.register(contracts)
        self.ingest_base(pages)
        self.ingest_metadata(documents)
        self.rank(registry.collections_of(self.table("registry"), contracts))

    def _of(self, df: DataFrame, collection_ids: DataFrame) -> DataFrame:
        return restrict(df, collection_ids, "collection_id", ["token_id"])
