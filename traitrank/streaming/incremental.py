"""Incremental ingest: landed files as streams, each batch merged into the tables.

The stream's checkpoint remembers which files are done. A batch may be replayed after a
failure, so every handler writes by key and a replay changes nothing. Rows that come before what
they belong to wait in the stream's state. The data carries no event time, hence no watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitrank import schemas
from traitrank.operators.ingest import with_landing
from traitrank.operators.upsert import merge_upsert
from traitrank.plans.rarity_run import RarityRun
from traitrank.sources.staging import Staging
from traitrank.streaming.arrivals import held_until_open, keyed_state

FILES_PER_BATCH = 1000
# Places in which the early pages of one contract wait.
PAGE_SALTS = 16


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "json",
    files_per_batch: int = FILES_PER_BATCH,
    **options: str,
) -> DataFrame:
    """New files under ``path``, a bounded number of them per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(file_format).options(**options).load(path)


def drain(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame], None]) -> None:
    """Process everything that has landed so far in batches, then stop."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: handle(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_into(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    checkpoint: str,
    newest_by: str | None = None,
) -> None:
    """Upsert a stream of rows into a table.

    With ``newest_by`` a batch may hold several versions of a key; the one with the greatest
    value of that column is taken. Without it a repeated key is an error.
    """

    def newest(batch: DataFrame) -> DataFrame:
        if newest_by is None:
            return batch
        row = F.max_by(F.struct(*batch.columns), F.struct(newest_by, *batch.columns)).alias("row")
        return batch.groupBy(*keys).agg(row).select("row.*")

    drain(stream, checkpoint, lambda batch: merge_upsert(newest(batch), table, keys, partition))
    stream.sparkSession.catalog.refreshTable(table)


def table_stream(spark: SparkSession, table: str, columns: Sequence[str], files_per_batch: int | None = None) -> DataFrame:
    """The rows of a parquet table as a stream of its files; rows of a file that is rewritten come again."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    schema = StructType([f for f in spark.table(table).schema.fields if f.name in columns])
    reader = spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(described["data_type"])


def _drain_held(
    landed: DataFrame, openings: DataFrame, keys: Sequence[str], checkpoint: str, handle: Callable[[DataFrame], None]
) -> None:
    """Hand landed rows to ``handle`` once their key is open."""
    # Rows without a key can never be taken up.
    held = held_until_open(landed.dropna(subset=list(keys)), openings.dropna(subset=list(keys)).select(*keys), keys)

    def batch(released: DataFrame) -> None:
        # Staged: whoever reads the batch twice would run its state twice.
        found = Staging.of(landed).write(released.drop(*keys), "released")
        if not found.isEmpty():
            handle(found)

    with keyed_state(landed.sparkSession):
        drain(held, checkpoint, batch)


def drain_pages(pages: DataFrame, names: schemas.TableNames, checkpoint: str) -> None:
    """Add the tokens of newly landed pages to the base table and advance the states.

    Pages of contracts that are not registered yet wait in the stream's state; the registry's files
    are a stream as well, and a contract that comes in it lets its pages go.
    """
    spark = pages.sparkSession
    run = RarityRun(spark, names)
    address = F.lower("contract_address").alias("__address")
    # The pages of one contract may be any share, so they wait in several places.
    placed = with_landing(pages).withColumn("__address", address).withColumn("__salt", F.pmod(F.xxhash64("page_no"), F.lit(PAGE_SALTS)))
    contracts = table_stream(spark, names.full("registry"), ["contract_address"]).select(
        address, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PAGE_SALTS - 1).cast("long"))).alias("__salt")
    )
    _drain_held(placed, contracts, ["__address", "__salt"], checkpoint, run.ingest_base)
    spark.catalog.refreshTable(names.full("base"))


def drain_documents(documents: DataFrame, names: schemas.TableNames, checkpoint: str) -> None:
    """Add the traits of newly landed documents for tokens that have none yet, and advance the states.

    Documents of tokens that are not listed yet wait, as pages do; the base table's files let them go.
    """
    spark = documents.sparkSession
    run = RarityRun(spark, names)
    address = F.lower("contract_address").alias("__address")
    keyed = documents.select("*", address, F.col("token_id").alias("__token"))
    listed = table_stream(spark, names.full("base"), ["contract_address", "token_id"], FILES_PER_BATCH).select(
        address, F.col("token_id").alias("__token")
    )
    _drain_held(keyed, listed, ["__address", "__token"], checkpoint, run.ingest_metadata)
    spark.catalog.refreshTable(names.full("metadata"))
