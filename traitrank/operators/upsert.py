"""Writes to catalog tables: append, insert-only, upsert and update.

The tables are plain parquet, which has no MERGE, so a merge is a join and a rewrite of the
partitions it touches. Such a rewrite is not atomic across partitions and not safe against
another writer of the same partitions. What is written is staged first, the rows that only the
table has included, so a rewrite that breaks off can be finished from the staged copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitrank.operators.joins import Size, lookup_join, measure, restrict
from traitrank.sources.staging import Staging
from traitrank.sources.tables import fresh_table

_DYNAMIC_OVERWRITE = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
# A table in buckets of one key serves a join on that key and others, and keeps its buckets where
# nothing is joined.
_BY_BUCKETS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition: str | None = None,
    location: str | None = None,
) -> None:
    """Create an empty parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY (`{partition}`)" if partition else ""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}{at}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_if_missing(df: DataFrame, table: str, partition: str, path: str | None = None) -> None:
    """Create the table from ``df``; an existing table stays as it is and ``df`` is not run."""
    writer = _rebalanced(df, partition).write.mode("ignore").format("parquet").partitionBy(partition)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _rebalanced(df: DataFrame, partition: str | None) -> DataFrame:
    """Few files per table partition, while a large partition still has many writers."""
    return df.hint("rebalance", partition) if partition else df.hint("rebalance")


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    return df.select(*df.sparkSession.table(table).columns)


def append(df: DataFrame, table: str, partition: str | None = None) -> None:
    """Append by column name. New columns are added to the table, absent ones stay NULL."""
    spark = df.sparkSession
    known = spark.table(table).schema
    added = [f for f in df.schema.fields if f.name not in known.names]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    full = df.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in known if f.name not in df.columns]
    )
    _in_table_order(_rebalanced(full, partition), table).write.insertInto(table)


def unique_size(source: DataFrame, keys: Sequence[str]) -> Size:
    """Size of the keys of ``source``; fails if a key occurs twice, as MERGE does."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    size = measure(per_key, "n")
    if size.largest > 1:
        raise ValueError(f"merge source holds a key ({', '.join(keys)}) {size.largest} times")
    return size


def upserted(
    target: DataFrame, source: DataFrame, keys: Sequence[str], size: Size | None = None
) -> DataFrame:
    """Rows of ``target`` without a new version, and all of ``source``.

    ``target`` is shuffled only if the source keys are too many to broadcast.
    """
    kept = lookup_join(target, source.select(*keys), keys, how="left_anti", size=size)
    return kept.unionByName(source, allowMissingColumns=True).select(*target.columns)


def absent(
    source: DataFrame, target: DataFrame, keys: Sequence[str], size: Size | None = None
) -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks; ``target`` may repeat keys."""
    wanted = source.select(*keys)
    size = size or measure(wanted)
    if size.broadcastable:
        # Then at most as many keys as the source has leave the scan of the target.
        target = target.join(F.broadcast(wanted), list(keys), "left_semi")
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")


def updated(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    size: Size | None = None,
) -> DataFrame:
    """``target`` with ``columns`` replaced where a key matches, by NULL as well.

    ``size`` is that of the updates with their columns, which are what may be broadcast.
    """
    new = updates.select(
        *keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns]
    )
    joined = lookup_join(target, new, keys, how="left", spread=target.columns, size=size)
    return joined.select(
        *[
            F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def insert_missing(
    source: DataFrame, table: str, keys: Sequence[str], partition: str, staging: Staging | None = None
) -> None:
    """Append the source rows whose key the table lacks. Touches no existing file."""
    staging = staging or Staging.of(source)
    staged = staging.write(source, "incoming")
    size = unique_size(staged, keys)
    touched = touched_rows(fresh_table(source.sparkSession, table), staged, keys, partition)
    append(absent(staged, touched, keys, size), table, partition)


def touched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Target rows in the partitions that ``source`` has rows for."""
    return restrict(target, source, partition, [k for k in keys if k != partition])


def merge_upsert(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    *,
    replace_group: bool = False,
    staging: Staging | None = None,
) -> None:
    """Update rows whose key matches, insert the others, keep what only the table has.

    Only touched partitions are rewritten. With ``replace_group`` a touched partition ends
    up with the source rows alone, so rows withdrawn from the source disappear.
    """
    spark = source.sparkSession
    staging = staging or Staging.of(source)
    staged = staging.write(source, "incoming")
    size = unique_size(staged, keys)
    target = fresh_table(spark, table)
    if replace_group:
        result = staged
    else:
        result = upserted(touched_rows(target, staged, keys, partition), staged, keys, size)
        result = staging.write(result, "merged")
    with _settings(spark, _DYNAMIC_OVERWRITE):
        _in_table_order(_rebalanced(result, partition), table).write.insertInto(table, overwrite=True)


def replace_groups(staged: DataFrame, table: str, partition: str) -> None:
    """The partitions that ``staged`` has rows for hold these alone. Pass it staged: it may come from the table."""
    fresh_table(staged.sparkSession, table)
    with _settings(staged.sparkSession, _DYNAMIC_OVERWRITE):
        _in_table_order(_rebalanced(staged, partition), table).write.insertInto(table, overwrite=True)


def merge_update(
    updates: DataFrame,
    table: str,
    keys: Sequence[str],
    columns: Sequence[str],
    staging: Staging | None = None,
) -> None:
    """Set ``columns`` where a key matches; nothing is inserted. For unpartitioned tables.

    The whole table is rewritten from a staged copy, which remains if the rewrite fails.
    """
    spark = updates.sparkSession
    staging = staging or Staging.of(updates)
    staged = staging.write(updates.select(*keys, *columns), "updates")
    unique_size(staged, keys)
    changed = updated(fresh_table(spark, table), staged, keys, columns, measure(staged))
    staging.write(changed, "updated").write.insertInto(table, overwrite=True)


def create_bucketed(
    spark: SparkSession, name: str, schema: T.StructType, partition: str, bucket: str, buckets: int
) -> None:
    """Create an empty parquet table of partitions in ``buckets`` buckets of ``bucket``, unless it exists.

    Each partition holds at most one file per bucket and write, so this is for few large partitions.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`)"
        f" CLUSTERED BY (`{bucket}`) SORTED BY (`{bucket}`) INTO {buckets} BUCKETS"
    )


def buckets_of(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """The column and the number of the buckets of a table; None if it has none."""
    named = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in named:
        return None
    return named["Bucket Columns"].strip("[]").replace("`", ""), int(named["Num Buckets"])


def bucketed_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of both with those of ``source`` where a key is in either; for a ``target`` in buckets.

    Both meet in one full join, for which only ``source`` is shuffled, into the target's buckets. A
    task holds one bucket of all partitions, so its rows are written as they lie. ``target`` may
    repeat a key that ``source`` lacks.
    """
    new = source.select(F.struct(*columns).alias("__new"), *[F.col(k).alias(f"__{k}") for k in keys])
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    joined = target.select(*columns).hint("merge").join(new, on, "full")
    return joined.select(
        *[F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )


def append_bucketed(df: DataFrame, table: str) -> None:
    """Append by column name, each bucket written by one task."""
    spark = df.sparkSession
    bucket, buckets = buckets_of(spark, table)
    _in_table_order(df.repartition(buckets, bucket), table).write.insertInto(table)


def merge_upsert_bucketed(
    source: DataFrame, table: str, keys: Sequence[str], partition: str, *, staging: Staging | None = None
) -> None:
    """``merge_upsert`` into a table of buckets: however many keys come, the table is never shuffled.

    The buckets are of one of ``keys``. What is merged is staged in the same buckets as a table beside
    ``table``, whose entry goes once the touched partitions are overwritten from it. Keys that are
    NULL match nothing. Fails if the source repeats a key or the table has no such buckets.
    """
    spark = source.sparkSession
    bucket, buckets = buckets_of(spark, table) or (None, 0)
    if bucket not in keys:
        raise ValueError(f"{table} has no buckets of one of ({', '.join(keys)})")
    staging = staging or Staging.of(source)
    target = fresh_table(spark, table)
    staged = staging.write(source.select(*target.columns), "incoming")
    unique_size(staged, keys)
    merged = f"{table}_merged_{uuid.uuid4().hex}"
    with _settings(spark, _BY_BUCKETS):
        result = bucketed_merge(touched_rows(target, staged, keys, partition), staged, keys, target.columns)
        (
            result.write.format("parquet").bucketBy(buckets, bucket).sortBy(bucket)
            .option("path", staging.path("merged")).saveAsTable(merged)
        )
        with _settings(spark, _DYNAMIC_OVERWRITE):
            _in_table_order(spark.table(merged), table).write.insertInto(table, overwrite=True)
    # Its files stay in the shared folder, as all that is staged.
    drop_table(spark, merged)
