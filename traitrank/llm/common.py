"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitrank.operators.joins import Size, lookup_join

# A side is broadcast up to so many estimated bytes, by count of its rows and not of its files.
SMALL_BYTES = 16 << 20


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def without(rows: DataFrame, ids: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``ids``, one narrow column of distinct values.

    ``ids`` is counted: it is broadcast while small and met by a salted join beyond.
    """
    n = ids.count()
    fits = 64 * n <= SMALL_BYTES
    size = Size(rows=n, bytes=64 * n if fits else 1 << 62)
    return lookup_join(rows, ids, [key], how="left_anti", spread=[spread], size=size)
