"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage: once written, a lost executor costs a re-read, not a
recomputation, and the size of the result is known before the next plan is chosen.
"""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. On a cluster the setting
    is required, since executors do not share a machine's temporary folder.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="traitrank-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Staging:
    """Writes DataFrames under a folder of its own and hands back the written tables.

    The files stay until the shared folder is cleaned; nothing here deletes data.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/traitrank-{uuid.uuid4().hex}"

    @classmethod
    def of(cls, df: DataFrame) -> "Staging":
        return cls(df.sparkSession)

    def path(self, label: str) -> str:
        return f"{self.folder}/{label}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, label: str) -> DataFrame:
        target = self.path(label)
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def write_counted(self, df: DataFrame, label: str, counts: Mapping[str, Column]) -> tuple[DataFrame, dict]:
        """The written table and the aggregates ``counts`` over its rows, taken while they are written.

        The counts come from the tasks that write, after all shuffles, so a lost executor whose
        output has to be made again does not count twice. A failed write gives none.
        """
        seen = Observation(f"{label}-{uuid.uuid4().hex}")
        written = self.write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), label)
        return written, seen.get
