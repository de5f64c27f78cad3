"""A local session for tests and benchmarks; on a cluster the caller brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the jobs expect of a session. AQE sizes shuffle partitions, splits skewed ones and
# turns a join into a broadcast when its side proves small.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cpus: int | str = "*", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("traitrank")
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
