"""The given Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; column pruning and filters reach the Parquet scan.

    ``jobmart.inputPartitions`` (unset by default) deals the rows out to so many
    partitions: for a bench on files of one row group, which are one task each."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    n = spark.conf.get("jobmart.inputPartitions", None)
    return df.repartition(int(n)) if n else df
