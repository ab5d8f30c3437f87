"""Ranks within groups of any size.

A window over a group puts all its rows into one task.  Here rows are dealt by range of (group,
order), so that a group spreads over as many tasks as its share of the rows; each task
numbers its part, and the parts before it, counted per group, are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def distributed_rank(rows: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``rows`` with their place (from 1) in each group of ``keys`` by ``order``.

    The ranged rows are staged, so that both passes see the same parts; a part's number is
    no longer needed once offsets are added.  Rows that are equal in keys and order lie in one part."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    held = ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_held"))
    # one row a group and part; a group has at most as many as there are parts
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(*keys, "_part", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    return (ranged.withColumn("_n", F.row_number().over(inside)).join(offsets.filter("_before > 0"), ["_part", *keys], "left")
            .withColumn(name, F.col("_n") + F.coalesce("_before", F.lit(0))).select(*rows.columns, name))
