"""Data-quality operators (P08, F12/F17 lookups, F16 keyword map).

Lookup tables here are built from the fixed dictionaries, so their size is known
on the driver (tens of rows); they are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions.enrich import canonical_location, keyword_table


def salary_ranges(spark: SparkSession, ranges: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    rows = [(lvl, int(lo), int(hi)) for lvl, (lo, hi) in (ranges or D.SENIORITY_SALARY_RANGES).items()]
    return spark.createDataFrame(rows, "seniority_level string, range_min long, range_max long")


def salary_range_check(processed: DataFrame,
                       ranges: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Compare each posting's salary with its level's expected range.

    ``salary_status``: 'below' (max under the range), 'above' (min over it),
    'within' (overlaps it), 'unknown' (no level, no salary, or unknown level).
    """
    table = salary_ranges(processed.sparkSession, ranges)   # one row per level: broadcast
    j = processed.join(F.broadcast(table), "seniority_level", "left")
    status = (F.when(F.col("range_min").isNull() | F.col("salary_min").isNull()
                     | F.col("salary_max").isNull(), F.lit("unknown"))
              .when(F.col("salary_max") < F.col("range_min"), F.lit("below"))
              .when(F.col("salary_min") > F.col("range_max"), F.lit("above"))
              .otherwise(F.lit("within")))
    return j.select("*", status.alias("salary_status"))


def canonical_locations_of(df: DataFrame, column: str = "location") -> DataFrame:
    """F12 over a column: (input, canonical)."""
    return df.select("*", canonical_location(F.col(column)).alias("canonical_location"))


def keyword_skill_map(spark: SparkSession, dictionary: dict | None = None) -> DataFrame:
    """F16: keyword -> skill, a later category overwriting an earlier one."""
    return keyword_table(spark, dictionary)
