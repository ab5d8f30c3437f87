"""Raw postings from files (S01), by the declared schema.

Reading is permissive: a line that is no JSON, or whose values do not fit the schema, is a row
with its text in ``_corrupt_record``; the transform rejects it and A07 counts it.  Parquet files have their own
schema; columns they lack are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import CORRUPT, RAW_POSTING

TEXT_FORMATS = ("json", "csv")


def permissive(reader, fmt: str, schema: T.StructType = RAW_POSTING):
    """A batch or stream reader of ``fmt`` with the declared schema; text formats keep what does not fit it."""
    if fmt not in TEXT_FORMATS:
        return reader.format(fmt).schema(schema)
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.format(fmt).schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_raw(spark: SparkSession, path: str | list[str], fmt: str = "json", schema: T.StructType = RAW_POSTING, **options) -> DataFrame:
    """Raw postings of the files at ``path``; ``options`` go to Spark's reader."""
    return permissive(spark.read, fmt, schema).options(**options).load(path)
