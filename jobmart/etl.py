"""One batch end to end (the original's full run, 3.1): setup -> parse -> transform
-> idempotent load -> views.

    from jobmart.etl import run_batch
    stats = run_batch(spark, store_root, raw=spark.read.parquet("s3://.../postings/"))
    spark.sql("SELECT * FROM skill_demand_view").show()

Scraping over HTTP is not part of it: pages arrive as a table (``pages=``, with a
``platform`` column) or postings as files (``raw=``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .operators.load import StarStore
from .operators.transform import observed_transform
from .plans.views import register_views
from .sources.html import parse_detail_pages


class RunStats(NamedTuple):
    transform: dict      # A07: total_jobs, transformed_jobs, errors
    load: dict           # A09 for this batch


def run_batch(spark: SparkSession, store_root: str, raw: DataFrame | None = None,
              pages: DataFrame | None = None, register: bool = True, digits: int = 1,
              **transform_opts) -> RunStats:
    """Load one batch of raw postings (or detail pages) into the star store at
    ``store_root`` and (re)register the tables and views for SQL.  Safe to
    re-run: rows whose keys are loaded already are skipped."""
    if (raw is None) == (pages is None):
        raise ValueError("pass exactly one of raw= or pages=")
    postings = raw if raw is not None else parse_detail_pages(pages)
    store = StarStore(spark, store_root, digits)
    store.setup()
    rows, seen = observed_transform(postings, **transform_opts)
    l_stats = store.append(rows).first().asDict()              # one row
    t_stats = dict(seen.get)                                   # counted while the rows were staged
    if register:
        register_views(spark, store.tables())
    return RunStats(t_stats, l_stats)
