"""Crawl frontiers derived from the given ``events`` table (FIXTURES.md §4).

One row per link seen on a listing page: (crawl, platform, page, pos, url, page_empty,
detail_failed).  Every ``EVENTS_PER_CRAWL`` events are one crawl, so pages per crawl are
bounded and the number of crawls grows with the table.  Crawl order is (platform, page,
pos).  Users' own frontiers (listing links parsed from ``pages``) have the same shape,
with or without ``crawl`` and ``detail_failed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from .tables import table

# FIXED VALUES of the derived frontier
EVENTS_PER_CRAWL = 1000
EVENTS_PER_PAGE = 50
EMPTY_PAGE_MOD, EMPTY_PAGE_REM = 23, 22
FRONTIER_CAP = 20


def derived_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    platform = F.element_at(F.array(*[F.lit(p) for p in D.PLATFORMS]),
                            (F.col("event_id") % len(D.PLATFORMS) + 1).cast("int"))
    crawl = F.floor(F.col("event_id") / EVENTS_PER_CRAWL).cast("long")
    page = F.floor((F.col("event_id") % EVENTS_PER_CRAWL) / EVENTS_PER_PAGE).cast("long") + 1
    return e.select(
        crawl.alias("crawl"),
        platform.alias("platform"),
        page.alias("page"),
        F.col("event_id").alias("pos"),
        F.concat(F.lit("https://"), platform, F.lit(".example/job/u"),
                 F.col("user_id").cast("string")).alias("url"),
        ((page + crawl) % EMPTY_PAGE_MOD == EMPTY_PAGE_REM).alias("page_empty"),
        (F.col("event_type") == "error").alias("detail_failed"),
        F.col("user_id").alias("user"),
    )
