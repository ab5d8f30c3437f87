"""Platform pages rendered from the given tables, to run the page parsers at scale.

The ``pages`` test table holds generic pages only, so detail pages (S05) and
listing pages (S04) in each platform's markup are built natively from the
derived postings and the derived crawl frontier; parsing them back must give the
fields and links they were built from.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# the platforms' markup, spelled out here on its own: the parsers' selectors are not used
_DETAIL = {
    "careerviet": '<h1 class="title">{job_title}</h1><div class="detail-box has-background"><span class="date">{posting_date}</span></div>'
                  '<h3 class="company-name">{company}</h3><span class="job-location">{location}</span>'
                  '<section class="job-detail-content">{job_description}</section>',
    "topcv": '<h1 class="job-detail__info--title">{job_title}</h1><a class="company-name">{company}</a><span class="address">{location}</span>'
             '<div class="job-detail__information-detail">{job_description}</div>',
    "vieclam24h": '<div class="text-24 font-bold leading-10 text-se-neutral-84 !font-medium">{job_title}</div>'
                  '<div class="text-14 font-normal leading-6 text-se-neutral-84 line-clamp-2 break-words">{posting_date}</div>'
                  '<div class="flex flex-col gap-8 w-full sm_cv:gap-6">{job_description}</div>',
}
_ITEM = {
    "careerviet": '<div class="job-item"><a href="/logo">logo</a><a href="/job/u{user}.html">job</a></div>',
    "topcv": '<div class="job-item-search-result"><h3 class="title"><a href="https://www.topcv.vn/viec-lam/u{user}.html">job</a></h3></div>'
             '<div class="job-item-search-result"><h3 class="title"><a href="https://www.topcv.vn/brand/ad">ad</a></h3></div>',
    "vieclam24h": '<a target="_blank" href="/viec-lam/u{user}">job</a><a href="/nav">nav</a>',
}


def _fill(template: str) -> Column:
    """The template with ``{column}`` replaced by the column's text (NULL: empty)."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(F.col(p).cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def _by_platform(templates: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for platform, template in templates.items():
        out = F.when(F.col("platform") == platform, _fill(template)).otherwise(out)
    return out


def detail_pages(raw: DataFrame) -> DataFrame:
    """One detail page per raw posting, in its platform's markup:
    (page_id, url, html, platform)."""
    html = F.concat(F.lit("<html><body>"), _by_platform(_DETAIL),
                    F.lit("<script>var x = '<p>not text</p>';</script><!-- footer --></body></html>"))
    return raw.select(F.col("ingest_seq").alias("page_id"), F.col("job_url").alias("url"), html.alias("html"), "platform")


def listing_pages(frontier_events: DataFrame) -> DataFrame:
    """One listing page per non-empty (crawl, platform, page) of a frontier carrying
    ``user``: (page_id, crawl, platform, page, html)."""
    items = frontier_events.filter(~F.col("page_empty")).select(
        "crawl", "platform", "page", "pos", _by_platform(_ITEM).alias("item"))
    # a page of a derived crawl holds EVENTS_PER_PAGE links at most
    pages = (items.groupBy("crawl", "platform", "page")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("items")))
    html = F.concat(F.lit("<html><body><nav><a href='/'>home</a></nav>"),
                    F.array_join(F.transform("items", lambda x: x["item"]), ""),
                    F.lit("</body></html>"))
    walk = F.col("crawl") * 4 + F.array_position(F.array(*[F.lit(p) for p in _ITEM]), F.col("platform"))
    return pages.select((walk * 1000 + F.col("page")).alias("page_id"), "crawl", "platform", "page", html.alias("html"))
