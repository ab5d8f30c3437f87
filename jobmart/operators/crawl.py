"""Crawl-frontier operators.

The original crawler walks listing pages in order per platform: it stops at the
first page that fails or holds no links (that page still counts as visited),
skips URLs it has seen, and stops after ``max_results`` postings.  Here a
frontier table -- one row per ([crawl,] platform, page, pos, url) -- replaces the
loop.  Columns ``crawl`` and ``detail_failed`` are optional.  Every platform of the
frontier is kept, the built-in ones and users' own; caps are arguments, and None
means no cap.

* the stop page is an aggregate and an anti-join over pages, not a window over a
  platform's links;
* the first sighting of a URL and the first N postings are ``row_number() <= N``,
  which Spark runs as a partial top-N (``WindowGroupLimit``) before the shuffle, so
  a platform or URL that holds a third of all rows sends N rows per map task;
* links meet per-walk values page by page, so no join deals out links by platform.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions.text import quote_path20, quote_plus
from .rank import distributed_rank


def _walk(frontier: DataFrame) -> list[str]:
    """The columns that tell one walk from another."""
    return [c for c in ("crawl", "platform") if c in frontier.columns]


def _failed(frontier: DataFrame) -> Column:
    return F.coalesce(F.col("detail_failed"), F.lit(False)) if "detail_failed" in frontier.columns else F.lit(False)


def select_platforms(frontier: DataFrame, enabled: list[str] | None = None,
                     known: list[str] | None = None) -> DataFrame:
    """None or [] means all; names outside ``known`` (default: whatever the frontier
    holds) are ignored with a warning."""
    if not enabled:
        return frontier if known is None else frontier.filter(F.col("platform").isin(known))
    unknown = [] if known is None else [p for p in enabled if p not in known]
    if unknown:
        import warnings
        warnings.warn(f"unknown platforms ignored: {unknown}; available: {known}")
    return frontier.filter(F.col("platform").isin([p for p in enabled if p not in unknown]))


def _pages(frontier: DataFrame) -> DataFrame:
    """The pages that hold links, one row each."""
    return frontier.filter(~F.col("page_empty")).select(*_walk(frontier), "page").distinct()


def _on_pages(rows: DataFrame, frontier: DataFrame, per_walk: DataFrame) -> DataFrame:
    """``rows`` with the columns of their walk's row in ``per_walk``.

    Links meet them page by page: a platform may hold a third of all links, a page does not."""
    keys = _walk(frontier)
    return rows.join(_pages(frontier).join(per_walk, keys), [*keys, "page"])


def stop_pages(frontier: DataFrame, max_pages: int | None) -> DataFrame:
    """Per walk the first page, from 1, that holds no links or is missing (a failed
    fetch); ``max_pages + 1`` when the page budget ends first."""
    keys = _walk(frontier)
    full = _pages(frontier)
    # the page after every page with links, and page 1: those without links are stops
    after = full.select(*keys, (F.col("page") + 1).alias("page"))
    first = frontier.select(*keys).distinct().select(*keys, F.lit(1).cast("long").alias("page"))
    stops = (after.filter("page > 1").unionByName(first).join(full, [*keys, "page"], "left_anti")
             .groupBy(*keys).agg(F.min("page").alias("stop_page")))
    if max_pages is None:
        return stops
    return stops.withColumn("stop_page", F.least(F.col("stop_page"), F.lit(max_pages + 1).cast("long")))


def crawl_prefix(frontier: DataFrame, max_pages: int | None) -> DataFrame:
    """Links on the pages walked before the stop page."""
    return (_on_pages(frontier.filter(~F.col("page_empty")), frontier, stop_pages(frontier, max_pages))
            .filter(F.col("page") < F.col("stop_page"))
            .drop("stop_page", "page_empty"))


def crawl_pages(frontier: DataFrame, max_pages: int | None) -> DataFrame:
    """Pages fetched before the cap is considered: 1 .. min(stop, max_pages), with
    a flag on the page that ended the walk."""
    stops = stop_pages(frontier, max_pages)
    top = F.col("stop_page") if max_pages is None else F.least(F.col("stop_page"), F.lit(max_pages).cast("long"))
    return (stops.select(*_walk(frontier), "stop_page", F.explode(F.sequence(F.lit(1).cast("long"), top)).alias("page"))
            .withColumn("is_stop", F.col("page") == F.col("stop_page")).drop("stop_page"))


def crawl_dedupe(frontier: DataFrame, max_pages: int | None) -> DataFrame:
    """First sighting of each URL per walk, in crawl order; ``failed`` tells whether
    its detail page could not be read."""
    keys = _walk(frontier)
    prefix = crawl_prefix(frontier, max_pages)
    w = Window.partitionBy(*keys, "url").orderBy("page", "pos")
    return (prefix.select(*keys, "url", "page", "pos", _failed(prefix).alias("failed"))
            .withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n"))


def crawl_cap(frontier: DataFrame, max_results: int | None, max_pages: int | None) -> DataFrame:
    """The first ``max_results`` URLs per walk whose detail page was read.

    With a cap, map tasks send that many rows of a walk at most; without one, no task holds a walk."""
    read = crawl_dedupe(frontier, max_pages).filter(~F.col("failed")).drop("failed")
    if max_results is None:
        return distributed_rank(read, _walk(frontier), ["page", "pos"]).withColumn("rank", F.col("rank").cast("int"))
    w = Window.partitionBy(*_walk(frontier)).orderBy("page", "pos")
    return read.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max_results)


def platform_union(tables: dict[str, DataFrame]) -> DataFrame:
    """The postings of several platforms' own tables, one after the other in the
    order of ``tables``; a table may have columns that others lack."""
    if not tables:
        raise ValueError("no platform tables")
    named = [t.withColumn("platform", F.lit(p)).withColumn("platform_rank", F.lit(i))
             for i, (p, t) in enumerate(tables.items(), 1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def crawl_stats(frontier: DataFrame, max_results: int | None, max_pages: int | None,
                platforms: list[str] | None = None) -> DataFrame:
    """A08 per walk: pages visited, postings, duplicates skipped, errors, status.

    The walk ends after the page where the cap was reached, else at the stop
    page (counted), else after ``max_pages``.  Duplicates and errors (detail pages that could
    not be read) are counted up to where the walk ended.  A walk is ``failed`` when its
    first listing page held nothing; enabled ``platforms`` without any row are failed walks
    with one error, as is a scraper that raises."""
    keys = _walk(frontier)
    stops = stop_pages(frontier, max_pages)
    prefix = crawl_prefix(frontier, max_pages)
    firsts = crawl_dedupe(frontier, max_pages)
    place = F.struct(F.col("page").cast("long").alias("page"), F.col("pos").cast("long").alias("pos"))
    if max_results is None:
        cut = stops.select(*keys, F.lit(None).cast("struct<page:bigint,pos:bigint>").alias("last"))
    else:
        w = Window.partitionBy(*keys).orderBy("page", "pos")
        cut = (firsts.filter(~F.col("failed")).withColumn("rank", F.row_number().over(w))
               .filter(F.col("rank") <= max_results).filter(F.col("rank") == max_results)
               .select(*keys, place.alias("last")))
    base = stops.join(cut, keys, "left")
    inside = F.col("last").isNull() | (place <= F.col("last"))
    ends = base.select(*keys, "last")
    seen = (_on_pages(prefix, frontier, ends).filter(inside).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_seen")))
    got = (_on_pages(firsts, frontier, ends).filter(inside).groupBy(*keys)
           .agg(F.count(F.when(~F.col("failed"), 1)).alias("jobs"), F.count(F.when(F.col("failed"), 1)).alias("bad")))
    zero = F.lit(0).cast("long")
    jobs, bad = F.coalesce("jobs", zero), F.coalesce("bad", zero)
    walked = F.col("stop_page") if max_pages is None else F.least(F.col("stop_page"), F.lit(max_pages).cast("long"))
    out = (base.join(seen, keys, "left").join(got, keys, "left")
           .select(*keys, F.coalesce(F.col("last.page"), walked).cast("long").alias("pages_visited"),
                   jobs.alias("jobs_scraped"), (F.coalesce("rows_seen", zero) - jobs - bad).alias("duplicates_skipped"),
                   bad.alias("errors"), F.when(F.col("stop_page") == 1, "failed").otherwise("success").alias("status")))
    if not platforms:
        return out
    # a row for each platform asked for
    asked = F.explode(F.array(*[F.lit(p) for p in platforms])).alias("platform")
    if "crawl" in keys:
        wanted = frontier.select("crawl").distinct().select("crawl", asked)
    else:
        wanted = frontier.sparkSession.range(1).select(asked)
    silent = wanted.join(out, keys, "left_anti").select(
        *keys, zero.alias("pages_visited"), zero.alias("jobs_scraped"), zero.alias("duplicates_skipped"),
        F.lit(1).cast("long").alias("errors"), F.lit("failed").alias("status"))
    return out.filter(F.col("platform").isin(platforms)).unionByName(silent)


def listing_urls(pages: DataFrame, query: str, schemes: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """The listing-page URL of every (platform, page) row.  ``schemes`` (U02): user
    platforms' URLs of page 1 and of later pages, with ``{query}`` (form-encoded) and ``{page}``."""
    q = F.lit(query)
    page_s = F.col("page").cast("string")
    base = D.LIST_URL_BASE
    cv = F.when(F.col("page") == 1, F.concat(F.lit(base["careerviet"] + "/"), quote_plus(q), F.lit("-k-vi.html"))) \
          .otherwise(F.concat(F.lit(base["careerviet"] + "/"), quote_plus(q), F.lit("-k-trang-"), page_s,
                              F.lit("-vi.html")))
    tc = F.when(F.col("page") == 1, F.concat(F.lit(base["topcv"] + "-"), quote_plus(q))) \
          .otherwise(F.concat(F.lit(base["topcv"] + "-"), quote_plus(q), F.lit("?page="), page_s))
    vl = F.when(F.col("page") == 1, F.concat(F.lit(base["vieclam24h"] + "q="), quote_path20(q))) \
          .otherwise(F.concat(F.lit(base["vieclam24h"] + "page="), page_s, F.lit("&q="), quote_path20(q)))
    url: Column = (F.when(F.col("platform") == "careerviet", cv)
                   .when(F.col("platform") == "topcv", tc)
                   .when(F.col("platform") == "vieclam24h", vl))
    for name, (one, later) in (schemes or {}).items():
        text = F.when(F.col("page") == 1, F.lit(one)).otherwise(F.lit(later))
        text = F.replace(F.replace(text, F.lit("{query}"), quote_plus(q)), F.lit("{page}"), page_s)
        url = F.when(F.col("platform") == name, text).otherwise(url)
    return pages.select(*[c for c in ["crawl"] if c in pages.columns], "platform", "page", url.alias("list_url"))


def crawl_summary(frontier: DataFrame, max_results: int | None, max_pages: int | None,
                  platforms: list[str] | None = None) -> DataFrame:
    """A08 total: walks, and their pages, postings, duplicates and errors summed (one
    row; durations are not data)."""
    s = crawl_stats(frontier, max_results, max_pages, platforms)
    return s.agg(F.count(F.lit(1)).alias("walks"),
                 F.sum("pages_visited").alias("pages_visited"),
                 F.sum("jobs_scraped").alias("jobs_scraped"),
                 F.sum("duplicates_skipped").alias("duplicates_skipped"),
                 F.sum("errors").alias("errors"),
                 F.count(F.when(F.col("status") == "success", 1)).alias("succeeded"))
