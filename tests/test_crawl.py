"""Crawl operators against a brute-force replay of the crawl loop."""

import random

import pytest

from jobmart.operators import crawl as C

FRONTIER = "crawl long, platform string, page long, pos long, url string, page_empty boolean, detail_failed boolean"


def replay(rows, max_pages, max_results):
    """The loop, walk by walk: pages in order, stop at the first empty or missing one
    (visited), skip seen URLs, count pages that fail, stop at max_results postings."""
    out = {}
    for walk in sorted({r[:2] for r in rows}):
        pages = {}
        for c, p, page, pos, url, empty, failed in rows:
            if (c, p) == walk and not empty:
                pages.setdefault(page, []).append((pos, url, failed))
        jobs, seen, visited, dups, errors, page, stopped = [], set(), 0, 0, 0, 1, None
        while (max_pages is None or page <= max_pages) and (max_results is None or len(jobs) < max_results):
            visited += 1
            if page not in pages:
                stopped = page
                break
            for _, url, failed in sorted(pages[page]):
                if max_results is not None and len(jobs) >= max_results:
                    break
                if url in seen:
                    dups += 1
                    continue
                seen.add(url)
                if failed:
                    errors += 1
                else:
                    jobs.append(url)
            page += 1
        out[walk] = (visited, jobs, dups, errors, "failed" if stopped == 1 else "success")
    return out


@pytest.fixture(scope="module")
def frontier(spark):
    rnd, rows, pos = random.Random(7), [], 0
    walks = [(0, "careerviet", 9, 5), (0, "topcv", 4, None), (0, "vieclam24h", 12, 1), (1, "topcv", 3, 2), (1, "linkboard", 6, None)]
    bad = {f"u{i}" for i in range(0, 26, 5)}
    for crawl, platform, npages, empty_at in walks:
        for page in range(1, npages + 1):
            for _ in range(rnd.randint(3, 8)):
                url = f"u{rnd.randint(0, 25)}"
                rows.append((crawl, platform, page, pos, url, page == empty_at, url in bad))
                pos += 1
    rows = [r for r in rows if not (r[1] == "topcv" and r[0] == 0 and r[2] == 3)]      # a missing page
    return rows, spark.createDataFrame(rows, FRONTIER).cache()


@pytest.mark.parametrize("max_pages,max_results", [(None, None), (10, 7), (2, 500), (10, 1), (None, 4)])
def test_crawl_matches_replay(frontier, max_pages, max_results):
    rows, fr = frontier
    want = replay(rows, max_pages, max_results)
    stats = {(r.crawl, r.platform): r for r in C.crawl_stats(fr, max_results, max_pages).collect()}
    capped = sorted(C.crawl_cap(fr, max_results, max_pages).collect(), key=lambda r: r["rank"])
    assert set(stats) == set(want)
    for walk, (visited, jobs, dups, errors, status) in want.items():
        assert [r.url for r in capped if (r.crawl, r.platform) == walk] == jobs, walk
        s = stats[walk]
        assert (s.pages_visited, s.jobs_scraped, s.duplicates_skipped, s.errors, s.status) == (
            visited, len(jobs), dups, errors, status), walk


def test_user_platforms_survive_and_silent_ones_fail(frontier):
    _, fr = frontier
    assert C.crawl_dedupe(fr, None).filter("platform = 'linkboard'").count() > 0
    got = {(r.crawl, r.platform): r for r in C.crawl_stats(fr, None, None, ["linkboard", "quiet"]).collect()}
    assert set(got) == {(0, "linkboard"), (0, "quiet"), (1, "linkboard"), (1, "quiet")}
    assert (got[0, "quiet"].status, got[0, "quiet"].errors, got[0, "quiet"].jobs_scraped) == ("failed", 1, 0)
    assert got[1, "linkboard"].status == "success"


def test_frontier_without_crawls_or_failures(frontier):
    rows, fr = frontier
    one = fr.filter("crawl = 0").drop("crawl", "detail_failed")
    want = replay([(0, *r[1:6], False) for r in rows if r[0] == 0], None, None)
    got = {r.platform: r.jobs_scraped for r in C.crawl_stats(one, None, None).collect()}
    assert got == {p: len(w[1]) for (_, p), w in want.items()}


def test_platform_selection_and_union(spark, frontier):
    _, fr = frontier
    with pytest.warns(UserWarning):
        kept = C.select_platforms(fr, ["topcv", "nosuch"], ["topcv", "careerviet"])
    assert {r.platform for r in kept.select("platform").distinct().collect()} == {"topcv"}
    a = spark.createDataFrame([("u1", 1)], "url string, extra int")
    b = spark.createDataFrame([("u2",)], "url string")
    got = C.platform_union({"x": a, "y": b}).orderBy("platform_rank").collect()
    assert [(r.platform, r.platform_rank, r.url, r.extra) for r in got] == [("x", 1, "u1", 1), ("y", 2, "u2", None)]


def test_listing_urls_of_a_user_platform(spark):
    pages = spark.createDataFrame([("board", 1), ("board", 3), ("topcv", 1)], "platform string, page long")
    schemes = {"board": ("https://b.invalid/{query}", "https://b.invalid/{query}/{page}")}
    got = {(r.platform, r.page): r.list_url for r in C.listing_urls(pages, "a b", schemes).collect()}
    assert got["board", 1] == "https://b.invalid/a+b" and got["board", 3] == "https://b.invalid/a+b/3"
    assert got["topcv", 1].startswith("https://www.topcv.vn/")
