"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB twins.

Every query reads the given tables (or what Spark derives from them) in full.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.vectors import norm
from .. import dictionaries as D
from ..operators import load as L
from ..operators.transform import essential_ok, transform_postings, transform_stats
from ..sources.postings import derived_postings
from ..sources.tables import table
from . import oracle as O
from . import views as V

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared building blocks ---------------------------------------------------
def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_postings(derived_postings(spark, sf_dir))


def loaded_star(spark: SparkSession, sf_dir: str, staged: tuple[str, ...] = (), jobs: bool = True) -> L.StarTables:
    """Derived postings loaded as two batches (batch 0, then batch 1) into empty
    tables: one first-wins pass in (batch, ingest_seq) order.

    Lazy by default: column pruning reaches the enrichment, and a report that reads
    one table computes only the columns it needs.  ``staged`` ("firsts", "skills") writes
    what a report reads more than once.  The anti-joins against existing tables are run by ``load_incremental_*``."""
    return L.load_ordered(derived_postings(spark, sf_dir), ["batch", "ingest_seq"], staged, jobs)


def incremental_star(spark: SparkSession, sf_dir: str) -> L.StarTables:
    return incremental_store(spark, sf_dir).tables()


def incremental_store(spark: SparkSession, sf_dir: str) -> L.StarStore:
    """The same two batches through the persistent store: batch 1 meets the tables that
    batch 0 left (J03, J05, X03)."""
    import uuid

    from ..session import ensure_checkpoint_dir
    store = L.StarStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobmart-star-{uuid.uuid4().hex}")
    store.setup()
    raw = derived_postings(spark, sf_dir)
    for b in (0, 1):
        store.append(transform_postings(raw.filter(F.col("batch") == b)))
    return store


# --- transform ---------------------------------------------------------------
@register("extract_skills", O.with_tx(
    "SELECT ingest_seq, CAST(pos - 1 AS INTEGER) AS skill_pos, skill_name, skill_category FROM tx_skills"))
def q_extract_skills(spark, sf_dir):
    return (processed(spark, sf_dir)
            .select("ingest_seq", F.posexplode_outer("extracted_skills").alias("skill_pos", "s"))
            .filter(F.col("s").isNotNull())
            .select("ingest_seq", "skill_pos", "s.skill_name", "s.skill_category"))


@register("extract_skills_by_table", ORACLE["extract_skills"])
def q_extract_skills_by_table(spark, sf_dir):
    """The same skills with the dictionary as a table."""
    from ..operators.skills import extract_skills_by_table
    entries = [(o, n, k, kw) for o, n, k, kws in D.skill_entries() for kw in kws]
    table_ = spark.createDataFrame(entries, "entry_order int, skill_name string, skill_category string, keyword string")
    raw = derived_postings(spark, sf_dir)
    return extract_skills_by_table(raw.filter(essential_ok(raw)), table_)


@register("detect_seniority", O.with_tx("SELECT ingest_seq, seniority_level FROM tx"))
def q_detect_seniority(spark, sf_dir):
    return processed(spark, sf_dir).select("ingest_seq", "seniority_level")


@register("extract_salary", O.with_tx(
    "SELECT ingest_seq, salary_min, salary_max, salary_currency, salary_overflow FROM tx"))
def q_extract_salary(spark, sf_dir):
    return processed(spark, sf_dir).select("ingest_seq", "salary_min", "salary_max",
                                           "salary_currency", "salary_overflow")


@register("extract_labels", O.with_tx(
    "SELECT ingest_seq, company_name, location, posted_date FROM tx"))
def q_extract_labels(spark, sf_dir):
    return processed(spark, sf_dir).select("ingest_seq", "company_name", "location", "posted_date")


_TX_COLS = ["ingest_seq", "platform", "job_url", "job_title", "company_name", "location",
            "posted_date", "scraped_at", "seniority_level", "salary_min", "salary_max",
            "salary_currency", "raw_description", "clean_description"]


@register("transform_postings", O.with_tx(
    f"SELECT {', '.join(_TX_COLS)}, "
    "array_to_string(list_transform(extracted_skills, lambda s: s.skill_name), ',') AS skill_names FROM tx"))
def q_transform_postings(spark, sf_dir):
    return processed(spark, sf_dir).select(
        *_TX_COLS,
        F.array_join(F.transform("extracted_skills", lambda s: s["skill_name"]), ",").alias("skill_names"))


@register("transform_stats", f"""WITH raw AS ({O.derived_postings_sql()})
SELECT count(*) AS total_jobs,
  count(*) FILTER (WHERE {' AND '.join(f'coalesce(length({c}), 0) > 0' for c in ['job_title', 'job_description', 'platform', 'job_url'])}) AS transformed_jobs,
  count(*) FILTER (WHERE NOT ({' AND '.join(f'coalesce(length({c}), 0) > 0' for c in ['job_title', 'job_description', 'platform', 'job_url'])})) AS errors
FROM raw""")
def q_transform_stats(spark, sf_dir):
    return transform_stats(derived_postings(spark, sf_dir))


@register("clean_description",
          f"SELECT doc_id, {O.clean_description('text')} AS clean_description FROM documents")
def q_clean_description(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.clean_description(F.col("text")).alias("clean_description"))


@register("normalize_text", f"SELECT doc_id, {O.normalize_text('text')} AS normalized FROM documents")
def q_normalize_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.normalize_text(F.col("text")).alias("normalized"))


@register("clean_html", f"SELECT page_id, {O.clean_html('html')} AS text FROM pages")
def q_clean_html(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    return p.select("page_id", TX.clean_html(F.col("html")).alias("text"))


@register("truncate_text", f"SELECT doc_id, {O.truncate_text('text')} AS truncated FROM documents")
def q_truncate_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.truncate_text(F.col("text")).alias("truncated"))


# --- load --------------------------------------------------------------------
_JOB_OUT = ["platform", "job_url", "job_title", "company_name", "location", "posted_date",
            "scraped_at", "seniority_level", "salary_min", "salary_max", "salary_currency"]


@register("load_jobs", O.with_star(f"SELECT {', '.join(_JOB_OUT)} FROM s_jobs"))
def q_load_jobs(spark, sf_dir):
    return loaded_star(spark, sf_dir).jobs.select(*_JOB_OUT)


@register("load_descriptions", O.with_star(
    "SELECT job_url, raw_description, clean_description FROM s_desc"))
def q_load_descriptions(spark, sf_dir):
    firsts = L.first_postings(derived_postings(spark, sf_dir))
    return firsts.select("job_url", "raw_description", "clean_description")


def _descriptions(star):
    return (star.job_descriptions.join(star.jobs.select("job_id", "job_url"), "job_id")
            .select("job_url", "raw_description", "clean_description"))


@register("load_skills", O.with_star("SELECT skill_name, skill_category FROM s_skills"))
def q_load_skills(spark, sf_dir):
    return loaded_star(spark, sf_dir, jobs=False).skills.select("skill_name", "skill_category")


@register("load_job_skills", O.with_star("SELECT job_url, skill_name FROM s_links"))
def q_load_job_skills(spark, sf_dir):
    return _links(loaded_star(spark, sf_dir, ("skills",)))


def _links(star):
    return (star.job_skills.join(star.jobs.select("job_id", "job_url"), "job_id")
            .join(star.skills.select("skill_id", "skill_name"), "skill_id")
            .select("job_url", "skill_name"))


# the same tables, batch by batch through the persistent store
@register("load_incremental_jobs", ORACLE["load_jobs"])
def q_incremental_jobs(spark, sf_dir):
    return incremental_star(spark, sf_dir).jobs.select(*_JOB_OUT)


@register("load_incremental_descriptions", ORACLE["load_descriptions"])
def q_incremental_descriptions(spark, sf_dir):
    return _descriptions(incremental_star(spark, sf_dir))


@register("load_incremental_skills", ORACLE["load_skills"])
def q_incremental_skills(spark, sf_dir):
    return incremental_star(spark, sf_dir).skills.select("skill_name", "skill_category")


@register("load_incremental_links", ORACLE["load_job_skills"])
def q_incremental_links(spark, sf_dir):
    return _links(incremental_star(spark, sf_dir))


@register("load_stats", O.with_star("""
SELECT p.batch,
  (SELECT count(*) FROM tx WHERE tx.batch = p.batch) AS jobs_inserted,
  (SELECT count(*) FROM tx WHERE tx.batch = p.batch) AS job_descriptions_inserted,
  (SELECT count(*) FROM (SELECT skill_name, min(batch) AS b FROM tx_skills GROUP BY skill_name) f
     WHERE f.b = p.batch) AS skills_inserted,
  (SELECT count(*) FROM tx_skills WHERE tx_skills.batch = p.batch) AS job_skills_linked,
  (SELECT count(*) FROM (SELECT job_url, min(batch) AS b FROM tx GROUP BY job_url) f
     WHERE f.b = p.batch) AS jobs_new,
  (SELECT count(*) FROM (SELECT job_url, skill_name, min(batch) AS b FROM tx_skills
                         GROUP BY job_url, skill_name) f WHERE f.b = p.batch) AS job_skills_new,
  CAST(0 AS BIGINT) AS errors
FROM (SELECT DISTINCT batch FROM tx) p"""))
def q_load_stats(spark, sf_dir):
    return L.load_stats_by_batch(derived_postings(spark, sf_dir), "batch")


@register("orphans", O.with_star("""
, jobs_left AS (SELECT * FROM s_jobs WHERE platform <> 'topcv'),
skills_left AS (SELECT * FROM s_skills WHERE skill_name <> 'SQL')
SELECT 'job_skills.job_id' AS relation, count(*) AS orphans FROM s_links l
  WHERE NOT EXISTS (SELECT 1 FROM jobs_left j WHERE j.job_url = l.job_url)
UNION ALL
SELECT 'job_skills.skill_id', count(*) FROM s_links l
  WHERE NOT EXISTS (SELECT 1 FROM skills_left s WHERE s.skill_name = l.skill_name)
UNION ALL
SELECT 'job_descriptions.job_id', count(*) FROM s_desc d
  WHERE NOT EXISTS (SELECT 1 FROM jobs_left j WHERE j.job_url = d.job_url)"""))
def q_orphans(spark, sf_dir):
    """J06 on tables that lost parents: the jobs of one platform and one skill."""
    star = loaded_star(spark, sf_dir, ("skills",))
    return L.orphans(star._replace(jobs=star.jobs.filter("platform <> 'topcv'"),
                                   skills=star.skills.filter("skill_name <> 'SQL'")))


# --- views ---------------------------------------------------------------------
@register("skill_demand", O.with_star("""
SELECT s.skill_name, s.skill_category, count(*) AS job_count,
       CAST(count(*) AS DOUBLE) * 100 / (SELECT count(DISTINCT job_url) FROM s_links) AS percentage_of_jobs
FROM s_links l JOIN s_skills s ON l.skill_name = s.skill_name
GROUP BY s.skill_name, s.skill_category"""))
def q_skill_demand(spark, sf_dir):
    return V.skill_demand(loaded_star(spark, sf_dir, ("skills",), jobs=False))


_DETAIL_OUT = _JOB_OUT + ["clean_description", "raw_description"]


@register("job_details", O.with_star(
    f"SELECT {', '.join('j.' + c for c in _JOB_OUT)}, d.clean_description, d.raw_description "
    "FROM s_jobs j JOIN s_desc d ON j.job_url = d.job_url"))
def q_job_details(spark, sf_dir):
    """View 1 over a load's own postings: both tables' columns are in one row, nothing is joined."""
    return V.details_of(L.first_postings(derived_postings(spark, sf_dir))).select(*_DETAIL_OUT)


@register("job_details_stored", ORACLE["job_details"])
def q_job_details_stored(spark, sf_dir):
    """View 1 over the stored tables."""
    return V.job_details(incremental_star(spark, sf_dir)).select(*_DETAIL_OUT)


def _jobs_of(spark, sf_dir, columns):
    """The star with the columns of ``jobs`` that a report reads, staged: a report's filters
    on computed columns would be pushed into the enrichment and compute it once more for
    every condition."""
    from ..session import materialize
    star = loaded_star(spark, sf_dir)
    return star._replace(jobs=materialize(star.jobs.select(*columns), "jobs"))


@register("salary_by_seniority_location", O.with_star("""
SELECT seniority_level, location, avg(CAST(salary_min AS DOUBLE)) AS avg_salary_min,
       avg(salary_max) AS avg_salary_max, salary_currency, count(*) AS job_count
FROM s_jobs
WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL AND seniority_level IS NOT NULL AND location IS NOT NULL
GROUP BY seniority_level, location, salary_currency"""))
def q_salary_view(spark, sf_dir):
    return V.salary_by_seniority_location(_jobs_of(
        spark, sf_dir, ["job_id", "seniority_level", "location", "salary_min", "salary_max", "salary_currency"]))


@register("platform_job_count", O.with_star(
    "SELECT platform, count(*) AS total_jobs FROM s_jobs GROUP BY platform"))
def q_platform_job_count(spark, sf_dir):
    return V.platform_job_count(loaded_star(spark, sf_dir))


@register("postings_over_time", O.with_star(
    "SELECT CAST(posted_date AS DATE) AS date, count(*) AS daily_job_count FROM s_jobs "
    "WHERE posted_date IS NOT NULL GROUP BY CAST(posted_date AS DATE)"))
def q_postings_over_time(spark, sf_dir):
    return V.postings_over_time(_jobs_of(spark, sf_dir, ["job_id", "posted_date", "posted_date_text"]))


_LABEL = " Ngày cập nhật: "


@register("postings_over_time_undated", O.with_star("SELECT CAST(posted_date AS DATE) AS date, count(*) AS daily_job_count FROM s_jobs GROUP BY 1")
          .replace(f"'{_LABEL}' ||", f"'{_LABEL}' || CASE WHEN o.o_orderkey % 20 = 0 THEN 'chưa rõ ' ELSE '' END ||"))
def q_postings_over_time_undated(spark, sf_dir):
    """View 5 where every 20th posting's label holds no date: those without another date are the NULL group."""
    raw = derived_postings(spark, sf_dir)
    unclear = F.replace("job_description", F.lit(_LABEL), F.lit(_LABEL + "chưa rõ "))
    raw = raw.withColumn("job_description", F.when(F.col("ingest_seq") % 20 == 0, unclear).otherwise(F.col("job_description")))
    from ..session import materialize
    jobs = L.load_ordered(raw, ["batch", "ingest_seq"]).jobs.select("job_id", "posted_date", "posted_date_text")
    return V.postings_over_time(L.StarTables(materialize(jobs, "jobs"), None, None, None))


@register("top_skills", ORACLE["skill_demand"] + "\nORDER BY job_count DESC, skill_name LIMIT 10")
def q_top_skills(spark, sf_dir):
    """The first ten rows of the ordered report."""
    return V.skill_demand(loaded_star(spark, sf_dir, ("skills",), jobs=False)).limit(10)


@register("skill_demand_view", ORACLE["skill_demand"])
def q_skill_demand_view(spark, sf_dir):
    """The report by its name in SQL, over the registered tables."""
    V.register_views(spark, loaded_star(spark, sf_dir, ("skills",)))
    return spark.sql("SELECT skill_name, skill_category, job_count, percentage_of_jobs FROM skill_demand_view")


@register("skill_demand_approx", O.with_star("""
SELECT skill_name, count(*) AS job_count, true AS within_bound FROM s_links GROUP BY skill_name"""))
def q_skill_demand_approx(spark, sf_dir):
    """A02's approximate option: daily sketches merged per skill; ``within_bound`` tells whether the estimate is
    within three standard errors of the exact count beside it."""
    from ..session import materialize
    star = loaded_star(spark, sf_dir, ("skills",))
    # of the jobs, the sketches read the dates alone
    star = star._replace(jobs=materialize(star.jobs.select("job_id", "posted_date"), "jobs"))
    estimates = V.distinct_jobs(V.job_sketches(star), "skill_name").withColumnRenamed("job_count", "estimate")
    exact = V.skill_demand(star).select("skill_name", "job_count")
    bound = 3 * 1.04 / 4096 ** 0.5
    return exact.join(estimates, "skill_name").select(
        "skill_name", "job_count", (F.abs(F.col("estimate") - F.col("job_count")) <= F.greatest(F.lit(1.0), bound * F.col("job_count")))
        .alias("within_bound"))


@register("platform_job_ids", O.with_tx("SELECT ingest_seq, platform || '_' || md5(job_url) AS platform_job_id FROM tx"))
def q_platform_job_ids(spark, sf_dir):
    """F07."""
    return processed(spark, sf_dir).select("ingest_seq", "platform_job_id")


_SOUGHT = [f"https://{p}.example/job/{k}" for k in range(1, 40) for p in D.PLATFORMS]


@register("jobs_by_url", O.with_star(f"SELECT {', '.join(_JOB_OUT)} FROM s_jobs WHERE job_url IN ({', '.join(O.q(u) for u in _SOUGHT)})"))
def q_jobs_by_url(spark, sf_dir):
    """A lookup of some URLs in the stored table."""
    return incremental_store(spark, sf_dir).jobs_by_url(_SOUGHT).select(*_JOB_OUT)


_OK_SQL = " AND ".join(f"coalesce(length({c}), 0) > 0" for c in ["job_title", "job_description", "platform", "job_url"])


@register("raw_postings_read", f"""WITH raw AS ({O.derived_postings_sql()})
SELECT count(*) AS total_jobs, count(*) FILTER (WHERE {_OK_SQL} AND ingest_seq % 101 <> 0) AS transformed_jobs,
  count(*) FILTER (WHERE NOT ({_OK_SQL}) OR ingest_seq % 101 = 0) AS errors, count(*) FILTER (WHERE ingest_seq % 101 = 0) AS unreadable
FROM raw""")
def q_raw_postings_read(spark, sf_dir):
    """The postings as JSON lines, every 101st one broken off, read back by the declared schema and counted."""
    import uuid

    from ..schemas import CORRUPT, RAW_POSTING
    from ..session import ensure_checkpoint_dir, materialize
    from ..sources.raw import read_raw
    raw = derived_postings(spark, sf_dir)
    line = F.to_json(F.struct(*[f.name for f in RAW_POSTING.fields]))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobmart-lines-{uuid.uuid4().hex}"
    raw.select(F.when(F.col("ingest_seq") % 101 == 0, F.substr(line, F.lit(1), F.length(line) - 5)).otherwise(line).alias("value")).write.text(path)
    rows = materialize(read_raw(spark, path), "raw-read")
    return transform_stats(rows).select("*", rows.select(F.count(CORRUPT)).scalar().alias("unreadable"))


# --- crawl frontier (derived from events) --------------------------------------
from ..operators import crawl as C  # noqa: E402
from ..sources import frontier as FR  # noqa: E402

_CRAWL_QUERY = "Data Analyst"
_CAP_PAGES = D.DEFAULT_MAX_PAGES
_PLATFORMS = [*D.PLATFORMS, "quietboard"]         # one without a single link


def _crawl_ctes(max_results: int | None, max_pages: int | None) -> str:
    """The walks by window functions: pages with links numbered from 1 without a gap."""
    cap = f"WHERE rank <= {max_results}" if max_results else ""
    budget = f"least(stop_page, {max_pages + 1})" if max_pages else "stop_page"
    return f"""WITH fr AS ({O.frontier_sql()}),
full_pages AS (SELECT DISTINCT crawl, platform, page FROM fr WHERE NOT page_empty),
numbered AS (SELECT *, row_number() OVER (PARTITION BY crawl, platform ORDER BY page) AS rn FROM full_pages),
stops AS (SELECT crawl, platform, {budget} AS stop_page FROM (
            SELECT w.crawl, w.platform, CAST(coalesce(max(n.page), 0) + 1 AS BIGINT) AS stop_page
            FROM (SELECT DISTINCT crawl, platform FROM fr) w
            LEFT JOIN numbered n ON n.crawl = w.crawl AND n.platform = w.platform AND n.rn = n.page
            GROUP BY w.crawl, w.platform)),
prefix AS (SELECT f.crawl, f.platform, f.page, f.pos, f.url, f.failed
           FROM fr f JOIN stops s ON f.crawl = s.crawl AND f.platform = s.platform
           WHERE NOT f.page_empty AND f.page < s.stop_page),
firsts AS (SELECT crawl, platform, url, page, pos, failed FROM (
             SELECT *, row_number() OVER (PARTITION BY crawl, platform, url ORDER BY page, pos) AS rn FROM prefix)
           WHERE rn = 1),
capped AS (SELECT * FROM (SELECT crawl, platform, url, page, pos,
                                 CAST(row_number() OVER (PARTITION BY crawl, platform ORDER BY page, pos) AS INTEGER) AS rank
                          FROM firsts WHERE NOT failed) {cap}),
walk AS (SELECT crawl, platform, CAST(unnest(generate_series(1, {f"least(stop_page, {max_pages})" if max_pages else "stop_page"})) AS BIGINT) AS page,
                stop_page FROM stops)"""


def _frontier(spark, sf_dir):
    return FR.derived_frontier(spark, sf_dir)


@register("crawl_prefix", _crawl_ctes(None, None) + "\nSELECT crawl, platform, page, page = stop_page AS is_stop FROM walk")
def q_crawl_prefix(spark, sf_dir):
    return C.crawl_pages(_frontier(spark, sf_dir), None)


@register("crawl_dedupe", _crawl_ctes(None, None) + "\nSELECT crawl, platform, url, page, pos, failed FROM firsts")
def q_crawl_dedupe(spark, sf_dir):
    return C.crawl_dedupe(_frontier(spark, sf_dir), None)


@register("crawl_cap", _crawl_ctes(FR.FRONTIER_CAP, _CAP_PAGES) + "\nSELECT crawl, platform, url, page, pos, rank FROM capped")
def q_crawl_cap(spark, sf_dir):
    return C.crawl_cap(_frontier(spark, sf_dir), FR.FRONTIER_CAP, _CAP_PAGES)


@register("platform_union", _crawl_ctes(None, None) + """
SELECT CAST(CASE platform WHEN 'careerviet' THEN 1 WHEN 'topcv' THEN 2 ELSE 3 END AS INTEGER) AS platform_rank,
       crawl, platform, rank, url, page, pos FROM capped""")
def q_platform_union(spark, sf_dir):
    """Each platform's postings as a table of its own, joined end to end."""
    fr = _frontier(spark, sf_dir)
    return C.platform_union({p: C.crawl_cap(C.select_platforms(fr, [p]), None, None) for p in D.PLATFORMS})


def _crawl_stats_sql(n: int | None, pages: int | None) -> str:
    inside = "(b.lpage IS NULL OR x.page < b.lpage OR (x.page = b.lpage AND x.pos <= b.lpos))"
    names = ", ".join(f"({O.q(p)})" for p in _PLATFORMS)
    return _crawl_ctes(n, pages) + f"""
, base AS (SELECT s.crawl, s.platform, s.stop_page, l.page AS lpage, l.pos AS lpos FROM stops s
           LEFT JOIN capped l ON s.crawl = l.crawl AND s.platform = l.platform AND l.rank = {n or 0}),
seen AS (SELECT b.crawl, b.platform, count(*) AS rows_seen FROM prefix x
         JOIN base b ON x.crawl = b.crawl AND x.platform = b.platform WHERE {inside} GROUP BY 1, 2),
got AS (SELECT b.crawl, b.platform, count(*) FILTER (WHERE NOT failed) AS jobs, count(*) FILTER (WHERE failed) AS bad
        FROM firsts x JOIN base b ON x.crawl = b.crawl AND x.platform = b.platform WHERE {inside} GROUP BY 1, 2)
SELECT w.crawl, p.platform,
  CAST(CASE WHEN b.platform IS NULL THEN 0 ELSE coalesce(b.lpage, {f"least(b.stop_page, {pages})" if pages else "b.stop_page"}) END
       AS BIGINT) AS pages_visited,
  coalesce(g.jobs, 0) AS jobs_scraped, coalesce(s.rows_seen, 0) - coalesce(g.jobs, 0) - coalesce(g.bad, 0) AS duplicates_skipped,
  CASE WHEN b.platform IS NULL THEN 1 ELSE coalesce(g.bad, 0) END AS errors,
  CASE WHEN b.platform IS NULL OR b.stop_page = 1 THEN 'failed' ELSE 'success' END AS status
FROM (SELECT DISTINCT crawl FROM fr) w CROSS JOIN (VALUES {names}) p(platform)
LEFT JOIN base b ON b.crawl = w.crawl AND b.platform = p.platform
LEFT JOIN seen s ON s.crawl = w.crawl AND s.platform = p.platform
LEFT JOIN got g ON g.crawl = w.crawl AND g.platform = p.platform"""


@register("crawl_stats", _crawl_stats_sql(None, None))
def q_crawl_stats(spark, sf_dir):
    return C.crawl_stats(_frontier(spark, sf_dir), None, None, _PLATFORMS)


@register("crawl_stats_capped", _crawl_stats_sql(FR.FRONTIER_CAP, _CAP_PAGES))
def q_crawl_stats_capped(spark, sf_dir):
    return C.crawl_stats(_frontier(spark, sf_dir), FR.FRONTIER_CAP, _CAP_PAGES, _PLATFORMS)


@register("crawl_summary", "WITH stats AS (" + _crawl_stats_sql(None, None) + """)
SELECT count(*) AS walks, CAST(sum(pages_visited) AS BIGINT) AS pages_visited,
       CAST(sum(jobs_scraped) AS BIGINT) AS jobs_scraped,
       CAST(sum(duplicates_skipped) AS BIGINT) AS duplicates_skipped, CAST(sum(errors) AS BIGINT) AS errors,
       count(*) FILTER (WHERE status = 'success') AS succeeded
FROM stats""")
def q_crawl_summary(spark, sf_dir):
    return C.crawl_summary(_frontier(spark, sf_dir), None, None, _PLATFORMS)


@register("listing_urls", _crawl_ctes(None, None) +
          f"\nSELECT crawl, platform, page, {O.listing_url_sql('platform', 'page', _CRAWL_QUERY)} AS list_url FROM walk")
def q_listing_urls(spark, sf_dir):
    return C.listing_urls(C.crawl_pages(_frontier(spark, sf_dir), None), _CRAWL_QUERY)


# --- relevance, key phrases ------------------------------------------------------
from ..operators import quality as QL  # noqa: E402
from ..operators import relevance as R  # noqa: E402

_KW_QUERY = "data analyst the and"


def _kw_sql(query: str) -> str:
    words = query.lower().split()
    text = "lower(concat_ws(' ', source, text))"
    m = " + ".join(f"CAST(instr({text}, {O.q(w)}) > 0 AS INTEGER)" for w in words) or "0"
    thr = max(1, len(words) // 2)
    return (f"SELECT doc_id, {m} AS matched_words, ({m}) >= {thr} AS relevant FROM documents")


@register("keyword_relevance", _kw_sql(_KW_QUERY))
def q_keyword_relevance(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return R.keyword_relevance(d, _KW_QUERY, title="source", description="text") \
        .select("doc_id", "matched_words", "relevant")


@register("semantic_relevance", f"""
WITH qv AS (SELECT CAST(embedding AS DOUBLE[]) AS qe FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id,
        CASE WHEN sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
                  * sqrt(list_inner_product(qe, qe)) > 0
             THEN list_inner_product(CAST(embedding AS DOUBLE[]), qe)
                  / (sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
                     * sqrt(list_inner_product(qe, qe))) END AS sim
      FROM embeddings, qv)
SELECT vec_id, round(sim, 6) AS similarity, coalesce(sim >= {D.SEMANTIC_THRESHOLD}, false) AS relevant FROM s""")
def q_semantic_relevance(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # the query vector is a scalar subquery (one row, computed once), projected
    # as a column before the array functions use it
    query = e.filter(F.col("vec_id") == 0).select(F.struct("embedding", norm(F.col("embedding")).alias("norm"))).scalar()
    e = e.select("*", query.alias("_query"))
    return (R.semantic_relevance(e, "embedding", F.col("_query.embedding"), query_norm=F.col("_query.norm"))
            .select("vec_id", F.round("similarity", 6).alias("similarity"), "relevant"))


_LETTERS = "aetns"


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A user's embedding that SQL can follow: how often five letters occur."""
    return [[float(t.lower().count(c)) for c in _LETTERS] for t in texts]


def _letters_sql(text: str) -> str:
    return "[" + ", ".join(f"CAST(length({text}) - length(replace({text}, '{c}', '')) AS DOUBLE)" for c in _LETTERS) + "]"


@register("semantic_relevance_text", f"""
WITH v AS (SELECT doc_id, lower(concat_ws(' ', source, text)) AS t, {_letters_sql("lower(concat_ws(' ', source, text))")} AS e,
             {_letters_sql(O.q(_KW_QUERY))} AS q FROM documents),
s AS (SELECT doc_id, t, CASE WHEN list_inner_product(e, e) > 0
        THEN list_inner_product(e, q) / (sqrt(list_inner_product(e, e)) * sqrt(list_inner_product(q, q))) END AS sim FROM v)
SELECT doc_id, round(sim, 6) AS similarity, CASE WHEN sim IS NOT NULL THEN sim >= {D.SEMANTIC_THRESHOLD}
  ELSE {" + ".join(f"CAST(instr(t, {O.q(w)}) > 0 AS INTEGER)" for w in _KW_QUERY.split())} >= {max(1, len(_KW_QUERY.split()) // 2)} END AS relevant
FROM s""")
def q_semantic_relevance_text(spark, sf_dir):
    """Whole texts embedded by a user function in Arrow batches; the keyword test where there is no vector."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return (R.semantic_relevance_text(d, letter_counts, _KW_QUERY, title="source", description="text")
            .select("doc_id", F.round("similarity", 6).alias("similarity"), "relevant"))


_WORDS_CTE = f"""
WITH w AS (
  SELECT doc_id, x.w AS word, x.p AS pos FROM (
    SELECT doc_id, unnest(list_transform(regexp_split_to_array(lower(text), {O.q(O.WS_RUN)}),
                                         lambda v, i: {{'w': v, 'p': i}})) AS x
    FROM documents WHERE length(text) >= {D.KEY_PHRASE_MIN_TEXT})),
f AS (SELECT doc_id, word, count(*) AS freq, CAST(min(pos) - 1 AS INTEGER) AS first_pos FROM w
      WHERE length(word) >= {D.KEY_PHRASE_MIN_WORD} AND word NOT IN ({', '.join(O.q(s) for s in D.STOP_WORDS)})
      GROUP BY doc_id, word)"""


@register("word_frequency", _WORDS_CTE + "\nSELECT doc_id, word, freq, first_pos FROM f")
def q_word_frequency(spark, sf_dir):
    return R.word_frequency(table(spark, sf_dir, "documents"), "text", "doc_id")


@register("key_phrases", f"""
WITH w AS (
  SELECT doc_id, x.w AS word, x.p AS pos FROM (
    SELECT doc_id, unnest(list_transform(regexp_split_to_array(lower(text), {O.q(O.WS_RUN)}),
                                         lambda v, i: {{'w': v, 'p': i}})) AS x
    FROM documents WHERE length(text) >= {D.KEY_PHRASE_MIN_TEXT})),
f AS (SELECT doc_id, word, count(*) AS freq, min(pos) AS first_pos FROM w
      WHERE length(word) >= {D.KEY_PHRASE_MIN_WORD} AND word NOT IN ({', '.join(O.q(s) for s in D.STOP_WORDS)})
      GROUP BY doc_id, word)
SELECT doc_id, rank, word, freq FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY freq DESC, first_pos) AS INTEGER) AS rank FROM f)
WHERE rank <= 5""")
def q_key_phrases(spark, sf_dir):
    return R.key_phrases(table(spark, sf_dir, "documents"), "text", "doc_id", 5)


# --- quality ---------------------------------------------------------------------
_RANGE_VALUES = ", ".join(f"({O.q(k)}, {lo}, {hi})" for k, (lo, hi) in D.SENIORITY_SALARY_RANGES.items())


@register("salary_range_check", O.with_tx(f"""
, rng(seniority_level, range_min, range_max) AS (VALUES {_RANGE_VALUES})
SELECT t.ingest_seq, t.seniority_level, t.salary_min, t.salary_max,
  CAST(r.range_min AS BIGINT) AS range_min, CAST(r.range_max AS BIGINT) AS range_max,
  CASE WHEN r.range_min IS NULL OR t.salary_min IS NULL OR t.salary_max IS NULL THEN 'unknown'
       WHEN t.salary_max < r.range_min THEN 'below'
       WHEN t.salary_min > r.range_max THEN 'above' ELSE 'within' END AS salary_status
FROM tx t LEFT JOIN rng r ON t.seniority_level = r.seniority_level""", extra_ctes=True))
def q_salary_range_check(spark, sf_dir):
    return QL.salary_range_check(processed(spark, sf_dir)).select(
        "ingest_seq", "seniority_level", "salary_min", "salary_max", "range_min", "range_max",
        "salary_status")


@register("canonical_location", f"""WITH raw AS ({O.derived_postings_sql()})
SELECT ingest_seq, location, {O.canonical_location('location')} AS canonical_location FROM raw""")
def q_canonical_location(spark, sf_dir):
    raw = derived_postings(spark, sf_dir).select("ingest_seq", "location")
    return QL.canonical_locations_of(raw, "location")


_CANONICAL = ", ".join(f"({O.q(n)})" for n in D.LOCATION_ALIASES)


@register("canonical_locations", f"""WITH raw AS ({O.derived_postings_sql()}),
found AS (SELECT {O.canonical_location('location')} AS location, count(*) AS postings FROM raw GROUP BY 1)
SELECT n.location, coalesce(f.postings, 0) AS postings FROM (VALUES {_CANONICAL}) n(location)
LEFT JOIN found f ON f.location = n.location""")
def q_canonical_locations(spark, sf_dir):
    """every canonical location, with its postings."""
    from ..functions import enrich as E
    found = (derived_postings(spark, sf_dir).groupBy(E.canonical_location(F.col("location")).alias("location"))
             .agg(F.count(F.lit(1)).alias("postings")))
    return (E.canonical_locations(spark).join(found, "location", "left")
            .select("location", F.coalesce("postings", F.lit(0)).alias("postings")))


_KW_VALUES = ", ".join(f"({o}, {O.q(n)}, {O.q(k)})" for o, _, n, k in D.keyword_rows())


@register("keyword_flat", O.with_tx(f"""
SELECT m.keyword, m.skill_name, coalesce(c.postings, 0) AS postings
FROM (SELECT keyword, arg_max(skill_name, kw_order) AS skill_name
      FROM (VALUES {_KW_VALUES}) v(kw_order, skill_name, keyword) GROUP BY keyword) m
LEFT JOIN (SELECT skill_name, count(*) AS postings FROM tx_skills GROUP BY skill_name) c
  ON m.skill_name = c.skill_name"""))
def q_keyword_flat(spark, sf_dir):
    from ..operators.load import exploded_skills
    counts = exploded_skills(processed(spark, sf_dir)).groupBy("skill_name") \
        .agg(F.count(F.lit(1)).alias("postings"))
    kw = QL.keyword_skill_map(spark)
    return (kw.join(counts, "skill_name", "left")
            .select("keyword", "skill_name", F.coalesce("postings", F.lit(0)).alias("postings")))


# --- HTML pages ---------------------------------------------------------------------
from ..sources import html as H  # noqa: E402

# markup that SQL can read: one h1, article and nav a page, tags without '>' in attributes
_TEXT = "regexp_replace({0}, '<[^>]*>', ' ', 'g')"


def _decoded(c: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "\'\'"), ("&amp;", "&")):
        c = f"replace({c}, '{name}', '{char}')"
    return c


@register("page_fields", f"""
SELECT page_id, url, {O.normalize_text(_decoded(_TEXT.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")))} AS title,
  {O.normalize_text(_decoded(_TEXT.format("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")))} AS body,
  CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a[ >]')) AS INTEGER) AS nav_links
FROM pages""")
def q_page_fields(spark, sf_dir):
    return H.page_fields(table(spark, sf_dir, "pages"))


# --- incremental ingest: a stream into the persistent store -------------------------
@register("incremental_ingest", ORACLE["load_jobs"])
def q_incremental_ingest(spark, sf_dir):
    """Derived postings arrive in two rounds (batch 0, then batch 1) as Parquet
    files in a folder under the shared checkpoint dir; after each round the stream
    runs with ``availableNow`` against the same checkpoint, loading the new files
    into one star store.  Returns the loaded jobs (natural columns)."""
    import uuid

    from ..schemas import RAW_POSTING
    from ..session import ensure_checkpoint_dir
    from ..streaming.ingest import ingest_available

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobmart-stream-{uuid.uuid4().hex}"
    raw = derived_postings(spark, sf_dir)
    cols = [f.name for f in RAW_POSTING.fields]
    store = None
    for b in (0, 1):
        raw.filter(F.col("batch") == b).select(*cols).write.mode("error").parquet(f"{root}/in/{b}")
        _arrive(spark, f"{root}/in/{b}", f"{root}/source", f"b{b}")
        store = ingest_available(spark, f"{root}/source", f"{root}/star", f"{root}/checkpoint",
                                 max_files_per_trigger=None)
    return store.tables().jobs.select(*_JOB_OUT)


def _arrive(spark, src_dir: str, target: str, tag: str) -> None:
    """Move the data files of ``src_dir`` into the stream's source folder (a
    rename per file: the files are already written, the stream sees them whole)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    tgt = jvm.org.apache.hadoop.fs.Path(target)
    fs = tgt.getFileSystem(conf)
    fs.mkdirs(tgt)
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(src_dir)):
        name = st.getPath().getName()
        if name.endswith(".parquet"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(target, f"{tag}-{name}"))


# --- platform pages rendered from the tables, parsed back (S04, S05, S06) ---------
from ..sources import rendered as RD  # noqa: E402

_DETAIL_COLS = ["ingest_seq", "platform", "job_url", "job_title", "company", "location",
                "job_description", "posting_date"]


def _n(c: str) -> str:
    return O.normalize_text(c)


@register("detail_pages", f"""WITH raw AS ({O.derived_postings_sql()})
SELECT ingest_seq, platform, job_url,
  {_n("coalesce(job_title, '')")} AS job_title,
  CASE WHEN platform = 'vieclam24h' THEN '' ELSE {_n("coalesce(company, '')")} END AS company,
  CASE WHEN platform = 'vieclam24h' THEN '' ELSE {_n("coalesce(location, '')")} END AS location,
  {_n("regexp_replace(coalesce(job_description, ''), '<[^>]+>', ' ', 'g')")} AS job_description,
  CASE WHEN platform = 'topcv' THEN NULL ELSE {_n("coalesce(posting_date, '')")} END AS posting_date
FROM raw""")
def q_detail_pages(spark, sf_dir):
    """S05a-c: every derived posting rendered as its platform's detail page and
    parsed back with the platform's selectors."""
    pages = RD.detail_pages(derived_postings(spark, sf_dir))
    return H.parse_detail_pages(pages).select(*_DETAIL_COLS)


@register("listing_links", f"""WITH fr AS ({O.frontier_sql()})
SELECT crawl, platform, page,
  CAST(row_number() OVER (PARTITION BY crawl, platform, page ORDER BY pos) - 1 AS INTEGER) AS link_pos,
  CASE platform WHEN 'careerviet' THEN 'https://www.careerviet.vn/job/u' || CAST("user" AS VARCHAR) || '.html'
                WHEN 'topcv' THEN 'https://www.topcv.vn/viec-lam/u' || CAST("user" AS VARCHAR) || '.html'
                ELSE 'https://vieclam24h.vn/viec-lam/u' || CAST("user" AS VARCHAR) END AS url
FROM fr WHERE NOT page_empty""")
def q_listing_links(spark, sf_dir):
    """S04a-c: every non-empty frontier page rendered as its platform's listing
    page (with decoy links) and parsed back into detail links."""
    links = H.listing_page_links(RD.listing_pages(_frontier(spark, sf_dir)))
    walk = F.floor(F.col("page_id") / 1000).cast("long")
    return links.select(F.floor(walk / 4).cast("long").alias("crawl"), "platform", (F.col("page_id") % 1000).alias("page"),
                        F.col("pos").alias("link_pos"), "url")


# --- F05 over the pages table ------------------------------------------------------
_HREF = 'href="([^"]*)"'


_ABSOLUTE = """CASE WHEN href = '' THEN ''
       WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href
       WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || href
       WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || href
       WHEN starts_with(href, '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', '') || href
       WHEN starts_with(href, '#') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\\?$', '') || href
       ELSE regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', ''), '[^/]*$', '') || href
  END"""


@register("page_hrefs", f"""
WITH h AS (
  SELECT page_id, url, x.h AS href, x.i - 1 AS pos FROM (
    SELECT page_id, url, unnest(list_transform(regexp_extract_all(html, {O.q(_HREF)}, 1),
                                               lambda v, i: {{'h': v, 'i': i}})) AS x
    FROM pages))
SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
  {_ABSOLUTE} AS absolute_url
FROM h""")
def q_page_hrefs(spark, sf_dir):
    """every href of every page (native extraction), made absolute against
    the page URL with ``normalize_url``."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    hrefs = (p.select("page_id", "url",
                      F.posexplode_outer(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)))
                      .alias("pos", "href"))
             .filter(F.col("href").isNotNull()))
    return hrefs.select("page_id", "pos", "href",
                        TX.normalize_url(F.col("href"), F.col("url")).alias("absolute_url"))


@register("extract_salary_strict", O.with_tx(O.strict_salary_select(), extra_ctes=True))
def q_extract_salary_strict(spark, sf_dir):
    """F09 strict: thousands separators and decimals read, "up to"/"from" maxima
    scaled, bare numeric ranges ignored."""
    return transform_postings(derived_postings(spark, sf_dir), strict_salary=True).select(
        "ingest_seq", "salary_min", "salary_max", "salary_currency", "salary_overflow")


@register("page_links", f"""
WITH h AS (
  SELECT page_id, url, x.h AS href, x.i - 1 AS pos FROM (
    SELECT page_id, url, unnest(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), {O.q(_HREF)}, 1),
                                               lambda v, i: {{'h': v, 'i': i}})) AS x
    FROM pages))
SELECT page_id, CAST(pos AS INTEGER) AS pos, {_ABSOLUTE} AS url FROM h""")
def q_page_links(spark, sf_dir):
    """The links of every page's menu, absolute, by the HTML parser."""
    return H.page_links(table(spark, sf_dir, "pages"))


# --- a user platform (U02): the pages table as one more platform ----------------------
@register("user_platform_pages", ORACLE["page_fields"].replace(" AS title", " AS job_title").replace(" AS body", " AS job_description")
          .replace("SELECT page_id, url,", "SELECT page_id AS ingest_seq, url AS job_url, 'site' AS platform,")
          .rsplit(",\n  CAST(len(", 1)[0] + "\nFROM pages")
def q_user_platform_pages(spark, sf_dir):
    """Postings from the ``pages`` table with a user's selectors."""
    rules = {"site": {"job_title": ("h1", None), "job_description": ("article", None)}}
    pages = table(spark, sf_dir, "pages").withColumn("platform", F.lit("site"))
    return H.parse_detail_pages(pages, selectors=rules).select("ingest_seq", "job_url", "platform", "job_title", "job_description")
