"""Raw postings -> processed postings (P01-P04, F04, F07-F15), and A07 stats.

One narrow projection: no shuffle, no Python worker.  Seniority, salary and
skills read the raw description (tags included), the label extractors read the
cleaned one -- as in the original transformer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..schemas import CORRUPT
from ..functions import enrich as E
from ..functions.salary import with_salary
from ..functions.text import clean_description, word_tokens


def _nonempty(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0)) > 0


def essential_ok(df: DataFrame) -> Column:
    """Title, description, platform and url present and non-empty (no trim); rows that the
    reader could not parse (``sources.raw``) are rejected."""
    ok = (_nonempty(F.col("job_title")) & _nonempty(F.col("job_description"))
          & _nonempty(F.col("platform")) & _nonempty(F.col("job_url")))
    return ok & F.col(CORRUPT).isNull() if CORRUPT in df.columns else ok


def platform_job_id(platform: Column, url: Column) -> Column:
    """platform + '_' + a stable 128-bit hash of the URL."""
    return F.concat(platform, F.lit("_"), F.md5(url))


def _col_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _enriched(df: DataFrame, strict_salary: bool = False, unknown_label: str | None = None,
              skills: dict | None = None, levels: dict | None = None,
              aliases: dict | None = None) -> DataFrame:
    title, desc = F.col("job_title"), F.col("job_description")
    now = F.current_timestamp().cast("timestamp_ntz")
    # ISO text (a lower-case 't' separator is accepted); unreadable -> NULL; only a
    # source without the column gets the time of the run
    scraped = F.upper(F.col("scraped_at")).try_cast("timestamp_ntz") if "scraped_at" in df.columns else now
    # a source without an order of its own gets the scan's (file split, row); nothing is shuffled before
    seq = F.col("ingest_seq") if "ingest_seq" in df.columns else F.monotonically_increasing_id()
    # lower-case title and description once; lower(a + ' ' + b) equals
    # lower(a) + ' ' + lower(b) (context-dependent lower-casing only looks at
    # neighbouring letters, and the separator is a space)
    df = df.select("*", F.lower(title).alias("_lt"), F.lower(desc).alias("_ld"))
    lt, ld = F.col("_lt"), F.col("_ld")
    base = df.select(
        seq.alias("ingest_seq"),
        *[c for c in ["batch"] if c in df.columns],
        F.col("platform"), F.col("job_url"), title.alias("job_title"),
        _col_or_null(df, "company").alias("company"),
        _col_or_null(df, "location").alias("raw_location"),
        desc.alias("raw_description"),
        _col_or_null(df, "posting_date").alias("posting_date"),
        scraped.alias("scraped_at"),
        essential_ok(df).alias("_ok"),
        # computed once and reused below (not re-evaluated per consumer)
        clean_description(desc, lowered=ld).alias("clean_description"),
        F.concat(lt, F.lit(" "), ld).alias("_text_td"),
        F.concat(ld, F.lit(" "), lt).alias("_text_dt"),
    )
    base = with_salary(base, "_text_td", strict=strict_salary)
    # one token array serves both texts (they hold the same word runs); keep only
    # the tokens that are keywords of either dictionary
    sk = D.SKILL_DICTIONARY if skills is None else skills
    lv = D.SENIORITY_LEVELS if levels is None else levels
    kw_lists = [kws for cat in sk.values() for kws in cat.values()] + list(lv.values())
    base = base.select("*", E.keyword_hits(word_tokens(F.col("_text_dt")), kw_lists).alias("_tokens"))
    base = E.with_labels(base, "clean_description", "posting_date")
    return base.select(
        "*",
        E.detect_seniority(F.col("_text_td"), levels=levels, unknown_label=unknown_label,
                           tokens=F.col("_tokens"))
         .alias("seniority_level"),
        E.extract_skills(F.col("_text_dt"), dictionary=skills, tokens=F.col("_tokens")).alias("extracted_skills"),
        E.extract_company(F.col("_company"), F.col("company")).alias("company_name"),
        E.extract_location(F.col("_location"), F.col("raw_location"), aliases).alias("location"),
        E.extract_posted_date(F.col("_posted_lead"), F.col("_posted_any")).alias("posted_date"),
        E.posted_text(F.col("_posted"), F.col("posting_date")).alias("_posted_text"),
    )


def transform_postings(df: DataFrame, strict_salary: bool = False,
                       unknown_label: str | None = None, skills: dict | None = None,
                       levels: dict | None = None, aliases: dict | None = None,
                       keep_rejected: bool = False) -> DataFrame:
    """Processed postings (PROCESSED schema, plus ``batch`` if present).

    Rejected rows (P01 guard) are dropped unless ``keep_rejected``; then a
    boolean ``accepted`` column tells them apart.
    """
    e = _enriched(df, strict_salary, unknown_label, skills, levels, aliases)
    out = e.select(
        "ingest_seq",
        *[c for c in ["batch"] if c in e.columns],
        platform_job_id(F.col("platform"), F.col("job_url")).alias("platform_job_id"),
        "platform", "job_url", "job_title", "company_name", "location", "posted_date",
        F.when(F.col("posted_date").isNull(), F.col("_posted_text")).alias("posted_date_text"),
        "scraped_at", "seniority_level",
        "salary_min", "salary_max", "salary_currency", "salary_overflow",
        "raw_description", "clean_description",
        F.current_timestamp().alias("processed_at"),
        "extracted_skills",
        F.col("_ok").alias("accepted"),
    )
    if keep_rejected:
        return out
    return out.filter("accepted").drop("accepted")


def _stats(accepted: Column, overflow: Column) -> list[Column]:
    bad = ~accepted | F.coalesce(overflow, F.lit(False))
    return [F.count(F.lit(1)).alias("total_jobs"), F.count(F.when(accepted, 1)).alias("transformed_jobs"),
            F.count(F.when(bad, 1)).alias("errors")]


def transform_stats(df: DataFrame, strict_salary: bool = False) -> DataFrame:
    """Total, transformed, errors, one row.  An error is a rejected row or an accepted one
    whose salary is too large for its column (it is kept, without the salary)."""
    rows = with_salary(df.select(essential_ok(df).alias("_ok"), F.concat(
        F.lower("job_title"), F.lit(" "), F.lower("job_description")).alias("_text_td")), "_text_td", strict=strict_salary)
    return rows.agg(*_stats(F.col("_ok"), F.col("salary_overflow")))


def observed_transform(df: DataFrame, **opts) -> tuple[DataFrame, Observation]:
    """``transform_postings`` that counts A07 on the way: the observation holds total_jobs, transformed_jobs and
    errors once the rows were written, so statistics need no scan of their own."""
    seen = Observation("transform")
    rows = transform_postings(df, keep_rejected=True, **opts).observe(seen, *_stats(F.col("accepted"), F.col("salary_overflow")))
    return rows.filter("accepted").drop("accepted"), seen


def unreadable_times(df: DataFrame) -> DataFrame:
    """Rows whose ``scraped_at`` text is no timestamp (P04 leaves it NULL), one row."""
    bad = F.col("scraped_at").isNotNull() & F.upper(F.col("scraped_at")).try_cast("timestamp_ntz").isNull()
    return df.agg(F.count(F.when(bad, 1)).alias("unreadable_scraped_at"))
