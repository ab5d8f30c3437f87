"""Declared schemas: raw postings in, processed postings, and the four star tables."""

from pyspark.sql import types as T

SKILL = T.StructType([
    T.StructField("skill_name", T.StringType()),
    T.StructField("skill_category", T.StringType()),
])

# A raw posting as a scraper (or any upstream job) hands it over.  ``ingest_seq``
# replaces list order: first-wins rules order on it, so it must be unique per
# posting (a file offset, a Kafka offset, ``monotonically_increasing_id``).
RAW_POSTING = T.StructType([
    T.StructField("ingest_seq", T.LongType()),
    T.StructField("platform", T.StringType()),
    T.StructField("job_url", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("job_description", T.StringType()),
    T.StructField("posting_date", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
])

# where a reader puts the text of a row that does not fit the schema
CORRUPT = "_corrupt_record"

PROCESSED = T.StructType([
    T.StructField("ingest_seq", T.LongType()),
    T.StructField("platform_job_id", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("job_url", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("posted_date", T.DateType()),
    T.StructField("posted_date_text", T.StringType()),     # the date's text where it cannot be read
    T.StructField("scraped_at", T.TimestampNTZType()),
    T.StructField("seniority_level", T.StringType()),
    T.StructField("salary_min", T.LongType()),
    T.StructField("salary_max", T.DoubleType()),
    T.StructField("salary_currency", T.StringType()),
    T.StructField("salary_overflow", T.BooleanType()),
    T.StructField("raw_description", T.StringType()),
    T.StructField("clean_description", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("extracted_skills", T.ArrayType(SKILL)),
])

JOBS = T.StructType([
    T.StructField("job_id", T.BinaryType(), False),
    T.StructField("platform_job_id", T.StringType(), False),
    T.StructField("platform", T.StringType(), False),
    T.StructField("job_url", T.StringType(), False),
    T.StructField("job_title", T.StringType(), False),
    T.StructField("company_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("posted_date", T.DateType()),
    T.StructField("posted_date_text", T.StringType()),     # the date's text where it cannot be read
    T.StructField("scraped_at", T.TimestampNTZType()),
    T.StructField("seniority_level", T.StringType()),
    T.StructField("salary_min", T.LongType()),
    T.StructField("salary_max", T.DoubleType()),
    T.StructField("salary_currency", T.StringType()),
])

SKILLS = T.StructType([
    T.StructField("skill_id", T.BinaryType(), False),
    T.StructField("skill_name", T.StringType(), False),
    T.StructField("skill_category", T.StringType()),
])

JOB_SKILLS = T.StructType([
    T.StructField("job_id", T.BinaryType(), False),
    T.StructField("skill_id", T.BinaryType(), False),
])

JOB_DESCRIPTIONS = T.StructType([
    T.StructField("job_id", T.BinaryType(), False),
    T.StructField("raw_description", T.StringType()),
    T.StructField("clean_description", T.StringType()),
])

STAR = {
    "jobs": JOBS,
    "skills": SKILLS,
    "job_skills": JOB_SKILLS,
    "job_descriptions": JOB_DESCRIPTIONS,
}

# HTML pages: the shape of the ``pages`` test table.
PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
