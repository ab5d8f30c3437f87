"""The five reporting views (A01-A05, J01, J02, J09, O01-O03, P07, F19, F20) and
their registration as temp views (K06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.load import StarTables, job_id

DETAILS = ["job_id", "platform", "job_url", "job_title", "company_name", "location", "posted_date",
           "scraped_at", "seniority_level", "salary_min", "salary_max", "salary_currency",
           "clean_description", "raw_description"]


def job_details(star: StarTables) -> DataFrame:
    """View 1 (J01): jobs with their descriptions."""
    return star.jobs.join(star.job_descriptions, "job_id").select(*DETAILS)


def details_of(firsts: DataFrame) -> DataFrame:
    """View 1 over processed postings that are one a job: both tables are columns of the same row."""
    return firsts.select(job_id(F.col("job_url")).alias("job_id"), *DETAILS[1:])


def skill_demand(star: StarTables) -> DataFrame:
    """View 2 (A01, A02, J02, J09): jobs per skill and the share of jobs that have
    any skill.

    One shuffle of the links, by job: a job's skills are a set of at most
    vocabulary size, and the rows left are counted per skill (combined before the
    shuffle).  The number of jobs with a skill is the number of those sets."""
    sets = star.job_skills.groupBy("job_id").agg(F.collect_set("skill_id").alias("skills"))
    marked = sets.select(F.posexplode("skills").alias("pos", "skill_id"))
    per_skill = marked.groupBy("skill_id").agg(F.count(F.lit(1)).alias("job_count"),
                                               F.count(F.when(F.col("pos") == 0, 1)).alias("jobs_marked"))
    per_name = (per_skill.join(star.skills, "skill_id")
                .groupBy("skill_name", "skill_category")
                .agg(F.sum("job_count").alias("job_count"), F.sum("jobs_marked").alias("jobs_marked")))
    # one row per skill: one window over all rows is bounded by the vocabulary
    jobs_with_skills = F.sum("jobs_marked").over(Window.partitionBy())
    return (per_name.select("skill_name", "skill_category", "job_count",
                            F.try_divide(F.col("job_count").cast("double") * 100, jobs_with_skills)
                            .alias("percentage_of_jobs"))
            .orderBy(F.desc("job_count"), "skill_name"))


def salary_by_seniority_location(star: StarTables) -> DataFrame:
    """View 3 (A03, P07)."""
    j = star.jobs.filter(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()
                         & F.col("seniority_level").isNotNull() & F.col("location").isNotNull())
    return (j.groupBy("seniority_level", "location", "salary_currency")
            .agg(F.avg(F.col("salary_min").cast("double")).alias("avg_salary_min"),
                 F.avg("salary_max").alias("avg_salary_max"),
                 F.count("job_id").alias("job_count"))
            .select("seniority_level", "location", "avg_salary_min", "avg_salary_max",
                    "salary_currency", "job_count")
            .orderBy("seniority_level", "location", "salary_currency"))


def platform_job_count(star: StarTables) -> DataFrame:
    """View 4 (A04)."""
    return (star.jobs.groupBy("platform").agg(F.count("job_id").alias("total_jobs"))
            .orderBy(F.desc("total_jobs"), "platform"))


def postings_over_time(star: StarTables) -> DataFrame:
    """View 5 (A05, F19): jobs per day; those whose date is there but cannot be read are one NULL group."""
    return (star.jobs.filter(F.col("posted_date").isNotNull() | F.col("posted_date_text").isNotNull())
            .groupBy(F.col("posted_date").cast("date").alias("date"))
            .agg(F.count("job_id").alias("daily_job_count"))
            .orderBy("date"))


def job_sketches(star: StarTables, lg_k: int = 12) -> DataFrame:
    """A02's approximate option: a HyperLogLog sketch of the jobs of every skill and day.

    Sketches merge, so one stored row a skill and day answers for any set of skills and days, and
    new postings add rows without reading old ones.  ``2 ** lg_k`` registers: relative error about 1.04 / sqrt(2 ** lg_k)."""
    linked = star.job_skills.join(star.jobs.select("job_id", F.col("posted_date").alias("date")), "job_id")
    per = linked.groupBy("skill_id", "date").agg(F.hll_sketch_agg("job_id", F.lit(lg_k)).alias("jobs"))
    return per.join(star.skills, "skill_id").select("skill_name", "skill_category", "date", "jobs")


def distinct_jobs(sketches: DataFrame, *keys: str) -> DataFrame:
    """(keys, job_count): estimated distinct jobs of each group of sketches; without keys, of all."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("jobs")).alias("job_count"))


VIEWS = {
    "job_details_view": job_details,
    "skill_demand_view": skill_demand,
    "salary_by_seniority_location_view": salary_by_seniority_location,
    "platform_job_count_view": platform_job_count,
    "job_postings_over_time_view": postings_over_time,
}


def register_views(spark: SparkSession, star: StarTables) -> list[str]:
    """The star tables and the five views as temp views for SQL users."""
    for name, df in star._asdict().items():
        df.createOrReplaceTempView(name)
    for name, fn in VIEWS.items():
        fn(star).createOrReplaceTempView(name)
    return list(star._fields) + list(VIEWS)
