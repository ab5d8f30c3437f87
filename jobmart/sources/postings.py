"""Raw postings derived from the given ``orders`` x ``customer`` tables, so every
query's work grows with them.

The derivation rule (see FIXTURES.md §3) is written once here for Spark and once,
in the same shape, as DuckDB SQL in ``jobmart.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# ---------------------------------------------------------------------------
# FIXED VALUES of the derived-postings fixture (shared with the DuckDB oracle)
# ---------------------------------------------------------------------------
FIX_PLATFORMS = ["careerviet", "topcv", "vieclam24h"]
FIX_TITLES = ["Senior Data Analyst", "Junior Data Engineer", "BI Developer",
              "Machine Learning Engineer", "thực tập sinh data", "Trưởng phòng dữ liệu",
              "Phó giám đốc phân tích", "Data Analyst"]
FIX_LOCATIONS = ["Hà Nội", "hochiminh", "da nang", "TPHCM", "Cần Thơ", "Berlin", "hp"]
FIX_SKILLS = ["SQL, Python, Tableau", "Power BI; Excel", "R, AWS (GCP)", "Spark/Hadoop/Kafka",
              "PostgreSQL và MySQL", "tỉ mỉ, giao tiếp", "node.js + Git",
              "scikit-learn, TensorFlow", "a/b testing", "no tech",
              "Airflow, SSIS; looker studio"]
FIX_SALARIES = ["10 - 15 triệu", "10.000.000 - 15.000.000 vnđ", "up to 15 triệu", "from 10 triệu",
                "10 triệu - 15 triệu", "10 triệu đến 15 triệu", "3-5 years",
                "10,000,000 - 15,000,000 VND", "10.5 - 15 triệu", "5+ years", "20 triệu",
                "thỏa thuận", "500.000 - 15.000.000 vnd"]
TITLE_NULL_MOD, TITLE_NULL_REM = 97, 96
DESC_EMPTY_MOD, DESC_EMPTY_REM = 50, 49
DUP_MOD, DUP_REM, DUP_SHIFT = 10, 9, 9


def _pick(key: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v))
    return expr


def derived_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_POSTING rows plus ``batch`` (two load batches), one per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("o_orderkey")
    platform = _pick(k % 3, FIX_PLATFORMS)
    url_key = F.when(k % DUP_MOD == DUP_REM, k - DUP_SHIFT).otherwise(k)
    location = _pick(F.col("o_custkey") % 7, FIX_LOCATIONS)
    date_iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    date_dmy = F.date_format("o_orderdate", "dd/MM/yyyy")
    date_txt = F.when(k % 4 == 0, date_iso).otherwise(date_dmy)
    description = F.when(k % DESC_EMPTY_MOD == DESC_EMPTY_REM, F.lit("")).otherwise(F.concat(
        F.lit("<p>Công ty: "), F.col("c_name"), F.lit(" Địa điểm: "), location,
        F.lit(" Ngày cập nhật: "), date_txt, F.lit("</p> <div>"), _pick(k % 11, FIX_SKILLS),
        F.lit("</div> "), _pick(k % 13, FIX_SALARIES), F.lit(" Chi tiết")))
    # a file of few row groups is as few tasks, and what follows costs far more than reading: narrow
    # rows are dealt out, evenly whatever their keys
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner").repartition(n)
    return joined.select(
        k.alias("ingest_seq"),
        (k % 2).alias("batch"),
        platform.alias("platform"),
        F.concat(F.lit("https://"), platform, F.lit(".example/job/"), url_key.cast("string")).alias("job_url"),
        F.when(k % TITLE_NULL_MOD == TITLE_NULL_REM, F.lit(None).cast("string"))
         .otherwise(_pick(k % 8, FIX_TITLES)).alias("job_title"),
        F.col("c_name").alias("company"),
        location.alias("location"),
        description.alias("job_description"),
        F.when(platform == "topcv", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("hạn nộp hồ sơ: "), date_dmy)).alias("posting_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
    )

