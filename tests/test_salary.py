"""Golden salary rows (original behaviour, quirks included)."""

import pytest
from pyspark.sql import functions as F

from jobmart.functions.salary import with_salary

GOLDEN = [
    ("10 - 15 triệu", 10000000, 15000000.0),
    ("10.000.000 - 15.000.000 vnđ", 10000000, 15000000.0),
    ("10.5 - 15 triệu", 105000000, 15000000.0),
    ("3-5 years", 3000000, 5000000.0),
    ("2024-01-15", 2024000000, 1000000.0),
    ("3-5 trong", 3000000, 5000000.0),
    ("10,000,000 - 15,000,000 vnd", 0, 15000000.0),
    ("500.000 - 15.000.000 vnd", 500000000000, 15000000000000.0),
    ("up to 15 triệu", 15000000, 18.0),
    ("from 10 triệu - 15 triệu", 10000000, 12.0),
    ("10 triệu - 15 triệu", 10000000, 15000000.0),
    ("10tr-15tr", 10000000, 15000000.0),
    ("10 triệu đến 15 triệu", 10000000, 12000000.0),
]


def test_golden_rows(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in GOLDEN] + [("thỏa thuận",)], "t string")
    out = with_salary(df.select(F.lower("t").alias("t")), "t").collect()
    for (text, lo, hi), r in zip(GOLDEN, out):
        assert (r.salary_min, r.salary_max, r.salary_currency) == (lo, pytest.approx(hi), "vnd"), text
    none = out[-1]
    assert (none.salary_min, none.salary_max, none.salary_currency) == (None, None, "VND")


def test_overflow_is_flagged(spark):
    df = spark.createDataFrame([("9" * 25 + " triệu",)], "t string")
    r = with_salary(df, "t").first()
    assert r.salary_overflow is True and r.salary_min is None


def test_strict_reads_commas(spark):
    df = spark.createDataFrame([("10,000,000 - 15,000,000 vnd",), ("up to 15 triệu",)], "t string")
    out = with_salary(df, "t", strict=True).collect()
    assert (out[0].salary_min, out[0].salary_max) == (10000000, 15000000.0)
    assert out[1].salary_max == pytest.approx(18000000.0)
