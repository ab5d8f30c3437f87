"""The driver contract."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["skill_name", "skill_category", "job_count", "percentage_of_jobs"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
