"""A two-file stream gives the same star as loading the two batches."""

from conftest import SF001

import __spark_entry__ as E
from jobmart.operators import load as L
from jobmart.operators.transform import transform_postings
from jobmart.sources.postings import derived_postings


def test_stream_equals_batches(spark):
    jobs = E.queries()["incremental_ingest"](spark, SF001)
    tx = transform_postings(derived_postings(spark, SF001))
    mem, _ = L.load_batches(spark, [tx.filter("batch = 0"), tx.filter("batch = 1")])
    want = {(r.job_url, r.job_title, r.seniority_level) for r in mem.jobs.collect()}
    got = {(r.job_url, r.job_title, r.seniority_level) for r in jobs.collect()}
    assert got == want
