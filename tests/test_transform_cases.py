"""Transform rules on hand-written postings: one sentence per rule, worked out by hand."""

import pytest
from conftest import raw_df
from jobmart.operators.transform import transform_postings, transform_stats

# description -> skills the dictionary must find in it
SKILLS = {
    "You will write SQL every day; Power BI or Tableau dashboards come on top.": {"SQL", "Tableau", "Power BI"},
    "Tools here: Kafka/Airflow, containers on GCP (some AWS).": {"Kafka", "Airflow", "GCP", "AWS"},
    "Models in R - or scikit-learn if you like.": {"R", "Scikit-learn"},
    "Our kitchen needs somebody who can bake bread.": set(),
    "mysqlfan and pythonista are not skills, excellent is not Excel": {"Excel"},
}

# (title, description) -> level, None where nothing tells
LEVELS = [
    (("Senior BI Developer", "Daily reports."), "senior"),
    (("Junior Reporting Clerk", "Daily reports."), "junior"),
    (("Intern, warehouse data", "Six months."), "intern"),
    (("Data Clerk", "Daily reports."), None),
]


def posting(**kw):
    return {"job_title": "Report Writer", "job_description": "Writes reports.", "platform": "board",
            "job_url": "https://jobs.invalid/77", **kw}


@pytest.mark.parametrize("text", list(SKILLS))
def test_skills_found(spark, text):
    row = transform_postings(raw_df(spark, [posting(job_description=text)])).first()
    assert {s.skill_name.lower() for s in row.extracted_skills} == {s.lower() for s in SKILLS[text]}


@pytest.mark.parametrize("label", [None, "not_specified"])
def test_levels(spark, label):
    rows = [posting(job_title=t, job_description=d) for (t, d), _ in LEVELS]
    kw = {"unknown_label": label} if label else {}
    got = {r.ingest_seq: r.seniority_level for r in transform_postings(raw_df(spark, rows), **kw).collect()}
    assert [got[i] for i in range(len(rows))] == [want or label for _, want in LEVELS]


def test_titles_are_kept_as_they_come(spark):
    titles = ["Kế toán trưởng", "  two  spaces  ", "ML/AI (remote)"]
    got = transform_postings(raw_df(spark, [posting(job_title=t) for t in titles])).orderBy("ingest_seq").collect()
    assert [r.job_title for r in got] == titles


def test_labels_inside_the_description_win(spark):
    text = "<b>Công ty: Sao Mai</b> Địa điểm: TPHCM Ngày cập nhật: 02/03/2025 Chi tiết"
    r = transform_postings(raw_df(spark, [posting(job_description=text, company="Other", location="Berlin")])).first()
    assert (r.company_name, r.location, str(r.posted_date)) == ("sao mai", "hồ chí minh", "2025-03-02")


def test_labels_missing_fall_back(spark):
    r = transform_postings(raw_df(spark, [posting(company="Other", location="Berlin")])).first()
    assert (r.company_name, r.location, r.posted_date) == ("Other", "Berlin", None)


def test_rows_without_title_or_description_are_errors(spark):
    raw = raw_df(spark, [posting(), posting(job_title=None), posting(job_description=""), posting(job_title=" ")])
    assert sorted(r.ingest_seq for r in transform_postings(raw).collect()) == [0, 3]      # blanks are not trimmed
    s = transform_stats(raw).first()
    assert (s.total_jobs, s.transformed_jobs, s.errors) == (4, 2, 2)
