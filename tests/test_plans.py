"""Scale properties of the physical plans (guards against regressions)."""

import re

from conftest import SF001, raw_df, shuffled
from jobmart.operators import crawl as C
from jobmart.operators import load as L
from jobmart.operators import relevance as R
from jobmart.operators.transform import transform_postings
from jobmart.sources.frontier import derived_frontier
from jobmart.sources.tables import table


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_limited_map_side_under_a_hot_url(spark):
    # a third of the rows share one URL; without broadcasts by size, as on large tables
    rows = [{"job_title": f"t{i}", "platform": "p", "job_description": "sql",
             "job_url": "hot" if i % 3 == 0 else f"u{i}"} for i in range(300)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jobs = L.load_ordered(raw_df(spark, rows), ["ingest_seq"]).jobs
        plan = _plan(jobs)
        # no window and no sorting aggregate over texts; later rows of the hot URL fall away before any exchange
        assert "Window" not in plan and "SortAggregate" not in plan
        text = L.first_per_url(raw_df(spark, rows))
        text.collect()
        assert max(n for names, n in shuffled(text) if "job_description" in names) <= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot = jobs.filter("job_url = 'hot'").collect()
    assert len(hot) == 1 and hot[0].job_title == "t0"


def test_key_phrases_are_counted_inside_the_row(spark):
    assert "Exchange" not in _plan(R.key_phrases(table(spark, SF001, "documents")))


def test_crawl_cap_is_limited_before_the_shuffle(spark):
    # without broadcasts, as on large tables; one walk per platform, each with a third of the links
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(C.crawl_cap(derived_frontier(spark, SF001).drop("crawl"), 20, 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    limits = [x for x in plan.splitlines() if "WindowGroupLimit" in x]
    assert any("Partial" in x for x in limits) and any("20, Final" in x for x in limits)


def test_scans_read_only_needed_columns(spark):
    plan = _plan(R.word_frequency(table(spark, SF001, "documents")))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_incremental_append_does_not_shuffle_history(spark, tmp_path):
    from jobmart.session import materialize
    from jobmart.sources.postings import derived_postings
    tx = transform_postings(derived_postings(spark, SF001))
    store = L.StarStore(spark, str(tmp_path / "hist"))
    store.setup()
    store.append(tx.filter("batch = 0"))
    jobs = L.plan_load(store.tables(), materialize(tx.filter("batch = 1"))).new.jobs
    # the static plan (adaptive execution off): a small staged batch's keys are
    # broadcast for their size in bytes, not after history was already shuffled
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        final = jobs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [x for x in final.splitlines() if "LeftAnti" in x], "rows must be checked against the stored table"
    semi = [x for x in final.splitlines() if "LeftSemi" in x]
    assert semi and all("BroadcastHashJoin" in x for x in semi)
    # the stored table's key column is scanned, never under a hash exchange
    lines = final.splitlines()
    scans = [i for i, x in enumerate(lines) if re.search(r"FileScan parquet \[job_url#\d+\]", x)]
    assert scans
    for i in scans:
        assert not any("Exchange hashpartitioning" in x for x in lines[max(0, i - 3):i])


def test_transform_stages_fit_the_jit(spark):
    """The JVM never compiles methods of more than 8,000 bytes of code."""
    import re

    from conftest import raw_df
    from jobmart.operators.transform import transform_postings
    df = transform_postings(raw_df(spark, [{"platform": "p", "job_url": "u", "job_title": "t", "job_description": "d"}]))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000
