"""Star load: the original loader case, idempotence, batching, persistence."""

import os

from conftest import SF001, raw_df, shuffled
from jobmart.operators import load as L
from jobmart.operators.transform import transform_postings
from jobmart.sources.postings import derived_postings


def _keys(star):
    jobs = {(r.job_url, r.job_title) for r in star.jobs.collect()}
    skills = {(r.skill_name, r.skill_category) for r in star.skills.collect()}
    links = {(r.job_url, r.skill_name) for r in star.job_skills
             .join(star.jobs.select("job_id", "job_url"), "job_id")
             .join(star.skills.select("skill_id", "skill_name"), "skill_id").collect()}
    desc = {(r.job_url, r.clean_description) for r in star.job_descriptions
            .join(star.jobs.select("job_id", "job_url"), "job_id").collect()}
    return jobs, skills, links, desc


def test_single_job_loaded_with_skills(spark):
    raw = raw_df(spark, [{"job_title": "senior data analyst", "platform": "test_platform",
                          "job_url": "https://example.com/job/123",
                          "job_description": "raw description with sql, python."}])
    star, stats = L.load_batches(spark, [transform_postings(raw)])
    job = star.jobs.first()
    assert job.job_title == "senior data analyst" and job.seniority_level == "senior"
    names = {r.skill_name for r in star.job_skills.join(star.skills, "skill_id").collect()}
    assert names == {"SQL", "Python"}
    assert star.job_descriptions.first().clean_description == "raw description with sql, python."
    assert stats[0].first().jobs_new == 1


def test_duplicate_url_first_wins_and_links_union(spark):
    raw = raw_df(spark, [
        {"job_title": "first", "platform": "p", "job_url": "u1", "job_description": "needs sql"},
        {"job_title": "second", "platform": "p", "job_url": "u1", "job_description": "needs python"},
    ])
    star, _ = L.load_batches(spark, [transform_postings(raw)])
    jobs, skills, links, desc = _keys(star)
    assert jobs == {("u1", "first")}
    assert links == {("u1", "SQL"), ("u1", "Python")}
    assert desc == {("u1", "needs sql")}


def test_load_twice_is_idempotent_and_batches_equal_one(spark):
    tx = transform_postings(derived_postings(spark, SF001)).cache()
    one, _ = L.load_batches(spark, [tx])
    two, _ = L.load_batches(spark, [tx.filter("batch = 0"), tx.filter("batch = 1")])
    again = L.load_star(one, tx)
    shuffled, _ = L.load_batches(spark, [tx.repartition(7, "job_title")])
    k1 = _keys(one)
    assert k1 == _keys(two) == _keys(again) == _keys(shuffled)
    assert one.jobs.count() == one.jobs.select("job_url").distinct().count()


def test_star_store_append_retry_safe(spark, tmp_path):
    tx = transform_postings(derived_postings(spark, SF001))
    store = L.StarStore(spark, str(tmp_path / "star"))
    store.setup()
    store.append(tx.filter("batch = 0"))
    store.append(tx.filter("batch = 1"))
    store.append(tx.filter("batch = 1"))     # a retried batch adds nothing
    mem, _ = L.load_batches(spark, [tx.filter("batch = 0"), tx.filter("batch = 1")])
    assert _keys(store.tables()) == _keys(mem)
    assert L.orphans(store.tables()).filter("orphans > 0").count() == 0


def test_one_pass_ordered_load_equals_sequential(spark):
    raw = derived_postings(spark, SF001)
    tx = transform_postings(raw).cache()
    seq, stats = L.load_batches(spark, [tx.filter("batch = 0"), tx.filter("batch = 1")])
    one = L.load_ordered(raw, ["batch", "ingest_seq"])
    assert _keys(seq) == _keys(one) == _keys(L.load_ordered(raw, ["batch", "ingest_seq"], ("firsts", "skills")))
    by_batch = {r.batch: r.asDict() for r in L.load_stats_by_batch(raw, "batch").collect()}
    for b, st in enumerate(stats):
        want = st.first().asDict()
        got = {k: v for k, v in by_batch[b].items() if k != "batch"}
        assert got == want, (b, got, want)


def test_views_registered_for_sql(spark):
    from jobmart.plans.views import register_views
    star = L.load_ordered(derived_postings(spark, SF001))
    names = register_views(spark, star)
    assert "skill_demand_view" in names
    top = spark.sql("SELECT skill_name, job_count FROM skill_demand_view ORDER BY job_count DESC LIMIT 1").first()
    assert top.job_count > 0
    assert spark.sql("SELECT count(*) AS n FROM job_details_view").first().n == star.jobs.count()


def test_run_batch_end_to_end_and_rerun(spark, tmp_path):
    from jobmart.etl import run_batch
    raw = derived_postings(spark, SF001).drop("batch")
    root = str(tmp_path / "etl")
    first = run_batch(spark, root, raw=raw)
    assert first.transform["total_jobs"] == raw.count()
    assert first.load["jobs_new"] > 0
    again = run_batch(spark, root, raw=raw)
    assert again.load["jobs_new"] == 0 and again.load["job_skills_new"] == 0
    assert spark.sql("SELECT sum(total_jobs) AS n FROM platform_job_count_view").first().n == first.load["jobs_new"]


def test_star_store_recovers_from_a_crash_between_table_writes(spark, tmp_path):
    tx = transform_postings(derived_postings(spark, SF001))
    batch = tx.filter("batch = 0")
    store = L.StarStore(spark, str(tmp_path / "crash"))
    store.setup()
    # a first attempt writes the dimensions and jobs, then dies before the rest
    partial = L.plan_load(store.tables(), batch).new
    for name in ["skills", "jobs"]:
        getattr(partial, name).write.mode("append").parquet(store.path(name))
    store.append(batch)                       # the retry
    clean, _ = L.load_batches(spark, [batch])
    got = store.tables()
    assert _keys(got) == _keys(clean)
    assert got.jobs.count() == got.jobs.select("job_url").distinct().count()
    assert got.job_descriptions.count() == got.jobs.count()


def test_ties_in_the_order_keep_one_whole_row(spark):
    rows = [{"job_title": t, "platform": "p", "job_url": "u", "job_description": d, "ingest_seq": 5}
            for t, d in (("a", "needs sql"), ("b", "needs python"), ("b", "needs python"))]
    star = L.load_ordered(raw_df(spark, rows), ["ingest_seq"])
    job, text = star.jobs.collect(), star.job_descriptions.collect()
    assert len(job) == len(text) == 1
    assert (job[0].job_title, text[0].clean_description) in {("a", "needs sql"), ("b", "needs python")}


def test_append_leaves_no_staging(spark, tmp_path):
    from jobmart.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    store = L.StarStore(spark, str(tmp_path / "clean"))
    store.setup()
    store.append(transform_postings(raw_df(spark, [{"job_title": "t", "platform": "p", "job_url": "u", "job_description": "sql"}])))
    assert set(os.listdir(folder)) - before == set()


def test_user_dictionary_with_one_name_in_two_categories(spark):
    rows = [{"job_title": "t", "platform": "p", "job_url": "u", "job_description": "we use go here"}]
    two = {"a": {"Go": ["golang"]}, "b": {"Go": ["go"], "Here": ["here"]}}
    got = transform_postings(raw_df(spark, rows), skills=two).first().extracted_skills
    assert [s.skill_name for s in got] == ["Go", "Here"]
    assert transform_postings(raw_df(spark, rows), skills={}).first().extracted_skills == []


def test_unreadable_time_is_null_not_now(spark):
    from jobmart.operators.transform import unreadable_times
    rows = [{"job_title": "t", "platform": "p", "job_url": f"u{i}", "job_description": "x", "scraped_at": s}
            for i, s in enumerate(["2025-01-02t03:04:05", "yesterday", None])]
    raw = raw_df(spark, rows)
    got = [r.scraped_at for r in transform_postings(raw).orderBy("ingest_seq").collect()]
    assert str(got[0]) == "2025-01-02 03:04:05" and got[1:] == [None, None]
    assert unreadable_times(raw).first()[0] == 1
    assert transform_postings(raw.drop("scraped_at")).first().scraped_at is not None


# --- the store's layout, narrow first-wins, identity -------------------------------
def _store(spark, path, rows, digits=2):
    store = L.StarStore(spark, str(path), digits)
    store.setup()
    store.append(transform_postings(raw_df(spark, rows)))
    return store


def _posting(i, **kw):
    return {"ingest_seq": i, "job_title": f"title {i}", "platform": "p", "job_url": f"https://x.example/{i}", "job_description": f"sql text {i}", **kw}


def _scanned(df):
    """Partitions and rows that the scans of a finished plan read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            m = node.metrics()
            found.append(tuple(m.apply(k).value() if m.contains(k) else None for k in ("numPartitions", "numOutputRows")))
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_a_batch_reads_its_prefixes_alone(spark, tmp_path):
    store = _store(spark, tmp_path / "s", [_posting(i) for i in range(3000)])
    few = transform_postings(raw_df(spark, [_posting(i, job_title="again") for i in range(0, 3000, 100)]))     # 1% of the keys
    prefixes = store.prefixes_in(few)
    assert len(prefixes) <= 30
    old = store.tables(prefixes)
    for name in ("jobs", "job_descriptions", "job_skills"):
        df = getattr(old, name).select("job_id")
        assert "PartitionFilters: [isnotnull(" in (plan := df._jdf.queryExecution().executedPlan().toString()) or "PartitionFilters: [prefix2" in plan
        (parts, read), = _scanned(df)
        assert parts == len(prefixes) and read < 3000 * 30 / 256 * 2
    # what the batch holds is found there: nothing is added twice
    assert store.append(few).first().jobs_new == 0
    assert store.tables().jobs.count() == 3000
    # one file a prefix and batch
    assert all(len([f for f in files if f.endswith(".parquet")]) <= 2 for _, _, files in os.walk(store.path("jobs")))


def test_a_store_of_another_layout_is_refused(spark, tmp_path):
    _store(spark, tmp_path / "s", [_posting(1)])
    try:
        L.StarStore(spark, str(tmp_path / "s"), 3).setup()
    except ValueError as e:
        assert "prefix2" in str(e)
    else:
        raise AssertionError("a store with other prefixes must be refused")


def test_crash_between_writes_of_the_laid_out_tables(spark, tmp_path):
    batch = transform_postings(raw_df(spark, [_posting(i) for i in range(40)]))
    store = L.StarStore(spark, str(tmp_path / "crash"))
    store.setup()
    partial = L.plan_load(store.tables(), batch).new
    store._write("skills", partial.skills, 1)
    store._write("jobs", partial.jobs, 40)
    store.append(batch)
    got, clean = store.tables(), L.load_batches(spark, [batch])[0]
    assert _keys(got) == _keys(clean) and got.jobs.count() == got.job_descriptions.count() == 40


def test_lookups_skip_files_and_row_groups(spark, tmp_path):
    """One folder for a URL, and Bloom filters that rule row groups out."""
    store = _store(spark, tmp_path / "s", [_posting(i) for i in range(2000)])
    (parts, _), = _scanned(store.jobs_by_url(["https://x.example/77"]))
    assert parts == 1 and store.jobs_by_url(["https://x.example/77"]).first().job_title == "title 77"
    assert store.jobs_by_url(["https://x.example/77x", "https://x.example/1"]).count() == 1
    assert store.skills_by_name(["SQL"]).first().skill_category is not None
    files = [os.path.join(d, f) for n in ("jobs", "skills") for d, _, fs in os.walk(store.path(n)) for f in fs if f.endswith(".parquet")]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        blocks = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, jvm.org.apache.hadoop.fs.Path(f)).getBlocks()
        for b in blocks:
            marked = {c.getPath().toDotString() for c in b.getColumns() if c.getBloomFilterOffset() > 0}
            assert marked == {"job_url" if "/jobs/" in f else "skill_name"}
    # a value inside a file's range that the file does not hold: no row leaves the scan
    whole = spark.read.parquet(store.path("jobs"))
    held = whole.filter("prefix2 = '00'").select("job_url").orderBy("job_url").collect()
    absent = held[0].job_url + "0" if len(held) > 1 else held[0].job_url + "x"
    (_, read), = _scanned(spark.read.parquet(store.path("jobs")).filter(f"prefix2 = '00' and job_url = '{absent}'"))
    assert read == 0


def _first_by_plain_rule(rows):
    best = {}
    for r in rows:
        if r["job_url"] is not None and (r["job_url"] not in best or r["ingest_seq"] < best[r["job_url"]]["ingest_seq"]):
            best[r["job_url"]] = r
    return {u: r["job_title"] for u, r in best.items()}


def test_first_wins_on_narrow_rows(spark):
    """A hot URL, ordinary repeats, ties, one word of marks only, no URL: the same winners."""
    rows = [_posting(i, job_url=None if i % 50 == 0 else "hot" if i % 3 == 0 else f"u{i % 170}") for i in range(600)]
    df = raw_df(spark, rows).repartition(5)
    for words in (L.REPEAT_WORDS, 1):
        got = L.first_per_url(df, words=words).collect()
        assert {r.job_url: r.job_title for r in got} == _first_by_plain_rule(rows) and len(got) == len({r.job_url for r in got})
        assert df.columns == L.first_per_url(df, words=words).columns
    assert L.first_per_url(df.limit(0)).count() == 0
    same = raw_df(spark, [_posting(1)] * 4 + [_posting(1, job_title="other")])
    assert L.first_per_url(same).count() == 1


def test_rows_that_occur_once_are_not_shuffled(spark):
    """Only rows of repeated URLs and narrow rows pass an exchange; no text is under a window but that of ties."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = L.first_per_url(raw_df(spark, [_posting(i, job_url=f"u{min(i, 395)}") for i in range(400)]))
        df.collect()
        found = [("job_description" in names, n) for names, n in shuffled(df)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found and sum(n for text, n in found if text) <= 5 + 1       # the five rows of the repeated URL (and no tie)


def test_jobs_whose_64_bit_hashes_collide_stay_apart(spark, tmp_path, monkeypatch):
    """Ids are 128 bits of the key: rows that agree in every shorter hash Spark offers lose nothing."""
    star, _ = L.load_batches(spark, [transform_postings(raw_df(spark, [_posting(i) for i in range(50)]))])
    assert all(len(r.job_id) == 16 for r in star.jobs.select("job_id").collect())
    # a hash that knows four values only takes the place of the 64-bit one: marks and prefixes collide, rows do not
    real = L.F.xxhash64
    monkeypatch.setattr(L.F, "xxhash64", lambda *c: L.F.pmod(real(*c), L.F.lit(4)).cast("long"))
    store = _store(spark, tmp_path / "s", [_posting(i, job_url=f"u{i % 40}") for i in range(60)], digits=1)
    got = store.tables()
    assert got.jobs.count() == got.job_descriptions.count() == 40
    assert got.job_skills.count() == 40
