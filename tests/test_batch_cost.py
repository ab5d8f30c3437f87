"""What a batch costs on its way into the store: texts are copied once, keywords looked up once a token."""

import re

from pyspark.sql import functions as F

from conftest import raw_df
from jobmart import dictionaries as D
from jobmart.functions import enrich as E
from jobmart.functions import salary as SA
from jobmart.functions import text as TX
from jobmart.operators import load as L
from jobmart.operators.transform import transform_postings


def _rows(spark, urls):
    return transform_postings(raw_df(spark, [
        {"platform": "topcv", "job_url": u, "job_title": "Data Analyst", "job_description": f"<p>SQL {i}</p>"} for i, u in enumerate(urls)]))


def _staged_by(spark, tmp_path, monkeypatch, urls):
    names, stage = [], L.stage
    monkeypatch.setattr(L, "stage", lambda df, name="stage": (names.append(name), stage(df, name))[1])
    store = L.StarStore(spark, str(tmp_path / "star"))
    store.setup()
    stats = store.append(_rows(spark, urls)).first()
    return names, stats, store.tables()


def test_texts_without_repeated_urls_are_staged_once(spark, tmp_path, monkeypatch):
    names, stats, star = _staged_by(spark, tmp_path, monkeypatch, ["u1", "u2", "u3"])
    assert "firsts" not in names and "job_descriptions" not in names
    assert (stats.jobs_new, stats.job_skills_new) == (3, 3)
    assert sorted(r.clean_description for r in star.job_descriptions.collect()) == ["sql 0", "sql 1", "sql 2"]


def test_repeated_urls_keep_the_first_text(spark, tmp_path, monkeypatch):
    names, stats, star = _staged_by(spark, tmp_path, monkeypatch, ["u1", "u2", "u1"])
    assert "firsts" in names and stats.jobs_new == 2
    assert sorted(r.clean_description for r in star.job_descriptions.collect()) == ["sql 0", "sql 1"]


def test_skills_are_looked_up_by_token(spark):
    df = spark.createDataFrame([("sql and power bi, node.js",), ("",), (None,), ("no tech",)], "t string")
    df = df.select("t", TX.word_tokens(F.col("t")).alias("k"))
    out = df.select("t", E.extract_skills(F.col("t"), tokens=F.col("k")).alias("s"), E.extract_skills(F.col("t")).alias("p"))
    plan = df.select(E.extract_skills(F.col("t"), tokens=F.col("k")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("arrays_overlap") < len(D.skill_entries())      # one a skill before
    rows = out.collect()
    assert [r.s for r in rows] == [r.p for r in rows]
    assert [x.skill_name for x in rows[0].s] == ["SQL", "JavaScript", "Power BI"]


def test_a_name_of_two_categories_is_listed_once(spark):
    skills = {"a": {"X": ["one"], "Y": ["two"]}, "b": {"X": ["three", "one two"]}}
    df = spark.createDataFrame([("one two three",), ("three",), ("two",)], "t string").select("t", TX.word_tokens(F.col("t")).alias("k"))
    rows = df.select(E.extract_skills(F.col("t"), skills, tokens=F.col("k")).alias("s")).collect()
    assert [[x.skill_name for x in r.s] for r in rows] == [["X", "Y"], ["X"], ["Y"]]


TEXTS = ["10 - 15 triệu", "a1.5.2 -3", "12..5tr 7", "x 9 9 tr", "1-", "2020-01-02 5  triệu", "up to 7tr", "from  3 . 4 vnd", "3 5 - 6 tr 7",
         "5 tr - 6 vnđ", ".5.-.6 7 vnd", "000000001 2", "1 2-3 4 tr", "12 đến 15", "0" * 3000, None]


def test_patterns_without_backtracking_find_the_same(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert "++" in SA._eager(SA.PATTERNS[0][0]) or "*+" in SA._eager(SA.PATTERNS[0][0])
    for i, (p, _, _) in enumerate(SA.PATTERNS):
        for r in df.select("t", F.regexp_extract("t", p, 0).alias("a"), F.regexp_extract("t", SA._eager(p), 0).alias("b")).collect():
            assert r.a == r.b, (i, r)


def test_only_runs_that_change_are_replaced(spark):
    texts = ["a b", "a  b", "a\tb", " \t a\n\nb ", "a b", "　 x", "a  ", " ", "", "y" * 99 + " " + "z" * 100 + "  " + "w" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", F.regexp_replace("t", TX.WS_RUN, " ").alias("a"), F.regexp_replace("t", TX.WS_RUN_TO_CHANGE, " ").alias("b"),
                       TX.clean_description(F.col("t")).alias("c")).collect():
        assert r.a == r.b, r
        kept = " ".join(w for w in re.sub(r"\s+", " ", r.t.lower()).split(" ") if w and len(w) < 100)
        assert (r.c or "") == kept


def test_levels_and_skills_are_searched_only_where_tokens_point(spark):
    texts = ["phó giám đốc 5+x", "lead", "5 năm sql server", "xphó giám đốc", "tập trung", "power bix, a power bi", "3+ 3+a", "a++b c", "", None,
             "thực tập sinh, trưởng nhóm", "\U0001d400power bi", "num py"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", TX.word_tokens(F.col("t")).alias("k"))
    levels = {**D.SENIORITY_LEVELS, "odd": ["++", "a++"]}
    skills = {**D.SKILL_DICTIONARY, "odd": {"Plus": ["++"], "SQL": ["a++b"]}}
    out = df.select("t", *[f(F.col("t"), d, tokens=k).alias(f"{n}{i}") for n, f, d in (("l", E.detect_seniority, levels), ("s", E.extract_skills, skills))
                           for i, k in enumerate((None, F.col("k")))])
    rows = out.collect()
    assert [(r.t, r.l0, r.s0) for r in rows] == [(r.t, r.l1, r.s1) for r in rows]
    assert [r.l1 for r in rows][:5] == ["director_vp", "manager_lead", "senior", "director_vp", None]
    plan = df.select(E.detect_seniority(F.col("t"), tokens=F.col("k")).alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" not in plan                 # one or two a level before


def test_new_rows_go_to_their_tables_without_a_copy(spark, tmp_path, monkeypatch):
    names, stats, star = _staged_by(spark, tmp_path, monkeypatch, ["u1", "u2", "u3"])
    assert "jobs" not in names and "job_skills" not in names          # both were staged before
    store = L.StarStore(spark, str(tmp_path / "star"))
    again = store.append(_rows(spark, ["u2", "u4", "u4", None])).first()
    assert (again.jobs_inserted, again.jobs_new, again.job_skills_new, again.job_skills_linked, again.skills_inserted) == (3, 1, 1, 3, 0)
    assert again.asDict().keys() == stats.asDict().keys()
    assert store.tables().jobs.count() == store.tables().job_skills.count() == 4


def test_first_category_of_a_skill_needs_no_sort_of_all_links(spark):
    links = [(4, 0, "u", 0, "SQL", "late"), (None, 0, "u", 1, "SQL", "unplaced"), (2, 0, "u", 1, "R", "second"), (2, 0, "u", 0, "R", "first"),
             (1, 1, "u", 0, "R", "next batch"), (3, 0, "u", 5, "Go", None)]
    ex = spark.createDataFrame(links, "ingest_seq long, batch long, job_url string, pos int, skill_name string, skill_category string")
    got = L._star_of(None, ex, ["batch", "ingest_seq"]).skills
    assert {r.skill_name: r.skill_category for r in got.collect()} == {"SQL": "unplaced", "R": "first", "Go": None}
    lines = L._star_of(None, ex, ["ingest_seq"]).skills._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert "HashAggregate" in [x for x in lines if "Aggregate" in x][-1]      # the one next to the links


def _links_batch(spark, rows):
    """Processed postings with these URLs and skill names."""
    return _rows(spark, [u for u, _ in rows]).drop("extracted_skills").join(
        spark.createDataFrame([(i, [(n, "c") for n in names]) for i, (_, names) in enumerate(rows)],
                              "i long, extracted_skills array<struct<skill_name: string, skill_category: string>>"),
        F.col("clean_description") == F.concat(F.lit("sql "), F.col("i").cast("string"))).drop("i")


def test_links_of_a_batch_without_repeated_urls_are_not_shuffled_to_tell_them_apart(spark, tmp_path, monkeypatch):
    names, stage = [], L.stage
    monkeypatch.setattr(L, "stage", lambda df, name="stage": (names.append(name), stage(df, name))[1])
    store = L.StarStore(spark, str(tmp_path / "star"))
    store.setup()
    first = store.append(_links_batch(spark, [("u1", ["SQL", "R", "SQL", "", None]), ("u2", []), ("u3", ["R"])])).first()
    assert "links" not in names                         # staged, behind a shuffle, before
    assert (first.job_skills_linked, first.job_skills_new, first.skills_inserted) == (4, 3, 2)
    again = store.append(_links_batch(spark, [("u1", ["SQL", "Go"]), ("u4", ["R", "R"])])).first()
    assert "links" not in names and (again.jobs_new, again.job_skills_linked, again.job_skills_new, again.skills_inserted) == (1, 4, 2, 1)
    repeated = store.append(_links_batch(spark, [("u5", ["SQL"]), ("u5", ["SQL", "R"])])).first()
    assert "links" in names and (repeated.jobs_new, repeated.job_skills_linked, repeated.job_skills_new) == (1, 3, 2)
    star = store.tables()
    got = sorted((r.job_url, r.skill_name) for r in star.job_skills.join(star.jobs, "job_id").join(star.skills, "skill_id").collect())
    assert got == sorted([("u1", "SQL"), ("u1", "R"), ("u1", "Go"), ("u3", "R"), ("u4", "R"), ("u5", "SQL"), ("u5", "R")])


def test_keys_meet_the_stored_ones_without_an_aggregate(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    stored = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    got = L._not_loaded(batch, stored, ["k"])
    assert sorted(r.v for r in got.collect()) == [3, 4]
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()      # one of the batch's keys before


def test_dates_are_read_by_a_cast(spark):
    texts = ["29/02/2024", "29/02/2023", "31/04/2020", "00/01/2020", "1997-03-12", "1997-13-12", "0000-01-01", "01/02/2020\n", " 2020-01-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(E.parse_date(F.col("t")).alias("d"), F.try_to_date("t", "yyyy-MM-dd").alias("iso"), "t")
    got = {r.t: str(r.d) for r in df.filter("t not like '0000%'").collect() if r.d is not None}
    assert got == {"29/02/2024": "2024-02-29", "1997-03-12": "1997-03-12"}
    assert df.filter("t like '0000%' and d <=> iso").count() == 1
    assert "gettimestamp" not in df.select("d")._jdf.queryExecution().optimizedPlan().toString().lower()     # a parser by pattern before
