"""Distributed rank, statistics in the same pass, sketches, raw reader, unreadable dates."""

import json
import random

from conftest import SF001, raw_df
from pyspark.sql import functions as F

from jobmart.operators import crawl as C
from jobmart.operators import load as L
from jobmart.operators.rank import distributed_rank
from jobmart.operators.transform import observed_transform, transform_postings, transform_stats
from jobmart.plans import views as V
from jobmart.schemas import CORRUPT
from jobmart.sources.frontier import derived_frontier
from jobmart.sources.postings import derived_postings
from jobmart.sources.raw import read_raw


def test_distributed_rank(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"k{i % 11}", rng.randint(0, 40), i) for i in range(3000)] + [(None, 1, 1), (None, 0, 5)]
    got = distributed_rank(spark.createDataFrame(rows, "k string, page int, pos int").repartition(5), ["k"], ["page", "pos"])
    want = {}
    for k in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1:]), 1):
            want[r] = n
    found = {(r.k, r.page, r.pos): r["rank"] for r in got.collect()}
    assert {k: v for k, v in found.items() if k[0] is not None} == {k: v for k, v in want.items() if k[0] is not None}
    assert len(found) == len(rows) and got.columns == ["k", "page", "pos", "rank"]
    assert distributed_rank(got.drop("rank").limit(0), ["k"], ["page", "pos"]).count() == 0


def test_uncapped_crawl_has_no_window_over_a_walk(spark):
    frontier = derived_frontier(spark, SF001).drop("crawl")              # three walks, each a third of the links
    df = C.crawl_cap(frontier, None, None)
    windows = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in x]
    assert windows and all("_part" in w.split("windowspecdefinition(")[1] for w in windows)
    ranks = {}
    for r in df.collect():
        ranks.setdefault(r.platform, []).append(((r.page, r.pos), r["rank"]))
    assert len(ranks) == 3
    for places in ranks.values():
        assert [n for _, n in sorted(places)] == list(range(1, len(places) + 1))


def test_stats_are_counted_in_the_pass_that_stages_the_rows(spark, tmp_path):
    from jobmart.etl import run_batch
    seen = spark.sparkContext.accumulator(0)
    raw = derived_postings(spark, SF001).drop("batch")
    rows = [r.asDict() for r in raw.limit(200).collect()]
    rows.append({**rows[0], "ingest_seq": 10**9, "job_url": "new", "job_description": "lương " + "9" * 30 + " triệu - 1" + "0" * 30 + " triệu"})

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.createDataFrame(rows, raw.schema)
    stats = run_batch(spark, str(tmp_path / "s"), raw=df.mapInPandas(counted, df.schema), register=False)
    assert seen.value == len(rows)                                      # one scan of the source
    plain = transform_stats(df).first().asDict()
    assert stats.transform == plain
    over = transform_postings(df).filter("salary_overflow").count()
    assert over == 1 and plain["total_jobs"] == len(rows) and plain["errors"] == len(rows) - plain["transformed_jobs"] + over


def test_observation_of_a_lazy_transform(spark):
    rows, seen = observed_transform(derived_postings(spark, SF001))
    n = rows.count()
    assert seen.get["transformed_jobs"] == n and seen.get["total_jobs"] == derived_postings(spark, SF001).count()


def test_sketches_merge_within_their_error(spark):
    n = 40_000
    jobs = spark.range(n).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("job_id"),
                                 F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("posted_date"), "id")
    skills = spark.createDataFrame([(b"a", "A", "x"), (b"b", "B", "x")], L.STAR["skills"])
    links = jobs.select("job_id", F.lit(b"a").alias("skill_id")).unionByName(jobs.filter("id % 4 = 0").select("job_id", F.lit(b"b").alias("skill_id")))
    star = L.StarTables(jobs, skills, links.unionByName(links), None)     # links twice: nothing counts twice
    sketches = V.job_sketches(star, 12)
    assert sketches.count() == 18                                         # a row a skill and day
    bound = 3 * 1.04 / 4096 ** 0.5
    for keys, want in ((["skill_name"], {"A": n, "B": n // 4}), (["date"], None), ([], None)):
        for r in V.distinct_jobs(sketches, *keys).collect():
            exact = want[r.skill_name] if want else n / (9 if keys else 1)
            assert abs(r.job_count - exact) <= bound * exact


def test_rows_that_do_not_fit_the_schema(spark, tmp_path):
    good = {"ingest_seq": 1, "platform": "p", "job_url": "u", "job_title": "t", "job_description": "needs sql", "extra": [1]}
    lines = [json.dumps(good), json.dumps(good)[:-9], "no json", json.dumps({**good, "ingest_seq": "x"}), "{}", json.dumps({**good, "job_url": None}), ""]
    (tmp_path / "f.json").write_text("\n".join(lines))
    rows = read_raw(spark, str(tmp_path)).cache()
    assert rows.filter(F.col(CORRUPT).isNotNull()).count() == 3
    stats = transform_stats(rows).first()
    assert (stats.total_jobs, stats.transformed_jobs, stats.errors) == (6, 1, 5)
    done = transform_postings(rows).collect()
    assert [r.job_url for r in done] == ["u"] and done[0].extracted_skills[0].skill_name == "SQL"


def test_a_stream_skips_broken_lines(spark, tmp_path):
    from jobmart.streaming.ingest import ingest_available
    src = tmp_path / "in"
    src.mkdir()
    rows = [{"ingest_seq": i, "platform": "p", "job_url": f"u{i}", "job_title": "t", "job_description": "sql"} for i in range(5)]
    (src / "a.json").write_text("\n".join([json.dumps(r) for r in rows] + ['{"job_url": "u9", "job_title"']))
    store = ingest_available(spark, str(src), str(tmp_path / "star"), str(tmp_path / "ck"), fmt="json")
    assert {r.job_url for r in store.tables().jobs.collect()} == {f"u{i}" for i in range(5)}


def test_unreadable_dates_are_one_null_group(spark):
    dates = ["hạn nộp hồ sơ: 01/02/2025", "01/02/2025", "hôm qua", "32/13/2025", None, "", "  ", "soon"]
    raw = raw_df(spark, [{"job_title": "t", "platform": "p", "job_url": f"u{i}", "job_description": "x", "posting_date": d} for i, d in enumerate(dates)])
    got = {str(r.date): r.daily_job_count for r in V.postings_over_time(L.load_ordered(raw, ["ingest_seq"])).collect()}
    assert got == {"2025-02-01": 2, "None": 3}




def test_release_deletes_what_was_staged(spark):
    import os
    from jobmart.session import materialize, release, stage
    kept = materialize(spark.range(3))
    _, path = stage(spark.range(2))
    assert kept.count() == 3 and os.path.isdir(path.removeprefix("file:"))
    assert release(spark) >= 2 and not os.path.isdir(path.removeprefix("file:")) and release(spark) == 0
