"""Idempotent star-schema load.

Identity: ``job_id`` and ``skill_id`` are the 128-bit MD5 of the natural key, so ids are
computed in parallel from natural keys, never by a global counter, a later batch
finds an existing row's id without reading it back (J03/J04), and two URLs do not share an
id at any number of rows that fits on disks (at 10^12 rows the chance is 10^-15).

First-wins without row order: the first order of every URL is found on narrow rows (URL and
order), and only rows whose URL repeats are looked at again; a row whose URL occurs once
never has its text shuffled, and one URL that holds a third of all rows meets only
aggregates that combine before the shuffle.  Rows are picked before they are enriched.

Loading appends only: new rows are the batch minus what exists (semi-join of the
stored keys with the batch keys, then ``left_anti``); nothing is
read-modified-written.  Tables that hold a job's key are laid out by a prefix of its id,
and a batch reads only the prefixes it has keys in.  Dimensions are written before facts so a
retried batch re-derives exactly the missing rows.
"""

from __future__ import annotations

import hashlib
import os
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import STAR
from ..session import drop_staged, materialize, stage

JOB_COLUMNS = [f.name for f in STAR["jobs"].fields]


class StarTables(NamedTuple):
    jobs: DataFrame
    skills: DataFrame
    job_skills: DataFrame
    job_descriptions: DataFrame


def empty_star(spark: SparkSession) -> StarTables:
    """K05 in memory: the four tables with no rows.  ``limit(0)`` makes the
    emptiness visible to the optimizer, which then removes the joins against
    them instead of computing the batch side of a join with nothing."""
    return StarTables(*[spark.createDataFrame([], STAR[name]).limit(0) for name in StarTables._fields])


def job_id(url: Column) -> Column:
    return F.unhex(F.md5(url))


def _job_id_of(df: DataFrame) -> Column:
    """The job's id; a batch that was staged with it does not hash its URLs again."""
    return (F.col("job_id") if "job_id" in df.columns else job_id(F.col("job_url"))).alias("job_id")


def skill_id(name: Column) -> Column:
    return F.unhex(F.md5(name))


def _keys_ok(df: DataFrame) -> Column:
    """NOT NULL columns of ``jobs``: a row missing one is ignored."""
    return (F.col("platform_job_id").isNotNull() & F.col("platform").isNotNull()
            & F.col("job_url").isNotNull() & F.col("job_title").isNotNull())


# Keys are marked in bitmaps of 64 * REPEAT_WORDS bits, sent to all executors as (word, bits) rows,
# one a word at most: their size is bounded however many keys there are.  Where they are so many that
# other keys share their bits, more rows take the way of the marked ones.
REPEAT_WORDS = 1 << 18


def _bitmap(key: Column, words: int) -> tuple[Column, Column]:
    """(word, bit) of a hashed key."""
    return F.pmod(key, F.lit(words)), F.pmod(F.shiftright(key, 32), F.lit(64)).cast("int")


def _marks(keys: DataFrame, key: Column, words: int, name: str) -> DataFrame:
    """The bitmap of a frame's keys."""
    word, bit = _bitmap(key, words)
    return keys.groupBy(word.alias(f"{name}_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(f"{name}_bits"))


def _with_mark(rows: DataFrame, marks: DataFrame, key: Column, words: int, name: str) -> DataFrame:
    """``rows`` with column ``name``: whether their key may be in the bitmap."""
    word, bit = _bitmap(key, words)
    hit = F.call_function("shiftright", F.col(f"{name}_bits"), F.col(f"{name}_bit")).bitwiseAND(1) == 1
    return (rows.select("*", word.alias(f"{name}_word"), bit.alias(f"{name}_bit")).join(F.broadcast(marks), f"{name}_word", "left")
            .withColumn(name, F.coalesce(hit, F.lit(False))).drop(f"{name}_word", f"{name}_bit", f"{name}_bits"))


def first_per_url(rows: DataFrame, order: list[str] | None = None, words: int = REPEAT_WORDS) -> DataFrame:
    """The earliest row (by ``order``, default ingest_seq) per job_url; rows without a URL are left out.

    Two jobs read URLs and orders alone: the first marks the URLs that repeat in a bitmap, the second finds the
    first order of every marked URL and marks those.  Of the whole rows, those of unmarked URLs are
    kept as they are, later rows of marked URLs fall away where they were read, and only marked first rows are
    compared with the exact list.  Without repeated URLs, or without ties, those steps are not in the plan.  Whole
    rows are kept, so all columns come from the same posting.  Rows that share URL and
    order are told apart by their content, the same way every time."""
    return _first_per_url(rows, order, words)[0]


def _first_per_url(rows: DataFrame, order: list[str] | None, words: int = REPEAT_WORDS) -> tuple[DataFrame, list[str]]:
    """``first_per_url`` and the folders that its rows read."""
    order = order or ["ingest_seq"]
    rows = rows.filter(F.col("job_url").isNotNull())
    url, place = F.xxhash64("job_url"), F.xxhash64("job_url", *order)
    at = F.struct(*[F.col(c) for c in order])
    narrow = rows.select("job_url", *order)
    repeated, url_path = stage(_marks(narrow.groupBy("job_url").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), url, words, "_url"), "repeated")
    if repeated.isEmpty():
        return rows, [url_path]
    winners, win_path = stage(
        _with_mark(narrow, repeated, url, words, "_url").filter("_url")
        .groupBy("job_url", at.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("job_url").agg(F.min(F.struct("_at", "_n")).alias("_first")).select("job_url", "_first._at", "_first._n"), "winners")
    firsts = _marks(winners, F.xxhash64("job_url", *[F.col(f"_at.{c}") for c in order]), words, "_place")
    marked = _with_mark(rows, repeated, url, words, "_url")
    once = marked.filter(~F.col("_url")).select(*rows.columns)
    again = (_with_mark(marked.filter("_url"), firsts, place, words, "_place").filter("_place")
             .withColumn("_at", at).join(winners, ["job_url", "_at"]))
    if winners.filter("_n > 1").isEmpty():
        return once.unionByName(again.select(*rows.columns)), [url_path, win_path]
    text = [c for c in ("platform", "job_title", "job_description", "raw_description") if c in rows.columns]
    by_content = Window.partitionBy("job_url").orderBy(F.xxhash64(*text))
    ties = again.filter("_n > 1").withColumn("_n", F.row_number().over(by_content)).filter("_n = 1")
    return (once.unionByName(again.filter("_n = 1").select(*rows.columns)).unionByName(ties.select(*rows.columns)),
            [url_path, win_path])


def exploded_skills(processed: DataFrame) -> DataFrame:
    """(ingest_seq, [batch], job_url, pos, skill_name, skill_category) per posting skill."""
    # posexplode_outer + a filter, not posexplode: for an inner generator the
    # optimizer infers size(array) > 0 and pushes it below the projection, which
    # would evaluate the whole skill extraction twice.
    keep = ["ingest_seq"] + [c for c in ["batch"] if c in processed.columns] + ["job_url"] + [c for c in ["job_id"] if c in processed.columns]
    return (processed.select(*keep, F.posexplode_outer("extracted_skills").alias("pos", "s"))
            .select(*keep, "pos", "s.skill_name", "s.skill_category")
            .filter(F.col("skill_name").isNotNull() & (F.col("skill_name") != "")))


def _not_loaded(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` (J05, insert-or-ignore).

    Only the key columns of the stored table are read; they are reduced to the batch's
    keys first, so what meets the batch's wide rows is never larger than the batch.
    Spark broadcasts the batch's keys when they are small in bytes and shuffles keys
    otherwise.  With empty tables the optimizer prunes both joins."""
    hits = existing.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(hits, keys, "left_anti")


class LoadResult(NamedTuple):
    new: StarTables           # rows to append
    stats: DataFrame          # A09, one row
    staged: list[str]         # folders that both read


def plan_load(existing: StarTables, processed: DataFrame, order: list[str] | None = None, staged: bool = False) -> LoadResult:
    """Rows a batch adds to each table, given what the tables hold already.

    ``order`` (default ``["ingest_seq"]``) decides first-wins inside the batch.  The first
    postings are staged, for two tables read them; of a batch that is ``staged`` itself and repeats no
    URL, they are its own rows and are not written once more.  Where URLs repeat, a staged batch's links are staged too,
    for they meet the stored ones twice; otherwise a posting's links are its own, and nothing is shuffled to tell them apart."""
    accepted = processed.filter(_keys_ok(processed))
    ex = exploded_skills(accepted)
    picked, read = _first_per_url(accepted, order)
    # without a list of winners no URL repeats
    once = len(read) == 1
    firsts, paths = (picked, []) if staged and once else _staged_firsts(picked)
    drop_staged(processed.sparkSession, read)
    batch = _star_of(firsts, ex, order or ["ingest_seq"])
    if staged and once:
        batch = batch._replace(job_skills=_own_links(accepted))
    elif staged:
        links, path = stage(batch.job_skills, "links")
        batch, paths = batch._replace(job_skills=links), [*paths, path]
    new = StarTables(
        jobs=_not_loaded(batch.jobs, existing.jobs, ["job_url"]),               # K01
        skills=_not_loaded(batch.skills, existing.skills, ["skill_name"]),      # K03
        job_skills=_not_loaded(batch.job_skills, existing.job_skills, ["job_id", "skill_id"]),      # K04
        job_descriptions=_not_loaded(batch.job_descriptions, existing.job_descriptions, ["job_id"]))  # K02
    # The original counts every accepted row for jobs, descriptions and links
    # (an ignored duplicate still "succeeds"); skills count only new ones.
    return LoadResult(new, _load_stats(processed, ex, new.jobs, new.skills, new.job_skills), paths)


def _staged_firsts(picked: DataFrame) -> tuple[DataFrame, list[str]]:
    firsts, path = stage(picked, "firsts")
    return firsts, [path]


def _own_links(postings: DataFrame) -> DataFrame:
    """The links of postings whose URLs do not repeat: distinct in the row, so distinct."""
    names = postings.select(_job_id_of(postings), F.explode_outer(F.array_distinct("extracted_skills.skill_name")).alias("skill_name"))
    return (names.filter(F.col("skill_name").isNotNull() & (F.col("skill_name") != ""))
            .select("job_id", skill_id(F.col("skill_name")).alias("skill_id")))


def _star_of(firsts: DataFrame | None, ex: DataFrame, order: list[str]) -> StarTables:
    """The four tables' rows from the first posting of every URL and the postings' skills."""
    *lead, last = order
    # the first order of a skill, category and position is one number, which needs no sort of all links; a null
    # order comes first, and ``min`` passes over it
    seen = (ex.groupBy("skill_name", "skill_category", "pos", *lead, F.col(last).isNull().alias("_none")).agg(F.min(last).alias(last))
            .groupBy("skill_name").agg(F.min_by("skill_category", F.struct(*order, "pos")).alias("skill_category")))
    return StarTables(
        jobs=firsts and firsts.select(_job_id_of(firsts), *[c for c in JOB_COLUMNS if c != "job_id"]),
        # category of the first sighting sticks
        skills=seen.select(skill_id(F.col("skill_name")).alias("skill_id"), "skill_name", "skill_category"),
        # every accepted posting links its skills, duplicates of a URL included
        job_skills=ex.select(_job_id_of(ex), skill_id(F.col("skill_name")).alias("skill_id")).distinct(),
        # the first posting's text
        job_descriptions=firsts and firsts.select(_job_id_of(firsts), "raw_description", "clean_description"))


def load_ordered(raw: DataFrame, order: list[str] = ("batch", "ingest_seq"),
                 staged: tuple[str, ...] = (), jobs: bool = True, **transform_opts) -> StarTables:
    """Batches of raw postings loaded in ``batch`` order into empty tables, in one pass.

    Loading batch after batch keeps the first row per key in (batch, ingest_seq)
    order, so with empty tables it equals one first-wins pass over all batches.
    The first posting of every URL is picked from the raw rows, and only those are
    enriched for ``jobs`` and ``job_descriptions``; all postings' skills are
    extracted for the links.  ``staged`` ("firsts", "skills") names what is written once
    for reports that read it more than once; the rest of the plan stays lazy, and a
    report computes only the columns it reads.  ``jobs=False`` leaves out the tables of the first
    postings (None) for reports that read skills and links alone."""
    from .transform import essential_ok, transform_postings

    order = list(order)
    accepted = raw.filter(essential_ok(raw))
    firsts = first_postings(raw, order, **transform_opts) if jobs else None
    ex = exploded_skills(transform_postings(accepted, **transform_opts))
    if "firsts" in staged and jobs:
        firsts = materialize(firsts, "firsts")
    if "skills" in staged:
        ex = materialize(ex, "skills")
    return _star_of(firsts, ex, order)


def first_postings(raw: DataFrame, order: list[str] = ("batch", "ingest_seq"), **transform_opts) -> DataFrame:
    """The processed first posting of every URL: what ``jobs`` and ``job_descriptions`` hold of an ordered load."""
    from .transform import essential_ok, transform_postings

    return transform_postings(first_per_url(raw.filter(essential_ok(raw)), list(order)), **transform_opts)


def load_stats_by_batch(raw: DataFrame, batch: str = "batch", **transform_opts) -> DataFrame:
    """A09 for every batch of a sequential load into empty tables: a row, skill, URL or
    link is new in the batch where it is first seen.  Rows are read once for their
    keys and once for their skills; both are staged, narrow, and counted from there."""
    from .transform import essential_ok, transform_postings

    # what the transform rejects never reaches the load; its errors are rows without a key
    ok = F.col("platform").isNotNull() & F.col("job_url").isNotNull() & F.col("job_title").isNotNull()
    rows_ = materialize(raw.filter(essential_ok(raw)).select(batch, "job_url", ok.alias("ok")), "stats-rows")
    ex = materialize(exploded_skills(transform_postings(raw, **transform_opts)).select(batch, "job_url", "skill_name"),
                     "stats-skills")

    def new_in(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return (df.groupBy(*keys).agg(F.min(batch).alias(batch))
                .groupBy(batch).agg(F.count(F.lit(1)).alias(name)))

    counts = rows_.groupBy(batch).agg(F.count(F.when(F.col("ok"), 1)).alias("jobs_inserted"),
                                      F.count(F.when(~F.col("ok"), 1)).alias("errors"))
    linked = ex.groupBy(batch).agg(F.count(F.lit(1)).alias("job_skills_linked"))
    out = (counts.join(new_in(ex, ["skill_name"], "skills_inserted"), batch, "left")
           .join(linked, batch, "left")
           .join(new_in(rows_.filter("ok"), ["job_url"], "jobs_new"), batch, "left")
           .join(new_in(ex, ["job_url", "skill_name"], "job_skills_new"), batch, "left"))
    zero = F.lit(0).cast("long")
    return out.select(
        F.col(batch).cast("long").alias("batch"), "jobs_inserted",
        F.col("jobs_inserted").alias("job_descriptions_inserted"),
        F.coalesce("skills_inserted", zero).alias("skills_inserted"),
        F.coalesce("job_skills_linked", zero).alias("job_skills_linked"),
        F.coalesce("jobs_new", zero).alias("jobs_new"),
        F.coalesce("job_skills_new", zero).alias("job_skills_new"),
        "errors")


def _load_stats(processed: DataFrame, ex: DataFrame, new_jobs: DataFrame,
                new_skills: DataFrame, new_links: DataFrame) -> DataFrame:
    # each count is a one-row aggregate; they are combined as scalar subqueries
    return _stats_row(_batch_counts(processed, ex, new_skills), new_jobs.select(F.count(F.lit(1))).scalar(),
                      new_links.select(F.count(F.lit(1))).scalar())


def _batch_counts(processed: DataFrame, ex: DataFrame, new_skills: DataFrame) -> DataFrame:
    """The counts that are known before jobs and links are compared with the stored ones, one row."""
    ok = _keys_ok(processed)
    rows = processed.agg(F.count(F.when(ok, 1)).alias("jobs_inserted"),
                         F.count(F.when(~ok, 1)).alias("errors"))
    return rows.select("*", new_skills.select(F.count(F.lit(1))).scalar().alias("skills_inserted"),
                       ex.select(F.count(F.lit(1))).scalar().alias("job_skills_linked"))


def _stats_row(counts: DataFrame, jobs_new: Column, job_skills_new: Column) -> DataFrame:
    return counts.select(
        "jobs_inserted",
        F.col("jobs_inserted").alias("job_descriptions_inserted"),
        "skills_inserted", "job_skills_linked",
        jobs_new.alias("jobs_new"),
        job_skills_new.alias("job_skills_new"),
        "errors",
    )


def union_star(a: StarTables, b: StarTables) -> StarTables:
    return StarTables(*[x.unionByName(y) for x, y in zip(a, b)])


def load_star(existing: StarTables, processed: DataFrame) -> StarTables:
    """The tables after appending one batch (lazy; nothing is written)."""
    return union_star(existing, plan_load(existing, processed).new)


def load_batches(spark: SparkSession, batches: list[DataFrame]) -> tuple[StarTables, list[DataFrame]]:
    """Load batches in order into empty tables; return the tables and per-batch stats."""
    state = empty_star(spark)
    stats = []
    for b in batches:
        res = plan_load(state, b)
        stats.append(res.stats)
        state = union_star(state, res.new)
    return state, stats


def orphans(star: StarTables) -> DataFrame:
    """Rows whose declared foreign key has no parent, per relation."""
    js_jobs = star.job_skills.join(star.jobs.select("job_id"), "job_id", "left_anti")
    # one skill may be in a third of all links: Spark broadcasts the skills when they are
    # small in bytes and splits the skewed side otherwise
    js_skills = star.job_skills.join(star.skills.select("skill_id"), "skill_id", "left_anti")
    desc_jobs = star.job_descriptions.join(star.jobs.select("job_id"), "job_id", "left_anti")
    return (js_jobs.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit("job_skills.job_id").alias("relation"), "orphans")
            .unionByName(js_skills.agg(F.count(F.lit(1)).alias("orphans"))
                         .select(F.lit("job_skills.skill_id").alias("relation"), "orphans"))
            .unionByName(desc_jobs.agg(F.count(F.lit(1)).alias("orphans"))
                         .select(F.lit("job_descriptions.job_id").alias("relation"), "orphans")))


# ---------------------------------------------------------------------------
# Persistent store: four Parquet tables under one root (K05 + appends)
# ---------------------------------------------------------------------------
class StarStore:
    """Parquet-backed star schema.  ``append`` is safe to retry: every table
    only receives rows whose key it lacks, and a batch never reads files it is
    writing: the batch is staged as Parquet in the checkpoint folder
    before any write, and the stored tables are read by the files listed before.

    ``jobs``, ``job_descriptions`` and ``job_skills`` lie in folders by the first ``digits`` hex digits of
    the job's id (16 ** digits folders, all about equally large): one digit up to some 10^8 jobs, two to 10^10,
    three beyond, so that a folder holds several files.  A batch and a lookup read the folders of their
    keys alone.  Files of ``jobs`` and ``skills`` carry Bloom filters on URL and name, sized by the rows written."""

    WRITE_ORDER = ["skills", "jobs", "job_descriptions", "job_skills"]
    COUNTED = ["jobs", "job_skills"]          # while they are written
    LOOKUP = {"jobs": "job_url", "skills": "skill_name"}

    def __init__(self, spark: SparkSession, root: str, digits: int = 1):
        self.spark = spark
        self.root = root
        self.digits = digits
        self.prefix = f"prefix{digits}"

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def setup(self) -> None:
        """Create the four tables when absent; a store laid out with other prefixes is refused."""
        for name, schema in STAR.items():
            p = self.path(name)
            if not _exists(self.spark, p):
                self._write(name, self.spark.createDataFrame([], schema), 0)
            other = [f for f in _folders(self.spark, p) if f.startswith("prefix") and not f.startswith(self.prefix + "=")]
            if other:
                raise ValueError(f"{p} is laid out as {other[0].split('=')[0]}, not {self.prefix}")

    def prefix_of(self, job_id: Column) -> Column:
        return F.lower(F.substring(F.hex(job_id), 1, self.digits))

    def _read(self, name: str) -> DataFrame:
        schema = STAR[name] if name == "skills" else T.StructType([*STAR[name].fields, T.StructField(self.prefix, T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path(name))

    def tables(self, prefixes: list[str] | None = None) -> StarTables:
        """The tables; with ``prefixes``, only the folders of these are read."""
        def read(name: str) -> DataFrame:
            df = self._read(name)
            if name == "skills":
                return df
            return (df if prefixes is None else df.filter(F.col(self.prefix).isin(prefixes))).drop(self.prefix)
        return StarTables(*[read(n) for n in StarTables._fields])

    def prefixes_in(self, batch: DataFrame) -> list[str]:
        """The prefixes of a batch's URLs, at most 16 ** digits."""
        rows = batch.select(self.prefix_of(_job_id_of(batch)).alias("p")).distinct().collect()
        return sorted(r.p for r in rows if r.p is not None)

    def jobs_by_url(self, urls: list[str]) -> DataFrame:
        """The jobs of these URLs, read from their prefixes' folders, row groups without them skipped."""
        jobs = self._read("jobs")
        where = [hashlib.md5(u.encode()).hexdigest()[:self.digits] for u in urls]
        return jobs.filter(F.col(self.prefix).isin(where) & F.col("job_url").isin(urls)).drop(self.prefix)

    def skills_by_name(self, names: list[str]) -> DataFrame:
        """The skills of these names."""
        return self._read("skills").filter(F.col("skill_name").isin(names))

    def append(self, processed: DataFrame) -> DataFrame:
        """Load one batch of processed postings; returns its A09 stats (collected
        already, one row) as a DataFrame.

        The batch is staged, with the jobs' ids, and each stored table is read only in the batch's prefixes.  New jobs,
        descriptions and links go from the batch to their tables without a copy between; jobs and links are counted by the
        tasks that write them.  The staging folders go when the batch is written."""
        batch, path = stage(processed.withColumn("job_id", job_id(F.col("job_url"))), "batch")
        load = plan_load(self.tables(self.prefixes_in(batch)), batch, staged=True)
        skills, skills_path = stage(load.new.skills, "skills")
        counts = _batch_counts(batch, exploded_skills(batch.filter(_keys_ok(batch))), skills)
        row = counts.first()                    # one row of counts
        # a batch has no more new jobs than accepted rows
        filters = {"jobs": row.jobs_inserted, "skills": row.skills_inserted}
        written = {n: Observation(n) for n in self.COUNTED}
        for n in self.WRITE_ORDER:
            self._write(n, skills if n == "skills" else getattr(load.new, n), filters.get(n, 0), written.get(n))
        drop_staged(self.spark, [path, *load.staged, skills_path])
        new = [F.lit(written[n].get["n"]).cast("long") for n in self.COUNTED]
        return _stats_row(self.spark.createDataFrame([row], counts.schema), *new)

    def _write(self, name: str, rows: DataFrame, count: int, written: Observation | None = None) -> None:
        """Append rows to a table: about one file a prefix, more where a prefix has many rows; ``count``, the most
        they can be, sizes the Bloom filters.  ``written`` counts them."""
        if name != "skills":
            rows = rows.withColumn(self.prefix, self.prefix_of(F.col("job_id"))).hint("rebalance", self.prefix)
        if written is not None:
            # behind the exchange: a task that writes counts once, however often what it reads is computed
            rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
        out = rows.write.mode("append")
        if name in self.LOOKUP:
            a_file = 64 + (2 * count // 16 ** self.digits if name == "jobs" else count)
            out = (out.option(f"parquet.bloom.filter.enabled#{self.LOOKUP[name]}", "true")
                   .option(f"parquet.bloom.filter.expected.ndv#{self.LOOKUP[name]}", str(a_file)))
        (out if name == "skills" else out.partitionBy(self.prefix)).parquet(self.path(name))


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in p.getFileSystem(conf).listStatus(p) if s.isDirectory()]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)
