"""Skills by a dictionary table: both ways against each other, the projection and the plain rule."""

import random
import re

from conftest import raw_df
from jobmart import dictionaries as D
from jobmart.operators import skills as S
from jobmart.operators.transform import transform_postings

ENTRIES = "entry_order int, skill_name string, skill_category string, keyword string"


def rows_of(df):
    return sorted((r.ingest_seq, r.skill_pos, r.skill_name, r.skill_category) for r in df.collect())


def both(spark, postings, dictionary):
    one = rows_of(S.extract_skills_by_table(postings, dictionary, automaton=True))
    assert one == rows_of(S.extract_skills_by_table(postings, dictionary, automaton=False))
    return one


def plainly(texts, entries):
    """Whole-word search of every keyword in every text."""
    out = []
    for i, text in enumerate(texts):
        best = {}
        for order, name, category, keyword in entries:
            if not keyword:
                continue
            k = keyword.lower()
            left = r"(?<!\w)" if re.match(r"\w", k) else r"(?<=\w)"
            right = r"(?!\w)" if re.search(r"\w$", k) else r"(?=\w)"
            if re.search(left + re.escape(k) + right, text.lower()):
                e = (order, category is not None, category or "", name)
                best[name] = min(best.get(name, e), e)
        out += [(i, pos, e[3], e[2] if e[1] else None) for pos, e in enumerate(sorted(best.values()))]
    return sorted(out)


def test_both_ways_equal_the_projection(spark):
    texts = ["Needs SQL, Power BI and node.js; 5+ years of C++ or R", "mysqlfan pythonista excellent Excel", "tỉ mỉ, giao tiếp", "a/b testing (GCP)", ""]
    postings = raw_df(spark, [{"job_title": "Senior " + t[:9], "platform": "p", "job_url": f"u{i}", "job_description": t or "none"} for i, t in enumerate(texts)])
    entries = [(o, n, k, kw) for o, n, k, kws in D.skill_entries() for kw in kws]
    found = both(spark, postings, spark.createDataFrame(entries, ENTRIES))
    want = sorted((r.ingest_seq, i, s.skill_name, s.skill_category)
                  for r in transform_postings(postings).collect() for i, s in enumerate(r.extracted_skills))
    assert found == want and len(found) > 8


def test_boundaries_overlaps_and_odd_entries(spark):
    texts = ["go golang go+ +go c++ c++x x.net .net net", "ab abc bc b_c", "é éa ²x ² x²", "aaa aa a", "deep learning deep-learning", "日本語 日本", "x" * 200_000 + " go"]
    entries = [(0, "Go", "l", "go"), (1, "Plus", "l", "++"), (2, "Net", None, ".net"), (2, "Net", "z", "net"), (3, "Bc", "l", "bc"), (3, "Bc", "a", "b_c"),
               (4, "E", "l", "É"), (5, "Two", "l", "²"), (6, "A", "l", "a"), (6, "AA", "l", "aa"), (7, "DL", "l", "deep learning"), (8, "Go", "late", "golang"),
               (9, "Jp", "l", "日本"), (10, "None", "l", None), (11, "Empty", "l", ""), (12, "Cpp", "l", "c++"), (13, "Cpp", "l", "c++x")]
    postings = raw_df(spark, [{"job_title": "t", "platform": "p", "job_url": f"u{i}", "job_description": t} for i, t in enumerate(texts)])
    dictionary = spark.createDataFrame(entries, ENTRIES)
    assert both(spark, postings, dictionary) == plainly([t + " t" for t in texts], entries)
    assert both(spark, postings, dictionary.limit(0)) == [] == both(spark, postings.limit(0), dictionary)
    assert both(spark, raw_df(spark, [{"job_title": None, "job_description": "go"}]), dictionary) == []


def test_fifty_thousand_keywords(spark):
    rng = random.Random(7)
    syllables = ["ka", "lo", "mi", "re", "tu", "vex", "zor", "pin", "qua", "sy"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 5)))          # noqa: E731
    entries = [(i, f"Skill {i // 2}", f"cat {i % 7}", " ".join(word() for _ in range(rng.choice([1, 1, 2])))) for i in range(50_000)]
    texts = [" ".join(word() if rng.random() < 0.8 else rng.choice(entries)[3] for _ in range(60)) for _ in range(30)]
    postings = raw_df(spark, [{"job_title": "t", "platform": "p", "job_url": f"u{i}", "job_description": t} for i, t in enumerate(texts)])
    dictionary = spark.createDataFrame(entries, ENTRIES)
    found = both(spark, postings, dictionary)
    # the plain rule over words: every keyword is one or two words of letters
    by_words = {}
    for e in entries:
        by_words.setdefault(e[3], []).append(e)
    want = []
    for i, t in enumerate(texts):
        words = (t + " t").split()
        best = {}
        for k in [*words, *map(" ".join, zip(words, words[1:]))]:
            for order, name, category, _ in by_words.get(k, ()):
                best[name] = min(best.get(name, (order, category, name)), (order, category, name))
        want += [(i, pos, e[2], e[1]) for pos, e in enumerate(sorted(best.values()))]
    assert found == sorted(want) and len(found) > 500


def test_no_text_in_the_anchor_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        postings = raw_df(spark, [{"job_title": "t", "platform": "p", "job_url": "u", "job_description": "sql here"}]).repartition(2)
        df = S.extract_skills_by_table(postings, spark.createDataFrame([(0, "SQL", "l", "sql")], ENTRIES), automaton=False)
        plan = df._jdf.queryExecution().executedPlan()
        todo, texts = [plan], []
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange":
                names = [node.output().apply(i).name() for i in range(node.output().size())]
                texts.append(("anchor" in node.outputPartitioning().toString(), "_text" in names))
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        assert any(a for a, _ in texts) and not any(a and t for a, t in texts)
        assert sum(t for _, t in texts) == 1                     # the text meets its candidates once
        fast = S.extract_skills_by_table(postings, spark.createDataFrame([(0, "SQL", "l", "sql")], ENTRIES), automaton=True)
        assert "hashpartitioning" not in fast._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
