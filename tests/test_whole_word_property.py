"""Whole-word matching (token intersection + boundary regex) equals Python's
re.search(r'\\bKW\\b', text) for every dictionary keyword, on generated text."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobmart import dictionaries as D
from jobmart.functions import enrich as E
from jobmart.functions import text as TX

KEYWORDS = sorted({k for _, _, _, kws in D.skill_entries() for k in kws}
                  | {k for kws in D.SENIORITY_LEVELS.values() for k in kws})
PIECES = KEYWORDS + ["", " ", "  ", " ", "　", "_", "-", ".", "+", "/", ",", "(", ")",
                     "x", "é", "ữ", "9", "3", "5", "năm", "\n", "\t"]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=12).map("".join),
                min_size=200, max_size=200))
def test_whole_word_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    tokens = E.keyword_hits(TX.word_tokens(F.col("t")), [KEYWORDS])
    checks = [TX.has_whole_word(F.col("t"), [k], F.col("_tok")).alias(f"k{j}")
              for j, k in enumerate(KEYWORDS)]
    rows = df.select("i", "t", tokens.alias("_tok")).select("i", "t", *checks).collect()
    for r in rows:
        for j, k in enumerate(KEYWORDS):
            want = re.search(rf"\b{re.escape(k)}\b", r.t) is not None
            assert r[f"k{j}"] == want, (k, r.t)
