"""Relevance and key phrases; expected phrases are worked out by hand."""

from pyspark.sql import functions as F

from jobmart.operators import relevance as R

PHRASES = [
    # most frequent first, ties by first position; short words and stop words don't count
    (1, "Boats boats and more boats sail with sails through the harbour, the harbour where sails dry",
     ["boats", "sails", "more", "sail", "harbour,"]),
    (2, "a text of less than fifty characters", []),
    (3, "the and for with from into about about about about about abc abc abc abc abc abc", []),
    (4, None, []),
    (5, "", []),
    (6, "tree\tTREE\nroot   leaf leaf leaf -- soil soil, stem-stem water water water", ["leaf", "water", "tree", "root", "soil"]),
    (6, "same id, another text: mountains mountains rivers rivers rivers", ["rivers", "mountains", "same", "another", "text:"]),
]


def test_key_phrases(spark):
    df = spark.createDataFrame([(i, t) for i, t, _ in PHRASES], "doc_id int, text string")
    got = sorted((r.doc_id, list(r.key_phrases)) for r in R.key_phrase_lists(df).collect())
    assert got == sorted((i, p) for i, _, p in PHRASES)


def test_key_phrases_never_leave_the_row(spark):
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("x" * 60).alias("text"))
    plan = R.key_phrase_lists(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_keyword_relevance(spark):
    rows = [(1, "Data Analyst", "sql"), (2, "cook", "kitchen"), (3, "analyst", "")]
    df = spark.createDataFrame(rows, "id int, job_title string, job_description string")
    out = {r.id: r.relevant for r in R.keyword_relevance(df, "data analyst").collect()}
    assert out == {1: True, 2: False, 3: True}
    assert R.keyword_relevance(df, "").filter("relevant").count() == 0


def test_semantic_relevance(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "id int, v array<float>")
    out = {r.id: (r.similarity, r.relevant) for r in
           R.semantic_relevance(df, "v", F.array(F.lit(1.0), F.lit(0.2))).collect()}
    assert out[1][1] is True and out[2][1] is False and out[3] == (None, False)


ROWS = [(1, "data analyst", "sql"), (2, "xyz", ""), (3, "", "")]
COLUMNS = "id int, job_title string, job_description string"


def test_semantic_relevance_with_user_embedding(spark):
    def letters(texts):
        return [[t.lower().count(c) for c in "aeiost"] for t in texts]

    out = {r.id: r for r in R.semantic_relevance_text(spark.createDataFrame(ROWS, COLUMNS), letters, "data analyst").collect()}
    assert out[1].relevant is True and out[1].similarity > 0.95
    assert out[2].similarity is None and out[2].relevant is False      # zero vector -> keyword fallback
    assert out[3].relevant is False


def test_whole_texts_are_embedded(spark):
    def marks(texts):
        return [[float("MARK" in t), 1.0] for t in texts]

    df = spark.createDataFrame([(1, "t", "x" * 5000 + "MARK")], COLUMNS)
    assert R.semantic_relevance_text(df, marks, "MARK").first().similarity > 0.99
    assert R.semantic_relevance_text(df, marks, "MARK", chars=500).first().similarity < 0.8


def test_failing_embedding_falls_back_to_keywords(spark):
    def broken(texts):
        raise RuntimeError("no model")

    out = {r.id: r for r in R.semantic_relevance_text(spark.createDataFrame(ROWS, COLUMNS), broken, "data analyst").collect()}
    assert out[1].relevant is True and out[1].similarity is None and out[2].relevant is False
