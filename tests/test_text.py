"""Text functions against their Python definitions."""

from urllib.parse import quote_plus, urljoin

from pyspark.sql import functions as F

from jobmart.functions import text as TX

SAMPLES = ["hello \u00a0  world\u200b", "  a\tb\nc  ", "", None, "x\u2003y\u3000z\x85", "<b>bold</b>text <i>x</i>"]


# expected outputs, written out by hand from the rules in SURVEY 2.9 / 2.12
NORMALIZED = ["hello world", "a b c", "", "", "x y z", "<b>bold</b>text <i>x</i>"]
HTML_CLEANED = ["hello world", "a b c", "", "", "x y z", "boldtext x"]


def test_normalize_and_clean_html(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    out = df.select(TX.normalize_text(F.col("s")).alias("n"), TX.clean_html(F.col("s")).alias("h")).collect()
    assert [r.n for r in out] == NORMALIZED
    assert [r.h for r in out] == HTML_CLEANED


def test_clean_description(spark):
    long_word = "x" * 120
    keep_word = "y" * 99
    texts = ["<p>Công ty: ACME</p>  Chi tiết  nộp đơn  " + long_word + " end " + keep_word, "Chia sẻ", "",
             "A B  <br/>C", "chi  tiết stays", "Gợi Ýtext"]
    expected = ["công ty: acme end " + keep_word, None, None, "a b c", "stays", "text"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r.c for r in df.select(TX.clean_description(F.col("t")).alias("c")).collect()]
    assert out == expected


def test_truncate(spark):
    texts = ["short", "x" * 600]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r.c for r in df.select(TX.truncate_text(F.col("t"), 500).alias("c")).collect()]
    assert out == ["short", "x" * 497 + "..."]


def test_quote_plus_matches_python(spark):
    qs = ["Data Analyst", "c++ & c#", "a*b~c", "phân tích dữ liệu", "x/y?z=1"]
    df = spark.createDataFrame([(q,) for q in qs], "q string")
    out = [r.e for r in df.select(TX.quote_plus(F.col("q")).alias("e")).collect()]
    assert out == [quote_plus(q) for q in qs]


def test_normalize_url_matches_urljoin(spark):
    urls = ["", "https://other.example/a", "//cdn.example/x//y", "/job/1", "?page=2", "#top",
            "job/2", "../up/3", "./here", "/x//y", "a//b", "/a/./b/../c?q=1#f", "sub/",
            " /x", "\n/x", "a\tb", "x?", "?", "?a=1#", "/x#", "x;", "http://h/?", "https://www.careerviet.vn?#", "mailto:a@b", "\x01"]
    for base in ["https://www.careerviet.vn/viec-lam/tim?x=1#f", "https://host", "http://h/a//b/c",
                 "https://vieclam24h.vn/tim-kiem-viec-lam-nhanh?", ""]:
        df = spark.createDataFrame([(u,) for u in urls], "u string")
        out = [r.n for r in df.select(TX.normalize_url(F.col("u"), base).alias("n")).collect()]
        assert out == [urljoin(base, u) if u else "" for u in urls], base


def test_malformed_hosts_are_empty(spark):
    df = spark.createDataFrame([("http://[bad?",), (" http://[bad",)], "u string")
    assert [r.n for r in df.select(TX.normalize_url(F.col("u"), "https://h/").alias("n")).collect()] == ["", ""]


def test_whole_word_rules(spark):
    df = spark.createDataFrame([("5+ years",), ("5+years",), ("tỉ mỉ, careful",), ("pythonic code",)], "t string")
    out = df.select(
        F.col("t").rlike(TX.whole_word_pattern(["5+"])).alias("p5"),
        F.col("t").rlike(TX.whole_word_pattern(["tỉ mỉ"])).alias("tm"),
        F.col("t").rlike(TX.whole_word_pattern(["python"])).alias("py")).collect()
    assert [r.p5 for r in out] == [False, True, False, False]
    assert [r.tm for r in out] == [False, False, True, False]
    assert [r.py for r in out] == [False, False, False, False]


def test_normalize_url_on_random_urls(spark):
    """Native resolution equals urljoin on any mix of schemes, hosts, dots, parameters, blanks; no Python worker."""
    import random
    rng = random.Random(4)
    parts = ["", "a", "b.html", "..", ".", "c;p", "d;", "x y", "é", ":", "//", "/", "?", "#", "q=1", "http:", "https:", "mailto:", "HTTP:",
             "//h", "//H:80", "//[::1]", "//[bad", "\t", " ", "\n", ";", "ftp:", "foo:", "a/b/", "?x=1", "#f", "../", "./"]

    def some():
        return "".join(rng.choice(parts) for _ in range(rng.randint(0, 7)))
    bases = ["https://host", "http://h/a//b/c", "http://h/a/b/;p?q", "rel/path", "//h/x", "mailto:x", "http://h/..", "HTTP://X/y/./z/../w;k?j"]
    rows = [(rng.choice(bases) if rng.random() < 0.7 else some(), some()) for _ in range(2500)]

    def joined(b, u):
        try:
            return urljoin(b, u) if u else ""
        except ValueError:
            return ""
    df = spark.createDataFrame(rows, "b string, u string").select("b", "u", TX.normalize_url(F.col("u"), F.col("b")).alias("n"))
    assert [(r.b, r.u, r.n) for r in df.collect()] == [(b, u, joined(b, u)) for b, u in rows]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
