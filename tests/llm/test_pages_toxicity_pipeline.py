"""HTML extraction, WARC, toxicity and the pipeline."""

import base64
import gzip
import hashlib
import io
import itertools

import numpy as np
import pyarrow.parquet as pq
import pytest

from jobmart.llm import html_extract as H
from jobmart.llm import toxicity, warc

PAGES = "page_id long, url string, html string, record_type string"
SF001 = "/root/testdata/sf0.001"


# --- HTML --------------------------------------------------------------------------------
def test_blocks_of_broken_markup():
    text = lambda h: [t for t, _ in H.leaf_blocks(h)]
    assert text("<p>a &amp; b<p>c<br>d<script>x</script>e<!-- no --> f") == ["a & b", "c", "de f"]
    assert text("<p>a<b>b</p>c <i>d</i>\n  e") == ["ab", "c d e"]
    assert text("<title>t</title><div>x</div><style>y") == ["x"]
    assert text("1 < 2 <b") == ["1 < 2"] and text("") == [] and text("&#x41;&nbsp;&eacute;") == ["A é"]
    assert len(text("<p>x" * 10_000)) == 10_000
    assert text("<div>" * 5000 + "deep") == ["deep"]
    assert text("<a href='>'>q</a><a title=\"x>") == ["q"]


def test_blocks_after_open_heads_and_unclosed_controls():
    text = lambda h: [t for t, _ in H.leaf_blocks(h)]
    art = "<article><p>main</p></article>"
    for head in ("<head><title>T</title>", "<HEAD><meta charset=x><style>s</style><script>'<p>'</script>", "<head/>", "<Head><title>t</title></Head>",
                 "<head><title>T</title></head>", "<head><noscript><p>n</p></noscript><link rel=a><body>"):
        assert text("<html>" + head + art) == ["main"], head
    for tag in ("svg", "math", "button", "select", "object", "template"):
        assert text(f"<nav><{tag}>x</nav>{art}") == ["main"], tag
        assert text(f"<{tag}>x{art}<{tag}>y</{tag}>{art}") == ["main", "main"], tag
        assert text(f"<div>a <{tag}><b>x</b><i>y</{tag}> b</div>{art}") == ["a b", "main"], tag
        assert text(f"<p>a<{tag}><div>x<p>y</{tag}>b</p>{art}") == ["ab", "main"], tag
    assert text(f"<nav>a<svg class='i'/>b</nav>{art}<svg><path d='m'/></svg>") == ["ab", "main"]
    assert text(f"<svg><title/><style/><g><text>x</text></svg>{art}<math/>z") == ["main", "z"]
    assert text(f"<svg><title>x</svg>{art}") == ["main"]
    assert text(f"<p>a<select><option>x<option>y<optgroup><option>z</select>b</p>{art}") == ["ab", "main"]
    assert text(f"<select><option>x<option>y{art}") == ["main"] and text(f"<button>x<button>y</button>z{art}") == ["z", "main"]
    assert text("<textarea><p>x</textarea>a<iframe><p>x</iframe>b<noscript><p>x</noscript>c<title><p>x</title >d") == ["abcd"]
    assert text(f"<button><button>x</button>{art}" * 2000) == ["main"] * 2000


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(0)
    model = H.Crf({}, 0.0, rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2))
    for n in (1, 2, 6):
        s = rng.normal(size=n).tolist()

        def value(y):
            return (model.start[y[0]] + model.end[y[-1]] + sum(x for x, b in zip(s, y) if b)
                    + sum(model.move[a, b] for a, b in zip(y, y[1:])))
        assert model.decode(s) == [bool(b) for b in max(itertools.product((0, 1), repeat=n), key=value)]


def test_held_out_layouts_and_planted_parts():
    model = H.default_model()
    wrong = total = 0
    for blocks, labels in H.labelled_pages(200, 4242):
        got = model.decode(model.scores(blocks))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.01
    page = ("<html><head><title>T</title></head><body><header><p>Site name and motto</p></header><nav><a href=/>Home</a></nav>"
            "<div class='cookie-notice'><p>We use cookies to make this site better for you.</p></div>"
            "<article><h1>Head &amp; line</h1><p>First   paragraph\nof the text.</p><div class=ad>Buy this now, it is cheap.</div>"
            "<p>Second paragraph, a little longer than the first one.</p></article>"
            "<aside><h3>More</h3><p>Another story that you may want to read.</p></aside>"
            "<section class='comments'><p>I do not agree with this text at all.</p></section>"
            "<form><label>Your mail</label><input></form><footer>&copy; Someone</footer></body></html>")
    assert H.main_text(page, model) == "Head & line\nFirst paragraph of the text.\nSecond paragraph, a little longer than the first one."


INNER = ("<h1>Head line of it</h1><p>First paragraph of the text, long enough to be one.</p><p>Second paragraph, a little longer than the "
         "first one.</p><ul><li><a href=/a>Item with a link</a></li></ul>")


@pytest.mark.parametrize("article", [
    "<article>", '<article class="post popular">', '<article class="review">', '<article data-id="ad-12">', '<article class="post has-comments">',
    '<article class="tag-news">', '<article title="id=comment">', '<div class="post" data-class="comments-on">', "", "<main id=content>",
    "<!--><article>", "<!---><article>", "<!-- x --!><article>", '<article xclass="sidebar" class=story>'])
@pytest.mark.parametrize("body", ["<body>", '<body class="page has-sidebar">', '<body id="sidebar-right" class="widget">'])
def test_ordinary_pages_keep_their_article(article, body):
    end = {"d": "</div>", "m": "</main>", "": ""}.get(article[1:2], "</article>")
    page = (f"<html><head><title>T</title></head>{body}<nav><a href=/>Home</a></nav>{article}{INNER}{end}"
            "<section class='comments'><p>I do not agree with this text at all.</p></section><footer>&copy; Someone</footer></body></html>")
    assert H.main_text(page, H.default_model()) == ("Head line of it\nFirst paragraph of the text, long enough to be one.\n"
                                                    "Second paragraph, a little longer than the first one.\nItem with a link")


def test_pages_of_nothing_but_text():
    model = H.default_model()
    for page in ("Just some plain text without any markup, in one piece.", "<p>One paragraph only, nothing around it.</p>"):
        assert H.main_text(page, model) == page.replace("<p>", "").replace("</p>", "")
    long = "<article><h1>Long one</h1>" + "<p>A paragraph of the long page, again.</p>" * 30_000 + "</article>"
    assert H.main_text(f"<nav><a href=/>x</a></nav>{long}", model).count("\n") == 30_000


def test_paragraphs_close_however_deep_the_inline_markup():
    assert [t for t, _ in H.leaf_blocks("<p>a" + "<b>" * 40 + "b<p>c")] == ["ab", "c"]
    assert "t=p" in H.leaf_blocks("<p>" + "<i>" * 30 + "x<div>y</div>")[0][1] and "t=p" not in H.leaf_blocks("<p>" + "<i>" * 30 + "x<div>y</div>")[1][1]


def test_extract_real_pages(spark):
    df = spark.read.parquet(f"{SF001}/pages.parquet")
    got = H.extract(df).toPandas()
    assert len(got) == df.count()
    raw = pq.read_table(f"{SF001}/pages.parquet").to_pandas().set_index("page_id")["html"]
    for r in got.itertuples():
        body = raw[r.page_id].split("<article>")[1].split("</article>")[0]
        assert r.text == "\n".join(t for t, _ in H.leaf_blocks(body)) and r.n_chars == len(r.text)


def test_extract_edge_rows(spark):
    rows = [(1, "u", None, ""), (1, "u", "", ""), (None, None, "<nav>x</nav>", ""), (2, "u", "plain", "")]
    got = H.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 4 and [r.n_chars for r in got][:2] == [0, 0]
    assert H.extract(spark.createDataFrame([], PAGES)).count() == 0


# --- WARC --------------------------------------------------------------------------------
def sha(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://a/ b", "same", "x"), (2, "u2", "same", "x"), (3, None, None, "x"), (4, "u4", "", "x"), (5, "u5", "ünïque 😀" * 9000, "x"),
            (6, "u6", "WARC/1.1\r\n\r\nnot a header", "x"), (None, "u7", "same", "x")]
    rows += [(100 + k, f"h{k}", "hot payload", "x") for k in range(300)]
    folder = warc.write_archives(spark.createDataFrame(rows, PAGES), str(tmp_path / "w"), archive_bytes=2000)
    got = warc.read_archives(spark, folder).toPandas()
    assert len(got) == len(rows) and got["archive"].nunique() > 3
    have = {(None if np.isnan(r.page_id) else int(r.page_id)): r for r in got.itertuples()}
    last = {}
    for i, _, h, _ in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    for i, _, h, _ in rows:
        r, response = have[i], last[h or ""] == i
        assert r.payload_bytes == len((h or "").encode()) and r.payload_digest == sha(h)
        assert r.record_type == ("response" if response else "revisit")
        assert (np.isnan(r.refers_to) if response else r.refers_to == last[h or ""])
        assert (bytes(r.payload).decode() if response else r.payload) == ((h or "") if response else None)
    files = sorted((tmp_path / "w" / "archives").glob("*.warc.gz"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)      # any gzip reader can read them
    assert whole.count(b"WARC-Record-ID: ") == len(rows)


def test_reader_refuses_damage():
    record = warc.encode_record("1", "u", b"payload", None, False)
    assert next(warc.members(io.BytesIO(record + record)))[:8] == b"WARC/1.1"
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(record[:-9])))
    raw = next(warc.members(io.BytesIO(record)))
    for bad in (raw.replace(b"payload", b"pauload"), raw.replace(b"\r\n\r\n", b"\r\n\r\n\r\n", 1), b"GIF89a"):
        with pytest.raises((ValueError, KeyError)):
            warc.parse_record(bad)


def test_warc_repeats_and_empty(spark):
    same = spark.createDataFrame([(7, "u", "x", ""), (7, "u", "x", ""), (6, "u", "x", "")], PAGES)
    assert sorted(r.record_type for r in warc.round_trip(same).collect()) == ["response", "response", "revisit"]
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


# --- toxicity ------------------------------------------------------------------------------
def test_chain_learns_and_uses_earlier_categories():
    rng = np.random.default_rng(5)
    words = np.array([f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)])
    texts, labels = [], []
    for i in range(900):
        junk, toxic = i % 5 == 0, i % 7 == 0
        t = list(rng.choice(words, 60)) + ["junkmark"] * junk + [["vileword", "vilething"][i % 2]] * toxic
        texts.append(" ".join(t))
        labels.append((junk, toxic))
    labels = np.array(labels, int)
    found = [np.array(sorted(toxicity.features(t)), "<i8") for t in texts]
    chain = toxicity.fit_chain(found[:600], labels[:600], np.arange(600) % 3)
    p = np.array([toxicity.apply_chain(chain, t) for t in texts[600:]])
    assert ((p > 0.5) == labels[600:]).mean() > 0.97
    assert len(chain[0].earlier) == 0 and len(chain[1].earlier) == 1
    copied = np.column_stack([labels[:600, 0], labels[:600, 0]])     # a category that only the one before tells
    blank = [np.zeros(0, "<i8")] * 600
    assert toxicity.fit_chain(found[:600], copied, np.arange(600) % 3)[1].earlier[0] > 0
    assert toxicity.fit_chain(blank, labels[:600], np.arange(600) % 3)[0].weights == {}


def test_classify_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.classify(docs, labels).toPandas().set_index("doc_id")
    truth = labels.toPandas().groupby("doc_id")["toxic"].max()
    agree = (got["toxic"].reindex(truth.index) == (truth == 1))
    assert len(got) == docs.count() and agree.mean() > 0.98


def test_a_label_counts_where_the_others_are_null(spark):
    rng = np.random.default_rng(8)
    words = np.array([f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)])
    docs, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        docs.append((i, " ".join([*rng.choice(words, 30), *["vileword"] * toxic])))
        if i < 400:      # no toxic row has a quality, and some rows have nothing else
            labels += [(i, None, int(toxic))] if i % 2 == 0 else [(i, i % 3 % 2, None)] if i % 3 else [(i, None, None), (i, 1, 0)]
    got = toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 600 and {r.doc_id for r in got if r.toxic} == set(range(0, 600, 4))


def test_toxicity_edges(spark):
    schema = "doc_id long, text string, toxic string"
    docs = spark.createDataFrame([(1, None, "x"), (None, "text", "x"), (2, "", "x"), (2, "", "x")], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.classify(docs, none).filter("toxic").count() == 0
    one = spark.createDataFrame([(1, 1, 0), (2, None, 1), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(docs, one).count() == 4
    assert toxicity.drop_toxic(docs, one).columns == ["doc_id", "text", "toxic"]


# --- pipeline --------------------------------------------------------------------------------
def test_pipeline_stages(spark):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        out = P.materialize(stage(spark, docs, SF001), "test-" + name)
        assert out.schema.simpleString() == docs.schema.simpleString()
        docs = out
        sizes.append(out.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1]
    packed = P.STAGES[-1][1](spark, docs, SF001).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024
    assert set(packed["doc_id"]) == {r.doc_id for r in docs.select("doc_id").collect()}


def test_queries_are_registered():
    import __spark_entry__ as E
    names = [k for k in E.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_clean_rows_keep_a_column_named_like_the_helper(spark):
    docs = spark.createDataFrame([(i, f"plain words number {i}", "own", "more") for i in range(6)],
                                 "doc_id long, text string, _toxicity string, toxicity string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    got = toxicity.drop_toxic(docs, labels)
    assert got.columns == docs.columns and {(r._toxicity, r.toxicity) for r in got.collect()} == {("own", "more")} and got.count() == 6
