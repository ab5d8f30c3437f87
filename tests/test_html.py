"""Detail and listing page parsers on pages built here from the selector table."""

import pytest

from jobmart.sources import html as H


def element(rule, inner):
    tag, cls = rule
    return f'<{tag} class="{cls}">{inner}</{tag}>'


def detail_page(platform, **values):
    """A page with one element for each selector of ``platform`` that ``values`` names."""
    out = ["<html><body><div><p>Menu of the site</p></div>"]
    for field, rule in H.DETAIL_SELECTORS[platform].items():
        if rule and field in values:
            inner = element(rule, values[field])
            if platform == "careerviet" and field == "posting_date":
                inner = element(H.CAREERVIET_DATE_BOX, f"<ul><li>{inner}</li></ul>")
            out.append(inner)
    return "".join(out) + "</body></html>"


@pytest.mark.parametrize("platform", sorted(H.DETAIL_SELECTORS))
def test_fields_are_found_by_selector(platform):
    page = detail_page(platform, job_title="Bread <i>Taster</i>", job_description="<h4>What</h4><p>Taste &amp; tell.</p><p>Write it down.",
                       company="Oven&nbsp;Ltd", location=" Hội An ", posting_date="7/8/2024")
    f = H.detail_fields(page, platform)
    assert f["job_title"] == "Bread Taster"
    assert f["job_description"] == "What Taste & tell. Write it down."
    rules = H.DETAIL_SELECTORS[platform]
    assert f["company"] == ("Oven Ltd" if rules["company"] else "")
    assert f["location"] == ("Hội An" if rules["location"] else "")
    assert f["posting_date"] == ("7/8/2024" if rules["posting_date"] else None)


def test_missing_elements_are_empty_and_dates_need_their_box():
    assert H.detail_fields("<h1 class='title'>x</h1>", "careerviet") == {
        "job_title": "x", "job_description": "", "company": "", "location": "", "posting_date": None}
    assert H.detail_fields(None, "topcv")["job_title"] == ""


def test_whole_class_string_must_match():
    page = '<div class="text-24 font-bold">no</div>' + detail_page("vieclam24h", job_title="yes")
    assert H.detail_fields(page, "vieclam24h")["job_title"] == "yes"


def test_select_text_by_class_or_tag_alone():
    root = H.parse("<div><p>first</p><p class='b c'>second<script>no</script></p></div>")
    assert H.select_text(root, None, "c") == "second"
    assert H.select_text(root, "p", None) == "first"
    assert H.select_text(root, None, None) == "first second"


def test_listing_links():
    box = '<div class="job-item">{}</div>'
    two = box.format('<a href="/logo.png"></a><a href="/tin/{}">x</a>')
    assert H.listing_links(two.format(5) + box.format('<a href="/lone">x</a>') + two.format("6?p=1"), "careerviet") == [
        "https://www.careerviet.vn/tin/5", "https://www.careerviet.vn/tin/6?p=1"]
    item = '<div class="job-item-search-result"><h3 class="title"><a href="{}">x</a></h3></div>'
    assert H.listing_links(item.format("https://www.topcv.vn/viec-lam/z/9") + item.format("https://elsewhere.invalid/9"), "topcv") == [
        "https://www.topcv.vn/viec-lam/z/9"]
    assert H.listing_links('<a target="_blank" href="/w/1">x</a><a href="/w/2">x</a><a target="_blank">x</a>', "vieclam24h") == [
        "https://vieclam24h.vn/w/1"]


def test_user_platform():
    rules = {"board": {"job_title": ("h2", None), "job_description": ("div", "text"), "company": None, "location": None, "posting_date": None}}
    f = H.detail_fields("<h2>Role</h2><div class='text'>Body</div>", "board", rules)
    assert (f["job_title"], f["job_description"], f["company"]) == ("Role", "Body", "")
    links = {"board": H.ListingRule(item=("li", "job"), base="https://board.invalid/list/")}
    assert H.listing_links('<li class="job"><a href="a/1">x</a></li><a href="b">no</a>', "board", rules=links) == ["https://board.invalid/list/a/1"]


BAD = [(1, "https://a.invalid/1", "<p>" * 10_000 + "<h1 class='title'>deep</h1>", "careerviet"),
       (2, "https://a.invalid/2", '<a target="_blank" href="http://[bad">x</a><a target="_blank" href="/ok">x</a>', "vieclam24h"),
       (3, "https://a.invalid/3", "<h1>x</h1>", "no such platform"),
       (4, None, None, None)]
PAGE = "page_id long, url string, html string, platform string"


def test_bad_pages_are_errors_in_the_data(spark):
    got = {r.ingest_seq: r for r in H.parse_detail_pages(spark.createDataFrame(BAD, PAGE), errors=True).collect()}
    assert got[1].job_title == "deep" and got[1].error is None
    assert got[3].error and got[3].job_title is None and got[4].error
    assert len(got) == 4
    links = [(r.page_id, r.url) for r in H.listing_page_links(spark.createDataFrame(BAD, PAGE)).collect()]
    assert links == [(2, "https://vieclam24h.vn/ok")]


def test_pages_table_parse(spark):
    from conftest import SF001
    from jobmart.sources.tables import table
    pages = table(spark, SF001, "pages")
    fields, links = H.page_fields(pages), H.page_links(pages)
    assert fields.count() == pages.count()
    assert fields.filter("title = ''").count() == 0
    assert links.filter(~links.url.startswith("http")).count() == 0


def test_parse_detail_pages_to_postings(spark):
    from jobmart.operators.transform import transform_postings
    rows = [(i, f"https://x.invalid/{p}", detail_page(p, job_title="Data role", job_description="SQL and Kafka"), p)
            for i, p in enumerate(sorted(H.DETAIL_SELECTORS))]
    tx = transform_postings(H.parse_detail_pages(spark.createDataFrame(rows, PAGE))).collect()
    assert len(tx) == 3 and all({s.skill_name for s in r.extracted_skills} == {"SQL", "Kafka"} for r in tx)
