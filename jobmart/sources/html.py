"""HTML pages -> postings and links (S04, S05, S06, F05 on pages).

The only Python in the engine: parsing HTML needs a tokenizer.  Pages are parsed
inside Arrow-batched pandas UDFs, one page per row, in parallel over the
partitions of the ``pages`` table; the selectors are data (U02).

Tree rules follow the stdlib ``html.parser`` tokenizer the original uses: an end
tag closes up to its nearest open namesake (an unmatched one is ignored), void
tags close at once, nothing is closed implicitly.  Text = text nodes under the
element, each stripped, empty ones dropped, joined by the separator; comments,
script and style are skipped; then F01 normalisation.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dictionaries as D

# ---------------------------------------------------------------------------
# FIXED VALUES: the platforms' page selectors (tag, class); a class with spaces
# must equal the whole class attribute, a single name matches any class token.
# ---------------------------------------------------------------------------
DETAIL_SELECTORS: dict[str, dict[str, tuple[str, str] | None]] = {
    "careerviet": {
        "job_title": ("h1", "title"),
        "job_description": ("section", "job-detail-content"),
        "company": ("h3", "company-name"),
        "location": ("span", "job-location"),
        "posting_date": ("span", "date"),
    },
    "topcv": {
        "job_title": ("h1", "job-detail__info--title"),
        "job_description": ("div", "job-detail__information-detail"),
        "company": ("a", "company-name"),
        "location": ("span", "address"),
        "posting_date": None,
    },
    "vieclam24h": {
        "job_title": ("div", "text-24 font-bold leading-10 text-se-neutral-84 !font-medium"),
        "job_description": ("div", "flex flex-col gap-8 w-full sm_cv:gap-6"),
        "company": None,
        "location": None,
        "posting_date": ("div", "text-14 font-normal leading-6 text-se-neutral-84 line-clamp-2 break-words"),
    },
}
DETAIL_FIELDS = ["job_title", "company", "location", "job_description", "posting_date"]
# careerviet keeps the date inside this container only
CAREERVIET_DATE_BOX = ("div", "detail-box has-background")
LISTING_ITEMS = {
    "careerviet": ("div", "job-item"),
    "topcv": ("div", "job-item-search-result"),
}
TOPCV_TITLE = ("h3", "title")

VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"}
SKIP_TEXT = {"script", "style"}

_WS = re.compile(r"\s+")


# ---------------------------------------------------------------------------
# A minimal element tree
# ---------------------------------------------------------------------------
class Node:
    """An element.  Elements and texts of a page stand in one pre-order list (``order``);
    an element's descendants are the entries from ``first`` to ``last``, so that
    finding and reading need no recursion, however deep unclosed tags nest."""
    __slots__ = ("tag", "attrs", "order", "first", "last")

    def __init__(self, tag: str, attrs: dict[str, str], order: list):
        self.tag, self.attrs, self.order = tag, attrs, order
        self.first, self.last = len(order) + 1, None

    def _range(self) -> range:
        return range(self.first, len(self.order) if self.last is None else self.last)

    def find_all(self, tag: str | None = None, class_: str | None = None, **attrs):
        for i in self._range():
            n = self.order[i]
            if isinstance(n, Node) and (tag is None or n.tag == tag) and class_matches(n, class_) and \
                    all(n.attrs.get(k) == v for k, v in attrs.items()):
                yield n

    def find(self, tag: str | None = None, class_: str | None = None, **attrs):
        return next(self.find_all(tag, class_, **attrs), None)

    def get_text(self, separator: str = " ") -> str:
        out, i, end = [], self.first, self._range().stop
        while i < end:
            n = self.order[i]
            if isinstance(n, Node):
                if n.tag in SKIP_TEXT:
                    i = n._range().stop
                    continue
            elif n.strip():
                out.append(n.strip())
            i += 1
        return separator.join(out)


def class_matches(node: Node, class_: str | None) -> bool:
    if class_ is None:
        return True
    value = node.attrs.get("class")
    if value is None:
        return False
    tokens = value.split()
    if " " in class_:
        return " ".join(tokens) == class_
    return class_ in tokens


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.order: list = []
        self.root = Node("[document]", {}, self.order)
        self.root.first = 0
        self.stack = [self.root]
        self.depth: dict[str, int] = {}           # open elements of each tag

    def _add(self, tag, attrs) -> Node:
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.order)
        self.order.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        node = self._add(tag, attrs)
        if tag in VOID_TAGS:
            node.last = len(self.order)
        else:
            self.stack.append(node)
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs).last = len(self.order)

    def handle_endtag(self, tag):
        if not self.depth.get(tag):
            return
        while True:
            node = self.stack.pop()
            node.last = len(self.order)
            self.depth[node.tag] -= 1
            if node.tag == tag:
                return

    def handle_data(self, data):
        self.order.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    if html:
        b.feed(html)
        b.close()
    return b.root


def join_url(base: str, href: str) -> str:
    """``urljoin``; '' for what it refuses (a malformed host)."""
    try:
        return urljoin(base, href) if href else ""
    except ValueError:
        return ""


def normalize(text: str) -> str:
    """F01 in Python (same rules as the Column version)."""
    if not text:
        return ""
    return _WS.sub(" ", text.replace("\u00a0", " ").replace("\u200b", "")).strip()


def select_text(root: Node, tag: str | None, class_: str | None, separator: str = " ") -> str:
    """Text of the first element with tag and/or class (None: any); '' when absent."""
    el = root.find(tag, class_)
    return normalize(el.get_text(separator)) if el is not None else ""


# ---------------------------------------------------------------------------
# Per-page extraction (plain Python; used by the UDFs and the unit tests)
# ---------------------------------------------------------------------------
def detail_fields(html: str | None, platform: str, selectors: dict | None = None) -> dict[str, str | None]:
    """The posting fields of one detail page.  ``selectors`` (U02): user platforms,
    platform -> field -> (tag, class) or None, beside the built-in ones.  An unknown platform is a KeyError."""
    rules = {**DETAIL_SELECTORS, **(selectors or {})}[platform]
    root = parse(html)
    out: dict[str, str | None] = {}
    for field in DETAIL_FIELDS:
        rule = rules.get(field)
        if rule is None:
            out[field] = None if field == "posting_date" else ""
            continue
        scope = root
        if platform == "careerviet" and field == "posting_date":
            scope = root.find(*CAREERVIET_DATE_BOX)
            if scope is None:
                out[field] = None
                continue
        out[field] = select_text(scope, *rule)
    return out


class ListingRule(NamedTuple):
    """How a user platform's listing page holds its links (U02): the first link of every
    ``item`` element (tag, class; None: every link of the page), made absolute on
    ``base``, kept when it starts with ``prefix``."""
    item: tuple[str, str | None] | None = None
    base: str = ""
    prefix: str = ""


def listing_links(html: str | None, platform: str, base_url: str | None = None,
                  rules: dict[str, ListingRule] | None = None) -> list[str]:
    """Detail-page links of one listing page, in page order.  An unknown platform is a KeyError."""
    root = parse(html)
    if rules and platform in rules:
        rule = rules[platform]
        found = (root.find_all("a") if rule.item is None else
                 (a for i in root.find_all(*rule.item) if (a := i.find("a")) is not None))
        urls = [join_url(base_url or rule.base, a.attrs.get("href", "")) for a in found]
        return [u for u in urls if u and u.startswith(rule.prefix)]
    base = base_url or D.LIST_URL_BASE[platform]
    if platform == "careerviet":
        pairs = (list(item.find_all("a"))[1:2] for item in root.find_all(*LISTING_ITEMS["careerviet"]))
        return [u for p in pairs for a in p if (u := join_url(base, a.attrs.get("href", "")))]
    if platform == "topcv":
        titles = (item.find(*TOPCV_TITLE) for item in root.find_all(*LISTING_ITEMS["topcv"]))
        links = (t.find("a") for t in titles if t is not None)
        return [u for a in links if a is not None and (u := a.attrs.get("href", "")).startswith(D.TOPCV_JOB_PREFIX)]
    return [u for a in root.find_all("a", target="_blank") if (u := join_url(base, a.attrs.get("href", "")))]


def generic_fields(html: str | None) -> dict[str, object]:
    """Generic page: first h1, first article, number of nav links."""
    root = parse(html)
    nav = root.find("nav")
    return {
        "title": select_text(root, "h1", None),
        "body": select_text(root, "article", None),
        "nav_links": sum(1 for _ in nav.find_all("a")) if nav is not None else 0,
    }


def generic_links(html: str | None, page_url: str) -> list[str]:
    """Links under the first ``nav``, joined onto the page URL."""
    nav = parse(html).find("nav")
    if nav is None:
        return []
    out = []
    for a in nav.find_all("a"):
        u = join_url(page_url or "", a.attrs.get("href", ""))
        if u:
            out.append(u)
    return out


# ---------------------------------------------------------------------------
# Spark side: Arrow-batched UDFs, then native explode
# ---------------------------------------------------------------------------
DETAIL_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in [*DETAIL_FIELDS, "error"]])
LISTING_TYPE = T.StructType([T.StructField("urls", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())])
GENERIC_TYPE = T.StructType([T.StructField("title", T.StringType()),
                             T.StructField("body", T.StringType()),
                             T.StructField("nav_links", T.IntegerType())])


def _detail_udf(selectors: dict | None):
    @F.pandas_udf(DETAIL_TYPE)
    def run(html: pd.Series, platform: pd.Series) -> pd.DataFrame:
        rows = []
        for h, p in zip(html, platform):
            try:
                rows.append(detail_fields(h, p, selectors) | {"error": None if h else "no page"})
            except (KeyError, ValueError) as e:
                rows.append({"error": f"{type(e).__name__}: {e}"})
        return pd.DataFrame(rows, columns=DETAIL_TYPE.names, dtype=object)
    return run


def _listing_udf(rules: dict[str, ListingRule] | None):
    @F.pandas_udf(LISTING_TYPE)
    def run(html: pd.Series, platform: pd.Series) -> pd.DataFrame:
        rows = []
        for h, p in zip(html, platform):
            try:
                rows.append((listing_links(h, p, rules=rules), None if h else "no page"))
            except (KeyError, ValueError) as e:
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=LISTING_TYPE.names, dtype=object)
    return run


@F.pandas_udf(GENERIC_TYPE)
def _generic_fields_udf(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([generic_fields(h) for h in html], columns=["title", "body", "nav_links"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _generic_links_udf(html: pd.Series, url: pd.Series) -> pd.Series:
    return pd.Series([generic_links(h, u) for h, u in zip(html, url)])


def parse_detail_pages(pages: DataFrame, platform: str = "platform", selectors: dict | None = None,
                       errors: bool = False) -> DataFrame:
    """S05 -> S01: raw postings from detail pages (``url``, ``html``, platform column).

    A page that cannot be parsed (no html, unknown platform) is a row with NULL fields;
    ``errors=True`` adds the reason as column ``error``.  ``selectors`` adds user
    platforms (U02).  ``scraped_at`` is the parse time, as in the original;
    ``ingest_seq`` is kept when present."""
    f = _detail_udf(selectors)(F.col("html"), F.col(platform))
    seq = F.col("ingest_seq") if "ingest_seq" in pages.columns else F.col("page_id")
    out = pages.select(seq.cast("long").alias("ingest_seq"), F.col(platform).alias("platform"),
                       F.col("url").alias("job_url"), f.alias("f"))
    return out.select("ingest_seq", "platform", "job_url", "f.job_title", "f.company", "f.location",
                      "f.job_description", "f.posting_date",
                      F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
                      *(["f.error"] if errors else []))


def listing_pages_parsed(pages: DataFrame, platform: str = "platform",
                         rules: dict[str, ListingRule] | None = None) -> DataFrame:
    """(page_id, platform, urls, error), one row for every listing page."""
    f = _listing_udf(rules)(F.col("html"), F.col(platform))
    return (pages.select("page_id", F.col(platform).alias("platform"), f.alias("f"))
            .select("page_id", "platform", "f.urls", "f.error"))


def listing_page_links(pages: DataFrame, platform: str = "platform",
                       rules: dict[str, ListingRule] | None = None) -> DataFrame:
    """(page_id, platform, pos, url) for every link on listing pages."""
    return (listing_pages_parsed(pages, platform, rules)
            .select("page_id", "platform", F.posexplode_outer("urls").alias("pos", "url"))
            .filter(F.col("url").isNotNull()))


def page_fields(pages: DataFrame) -> DataFrame:
    """Generic fields of arbitrary pages: (page_id, url, title, body, nav_links)."""
    f = _generic_fields_udf(F.col("html"))
    return pages.select("page_id", "url", f.alias("f")).select(
        "page_id", "url", "f.title", "f.body", "f.nav_links")


def page_links(pages: DataFrame) -> DataFrame:
    """Generic links: (page_id, pos, url) from each page's nav, absolute."""
    return (pages.select("page_id",
                                 F.posexplode_outer(_generic_links_udf(F.col("html"), F.col("url")))
                                 .alias("pos", "url"))
            .filter(F.col("url").isNotNull()))
