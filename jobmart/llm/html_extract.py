"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is read once, tag by tag, with a stack of open elements (no recursion; unclosed,
misnested and truncated markup is ordinary).  Text between block-level boundaries (block
tags and line breaks) is a leaf block.  Its features: the tags, roles and class and id words of
its ancestors, its own element, its length, the share of its text in links, how it ends,
and its place on the page.  Class names of ``html`` and ``body``, names that state what a page has
(``has-sidebar``) or how a post is filed (``tag-news``), and names beside the text on an element that holds
the page's text (``popular``, ``review``) are no features.  Scripts, styles, comments, titles, form controls, drawings and embedded objects
are no text; one that is never closed ends with the element around it or at the next block.

The field has two labels, main and other: emission weights for each feature, transition
weights between neighbours, trained by maximum likelihood (forward-backward, L2) on labelled
pages and decoded by Viterbi.  The tables hold no labels, so the labelled pages are rendered
from a grammar of page layouts (``labelled_pages``), which knows what it placed where;
their number ``TRAIN_PAGES`` is the bound of the training sample.  Words of the text are not
features, so the model does not depend on the language.

Text: character references decoded, white space inside a block turned into one space,
trimmed; main blocks in page order, joined by one line feed.

Defined results: null or empty html, and pages without main blocks, have an empty text and 0
code points; an empty table gives no rows; repeated rows repeat their result; other columns are ignored, whatever their names; pages of any length and nesting are read whole.
"""

from __future__ import annotations

import functools
import html as _html
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

TRAIN_PAGES = 1400
SEED = 17

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*(?:>|\Z)", re.I | re.S)
# elements that hold no markup: they run to their end tag
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I) for t in "script style noscript iframe textarea title".split()}
# elements whose text is not kept, and where the next tag of that name is
_UNKEPT = {t: re.compile(rf"<(/?){t}(?=[\s/>])", re.I) for t in "template svg math object select button".split()}
_FOREIGN = frozenset(("svg", "math"))
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# class names that state what a page has, or how a post is filed, not what the element is
_STATE = re.compile(r"(?:has|no|with|without|is|not|tag|category|format|type|status|lang|theme)[-_]", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
                   "summary table tbody td tfoot th thead tr ul caption".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = _BLOCK - {"br", "body", "html"}
_ENDS_UNKEPT = _BLOCK - {"br", "hr", "option", "optgroup"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
_SCOPE = frozenset("ul ol dl table div section article body".split())


# what class and id words and tags say an element is; its kind is a feature like any other, weighted in training
_KINDS = {
    "advert": "ad ads advert advertisement sponsor sponsored promo promoted promotion adsbygoogle dfp outbrain taboola",
    "comment": "comment commentlist discussion reply replie response respond disqus review",
    "notice": "cookie consent gdpr notice alert banner popup modal overlay paywall disclaimer warning notification message toast",
    "menu": "menu nav navbar navigation topnav breadcrumb tab pagination pager toc",
    "side": "sidebar side widget rail secondary related recommended trending popular teaser aside more",
    "form": "newsletter subscribe signup login search contact form",
    "share": "share sharing social tag byline author meta",
    "head": "header masthead topbar",
    "foot": "footer copyright colophon legal",
    "main": "content article post entry story body prose main",
}
_KIND_OF = {w: k for k, ws in _KINDS.items() for w in ws.split()}
_TAG_KIND = {"nav": "menu", "menu": "menu", "aside": "side", "footer": "foot", "header": "head", "form": "form", "article": "main", "main": "main"}


class _Open:
    """An open element: its tag, whether inside a link, the element around it, what its own tag and names say
    (``own``), what is left of that where it holds the page's text (``quiet``), the characters of text in it,
    and the innermost element around that keeps no text, with whether all such are unclosed."""
    __slots__ = ("tag", "link", "parent", "own", "quiet", "total", "headed", "path", "kind", "unkept", "loose")

    def __init__(self, tag: str, link: bool, parent: _Open | None, own: tuple = (frozenset(), None), quiet: tuple = (frozenset(), None),
                 unkept: str | None = None, loose: bool = True):
        self.tag, self.link, self.parent, self.own, self.quiet, self.unkept, self.loose = tag, link, parent, own, quiet, unkept, loose
        self.total, self.headed, self.path, self.kind = 0, False, None, None


def _named(value: str) -> list[list[str]]:
    """The words of each class name or id."""
    return [[w[:-1] if len(w) > 3 and w.endswith("s") else w for w in (x.lower() for x in _WORDS.findall(name))]
            for name in value.split() if not _STATE.match(name)]


def _element_features(tag: str, attrs: str) -> tuple[tuple[set[str], str | None], tuple[set[str], str | None]]:
    """(features, kind) of an element, and what is left of them where it holds the page's text: there
    names that speak of something beside the text say nothing.

    What is around the text goes before the text itself, as in an article's comments, but for
    ``article`` and ``main`` with a class name of their own for it."""
    base, names = {"t=" + tag}, []
    if tag not in ("html", "body") and attrs and ("=" in attrs or "hidden" in attrs):
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                names += _named(value)
            elif name == "role":
                base.add("r=" + value.lower())
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                    name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                base.add("hidden")
    kinds = [{_KIND_OF[w] for w in words if w in _KIND_OF} for words in names]
    said = set().union(*kinds, {_TAG_KIND[tag]} if tag in _TAG_KIND else ())
    beside = sorted(said - {"main"})
    if tag in ("article", "main") and {"main"} in kinds:
        beside = []
    kind = beside[0] if beside else "main" if said else None
    own = base | {"c=" + w for words in names for w in words} | ({"in=" + kind} if kind else set())
    pure = [words for words, k in zip(names, kinds) if not k - {"main"}]
    calm = _TAG_KIND.get(tag) or ("main" if any(_KIND_OF.get(w) == "main" for words in pure for w in words) else None)
    quiet = base | {"c=" + w for words in pure for w in words} | ({"in=" + calm} if calm else set())
    return (own, kind), (quiet, calm)


def _settle(nodes: list[_Open]) -> None:
    """Paths and kinds of all elements, once it is known which of them hold the page's text: those around
    the first headline with a good part of the text, or, without a headline, those with most of it."""
    whole = sum(e.total for e in nodes)
    for e in reversed(nodes):
        if e.parent is not None:
            e.parent.total += e.total
    headline = next((e for e in nodes if e.tag == "h1"), None)
    at = headline
    while at is not None and not at.headed:
        at.headed = True
        at = at.parent
    for e in nodes:                                   # parents come before their children
        if e.parent is None:
            e.path = frozenset()
            continue
        holds = e.total >= 0.3 * whole if e.headed else headline is None and e.total >= 0.6 * whole
        features, kind = e.quiet if holds else e.own
        e.path = e.parent.path if features <= e.parent.path else e.parent.path | features
        e.kind = kind or e.parent.kind


def leaf_blocks(page: str, known: frozenset | None = None) -> list[tuple[str, set[str]]]:
    """(text, features) of the leaf blocks in page order; ``known`` limits the features kept."""
    found: list[tuple[str, str, _Open, float]] = []
    root = _Open("html", False, None)
    stack, nodes = [root], [root]
    parts: list[str] = []
    linked = total = 0
    first: tuple[str, _Open] | None = None
    made: dict[tuple[str, str], tuple] = {}

    def close_block() -> None:
        nonlocal linked, total, first
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                own, node = first or (next((e.tag for e in reversed(stack) if e.tag in _BLOCK), "html"), root)
                found.append((text, own, node, linked / max(1, total)))
            parts.clear()
        linked = total = 0
        first = None

    def add(raw: str) -> None:
        nonlocal linked, total, first
        if not raw or stack[-1].unkept:
            return
        text = _html.unescape(raw) if "&" in raw else raw
        n = len(text.strip())
        if n:
            top = stack[-1]
            if first is None:
                first = next((e for e in reversed(stack) if e.tag in _BLOCK), root).tag, top
            total += n
            top.total += n
            if top.link:
                linked += n
        parts.append(text)

    def pop_to(i: int) -> None:
        del stack[i:]

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "head":            # what cannot stand in a head is the body's, with or without its tags
            continue
        if m.group(1):
            if tag in _BLOCK and not stack[-1].unkept:
                close_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag in _BLOCK and stack[-1].unkept and not stack[i].unkept:
                        close_block()
                    pop_to(i)
                    break
                if tag not in _BLOCK and tag not in _UNKEPT and stack[i].tag in _BLOCK and stack[i].tag not in ("p", "li"):
                    break            # an inline end tag does not close blocks
            continue
        top = stack[-1]
        if top.unkept and top.loose and (tag in _ENDS_UNKEPT or tag in _UNKEPT and top.unkept not in _FOREIGN):
            pop_to(next(i for i, e in enumerate(stack) if e.unkept))     # no end tag is left: what cannot stand in it ends it
            top = stack[-1]
        if tag in _RAW_END and top.unkept not in _FOREIGN:
            at = _RAW_END[tag].search(page, at).end()
            continue
        if tag in _UNKEPT:
            if not m.group(3).endswith("/") or tag not in _FOREIGN and top.unkept not in _FOREIGN:
                following = _UNKEPT[tag].search(page, at)
                loose = following is None or not following.group(1)
                stack.append(_Open(tag, False, top, unkept=tag, loose=top.loose and loose))
            continue
        if top.unkept:
            if tag not in _VOID and tag not in ("option", "optgroup") and not m.group(3).endswith("/"):
                stack.append(_Open(tag, False, top, unkept=top.unkept, loose=top.loose))
            continue
        if tag in _BLOCK:
            close_block()
        if tag in _CLOSES_P:         # a block element ends an open paragraph
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in _BLOCK:
                    break
        if tag in _SIBLINGS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _SIBLINGS[tag]:
                    pop_to(i)
                    break
                if stack[i].tag in _SCOPE:
                    break
        if tag in _VOID or m.group(3).endswith("/"):
            continue
        key = (tag, m.group(3))
        got = made.get(key)
        if got is None:
            got = tuple((frozenset(f) if known is None else known & f, k) for f, k in _element_features(*key))
            if len(made) < 4096:
                made[key] = got
        stack.append(_Open(tag, tag == "a" or stack[-1].link, stack[-1], *got))
        nodes.append(stack[-1])
    add(page[at:])
    close_block()
    _settle(nodes)

    out, n = [], len(found)
    headline = next((i for i, b in enumerate(found) if b[1] == "h1"), -1)
    for i, (text, own, node, link) in enumerate(found):
        kind = node.kind
        words = text.count(" ") + 1
        feats = set(node.path)
        feats.add("own=" + own)
        feats.add(f"near={kind}")
        if own[0] == "h" and own[1:].isdigit():
            feats.add(f"heading near={kind}")
        feats.add("words=" + ("1" if words == 1 else "3" if words < 4 else "8" if words < 9 else "20" if words < 21 else "50" if words < 51 else "more"))
        feats.add("link=" + ("none" if link == 0 else "some" if link < 0.5 else "most"))
        feats.add("stop" if text[-1] in ".!?…:\"”»。" else "nostop")
        if text[0] in "©" or "©" in text[:30]:
            feats.add("copyright")
        if headline >= 0:
            feats.add("head=" + ("before" if i < headline else "after"))
        if i == 0:
            feats.add("first")
        if i == n - 1:
            feats.add("last")
        out.append((text, feats))
    return out


# --- the field ------------------------------------------------------------------------
class Crf:
    """Two labels: ``weights`` are scores of main over other; ``move[a, b]`` scores b after a."""

    def __init__(self, weights: dict[str, float], bias: float, move: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.weights, self.bias, self.move, self.start, self.end = weights, bias, move, start, end
        self.known = frozenset(weights)
        self._m = [float(x) for x in (*move.ravel(), *start, *end)]

    def scores(self, blocks: list[tuple[str, set[str]]]) -> list[float]:
        get = self.weights.get
        return [self.bias + sum([get(f, 0.0) for f in feats]) for _, feats in blocks]

    def decode(self, scores: list[float]) -> list[bool]:
        """The most probable labels (Viterbi)."""
        if not scores:
            return []
        m00, m01, m10, m11, s0, s1, e0, e1 = self._m
        a, b = s0, s1 + scores[0]
        back = []
        for s in scores[1:]:
            to0, to1 = a + m00 < b + m10, a + m01 < b + m11
            back.append((to0, to1))
            a, b = max(a + m00, b + m10), max(a + m01, b + m11) + s
        label = a + e0 < b + e1
        out = [label]
        for to0, to1 in reversed(back):
            label = to1 if label else to0
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[tuple[str, set[str]]], list[bool]]], l2: float = 0.3, steps: int = 200) -> Crf:
    """Maximum likelihood of the labels by forward-backward and Adam, all pages side by side."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    seen: dict[str, int] = {}
    for blocks, _ in pages:
        for _, feats in blocks:
            for f in feats:
                seen[f] = seen.get(f, 0) + 1
    for f in sorted(f for f, n in seen.items() if n >= 5):
        names[f] = len(names)
    T, n = max(len(b) for b, _ in pages), len(pages)
    live, y = np.zeros((n, T), bool), np.zeros((n, T), np.int64)
    row, col = [], []
    for i, (blocks, labels) in enumerate(pages):
        live[i, :len(blocks)] = True
        y[i, :len(blocks)] = labels
        for j, (_, feats) in enumerate(blocks):
            for f in feats:
                if f in names:
                    row.append(i * T + j)
                    col.append(names[f])
    row, col = np.array(row), np.array(col)
    size = live.sum(1)
    k = len(names)
    theta = np.zeros(k + 1 + 4 + 2 + 2)
    last = (np.arange(n), size - 1)
    true = np.zeros_like(theta)
    true[:k] = np.bincount(col, weights=(y.ravel()[row] == 1), minlength=k)
    true[k] = (y * live).sum()
    both = live[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            true[k + 1 + 2 * a + b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum()
        true[k + 5 + a] = (y[:, 0] == a).sum()
        true[k + 7 + a] = (y[last] == a).sum()
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, bias, move, start, end = theta[:k], theta[k], theta[k + 1:k + 5].reshape(2, 2), theta[k + 5:k + 7], theta[k + 7:]
        emit = np.zeros((n, T, 2))
        emit[:, :, 1] = (np.bincount(row, weights=w[col], minlength=n * T) + bias).reshape(n, T)
        alpha, beta = np.zeros((n, T, 2)), np.zeros((n, T, 2))
        alpha[:, 0] = start + emit[:, 0]
        for t in range(1, T):
            nxt = np.logaddexp(alpha[:, t - 1, :1] + move[0], alpha[:, t - 1, 1:] + move[1]) + emit[:, t]
            alpha[:, t] = np.where(live[:, t, None], nxt, alpha[:, t - 1])
        z = np.logaddexp.reduce(alpha[:, -1] + end, axis=1)
        beta[last] = end
        for t in range(T - 2, -1, -1):
            go = emit[:, t + 1] + beta[:, t + 1]
            nxt = np.logaddexp(move[:, 0] + go[:, :1], move[:, 1] + go[:, 1:])
            beta[:, t] = np.where(live[:, t + 1, None], nxt, beta[:, t])
        prob = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
        expect = np.zeros_like(theta)
        expect[:k] = np.bincount(col, weights=prob[:, :, 1].ravel()[row], minlength=k)
        expect[k] = prob[:, :, 1].sum()
        pair = np.exp(np.minimum(0, alpha[:, :-1, :, None] + move + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]))
        expect[k + 1:k + 5] = (pair * both[:, :, None, None]).sum((0, 1)).ravel()
        expect[k + 5:k + 7] = prob[:, 0].sum(0)
        expect[k + 7:] = prob[last].sum(0)
        g = (expect - true + l2 * theta) / n
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta = theta - 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return Crf(dict(zip(names, theta[:k].tolist())), float(theta[k]), theta[k + 1:k + 5].reshape(2, 2), theta[k + 5:k + 7], theta[k + 7:])


# --- labelled pages ----------------------------------------------------------------------
_MARK = ""      # marks main text in rendered pages; never part of a feature


class _Layout:
    """Renders random pages whose main text is marked."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        out = ["".join(r.choice("bcdfglmnprstvw") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(r.randint(lo, hi))]
        out[0] = out[0].capitalize()
        return " ".join(out)

    def sentence(self, lo: int = 4, hi: int = 30) -> str:
        return self.words(lo, hi) + self.r.choice([".", ".", ".", "!", "?", ""])

    def text(self, main: bool, lo: int = 1, hi: int = 5) -> str:
        parts = [self.sentence() for _ in range(self.r.randint(lo, hi))]
        if self.r.random() < 0.2:
            i = self.r.randrange(len(parts))
            parts[i] = self.r.choice(["<b>{}</b>", "<a href='/x'>{}</a>", "<i>{}</i>", "<em>{}</em>", "<span>{}</span>"]).format(parts[i])
        return (_MARK if main else "") + " ".join(parts)

    def tag(self, names: str, classes: str = "", p_class: float = 0.8) -> tuple[str, str]:
        name = self.r.choice(names.split())
        attr = ""
        if classes and (self.r.random() < p_class or name in ("div", "section", "p", "ul", "span")):
            attr = f' {self.r.choice(["class", "class", "id"])}="{self.r.choice(classes.split())}"'
        return f"<{name}{attr}>", f"</{name}>"

    def wrap(self, inner: str, names: str, classes: str = "", p_class: float = 0.8) -> str:
        a, b = self.tag(names, classes, p_class)
        return a + inner + b

    def links(self, n: int) -> str:
        r = self.r
        item = r.choice(["<li><a href='/a'>{}</a></li>", "<a href='/a'>{}</a> ", "<div><a href='/a'>{}</a></div>", "<p><a href='/a'>{}</a></p>",
                         "<li>{}</li>"])
        inner = "".join(item.format(self.words(1, 4)) for _ in range(n))
        return f"<ul>{inner}</ul>" if item.startswith("<li") else inner

    def paragraphs(self, main: bool, lo: int, hi: int) -> str:
        r, out = self.r, []
        p = r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}<br><p>"]) if main else r.choice(["<p>{}</p>", "<div>{}</div>", "<p>{}"])
        for _ in range(r.randint(lo, hi)):
            kind = r.random()
            if main and kind < 0.08:
                out.append(f"<{(h := r.choice(['h2', 'h3', 'h4']))}>{_MARK}{self.words(2, 8)}</{h}>")
            elif main and kind < 0.14:
                out.append("<{0}>{1}</{0}>".format(r.choice(["ul", "ol"]), "".join(f"<li>{self.text(True, 1, 2)}</li>" for _ in range(r.randint(2, 5)))))
            elif main and kind < 0.18:
                out.append(f"<blockquote>{self.text(True)}</blockquote>")
            elif main and kind < 0.20:
                out.append(f"<pre>{self.text(True)}</pre>")
            elif main and kind < 0.22:
                out.append(f"<figure><img src='i.png'><figcaption>{self.text(True, 1, 1)}</figcaption></figure>")
            elif main and kind < 0.24:
                out.append("<table>" + "".join(f"<tr><td>{_MARK}{self.words(1, 3)}</td><td>{_MARK}{self.words(1, 6)}</td></tr>" for _ in range(3)) + "</table>")
            elif main and kind < 0.30:
                out.append(p.format(_MARK + self.words(1, 6)))
            elif main and kind < 0.34:            # lists of links, and paragraphs that are mostly links, belong to the text
                item = r.choice(["<li><a href='/r'>{}</a></li>", "<li><a href='/r'>{}</a> {}</li>", "<li>{} <a href='/r'>{}</a></li>"])
                out.append("<ul>" + "".join(item.replace("{}", _MARK + self.words(2, 8), 1).replace("{}", self.words(2, 9)) for _ in range(r.randint(2, 6))) + "</ul>")
            elif main and kind < 0.37:
                out.append(p.format(f"{_MARK}<a href='/r'>{self.words(4, 14)}</a> {self.words(1, 5)}"))
            elif main and kind < 0.41:
                out.append(p.format(_MARK + self.words(1, 2) + r.choice([".", ".", "!", "?"])))
            else:
                out.append(p.format(self.text(main)))
            if main and r.random() < 0.06:
                out.append(self.advert())
        return "".join(out)

    def advert(self) -> str:
        return self.wrap(self.r.choice([self.text(False, 1, 2), f"<p>{self.text(False, 1, 3)}</p>", f"<a href='/b'>{self.words(2, 8)}</a>"]),
                         "div div aside ins section p", "ad ads advert advertisement sponsored promo ad-slot ad-banner sponsor promoted", 1.0)

    def notice(self) -> str:
        return self.wrap(self.r.choice(["<p>{}</p>", "{}", "<span>{}</span>"]).format(self.text(False, 1, 3)), "div div section aside p",
                         "cookie cookie-notice cookie-banner consent gdpr notice alert banner popup modal overlay paywall disclaimer site-notice warning "
                         "notification message", 1.0)

    def menu(self) -> str:
        return self.wrap(self.links(self.r.randint(2, 9)), "nav nav div ul menu", "menu nav navbar navigation main-menu topnav breadcrumb breadcrumbs tabs", 0.5)

    def head(self) -> str:
        r = self.r
        inner = r.choice(["<p>{}</p>", "<div>{}</div>", "<h2>{}</h2>", "{}", "<a href='/'>{}</a>"]).format(self.words(1, 8))
        if r.random() < 0.4:
            inner += f"<p>{self.sentence()}</p>"
        if r.random() < 0.5:
            inner += self.menu()
        return self.wrap(inner, "header header div", "header site-header masthead top topbar page-header", 0.5)

    def sidebar(self) -> str:
        out = []
        for _ in range(self.r.randint(1, 4)):
            out.append(self.r.choice(["<h3>{}</h3>", "<h4>{}</h4>", "<p>{}</p>"]).format(self.words(1, 4)))
            out.append(self.r.choice([self.links(3), self.paragraphs(False, 1, 2), self.advert()]))
        return self.wrap("".join(out), "aside aside div section", "sidebar side widget widgets right-column secondary rail related related-posts recommended "
                         "trending popular more-stories teaser", 0.6)

    def form(self) -> str:
        r = self.r
        inner = "".join(f"<label>{self.words(1, 4)}</label><input name='x'>" for _ in range(r.randint(1, 4)))
        if r.random() < 0.6:
            inner = f"<p>{self.sentence()}</p>" + inner
        if r.random() < 0.4:
            inner += f"<select><option>{self.words(1, 2)}</option></select><button>{self.words(1, 2)}</button>"
        form = f"<form>{inner}</form>"
        return self.wrap(form, "div section", "newsletter subscribe signup login search contact", 1) if r.random() < 0.5 else form

    def share(self) -> str:
        links = self.links(3)                     # a paragraph would end where a list begins
        return self.wrap(links, "div ul p" if links.startswith("<a") else "div div ul", "share social sharing share-buttons tags meta byline author", 1.0)

    def comments(self) -> str:
        r, out = self.r, []
        if r.random() < 0.6:
            out.append(f"<{(h := r.choice(['h2', 'h3']))}>{self.words(1, 3)}</{h}>")
        item = r.choice(["<li>{}</li>", "<div class='comment'>{}</div>", "<article class='comment'>{}</article>", "<p>{}</p>",
                         "<div class='comment-body'><p>{}</p></div>", "<div>{}</div>", "<blockquote>{}</blockquote>"])
        for _ in range(r.randint(1, 6)):
            who = f"<{(w := r.choice(['b', 'span', 'cite']))}>{self.words(1, 2)}</{w}> " if r.random() < 0.5 else ""
            out.append(item.format(who + self.text(False, 1, 4)))
        return self.wrap("".join(out), "div section ol div aside", "comments comment-list comment-section discussion replies responses user-comments disqus reviews", 1.0)

    def foot(self) -> str:
        r = self.r
        inner = r.choice(["&copy; {}", "<p>&copy; {}</p>", "{}", "<p>{}</p>", "<div>{}</div>", "<small>{}</small>"]).format(self.text(False, 1, 3))
        if r.random() < 0.4:
            inner = self.links(4) + inner
        return self.wrap(inner, "footer footer footer div", "footer site-footer bottom copyright colophon legal", 0.5)

    def main(self) -> str:
        r = self.r
        title = f"<h1>{_MARK}{self.words(2, 12)}</h1>" if r.random() < 0.85 else f"<h2>{_MARK}{self.words(2, 10)}</h2>" if r.random() < 0.5 else ""
        if r.random() < 0.15:
            title = f"<header>{title}</header>"
        body = self.paragraphs(True, 1 if r.random() < 0.3 else 3, 12)
        if r.random() < 0.1:
            title += self.share()
        if r.random() < 0.25:
            body = self.wrap(body, "div section", "content entry-content post-content article-body story-body text body prose", 0.9)
        inner = title + body
        for extra, p in ((self.share, 0.12), (self.comments, 0.12), (self.notice, 0.06), (self.form, 0.06), (self.sidebar, 0.05)):
            if r.random() < p:
                inner += extra()
        if r.random() < 0.08:
            return inner                          # no element around the text
        out = self.wrap(inner, "article article article main main div div section td", "content main article post entry story main-content page-content post-body", 0.35)
        if r.random() < 0.25:                     # what blog software writes beside the name: how the post is filed, what the page has
            extra = " ".join(r.sample("popular review trending featured has-comments tag-news category-more post-77 format-standard "
                                      "related widget with-sidebar comment-open hentry".split(), r.randint(1, 3)))
            out = re.sub(r'^<(\w+)(?: class="([^"]*)")?', lambda m: f'<{m[1]} class="{(m[2] or "")} {extra}"', out, count=1)
        return out

    def page(self) -> str:
        r = self.r
        before = [f() for f, p in ((self.notice, 0.25), (self.head, 0.45), (self.menu, 0.6), (self.advert, 0.45), (self.sidebar, 0.15), (self.form, 0.15)) if r.random() < p]
        after = [f() for f, p in ((self.share, 0.2), (self.advert, 0.2), (self.comments, 0.35), (self.sidebar, 0.35), (self.form, 0.2), (self.menu, 0.1),
                                  (self.notice, 0.15), (self.foot, 0.85)) if r.random() < p]
        if r.random() < 0.5:
            r.shuffle(before)
        main = self.main()
        if r.random() < 0.2:
            main = f"<main>{main}</main>"
        inner = "".join(before) + main + "".join(after)
        if r.random() < 0.25:
            inner = self.wrap(inner, "div", "wrapper container page site layout row", 0.8)
        if r.random() < 0.06:                     # a page without markup, or of nothing but its text
            return self.text(True, 1, 6) if r.random() < 0.5 else self.paragraphs(True, 1, 5)
        names = r.choice(["", "", ' class="page has-sidebar"', ' class="single post comments-open"', ' id="sidebar-right" class="home widget"'])
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body{names}>{inner}</body></html>"


def labelled_pages(n: int, seed: int) -> list[tuple[list[tuple[str, set[str]]], list[bool]]]:
    """Leaf blocks of ``n`` rendered pages and whether each is main text."""
    layout, out = _Layout(seed), []
    for _ in range(n):
        blocks = leaf_blocks(layout.page())
        labels = [_MARK in text for text, _ in blocks]
        out.append(([(text.replace(_MARK, ""), feats) for text, feats in blocks], labels))
    return out


@functools.lru_cache(1)
def default_model() -> Crf:
    """The field trained on the labelled pages; once a process."""
    return fit(labelled_pages(TRAIN_PAGES, SEED))


def main_text(page: str, model: Crf) -> str:
    blocks = leaf_blocks(page, model.known)
    return "\n".join(text for (text, _), main in zip(blocks, model.decode(model.scores(blocks))) if main)


def extract(pages: DataFrame, model: Crf | None = None, html: str = "html") -> DataFrame:
    """``page_id, url`` with text and n_chars for every row."""
    model = model or default_model()
    shared = pages.sparkSession.sparkContext.broadcast(model)     # one weight a feature

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series([main_text(h, shared.value) for h in part], dtype=object)
    return (pages.select("page_id", "url", run(text_or_empty(html)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
