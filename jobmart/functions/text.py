"""Text functions as native Spark Column expressions.

Regex text here is written so that Java's engine (Spark) and RE2 (the DuckDB
oracle) read it the same way:

* word characters are ``[\\p{L}\\p{N}_]`` -- Python's Unicode ``\\w`` -- instead of
  ``\\b``/``\\w`` whose meaning differs between engines and JDK versions;
* whitespace is the class Python's ``str.split()``/``\\s`` use, because Java's
  ``\\s`` misses NBSP and the other Unicode spaces.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dictionaries as D

WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WS_RUN = WS + "+"
WS_NOT_SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}&&[^ ]]"
# the runs that are not one ASCII space already: replacing these alone gives what replacing all would
WS_RUN_TO_CHANGE = rf"{WS_NOT_SPACE}{WS}*| {WS_RUN}"

_META = set("\\.^$|?*+()[]{}")


def escape(literal: str) -> str:
    """Escape regex metacharacters (only those; RE2 rejects needless escapes)."""
    return "".join("\\" + ch if ch in _META else ch for ch in literal)


def _is_word_char(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def whole_word_alternative(keyword: str) -> str:
    """Pattern for one keyword with Python ``\\b`` semantics on both ends.

    ``\\b`` before a word character needs a non-word character or the start;
    before a non-word character (``+`` in ``5+``) it needs a word character.
    """
    left = f"(?:^|{NON_WORD})" if _is_word_char(keyword[0]) else WORD
    right = f"(?:$|{NON_WORD})" if _is_word_char(keyword[-1]) else WORD
    return left + escape(keyword) + right


def whole_word_pattern(keywords: list[str]) -> str:
    """One alternation that matches if any keyword occurs as a whole word."""
    return "(?:" + "|".join(whole_word_alternative(k) for k in keywords) + ")"


def _whole_word_search(keyword: str) -> str:
    """``whole_word_alternative`` for Java's engine: the keyword is sought as plain text, its ends are looked at where it
    stands.  The SQL's engine cannot look around."""
    left = f"(?<!{WORD}{escape(keyword)})" if _is_word_char(keyword[0]) else f"(?<={WORD}{escape(keyword)})"
    right = f"(?!{WORD})" if _is_word_char(keyword[-1]) else f"(?={WORD})"
    return escape(keyword) + right + left


def contains_any(text: Column, keywords: list[str]) -> Column:
    """Cheap substring pre-test: a whole-word hit implies a substring hit."""
    cond = None
    for k in keywords:
        c = F.instr(text, k) > 0
        cond = c if cond is None else (cond | c)
    return cond


def is_single_word(keyword: str) -> bool:
    return all(_is_word_char(ch) for ch in keyword)


def anchor(keyword: str) -> str:
    """The longest word of a keyword ('' without any).  Both ends of an occurrence are word
    boundaries, so every word of the keyword is a token of a text that holds it."""
    return max("".join(ch if _is_word_char(ch) else " " for ch in keyword).split(" "), key=len)


def word_tokens(text: Column) -> Column:
    """Maximal runs of word characters.  A keyword made only of word characters
    occurs as a whole word exactly when it equals one of these tokens."""
    return F.split(text, NON_WORD + "+")


def has_whole_word(text: Column, keywords: list[str], tokens: Column | None = None) -> Column:
    """True when any keyword occurs in ``text`` as a whole word.

    With ``tokens`` (``word_tokens(text)``, computed once per row) single-word
    keywords are a set-membership test.  Other keywords ("power bi", "node.js",
    "5+") bring their words as tokens: only rows that hold the ``anchor`` of one run the
    substring pre-test, and only rows that can match the boundary regex;
    ``And``/``Or`` short-circuit in generated code.
    """
    single = [k for k in keywords if is_single_word(k)] if tokens is not None else []
    multi = [k for k in keywords if k not in single]
    cond = None
    if single:
        cond = F.arrays_overlap(tokens, F.array(*[F.lit(k) for k in single]))
    if multi:
        pattern = _whole_word_search(multi[0]) if len(multi) == 1 else whole_word_pattern(multi)
        m = contains_any(text, multi) & text.rlike(pattern)
        anchors = sorted({anchor(k) for k in multi})
        if tokens is not None and "" not in anchors:
            m = F.arrays_overlap(tokens, F.array(*[F.lit(a) for a in anchors])) & m
        cond = m if cond is None else (cond | m)
    return cond


def normalize_text(c: Column) -> Column:
    """NBSP -> space, drop U+200B, collapse whitespace, trim; null -> ''."""
    s = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\u00a0"), F.lit(" ")),
                  F.lit("\u200b"), F.lit(""))
    # after the collapse every whitespace run is one ASCII space, so trim() suffices
    return F.trim(F.regexp_replace(s, WS_RUN, " "))


def clean_html(c: Column) -> Column:
    """remove tags (no space put in their place), then F01."""
    return normalize_text(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", ""))


def truncate_text(c: Column, max_length: int = 500, suffix: str = "...") -> Column:
    """unchanged if short enough, else cut to ``max_length - len(suffix)`` + suffix."""
    if max_length < len(suffix):
        raise ValueError("max_length must be at least len(suffix)")
    keep = max_length - len(suffix)
    return (F.when(F.length(c) <= max_length, c)
            .otherwise(F.concat(F.substring(c, 1, keep), F.lit(suffix))))


def clean_description(c: Column, boilerplate: list[str] | None = None,
                      max_word_chars: int = D.MAX_WORD_CHARS, lowered: Column | None = None) -> Column:
    """lower, strip tags, collapse whitespace, drop boilerplate, drop long words.

    Empty input or empty result gives NULL.  All steps are regex passes: after the
    whitespace collapse the only separator left is one ASCII space, so "drop words
    of >= N characters, rejoin with single spaces" is a replace of ``[^ ]{N,}``
    followed by a space collapse and trim (Java regex counts code points, like
    Python's ``len``).
    """
    phrases = boilerplate if boilerplate is not None else D.BOILERPLATE
    s = lowered if lowered is not None else F.lower(c)     # reuse an already lowered column
    s = F.regexp_replace(s, "<[^>]+>", "")
    # a pass that would change nothing is not run: finding that out is a search for bytes or one class of characters
    s = _let(s, lambda t: F.when(F.contains(t, F.lit("  ")) | t.rlike(WS_NOT_SPACE), F.regexp_replace(t, WS_RUN_TO_CHANGE, " ")).otherwise(t))
    if phrases:
        s = _let(s, lambda t: F.when(reduce(or_, [F.contains(t, F.lit(p)) for p in phrases]),
                                     F.regexp_replace(t, "(?:" + "|".join(escape(p) for p in phrases) + ")", "")).otherwise(t))
    # a word is looked at from its start alone
    s = _let(s, lambda t: F.when(F.length(t) < max_word_chars, t).otherwise(
        F.regexp_replace(t, "(?<![^ ])[^ ]{%d,}" % max_word_chars, "")))
    s = F.trim(_let(s, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " {2,}", " ")).otherwise(t)))
    # not inside a condition, where ``nullif`` would run all passes twice; a null stays null
    return F.nullif(s, F.lit(""))


def quote_plus(c: Column) -> Column:
    """form-encode like Python's ``quote_plus`` (``~`` kept, ``*`` encoded)."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")),
                     F.lit("*"), F.lit("%2A"))


def quote_path20(c: Column) -> Column:
    """``quote_plus`` with ``+`` turned into ``%20`` (the vieclam24h listing form)."""
    return F.replace(quote_plus(c), F.lit("+"), F.lit("%20"))


# fixed values: schemes whose URLs are resolved against a base, and those of them whose last segment has parameters
RELATIVE_SCHEMES = ["", "ftp", "http", "gopher", "nntp", "imap", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps",
                    "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss"]
PARAMETER_SCHEMES = ["", "ftp", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "mms", "sftp"]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _url_parts(url: Column, default_scheme: Column) -> Column:
    """Struct of a URL's scheme, host, path, params, query, fragment, and whether its host is well formed.

    Leading blanks and controls and all line breaks and tabs go first, as browsers do."""
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def after_scheme(s: Column) -> Column:
        named = F.lower(F.regexp_extract(s, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
        return F.struct(F.when(named == "", default_scheme).otherwise(named).alias("scheme"),
                        F.when(named == "", s).otherwise(F.substr(s, F.length(named) + 2)).alias("rest"))

    def after_host(p: Column) -> Column:
        host = F.regexp_extract(p["rest"], r"(?s)^//([^/?#]*)", 1)
        return F.struct(p["scheme"].alias("scheme"), host.alias("host"),
                        F.when(p["rest"].startswith("//"), F.substr(p["rest"], F.length(host) + 3)).otherwise(p["rest"]).alias("rest"))

    def whole(p: Column) -> Column:
        path = F.regexp_extract(p["rest"], r"(?s)^([^?#]*)", 1)
        cut = p["scheme"].isin(PARAMETER_SCHEMES)
        bracketed = F.regexp_extract(p["host"], r"\[([^\]]*)\]", 1)
        well_formed = (~p["host"].rlike(r"[\[\]]")) | bracketed.rlike(r"^(?:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(?:%.+)?|v[0-9A-Fa-f]+\..+)$")
        return F.struct(
            p["scheme"].alias("scheme"), p["host"].alias("host"),
            F.when(cut, F.regexp_extract(path, r"(?s)^((?:.*/)?[^/;]*)", 1)).otherwise(path).alias("path"),
            F.when(cut, F.regexp_extract(path, r"(?s)^(?:.*/)?[^/;]*;([^/]*)$", 1)).otherwise(F.lit("")).alias("params"),
            F.regexp_extract(p["rest"], r"(?s)^[^?#]*\?([^#]*)", 1).alias("query"),
            F.regexp_extract(p["rest"], r"(?s)^[^#]*#(.*)$", 1).alias("fragment"), well_formed.alias("well_formed"))
    return _let(_let(_let(clean, after_scheme), after_host), whole)


def _written(scheme: Column, host: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    """The URL of its parts; empty parameters, queries and fragments are not written."""
    def sign(s: str, c: Column) -> Column:
        return F.when(c == "", F.lit("")).otherwise(F.concat(F.lit(s), c))

    def full(local: Column) -> Column:
        rooted = F.when((local != "") & ~local.startswith("/"), F.concat(F.lit("/"), local)).otherwise(local)
        front = (F.when(host != "", F.concat(F.lit("//"), host, rooted))
                 .when(local.startswith("//") | ((scheme != "") & ((local == "") | local.startswith("/"))), F.concat(F.lit("//"), local))
                 .otherwise(local))
        return F.concat(F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit(":"))), front)
    return F.concat(_let(F.concat(path, sign(";", params)), full), sign("?", query), sign("#", fragment))


def _without_dots(segments: Column) -> Column:
    """RFC 3986 5.2.4 as a fold: ``.`` adds nothing, ``..`` takes the segment before it away; either as the last one leaves a slash."""
    kept = F.reduce(segments, F.slice(segments, F.lit(1), F.lit(0)), lambda acc, s:
                    F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                    .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segments, -1)
    path = F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path == "", F.lit("/")).otherwise(path)


def _merged(base_path: Column, path: Column) -> Column:
    """A path resolved against the base's: from the root, or from the base's folder with empty segments left out."""
    folder = F.split(base_path, "/")
    folder = F.when(F.element_at(folder, -1) == "", folder).otherwise(F.slice(folder, F.lit(1), F.size(folder) - 1))

    def relative(all_: Column) -> Column:
        inner = F.filter(F.slice(all_, F.lit(2), F.greatest(F.size(all_) - 2, F.lit(0))), lambda s: s != "")
        return F.when(F.size(all_) <= 2, all_).otherwise(
            F.concat(F.slice(all_, F.lit(1), F.lit(1)), inner, F.slice(all_, F.lit(-1), F.lit(1))))
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(_let(F.concat(folder, F.split(path, "/")), relative))
    return _let(segments, _without_dots)


def normalize_url(url: Column, base: Column | str) -> Column:
    """``url`` made absolute against ``base`` like ``urllib.parse.urljoin``; '' when empty or when
    a host is malformed.  All native: RFC 3986 resolution over arrays of path segments."""
    b = F.lit(base) if isinstance(base, str) else base

    def resolve(p: Column) -> Column:
        u, o = p["u"], p["o"]
        path = (F.when(u["host"] != "", u["path"])
                .when((u["path"] == "") & (u["params"] == ""), o["path"])
                .otherwise(_merged(o["path"], u["path"])))
        same = (u["host"] == "") & (u["path"] == "") & (u["params"] == "")
        return (F.when(~u["well_formed"] | ~o["well_formed"], F.lit(""))
                .when((u["scheme"] != o["scheme"]) | ~u["scheme"].isin(RELATIVE_SCHEMES), url)
                .otherwise(_let(F.struct(
                    F.when(u["host"] != "", u["host"]).otherwise(o["host"]).alias("host"), path.alias("path"),
                    F.when(same, o["params"]).otherwise(u["params"]).alias("params"),
                    F.when(same & (u["query"] == ""), o["query"]).otherwise(u["query"]).alias("query")),
                    lambda r: _written(u["scheme"], r["host"], r["path"], r["params"], r["query"], u["fragment"]))))

    joined = _let(_let(_url_parts(b, F.lit("")), lambda o: F.struct(o.alias("o"), _url_parts(url, o["scheme"]).alias("u"))), resolve)
    return (F.when(url.isNull() | (url == ""), F.lit(""))
            .when(b.isNull() | (b == ""), url)
            .otherwise(joined))
