"""Dictionary-driven enrichment as native Column expressions.

F08 seniority, F10/F11 skills, F12 canonical location, F13-F15 labels,
F16 flattened keyword map.  Dictionaries default to ``jobmart.dictionaries``;
pass your own dicts to extend them (U01).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from .text import WS, _let, anchor, escape, has_whole_word, is_single_word


# --- F08 -------------------------------------------------------------------
def detect_seniority(text: Column, levels: dict[str, list[str]] | None = None,
                     priority: list[str] | None = None,
                     unknown_label: str | None = None, tokens: Column | None = None) -> Column:
    """First level (in priority order) with a whole-word keyword hit; else NULL
    (or ``unknown_label``).  ``text`` is lower(title + ' ' + description)."""
    levels = D.SENIORITY_LEVELS if levels is None else levels
    order = priority or [lvl for lvl in D.SENIORITY_PRIORITY if lvl in levels] + \
        [lvl for lvl in levels if lvl not in D.SENIORITY_PRIORITY]
    fallback = F.lit(unknown_label) if unknown_label is not None else F.lit(None).cast("string")
    if not order:
        return fallback
    if tokens is not None:
        first = F.array_min(_lists_found(text, tokens, [[k.lower() for k in levels[lvl]] for lvl in order]))
        return F.coalesce(F.get(F.array(*[F.lit(lvl) for lvl in order]), first), fallback)
    expr = None
    for level in order:
        hit = has_whole_word(text, [k.lower() for k in levels[level]])
        expr = F.when(hit, F.lit(level)) if expr is None else expr.when(hit, F.lit(level))
    return expr.otherwise(fallback)


def _lists_found(text: Column, tokens: Column, lists: list[list[str]]) -> Column:
    """Indexes of the lists with a keyword in ``text`` as a whole word; they may repeat, and nulls stand between them.

    A token names the lists of which it is a keyword and the keywords of several words that it is the
    ``anchor`` of: only these are searched in the text, however many there are."""
    codes: dict[str, list[int]] = {}
    searched: list[tuple[int, str]] = []
    for i, kws in enumerate(lists):
        for k in kws:
            if is_single_word(k):
                codes.setdefault(k, []).append(i)
            else:
                codes.setdefault(anchor(k), []).append(len(lists) + len(searched))
                searched.append((i, k))
    always = codes.pop("", [])              # keywords without a word
    found = F.array(*[F.lit(c) for c in always]).cast("array<int>")
    if codes:
        # a map's keys are compared one by one: a map a length keeps them few
        by_length: list[dict[str, list[int]]] = [{} for _ in range(max(map(len, codes)) + 1)]
        for w, at in codes.items():
            by_length[len(w)][w] = at
        maps = [F.create_map(*[x for w, at in words.items() for x in (F.lit(w), F.array(*[F.lit(c) for c in at]))])
                if words else F.lit(None).cast("map<string,array<int>>") for words in by_length]
        none = F.array().cast("array<int>")
        of_token = F.flatten(F.transform(tokens, lambda t: F.coalesce(
            F.try_element_at(F.get(F.array(*maps), F.length(t)), t), none)))
        found = F.concat(F.coalesce(of_token, none), found) if always else F.coalesce(of_token, none)

    def index(c: Column) -> Column:
        hit = F.when(c < len(lists), c)
        for j, (i, k) in enumerate(searched):
            hit = hit.when(c == len(lists) + j, F.when(has_whole_word(text, [k]), F.lit(i)))
        return hit
    return F.transform(found, index) if searched else found


_SKILLS = "array<struct<skill_name: string, skill_category: string>>"


# --- F10 / F11 -------------------------------------------------------------
def extract_skills(text: Column, dictionary: dict | None = None,
                   types: dict[str, str] | None = None, tokens: Column | None = None) -> Column:
    """array<struct<skill_name, skill_category>> in dictionary order, one entry per
    skill with any keyword as a whole word.  ``text`` is lower(desc + ' ' + title).

    With ``tokens`` (``_lists_found``) only keywords that the tokens point at are tried."""
    entries = D.skill_entries(dictionary, types)
    if not entries:
        return F.array().cast(_SKILLS)
    if tokens is not None:
        found = _lists_found(text, tokens, [kws for _, _, _, kws in entries])
    else:
        found = F.array(*[F.when(has_whole_word(text, kws), F.lit(i)) for i, (_, _, _, kws) in enumerate(entries)])
    # The lambdas keep these projections out of whole-stage codegen, where the keyword branches
    # became one method too big for the JIT.
    found = F.filter(found, lambda i: i.isNotNull())
    rows = F.array(*[F.struct(F.lit(name).alias("skill_name"), F.lit(kind).alias("skill_category")) for _, name, kind, _ in entries])
    found = F.transform(F.sort_array(F.array_distinct(found)), lambda i: F.get(rows, i))
    if len({name for _, name, _, _ in entries}) == len(entries):
        return found
    # a name that matched under an earlier category is not repeated
    return _let(found, lambda all_: F.filter(all_, lambda s, i: ~F.exists(
        F.slice(all_, F.lit(1), i), lambda e: e["skill_name"] == s["skill_name"])))


# --- F16 -------------------------------------------------------------------
def keyword_table(spark: SparkSession, dictionary: dict | None = None) -> DataFrame:
    """Flattened keyword -> skill map; a later category overwrites an earlier one."""
    rows = D.keyword_rows(dictionary)
    df = spark.createDataFrame(rows, "kw_order int, category string, skill_name string, keyword string")
    return (df.groupBy("keyword")
              .agg(F.max_by("skill_name", "kw_order").alias("skill_name")))


# --- F12 -------------------------------------------------------------------
def canonical_location(c: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """lower + strip, alias -> canonical, unknown -> normalised input, empty -> ''."""
    mapping = D.alias_map(aliases)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]) if mapping else F.lit(None).cast("map<string,string>")
    norm = F.regexp_replace(F.lower(c), f"^{WS}+|{WS}+$", "")
    return F.when(c.isNull() | (c == ""), F.lit("")) \
            .otherwise(F.coalesce(F.try_element_at(lookup, norm), norm))


def canonical_locations(spark: SparkSession, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """the canonical location names."""
    names = list((D.LOCATION_ALIASES if aliases is None else aliases).keys())
    return spark.createDataFrame([(n,) for n in names], "location string")


# --- F13-F15 ---------------------------------------------------------------
LABELS = [D.LABEL_COMPANY, D.LABEL_LOCATION, D.LABEL_POSTED]


def label_pattern(label: str, labels: list[str] | None = None) -> str:
    """Value after ``label:`` up to the next label or the end (group 1)."""
    stops = "|".join(escape(lb) + r"\s*:" for lb in (labels or LABELS))
    return rf"(?:^|[^\p{{L}}\p{{N}}_]){escape(label)}\s*:\s*(.*?)\s*(?:{stops}|$)"


DATE_LEAD = r"^([0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})"
DATE_ANY = r"([0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})"


def label_value(clean_desc: Column, label: str) -> Column:
    """Group 1 of the label pattern; the regex only runs where the label occurs
    as a substring (without it the pattern cannot match)."""
    text = F.coalesce(clean_desc, F.lit(""))
    return F.when(F.instr(text, label) > 0, F.regexp_extract(text, label_pattern(label), 1)) \
            .otherwise(F.lit(""))


def parse_date(s: Column) -> Column:
    """'dd/mm/yyyy' or 'yyyy-mm-dd' -> date; anything else -> NULL.

    The text's shape is looked at first, so a cast reads all that is left: a parser by pattern costs more a row."""
    iso = F.concat_ws("-", F.substring(s, 7, 4), F.substring(s, 4, 2), F.substring(s, 1, 2))
    return (F.when(s.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"), iso.try_cast("date"))
            .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), s.try_cast("date")))


def keyword_hits(tokens: Column, dictionaries: list[list[str]]) -> Column:
    """The row's tokens that are single-word keywords, or anchors of other keywords, of any given dictionary.

    One lookup per token in a set that is built once; the per-skill / per-level membership
    tests then run against this short array instead of every token."""
    keywords = {k.lower() for kws in dictionaries for k in kws}
    words = sorted({k if is_single_word(k) else anchor(k) for k in keywords} - {""})
    # the lambda keeps the projection out of whole-stage codegen, as in ``extract_skills``
    return F.array_distinct(F.filter(tokens, lambda t: t.isin(words)))


def with_labels(df: DataFrame, clean_desc: str, posting_date: str) -> DataFrame:
    """Add the labels' values and the dates' texts, one column each: the functions below name
    them more than once, and inside conditions every mention would run its patterns again."""
    text = F.col(clean_desc)
    d = df.select("*", *[label_value(text, lb).alias(name) for lb, name in
                         ((D.LABEL_COMPANY, "_company"), (D.LABEL_LOCATION, "_location"), (D.LABEL_POSTED, "_posted"))])
    return d.select("*", F.regexp_extract("_posted", DATE_LEAD, 1).alias("_posted_lead"),
                    F.regexp_extract(F.coalesce(posting_date, F.lit("")), DATE_ANY, 1).alias("_posted_any"))


def extract_company(label: Column, raw_company: Column) -> Column:
    """text after 'công ty:', else the raw company."""
    return F.coalesce(F.nullif(label, F.lit("")), raw_company)


def extract_location(label: Column, raw_location: Column,
                     aliases: dict[str, list[str]] | None = None) -> Column:
    """text after 'địa điểm:' made canonical, else the raw location."""
    return F.when(label != "", canonical_location(label, aliases)).otherwise(raw_location)


def extract_posted_date(lead: Column, raw_date: Column) -> Column:
    """the leading date after 'ngày cập nhật:'; else the first date in the raw
    posting date text."""
    return F.coalesce(parse_date(lead), parse_date(raw_date))


def posted_text(label: Column, raw_posting_date: Column) -> Column:
    """The text that tells the posting's date, whether it can be read or not; NULL where nothing does."""
    return F.coalesce(F.nullif(label, F.lit("")), F.nullif(F.trim(raw_posting_date), F.lit("")))


__all__ = [
    "with_labels", "posted_text", "detect_seniority", "extract_skills", "keyword_table",
    "canonical_location", "canonical_locations", "extract_company", "extract_location",
    "extract_posted_date", "parse_date", "label_pattern", "keyword_hits",
]
