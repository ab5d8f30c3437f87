"""Skills from a dictionary table (J08, U01): for dictionaries too large to be one
projection, or kept as data.

Two ways with the same result.  A dictionary within ``MAX_KEYWORDS`` keywords and ``MAX_CHARS`` characters (counted
first) is sent to the executors, which run its Aho-Corasick automaton over Arrow batches of texts: one
pass over each text however many keywords there are, and no shuffle.  Beyond that, texts and keywords meet in an
equi-join: every keyword has an anchor, the longest of its words (a keyword without word
characters: its first character), and a keyword that occurs in a text as a whole word
brings its anchor as a word of the text.  Only (key, anchor) rows pass that join; the candidates of a
text then meet it once, and are checked there by the whole-word pattern.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NON_WORD, WORD, word_tokens

MAX_KEYWORDS, MAX_CHARS = 200_000, 8_000_000
_SKILL = "array<struct<skill_name:string,skill_category:string>>"


def _escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\.^$|?*+()\[\]{}])", r"\\$1")


def dictionary_table(dictionary: DataFrame) -> DataFrame:
    """``dictionary`` (entry_order, skill_name, skill_category, keyword) with each keyword's
    anchor and whole-word pattern; null and empty keywords are left out."""
    kw = F.lower("keyword")
    words = F.filter(word_tokens(kw), lambda w: w != "")
    longest = F.reduce(words, F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a))
    left = F.when(kw.rlike("^" + WORD), F.lit(f"(?:^|{NON_WORD})")).otherwise(F.lit(WORD))
    right = F.when(kw.rlike(WORD + "$"), F.lit(f"(?:$|{NON_WORD})")).otherwise(F.lit(WORD))
    return (dictionary.filter(F.length("keyword") > 0)
            .select("entry_order", "skill_name", "skill_category",
                    F.when(longest != "", longest).otherwise(F.substring(kw, 1, 1)).alias("anchor"),
                    F.concat(left, _escaped(kw), right).alias("pattern")))


# --- the automaton -----------------------------------------------------------------
@lru_cache(maxsize=1 << 16)
def _word_char(ch: str) -> bool:
    return ch == "_" or unicodedata.category(ch)[0] in "LN"


class Matcher:
    """An Aho-Corasick automaton over lower-case keywords; an occurrence counts when both of its
    ends are word boundaries (between a word character and another or the text's end)."""

    def __init__(self, entries: list[tuple[int, str, str | None, str]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for order, name, category, keyword in sorted(entries, key=lambda e: (e[0], e[2] is not None, e[2] or "")):
            if keyword not in self.automaton:
                self.automaton.add_word(keyword, (len(keyword), _word_char(keyword[0]), _word_char(keyword[-1]), []))
            self.automaton.get(keyword)[3].append((order, category is not None, category or "", name))
        if len(self.automaton):
            self.automaton.make_automaton()

    def skills(self, text: str) -> list[tuple[str, str | None]]:
        """(name, category) of the skills in ``text``, in the order of their entries."""
        best: dict[str, tuple] = {}
        if not len(self.automaton):
            return []
        last = len(text) - 1
        for end, (size, left, right, entries) in self.automaton.iter(text):
            start = end - size + 1
            if (start > 0 and _word_char(text[start - 1])) == left or (end < last and _word_char(text[end + 1])) == right:
                continue
            for e in entries:
                if e[3] not in best or e < best[e[3]]:
                    best[e[3]] = e
        return [(name, category if known else None) for _, known, category, name in sorted(best.values())]


def _by_automaton(rows: DataFrame, entries: list[tuple], key: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(entries)        # at most MAX_CHARS characters of keywords

    @F.pandas_udf(_SKILL)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value)
        for texts in batches:
            yield pd.Series([[{"skill_name": n, "skill_category": c} for n, c in matcher.skills(t)] for t in texts])
    return (rows.select(key, F.posexplode(run("_text")).alias("skill_pos", "s"))
            .select(key, "skill_pos", "s.skill_name", "s.skill_category"))


# --- anchors -----------------------------------------------------------------------
def _by_anchors(rows: DataFrame, dictionary: DataFrame, key: str) -> DataFrame:
    """A word that every text holds is a hot key on one side only and meets few keywords;
    adaptive execution splits the skewed side."""
    anchors = F.concat(F.filter(word_tokens(F.col("_text")), lambda w: w != ""),
                       F.regexp_extract_all("_text", F.lit(f"({NON_WORD})"), F.lit(1)))
    narrow = rows.select(key, F.explode(F.array_distinct(anchors)).alias("anchor"))
    # a text meets all its candidates in one row
    candidates = (narrow.join(dictionary_table(dictionary), "anchor")
                  .groupBy(key).agg(F.collect_list(F.struct("entry_order", "skill_category", "skill_name", "pattern")).alias("_c")))
    held = rows.join(candidates, key).select(
        key, F.explode(F.filter("_c", lambda c: F.regexp_like(F.col("_text"), c["pattern"]))).alias("c"))
    # still dealt by key: neither step shuffles
    hits = held.groupBy(key, "c.skill_name").agg(F.min(F.struct("c.entry_order", "c.skill_category")).alias("e"))
    by_entry = Window.partitionBy(key).orderBy("e", "skill_name")
    return hits.select(key, (F.row_number().over(by_entry) - 1).alias("skill_pos"), "skill_name",
                       F.col("e.skill_category").alias("skill_category"))


def extract_skills_by_table(postings: DataFrame, dictionary: DataFrame, key: str = "ingest_seq",
                            title: str = "job_title", description: str = "job_description",
                            automaton: bool | None = None) -> DataFrame:
    """(key, skill_pos, skill_name, skill_category): what ``extract_skills`` finds, for a
    dictionary of any size.

    ``automaton`` picks the way; by default the dictionary's size does.  ``key`` must tell rows apart."""
    text = F.lower(F.concat(F.col(description), F.lit(" "), F.col(title)))
    rows = postings.select(key, text.alias("_text")).filter(F.col("_text").isNotNull())
    kw = dictionary.filter((F.length("keyword") > 0) & F.col("skill_name").isNotNull())
    if automaton is None:
        size = kw.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("keyword") + F.length("skill_name")).alias("chars")).first()
        automaton = size.n <= MAX_KEYWORDS and (size.chars or 0) <= MAX_CHARS
    if automaton:
        entries = kw.select("entry_order", "skill_name", "skill_category", F.lower("keyword").alias("k")).collect()
        return _by_automaton(rows, [tuple(e) for e in entries], key)
    return _by_anchors(rows, kw, key)
