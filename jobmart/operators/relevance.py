"""Relevance filters and key phrases."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions.text import WS_RUN
from ..functions.vectors import cosine_similarity


def keyword_matches(title: Column, description: Column, query: str) -> Column:
    """P05 count: query words (lower-cased, split on whitespace, repeats kept)
    that occur as substrings of lower(title + ' ' + description)."""
    words = query.lower().split()
    text = F.lower(F.concat_ws(" ", title, description))
    if not words:
        return F.lit(0)
    total = None
    for w in words:
        hit = (F.instr(text, w) > 0).cast("int")
        total = hit if total is None else total + hit
    return total


def keyword_threshold(query: str) -> int:
    return max(1, len(query.lower().split()) // 2)


def keyword_relevance(df: DataFrame, query: str, title: str = "job_title",
                      description: str = "job_description") -> DataFrame:
    """Adds ``matched_words`` and ``relevant`` (an empty query keeps nothing)."""
    m = keyword_matches(F.col(title), F.col(description), query)
    ok = (m >= keyword_threshold(query)) if query.split() else F.lit(False)
    return df.select("*", m.alias("matched_words"), ok.alias("relevant"))


def semantic_relevance(df: DataFrame, vector: str, query_vector: Column,
                       threshold: float = D.SEMANTIC_THRESHOLD,
                       fallback: Column | None = None, query_norm: Column | None = None) -> DataFrame:
    """cosine(vector, query_vector) >= threshold.  Where the similarity is
    undefined (missing or zero vector) the ``fallback`` flag decides (P05 in the
    original); without one the row is not relevant."""
    sim = cosine_similarity(F.col(vector), query_vector, query_norm)
    rel = F.when(sim.isNotNull(), sim >= threshold)
    rel = F.coalesce(rel, fallback if fallback is not None else F.lit(False))
    return df.select("*", sim.alias("similarity"), rel.alias("relevant"))


def embed_text(title: Column, description: Column, chars: int | None = None) -> Column:
    """The text to embed (U03): title + ' ' + the description, whole unless the
    caller asks for its first ``chars`` characters."""
    return F.concat_ws(" ", title, description if chars is None else F.substring(description, 1, chars))


def word_frequency(df: DataFrame, text: str = "text", key: str = "doc_id",
                   stop_words: list[str] | None = None) -> DataFrame:
    """(key, word, freq, first_pos) for the words the key-phrase extractor
    counts (lower-cased, whitespace split, stop words and words of <= 3 chars
    dropped; texts under 50 chars skipped).  A (key, word) aggregate, combined
    map-side, over whole texts."""
    stops = stop_words if stop_words is not None else D.STOP_WORDS
    d = df.select(key, text).filter(F.length(text) >= D.KEY_PHRASE_MIN_TEXT)
    words = (d.select(key, F.posexplode_outer(F.split(F.lower(F.col(text)), WS_RUN)).alias("pos", "word"))
             .filter((F.length("word") >= D.KEY_PHRASE_MIN_WORD) & ~F.col("word").isin(stops)))
    return words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("freq"),
                                          F.min("pos").alias("first_pos"))


_PHRASES = "array<struct<word: string, freq: bigint>>"


def _phrases(text: Column, top_n: int, stop_words: list[str] | None) -> Column:
    """The ``top_n`` most frequent words of a text, counted inside its row."""
    stops = frozenset(stop_words if stop_words is not None else D.STOP_WORDS)
    least, shortest = D.KEY_PHRASE_MIN_WORD, D.KEY_PHRASE_MIN_TEXT

    @F.pandas_udf(_PHRASES)
    def count(lowered: pd.Series) -> pd.Series:
        out = []
        for t in lowered:
            words = [] if t is None else [w for w in t.split() if len(w) >= least and w not in stops]
            # str.split() knows the white space of WS_RUN; Counter keeps first positions' order among equal counts
            out.append([{"word": w, "freq": n} for w, n in Counter(words).most_common(top_n)])
        return pd.Series(out, dtype=object)
    return count(F.when(F.length(text) >= shortest, F.lower(text)))


def key_phrases(df: DataFrame, text: str = "text", key: str = "doc_id", top_n: int = 5,
                stop_words: list[str] | None = None) -> DataFrame:
    """the ``top_n`` most frequent words per text (lower-cased, whitespace
    split, stop words and words of <= 3 chars dropped; ties by first position).
    Texts shorter than 50 chars give none.  Rows: (key, rank, word, freq).

    A text lies in one row, so it is counted there: nothing is shuffled, and rows
    that share a key stay apart.  Whole texts are read; nothing is truncated."""
    p = df.select(key, F.posexplode_outer(_phrases(F.col(text), top_n, stop_words)).alias("pos", "p"))
    return (p.filter(F.col("p").isNotNull())
            .select(key, (F.col("pos") + 1).alias("rank"), "p.word", "p.freq"))


def key_phrase_lists(df: DataFrame, text: str = "text", key: str = "doc_id", top_n: int = 5,
                     stop_words: list[str] | None = None) -> DataFrame:
    """F18 as one ordered list of words per text; ``[]`` where there are none."""
    return (df.select(key, _phrases(F.col(text), top_n, stop_words).alias("_p"))
            .select(key, F.col("_p.word").alias("key_phrases")))


def semantic_relevance_text(df: DataFrame, embed, query: str, title: str = "job_title",
                            description: str = "job_description",
                            threshold: float = D.SEMANTIC_THRESHOLD, chars: int | None = None) -> DataFrame:
    """P06 with a user embedding function (U03): ``embed(list[str]) -> list[list[float]]``.

    Texts (title + ' ' + description, whole unless ``chars`` is given) are embedded in
    Arrow batches on the executors; the query is embedded once on the driver -- a
    single vector.  Where ``embed`` raises (a batch, or the query) or the similarity is
    undefined, the keyword test (P05) decides, as the original does without a model."""

    @F.pandas_udf("array<float>")
    def embed_batch(texts: pd.Series) -> pd.Series:
        try:
            return pd.Series([list(map(float, v)) for v in embed(texts.tolist())])
        except Exception:  # noqa: BLE001  a model's failure is any exception
            return pd.Series([None] * len(texts), dtype=object)

    try:
        qvec = [float(x) for x in embed([query])[0]]
    except Exception:  # noqa: BLE001
        qvec = []
    vec = embed_batch(embed_text(F.col(title), F.col(description), chars)) if qvec else F.lit(None).cast("array<float>")
    kw = keyword_matches(F.col(title), F.col(description), query) >= keyword_threshold(query) \
        if query.split() else F.lit(False)
    out = semantic_relevance(df.select("*", vec.alias("_embedding")), "_embedding",
                             F.array(*[F.lit(x) for x in qvec]).cast("array<double>"), threshold, fallback=kw,
                             query_norm=F.lit(math.sqrt(sum(x * x for x in qvec))))
    return out.drop("_embedding")
