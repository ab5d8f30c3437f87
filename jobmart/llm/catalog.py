"""The registered queries of the operators in this package, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import convtrie, embed_dedup, fingerprint, html_extract, lexsearch, lm, mixing, ngram_join, packing, tokencount, toxicity, urlfilter, warc
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _reach(nodes: str, links: str) -> str:
    """CTE ``comp``: the smallest node that each node of ``links`` (a, b) reaches."""
    return f"""
reach(node, seen) AS (SELECT node, node FROM {nodes} UNION SELECT l.a, r.seen FROM reach r JOIN {links} l ON l.b = r.node),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)"""


_JOIN_SQL = f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
grams AS (SELECT DISTINCT doc_id AS node, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: list_slice(ws, i, i + 4))
                             WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS g FROM w)),
sizes AS (SELECT node, count(*) AS n FROM grams GROUP BY node),
links AS (SELECT a, b, c = na AND c = nb AS same FROM (
  SELECT x.node AS a, y.node AS b, count(*) AS c, any_value(sx.n) AS na, any_value(sy.n) AS nb
  FROM grams x JOIN grams y ON x.g = y.g AND x.node <> y.node JOIN sizes sx ON sx.node = x.node JOIN sizes sy ON sy.node = y.node
  GROUP BY 1, 2) WHERE c >= 0.8 * (na + nb - c)),
{_reach("(SELECT doc_id AS node FROM documents)", "links")}
SELECT d.doc_id, least(d.doc_id, (SELECT min(b) FROM links l WHERE l.a = d.doc_id AND same)) AS class_id,
  (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c ON c.node = d.doc_id"""

_DEDUP_SQL = f"""WITH RECURSIVE v AS (
  SELECT vec_id AS node, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
links AS (SELECT x.node AS a, y.node AS b FROM v x JOIN v y ON x.node <> y.node AND list_cosine_similarity(x.e, y.e) >= 0.9),
{_reach("(SELECT vec_id AS node FROM embeddings)", "links")}
SELECT m.vec_id, (SELECT count(*) FROM links l WHERE l.a = m.vec_id) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN comp c ON c.node = m.vec_id"""

_WARC_SQL = """WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, octet_length(encode(h)) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(CAST(
    substr(CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR), CAST(i * 5 + 1 AS BIGINT), 5) AS BIT) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to, url
FROM p"""


_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

_SEARCH_SQL = f"""WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
total AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS docs, CAST(sum(len(ts)) AS BIGINT) AS words FROM d),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
gain AS (SELECT tf.doc_id, tf.t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))) AS gain
  FROM tf JOIN df ON df.t = tf.t CROSS JOIN total),
scores AS (SELECT item_id, doc_id, CAST(sum(gain) AS BIGINT) AS score
  FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) i JOIN gain g ON g.t = i.t GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


# the remainder table of the checksum's polynomial for four bits at a time
_NIBBLES = []
for _i in range(16):
    for _ in range(4):
        _i = _i >> 1 ^ (0xEDB88320 if _i & 1 else 0)
    _NIBBLES.append(_i)


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    def step(x: str) -> str:
        return f"xor(list_extract([{', '.join(f'{n}::UBIGINT' for n in _NIBBLES)}], ({x} & 15)::BIGINT + 1), {x} >> 4)"
    return (f"xor(4294967295::UBIGINT, list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT), "
            f"lambda r, c: {step(step('xor(r, c)'))}, 4294967295::UBIGINT))")


_TRIE_SQL = f"""WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 20 AS base, CAST({_crc32_sql('CAST(c AS VARCHAR)')} % 4 AS BIGINT) AS h FROM (SELECT DISTINCT c FROM t)),
parts AS (SELECT convs.c, 0 AS own, t.pos, t.role, t.text FROM convs JOIN t ON t.c = convs.base AND t.pos <= h
  UNION ALL SELECT convs.c, 1, t.pos, t.role, t.text FROM convs JOIN t ON t.c = convs.c AND t.pos > h),
seqs AS (SELECT convs.c, coalesce(s, []) AS s FROM convs LEFT JOIN (
  SELECT c, list(sha256(length(role) || ':' || role || text) ORDER BY own, pos) AS s FROM parts GROUP BY c) USING (c)),
words AS (SELECT DISTINCT sha256(length(role) || ':' || role || text) AS k, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n FROM t),
pref AS (SELECT c, d, list_slice(s, 1, d) AS node, len(s) = d AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (SELECT node, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM pref GROUP BY node, d),
kids AS (SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce((SELECT n FROM words WHERE k = nodes.node[depth]), 0) AS saved
  FROM nodes LEFT JOIN kids ON kids.node = nodes.node),
up AS (SELECT list_slice(node, 1, d) AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT node, n_children, saved, unnest(range(0, depth + 1)) AS d FROM whole) GROUP BY 1)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, up.n_leaves, up.saved_tokens, w.ends_sha256
FROM whole w JOIN up ON up.node = w.node LEFT JOIN nodes p ON w.depth > 0 AND p.node = list_slice(w.node, 1, w.depth - 1)"""


@register("op1_best_fit_packing")
def q_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@register("op4_token_counts")
def q_token_counts(spark, sf_dir):
    """Tokens of every line of every document, attributed from one encoding of the whole text."""
    return tokencount.count_lines(read_table(spark, sf_dir, "documents"))


@register("op5_toxicity")
def q_toxicity(spark, sf_dir):
    """Category probabilities of every document from a chain fitted on ``labels``."""
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op6_ngram_jaccard_join", _JOIN_SQL)
def q_ngram_join(spark, sf_dir):
    """Links and components of all documents by five-word shingles, similarity 0.8 or more."""
    return ngram_join.jaccard_join(read_table(spark, sf_dir, "documents")).drop("node")


@register("op8_warc", _WARC_SQL)
def q_warc(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return warc.round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@register("op9_fingerprints")
def q_fingerprints(spark, sf_dir):
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprint.compare_with_next(read_table(spark, sf_dir, "documents"))


@register("op10_mix_sources")
def q_mix(spark, sf_dir):
    """All documents mixed to target weights."""
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@register("op3_lm_scores")
def q_lm(spark, sf_dir):
    """Scores of all documents under a model learned from the training fold."""
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


@register("op7_embedding_near_dedup", _DEDUP_SQL)
def q_embeddings(spark, sf_dir):
    """Links and components of all embeddings by cosine, 0.9 or more."""
    return embed_dedup.near_dedup(read_table(spark, sf_dir, "embeddings"))


@register("op2_html_extraction")
def q_html(spark, sf_dir):
    """Main text of every page, by a field trained on labelled pages."""
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


@register("op13_ranked_search", _SEARCH_SQL)
def q_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return lexsearch.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op11_conversation_trie", _TRIE_SQL)
def q_trie(spark, sf_dir):
    """The prefix trie of all rebuilt conversations."""
    return convtrie.prefix_trie(read_table(spark, sf_dir, "conversations"))


@register("op12_url_filters")
def q_url_filters(spark, sf_dir):
    """Every page's URL judged by the rules, else by a model trained on a small labelled table."""
    labelled = spark.createDataFrame(urlfilter.labelled_urls(), "url string, block int")
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), urlfilter.train(labelled))
