"""Ranked lexical search by pipelined term partitioning.

The index of the query terms is cut twice: by shards of documents and by term owners.  A
bundle holds, for one shard, the sparse accumulators (document, score) of all items of a
block.  It visits the owners one after another by ``cogroup``: an owner meets the bundle
with its terms' postings of that shard, adds their integer contributions and sends the
bundle on.  Owners are in order of falling term weight, so that rare terms come first; an
accumulator goes only when even the largest contributions that all later owners could add
leave it below the shard's k-th best partial score, which no final answer can be.  The last
owner's stage selects k documents per item and shard, and a window the k best of those.

A scan of the documents keeps the postings of query terms alone.  Items are taken in blocks of bounded
size (``BLOCK_ITEMS``, ``BLOCK_TERMS``), each against all documents; only a block's vocabulary is sent to the
executors, and only its terms' statistics return.

Terms are told apart by 64-bit hashes.  Defined results: null text has no terms; a document
or an item without terms takes part in nothing; every row is a document of its own, also
when rows share an id, and every row of ``items`` an item of its own; documents without an id
rank behind equal scores with one; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_staged, stage
from .common import ensure_checkpoint_dir, materialize, partitions, text_or_empty
from .hashing import token_hashes

TOP = 10
OWNERS = 4
SHARD_DOCS, SHARD_CHARS = 4096, 4_000_000     # a longer text is a shard of its own
BLOCK_ITEMS, BLOCK_TERMS = 512, 500_000

# the bytes that end a term: ASCII without digits and letters
_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts in order, and each text's number of terms."""
    return token_hashes(texts, _BREAK)


def factor(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a document's occurrences of a term count, before the term's weight."""
    m = 100 - 75 + (75 * n * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    lo = held = 0
    for i, s in enumerate(sizes.tolist()):
        if i > lo and (i - lo == SHARD_DOCS or held + s > SHARD_CHARS):
            yield lo, i
            lo, held = i, 0
        held += s
    if lo < len(sizes):
        yield lo, len(sizes)


_SHARDS = ("shard long, ids binary, unknown binary, n binary, terms binary, held binary, doc binary, tf binary, "
           "docs long, words long")


def _index(docs: DataFrame, vocabulary, key: str, text: str) -> DataFrame:
    """The postings of the vocabulary, one row a shard of documents, by term and document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, shard = vocabulary.value, TaskContext.get().partitionId() << 32
        for pdf in batches:
            for lo, hi in _slices(pdf["text"].str.len().to_numpy(np.int64)):
                part = pdf.iloc[lo:hi]
                found, n = term_hashes(part["text"].tolist())
                at = np.minimum(np.searchsorted(names, found), len(names) - 1)
                doc = np.repeat(np.arange(hi - lo), n)
                hit = names[at] == found
                pairs, tf = np.unique(at[hit] * np.int64(hi - lo) + doc[hit], return_counts=True)
                terms, held = np.unique(pairs // (hi - lo), return_counts=True)
                yield pd.DataFrame([(
                    shard, part["id"].to_numpy("<i8").tobytes(), part["unknown"].to_numpy(bool).tobytes(),
                    n.astype("<i8").tobytes(), terms.astype("<i4").tobytes(), held.astype("<i4").tobytes(),
                    (pairs % (hi - lo)).astype("<u2").tobytes(), tf.astype("<i4").tobytes(), int((n > 0).sum()), int(n.sum()))],
                    columns=[c.split()[0] for c in _SHARDS.split(", ")])
                shard += 1
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.col(key).isNull().alias("unknown"),
                       text_or_empty(text).alias("text"))
    return rows.mapInPandas(run, _SHARDS)


def _unpack(row, docs: int, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's terms, ends of their postings, documents and factors."""
    doc = np.frombuffer(row.doc, "<u2")
    n, tf = np.frombuffer(row.n, "<i8"), np.frombuffer(row.tf, "<i4").astype(np.int64)
    return np.frombuffer(row.terms, "<i4"), np.cumsum(np.frombuffer(row.held, "<i4")), doc, factor(tf, n[doc], docs, terms)


def _statistics(index: DataFrame, size: int, docs: int, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(df, largest factor) of every term of the vocabulary."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for pdf in batches:
            for row in pdf.itertuples():
                names, ends, _, f = _unpack(row, docs, terms)
                if len(names):
                    df[names] += np.diff(ends, prepend=0)
                    top[names] = np.maximum(top[names], np.maximum.reduceat(f, np.r_[0, ends[:-1]]))
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"term": seen, "df": df[seen], "top": top[seen]})
    found = (index.select("n", "terms", "held", "doc", "tf").mapInPandas(run, "term long, df long, top long")
             .groupBy("term").agg(F.sum("df").alias("df"), F.max("top").alias("top")).toPandas())
    df, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    df[found["term"].to_numpy(np.int64)] = found["df"]
    top[found["term"].to_numpy(np.int64)] = found["top"]
    return df, top


def owners_of(df: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """The owner of every term: falling weight, about the same number of postings each."""
    order = np.lexsort((np.arange(len(df)), -weights))
    middle = 2 * np.cumsum(df[order]) - df[order]
    owner = np.zeros(len(df), np.int64)
    owner[order] = np.minimum(middle * count // max(2 * int(df.sum()), 1), count - 1)
    return owner


def _by_owner(index: DataFrame, owner, docs: int, terms: int) -> DataFrame:
    """One row for each owner and shard: the shard's postings of the owner's terms."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = owner.value
        for pdf in batches:
            for row in pdf.itertuples():
                names, ends, doc, f = _unpack(row, docs, terms)
                held = np.diff(ends, prepend=0)
                each = np.repeat(of[names], held)
                for o in np.unique(of[names]).tolist():
                    mine = of[names] == o
                    yield pd.DataFrame([(o, row.shard, names[mine].astype("<i4").tobytes(), held[mine].astype("<i4").tobytes(),
                                         doc[each == o].tobytes(), f[each == o].astype("<i4").tobytes())],
                                       columns=["owner", "shard", "terms", "held", "doc", "f"])
    return (index.select("shard", "n", "terms", "held", "doc", "tf")
            .mapInPandas(run, "owner int, shard long, terms binary, held binary, doc binary, f binary"))


class Plan:
    """What a block's stages share: each item's (term, weight times occurrences) by owner, and
    the most that the owners after a stage can add to an item's score."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, top: np.ndarray, owner: np.ndarray,
                 count: int, k: int):
        self.count, self.k = count, k
        self.gains = [[{} for _ in items] for _ in range(count)]
        self.left = np.zeros((count, len(items)), np.int64)
        for i, (names, times) in enumerate(items):
            gain = weights[names] * times
            for t, g in zip(names[gain > 0].tolist(), gain[gain > 0].tolist()):
                self.gains[owner[t]][i][t] = g
                self.left[:owner[t], i] += g * int(top[t])


def select_best(score: np.ndarray, ids: np.ndarray, unknown: np.ndarray, k: int) -> np.ndarray:
    """The k largest scores; equal ones by ascending id, rows without an id last."""
    return np.lexsort((ids, unknown, -score))[:k]


def visit(plan: Plan, owner: int, bundle, postings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each item's accumulators (documents, scores) after the owner's contributions."""
    size = len(bundle.unknown)
    ends = np.cumsum(np.frombuffer(bundle.held, "<i4"))
    doc, score = np.frombuffer(bundle.doc, "<u2"), np.frombuffer(bundle.score, "<i8")
    where: dict[int, tuple[int, int]] = {}
    if postings is not None:
        stop = np.cumsum(np.frombuffer(postings.held, "<i4"))
        where = dict(zip(np.frombuffer(postings.terms, "<i4").tolist(), zip(np.r_[0, stop[:-1]].tolist(), stop.tolist())))
        new_doc, f = np.frombuffer(postings.doc, "<u2"), np.frombuffer(postings.f, "<i4").astype(np.int64)
    out = []
    for i, gains in enumerate(plan.gains[owner]):
        lo, hi = (int(ends[i - 1]) if i else 0), int(ends[i])
        total = np.zeros(size, np.int64)
        total[doc[lo:hi]] = score[lo:hi]
        for term, gain in gains.items():
            if term in where:
                a, b = where[term]
                total[new_doc[a:b]] += gain * f[a:b]
        live = np.flatnonzero(total)
        if len(live) > plan.k:
            value = total[live]
            bar = np.partition(value, len(value) - plan.k)[len(value) - plan.k]
            live = live[value + plan.left[owner, i] >= bar]
        out.append((live, total[live]))
    return out


_BUNDLE = "shard long, ids binary, unknown binary, held binary, doc binary, score binary"


def _stage(plan, owner: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for b in left.itertuples():
            found = visit(plan.value, owner, b, next(right.itertuples(), None))
            if owner < plan.value.count - 1:
                rows.append((b.shard, b.ids, b.unknown, np.array([len(d) for d, _ in found], "<i4").tobytes(),
                             np.concatenate([d for d, _ in found]).astype("<u2").tobytes(),
                             np.concatenate([s for _, s in found]).astype("<i8").tobytes()))
                continue
            ids, unknown = np.frombuffer(b.ids, "<i8"), np.frombuffer(b.unknown, bool)
            for i, (doc, score) in enumerate(found):
                best = select_best(score, ids[doc], unknown[doc], plan.value.k)
                rows += [(i, int(ids[doc[j]]), bool(unknown[doc[j]]), int(score[j])) for j in best]
        names = _BUNDLE if owner < plan.value.count - 1 else _FOUND
        return pd.DataFrame(rows, columns=[c.split()[0] for c in names.split(", ")])
    return run


_FOUND = "item int, id long, unknown boolean, score long"


def _search_block(docs: DataFrame, items: list, item_id: str, id_type, key: str, text: str, k: int, count: int) -> DataFrame | None:
    spark = docs.sparkSession
    terms = [np.unique(np.frombuffer(r.terms, "<u8"), return_counts=True) for r in items]
    names = np.unique(np.concatenate([t for t, _ in terms]))
    if not len(names):
        return None
    share = spark.sparkContext.broadcast
    index, index_at = stage(_index(docs, share(names), key, text), "lex-index")
    total = index.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    if not total.docs:
        drop_staged(spark, [index_at])
        return None
    df, top = _statistics(index, len(names), total.docs, total.words)
    weights = np.array([weight(int(d), total.docs) if d else 0 for d in df], np.int64)
    owner = owners_of(df, weights, count)
    plan = share(Plan([(np.searchsorted(names, t), n) for t, n in terms], weights, top, owner, count, k))
    owned_at = f"{index_at}-owned"
    _by_owner(index, share(owner), total.docs, total.words).write.partitionBy("owner").parquet(owned_at)
    owned = spark.read.schema("shard long, terms binary, held binary, doc binary, f binary, owner int").parquet(owned_at)

    parts = partitions(spark)
    nothing = F.lit(b"")
    bundles = index.select("shard", "ids", "unknown", F.lit(np.zeros(len(items), "<i4").tobytes()).alias("held"),
                           nothing.alias("doc"), nothing.alias("score"))
    for o in range(count):
        mine = owned.filter(F.col("owner") == o).drop("owner")
        bundles = (bundles.repartition(parts, "shard").groupBy("shard").cogroup(mine.repartition(parts, "shard").groupBy("shard"))
                   .applyInPandas(_stage(plan, o), _BUNDLE if o < count - 1 else _FOUND))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "unknown", "id")
    names_of = spark.createDataFrame([(i, r[item_id]) for i, r in enumerate(items)], f"item int, item_id {id_type}")
    ranked = (bundles.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
              .join(F.broadcast(names_of), "item")       # at most BLOCK_ITEMS rows
              .select("item_id", "rank", F.when(~F.col("unknown"), F.col("id")).alias("doc_id"), "score"))
    out = materialize(ranked, "lex-ranked")              # k rows an item
    drop_staged(spark, [index_at, owned_at])
    return out


def search(docs: DataFrame, items: DataFrame, k: int = TOP, owners: int = OWNERS, key: str = "doc_id", text: str = "text",
           item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest scores above 0 for every row of ``items``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [term_hashes([t])[0] for t in pdf.pop("text")]
            pdf["terms"], pdf["size"] = [f.astype("<u8").tobytes() for f in found], [len(f) for f in found]
            yield pdf
    id_type = items.schema[item_id].dataType.simpleString()
    # an id travels as text: pandas would turn a long column with nulls into floats
    queries, queries_at = stage(
        items.select(F.col(item_id).cast("string").alias(item_id), text_or_empty(text).alias("text"),
                     F.monotonically_increasing_id().alias("row"))
        .mapInPandas(terms, f"{item_id} string, row long, terms binary, size long")
        .withColumn(item_id, F.col(item_id).cast(id_type)), "lex-items")
    total = queries.agg(F.count(F.lit(1)).alias("items"), F.sum("size").alias("terms")).first()
    blocks = max(1, math.ceil(total["items"] / BLOCK_ITEMS), math.ceil((total["terms"] or 0) / BLOCK_TERMS))
    found = []
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("row").collect()   # a block is bounded
        got = _search_block(docs, block, item_id, id_type, key, text, k, owners) if block else None
        found += [got] if got is not None else []
    drop_staged(spark, [queries_at])
    if not found:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
