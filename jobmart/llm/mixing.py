"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are word counts.  Sources, in code point order (null last), weigh 1, 2, 3, 1, 2,
3, ...; their targets share ``total`` by weight, stop at ``max_repeats`` times the
source's size, and the excess is shared again among the others.

Each source takes all its documents ``q`` whole times and one more copy of some of
them.  Which ones: the source's documents are counted by exact size, the remaining
budget is met by taking the same share of every size, and what is left by a bounded
knapsack over the counts (subset-sum dynamic programming).  ``m`` documents of a
size are then chosen by a seeded hash: a hash bucket is taken whole until the bucket
where the count is reached, so a size that a third of all rows share is split into
buckets of a few hundred rows and never ordered in one task.

Defined results: null text has size 0; a source whose documents are all empty has
target 0; null sources are one source; repeated rows are separate documents, of
which it does not matter which one is taken; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, text_or_empty, unused

SEED = 20240229
BUCKET_ROWS = 256
SOURCES_BROADCAST = 100_000


def share_targets(sizes: np.ndarray, weights: np.ndarray, total: float, max_repeats: float) -> np.ndarray:
    """Targets by weight, none above ``max_repeats * size``; excess is shared again."""
    cap = max_repeats * sizes.astype(float)
    target = np.zeros(len(sizes))
    open_ = cap > 0
    left = float(total)
    while open_.any():
        share = left * weights / weights[open_].sum()
        over = open_ & (share > cap)
        if not over.any():
            target[open_] = share[open_]
            break
        target[over] = cap[over]
        left -= cap[over].sum()
        open_ &= ~over
    return target


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, dp_limit: int = 1 << 17) -> np.ndarray:
    """How many documents of each size to take so that their words come to at most and
    as near as possible to ``budget``.

    Whole shares first; while more than ``dp_limit`` words remain, one document of each
    size that fits, longest first; then subset-sum dynamic programming over the
    documents left, whose counts are split into powers of two."""
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    total = int((sizes * counts).sum())
    take = np.zeros(len(sizes), np.int64)
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    take = (counts.astype(object) * int(budget) // total).astype(np.int64)
    take[sizes == 0] = 0
    rest = int(budget - (take * sizes).sum())
    order = np.argsort(-sizes, kind="stable")
    while rest > dp_limit:
        before = rest
        for i in order:
            if sizes[i] and take[i] < counts[i] and sizes[i] <= rest:
                k = 1 if rest - sizes[i] > dp_limit else 0
                take[i] += k
                rest -= k * int(sizes[i])
            if rest <= dp_limit:
                break
        if rest == before:
            break
    if rest > dp_limit:   # every document left that fits leaves less than the limit: take the longest
        for i in order:
            while sizes[i] and take[i] < counts[i] and sizes[i] <= rest and rest > dp_limit:
                take[i] += 1
                rest -= int(sizes[i])
    if rest <= 0 or rest > dp_limit:
        return take
    reached_by = np.full(rest + 1, -1, np.int64)
    reached = np.zeros(rest + 1, bool)
    reached[0] = True
    parts: list[tuple[int, int]] = []
    for i in order[::-1]:
        size, left = int(sizes[i]), int(counts[i] - take[i])
        if size == 0 or size > rest:
            continue
        left, k = min(left, rest // size), 1
        while left > 0:
            n = min(k, left)
            left, k = left - n, k * 2
            w = n * size
            new = reached[:-w] & ~reached[w:] if w <= rest else None
            if new is not None and new.any():
                at = np.flatnonzero(new) + w
                reached[at] = True
                reached_by[at] = len(parts)
            parts.append((int(i), n))
        if reached[rest]:
            break
    best = int(np.flatnonzero(reached)[-1])
    while best:
        i, n = parts[reached_by[best]]
        take[i] += n
        best -= n * int(sizes[i])
    return take


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    m = fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(pdf["budget"].iloc[0]))
    return pd.DataFrame({"src": pdf["src"], "size": pdf["size"], "n": pdf["n"], "m": m})


def mix_sources(docs: DataFrame, seed: int = SEED, max_repeats: int = 3, text: str = "text",
                source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken; other columns dropped but the key.

    ``copies`` is how often the mix holds the document (0 to ``max_repeats``)."""
    spark = docs.sparkSession
    sized = materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                                    F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
                                    F.xxhash64(F.lit(seed), F.col(key), text_or_empty(text)).alias("h")), "mix-sizes")
    # one row per source, never per document
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).toPandas()
    totals["isnull"] = totals["source"].isna()
    totals = totals.sort_values(["isnull", "source"], key=lambda s: s.fillna("") if s.name == "source" else s).reset_index(drop=True)
    size = totals["source_size"].to_numpy(np.int64)
    target = share_targets(size, np.arange(len(size)) % 3 + 1.0, float(size.sum()), float(max_repeats))
    q = np.zeros(len(size), np.int64)
    q[size > 0] = np.minimum(max_repeats, np.floor(target[size > 0] / size[size > 0] + 1e-12)).astype(np.int64)
    budget = np.where(q >= max_repeats, 0, np.maximum(0, np.round(target).astype(np.int64) - q * size))
    plan = spark.createDataFrame(
        [(None if n else s, int(i), int(z), float(t), int(k), int(b))
         for i, (s, n, z, t, k, b) in enumerate(zip(totals["source"], totals["isnull"], size, target, q, budget))],
        "source string, src long, source_size long, target double, q long, budget long")
    if len(size) <= SOURCES_BROADCAST:
        plan = F.broadcast(plan)
    rows = (sized.withColumnRenamed("source", "s").join(plan, F.col("s").eqNullSafe(F.col("source")))
            .drop("s", "source"))

    fitted = (rows.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"), F.first("budget").alias("budget"))
              .groupBy("src").applyInPandas(_fit_source, "src long, size long, n long, m long"))
    fitted = materialize(fitted, "mix-fitted")
    rows = (rows.join(fitted, ["src", "size"])
            .withColumn("bucket", F.pmod("h", F.ceil(F.col("n") / BUCKET_ROWS))))
    some = rows.filter("m > 0 and m < n")
    by_size = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    need = (some.groupBy("src", "size", "bucket").agg(F.count(F.lit(1)).alias("in_bucket"), F.first("m").alias("m"))
            .withColumn("need", F.col("m") - F.coalesce(F.sum("in_bucket").over(by_size), F.lit(0)))
            .select("src", "size", "bucket", "need"))
    in_bucket = Window.partitionBy("src", "size", "bucket").orderBy("h", "doc_id")
    chosen = (some.join(need, ["src", "size", "bucket"])
              .withColumn("extra", (F.row_number().over(in_bucket) <= F.col("need")).cast("long")).drop("need"))
    whole = rows.filter("m = 0 or m = n").withColumn("extra", (F.col("m") > 0).cast("long"))
    return (whole.unionByName(chosen).withColumn("copies", F.col("q") + F.col("extra"))
            .select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "h"))


def apply_mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """``docs`` as the mix holds them: every row as often as it was taken, all columns."""
    h, n, copies, copy = (unused(docs, c) for c in ("mix_h", "mix_n", "mix_copies", "mix_copy"))
    each = Window.partitionBy(h).orderBy(F.lit(0))         # numbers rows that repeat id and text
    taken = (mix_sources(docs, seed, **how).filter("copies > 0").select(F.col("h").alias(h), F.col("copies").alias(copies)))
    taken = taken.withColumn(n, F.row_number().over(each))
    rows = docs.withColumn(h, F.xxhash64(F.lit(seed), "doc_id", text_or_empty("text")))
    rows = rows.withColumn(n, F.row_number().over(each)).join(taken, [h, n])
    return (rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*docs.columns))
