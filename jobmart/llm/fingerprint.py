"""Document fingerprints by locally consistent parsing.

A text is a string of code points.  Each level parses the string of names into
phrases: runs of one name are phrases of their own; elsewhere deterministic coin
tossing (compare a name with its left neighbour, keep the lowest differing bit's place
and value) is repeated until the labels are small, and local maxima of the labels start
phrases of two to a few names.  A phrase's name is a hash of its content, so where a
phrase starts depends on a bounded neighbourhood only, and equal substrings get equal
interior names wherever they lie.

The fingerprint keeps, of the names of the levels in ``SKETCH_LEVELS``, the smallest of
``SLOTS`` buckets of one permutation as 32-bit values, and a hash of the whole text, in hex.
The likeness of two fingerprints is the share of equal slots among slots that either
fills: an estimate of the Jaccard similarity of their phrase sets.

Defined results: null text is empty; empty texts have the all-empty fingerprint and are
alike only to empty texts (1.0).  Texts of any length are parsed whole.  Rows that
repeat a doc_id follow each other in text order, and a repeated row's next document is
its repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, partitions, text_or_empty

SKETCH_LEVELS = (2, 3)
SLOTS = 64
EMPTY = np.uint32(0xFFFFFFFF)
CHUNK = 1 << 18      # code points that are parsed together


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function on arrays (multiply and shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _toss(a: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing: place and value of the lowest bit in which ``a`` differs from ``left``."""
    x = a ^ left
    low = x & (~x + x.dtype.type(1))
    place = np.bitwise_count(low - x.dtype.type(1))
    return place * np.uint8(2) + ((a & low) != 0)


# tossing once more on small labels, tabulated from the rule above
_SMALL = 130
_grid = np.arange(_SMALL, dtype=np.uint16)
_AGAIN = _toss(np.repeat(_grid, _SMALL), np.tile(_grid, _SMALL)).astype(np.uint8)
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def parse_level(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level over the concatenated strings of many texts: (phrase names, doc of each).

    ``doc`` is sorted; phrases never cross texts."""
    n = len(names)
    if n == 0:
        return names, doc
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(doc[1:], doc[:-1], out=first[1:])
    same = np.zeros(n, bool)                      # equal to the left neighbour in the same text
    same[1:] = (names[1:] == names[:-1]) & ~first[1:]
    at_first = np.flatnonzero(first)
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[at_first] = ~names[at_first]
    label = _toss(names, left)                    # 64-bit names -> 130 labels
    for _ in range(2):                            # -> 16 -> 10
        before = np.zeros(n, np.uint8)
        before[1:] = label[:-1]
        before[at_first] = label[at_first] ^ np.uint8(1)
        label = _AGAIN[label.astype(np.int32) * _SMALL + before]
    run = same.copy()
    run[:-1] |= same[1:]                          # member of a run of equal names
    before = np.zeros(n, np.uint8)
    before[1:] = label[:-1]
    after = np.zeros(n, np.uint8)
    after[:-1] = label[1:]
    peak = (label >= after) & (label > before) & ~run
    start = first | (run & ~same)
    start[1:] |= run[:-1] & ~same[1:]             # what follows a run starts a phrase
    peak[1:] &= ~first[:-1]
    start |= peak
    at = np.flatnonzero(start)
    size = np.diff(np.append(at, n))
    pos = np.minimum(np.arange(n) - np.repeat(at, size), 63)
    out = np.add.reduceat(names * _POWERS[pos], at)
    return _mix(out + size.astype(np.uint64)), doc[at]


# names of the code points of the first plane, from the mixing function
_POINTS = _mix(np.arange(1, 65537, dtype=np.uint64))


def sketches(texts: list[str]) -> np.ndarray:
    """(len(texts), SLOTS) uint32 sketches; texts are parsed together."""
    out = np.full((len(texts), SLOTS), EMPTY, np.uint32)
    if not texts:
        return out
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    names = _POINTS[np.minimum(points, 65535)]
    if len(points) and points.max() > 65535:
        high = points > 65535
        names[high] = _mix(points[high].astype(np.uint64) + np.uint64(1))
    kept = []
    for level in range(1, max(SKETCH_LEVELS) + 1):
        names, doc = parse_level(names, doc)
        if level in SKETCH_LEVELS:
            kept.append((names, doc))
    all_names = np.concatenate([k[0] for k in kept])
    all_docs = np.concatenate([k[1] for k in kept])
    h = _mix(all_names ^ np.uint64(0xA0761D6478BD642F))
    slot = (h >> np.uint64(58)).astype(np.int64) % SLOTS
    value = np.minimum((h & np.uint64(0xFFFFFFFF)).astype(np.uint32), EMPTY - np.uint32(1))
    np.minimum.at(out, (all_docs, slot), value)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots among those that either sketch fills; two empty ones are alike."""
    used = (a != EMPTY) | (b != EMPTY)
    n = used.sum(1)
    return np.where(n == 0, 1.0, ((a == b) & used).sum(1) / np.maximum(n, 1))


def _hex(sketch: np.ndarray, texts: list[str]) -> list[str]:
    return [s.astype(">u4").tobytes().hex() + hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
            for s, t in zip(sketch, texts)]


def sketch_of(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint)[:4 * SLOTS], ">u4").astype(np.uint32)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) per row, no shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in _chunks([len(t) for t in texts]):
                part = texts[lo:hi]
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[lo:hi], "n_chars": [len(t) for t in part],
                                    "fingerprint": _hex(sketches(part), part)})
    return (docs.select(id_text(key).alias("doc_id"), text_or_empty(text).alias("text"))
            .mapInPandas(run, "doc_id string, n_chars long, fingerprint string")
            .withColumn("doc_id", F.col("doc_id").cast("long")))


def _chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > CHUNK:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(lengths):
        yield lo, len(lengths)


def edited_text(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the start of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to it and to the next document.

    The next document by descending ``key`` (after the last: the first; nulls last) is
    met by one range-wise shuffle: rows are dealt to buckets by quantiles of the key
    (read alone), and the first rows of each bucket are also sent to the bucket before.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    buckets = buckets or max(64, 4 * n)
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    ids = rows.select("doc_id").filter("doc_id is not null")
    # a value for each bucket comes back, not for each row
    bounds = ids.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 100_000)).first()[0]
    splits = [-float("inf"), *sorted({float(b) for b in bounds or []}), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    rows = rows.withColumn("d", F.col("doc_id").cast("double"))
    rows = Bucketizer(splits=splits, inputCol="d", outputCol="bucket", handleInvalid="keep").transform(rows).drop("d")
    # descending: a null key comes last, so its bucket is the lowest
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("bucket").cast("long")))
    rows = rows.withColumn("h", F.xxhash64("text"))
    # each bucket's first row goes to the bucket before it as well (to the last one from the first)
    heads = (rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("m"))
             .select("bucket", "m.doc_id", "m.h"))
    ring = Window.orderBy(F.desc("bucket"))          # one row per bucket
    goes = heads.withColumn("to", F.coalesce(F.lag("bucket").over(ring), F.min("bucket").over(
        ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    goes = goes.select(F.col("bucket").alias("hb"), F.col("doc_id").alias("hd"), F.col("h").alias("hh"), "to")
    marked = rows.join(F.broadcast(goes), (F.col("bucket") == F.col("hb")) & F.col("doc_id").eqNullSafe(F.col("hd"))
                       & (F.col("h") == F.col("hh")), "left")
    copies = F.when(F.col("to").isNull(), F.array(F.struct("bucket", F.lit(0).alias("head")))).otherwise(
        F.array(F.struct("bucket", F.lit(0).alias("head")), F.struct(F.col("to").alias("bucket"), F.lit(1).alias("head"))))
    dealt = (marked.select("doc_id", "text", "h", F.explode(copies).alias("c"))
             .select("doc_id", "text", "h", "c.bucket", "c.head")
             .repartition(n, "bucket").sortWithinPartitions("bucket", "head", F.desc_nulls_last("doc_id"), F.desc("h")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []                       # (doc_id, text, bucket, head), one row beyond what is returned
        points = 0

        def flush(last: bool) -> Iterator[pd.DataFrame]:
            nonlocal held, points
            texts = [x[1] for x in held]
            use = [i for i in range(len(held) - 1) if not held[i][3] and held[i][2] == held[i + 1][2]]
            if use:
                edited = [edited_text(texts[i], texts[i + 1]) for i in use]
                own, new = sketches(texts), sketches(edited)
                mine = own[use]
                yield pd.DataFrame({
                    "doc_id": [held[i][0] for i in use], "n_chars": [len(texts[i]) for i in use],
                    "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                    "fingerprint": _hex(mine, [texts[i] for i in use]), "edited_fingerprint": _hex(new, edited),
                    "near_edited": likeness(mine, new), "near_next": likeness(mine, own[[i + 1 for i in use]])})
            held = [] if last else held[-1:]
            points = sum(len(x[1]) for x in held)

        for pdf in batches:
            for row in zip(pdf["doc_id"], pdf["text"], pdf["bucket"], pdf["head"]):
                held.append(row)
                points += len(row[1])
                if points > CHUNK and len(held) > 1:
                    yield from flush(False)
        yield from flush(True)

    return dealt.select(id_text("doc_id").alias("doc_id"), "text", "bucket", "head").mapInPandas(
        run, "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double").withColumn("doc_id", F.col("doc_id").cast("long"))
