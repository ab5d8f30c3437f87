"""N-gram Jaccard self-join: a MinHash LSH forest with exact verification.

A text is the set of its ``N`` consecutive lower-cased words (a shorter text: its
words as one n-gram).  Texts with equal sets are one class, joined once by their smallest id.

Forest: ``TREES`` prefix tries over labels of ``MAX_DEPTH`` MinHash values.  Matched
prefixes are shortened from the full label while the share of pairs at the threshold that
meet in some tree, 1 - (1 - t^d)^trees, is below ``TARGET``; the trie nodes at the depth
reached are the candidate groups.  A node whose members also share a node of an earlier tree is
left out, a pair that met in an earlier tree is skipped, and the others are verified on
their whole n-gram sets.  Nodes of more than ``BLOCK`` classes are dealt out as pairs of
blocks, so that no task holds a large group and no pair leaves a task: tasks return each class's
number of links and its smallest linked id, from which components are built.

Rows: doc_id, class_id (smallest doc_id with the same n-grams), n_links (other rows with
Jaccard similarity of ``threshold`` or more, copies included), component_id (smallest
doc_id reachable by links), kept (doc_id = component_id).

Defined results: null text is empty; a text without words links with nothing; a row without
doc_id takes a negative id made from its text; rows that share a doc_id are one
node of the graph; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, partitions, text_or_empty, unused
from .groups import local_roots, sorted_groups
from .hashing import token_hashes

N = 5
THRESHOLD = 0.8
TREES = 12
MAX_DEPTH = 4
TARGET = 0.9995
BLOCK = 256
BITMAP = 1 << 24
_MULTIPLY = np.random.default_rng(11).integers(1, 2**63, TREES * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def depth_for(threshold: float, trees: int = TREES, target: float = TARGET, depth: int = MAX_DEPTH) -> int:
    """The longest prefix, shortened from ``depth``, at which pairs at the threshold meet with ``target`` chance."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def node_id(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id, -1 - F.shiftrightunsigned(F.xxhash64(text), 1))


def ngram_sets(texts: list[str], n: int = N) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    hashes, counts = token_hashes(texts)
    out, at = [], 0
    for c in counts.tolist():
        h = hashes[at:at + c]
        at += c
        if c == 0:
            out.append(np.zeros(0, np.uint64))
            continue
        width = min(n, c)
        g = np.zeros(c - width + 1, np.uint64)
        for j in range(width):
            g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[j:c - width + 1 + j]
        out.append(np.unique((g ^ (g >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)))
    return out


def _chunks(texts: list[str], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    lo = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def nodes_of(sets: list[np.ndarray], depth: int) -> np.ndarray:
    """(len(sets), TREES) ids of the trie nodes at ``depth``, int64."""
    out = np.zeros((len(sets), TREES), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out.view(np.int64)
    flat = np.concatenate([sets[i] for i in full])
    at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
    for tree in range(TREES):
        label = np.full(len(full), tree + 1, np.uint64)
        for level in range(depth):
            m = np.minimum.reduceat(_permute(flat, tree * MAX_DEPTH + level), at)
            label = (label ^ m ^ (label >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        out[full, tree] = label ^ (label >> np.uint64(29))
    return out.view(np.int64)


def _permute(x: np.ndarray, k: int) -> np.ndarray:
    y = x * _MULTIPLY[k]
    return y ^ (y >> np.uint64(32))


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, over the n-grams that lie in two sets or more."""
    flat = np.concatenate([*a, *b])
    names, col, seen = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in (*a, *b)])
    used = seen > 1
    place = np.cumsum(used) - 1
    keep = used[col]
    row, col = row[keep], place[col[keep]]
    out = np.zeros((len(a), len(b)), np.float32)
    step = max(256, (1 << 22) // max(1, len(a) + len(b)))
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for lo in range(0, int(used.sum()), step):
        i, j = np.searchsorted(col, [lo, lo + step])
        m = np.zeros((len(a) + len(b), step), np.float32)
        m[row[i:j], col[i:j] - lo] = 1
        out += m[:len(a)] @ m[len(a):].T
    return out


def _verify(tree: int, left: pd.DataFrame, right: pd.DataFrame | None, threshold: float) -> pd.DataFrame:
    """Links between two blocks of a node, or within one."""
    a = [np.frombuffer(x, "<u8") for x in left["grams"]]
    na = np.vstack([np.frombuffer(x, "<i8") for x in left["nodes"]])
    if right is None:
        b, nb = a, na
    else:
        b, nb = ([np.frombuffer(x, "<u8") for x in right["grams"]], np.vstack([np.frombuffer(x, "<i8") for x in right["nodes"]]))
    size_a, size_b = np.array([len(x) for x in a], float), np.array([len(x) for x in b], float)
    todo = np.minimum(size_a[:, None], size_b[None, :]) >= threshold * np.maximum(size_a[:, None], size_b[None, :])
    for t in range(tree):
        todo &= na[:, t][:, None] != nb[:, t][None, :]
    if right is None:
        np.fill_diagonal(todo, False)
    if not todo.any():
        return pd.DataFrame({"node": [], "links": [], "root": []})
    ra, rb = todo.any(1), todo.any(0)
    linked = np.zeros_like(todo)
    if len(a) + len(b) <= 8:
        for i, j in zip(*np.nonzero(todo)):
            if right is not None or i < j:
                both = len(np.intersect1d(a[i], b[j], assume_unique=True))
                if both >= threshold * (size_a[i] + size_b[j] - both):
                    linked[i, j] = True
                    if right is None:
                        linked[j, i] = True
    else:
        ia, ib = np.flatnonzero(ra), np.flatnonzero(rb)
        both = _common([a[i] for i in ia], [b[j] for j in ib])
        linked[np.ix_(ia, ib)] = both >= threshold * (size_a[ia][:, None] + size_b[ib][None, :] - both)
        linked &= todo
    ids_a, copies_a = left["node"].to_numpy(np.int64), left["copies"].to_numpy(np.int64)
    if right is None:
        ids, links, all_ = ids_a, linked @ copies_a, linked
    else:
        ids_b, copies_b = right["node"].to_numpy(np.int64), right["copies"].to_numpy(np.int64)
        ids = np.concatenate([ids_a, ids_b])
        links = np.concatenate([linked @ copies_b, linked.T @ copies_a])
        all_ = np.zeros((len(ids), len(ids)), bool)
        all_[:len(ids_a), len(ids_a):] = linked
        all_[len(ids_a):, :len(ids_a)] = linked.T
    got = links > 0
    return pd.DataFrame({"node": ids[got], "links": links[got], "root": local_roots(all_, ids)[got]})


def jaccard_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, target: float = TARGET,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``; see the module's docstring."""
    spark = docs.sparkSession
    depth = depth_for(threshold, TREES, target)
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("node", node_id(F.col("doc_id"), F.col("text")))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in _chunks(texts):
                sets = ngram_sets(texts[lo:hi], n)
                nodes = nodes_of(sets, depth)
                yield pd.DataFrame({
                    "has_id": pdf["has_id"].iloc[lo:hi].to_numpy(), "node": pdf["node"].iloc[lo:hi].to_numpy(),
                    "set": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else
                            b"none" + int(i).to_bytes(8, "little", signed=True) for s, i in zip(sets, pdf["node"].iloc[lo:hi])],
                    "grams": [len(s) for s in sets], "nodes": [x.astype("<i8").tolist() for x in nodes]})

    signed = materialize(rows.select(F.col("doc_id").isNotNull().alias("has_id"), "text", "node")
                         .mapInPandas(sign, "has_id boolean, node long, set binary, grams int, nodes array<long>"), "join-signed")
    classes = materialize(signed.groupBy("set").agg(F.min("node").alias("class_id"), F.count(F.lit(1)).alias("copies"),
                                                    F.first("grams").alias("grams"), F.first("nodes").alias("nodes")), "join-classes")
    labelled = classes.filter("grams > 0").select(F.col("class_id").alias("node"), "nodes")
    # one narrow row a class and tree; only members of shared trie nodes go on
    trees = labelled.select("node", F.posexplode("nodes").alias("tree", "trie"))
    multi = materialize(trees.groupBy("tree", "trie").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "join-multi")
    members = materialize(trees.join(multi, ["tree", "trie"]), "join-members")
    # members that all share a node of one earlier tree meet there already
    one = [F.min(F.element_at("nodes", t + 1)) == F.max(F.element_at("nodes", t + 1)) for t in range(TREES)]
    useful = (members.join(labelled, "node").groupBy("tree", "trie")
              .agg(F.max("n").alias("n"), *[o.alias(f"o{t}") for t, o in enumerate(one)])
              .filter(~_any([(F.col("tree") > t) & F.col(f"o{t}") for t in range(TREES)]))
              .select("tree", "trie", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    places = materialize(members.select("node", "tree", "trie").join(useful, ["tree", "trie"]), "join-places")
    wanted = places.select("node").distinct().join(
        classes.filter("grams > 0").select(F.col("class_id").alias("node"), "set", "copies", "nodes"), "node")
    maybe = _bitmap(places.select("node"))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in _chunks(texts):
                part = pdf.iloc[lo:hi]
                sets = ngram_sets(texts[lo:hi], n)
                same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == bytes(k) for s, k in zip(sets, part["set"])]
                yield pd.DataFrame({"node": part["node"], "copies": part["copies"], "set": part["set"],
                                    "nodes": [np.asarray(x, "<i8").tobytes() for x in part["nodes"]],
                                    "grams": [s.astype("<u8").tobytes() for s in sets]})[same]

    sets = materialize(rows.select("node", "text").filter(maybe("node")).join(wanted, "node")
                       .mapInPandas(grams, "node long, copies long, set binary, nodes binary, grams binary")
                       .dropDuplicates(["node", "set"]).drop("set"), "join-sets")

    block = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    # block b meets blocks 0..blocks-1; the pair (low, high) is one task's group
    dealt = (places.withColumn("own", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
             .join(sets, "node"))
    parts = partitions(spark)
    keys = ["tree", "trie", "low", "high"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for pdf in sorted_groups(batches, keys):
            if len(pdf) < 2:
                continue
            if pdf["low"].iloc[0] == pdf["high"].iloc[0]:
                got = _verify(int(pdf["tree"].iloc[0]), pdf, None, threshold)
            else:
                first = (pdf["own"] == pdf["low"]).to_numpy()
                if first.all() or not first.any():
                    continue
                got = _verify(int(pdf["tree"].iloc[0]), pdf[first], pdf[~first], threshold)
            if len(got):
                out.append(got)
                held += len(got)
            if held > 20_000:
                yield pd.concat(out, ignore_index=True)
                out, held = [], 0
        if out:
            yield pd.concat(out, ignore_index=True)

    found = materialize(dealt.select(*keys, "own", "node", "copies", "nodes", "grams")
                        .repartition(parts, *keys).sortWithinPartitions(*keys)
                        .mapInPandas(verify, "node long, links long, root long"), "join-found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "join-cc")
    per_class = (classes.select("set", "class_id", "copies", "grams")
                 .join(links.withColumnRenamed("node", "class_id"), "class_id", "left")
                 .join(reach.withColumnRenamed("node", "class_id"), "class_id", "left")
                 .select("set", "class_id", F.coalesce("component", "class_id").alias("component_id"),
                         (F.when(F.col("grams") > 0, F.col("copies") - 1).otherwise(0)
                          + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")))
    return (signed.select("has_id", "node", "set").join(per_class, "set")
            .select("node", F.when(F.col("has_id"), F.col("node")).alias("doc_id"), "class_id", "n_links", "component_id", (F.col("node") == F.col("component_id")).alias("kept")))


def _bitmap(ids: DataFrame, bits: int = BITMAP):
    """A filter that every id of ``ids`` passes and few others, from a bitmap of ``bits`` bits.

    Texts that cannot be candidates need not be shuffled to the join that follows.  The
    bitmap's size is fixed: with more ids it lets more rows through, and the join
    still decides."""
    at = F.pmod(F.xxhash64("node"), F.lit(bits))
    words = (ids.select(F.shiftright(at, 5).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(node), {bits}) & 31 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas())      # bits / 32 rows at most
    table = np.zeros(bits // 32, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bit"].to_numpy(np.int64)
    shared = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(place: pd.Series) -> pd.Series:
        p = place.to_numpy(np.int64)
        return pd.Series((shared.value[p >> 5] >> (p & 31)) & 1 == 1)
    return lambda node: test(F.pmod(F.xxhash64(node), F.lit(bits)))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each group of linked rows (the smallest id, rows without one last), all columns.

    Rows are told apart by a staged row number, not by doc_id: rows that share an id are one group
    only if their texts are linked.  Rows without words are groups of their own."""
    row = unused(docs, "join_row")
    staged = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "join-rows")
    groups = jaccard_join(staged.select(row, "text"), key=row, **how).select(F.col("doc_id").alias(row), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))[row]
    kept = staged.select(row, "doc_id").join(groups, row).groupBy("component_id").agg(first.alias(row)).select(row)
    return staged.join(kept, row, "left_semi").drop(row)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
