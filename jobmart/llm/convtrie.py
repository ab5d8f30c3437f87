"""A prefix trie over conversations as balanced parentheses.

A node is a distinct sequence of first turns.  Every turn has a 128-bit key (SHA-256 of role and
text), every prefix a 128-bit polynomial sum of its turns' keys, so that equal prefixes
meet in an aggregate wherever they lie and no conversation is gathered in one place: turns
are dealt by range of (conv_id, turn, key), each task sums its part, and the parts' totals (two rows
a task) are added in a second pass.

Chains of nodes with the same members are one *event*; (smallest member, number of members) names it.
The path of a leaf lists its events from the top: at most as many as there are different
numbers of members on it, so never more than the square root of twice the rows.  Paths are sorted and
dealt by range into shards.  A shard writes its part of the trie as balanced parentheses with a
range min-max index over blocks of excess: ``findclose`` delimits an event's subtree, the rank of
leaf pairs ``()`` counts its leaves, and cumulative arrays give the tokens saved below it.  Events on a
shard's first or last path (its spine) may go on in other shards; their parts are merged by
sums, and what the spine's own events save is added along the spine's paths.

``rebuilt`` puts the first h turns of a group's first conversation in front of the others' own later turns, h by a checksum of the id.

Defined results: turns are in order of ``turn``, null first, equal ones by the hash of role and
text; null role or text is empty; repeated rows are turns of their own; rows without conv_id belong to no conversation and are
left out; an empty table gives no rows, not even a root; a conversation without turns is a member of the root
alone; texts of any length are read whole, and only their hash and number of words travel; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, blocks_of, ensure_checkpoint_dir, materialize, partitions, text_or_empty

GROUP, HEAD = 20, 3           # conversations that share a first one; turns that it may lend at most
LEAVES = 50_000               # paths of a shard, about
BLOCK = 64                    # parentheses of a block of the min-max index
ENDS = 4096                   # ids that are joined to one piece before pieces are hashed

# odd multipliers of the two sums
_BASES = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95], np.uint64)
_INVERSE = np.array([pow(int(b), -1, 2**64) for b in _BASES], np.uint64)


def powers(which: int, exponent: np.ndarray) -> np.ndarray:
    """The multiplier's powers modulo 2**64, negative ones by its inverse."""
    out = np.ones(len(exponent), np.uint64)
    for base, e in ((_BASES[which], np.maximum(exponent, 0)), (_INVERSE[which], np.maximum(-exponent, 0))):
        e, base = e.astype(np.uint64), np.full(1, base, np.uint64)
        while e.any():
            out = np.where(e & np.uint64(1) > 0, out * base, out)
            base, e = base * base, e >> np.uint64(1)
    return out


# --- turns, prefixes ------------------------------------------------------------
def turns_of(conversations: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, key, words): all that the trie needs of a turn."""
    r, t = text_or_empty(role), text_or_empty(text)
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256), 1, 32).alias("key"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("words"))


_SUMS = "conv_id long, part int, pos long, q0 long, q1 long, t0 long, t1 long, words long, total long, edge boolean"


def _local_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running position, sums and words of every conversation inside one sorted partition; ``edge``
    marks the last row of the partition's first and last conversation."""
    part = TaskContext.get().partitionId()
    held, first, carry = None, None, (0, np.zeros(2, np.uint64), 0)
    last: pd.DataFrame | None = None            # the row before, held back until it is known to be an edge
    for pdf in batches:
        if not len(pdf):
            continue
        conv = pdf["conv_id"].to_numpy(np.int64)
        start = np.r_[conv[0] != held, conv[1:] != conv[:-1]]
        run = np.cumsum(start)                    # 0: goes on from the batch before
        at = np.flatnonzero(start)
        heads = np.r_[0, at] if not start[0] else at
        run -= run[0]
        base = carry if not start[0] else (0, np.zeros(2, np.uint64), 0)
        pos = np.arange(len(conv)) - heads[run] + 1 + np.where(run == 0, base[0], 0)
        keys = np.frombuffer(b"".join(bytes.fromhex(k) for k in pdf["key"]), "<u8").reshape(-1, 2)
        out = {"conv_id": conv, "part": np.full(len(conv), part, np.int32), "pos": pos}
        sums = []
        for i in range(2):
            term = keys[:, i] * powers(i, pos)
            total = np.cumsum(term)
            before = total[heads] - term[heads]
            s = total - before[run] + np.where(run == 0, base[1][i], np.uint64(0))
            out[f"q{i}"], out[f"t{i}"] = s.view(np.int64), term.view(np.int64)
            sums.append(s[-1])
        words = pdf["words"].to_numpy(np.int64)
        total = np.cumsum(words)
        out["words"], out["total"] = words, total - (total[heads] - words[heads])[run] + np.where(run == 0, base[2], 0)
        frame = pd.DataFrame({k: out[k] for k in ("conv_id", "part", "pos", "q0", "q1", "t0", "t1", "words", "total")})
        if first is None:
            first = conv[0]
        frame["edge"] = np.r_[(conv[1:] != conv[:-1]) & (conv[:-1] == first), False]
        if last is not None:
            last["edge"] = bool(last["conv_id"].iloc[0] == first and conv[0] != first)
            yield last
        held, carry = conv[-1], (int(pos[-1]), np.array(sums, np.uint64), int(out["total"][-1]))
        last = frame.iloc[-1:].copy()
        yield frame.iloc[:-1]
    if last is not None:
        last["edge"] = True
        yield last


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, q0, q1, t0, t1, words, total): every turn's place, the sums and words of the
    turns up to it and its own term, however many turns a conversation has."""
    spark = turns.sparkSession
    spread = turns.withColumn("row", F.monotonically_increasing_id())      # repeated rows may part
    local = materialize(
        spread.repartitionByRange(partitions(spark), "conv_id", F.asc_nulls_first("turn"), "key", "row")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "key", "row").select("conv_id", "key", "words")
        .mapInPandas(_local_sums, _SUMS), "trie-sums")
    # at most two rows a task: what earlier tasks hold of a conversation
    before = _carries(local.filter("edge").select("part", "conv_id", "pos", "q0", "q1", "total").collect())
    shared = spark.sparkContext.broadcast(before)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = [shared.value.get(k) for k in zip(pdf["part"].tolist(), pdf["conv_id"].tolist())] if shared.value else []
            if any(known):
                pos, q0, q1, total = (np.array([k[i] if k else 0 for k in known], np.int64) for i in range(4))
                for i, q in enumerate((q0, q1)):
                    p = powers(i, pos)
                    for name, offset in ((f"q{i}", q.view(np.uint64)), (f"t{i}", np.uint64(0))):
                        pdf[name] = (pdf[name].to_numpy(np.int64).view(np.uint64) * p + offset).view(np.int64)
                pdf["pos"] += pos
                pdf["total"] += total
            yield pdf.drop(columns=["part", "edge"])
    return local.mapInPandas(add, ", ".join(c for c in _SUMS.split(", ") if c.split()[0] not in ("part", "edge")))


def _carries(edges: list) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(task, conversation) -> position, sums and words that earlier tasks hold of it."""
    mask = 2**64 - 1
    signed = lambda x: x - 2**64 if x >= 2**63 else x                       # noqa: E731
    out, so_far = {}, {}
    for r in sorted(edges, key=lambda r: r.part):
        pos, q0, q1, total = so_far.get(r.conv_id, (0, 0, 0, 0))
        if pos:
            out[(r.part, r.conv_id)] = (pos, signed(q0), signed(q1), total)
        sums = [(q + own * pow(int(b), pos, 2**64)) & mask for q, own, b in zip((q0, q1), (r.q0, r.q1), _BASES)]
        so_far[r.conv_id] = (pos + r.pos, *sums, total + r.total)
    return out


_ROW = "conv_id long, depth long, n0 long, n1 long, p0 long, p1 long, words long, total long"


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id) and their rebuilt turns: depth, the prefix that ends there
    (n0, n1), the prefix before it (p0, p1), words of the turn and of the prefix."""
    head = (rows.filter(F.col("pos") <= HEAD).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "q0", "q1", "words", "total"))).alias("head")))   # at most HEAD
    none = F.slice("head", F.lit(1), F.lit(0))
    lent = head.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("head").alias("lent"))
    convs = head.select("conv_id", "head", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
                        (F.crc32(F.col("conv_id").cast("string")) % (HEAD + 1)).cast("int").alias("h"))
    convs = materialize(convs.join(lent, "base", "left").select(
        "conv_id", "head", "h", F.slice(F.coalesce("lent", none), F.lit(1), F.col("h")).alias("lent")), "trie-convs")
    ahead = convs.select("conv_id", F.posexplode("lent").alias("i", "t"), "lent").select(
        "conv_id", (F.col("i") + 1).cast("long").alias("depth"), F.col("t.q0").alias("n0"), F.col("t.q1").alias("n1"),
        *[F.coalesce(F.get("lent", F.col("i") - 1)[f"q{k}"], F.lit(0)).alias(f"p{k}") for k in range(2)],
        F.col("t.words").alias("words"), F.col("t.total").alias("total"))
    # at the own turns: the sums of what is lent, and of the own first h turns, which fall away
    upto = {"a": F.get("lent", F.size("lent") - 1), "b": F.get("head", F.col("h") - 1)}
    offsets = convs.select("conv_id", "h", F.size("lent").alias("n"), *[
        F.coalesce(at[f], F.lit(0).cast("long")).alias(f"{k}_{f}") for k, at in upto.items() for f in ("q0", "q1", "total")])
    own = rows.join(offsets, "conv_id").filter("pos > h")

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            u = lambda c: pdf[c].to_numpy(np.int64).view(np.uint64)          # noqa: E731, B023
            shift = (pdf["n"] - pdf["h"]).to_numpy(np.int64)
            out = {"conv_id": pdf["conv_id"], "depth": pdf["pos"] + shift}
            for i in range(2):
                p = powers(i, shift)
                whole = u(f"a_q{i}") + p * (u(f"q{i}") - u(f"b_q{i}"))
                out[f"n{i}"], out[f"p{i}"] = whole.view(np.int64), (whole - p * u(f"t{i}")).view(np.int64)
            yield pd.DataFrame({**out, "words": pdf["words"], "total": pdf["total"] - pdf["b_total"] + pdf["a_total"]})[
                [c.split()[0] for c in _ROW.split(", ")]]
    return convs.select("conv_id"), ahead.unionByName(own.mapInPandas(move, _ROW))


# --- a shard of the trie -----------------------------------------------------------
class Parentheses:
    """Balanced parentheses with a range min-max tree over blocks of excess."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = max(1, -(-len(opens) // BLOCK))
        leaves = 1 << (blocks - 1).bit_length()
        top = np.iinfo(np.int64).max
        padded = np.full(leaves * BLOCK, top, np.int64)
        padded[:len(opens)] = self.excess
        self.grid = padded.reshape(leaves, BLOCK)
        self.low = np.full(2 * leaves, top, np.int64)           # a heap: node k covers 2k and 2k+1
        self.low[leaves:] = self.grid.min(1)
        for k in range(leaves.bit_length() - 2, -1, -1):
            at = np.arange(1 << k, 2 << k)
            self.low[at] = np.minimum(self.low[2 * at], self.low[2 * at + 1])
        pair = opens[:-1] & ~opens[1:]
        self.pairs = np.cumsum(np.r_[pair, False])              # leaf pairs that begin at or before a place

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes each one opened at ``at``: the first after it whose excess is one lower."""
        goal = self.excess[at] - 1
        block, leaves = at // BLOCK, len(self.low) // 2
        out = np.full(len(at), -1, np.int64)
        for lo in range(0, len(at), 65_536):                    # inside the own block
            s = slice(lo, lo + 65_536)
            hit = (self.grid[block[s]] <= goal[s, None]) & (np.arange(BLOCK) > (at[s] % BLOCK)[:, None])
            out[s] = np.where(hit.any(1), block[s] * BLOCK + hit.argmax(1), -1)
        far = np.flatnonzero(out < 0)
        node, want = block[far] + leaves, goal[far]
        up = np.ones(len(far), bool)
        while up.any():                                         # to the first block to the right that goes low enough
            right = up & (node % 2 == 0)
            found = right & (self.low[np.minimum(node + 1, len(self.low) - 1)] <= want)
            node = np.where(found, node + 1, np.where(up, node // 2, node))
            up &= ~found
        inner = node < leaves
        while inner.any():                                      # and down to it
            left = np.minimum(2 * node, len(self.low) - 1)
            node = np.where(inner, np.where(self.low[left] <= want, 2 * node, 2 * node + 1), node)
            inner = node < leaves
        if len(far):
            out[far] = (node - leaves) * BLOCK + (self.grid[node - leaves] <= want[:, None]).argmax(1)
        return out

    def leaves_in(self, at: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Leaf pairs from ``at`` to ``close``."""
        return self.pairs[close] - self.pairs[at] + (self.opens[np.minimum(at + 1, len(self.opens) - 1)] == 0)


_EVENT = "conv_id long, n_convs long, own long, n_leaves long, below long, spine long, level long, shard long"


def shard_events(paths: Iterator[np.ndarray]) -> dict[str, np.ndarray]:
    """Events of sorted leaf paths, each an array of (conv_id, n_convs, own): leaves and tokens saved below them
    in this shard.  ``spine`` is 1 for events on the first path, 2 on the last, 3 on both; of these
    ``below`` leaves out what the spine's own events save."""
    runs, parts, count, first = [], [], 0, None
    before, stack = np.zeros((0, 3), np.int64), []            # the open events and their places
    for path in paths:
        both = min(len(before), len(path))
        other = (before[:both, :2] != path[:both, :2]).any(1)
        same = int(other.argmax()) if other.any() else both
        runs += [len(before) - same, len(path) - same]
        parts.append(path[same:].copy())
        stack = stack[:same] + list(range(count, count + len(path) - same))
        count += len(path) - same
        first = len(path) if first is None else first
        before = path
    events = np.concatenate(parts)
    opens = np.repeat(np.resize([False, True], len(runs) + 1), [*runs, len(before)])
    trie, at = Parentheses(opens), np.flatnonzero(opens)
    close = trie.findclose(at)
    spine, level = np.zeros(count, np.int64), np.full(count, -1)
    spine[:first], level[:first] = 1, np.arange(first)
    spine[stack] += 2
    level[stack] = np.arange(len(stack))
    saved = np.zeros(len(opens), np.int64)
    saved[at] = np.where(spine > 0, 0, events[:, 2])
    saved = np.cumsum(saved)
    return {"conv_id": events[:, 0], "n_convs": events[:, 1], "own": events[:, 2], "n_leaves": trie.leaves_in(at, close),
            "below": saved[close] - saved[at], "spine": spine, "level": level}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def paths() -> Iterator[np.ndarray]:
        for batch in batches:
            lists = batch.column("path")
            flat = lists.flatten()
            cols = np.column_stack([flat.field(n).to_numpy(zero_copy_only=False) for n in ("conv_id", "n_convs", "own")])
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            for lo, hi in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
                yield cols[lo:hi]

    rows = paths()
    head = next(rows, None)
    if head is not None:
        found = shard_events(itertools.chain([head], rows))
        found["shard"] = np.full(len(found["level"]), TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in found.values()], list(found))


def subtree_totals(paths: DataFrame, shards: int) -> DataFrame:
    """(conv_id, n_convs, n_leaves, below) of every event: its leaves and what the events below it save.
    ``paths``: one row a leaf, ``path`` an array of (at, conv_id, n_convs, own)."""
    found = materialize(paths.repartitionByRange(shards, "path").sortWithinPartitions("path").select("path")
                        .mapInArrow(_shards, _EVENT), "trie-shards")
    inner = found.filter("spine = 0").select("conv_id", "n_convs", "n_leaves", "below")
    spine = found.filter("spine > 0")
    # the spine's paths, two a shard; each of its events counts once, on the first path that holds it
    sides = spine.withColumn("side", F.explode(F.when(F.col("spine") == 3, F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).otherwise(F.array("spine"))))
    sides = sides.select("conv_id", "n_convs", "own", "level", (F.col("shard") * 2 + F.col("side")).alias("line"))
    owner = sides.groupBy("conv_id", "n_convs").agg(F.min("line").alias("owner"))
    under = (Window.partitionBy("line").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1))
    along = (sides.join(owner, ["conv_id", "n_convs"])
             .withColumn("more", F.coalesce(F.sum(F.when(F.col("line") == F.col("owner"), F.col("own")).otherwise(0)).over(under), F.lit(0))))
    more = along.groupBy("conv_id", "n_convs").agg(F.sum("more").alias("more"))
    merged = (spine.groupBy("conv_id", "n_convs").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("below").alias("below"))
              .join(more, ["conv_id", "n_convs"]).select("conv_id", "n_convs", "n_leaves", (F.col("below") + F.col("more")).alias("below")))
    return inner.unionByName(merged)


# --- ends ---------------------------------------------------------------------------
def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ids of a node joined by commas, at most ``ENDS`` to a piece."""
    for pdf in batches:
        n0, n1, ids = (pdf[c].to_numpy(np.int64) for c in ("n0", "n1", "conv_id"))
        cut = np.flatnonzero(np.r_[True, (n0[1:] != n0[:-1]) | (n1[1:] != n1[:-1])]).tolist() + [len(ids)]
        rows = [(n0[lo], n1[lo], ids[i], ",".join(map(str, ids[i:min(i + ENDS, hi)].tolist())))
                for lo, hi in zip(cut[:-1], cut[1:]) for i in range(lo, hi, ENDS)]
        yield pd.DataFrame(rows, columns=["n0", "n1", "first", "ids"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 over a node's pieces in order, piece by piece."""
    held, sha = None, None
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            if (r.n0, r.n1) == held:
                sha.update(b",")
            else:
                if held is not None:
                    rows.append((*held, sha.hexdigest()))
                held, sha = (r.n0, r.n1), hashlib.sha256()
            sha.update(r.ids.encode())
        yield pd.DataFrame(rows, columns=["n0", "n1", "ends_sha256"])
    if held is not None:
        yield pd.DataFrame([(*held, sha.hexdigest())], columns=["n0", "n1", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(n0, n1, ends_sha256) of every node where conversations end."""
    parts = partitions(ends.sparkSession)
    pieces = (ends.repartitionByRange(parts, "n0", "n1", "conv_id").sortWithinPartitions("n0", "n1", "conv_id")
              .mapInPandas(_pieces, "n0 long, n1 long, first long, ids string"))
    return (pieces.repartition(parts, "n0", "n1").sortWithinPartitions("n0", "n1", "first")
            .mapInPandas(_digests, "n0 long, n1 long, ends_sha256 string"))


# --- the trie -------------------------------------------------------------------------
def prefix_trie(conversations: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    ensure_checkpoint_dir(spark)
    parts = partitions(spark)
    convs, turns = rebuilt(numbered(turns_of(conversations, role, text)))
    rows = materialize(turns, "trie-rows")

    zero = F.lit(0).cast("long")
    root = (convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
            .select(zero.alias("n0"), zero.alias("n1"), zero.alias("depth"), "n_convs", "conv_id", F.lit(None).cast("long").alias("p0"),
                    F.lit(None).cast("long").alias("p1"), zero.alias("words"), zero.alias("total")))
    nodes = materialize(
        rows.groupBy("n0", "n1", "depth").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p0").alias("p0"), F.min("p1").alias("p1"),
            F.min("words").alias("words"), F.min("total").alias("total")).unionByName(root), "trie-nodes")
    children = nodes.filter("p0 is not null").groupBy(F.col("p0").alias("n0"), F.col("p1").alias("n1")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, ["n0", "n1"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-counted")

    # events: chains of nodes with the same members
    events = nodes.groupBy("conv_id", "n_convs").agg(
        F.max("depth").alias("at"), F.max("total").alias("total"), F.min(F.col("total") - F.col("words")).alias("before"),
        F.min("depth").alias("top"))
    events = materialize(events.withColumn("own", (F.col("n_convs") - 1) * (F.col("total") - F.col("before"))), "trie-events")

    # leaf paths: the events that a leaf's smallest member passes, the root's first
    leaves = nodes.filter("n_children = 0").select("conv_id", F.col("n_convs").alias("leaf_convs"))
    shared = nodes.filter("n_convs > 1 and depth > 0").select("n0", "n1", F.col("conv_id").alias("e"), "n_convs")
    passed = (rows.select("conv_id", "n0", "n1").join(leaves, "conv_id").join(shared, ["n0", "n1"])
              .select("conv_id", "e", "n_convs").distinct())
    alone = leaves.filter("leaf_convs = 1").select("conv_id", F.col("conv_id").alias("e"), F.lit(1).cast("long").alias("n_convs"))
    below_root = events.filter("top > 0").select(F.col("conv_id").alias("e"), "n_convs", "at", "own")
    steps = (passed.unionByName(alone).join(below_root, ["e", "n_convs"]).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("at", F.col("e").alias("conv_id"), "n_convs", "own"))).alias("path")))
    top = events.filter("top = 0").first()               # the root's event, one row
    if top is not None:
        start = F.array(F.struct(*[F.lit(top[c]).cast("long").alias(c) for c in ("at", "conv_id", "n_convs", "own")]))
        path = F.when(F.col("path").isNull(), start).otherwise(F.concat(start, "path"))
    else:
        path = F.col("path")
    paths = materialize(leaves.select("conv_id").join(steps, "conv_id", "left").select(path.alias("path")), "trie-paths")
    totals = subtree_totals(paths, blocks_of(paths.count(), LEAVES, parts))

    # nodes of one member have one leaf and save nothing; the others take their event's totals
    one = nodes.filter("n_convs = 1").withColumns({"n_leaves": F.lit(1).cast("long"), "saved_tokens": zero})
    of_event = (events.filter("n_convs > 1").select("conv_id", "n_convs", F.col("total").alias("event_total"))
                .join(totals, ["conv_id", "n_convs"]))
    many = nodes.filter("n_convs > 1").join(of_event, ["conv_id", "n_convs"]).withColumn(
        "saved_tokens", F.col("below") + (F.col("n_convs") - 1) * (F.col("event_total") - F.col("total") + F.col("words")))
    out = one.unionByName(many.select(one.columns))

    # a parent of one member is the same conversation's
    parents = nodes.filter("n_convs > 1").select(F.col("n0").alias("p0"), F.col("n1").alias("p1"), F.col("conv_id").alias("parent"))
    out = out.join(parents, ["p0", "p1"], "left").withColumn(
        "parent_conv_id", F.when(F.col("p0").isNotNull(), F.coalesce("parent", "conv_id")))

    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("n0", "n1"), "depth").alias("n"))
    ends = materialize(convs.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("n.n0", zero).alias("n0"), F.coalesce("n.n1", zero).alias("n1")), "trie-ends")
    counted = ends.groupBy("n0", "n1").agg(F.count(F.lit(1)).alias("ends"), F.min("conv_id").alias("conv_id"))
    single = counted.filter("ends = 1").select("n0", "n1", F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    several = end_digests(ends.join(counted.filter("ends > 1").select("n0", "n1"), ["n0", "n1"], "left_semi"))
    return (out.join(single.unionByName(several), ["n0", "n1"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
