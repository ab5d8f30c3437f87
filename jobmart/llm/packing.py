"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

1. Every document is encoded once (ids, then the end id) and cut into pieces: longer
   documents into ``capacity``-token pieces of which the first holds the remainder.
   Pieces, not ids, are kept: place, length and checksum.
2. Pieces are dealt at random into blocks of about ``block`` pieces; a block is one bin
   packing problem small enough for a task, large enough to fill bins to the last tokens.
   Full pieces are sequences of their own.
3. Each block evolves ``islands`` populations, every (block, island) a group of its own.
   An individual is a partition of the block's pieces into bins (the groups).
   Crossover injects whole well-filled bins of one parent into the other, bins that hold
   duplicates of injected pieces are dissolved, and displaced pieces are best-fitted (those that
   fill a bin exactly go first).
   Mutation dissolves the emptiest bins and a few others.  Between epochs every
   island's elite also migrates to the next island of its block.
4. The best individual of a block places its pieces gapless into sequences.

Defined results: null text is empty (one piece, the end id); an empty table gives no
pieces; rows that repeat a doc_id are packed as documents of their own.  The
result is deterministic: pieces carry a row id that is written with them, and every random
choice is seeded by block, island and epoch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteEncoder, blocks_of, id_text, materialize, partitions, text_or_empty

CAPACITY = 1024
END_ID = 2
BLOCK = 8192
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 8


# --- pieces -------------------------------------------------------------------
def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row's whole text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = ByteEncoder(tokenizer), np.uint32(end_id).astype("<u4").tobytes()
        for pdf in batches:
            out = []
            for doc, t in zip(pdf["doc_id"], pdf["text"]):
                ids = encoder.ids(t) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
    return (docs.select(id_text(key).alias("doc_id"), text_or_empty(text).alias("text"))
            .mapInPandas(run, "doc_id string, piece int, start long, length long, ids_crc32 long")
            .withColumn("doc_id", F.col("doc_id").cast("long")))


# --- one block ------------------------------------------------------------------
class Problem:
    """Pieces of one block by descending length; bins are numbered from 0."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity

    def loads(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, weights=self.lengths).astype(np.int64)

    def fitness(self, bins: np.ndarray) -> tuple[int, float]:
        """Fewer bins, then bins filled unevenly (full ones beside empty ones), are better."""
        fill = self.loads(bins) / self.capacity
        return -len(fill), float((fill ** 2).sum())

    def best_fit(self, bins: np.ndarray, items: np.ndarray, rng: np.random.Generator | None = None) -> np.ndarray:
        """Put ``items`` (longest first; jittered by ``rng``) each into the fullest bin that
        has room.  Other pieces keep the bins they are in; ``bins`` holds -1 for ``items``."""
        cap = self.capacity
        placed = bins >= 0
        used = np.bincount(bins[placed], weights=self.lengths[placed]).astype(np.int64)
        room: list[list[int]] = [[] for _ in range(cap + 1)]
        mask = 0
        for b, r in enumerate((cap - used).tolist()):
            if r > 0:
                room[r].append(b)
                mask |= 1 << r
        n_bins = len(used)
        length = self.lengths[items]
        order = np.argsort(-(length if rng is None else length * rng.uniform(0.9, 1.0, len(items))), kind="stable")
        out = bins.copy()
        for i, size in zip(items[order].tolist(), length[order].tolist()):
            fits = mask >> size
            if fits:
                r = size + (fits & -fits).bit_length() - 1
                b = room[r].pop()
                if not room[r]:
                    mask ^= 1 << r
                r -= size
            else:
                b, n_bins, r = n_bins, n_bins + 1, cap - size
            out[i] = b
            if r > 0:
                room[r].append(b)
                mask |= 1 << r
        return out

    def refit(self, bins: np.ndarray, items: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Best-fit displaced ``items``: bins with room first take one or two of them that fill
        it to the last token; then the longest item left goes to the open bin with the least room
        that holds it, and one or two that fill up what is left there go with it.  If no open bin holds it,
        it opens one, and those that fit its room best join it -- one, two or three that fill it
        exactly, else the longest that fits."""
        cap, out, placed = self.capacity, bins.copy(), bins >= 0
        used = np.bincount(bins[placed], weights=self.lengths[placed]).astype(np.int64)
        pool: list[list[int]] = [[] for _ in range(cap + 1)]
        for i in items.tolist():
            pool[int(self.lengths[i])].append(i)
        left = np.array([len(x) for x in pool])
        n, longest, remaining = len(used), cap, len(items)

        def exact(gap: int) -> tuple[int, ...] | None:
            if left[gap]:
                return (gap,)
            short = np.arange(gap // 2, 0, -1)
            both = (left[short] > 0) & (left[gap - short] > 0)
            if gap % 2 == 0 and len(both) and left[gap // 2] < 2:
                both[0] = False
            found = short[both]
            if not len(found):
                return None
            a = int(found[rng.integers(len(found))])
            return (gap - a, a)

        def three(gap: int) -> tuple[int, ...] | None:
            for a in np.flatnonzero(left[:gap])[::-1][:12].tolist():
                left[a] -= 1
                rest = exact(gap - a)
                left[a] += 1
                if rest:
                    return (a, *rest)
            return None

        def put(b: int, lengths: tuple[int, ...]) -> None:
            nonlocal remaining
            for size in lengths:
                out[pool[size].pop()] = b
                left[size] -= 1
                remaining -= 1

        room = cap - used
        bins_of: list[list[int]] = [[] for _ in range(cap + 1)]           # open bins by room
        mask = 0
        for b in rng.permutation(np.flatnonzero(room > 0)).tolist():
            r = int(room[b])
            found = exact(r) if remaining else None
            if found:
                put(b, found)
            else:
                bins_of[r].append(b)
                mask |= 1 << r
        while remaining:
            while not left[longest]:
                longest -= 1
            fits = mask >> longest
            if fits:
                r = longest + (fits & -fits).bit_length() - 1
                b = bins_of[r].pop()
                if not bins_of[r]:
                    mask ^= 1 << r
                put(b, (longest,))
                r -= longest
                found = exact(r) if r and remaining else None
                if found:
                    put(b, found)
                elif r:
                    bins_of[r].append(b)
                    mask |= 1 << r
                continue
            put(n, (longest,))
            gap = cap - longest
            while gap and remaining:
                found = exact(gap) or three(gap)
                if found:
                    put(n, found)
                    break
                fits = np.flatnonzero(left[:gap + 1])
                if not len(fits):
                    break
                put(n, (int(fits[-1]),))
                gap -= int(fits[-1])
            n += 1          # what room it has left holds none of the items left
        return out

    def crossover(self, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Whole well-filled bins of ``b`` go into ``a``; displaced pieces are best-fitted."""
        fill_a, fill_b = self.loads(a), self.loads(b)
        good = np.flatnonzero(fill_b >= max(self.capacity - 1, int(np.quantile(fill_b, 0.5))))
        good = good[rng.random(len(good)) < rng.uniform(0.3, 0.9)]
        if not len(good):
            good = np.array([int(fill_b.argmax())])
        chosen = np.zeros(len(fill_b), bool)
        chosen[good] = True
        injected = chosen[b]
        dissolved = np.zeros(len(fill_a), bool)      # bins of a with duplicates of injected pieces
        dissolved[a[injected]] = True
        child = np.where(injected, len(fill_a) + b, np.where(dissolved[a], -1, a))
        return self._refit(child, rng)

    def mutate(self, a: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The emptiest bins and some others are dissolved and their pieces best-fitted."""
        fill = self.loads(a)
        gone = rng.random(len(fill)) < 0.03
        gone[np.argsort(fill, kind="stable")[:max(1, len(fill) // 50)]] = True
        return self._refit(np.where(gone[a], -1, a), rng)

    def _refit(self, child: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        kept = child >= 0
        out = child.copy()
        out[kept] = np.unique(child[kept], return_inverse=True)[1]
        return self.refit(out, np.flatnonzero(~kept), rng)


def evolve(problem: Problem, population: list[np.ndarray], rng: np.random.Generator,
           size: int = POPULATION, generations: int = GENERATIONS) -> list[np.ndarray]:
    """The ``size`` fittest after some generations, best first.  Stops early at the volume bound."""
    bound = -(-int(problem.lengths.sum()) // problem.capacity)
    ranked = sorted(population, key=problem.fitness, reverse=True)[:size]
    for _ in range(generations):
        if ranked[0].max() + 1 <= bound:
            break
        i, j = rng.choice(len(ranked), 2, replace=len(ranked) < 2)
        child = problem.crossover(ranked[min(i, j)], ranked[max(i, j)], rng)
        ranked = sorted([*ranked, child, problem.mutate(child, rng)], key=problem.fitness, reverse=True)[:size]
    return ranked


# --- distribution -----------------------------------------------------------------
def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
                   block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 7,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = materialize(pieces_of(docs, capacity, end_id, tokenizer, key, text)
                         .withColumn("row", F.monotonically_increasing_id()), "pieces")
    blocks = blocks_of(pieces.count(), block)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(blocks)))
    n = partitions(spark)
    own = dealt.filter(F.col("length") < capacity).select("block", "row", "length")
    state = "block long, island int, elite boolean, lengths binary, bins binary"

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["block"].iloc[0])
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True])
        problem = Problem(pdf["length"].to_numpy(np.int64), capacity)
        all_, none = np.arange(len(pdf)), np.full(len(pdf), -1, np.int64)
        rows = []
        for island in range(islands):
            rng = np.random.default_rng([seed, b & (2**63 - 1), island])
            for k in range(POPULATION):
                bins = problem.best_fit(none, all_, None if island == k == 0 else rng)
                rows.append((b, island, k == 0, problem.lengths.astype("<i4").tobytes(), bins.astype("<i4").tobytes()))
        return pd.DataFrame(rows, columns=["block", "island", "elite", "lengths", "bins"])

    def epoch(number: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            b, island = int(pdf["block"].iloc[0]), int(pdf["island"].iloc[0])
            problem = Problem(np.frombuffer(pdf["lengths"].iloc[0], "<i4").astype(np.int64), capacity)
            rng = np.random.default_rng([seed, b & (2**63 - 1), island, number + 1])
            members = [np.frombuffer(x, "<i4").astype(np.int64) for x in sorted(pdf["bins"])]
            members = evolve(problem, members, rng)
            if number == epochs - 1:
                members = members[:1]
            head = pdf["lengths"].iloc[0]
            return pd.DataFrame([(b, island, i == 0, head, m.astype("<i4").tobytes()) for i, m in enumerate(members)],
                                columns=["block", "island", "elite", "lengths", "bins"])
        return run

    people = own.repartition(n, "block").groupBy("block").applyInPandas(first, state)
    for e in range(epochs):
        if e:   # every island's elite also goes to the next island
            moves = F.when(F.col("elite"), F.array("island", F.pmod(F.col("island") + 1, F.lit(islands)))).otherwise(F.array("island"))
            people = people.withColumn("island", F.explode(F.array_distinct(moves)))
        people = people.repartition(n, "block", "island").groupBy("block", "island").applyInPandas(epoch(e), state)

    def place(items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        b = int(items["block"].iloc[0])
        items = items.sort_values(["length", "row"], ascending=[False, True]).reset_index(drop=True)
        full = (items["length"] >= capacity).to_numpy()
        bins = np.arange(len(items))
        n_full, lengths = int(full.sum()), items["length"].to_numpy(np.int64)
        if n_full < len(items):
            problem = Problem(lengths[n_full:], capacity)
            found = [np.frombuffer(x, "<i4").astype(np.int64) for x in sorted(best["bins"])]
            bins[n_full:] = n_full + max(found, key=problem.fitness)
        order = np.argsort(bins, kind="stable")
        run = np.cumsum(lengths[order]) - lengths[order]
        firsts = np.r_[True, bins[order][1:] != bins[order][:-1]]
        offset = np.empty(len(items), np.int64)
        offset[order] = run - np.repeat(run[firsts], np.diff(np.append(np.flatnonzero(firsts), len(items))))
        # a block has fewer than 2**31 bins
        return items[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(
            sequence_id=(b << 31) + bins, offset=offset)

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return (dealt.withColumn("doc_id", id_text("doc_id")).repartition(n, "block").groupBy("block")
            .cogroup(people.select("block", "bins").repartition(n, "block").groupBy("block"))
            .applyInPandas(place, schema).withColumn("doc_id", F.col("doc_id").cast("long")))
