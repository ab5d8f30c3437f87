"""Embedding near-duplicates by inverted multi-indexes.

Vectors are compared by cosine, so they are scaled to length one.  A table halves the components,
taken in an order of its own, and each half has a codebook (k-means on a bounded sample); the pair
of nearest codewords is the vector's cell in the product grid, its home.  As a query, a vector visits
the cells nearest to it, in the multi-sequence order of d1(i) + d2(j); the first one is its home.  Two
vectors meet in a table if either visits the other's home.  A vector is copied to the cells that it
visits, so visits are few and a pair that does not meet in one table meets in another.  How many tables:
the most that any of these takes for a recall of ``target``, half as many again for safety: sampled
vectors against copies turned to a cosine of exactly the threshold, in random directions and in those of
the sample's own differences; and a bounded set of sample queries against all rows by brute force, as
the mean of each query's recall.  Of sampled vectors that link with each other one stands for all.  Where
``MOST`` tables are too few, visits are doubled, at last to all cells.
Pairs that meet in a cell are compared in single precision, those near the threshold again in double.

Vectors with equal components are one class (joined once, told apart by 128 bits of hashes).  Homes and visits of
all tables are staged with the vector once; then cells are worked off in passes: those of as many tables as take ``PASS_BYTES``, or a share of
one table's that takes one copy of the vectors.  The shuffle files of a pass are deleted before the next, so that disk holds one pass whatever their number.
A pair counts in the first table in which it meets, there in the lower cell.  Cells of more than ``BLOCK`` rows are
dealt out as pairs of blocks (homes with homes, homes with visitors), so that no task holds a
large cell; tasks return each class's number of links
and the smallest id it reaches there, from which components are built.

Rows: vec_id, n_links, component_id, kept.

Defined results: vectors that are null, zero, empty, or hold null or non-finite components
link with nothing; vectors link within their own dimension, which has an index of its own; a row without vec_id takes a negative
id made from its vector; rows that share a vec_id are one node of the graph; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_staged, stage
from .common import components, partitions

SAMPLE = 20_000      # vectors the codebooks are fitted on, at most
QUERIES = 256        # sample queries compared with all rows for the number of tables
PROBES = 2048        # sampled vectors that are turned to the threshold for it
PER_CELL = 48        # wanted vectors in a cell
MAX_CODES = 1024     # codewords of a half
BLOCK = 4096
VISITS = 2           # cells that a vector visits in a table, its home among them
MOST = 20            # tables without the safety share; where more are needed, visits are doubled
PASS_BYTES = 64 << 20      # rows dealt out at once, or one copy of all vectors if that is more
TASK_BYTES = 48 << 20      # of them, rows of a task
_STRIP = 2_000_000   # similarities held at once
_GROUP = 256


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; large components don't overflow."""
    x = np.asarray(x, float)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_distances(x[lo:lo + 2000], centres).argmin(1) for lo in range(0, len(x), 2000)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = x @ (-2 * centres.T)
    d += (x * x).sum(1)[:, None]
    d += (centres * centres).sum(1)[None, :]
    return d


def _nearest(d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the n smallest values of each row, ascending, and these values; ``d`` may be overwritten."""
    if n > 4:
        at = np.argsort(d, 1, kind="stable")[:, :n]
        return at, np.take_along_axis(d, at, 1)
    rows, at, least = np.arange(len(d)), [], []
    for _ in range(min(n, d.shape[1])):
        at.append(d.argmin(1))
        least.append(d[rows, at[-1]])
        d[rows, at[-1]] = np.inf
    return np.stack(at, 1), np.stack(least, 1)


class MultiIndex:
    """The two codebooks and the order in which a query visits the cells of their grid."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def visits(self, x: np.ndarray, n: int) -> np.ndarray:
        """(len(x), n) cells by ascending distance; the first one is the vector's own.

        The n nearest cells lie among the pairs of ranks (a, b) with (a+1)(b+1) <= n: any other
        pair has n nearer ones."""
        n = min(n, self.cells)
        half = self.first.shape[1]
        d1, d2 = _distances(x[:, :half], self.first), _distances(x[:, half:], self.second)
        (o1, s1), (o2, s2) = _nearest(d1, n), _nearest(d2, n)
        pairs = [(a, b) for a in range(o1.shape[1]) for b in range(o2.shape[1]) if (a + 1) * (b + 1) <= n]
        pa, pb = np.array(pairs).T
        rows = np.arange(len(x))[:, None]
        at = np.argsort(s1[:, pa] + s2[:, pb], 1, kind="stable")[:, :n]
        return o1[rows, pa[at]].astype(np.int64) * len(self.second) + o2[rows, pb[at]]

    def ranks(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells are nearer to each row than its one of ``cells``."""
        half, out = self.first.shape[1], []
        for lo in range(0, len(x), 1000):
            part, at = x[lo:lo + 1000], cells[lo:lo + 1000]
            d1, d2 = _distances(part[:, :half], self.first), _distances(part[:, half:], self.second)
            rows = np.arange(len(part))
            limit = d1[rows, at // len(self.second)] + d2[rows, at % len(self.second)]
            out += [np.searchsorted(s, f - one).sum() for s, f, one in zip(np.sort(d2, 1), limit, d1)]
        return np.array(out, np.int64)

    def meeting(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank at which row i of ``x`` and of ``y`` meet: either visits the other's cell."""
        a, b = self.visits(x, 1)[:, 0], self.visits(y, 1)[:, 0]
        out = np.zeros(len(x), np.int64)
        apart = np.flatnonzero(a != b)
        out[apart] = np.minimum(self.ranks(x[apart], b[apart]), self.ranks(y[apart], a[apart]))
        return out


class Table:
    """A multi-index over the components in an order of its own."""

    def __init__(self, sample: np.ndarray, k: int, number: int):
        self.order = np.random.default_rng([5, number]).permutation(sample.shape[1])
        half, x = sample.shape[1] // 2, sample[:, self.order].astype(np.float32)
        self.index = MultiIndex(codebook(x[:, :half], k, 2 * number + 1), codebook(x[:, half:], k, 2 * number + 2))

    def visits(self, x: np.ndarray, n: int) -> np.ndarray:
        return self.index.visits(x[:, self.order].astype(np.float32), n)

    def meeting(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.index.meeting(x[:, self.order].astype(np.float32), y[:, self.order].astype(np.float32))


def turned(x: np.ndarray, towards: np.ndarray, cosine: float) -> np.ndarray:
    """Each row of ``x`` (length one) turned towards its row of ``towards`` to the given cosine."""
    side = towards - (towards * x).sum(1, keepdims=True) * x
    size = np.sqrt((side * side).sum(1, keepdims=True))
    return cosine * x + (1 - cosine * cosine) ** 0.5 * side / np.where(size > 0, size, 1)


def _vectors(column: pa.Array) -> np.ndarray:
    """Arrays of one length as rows of a matrix, in their own precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    at = np.arange(len(rows) + 1, dtype=np.int32) * (rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(rows)])


def _rows_of(column: pa.Array, kind: str) -> np.ndarray:
    """Binary values of one length as rows of a matrix."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as arrays."""
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(rows.ravel()))


def _needed(ranks: np.ndarray, weights: np.ndarray, target: float) -> int:
    """The visits at which ``target`` of the weight has met."""
    at = np.argsort(ranks, kind="stable")
    share = np.cumsum(weights[at])
    return int(ranks[at[np.searchsorted(share, target * share[-1] * (1 - 1e-12))]]) + 1


def _sample(classes: DataFrame, n: int) -> np.ndarray:
    """The first ``SAMPLE`` vectors by a hash of their node."""
    order = F.xxhash64("node")
    if n > 4 * SAMPLE:     # only rows that can be among them are sorted
        low = classes.filter(order < -2**63 + int(2**64 * (2 * SAMPLE / n)))
        if low.count() >= SAMPLE:
            classes = low
    got = classes.select("embedding", order.alias("h"), "node").orderBy("h", "node").limit(SAMPLE).select("embedding").toArrow()
    return _vectors(got["embedding"].combine_chunks())


def _alone(x: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows link with no earlier one."""
    x, out = x.astype(np.float32), []
    for lo in range(0, len(x), 500):
        out.append(~np.tril(x[lo:lo + 500] @ x[:lo + 500].T >= threshold, lo - 1).any(1))
    return np.concatenate(out)


def fit_index(classes: DataFrame, threshold: float, target: float) -> tuple[list[Table], int]:
    """Tables with codebooks from a bounded sample, as many as ``target`` recall takes, and the number of visits."""
    n = classes.count()
    sample = unit(_sample(classes, n))
    k = int(min(MAX_CODES, max(1, round((n / PER_CELL) ** 0.5))))
    alone = _alone(sample, threshold)      # a group of close vectors weighs as one, and codewords do not cut it up
    apart, lone = sample[alone], sample[:PROBES][alone[:PROBES]]
    cells = min(k, len(apart)) ** 2
    probes, pairs = lone[np.arange(PROBES) % len(lone)], []
    if sample.shape[1] > 1:      # in one dimension all vectors are parallel or opposite
        rng = np.random.default_rng(3)
        noise = rng.normal(size=probes.shape)
        own = sample[rng.integers(len(sample), size=PROBES)] - sample[rng.integers(len(sample), size=PROBES)]
        pairs = [(probes, turned(probes, towards, threshold)) for towards in (noise, own + 1e-9 * noise)]
    tables: list[Table] = []
    ranks: list[list[np.ndarray]] = []

    def grow(to: int) -> None:
        for number in range(len(tables), to):
            tables.append(Table(apart, k, number))
            ranks.append([tables[-1].meeting(x, y) for x, y in pairs])

    def probed(visits: int) -> int:
        """Tables in which ``target`` of all probes have met; MOST + 1 if so many do not do."""
        met = np.zeros((len(pairs), PROBES), bool)
        for number in range(MOST):
            grow(number + 1)
            for m, r in zip(met, ranks[number]):
                m |= r < visits
            if (met.mean(1) >= target * (1 - 1e-12)).all():
                return number + 1
        return MOST + 1

    visits = VISITS
    while True:
        visits = min(cells, visits)
        needed = probed(visits)
        if needed <= MOST:
            grow(needed + -(-needed // 2))
            needed = max(needed, _measured(classes, tables, visits, lone[:QUERIES], threshold, target))
            if needed <= len(tables):
                break
        visits *= 2
    needed += -(-needed // 2) if visits < cells else 0
    grow(needed)
    return tables[:needed], visits


def _measured(classes: DataFrame, tables: list[Table], visits: int, queries: np.ndarray, threshold: float, target: float) -> int:
    """Tables in which ``target`` of the queries' links have met, as the mean over queries; one more than there are if they have not."""
    shared = classes.sparkSession.sparkContext.broadcast((tables, queries))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, queries = shared.value
        homes = [t.visits(queries, visits) for t in tables]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(_vectors(batch.column(0)))
            near = x @ queries.T
            row, q = np.nonzero((near >= threshold) & (near < 1 - 1e-12))
            if not len(row):
                continue
            at, left = np.full(len(row), len(tables)), np.arange(len(row))
            for number, (t, theirs) in enumerate(zip(tables, homes)):
                met = _meet(t.visits(x[row[left]], visits), theirs[q[left]])
                at[left[met]] = number
                left = left[~met]
                if not len(left):
                    break
            key, count = np.unique(q * (len(tables) + 1) + at, return_counts=True)
            yield pa.RecordBatch.from_pydict({"query": key // (len(tables) + 1), "first": key % (len(tables) + 1), "n": count.astype(np.int64)})

    # a row for each query and table comes back, not for each pair
    got = (classes.select("embedding").mapInArrow(first, "query long, first long, n long").groupBy("query", "first")
           .agg(F.sum("n").alias("n")).orderBy("query", "first").toPandas())
    if not len(got):
        return 1
    weights = got["n"] / got.groupby("query")["n"].transform("sum")
    return _needed(got["first"].to_numpy(), weights.to_numpy(), target)


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row i of either visits the home of the other's."""
    return (a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """``root`` after rows a[i] and b[i] are of one set; sets are named by their lowest row."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


def _verify(table: int, cell: int, x: np.ndarray, raw: np.ndarray, ids: np.ndarray, copies: np.ndarray, visits: np.ndarray,
            lower: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links among the rows of a cell, homes with homes and homes with visitors: nodes, links, smallest ids.

    ``x`` are the vectors at length one in single precision, ``visits[i, t]`` the cells of row i in table t; of a
    pair of blocks ``lower`` says which rows are the lower one's, which are homes."""
    home = visits[:, table, 0] == cell
    if lower is None:
        left, right = np.flatnonzero(home), np.arange(len(x))
    else:
        left, right = np.flatnonzero(lower), np.flatnonzero(~lower)
    if not len(left) or not len(right):
        return None
    sides = [(left, right)]
    if table and len(left) > _GROUP:      # pairs of one home in the first table have met there: large groups are not compared again
        at_first, n = np.unique(visits[left, 0, 0], return_counts=True)
        for one in at_first[n > _GROUP]:
            same = visits[left, 0, 0] == one
            sides.append((left[same], right[visits[right, 0, 0] != one]))
            left = left[~same]
        sides[0] = (left, right)
    slack = np.float32((x.shape[1] + 16) * 2.0 ** -23)      # more than single precision is off
    rank = None
    for left, right in sides:
        others, step = x[right].T, max(1, _STRIP // max(1, len(right)))
        for lo in range(0, len(left) if len(right) else 0, step):
            near = (x[left[lo:lo + step]] @ others).ravel()
            at = np.flatnonzero(near >= threshold - slack)
            a, b = left[lo + at // len(right)], right[at % len(right)]
            if lower is None:      # a row and itself; two homes meet once
                one = ~home[b] | (a < b)
                at, a, b = at[one], a[one], b[one]
            if not len(a):
                continue
            unsure = np.flatnonzero(near[at] < threshold + slack)
            if len(unsure):
                sure = np.ones(len(a), bool)
                for part in np.array_split(unsure, 1 + len(unsure) // 20_000):
                    sure[part] = np.einsum("ij,ij->i", unit(raw[a[part]]), unit(raw[b[part]])) >= threshold
                a, b = a[sure], b[sure]
            for t in range(table):      # pairs that have met in an earlier table count there
                if not len(a):
                    break
                new = ~_meet(visits[a, t], visits[b, t])
                a, b = a[new], b[new]
            # a home and a visitor that each visit the other's cell: the lower cell counts
            theirs = visits[b, table, :1]
            new = ~((theirs[:, 0] < cell) & (visits[a, table] == theirs).any(1))
            a, b = a[new], b[new]
            if not len(a):
                continue
            if rank is None:
                order = np.argsort(ids, kind="stable")      # rows by id, as sets are named by their lowest
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                root, links = np.arange(len(x)), np.zeros(len(x), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            _join(root, rank[a], rank[b])
    if rank is None:
        return None
    got = links > 0
    return ids[got], links[got], ids[order[root[rank[got]]]]


@contextmanager
def _without_old_shuffles(spark: SparkSession):
    """Each statement's shuffle files are deleted at its end; what it stages is read again, not they."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def near_dedup(embeddings: DataFrame, threshold: float = 0.9, target: float = 0.999, key: str = "vec_id",
               vector: str = "embedding") -> DataFrame:
    """One row per row of ``embeddings``; see the module's docstring."""
    spark = embeddings.sparkSession
    single = embeddings.select(F.col(vector).alias("v")).dtypes[0][1] == "array<float>"
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("embedding"))
    v, kind = F.col("embedding"), "float" if single else "double"
    # looked for in vain, a value is in no place of an array or, where the array holds nulls, it is not known whether it is
    whole = ~F.array_contains(v, F.lit(float("nan")).cast(kind))
    sound = whole & (F.array_max(v) < float("inf")) & (F.array_min(v) > -float("inf")) & ((F.array_max(v) != 0) | (F.array_min(v) != 0))
    node = F.coalesce("vec_id", -1 - F.shiftrightunsigned(F.xxhash64(v.cast("array<double>")), 1))
    rows = rows.withColumns({"sound": F.coalesce(sound, F.lit(False)), "node": node})
    out = rows.filter(~F.col("sound")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("node").alias("component_id"),
                                              F.lit(True).alias("kept"))
    rows = rows.filter("sound")
    with _without_old_shuffles(spark):
        classes, in_classes = stage(rows.groupBy("embedding").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("copies")), "dedup-classes")
        dims = [r.d for r in classes.select(F.size("embedding").alias("d")).distinct().orderBy("d").collect()]
        # vectors of different dimensions have no cosine: an index for each
        links = [_of_dimension(classes.filter(F.size("embedding") == d), kind, threshold, target, [in_classes] * (d == dims[-1])) for d in dims]
    if not links:
        return out
    per_class = links[0]
    for more in links[1:]:
        per_class = per_class.unionByName(more)
    return (rows.select("vec_id", "node", *_hashes()).join(per_class, ["h1", "h2"])
            .select("vec_id", "n_links", "component_id", (F.col("node") == F.col("component_id")).alias("kept")).unionByName(out))


def _hashes() -> list[Column]:
    """128 bits that tell vectors apart."""
    return [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2")]


def _of_dimension(classes: DataFrame, kind: str, threshold: float, target: float, done: list[str]) -> DataFrame:
    """Links and components of classes of vectors of one dimension; the folders ``done`` are deleted once these are read."""
    spark, kind = classes.sparkSession, "<f4" if kind == "float" else "<f8"
    tables, visits = fit_index(classes, threshold, target)
    cells = tables[0].index.cells
    shared = spark.sparkContext.broadcast(tables)
    step = max(1, min(2000, 200_000 // visits))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(lo, step) for lo in range(0, batch.num_rows, step)):
                raw = _vectors(part.column("embedding"))
                x = unit(raw)
                seen = np.hstack([t.visits(x, visits) for t in shared.value]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in ("node", "copies", "h1", "h2")}
                                                 | {"vector": _binary(raw.astype(kind)), "visits": _lists(seen)})

    placed, in_placed = stage(classes.select("*", *_hashes()).mapInArrow(
        place, "node long, copies long, h1 long, h2 long, vector binary, visits array<int>"), "dedup-placed")
    drop_staged(spark, done)
    large, in_large = stage(_large(placed, len(tables), cells, visits), "dedup-large")
    large_in = {r.t for r in large.select(F.floor(F.col("cell") / cells).alias("t")).distinct().collect()}
    n, width = (placed.count(), len(placed.select("vector").first().vector) + 4 * len(tables) * visits + 64)
    at_once = max(1, PASS_BYTES // (n * visits * width))
    shares = math.ceil(n * visits * width / max(PASS_BYTES, n * width))      # 1 if a pass takes a whole table
    found, staged = [], [in_placed, in_large]
    for lo, share in ((lo, share) for lo in range(0, len(tables), at_once) for share in range(shares)):
        numbers = range(lo, min(len(tables), lo + at_once))
        met = _dealt(placed, numbers, share, shares, cells, visits, large if large_in & {*numbers} else None)
        tasks = partitions(spark, math.ceil(len(numbers) * n * visits * width / shares / TASK_BYTES))
        links, path = stage(met.repartition(tasks, "cell", "pair").sortWithinPartitions("cell", "pair")
                            .mapInArrow(_verifier(cells, visits, kind, threshold), "node long, links long, root long"), "dedup-found")
        found.append(links)
        staged.append(path)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    links = every.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(every.select(F.col("node").alias("a"), F.col("root").alias("b")), "dedup-cc")
    per_class = stage(placed.join(links, "node", "left").join(reach, "node", "left")
                      .select("h1", "h2", F.coalesce("component", "node").alias("component_id"),
                              (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "dedup-links")[0]
    drop_staged(spark, staged)
    return per_class


def _large(placed: DataFrame, tables: int, cells: int, visits: int) -> DataFrame:
    """Cells of more than ``BLOCK`` rows, numbered over all tables, and how many blocks of homes and of visitors they make."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        first = np.arange(tables, dtype=np.int64)[None, :, None] * cells

        def counted() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"cell": key >> 1, "n": n.astype(np.int64), "homes": np.where(key & 1, 0, n).astype(np.int64)})
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = 2 * (_vectors(batch.column(0)).reshape(-1, tables, visits) + first)
            seen[:, :, 1:] += 1      # visitors
            held.append(seen.ravel())
            size += seen.size
            if size > 2_000_000:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    return (placed.select("visits").mapInArrow(count, "cell long, n long, homes long").groupBy("cell")
            .agg(F.sum("n").alias("n"), F.sum("homes").alias("homes")).filter((F.col("n") > BLOCK) & (F.col("homes") > 0))
            .select("cell", F.ceil(F.col("homes") / BLOCK).cast("int").alias("inner"), F.ceil((F.col("n") - F.col("homes")) / BLOCK).cast("int").alias("outer")))


def _dealt(placed: DataFrame, numbers: range, share: int, shares: int, cells: int, visits: int, large: DataFrame | None) -> DataFrame:
    """Every vector in the cells that it visits in the tables ``numbers``; cells that are ``large`` as pairs of blocks.

    Of ``shares`` shares of the cells this is the one numbered ``share``."""
    rest = ["node", "copies", "vector"]
    table = F.lit(numbers[0]) + F.floor(F.col("pos") / visits).cast("int")
    met = (placed.select(*rest, "visits", F.posexplode(F.slice("visits", numbers[0] * visits + 1, len(numbers) * visits)))
           .select(*rest, (F.col("col") + table.cast("long") * cells).alias("cell"), (F.col("pos") % visits > 0).alias("visitor"),
                   F.slice("visits", F.lit(1), (table + 1) * visits).alias("visits")))      # earlier tables tell which pairs have met
    if shares > 1:
        met = met.filter(F.col("cell") % shares == share)
    rest.append("visits")
    if large is None:
        return met.select("cell", F.lit(0).cast("long").alias("pair"), F.lit(True).alias("lower"), *rest)
    # blocks of homes are numbered before blocks of visitors, which meet homes only
    hashed = F.xxhash64("node", F.lit(3))
    cell = F.col("cell")
    here = large.filter((cell >= numbers[0] * cells) & (cell < (numbers[-1] + 1) * cells))
    return (met.join(F.broadcast(here), "cell", "left").withColumn("own", F.when(F.col("inner").isNull(), 0).when(
                F.col("visitor"), F.col("inner") + F.pmod(hashed, F.col("outer"))).otherwise(F.pmod(hashed, F.col("inner"))).cast("int"))
            .withColumn("last", F.when(F.col("inner").isNull(), 0).when(F.col("visitor"), F.col("inner") - 1)
                        .otherwise(F.col("inner") + F.col("outer") - 1))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .select("cell", (F.least("own", "other").cast("long") * 2**31 + F.greatest("own", "other")).alias("pair"),
                    (F.col("own") <= F.col("other")).alias("lower"), *rest))


def _verifier(cells: int, visits: int, kind: str, threshold: float):
    """For sorted rows of cells and pairs of blocks: each node's links and the smallest id that it reaches there."""
    def links(chunk: pa.RecordBatch, cuts: np.ndarray) -> Iterator[tuple]:
        raw = _rows_of(chunk.column("vector"), kind)
        x = unit(raw).astype(np.float32)
        data, at = chunk.column("visits").values.to_numpy(), chunk.column("visits").offsets.to_numpy()
        cell, pair, node, copies = (chunk.column(c).to_numpy() for c in ("cell", "pair", "node", "copies"))
        lower = chunk.column("lower").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi - lo < 2:
                continue
            table, own = divmod(int(cell[lo]), cells)
            seen = data[at[lo]:at[hi]].reshape(hi - lo, table + 1, visits)
            one = pair[lo] >> 31 == pair[lo] & (2**31 - 1)
            got = _verify(table, own, x[lo:hi], raw[lo:hi], node[lo:hi], copies[lo:hi], seen, None if one else lower[lo:hi], threshold)
            if got:
                yield got

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for chunk, cuts in _runs(batches, ["cell", "pair"]):
            for got in links(chunk, cuts):
                out.append(got)
                size += len(got[0])
                if size > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "links", "root"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "links", "root"])
    return verify


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole runs of equal ``keys`` in a sorted stream: rows, and where the runs among them begin and end."""
    held: list[pa.RecordBatch] = []      # rows of the last run, which may go on
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys], 1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        if held and (k[0] != last).any():
            cuts = np.r_[0, cuts]
        last = k[-1]
        if len(cuts):
            before = sum(b.num_rows for b in held)
            done = pa.concat_batches([*held, batch.slice(0, int(cuts[-1]))])
            cuts_of = np.unique(np.r_[0, cuts + before])
            yield done, cuts_of
            held = []
        held.append(batch.slice(int(cuts[-1]) if len(cuts) else 0))
    if held:
        done = pa.concat_batches(held)
        yield done, np.array([0, done.num_rows])
