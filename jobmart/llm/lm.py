"""LM scoring with a weighted backoff automaton.

Model: interpolated trigrams with absolute discounting over all training documents.
States are histories of two words that occur at least ``REPEATS`` times in training, of one
word, and the empty one.  From state h, a word w that followed h in training has an arc
weighted log p(w | h); every other word takes h's failure arc, weighted with the mass that
the discounts of h left over, to the state of h without its first word, and from there on to
the empty state, whose arc carries the discounted unigram probability (unseen words share
what the unigram discounts left over).  A history of two words that is no state of its own
is that of its last word.  A text is read once from left to right: the state carried is the
longest one that ends in the words read, the log-probabilities of the arcs taken are
summed.  ``order=2`` leaves the two-word states out.

Scale: neither the vocabulary nor the automaton fits a task, so texts are dealt to blocks of
about ``BLOCK_BYTES`` and words to shards by their 64-bit hash.

1. each block counts its words and word pairs and sends every shard its part;
2. each shard adds them up and answers every block with the totals of that block's words
   (count, number of distinct followers), which of its pairs other blocks hold as well and what these add
   to their counts, and its share of the corpus totals;
3. each block, which now knows the totals of its pairs, sends the words that follow the
   pairs that are states to the shards of those pairs, which add up and answer in the same way;
4. each block builds the arcs its texts need and walks them.

Texts are shuffled once (all uses of the blocks share the exchange).  Pairs go to the shard of their
first word; words that start many pairs (found in a small sample, which decides the dealing only,
never a result) have their pairs spread over all shards by the second word.  A pair is kept as
the first word's 64-bit hash and 32 bits of the second's, a state of two words is
told apart by its shard and 48 bits, a triple by its state and 32 bits of the word that follows.

Base: add-one unigrams, sum of log10((c + 1) / (N + V + 1)).

Defined results: null text has the end token only; a null doc_id counts as the empty text for the fold;
without training documents both scores are those of one unseen type (0.0); repeated rows
count and are scored as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, id_text, partitions, text_or_empty
from .hashing import mix64, token_hashes

FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 8 << 20
END = np.uint64(1)           # the end token's hash
HOT = 64                     # words whose pairs are spread, at most
HOT_SAMPLE = 512             # documents they are looked for in, from all over the table
ORDER = 3
REPEATS = 2                  # occurrences in training that make a history of two words a state


# --- a block of texts ---------------------------------------------------------------
class Block:
    """Words and pairs of a block, in the order in which blocks and shards exchange them."""

    def __init__(self, texts: list[str], train: np.ndarray, shards: int, hot: np.ndarray):
        words, counts = token_hashes(texts)
        self.sizes = counts + 1
        ends = np.cumsum(self.sizes) - 1
        tokens = np.empty(int(self.sizes.sum()), np.uint64)
        is_end = np.zeros(len(tokens), bool)
        is_end[ends] = True
        tokens[is_end], tokens[~is_end] = END, words
        weight = self.weight = np.repeat(train, self.sizes)
        vocab, self.word = np.unique(tokens, return_inverse=True)
        order = np.argsort(vocab % np.uint64(shards), kind="stable")      # by shard, then hash
        place = np.empty(len(vocab), np.int64)
        place[order] = np.arange(len(vocab))
        self.vocab, self.word = vocab[order], place[self.word]
        shard = (self.vocab % np.uint64(shards)).astype(np.int64)
        self.at = np.searchsorted(shard, np.arange(shards + 1))
        self.counts = np.bincount(self.word, weights=weight, minlength=len(vocab)).astype(np.int64)
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        end = int(np.searchsorted(vocab, END))
        self.end = place[end]
        before[np.concatenate([[0], ends[:-1] + 1])] = self.end           # a text starts in the end state
        self.before = before
        # pairs: (first word's place, 32 bits of the second); hot first words by (shard, first, second)
        second = self.second_of = mix64(self.vocab) >> np.uint64(32)
        self.hot_of = np.full(len(vocab), -1, np.int64)
        found = np.searchsorted(hot, self.vocab)
        found[found == len(hot)] = 0
        if len(hot):
            same = hot[found] == self.vocab
            self.hot_of[same] = found[same]
        code = (before.astype(np.uint64) << np.uint64(32)) | second[self.word]
        spread = self.hot_of[before] >= 0
        self.pair = np.empty(len(tokens), np.int64)
        cold, inv = np.unique(code[~spread], return_inverse=True)
        self.pair[~spread] = inv
        self.n_cold = len(cold)
        self.first = (cold >> np.uint64(32)).astype(np.int64)
        self.second = (cold & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        self.runs = np.bincount(self.first, minlength=len(vocab))         # pairs of each first word, in place order
        self.cold_at = np.concatenate([[0], np.cumsum(self.runs)])[self.at]
        h = self.hot_of[before[spread]].astype(np.uint64)
        s = second[self.word[spread]]
        warm, inv = np.unique(((s % np.uint64(shards)) << np.uint64(40)) | (h << np.uint64(32)) | s, return_inverse=True)
        self.pair[spread] = self.n_cold + inv
        self.warm_key = (warm & np.uint64(0xFFFFFFFFFF)).astype(np.uint64)  # (hot word, second)
        self.warm_at = np.searchsorted((warm >> np.uint64(40)).astype(np.int64), np.arange(shards + 1))
        self.pair_counts = np.bincount(self.pair, weights=weight, minlength=self.n_cold + len(warm)).astype(np.int64)

    def parts(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """What each shard is sent."""
        for s in range(shards):
            u, c, w = (slice(a[s], a[s + 1]) for a in (self.at, self.cold_at, self.warm_at))
            yield s, _pack(self.vocab[u], self.counts[u], self.runs[u], self.second[c], self.pair_counts[c],
                           self.warm_key[w], self.pair_counts[self.n_cold:][w])


class Histories:
    """The two-word histories of a block that are states, and the words that follow them.

    A pair that no other block holds, held-out texts included, is known here in full (``own``), and so
    are the triples that hold it; shards are sent the others, and the number of the known ones."""

    def __init__(self, block: Block, pairs: np.ndarray, own: np.ndarray, shards: int):
        inside = np.ones(len(block.word), bool)
        inside[np.cumsum(block.sizes) - block.sizes] = False              # a text's first word follows the end state alone
        self.place = np.flatnonzero(inside)
        self.place = self.place[pairs[block.pair[self.place - 1]] >= REPEATS]
        last = self.place - 1
        key = mix64(block.vocab[block.before[last]] * np.uint64(0x9E3779B97F4A7C15) + mix64(block.vocab[block.word[last]]))
        names, first, state = np.unique(key, return_index=True, return_inverse=True)
        order = np.argsort(names % np.uint64(shards), kind="stable")
        to = np.empty(len(names), np.int64)
        to[order] = np.arange(len(names))
        names, known, self.state = names[order], own[block.pair[last]][first][order], to[state]
        shard = (names % np.uint64(shards)).astype(np.int64)
        code = (self.state.astype(np.uint64) << np.uint64(32)) | block.second_of[block.word[self.place]]
        triples, first, self.triple = np.unique(code, return_index=True, return_inverse=True)
        of = (triples >> np.uint64(32)).astype(np.int64)
        self.counts = np.bincount(self.triple, weights=block.weight[self.place], minlength=len(triples)).astype(np.int64)
        here = own[block.pair[self.place]][first] | known[of]             # triples that are known in full
        self.followers = np.bincount(of[here & (self.counts > 0)], minlength=len(names))
        self.own_stats = np.array([(self.counts[here] == 1).sum(), (self.counts[here] == 2).sum()], np.int64)
        self.shared, self.sent = np.flatnonzero(~known), np.flatnonzero(~here)
        self.names = names[self.shared] >> np.uint64(16)                  # within a shard
        self.at = np.searchsorted(shard[self.shared], np.arange(shards + 1))
        self.runs = np.bincount(of[self.sent], minlength=len(names))[self.shared]
        self.sent_at = np.concatenate([[0], np.cumsum(self.runs)])[self.at]
        self.second = (triples[self.sent] & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def parts(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """What each shard is sent."""
        for s in range(shards):
            h, t = slice(self.at[s], self.at[s + 1]), slice(self.sent_at[s], self.sent_at[s + 1])
            yield s, _pack(self.names[h], self.runs[h], self.followers[self.shared[h]], self.second[t],
                           self.counts[self.sent[t]], self.own_stats * (s == 0))

    def totals(self, answers: dict[int, bytes], shards: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Number of different followers of each state, count of each triple, and the discount."""
        stats, followers, counts = np.zeros(2, np.int64), self.followers.copy(), self.counts.copy()
        for s in range(shards):
            part, f, more = _unpack(answers[s])
            stats += part
            followers[self.shared[self.at[s]:self.at[s + 1]]] = f
            counts[self.sent[self.sent_at[s]:self.sent_at[s + 1]]] += more
        return followers, counts, discount(*stats.tolist())


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other: counts in the least width, hashes, which are in order or nearly
    so, as differences; each byte of a value goes to a stream of its own, which is compressed."""
    out = []
    z = zstandard.ZstdCompressor(level=1)
    for a in arrays:
        if a.dtype.kind == "i":
            top = int(a.max()) if len(a) else 0
            kind, values = "<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8", a
        else:
            kind, values = a.dtype.str, np.diff(a, prepend=a.dtype.type(0))
        streams = []
        for plane in values.astype(kind).view(np.uint8).reshape(len(a), -1 if len(a) else 1).T:
            raw = plane.tobytes()
            small = z.compress(raw)
            streams.append(small if len(small) < len(raw) else raw)
        out.append((b"c" if a.dtype.kind == "i" else b"r") + kind[1:].encode() + len(a).to_bytes(8, "little"))
        out += [len(x).to_bytes(8, "little") + x for x in streams if len(a)]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at, z = [], 0, zstandard.ZstdDecompressor()
    while at < len(data):
        counts, kind = data[at:at + 1] == b"c", np.dtype("<" + data[at + 1:at + 3].decode())
        n, at = int.from_bytes(data[at + 3:at + 11], "little"), at + 11
        planes = np.empty((n, kind.itemsize), np.uint8)
        for k in range(kind.itemsize if n else 0):
            held = int.from_bytes(data[at:at + 8], "little")
            stream = data[at + 8:at + 8 + held]
            at += 8 + held
            planes[:, k] = np.frombuffer(stream if held == n else z.decompress(stream), np.uint8)
        values = planes.reshape(-1).view(kind)
        out.append(values.astype(np.int64) if counts else np.cumsum(values, dtype=kind))
    return out


# --- a shard of the model -------------------------------------------------------------
def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, place of each key in them, total counts)."""
    flat = np.concatenate(keys)
    names, inv = np.unique(flat, return_inverse=True)
    return names, inv, np.bincount(inv, weights=np.concatenate(counts), minlength=len(names)).astype(np.int64)


def _elsewhere(inv: np.ndarray, counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """For each block's keys: 0 where no other block holds the key, else 1 + what the others add to its count."""
    return np.where(np.bincount(inv, minlength=len(total))[inv] > 1, total[inv] - counts + 1, 0)


def answer(parts: list[bytes], hot: int) -> list[bytes]:
    """A shard's answers to the blocks that sent ``parts``, in the same order."""
    got = [_unpack(p) for p in parts]
    sizes = [[len(a) for a in g] for g in got]
    words, word, total = _totals([g[0] for g in got], [g[1] for g in got])
    runs = np.concatenate([g[2] for g in got])
    code = (np.repeat(word, runs).astype(np.uint64) << np.uint64(32)) | np.concatenate([g[3] for g in got]).astype(np.uint64)
    cold_counts, warm_counts = (np.concatenate([g[k] for g in got]) for k in (4, 6))
    cold, inv, cold_total = _totals([code], [cold_counts])
    followers = np.bincount((cold[cold_total > 0] >> np.uint64(32)).astype(np.int64), minlength=len(words))
    warm, warm_inv, warm_total = _totals([g[5] for g in got], [warm_counts])
    warm_followers = np.bincount((warm[warm_total > 0] >> np.uint64(32)).astype(np.int64), minlength=hot)[:hot]
    pair_totals = np.concatenate([cold_total, warm_total])
    stats = np.array([total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum(),
                      (pair_totals == 1).sum(), (pair_totals == 2).sum()], np.int64)
    cold_more, warm_more = _elsewhere(inv, cold_counts, cold_total), _elsewhere(warm_inv, warm_counts, warm_total)
    out = []
    u = c = w = 0
    for g, n in zip(got, sizes):
        mine, mine_cold, mine_warm = word[u:u + n[0]], cold_more[c:c + n[3]], warm_more[w:w + n[5]]
        u, c, w = u + n[0], c + n[3], w + n[5]
        out.append(_pack(stats, total[mine], followers[mine], warm_followers.astype(np.int64), mine_cold, mine_warm))
    return out


def answer_histories(parts: list[bytes]) -> list[bytes]:
    """A shard's answers to the blocks that sent ``parts`` of their two-word histories."""
    got = [_unpack(p) for p in parts]
    names, state = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    runs, known = (np.concatenate([g[k] for g in got]) for k in (1, 2))
    code = (np.repeat(state, runs).astype(np.uint64) << np.uint64(32)) | np.concatenate([g[3] for g in got]).astype(np.uint64)
    triples, inv, total = _totals([code], [np.concatenate([g[4] for g in got])])
    followers = (np.bincount((triples[total > 0] >> np.uint64(32)).astype(np.int64), minlength=len(names))
                 + np.bincount(state, weights=known, minlength=len(names)).astype(np.int64))
    stats = sum((g[5] for g in got), np.array([(total == 1).sum(), (total == 2).sum()], np.int64))
    out, h, t = [], 0, 0
    for g in got:
        out.append(_pack(stats, followers[state[h:h + len(g[0])]], total[inv[t:t + len(g[3])]] - g[4]))
        h, t = h + len(g[0]), t + len(g[3])
    return out


# --- the walk ---------------------------------------------------------------------------
def discount(n1: int, n2: int) -> float:
    """Absolute discount from the numbers of singletons and pairs."""
    return min(0.99, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


class Model:
    """What a block's texts need of the words and pairs of the whole corpus."""

    def __init__(self, block: Block, answers: dict[int, bytes], shards: int, hot: int):
        self.stats = np.zeros(6, np.int64)
        self.count, self.followers = np.zeros(len(block.vocab), np.int64), np.zeros(len(block.vocab), np.int64)
        warm_followers = np.zeros(hot, np.int64)
        more = np.zeros(len(block.pair_counts), np.int64)
        for s in range(shards):
            part, c, f, wf, more_cold, more_warm = _unpack(answers[s])
            self.stats += part
            self.count[block.at[s]:block.at[s + 1]], self.followers[block.at[s]:block.at[s + 1]] = c, f
            warm_followers += wf
            more[block.cold_at[s]:block.cold_at[s + 1]] = more_cold
            more[block.n_cold + block.warm_at[s]:block.n_cold + block.warm_at[s + 1]] = more_warm
        self.own = more == 0                                              # pairs of this block alone
        self.pairs = block.pair_counts + np.maximum(more - 1, 0)
        is_hot = block.hot_of >= 0
        self.followers[is_hot] += warm_followers[block.hot_of[is_hot]]


def walk(block: Block, model: Model, histories: Histories | None, answers: dict[int, bytes], shards: int) -> dict[str, np.ndarray]:
    """Scores of the block's texts: the arcs that they take and their sums."""
    count = model.count
    n, v, u1, u2, b1, b2 = model.stats.tolist()
    d1, d2 = discount(u1, u2), discount(b1, b2)
    if n:
        unigram = np.maximum(count - d1, 0) / n + d1 * v / n / (v + 1)
    else:
        unigram = np.ones(len(count))
    # every training word is followed by a word, so a state is left as often as its word occurs
    left = np.maximum(count, 1)
    failure = np.where(count > 0, d2 * model.followers / left, 1.0)
    seen, state = model.pairs[block.pair], block.before
    p = np.maximum(seen - d2, 0) / left[state] + failure[state] * unigram[block.word]
    if histories is not None and len(histories.place):
        followers, triples, d3 = histories.totals(answers, shards)
        at, left = histories.place, model.pairs[block.pair[histories.place - 1]]
        p[at] = np.maximum(triples[histories.triple] - d3, 0) / left + d3 * followers[histories.state] / left * p[at]
    starts = np.cumsum(block.sizes) - block.sizes
    base = np.log10((count + 1) / (n + v + 1))
    return {"n_tokens": block.sizes, "n_known": np.add.reduceat((count > 0)[block.word].astype(np.int64), starts),
            "train_tokens": np.full(len(block.sizes), n), "base_score": np.add.reduceat(base[block.word], starts),
            "score": np.add.reduceat(np.log10(p), starts)}


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, order: int = ORDER,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    rows = docs.select(id_text(key).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("held_out", F.crc32(F.coalesce("doc_id", F.lit(""))) % FOLDS == HELD_OUT)
    total, n_rows = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    blocks = blocks_of(total or 0, block_bytes, 64)
    shards = max(64, blocks // 2)
    n = partitions(spark, blocks // 4)
    # decides where pairs are counted, not what is counted
    share = min(1.0, HOT_SAMPLE / max(1, n_rows))
    sample = [t for t, in rows.select(F.substring("text", 1, 20_000)).sample(share, 17).limit(2 * HOT_SAMPLE).collect()]
    words, seen = np.unique(token_hashes(sample)[0], return_counts=True)
    often = np.flatnonzero(seen >= max(8, seen.sum() / (4 * shards)))
    hot = np.sort(np.append(words[often[np.argsort(-seen[often], kind="stable")][:HOT - 1]], END))
    n_hot = len(hot)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(n, "block")

    def block_of(pdf: pd.DataFrame) -> Block:
        return Block(pdf["text"].tolist(), ~pdf["held_out"].to_numpy(bool), shards, hot)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(s, int(pdf["block"].iloc[0]), part) for s, part in block_of(pdf).parts(shards)],
                            columns=["shard", "block", "part"])

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": pdf["shard"], "block": pdf["block"], "part": answer(list(pdf["part"]), n_hot)})

    def of(answers: pd.DataFrame, what: int) -> dict[int, bytes]:
        mine = answers[answers["what"] == what]
        return dict(zip(mine["shard"], mine["part"]))

    def count_histories(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["shard", "block", "part"])
        block = block_of(pdf)
        model = Model(block, of(answers, 2), shards, n_hot)
        histories = Histories(block, model.pairs, model.own, shards)
        return pd.DataFrame([(s, int(pdf["block"].iloc[0]), part) for s, part in histories.parts(shards)],
                            columns=["shard", "block", "part"])

    def add_up_histories(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": pdf["shard"], "block": pdf["block"], "part": answer_histories(list(pdf["part"]))})

    def score(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        block = block_of(pdf)
        model = Model(block, of(answers, 2), shards, n_hot)
        histories = Histories(block, model.pairs, model.own, shards) if order > 2 else None
        got = walk(block, model, histories, of(answers, 3), shards)
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "held_out": pdf["held_out"].to_numpy(), **got})

    part = "shard int, block long, part binary"

    def answered(parts: DataFrame, by, what: int) -> DataFrame:
        return (parts.repartition(max(n, shards // 2), "shard").groupBy("shard").applyInPandas(by, part)
                .withColumn("what", F.lit(what)).repartition(n, "block"))

    answers = answered(dealt.groupBy("block").applyInPandas(count, part), add_up, 2)
    if order > 2:
        more = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(count_histories, part)
        answers = answers.unionByName(answered(more, add_up_histories, 3))
    return (dealt.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInPandas(score, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double")
            .withColumn("doc_id", F.col("doc_id").cast("long")))
