"""LM scores, fingerprints and token counts against brute force and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from jobmart.llm import fingerprint as FP
from jobmart.llm import lm, tokencount
from jobmart.llm.common import ByteEncoder
from jobmart.llm.hashing import token_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, score string"


def some_docs():
    rng = np.random.default_rng(4)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab, rng.integers(0, 40)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "The THE the\x0b\x1cÄä  \n the"), (None, "no id"), (3, rows[3][1]), (1003, "the " * 3000)]
    return rows


def test_token_hashes_match_words():
    texts = ["A b  a\tB", "", "  ", "ÄB äb äB", "x\x1cy"]
    h, n = token_hashes(texts)
    words = [w for t in texts for w in WORD.findall(t.translate(LOWER))]
    assert n.tolist() == [len(WORD.findall(t)) for t in texts]
    assert [(a == b) for a in h for b in h] == [(a == b) for a in words for b in words]


@pytest.mark.parametrize("order", [2, 3])
def test_lm_against_brute_force(spark, order):
    rows = some_docs()
    got = lm.score_documents(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA), block_bytes=500, order=order).toPandas()
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tok = [(i, fold(i), WORD.findall((t or "").translate(LOWER)) + [None]) for i, t in rows]
    c, pairs, triples = Counter(), Counter(), Counter()
    for _, held, t in tok:
        if not held:
            c.update(t)
            pairs.update(zip([None] + t[:-1], t))
            triples.update(zip([None] + t[:-2], t[:-1], t[1:]))
    triples = Counter({x: k for x, k in triples.items() if order > 2 and pairs[x[:2]] >= lm.REPEATS})
    n, v = sum(c.values()), len(c)
    ones = lambda x, k: sum(y == k for y in x.values())
    d1, d2 = lm.discount(ones(c, 1), ones(c, 2)), lm.discount(ones(pairs, 1), ones(pairs, 2))
    d3 = lm.discount(ones(triples, 1), ones(triples, 2))
    followers, after = Counter(h for h, _ in pairs), Counter(x[:2] for x in triples)

    def p(h, w):
        """``h``: one word, or a tuple of two."""
        if isinstance(h, tuple):
            shorter = p(h[1], w)
            return (max(triples[(*h, w)] - d3, 0) + d3 * after[h] * shorter) / pairs[h] if after[h] else shorter
        uni = max(c[w] - d1, 0) / n + d1 * v / n / (v + 1)
        return (max(pairs[h, w] - d2, 0) + d2 * followers[h] * uni) / c[h] if c[h] else uni

    def histories(t):
        return [None, *zip([None] + t[:-2], t[:-1])]
    want = sorted((-1 if i is None else i, held, len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6),
                   round(sum(math.log10(p(h, w)) for h, w in zip(histories(t), t)), 6)) for i, held, t in tok)
    have = sorted((-1 if np.isnan(r.doc_id) else int(r.doc_id), bool(r.held_out), r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6), round(r.score, 6)) for r in got.itertuples())
    for a, b in zip(have, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
    # the model is a distribution: what follows a history sums to one over all types and one unseen type
    for h in ("w1", None, ("the", "the"), (None, "w1"), *list(after)[:5]):
        assert sum(p(h, w) for w in c) + p(h, "unseen") == pytest.approx(1)


def test_lm_longer_histories_tell_repeated_texts_apart(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(40)], 30)), "x") for i in range(400)]
    rows += [(1000 + i, rows[i][1], "x") for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    by_order = {}
    for order in (2, 3):
        got = lm.score_documents(docs, block_bytes=4000, order=order).filter("not held_out").toPandas().set_index("doc_id")["score"]
        twice = [i for i in range(20) if i in got.index and 1000 + i in got.index]
        by_order[order] = got[twice].mean() - got[[i for i in got.index if 20 <= i < 400]].mean()
    assert by_order[3] > by_order[2] + 1


def test_lm_scores_do_not_depend_on_the_blocks():
    """Histories whose training texts lie in one block and whose held-out texts lie in others."""
    rng = np.random.default_rng(11)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(3000)], 30)) for _ in range(60)]
    rows = [(t, True) for t in texts for _ in range(2)] + [(t, False) for t in texts]
    shards, hot = 4, np.array([lm.END])

    def exchanged(parts, by):
        out = [{} for _ in parts]
        for s in range(shards):
            for mine, part in zip(out, by([p[s] for p in parts])):
                mine[s] = part
        return out

    def scores(deal):
        blocks = [lm.Block([t for t, _ in b], np.array([train for _, train in b]), shards, hot) for b in deal]
        models = [lm.Model(b, a, shards, 1) for b, a in
                  zip(blocks, exchanged([dict(b.parts(shards)) for b in blocks], lambda parts: lm.answer(parts, 1)))]
        histories = [lm.Histories(b, m.pairs, m.own, shards) for b, m in zip(blocks, models)]
        answers = exchanged([dict(h.parts(shards)) for h in histories], lm.answer_histories)
        return np.concatenate([lm.walk(b, m, h, a, shards)["score"] for b, m, h, a in zip(blocks, models, histories, answers)])

    apart, whole = scores([rows[:60], rows[60:120], rows[120:150], rows[150:]]), scores([rows])
    assert np.isfinite(apart).all()
    assert apart == pytest.approx(whole, rel=1e-9)


def test_lm_empty(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


# --- fingerprints -----------------------------------------------------------------------
def test_parse_is_locally_consistent():
    rng = np.random.default_rng(6)
    middle = "".join(rng.choice(list("abcdefgh "), 3000))
    a, b = FP.sketches(["x" * 7 + middle]), FP.sketches(["Another start, of another length. " + middle + "tail"])
    assert FP.likeness(a, b)[0] > 0.8
    assert FP.likeness(a, FP.sketches(["".join(rng.choice(list("abcdefgh "), 3000))]))[0] < 0.2


def test_phrases_cover_texts_and_stay_short():
    rng = np.random.default_rng(7)
    names = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    doc = np.sort(rng.integers(0, 30, 20_000))
    out, owner = FP.parse_level(names, doc)
    assert set(owner) == set(doc) and 0.2 * 20_000 < len(out) < 0.6 * 20_000
    for d in range(30):      # each text alone gives the same phrases
        assert (FP.parse_level(names[doc == d], doc[doc == d])[0] == out[owner == d]).all()


def test_batches_do_not_change_fingerprints():
    texts = ["", "a", "aaaa", "abcabcabc" * 40, "zzzz" * 500, "Grüße 日本 😀" * 30]
    assert (FP.sketches(texts) == np.vstack([FP.sketches([t]) for t in texts])).all()


def test_compare_with_next(spark):
    rng = np.random.default_rng(8)
    rows = [(i * 3, "".join(rng.choice(list("abcdef \n"), rng.integers(0, 400)))) for i in range(120)]
    rows += [(5000, None), (5001, "äöü😀" * 50), (5002, rows[9][1]), (None, "without id " * 9)]
    got = FP.compare_with_next(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)).toPandas()
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    want = {}
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        k = len(t) // 3
        want[i] = (len(t), hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest(),
                   FP.likeness(FP.sketches([t]), FP.sketches([nxt]))[0])
    have = {(None if np.isnan(r.doc_id) else int(r.doc_id)): (r.n_chars, r.edited_sha256, r.near_next) for r in got.itertuples()}
    assert have == want and len(got) == len(rows)
    f = {int(r.doc_id): r.fingerprint for r in got.itertuples() if not np.isnan(r.doc_id)}
    assert f[5002] == f[27] and f[5001] != f[27]
    assert got[["near_edited", "near_next"]].stack().between(0, 1).all()


def test_compare_small_tables(spark):
    assert FP.compare_with_next(spark.createDataFrame([], SCHEMA)).count() == 0
    one = FP.compare_with_next(spark.createDataFrame([(4, "abc", "")], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"aba").hexdigest() and one[0].near_next == 1.0
    same = FP.compare_with_next(spark.createDataFrame([(4, "abc", ""), (4, "abc", ""), (4, "abd", "")], SCHEMA))
    assert same.count() == 3


# --- token counts --------------------------------------------------------------------------
def brute(ends, bounds, rule):
    out = [0.0] * (len(bounds) - 1)
    start = 0
    for end in ends:
        held = [max(0, min(end, b) - max(start, a)) for a, b in zip(bounds, bounds[1:])]
        touched = [i for i, x in enumerate(held) if x]
        if rule == "share":
            for i in touched:
                out[i] += held[i] / (end - start)
        else:
            out[{"start": touched[0], "end": touched[-1], "majority": held.index(max(held))}[rule]] += 1
        start = end
    return out


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_attribution_against_brute_force(rule):
    rng = np.random.default_rng(9)
    for _ in range(100):
        ends = np.cumsum(rng.integers(1, 6, rng.integers(1, 30)))
        inner = np.sort(rng.integers(0, ends[-1] + 1, rng.integers(0, 8)))
        bounds = np.concatenate([[0], inner, [ends[-1]]])
        assert tokencount.attribute(ends, bounds, rule).tolist() == pytest.approx(brute(ends.tolist(), bounds.tolist(), rule))


def test_lines_add_up_to_the_whole_text(spark):
    rows = [(1, "a line\n\nthird  line\n"), (2, None), (3, ""), (4, "\n"), (5, "ünï " * 4000 + "\nend"), (None, "x\ny"), (1, "a line\n\nthird  line\n")]
    got = tokencount.count_lines(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)).toPandas()
    enc = ByteEncoder()
    assert sorted(got.groupby(["doc_id", "section"], dropna=False).size().loc[1]) == [2, 2, 2]
    for i, t in rows[1:5]:
        mine = got[got["doc_id"] == i]
        assert mine["n_tokens"].sum() == len(enc.ids(t or "")) // 4 == mine["doc_tokens"].iloc[0]
        assert mine["char_end"].max() == len(t or "")
    assert len(got[got["doc_id"] == 1]) == 6


def test_fields(spark):
    got = tokencount.count_fields(spark.createDataFrame([(1, "body text", "title")], SCHEMA), ["score", "text"], "share").collect()
    assert [r.field for r in got] == ["score", "text"] and sum(r.n_tokens for r in got) == pytest.approx(got[0].doc_tokens)
    assert tokencount.count_lines(spark.createDataFrame([], SCHEMA)).count() == 0
