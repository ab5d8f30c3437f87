"""N-gram join and embedding near-duplicates against all pairs, and on edge cases."""

import os
import re
import threading

import numpy as np
import pytest

from jobmart.llm import embed_dedup, ngram_join
from jobmart.llm.common import components
from jobmart.llm.groups import local_roots

SCHEMA = "doc_id long, text string, nodes string"


def roots(pairs, ids):
    at = {i: i for i in ids}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def corpus():
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(60):
        base = list(rng.choice(vocab, rng.integers(3, 200)))
        for _ in range(rng.integers(1, 5)):
            t = list(base)
            for _ in range(rng.integers(0, 4)):
                t[rng.integers(len(t))] = "edit" + str(rng.integers(99))
            rows.append((i, " ".join(t)))
            i += 1
    hot = list(rng.choice(vocab, 300))
    for k in range(150):                      # a large group of near copies, another of exact ones
        t = list(hot)
        t[k] = f"only{k}"
        rows.append((i + k, " ".join(t)))
    rows += [(2000 + k, "the very same text here again and again") for k in range(80)]
    passage = " ".join(rng.choice(vocab, 60))
    rows += [(3000 + k, passage + " " + " ".join(rng.choice(vocab, 120))) for k in range(40)]
    rows += [(4000, ""), (4001, None), (4002, "  \n"), (4003, "two words"), (4004, "TWO  words"), (None, "two words")]
    return rows


@pytest.mark.parametrize("block", [512, 32])
def test_join_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = corpus()
    got = ngram_join.jaccard_join(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)).toPandas()
    ids = [(-10**18 if i is None else i) for i, _ in rows]
    sets = [shingles(t or "") for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    links = np.zeros(len(rows), int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    comp = roots([(ids[a], ids[b]) for a, b in pairs], ids)
    have = {(-10**18 if np.isnan(r.doc_id) else int(r.doc_id)): r for r in got.itertuples()}
    assert len(have) == len(rows)
    for i, n in zip(ids, links):
        assert have[i].n_links == n, i
        if comp[i] >= 0:
            assert have[i].component_id == comp[i]
        assert have[i].kept == (comp[i] == i)
    kept = ngram_join.one_of_each(spark.createDataFrame([(i, t, "x") for i, t in rows] + [(2000, rows[-90][1], "x")], SCHEMA))
    assert kept.columns == ["doc_id", "text", "nodes"]


def test_prefixes_are_shortened_until_the_target():
    assert ngram_join.depth_for(0.8) == 3 and ngram_join.depth_for(0.99) == 4
    assert ngram_join.depth_for(0.8, trees=2, target=0.999) == 1


def test_join_empty_table(spark):
    assert ngram_join.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_local_roots():
    m = np.zeros((5, 5), bool)
    for a, b in ((0, 3), (3, 4)):
        m[a, b] = m[b, a] = True
    assert local_roots(m, np.array([9, 2, 3, 4, 1])).tolist() == [1, 2, 3, 1, 1]


# --- embeddings ---------------------------------------------------------------------------
EMB = "vec_id long, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for _ in range(150):
        v = rng.normal(size=16)
        for _ in range(rng.integers(1, 4)):
            rows.append((i, [float(np.float32(x)) for x in v + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.3])]))
            i += 1
    hot = rng.normal(size=16)
    rows += [(i + k, [float(np.float32(x)) for x in hot + rng.normal(size=16) * 0.05]) for k in range(200)]
    rows += [(2000 + k, [1.0] * 16) for k in range(70)] + [(2100, [3.0] * 16)]
    bad = [(3000, None), (3001, [0.0] * 16), (3002, [1.0] * 15 + [None]), (3003, [float("nan")] + [1.0] * 15), (3004, [float("inf")] + [1.0] * 15),
           (3005, []), (3006, [1.0, 2.0]), (None, [5.0] * 16)]
    return rows, bad


@pytest.mark.parametrize("block", [1024, 64])
def test_links_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rows, bad = vectors()
    got = embed_dedup.near_dedup(spark.createDataFrame([(i, v, 1) for i, v in rows + bad], EMB)).toPandas()
    sound = rows + [bad[-1]]
    ids = [(-10**18 if i is None else i) for i, _ in sound]
    x = np.array([v for _, v in sound], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b]
    comp = roots(pairs, ids)
    have = {(-10**18 if np.isnan(r.vec_id) else int(r.vec_id)): r for r in got.itertuples()}
    assert len(got) == len(rows) + len(bad)
    found = sum(have[i].n_links for i in ids)
    assert 0.99 * near.sum() <= found <= near.sum()
    wrong = [i for i, n in zip(ids, near.sum(1)) if have[i].n_links > n]
    assert not wrong
    assert np.mean([have[i].component_id == comp[i] for i in ids if comp[i] >= 0]) > 0.99
    for i, _ in bad[:-1]:
        assert have[i].n_links == 0 and have[i].component_id == i and have[i].kept


def test_visits_are_the_nearest_cells():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 8))
    index = embed_dedup.MultiIndex(rng.normal(size=(7, 4)), rng.normal(size=(6, 4)))
    d = ((x[:, None, :4] - index.first) ** 2).sum(2)[:, :, None] + ((x[:, None, 4:] - index.second) ** 2).sum(2)[:, None, :]
    want = np.argsort(d.reshape(50, -1), 1)
    for n in (1, 5, 42):
        assert (index.visits(x, n) == want[:, :n]).all()


def test_embeddings_empty_and_all_bad(spark):
    assert embed_dedup.near_dedup(spark.createDataFrame([], EMB)).count() == 0
    assert embed_dedup.near_dedup(spark.createDataFrame([(1, None, 0), (2, [0.0], 0)], EMB)).filter("kept").count() == 2


def turn(x, towards, cosine):
    side = towards - (towards * x).sum(1, keepdims=True) * x
    return cosine * x + (1 - cosine ** 2) ** 0.5 * side / np.linalg.norm(side, axis=1, keepdims=True)


@pytest.mark.parametrize("pairs, others, hot", [(2000, 0, 0), (300, 6000, 0), (1500, 0, 1500)])
def test_lone_pairs_are_found_with_large_codebooks(spark, monkeypatch, pairs, others, hot):
    monkeypatch.setattr(embed_dedup, "PER_CELL", 0.5)     # codebooks as large as those of a table 96 times as long
    rng = np.random.default_rng(6)
    x = embed_dedup.unit(rng.normal(size=(pairs, 64)))
    y = turn(x, rng.normal(size=x.shape), 0.901)
    rest = rng.normal(size=(others, 64))
    group = turn(np.repeat(x[:1], hot, 0), rng.normal(size=(hot, 64)), 0.995)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.vstack([x, y, rest, group]))]
    got = {r.vec_id: r.n_links for r in embed_dedup.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert np.mean([got[i] > 0 for i in range(1, pairs)]) >= 0.997
    assert len(got) == len(rows) and not any(got[i] for i in range(2 * pairs, 2 * pairs + others))


def test_vectors_of_several_dimensions(spark):
    """Every dimension links within itself, exactly as all pairs say."""
    rng = np.random.default_rng(8)
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [2.0, 4.0, 6.0]), (4, [1.0]), (5, [-2.0]), (6, [4.0]), (7, [1.0, 0.0, 0.0, 0.0, 0.0])]
    for d, first in ((2, 100), (5, 200), (8, 300)):
        base = rng.normal(size=(15, d))
        rows += [(first + k, (base[k % 15] + rng.normal(size=d) * 0.2).tolist()) for k in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    pairs = []
    for (a, x), (b, y) in ((p, q) for k, p in enumerate(rows) for q in rows[:k] if len(p[1]) == len(q[1])):
        x, y = np.array(x), np.array(y)
        if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
            pairs.append((a, b))
    comp = roots(pairs, [i for i, _ in rows])
    got = {r.vec_id: r for r in embed_dedup.near_dedup(spark.createDataFrame([(i, v, 0) for i, v in rows], EMB)).collect()}
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got.values()) / 2
    assert found >= 0.99 * len(pairs) and found <= len(pairs)
    assert [got[i].n_links for i in (1, 2, 3, 4, 5, 6, 7)] == [2, 2, 2, 1, 0, 1, 0]
    if found == len(pairs):
        assert {i: r.component_id for i, r in got.items()} == comp


def test_disk_holds_a_few_copies_of_the_vectors(spark, monkeypatch):
    """Shuffle files of the passes do not pile up: at no time do they take more than some copies of the vectors."""
    monkeypatch.setattr(embed_dedup, "PASS_BYTES", 1, raising=False)      # as if the table were large: one copy a pass
    n, d = 8000, 64
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[1::100] = turn(embed_dedup.unit(x[::100]), rng.normal(size=x[::100].shape), 0.95)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], EMB).repartition(4)
    folders = [f.getPath() for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def held():
        total = 0
        for top in folders:
            for at, _, names in os.walk(top):
                for name in names:
                    if name.startswith("shuffle_"):
                        try:
                            total += os.path.getsize(os.path.join(at, name))
                        except FileNotFoundError:
                            pass
        return total

    before, seen, over = held(), [], threading.Event()

    def watch():
        while not over.wait(0.05):
            seen.append(held())

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        got = {r.vec_id: r.n_links for r in embed_dedup.near_dedup(df).collect()}
    finally:
        over.set()
        watching.join()
    assert len(got) == n and sum(got.values()) == 2 * len(x[::100])
    assert max(seen) - before < 12 * x.nbytes


@pytest.mark.parametrize("block", [4096, 200])
def test_large_group_counts_each_pair_once(spark, monkeypatch, block):
    """A group that fills cells in every table, in passes that take shares of the cells."""
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    monkeypatch.setattr(embed_dedup, "PER_CELL", 8)
    monkeypatch.setattr(embed_dedup, "PASS_BYTES", 1, raising=False)
    rng = np.random.default_rng(12)
    centre = embed_dedup.unit(rng.normal(size=(1, 24)))
    x = np.vstack([turn(np.repeat(centre, 700, 0), rng.normal(size=(700, 24)), c) for c in (0.99, 0.955)] + [rng.normal(size=(600, 24))])
    near = embed_dedup.unit(x) @ embed_dedup.unit(x).T >= 0.9
    np.fill_diagonal(near, False)
    comp = roots(list(zip(*np.nonzero(near))), range(len(x)))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_dedup(df).collect()}
    links = np.array([got[i].n_links for i in range(len(x))])
    assert len(got) == len(x) and (links <= near.sum(1)).all() and links.sum() >= 0.998 * near.sum()
    assert np.mean([got[i].component_id == comp[i] for i in range(len(x))]) > 0.998


def test_zeros_of_either_sign_are_equal(spark):
    rows = [(1, [0.0, 1.0, 2.0]), (2, [-0.0, 1.0, 2.0]), (3, [1.0, -0.0, 0.0]), (4, [1.0, 0.0, -0.0]), (5, [-0.0, 0.0, 0.0])]
    for kind in ("float", "double"):
        got = embed_dedup.near_dedup(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
            (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)]


def test_one_of_each_knows_rows_not_ids(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, "a"), (1, "an unlike text that shares only the id of the other", "b"), (2, words, "c"), (None, words + " end", "d"),
            (None, None, "e"), (None, "", "f"), (3, "", "g"), (3, "", "h"), (5, words, "i"), (4, "two words", "j"), (4, "two words", "k")]
    schema = "doc_id long, text string, _node string, join_row string"
    df = spark.createDataFrame([(i, t, n, "x") for i, t, n in rows], schema).repartition(3)
    kept = ngram_join.one_of_each(df).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "_node", "join_row"}
    names = sorted(r._node for r in kept)
    # the copies leave one row with the smallest id, texts without words stay, "two words" leaves one
    assert names[0] == "a" and set("befgh") <= set(names) and len(set("jk") & set(names)) == 1 and not set("cdi") & set(names)
    assert ngram_join.one_of_each(df.limit(0)).count() == 0
