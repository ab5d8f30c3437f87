"""Packing and mixing against plain recomputation and on edge cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import mixing, packing
from jobmart.llm.common import ByteEncoder, default_tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


def ids_of(text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_tokenizer_path())
    return tok.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("text", [
    "", " ", "a", "don't we'll  two\n\n  spaces\t\ttabs ", "ñandú über façade", "日本語のテキスト 12 ³½", "x<|endoftext|>y", "\r\n\x0b\x0c\x85\xa0z",
    "emoji 😀😀 é", "a" * 3000, "1234567890 " * 50])
def test_encoder_equals_the_library(text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_tokenizer_path())
    assert np.frombuffer(ByteEncoder().ids(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(4, 4) == [(0, 4)]


def test_pieces_are_whole_gapless_and_few(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["word"] * int(n)), "a") for i, n in enumerate(rng.integers(0, 60, 300))]
    rows += [(1000, None, None), (1001, "", "b"), (1002, "x " * 500, "b"), (None, "no id", "b"), (5, rows[5][1], "a")]
    got = packing.pack_documents(docs_df(spark, rows).withColumn("sequence_id", F.lit("clash")),
                                 capacity=64, block=100).toPandas()
    want = defaultdict(list)
    for i, t, _ in rows:
        ids = ids_of(t)
        for piece, (start, length) in enumerate(packing.cut(len(ids), 64)):
            crc = zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            want[i].append((piece, start, length, crc))
    have = defaultdict(list)
    for r in got.itertuples():
        have[None if np.isnan(r.doc_id) else int(r.doc_id)].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all() and s["length"].sum() <= 64
    bound = -(-got["length"].sum() // 64)
    assert bound <= got["sequence_id"].nunique() <= 1.08 * bound
    again = packing.pack_documents(docs_df(spark, rows), capacity=64, block=100).toPandas()
    cols = ["doc_id", "piece", "sequence_id", "offset"]
    assert (got[cols].sort_values(cols).reset_index(drop=True).fillna(-1)
            .equals(again[cols].sort_values(cols).reset_index(drop=True).fillna(-1)))


def test_packing_empty_table(spark):
    assert packing.pack_documents(docs_df(spark, [])).count() == 0


def test_refit_fills_open_bins_before_it_opens_others():
    p = packing.Problem(np.array([60, 60, 30, 30], np.int64), 100)
    got = p.refit(np.array([0, 1, -1, -1]), np.array([2, 3]), np.random.default_rng(0))
    assert sorted(got[2:].tolist()) == [0, 1] and got[:2].tolist() == [0, 1]
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = np.sort(rng.integers(1, 100, 60))[::-1].astype(np.int64)
        p = packing.Problem(lengths, 100)
        bins = p.best_fit(np.full(60, -1), np.arange(60))
        gone = np.isin(bins, rng.choice(bins.max() + 1, 6, replace=False))
        kept = np.full(60, -1)
        kept[~gone] = np.unique(bins[~gone], return_inverse=True)[1]
        got = p.refit(kept, np.flatnonzero(gone), rng)
        fill = np.bincount(got, weights=lengths)
        assert (got >= 0).all() and fill.max() <= 100 and (fill > 0).all() and (got[~gone] == kept[~gone]).all()
        opened = np.arange(len(fill)) > kept.max()
        # a piece opens a bin only if no bin that was there holds it
        for b in np.flatnonzero(opened):
            assert lengths[got == b].max() > 100 - fill[~opened].min()


def test_crossover_keeps_every_piece_in_a_bin_with_room():
    rng = np.random.default_rng(3)
    p = packing.Problem(np.sort(rng.integers(1, 100, 200))[::-1].astype(np.int64), 100)
    none, all_ = np.full(200, -1), np.arange(200)
    a, b = p.best_fit(none, all_), p.best_fit(none, all_, rng)
    for _ in range(20):
        child = p.crossover(a, b, rng)
        assert child.min() >= 0 and p.loads(child).max() <= 100 and (np.bincount(child) > 0).all()
        a, b = b, p.mutate(child, rng)
    best = packing.evolve(p, [a, b], rng, generations=10)[0]
    assert p.fitness(best) >= max(p.fitness(a), p.fitness(b))


# --- mixing ---------------------------------------------------------------------------
def test_share_targets_caps_and_reshares():
    t = mixing.share_targets(np.array([10, 100, 100]), np.array([1.0, 2.0, 3.0]), 210, 3)
    assert t[0] == 30 and t.sum() == pytest.approx(210) and t[1] / t[2] == pytest.approx(2 / 3)
    assert mixing.share_targets(np.array([0, 5]), np.array([1.0, 2.0]), 5, 3).tolist() == [0, 5]


def test_fit_counts_against_all_subsets():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = np.unique(rng.integers(1, 12, 4))
        counts = rng.integers(1, 4, len(sizes))
        budget = int(rng.integers(0, (sizes * counts).sum() + 1))
        m = mixing.fit_counts(sizes, counts, budget)
        assert (m >= 0).all() and (m <= counts).all()
        assert (m * sizes).sum() <= budget
        sums = {0}
        floor = counts * budget // int((sizes * counts).sum())
        for s, c, f in zip(sizes, counts, floor):
            sums = {x + s * k for x in sums for k in range(f, c + 1)}
        assert budget - (m * sizes).sum() == min(budget - x for x in sums if x <= budget)


def test_fit_counts_beyond_the_limit():
    m = mixing.fit_counts(np.array([3, 50_000, 90_000]), np.array([10, 9, 9]), 700_000, dp_limit=1000)
    assert (m * np.array([3, 50_000, 90_000])).sum() <= 700_000 and (m <= [10, 9, 9]).all()


def test_mix_hits_targets_and_is_repeatable(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(n)), f"s{i % 4}") for i, n in enumerate(rng.integers(1, 40, 800))]
    rows += [(i, "one size fits all", "s1") for i in range(800, 1800)]              # a hot size
    rows += [(1800, None, "s0"), (1801, "", None), (1802, "null source words", None), (None, "no id here", "s2"), (7, rows[7][1], "s3")]
    df = docs_df(spark, rows)
    got = mixing.mix_sources(df).toPandas()
    assert len(got) == len(rows)
    assert (got["taken"] <= 3 * got["size"]).all() and set(got["copies"]) <= {0, 1, 2, 3}
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    got["source"] = [str(source[None if np.isnan(i) else int(i), n]) for i, n in zip(got["doc_id"], got["size"])]
    by = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by["taken"] - by["target"]) <= 40).all()
    assert by["target"].sum() == pytest.approx(got["size"].sum())
    again = mixing.mix_sources(df.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert (got[key].fillna(-1).sort_values(key).reset_index(drop=True)
            .equals(again[key].fillna(-1).sort_values(key).reset_index(drop=True)))
    mixed = mixing.apply_mix(df)
    assert mixed.columns == df.columns and mixed.count() == got["copies"].sum()


def test_mix_empty(spark):
    assert mixing.mix_sources(docs_df(spark, [])).count() == 0


def test_mixed_rows_keep_columns_named_like_helpers(spark):
    schema = "doc_id long, text string, source string, _h string, _n int, mix_h string, mix_copies int"
    rows = [(i, "a b c " * (1 + i % 5), "s", f"h{i}", i, f"m{i}", -i) for i in range(40)] + [(None, None, None, None, None, None, None)] * 2
    got = mixing.apply_mix(spark.createDataFrame(rows, schema))
    assert got.columns == [c.split()[0] for c in schema.split(", ")]
    for r in got.collect():
        assert r.doc_id is None or (r._h, r._n, r.mix_h, r.mix_copies) == (f"h{r.doc_id}", r.doc_id, f"m{r.doc_id}", -r.doc_id)
