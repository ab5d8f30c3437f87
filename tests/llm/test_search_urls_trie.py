"""Lexical search, URL filters and the conversation trie against plain recomputation and on edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobmart.llm import convtrie, lexsearch, urlfilter

DOCS = "doc_id long, text string, score string, item_id long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- lexical search --------------------------------------------------------------
def ranked(docs, items, k=10):
    """{item row: [(rank, doc_id, score)]} by scoring every document."""
    terms = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n = [sum(c.values()) for c in terms]
    count, words = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), c, size in zip(docs, terms, n):
            s = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    s += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (100 - 75 + (75 * size * count) // words)))
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **opts):
    got = lexsearch.search(spark.createDataFrame([(i, t, "x", 7) for i, t in docs], DOCS).repartition(3),
                           spark.createDataFrame([(i, t, 1, "y") for i, t in items], "item_id long, text string, doc_id long, rank string"), **opts)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in got.collect()], key=str)


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本", "the", "THE", "of"]
    weights = [1 / (1 + i % 300) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)]                     # ties: many equal texts
    docs += [(2000, None), (2001, ""), (2002, "... !?"), (None, docs[5][1]), (None, docs[7][1]), (5, docs[5][1]),
             (2003, "w1 " * 60_000 + "w299"), (2004, "É" * 2000)]
    return docs


def queries():
    return [(0, "w1 w2 w3 the of"), (1, "w299 w250, w250; Été"), (2, None), (3, ""), (4, "never seen anywhere"), (None, "naïve THE"),
            (5, corpus()[5][1]), (5, "日本 w7"), (6, "w1 " * 30)]


@pytest.mark.parametrize("owners", [1, 4])
def test_search_equals_scoring_every_document(spark, monkeypatch, owners):
    monkeypatch.setattr(lexsearch, "SHARD_DOCS", 64)
    assert found(spark, corpus(), queries(), owners=owners) == ranked(corpus(), queries())


def test_search_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexsearch, "BLOCK_ITEMS", 3)
    assert found(spark, corpus(n=60), queries(), k=3) == ranked(corpus(n=60), queries(), 3)


def test_search_of_nothing(spark):
    assert found(spark, [], queries()) == found(spark, corpus(), []) == found(spark, [(1, None), (2, "-")], queries()) == []


def test_pruning_leaves_out_only_what_cannot_win(spark):
    """After the rare terms, accumulators that the common ones cannot lift are gone; all answers stay."""
    rng = random.Random(1)
    docs = [(i, "common " * rng.randint(1, 3) + ("rare" if i % 40 == 0 else f"x{i}")) for i in range(800)]
    terms = [np.unique(lexsearch.term_hashes(["rare common"])[0], return_counts=True)]
    names = np.unique(np.concatenate([t for t, _ in terms]))
    df = np.array([20 if n == lexsearch.term_hashes(["rare"])[0][0] else 800 for n in names])
    weights = np.array([lexsearch.weight(int(d), 800) for d in df])
    assert weights[df == 800] == 0 or weights[df == 20] > 10 * weights[df == 800]
    owner = lexsearch.owners_of(df, weights, 2)
    assert owner[df == 20] < owner[df == 800]
    assert found(spark, docs, [(0, "rare common")]) == ranked(docs, [(0, "rare common")])


# --- URL filters -------------------------------------------------------------------
def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (m.group(1).translate(LOWER), m.group(2)) if m else ("", "")


def plain_grams(text, field):
    """Buckets of all n-grams by plain integers."""
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31
    raw = b"\x02" + text.encode() + b"\x03"
    return [mix(sum(mix(int(urlfilter._LETTER[raw[i + j]]) * int(urlfilter._PLACE[j]) & mask) for j in range(n)) + 8 * field + n & mask)
            % urlfilter.BUCKETS for n in urlfilter.SIZES for i in range(len(raw) - n + 1)]


@pytest.fixture(scope="module")
def model():
    rows = urlfilter.labelled_urls()
    parts = [split(u) for u, _ in rows]
    return urlfilter.fit([h for h, _ in parts], [p for _, p in parts], np.array([y for _, y in rows], float))


URLS = ["http://casino-slots.example.org/en/5", "https://blog.thering.example.org/de/77.html", None, "", "no scheme", "://", "http://", "HTTP://A.B",
        "http://WWW.Example.COM/en/x?y#z", "http://example.com/en/1", "http://x.example.com/en/", "http://example.com", "http://example.com/",
        "https://deep.www.example.com/en/1", "http://a.net/es/5", "http://a.net/ES/5", "http://net/fr/", "http://notnet/fr/", "http://a.net:80/fr/1",
        "ftp://u@h.com/p", "http://é.org/ü?q", "http://com/a", "x http://two.net/es/ http://three", "http://xn.net#/es/", "http://a.net/es",
        "http://long.org/" + "a/" * 300_000, "http://net/es/x", "http://a.net/es/5", "http://line.net/es/\nnext"]
SCHEMA = "page_id long, url string, host string, verdict string, _ int"


def test_hosts_paths_rules(spark, model):
    rows = [(i, u, "h", "v", 1) for i, u in enumerate(URLS)]
    got = {r.page_id: r for r in urlfilter.judge(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert len(got) == len(URLS)

    def rule(host, path):
        fits = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.host + r.path), default=None)
    for i, u in enumerate(URLS):
        host, path = split(u)
        want = rule(host, path)
        assert (got[i].host, got[i].path) == (host, path), u
        assert got[i].rule == (want.host + want.path if want else None), u
        assert got[i].verdict == (want.verdict if want else "block" if got[i].p_block >= 0.5 else "allow"), u
    assert got[2].verdict == "allow" and got[0].verdict == "block" and got[1].verdict == "allow"
    assert [got[i].rule for i in (8, 9, 10, 13)] == ["www.example.com/en/", "example.com/en/", "example.com/en/", "www.example.com/en/"]
    assert urlfilter.judge(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_grams_and_logits_by_plain_arithmetic(model):
    urls = [u for u in URLS if u is None or len(u) < 200]
    parts = [split(u) for u in urls]
    z = model.logits([h for h, _ in parts], [p for _, p in parts])
    for (host, path), have in zip(parts, z):
        want = model.bias
        for field, text in enumerate((host, path)):
            at = plain_grams(text, field)
            want += sum(model.weights[a] for a in at) / max(1, len(at)) ** 0.5
        assert have == pytest.approx(want, abs=1e-9)


def test_fit_is_the_minimum(model):
    """The gradient of the penalised loss vanishes at the fitted weights, but for the tolerance of the descent."""
    rows = urlfilter.labelled_urls()
    parts = [split(u) for u, _ in rows]
    y = np.array([b for _, b in rows], float)
    of, at, value = urlfilter.features([h for h, _ in parts], [p for _, p in parts])
    z = np.bincount(of, model.weights[at] * value, minlength=len(y)) + model.bias
    g = 1 / (1 + np.exp(-z)) - y
    grad = np.bincount(at, g[of] * value, minlength=urlfilter.BUCKETS) + urlfilter.PENALTY * model.weights
    assert abs(grad).max() < 1e-4 * len(y) and abs(g.sum()) < 1e-3 * len(y)


def test_held_out_urls(spark, model):
    rows = urlfilter.labelled_urls(2000, seed=77)
    parts = [split(u) for u, _ in rows]
    wrong = (model.logits([h for h, _ in parts], [p for _, p in parts]) > 0) != np.array([y > 0 for _, y in rows])
    assert wrong.mean() < 0.02
    # words the table does not hold
    known = [split(u) for u in ("https://winter.example.org/en/5", "http://www.diabetes-help.org/articles/3", "https://www.richmondtimes.com/news",
                                "http://m.therou.example.org/en/9")]
    assert (model.logits([h for h, _ in known], [p for _, p in known]) < 0).all()


def test_training_table_edges(spark):
    schema = "url string, block int, host string"
    assert urlfilter.train(spark.createDataFrame([], schema)).logits(["a.com"], ["/"])[0] < 0
    assert urlfilter.train(spark.createDataFrame([("http://a.com", 1, "x"), (None, None, "x")], schema)).logits(["a.com"], ["/"])[0] > 0
    m = urlfilter.train(spark.createDataFrame([(f"http://good{i}.com/", 0, "x") for i in range(20)] + [(None, 0, "x")]
                                              + [(f"http://evil{i}.com/", 1, "x") for i in range(20)] * 2, schema))
    assert m.logits(["good77.com", "evil77.com"], ["/", "/"])[0] < 0 < m.logits(["evil77.com"], ["/"])[0]


# --- conversation trie ----------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, n0 string, depth int"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows):
    """All nodes by sets of whole sequences."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].add(c)
    kids = Counter(n[:-1] for n in members if n)
    out = {n: [0, 0] for n in members}
    for n, m in members.items():
        saved = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            out[n[:d]][0] += not kids[n]
            out[n[:d]][1] += saved
    ends = defaultdict(list)
    for c in sorted(seqs):
        ends[seqs[c]].append(str(c))
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], *out[n],
                   hashlib.sha256(",".join(ends[n]).encode()).hexdigest()) for n, m in members.items())


def built(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(parts)
    got = convtrie.prefix_trie(df)
    assert got.columns == NODE
    return sorted(tuple(r) for r in got.collect())


def conversations(seed=2, n=260):
    rng = random.Random(seed)
    texts = ["hello there", "how are you", "fine", "", "a b  c\td", "x" * 50, "please go on", "ok ok ok"]
    rows = []
    for c in rng.sample(range(-40, 4000), n):
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 9])):
            rows.append((c, t, rng.choice(["user", "user", "assistant"]) if rng.random() < 0.3 else "user", rng.choice(texts[:2] if t < 2 else texts)))
    for c in range(5000, 5400):                                  # a group of copies, another that parts late
        rows += [(c, t, "user", f"same {t}") for t in range(5 if c % 2 else 7)]
    rows += [(6000, t, "assistant", f"long {t // 2}") for t in range(90)] + [(6001, t, "assistant", f"long {t // 2}") for t in range(80)]
    rows += [(6100, None, None, None), (6100, None, "a", "b"), (6100, 3, "z", None), (6100, 3, "z", None), (6100, 3, "a", "q"),
             (None, 1, "user", "nobody's"), (6200, 0, "", "only one"), (6207, 0, "user", "x"), (6207, 1, "user", "x" * 1_000_000 + " tail")]
    return rows


@pytest.mark.parametrize("leaves", [50_000, 12])
def test_trie_equals_whole_sequences(spark, monkeypatch, leaves):
    monkeypatch.setattr(convtrie, "LEAVES", leaves)
    rows = conversations()
    assert built(spark, rows) == trie(rows)


@pytest.mark.parametrize("rows", [
    [], [(None, 1, "user", "x")], [(7, 1, "user", "one")], [(20, 1, "user", "one"), (20, 1, "user", "one")],
    [(c, 1, "user", "one two") for c in range(40, 60)], [(c, None, None, None) for c in range(60)]])
def test_small_tries(spark, rows):
    assert built(spark, rows) == trie(rows)


def test_long_conversations_in_many_tasks(spark):
    """Copies of one conversation that is dealt over all partitions: a chain whose savings add up from the end."""
    n, none = 3000, hashlib.sha256(b"").hexdigest()
    words = [1 + t % 3 for t in range(n)]
    rows = [(c, t, "user", " ".join([f"turn{t}"] * words[t])) for c in (40, 60, 80) for t in range(n)]
    left = [sum(words)]
    for w in words:
        left.append(left[-1] - w)
    ends = hashlib.sha256(b"40,60,80").hexdigest()
    assert built(spark, rows) == [(40, d, 40 if d else None, 3, int(d < n), 1, 2 * left[max(d - 1, 0)], ends if d == n else none)
                                  for d in range(n + 1)]


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "ENDS", 3)
    rows = [(c, 0, "user", "equal") for c in range(0, 2000, 20)]
    assert built(spark, rows) == trie(rows)


def test_parentheses():
    rng = random.Random(5)
    for shape in (0.5, 0.9, 0.1):
        opens, depth = [True], 1
        while depth and len(opens) < 5000:
            up = rng.random() < shape
            opens.append(up)
            depth += 1 if up else -1
        opens += [False] * depth
        trie_ = convtrie.Parentheses(np.array(opens))
        at, stack, close = [i for i, o in enumerate(opens) if o], [], {}
        for i, o in enumerate(opens):
            if o:
                stack.append(i)
            else:
                close[stack.pop()] = i
        got = trie_.findclose(np.array(at))
        assert got.tolist() == [close[i] for i in at]
        leaves = [sum(opens[j] and not opens[j + 1] for j in range(i, close[i])) for i in at[:200]]
        assert trie_.leaves_in(np.array(at[:200]), got[:200]).tolist() == leaves


def test_sums_of_a_conversation_in_many_tasks():
    """Totals of the parts, put together, equal one running sum."""
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, (50, 2), dtype=np.uint64)
    whole = [sum(int(k) * pow(int(b), i + 1, 2**64) for i, k in enumerate(keys[:, j])) % 2**64 for j, b in enumerate(convtrie._BASES)]
    from pyspark.sql import Row
    edges = []
    for part, (lo, hi) in enumerate([(0, 20), (20, 21), (21, 50)]):
        q = [sum(int(k) * pow(int(b), i + 1, 2**64) for i, k in enumerate(keys[lo:hi, j])) % 2**64 for j, b in enumerate(convtrie._BASES)]
        edges.append(Row(part=part, conv_id=9, pos=hi - lo, q0=q[0] - 2**64 if q[0] >= 2**63 else q[0], q1=q[1] - 2**64 if q[1] >= 2**63 else q[1], total=hi - lo))
    edges.append(Row(part=3, conv_id=9, pos=0, q0=0, q1=0, total=0))
    pos, q0, q1, total = convtrie._carries(edges)[(3, 9)]
    assert (pos, total) == (50, 50) and [q0 % 2**64, q1 % 2**64] == whole
    assert convtrie.powers(0, np.array([0, 5, -5])).tolist() == [1, pow(int(convtrie._BASES[0]), 5, 2**64), pow(int(convtrie._BASES[0]), -5, 2**64)]
