"""URL filters: explicit rules first, a trained model for every URL that no rule fits.

The model is a logistic regression over hashed character n-grams of host and path.  Host and
path are marked at both ends and cut into all their byte n-grams of ``SIZES`` bytes; each is hashed, with
its field, into one of ``BUCKETS`` buckets and counts one over the square root of its field's number of n-grams, so
that long paths weigh no more than short ones.  The weights are fitted by L-BFGS in one task on at
most ``SAMPLE`` labelled URLs (those with the smallest hash); ``labelled_urls`` makes the small
table that the registered query trains on.  A rule fits its host and all hosts below it if the path starts with the rule's
path; of the rules that fit, the longest decides (of equally long ones that with the longer host).

Defined results: the host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; the path goes on from there to ``?``, ``#`` or the end.  A URL that is null or
has no ``://`` has neither: no rule fits it and the model's intercept decides.  Repeated rows are judged
alike; an empty table gives no rows; URLs of any length are read whole; other columns are ignored.
Without labelled rows of both kinds the model calls every URL by the kind it knows, or allows it.
"""

from __future__ import annotations

import pickle
import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import mix64
from .toxicity import _lbfgs

SIZES = (3, 4, 5)
BUCKETS = 1 << 18
SAMPLE = 20_000
PENALTY = 0.02
CHUNK = 4_000_000        # characters whose n-grams are held at a time; a longer URL stands alone

_LETTER = np.random.default_rng(12).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(13).integers(0, 2**63, max(SIZES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


# fixed values: the rules of the registered query
RULES = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block")]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(texts: list[str], field: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram, and each text's number of n-grams."""
    raw = [b"\x02" + t.encode("utf-8", "surrogatepass") + b"\x03" for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    letters = _LETTER[np.frombuffer(b"".join(raw), np.uint8)]
    rest = np.repeat(np.cumsum(size), size) - np.arange(size.sum())        # bytes from here to the text's end
    of = np.repeat(np.arange(len(raw)), size)
    held, at, value = [], [], np.zeros(len(letters), np.uint64)
    for n in range(1, min(max(SIZES), len(letters)) + 1):
        value[:len(letters) - n + 1] += mix64(letters[n - 1:] * _PLACE[n - 1])
        if n in SIZES:
            whole = np.flatnonzero(rest >= n)
            at.append(mix64(value[whole] + np.uint64(8 * field + n)) & np.uint64(BUCKETS - 1))
            held.append(of[whole])
    held, at = np.concatenate([*held, of[:0]]), np.concatenate([*at, np.zeros(0, np.uint64)]).astype(np.int64)
    return held, at, np.bincount(held, minlength=len(raw))


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(url, bucket, value) of all n-grams of hosts and paths."""
    parts = []
    for field, texts in enumerate((hosts, paths)):
        of, at, count = grams(texts, field)
        parts.append((of, at, 1 / np.sqrt(count)[of] if len(of) else np.zeros(0)))
    return tuple(np.concatenate(x) for x in zip(*parts))


class Model(NamedTuple):
    weights: np.ndarray       # one per bucket
    bias: float

    def logits(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        out = np.zeros(len(hosts))
        for lo, hi in _chunks([len(h) + len(p) for h, p in zip(hosts, paths)]):
            of, at, value = features(hosts[lo:hi], paths[lo:hi])
            out[lo:hi] = np.bincount(of, self.weights[at] * value, minlength=hi - lo)
        return out + self.bias


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    lo = held = 0
    for i, s in enumerate(sizes):
        if i > lo and held + s > CHUNK:
            yield lo, i
            lo, held = i, 0
        held += s
    if lo < len(sizes):
        yield lo, len(sizes)


def fit(hosts: list[str], paths: list[str], y: np.ndarray, steps: int = 100) -> Model:
    """Regularised logistic regression; ``y`` is 1 for URLs to block."""
    weights = np.zeros(BUCKETS)
    n, n1 = len(y), float(y.sum())
    if n1 in (0, n):
        return Model(weights, 7.0 if n and n1 else -7.0)
    of, at, value = features(hosts, paths)
    used, at = np.unique(at, return_inverse=True)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(of, theta[:-1][at] * value, minlength=n) + theta[-1]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.bincount(at, g[of] * value, minlength=len(used)) + PENALTY * theta[:-1]
        return (float((np.logaddexp(0, z) - y * z).sum() + 0.5 * PENALTY * theta[:-1] @ theta[:-1]), np.r_[grad, g.sum()])

    theta = _lbfgs(loss, np.r_[np.zeros(len(used)), np.log(n1 / (n - n1))], steps)
    weights[used] = theta[:-1]
    return Model(weights, float(theta[-1]))


def train(labelled: DataFrame, sample: int = SAMPLE, url: str = "url", label: str = "block") -> Model:
    """The model of a labelled table, fitted in one task on at most ``sample`` of its URLs; of
    repeated URLs the largest label counts, rows without one are left out."""
    rows = (labelled.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(label).cast("int").alias("y"))
            .filter("y is not null").groupBy("host", "path").agg(F.max("y").alias("y"))
            .orderBy(F.xxhash64("host", "path"), "host", "path").limit(sample))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["host", "path"])
        m = fit(pdf["host"].tolist(), pdf["path"].tolist(), pdf["y"].to_numpy(np.float64))
        used = np.flatnonzero(m.weights)
        return pd.DataFrame({"model": [pickle.dumps((used, m.weights[used], m.bias))]})
    got = rows.groupBy(F.lit(1).alias("one")).applyInPandas(run, "model binary").collect()
    weights = np.zeros(BUCKETS)
    if not got:
        return Model(weights, -7.0)
    used, values, bias = pickle.loads(bytes(got[0].model))
    weights[used] = values
    return Model(weights, bias)


class Rules:
    """Rules by host; those of a URL stand at its host and the hosts above it."""

    def __init__(self, rules: list[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for r in rules:
            self.by_host.setdefault(r.host, []).append(r)

    def of(self, host: str, path: str) -> Rule | None:
        best, at = None, host
        while at:
            for r in self.by_host.get(at, ()):
                if path.startswith(r.path) and (best is None or len(r.host) + len(r.path) > len(best.host) + len(best.path)):
                    best = r
            at = at.partition(".")[2]
        return best


def judge(pages: DataFrame, model: Model, rules: list[Rule] = RULES, key: str = "page_id", url: str = "url",
          threshold: float = 0.5) -> DataFrame:
    """(key, host, path, rule, verdict, p_block) for every row; ``rule`` is null where the model decides."""
    shared = pages.sparkSession.sparkContext.broadcast((Rules(rules), model))     # the caller's rules, BUCKETS weights

    @F.pandas_udf("rule string, verdict string, p_block double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        book, m = shared.value
        for hosts, paths in batches:
            p = 1 / (1 + np.exp(-np.clip(m.logits(hosts.tolist(), paths.tolist()), -30, 30)))
            found = [book.of(h, q) for h, q in zip(hosts, paths)]
            yield pd.DataFrame({
                "rule": pd.Series([r.host + r.path if r else None for r in found], dtype=object),
                "verdict": [r.verdict if r else "block" if x >= threshold else "allow" for r, x in zip(found, p)],
                "p_block": p})
    parts = pages.select(key, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return parts.withColumn("_", run("host", "path")).select(key, "host", "path", "_.rule", "_.verdict", "_.p_block")


# words of hosts and paths of the two kinds, joined by rule into the small labelled table
_BLOCKED = ("casino poker slots jackpot roulette betting bets bet wager bingo lottery gamble win winner lucky bonus prize "
            "pills pharma viagra cialis meds drugs cheap discount replica adult porn xxx sex nude escort cams dating hot "
            "ads adserver adclick banner popup track tracker tracking clicks affiliate spam farm linkfarm seo traffic spammer "
            "free loans payday credit cash rich crypto pump warez crack keygen torrent malware phish scam clickbait").split()
_PLAIN = ("news daily times post herald journal review magazine library school college museum garden kitchen recipes travel "
          "history science nature weather sports music cinema theatre city council river mountain forest harbour market "
          "books poetry writers teacher student health clinic hospital energy water bridge railway aviation bicycle winter window "
          "windmill alphabet better tibet diabetes freedom freeway farmers track trackside roadside essex sussex pillar pillow "
          "caterpillar cashmere credits richmond locate lighthouse wiki docs forum blog notes home studio design maps photo "
          "union church parish archive society institute observer gazette chronicle tribune community village country").split()
_SYLLABLES = ("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou le ve co me de hi ri ro ic ne "
              "ea ra ce li ch ll be ma si om ur sch ein ung aux ment eau que cion ado ria tion ble ing ly sh wh").split()
_TOP = "com net org info de fr es io example.com example.net example.org".split()
_SUB = ["", "", "www.", "m.", "blog."]
_PLAIN_PATHS = "articles news page post story about archive topics help guide photos en de fr es items section".split()


def labelled_urls(count: int = 4000, seed: int = 12) -> list[tuple[str, int]]:
    """A small labelled table made by rule: hosts of plain words or syllables to allow; hosts, and a few paths,
    that hold words of spam, gambling, drugs, adult pages or tracking to block.  Domains, forms of
    paths and query strings are drawn alike for both kinds."""
    rng = random.Random(seed)

    def plain_name() -> str:
        if rng.random() < 0.5:
            return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(2, 5)))
        return rng.choice(["", "-"]).join(rng.choice(_PLAIN) for _ in range(rng.randint(1, 2)))

    def blocked_name() -> str:
        parts = [rng.choice(_BLOCKED)]
        if rng.random() < 0.8:
            parts.insert(rng.randint(0, 1), rng.choice(_BLOCKED) if rng.random() < 0.6 else
                         rng.choice(["x", "go", "my", "top", "best", "24", "777", "online", "club", rng.choice(_SYLLABLES)]))
        return rng.choice(["-", "-", ""]).join(parts)

    def plain_path() -> str:
        number = str(rng.randint(1, 99999))
        start = rng.choice(["", "/" + rng.choice(_PLAIN_PATHS), "/" + rng.choice(_PLAIN_PATHS) + "/" + rng.choice(_PLAIN)])
        return start + rng.choice(["", "/", "/" + number, "/" + number + ".html", "/" + number + "/"])

    out: list[tuple[str, int]] = [("", 0), ("mailto:someone", 0), ("http://", 0)]
    while len(out) < count:
        block = len(out) % 2
        path = plain_path()
        if block and rng.random() < 0.2:
            name, path = plain_name(), f"/{blocked_name()}/{blocked_name()}" + rng.choice(["", "/", ".html"])
        else:
            name = blocked_name() if block else plain_name()
        url = f"{rng.choice(['http', 'https'])}://{rng.choice(_SUB)}{name}.{rng.choice(_TOP)}{path}"
        out.append((url + rng.choice(["", "", "#top", "?page=2&ref=x", "?utm_source=feed"]), block))
    return out
