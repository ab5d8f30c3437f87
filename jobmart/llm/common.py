"""Helpers shared by the operators: columns, staged tables, tokenizer, components."""

from __future__ import annotations

import math
import os
import re
from array import array

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, ship_package

__all__ = ["ByteEncoder", "components", "ensure_checkpoint_dir", "id_text", "materialize", "partitions",
           "read_table", "ship_package", "text_or_empty", "unused"]

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole; workers get the package first."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, for a helper column beside its own."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(col: str | Column) -> Column:
    """An id as text: pandas would turn a long column with nulls into floats."""
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def partitions(spark: SparkSession, at_least: int = 1) -> int:
    """Shuffle partitions of the session, raised to ``at_least``; explicit counts keep
    adaptive execution from merging small but CPU-heavy groups into a few tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), at_least)


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The visible character that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """Byte-level BPE ids of whole texts as little-endian uint32 bytes.

    ``path`` is a ``tokenizers`` JSON file.  Where the file's merges are in id order (checked),
    ``tiktoken`` merges over the same vocabulary: the same ids, several times faster;
    otherwise ``tokenizers`` itself is used.  Added tokens that occur in a text become
    their own id, as the library does with ``add_special_tokens=False``.
    """

    # fixed values: the pre-tokenization pattern of byte-level BPE vocabularies of this family, and
    # the same without look-ahead, which is equal on texts without two white-space characters in a row
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    PLAIN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json
        with open(path or default_tokenizer_path(), encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = _byte_letters()
        self.vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.added_bytes = {i: len(t.encode()) for t, i in added.items()}
        self.added = {t: array("I", [i]).tobytes() for t, i in added.items()}
        self.split_added = (re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
                            if added else None)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        if all(self.vocab.get(a + b) == i for i, (a, b) in enumerate(merges, 256)):
            import tiktoken
            ranks = {bytes(letters[c] for c in t): i for t, i in self.vocab.items()}
            self.encode, self.encode_plain = (
                tiktoken.Encoding("bytes", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
                for p in (self.PATTERN, self.PLAIN))
        else:
            from tokenizers import Tokenizer
            whole = Tokenizer.from_file(path or default_tokenizer_path())
            self.encode = self.encode_plain = lambda t: whole.encode(t, add_special_tokens=False).ids
        self.spaces = re.compile(r"\s\s").search

    def ids(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian uint32 bytes."""
        if self.split_added is not None and any(a in text for a in self.added):
            return b"".join(self.added[part] if part in self.added else self._ordinary(part)
                            for part in self.split_added.split(text))
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        return array("I", (self.encode if self.spaces(text) else self.encode_plain)(text)).tobytes()

    def token_bytes(self) -> np.ndarray:
        """Number of UTF-8 bytes that each id stands for."""
        out = np.zeros(max([*self.vocab.values(), *self.added_bytes]) + 1, np.int64)
        for tok, i in self.vocab.items():
            out[i] = len(tok)          # one visible character per byte
        for i, n in self.added_bytes.items():
            out[i] = n
        return out


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a long, b long).

    Alternating large-star and small-star rounds: every node links to the smallest
    neighbour, so the graph shrinks to stars in a logarithmic number of rounds.
    Hot nodes only meet aggregates (``min`` combines before the shuffle) and joins
    that adaptive execution can split.  Each round's edges are staged in the shared
    folder; nothing but two counters reaches the driver.  Returns (node, component)
    for every node with an edge; component is the smallest node reachable.
    """
    spark = edges.sparkSession
    cur = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                      f"{name}-0")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # joined on a second key too: both sides get an exchange of their own, which adaptive
        # execution can split where one node holds many of the edges
        k = F.xxhash64("a").alias("k")
        linked = both.select("*", k).join(low.select("*", k), ["k", "a"]).drop("k")
        if large:
            out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select("a", F.col("m").alias("b")))
        return (out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    seen = None
    for i in range(max_rounds):
        nxt = materialize(star(star(cur, True), False), f"{name}-{i + 1}")
        mark = nxt.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        cur, done = nxt, (mark.n, mark.h) == seen
        seen = (mark.n, mark.h)
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def blocks_of(total: int, per_block: int, at_least: int = 1) -> int:
    return max(at_least, math.ceil(total / per_block))
