"""Token counts by section: offset-mapped attribution.

A document is encoded once, whole.  Byte-level tokens cut its UTF-8 bytes without gaps,
so the cumulated token lengths give every token's span.  Sections are spans of the same
text; an interval join (both sides sorted, binary search) gives the tokens of each.  A
token that crosses a boundary is allocated by an explicit rule:

* ``start``: to the section that holds its first byte (the default),
* ``end``: to the section that holds its last byte,
* ``majority``: to the section with most of its bytes, the earlier one on a tie,
* ``share``: to all it touches, in proportion to the bytes.

Sections: ``lines`` of a text (each with its line break), or the named ``fields`` of a
row, rendered one after the other with a line break between them, which belongs to the
field before it.  Character spans are those of the rendered text.

Defined results: null text or field is empty and has one section with 0 tokens; the
tokens of a row's sections add up to the tokens of its whole text; rows are
independent, so repeated rows repeat their result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteEncoder, id_text, text_or_empty

RULES = ("start", "end", "majority", "share")


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> np.ndarray:
    """Tokens of each section.  ``ends``: last byte + 1 of every token; ``bounds``: 0 and
    the byte at which each section ends."""
    sections = len(bounds) - 1
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    out = np.zeros(sections)
    if not len(ends):
        return out
    starts = np.r_[0, ends[:-1]]
    lo = np.searchsorted(bounds, starts, "right") - 1
    hi = np.searchsorted(bounds, ends - 1, "right") - 1
    if rule == "start":
        return np.bincount(lo, minlength=sections).astype(float)
    if rule == "end":
        return np.bincount(hi, minlength=sections).astype(float)
    out += np.bincount(lo[lo == hi], minlength=sections)
    for t in np.flatnonzero(lo != hi):
        parts = np.arange(lo[t], hi[t] + 1)
        held = np.minimum(bounds[parts + 1], ends[t]) - np.maximum(bounds[parts], starts[t])
        if rule == "majority":
            out[parts[int(held.argmax())]] += 1
        else:
            out[parts] += held / held.sum()
    return out


def count_lines(docs: DataFrame, rule: str = "start", tokenizer: str | None = None, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(doc_id, section, char_start, char_end, n_tokens, doc_tokens) for every line of every text."""
    rows = docs.select(id_text(key).alias("doc_id"), F.array(text_or_empty(text)).alias("parts"))
    return _count(rows, True, rule, tokenizer).drop("field")


def count_fields(docs: DataFrame, fields: list[str], rule: str = "start", tokenizer: str | None = None,
                 key: str = "doc_id") -> DataFrame:
    """(doc_id, field, section, char_start, char_end, n_tokens, doc_tokens) for every field of every row."""
    rows = docs.select(id_text(key).alias("doc_id"), F.array(*[text_or_empty(F.col(f).cast("string")) for f in fields]).alias("parts"))
    return _count(rows, False, rule, tokenizer).withColumn(
        "field", F.element_at(F.array(*map(F.lit, fields)), F.col("section") + 1))


def _count(rows: DataFrame, lines: bool, rule: str, tokenizer: str | None) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = ByteEncoder(tokenizer)
        width = encoder.token_bytes()
        for pdf in batches:
            doc_ids, totals, sizes, places, starts, stops, counts = [], [], [], [], [], [], []
            for doc, parts in zip(pdf["doc_id"], pdf["parts"]):
                sections = parts[0].split("\n") if lines else list(parts)
                sections = [s + "\n" for s in sections[:-1]] + sections[-1:]
                if lines and len(sections) > 1 and not sections[-1]:
                    sections.pop()               # a final line break ends the last line
                ids = np.frombuffer(encoder.ids("".join(sections)), "<u4")
                chars = np.cumsum([0] + [len(s) for s in sections])
                bounds = np.cumsum([0] + [len(s.encode("utf-8", "surrogatepass")) for s in sections])
                doc_ids.append(doc)
                totals.append(len(ids))
                sizes.append(len(sections))
                places.append(np.arange(len(sections)))
                starts.append(chars[:-1])
                stops.append(chars[1:])
                counts.append(attribute(np.cumsum(width[ids]), bounds, rule))
            if doc_ids:
                yield pd.DataFrame({"doc_id": np.repeat(np.array(doc_ids, object), sizes), "section": np.concatenate(places),
                                    "char_start": np.concatenate(starts), "char_end": np.concatenate(stops),
                                    "n_tokens": np.concatenate(counts), "doc_tokens": np.repeat(totals, sizes)})
    out = rows.mapInPandas(run, "doc_id string, section int, char_start long, char_end long, n_tokens double, doc_tokens long")
    if rule != "share":
        out = out.withColumn("n_tokens", F.col("n_tokens").cast("long"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("field", F.lit(None).cast("string"))

