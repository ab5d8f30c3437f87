"""Streaming over sorted groups inside a task, and links found there."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of equal ``keys`` in a sorted stream of frames, each as one frame.

    Cheaper than one call a group where groups are small: a partition holds one run at a
    time, besides the batch at hand."""
    held: pd.DataFrame | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        k = pdf[keys].to_numpy()
        cut = np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, len(pdf)]
        for lo, hi in zip(cut[:-2], cut[1:-1]):
            yield pdf.iloc[lo:hi]
        held = pdf.iloc[cut[-2]:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def local_roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each row of a symmetric link matrix reaches."""
    root = ids.copy()
    touched = np.flatnonzero(linked.any(1))
    if not len(touched):
        return root
    sub = linked[np.ix_(touched, touched)]
    cur = root[touched]
    top = np.iinfo(np.int64).max
    while True:
        nxt = np.minimum(cur, np.where(sub, cur[None, :], top).min(1))
        if (nxt == cur).all():
            break
        cur = nxt
    root[touched] = cur
    return root
