"""Posting lists inside one shard: top-k keeper and windowed MaxScore traversal (numpy, within a task)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents that the traversal looks at together; thresholds are renewed between windows.
WINDOW = 2048


@dataclass
class Top:
    """The ``k`` best ``(score, id)`` seen so far, ties to the smaller id, null ids last.

    ``least`` is the score below which nothing can enter any more; it starts at the caller's floor.
    """

    k: int
    least: float = -np.inf
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nulls: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        fit = scores >= self.least
        if not fit.any():
            return
        s, i, n = (np.concatenate(x) for x in ((self.scores, scores[fit]), (self.ids, ids[fit]), (self.nulls, nulls[fit])))
        order = np.lexsort((i, n, -s))[: self.k]
        self.scores, self.ids, self.nulls = s[order], i[order], n[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


@dataclass
class Postings:
    """One list: documents in ascending order, a value for each, a weight, and no ``weight * value`` over ``bound``."""

    docs: np.ndarray
    values: np.ndarray
    weight: int
    bound: int
    edges: np.ndarray  # where each window starts in ``docs``, and the end


def window_edges(docs: np.ndarray, n_docs: int) -> np.ndarray:
    return np.searchsorted(docs, np.arange(0, n_docs + WINDOW, WINDOW))


def filled(docs: np.ndarray, values: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """A list that holds most documents with zeros for the others: it is then read without its document numbers."""
    if 2 * len(docs) < n_docs or len(docs) == n_docs:
        return docs, values
    full = np.zeros(n_docs, values.dtype)
    full[docs] = values
    return np.arange(n_docs, dtype=docs.dtype), full


def max_score(lists: list[Postings], ids: np.ndarray, nulls: np.ndarray, top: Top, own: int = -1) -> None:
    """Offer ``top`` every document of the shard (but ``own``) whose summed score can enter it.

    In each window the lists of least bound whose bounds together stay below ``top.least`` are
    non-essential: a document in none of the others cannot enter. The essential lists are
    traversed and summed; then the others are probed, greatest bound first, for the documents
    that can still reach ``top.least``.
    """
    n_docs = len(ids)
    lists = sorted(lists, key=lambda x: x.bound)
    reach = np.concatenate([[0], np.cumsum([x.bound for x in lists])]).astype(np.int64)  # of the first j lists together
    for w, start in enumerate(range(0, n_docs, WINDOW)):
        size = min(WINDOW, n_docs - start)
        split = int(np.searchsorted(reach[1:], top.least))  # lists[:split] are non-essential
        if split == len(lists) and top.least > 0:
            return
        scores = np.zeros(size, np.int64)
        touched = np.full(size, top.least <= 0)
        for x in lists[split:]:
            a, b = x.edges[w], x.edges[w + 1]
            if b - a == size:  # the list holds the whole window
                scores += x.weight * x.values[a:b]
                touched[:] = True
            elif b > a:
                at = x.docs[a:b] - start
                scores[at] += x.weight * x.values[a:b]
                touched[at] = True
        left = np.flatnonzero(touched)
        for j in range(split - 1, -1, -1):
            left = left[scores[left] + reach[j + 1] >= top.least]
            if not len(left):
                break
            x = lists[j]
            a, b = x.edges[w], x.edges[w + 1]
            if b - a == size:
                scores[left] += x.weight * x.values[a:b][left]
            elif b > a:
                part = x.docs[a:b]
                at = np.minimum(np.searchsorted(part, left + start), b - a - 1)
                hit = part[at] == left + start
                scores[left[hit]] += x.weight * x.values[a:b][at[hit]]
        if own >= 0:
            left = left[left != own - start]
        if len(left):
            top.offer(scores[left], ids[start + left], nulls[start + left])


def blocks(queries: DataFrame, key: str, weight: str, most: int) -> Iterator[DataFrame]:
    """``queries`` cut by a hash of ``key`` into as many parts as keep the sum of ``weight`` at about ``most``.

    Each part is small enough to be sent to every task; all parts together are all queries.
    """
    total = queries.agg(F.sum(weight)).first()[0] or 0
    n = -(-total // most)
    for b in range(n):
        yield queries.where(F.pmod(F.xxhash64(key), F.lit(n)) == b)
