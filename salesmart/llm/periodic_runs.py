"""Periodic runs of words: difference-cover longest common extensions drive a harmonic-grid search.

A run is a stretch of consecutive words with smallest period q and length of at
least ``max(min_words, 2 * q)`` that no neighbouring word extends.

1. Grid: for every period p the positions 0, p, 2p, ... are looked at.  A
   stretch of 2p words with period p holds one grid position i in its first p
   words, and there word i equals word i + p; other grid positions are passed
   over.  The grid has n log n positions, compared in some 2 sqrt(n) slices.
2. From (i, i + p) the common extension to the right, and in the reversed text
   to the left, gives the whole stretch.
3. An extension compares fewer than ``_COVER_MOD`` words until both positions
   fall on the difference cover.  If they are equal so far, the rest is the
   minimum of the LCP array between the two sampled suffixes, read from a
   sparse table.  Only the cover's suffixes (4 of 13) are ever sorted, and
   only in texts where some pair gets that far.
4. A stretch with period p and 2p words whose smallest period is q < p is the
   maximal stretch of q too, so the least p of equal stretches is the period.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_arrow, slices

#: A difference cover; every residue is a difference of two of its members.
_COVER, _COVER_MOD = (0, 1, 3, 9), 13

#: Pairs extended at a time, so that a text of one repeated word stays within some tens of megabytes.
_PAIRS = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _steps_to_cover() -> np.ndarray:
    """By the residues of two positions: the steps until both are on the cover."""
    on = np.isin(np.arange(2 * _COVER_MOD) % _COVER_MOD, _COVER)
    a, b, step = np.ogrid[:_COVER_MOD, :_COVER_MOD, :_COVER_MOD]
    return (on[a + step] & on[b + step]).argmax(axis=2)


_STEPS = _steps_to_cover()


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


class Extensions:
    """Longest common extensions to the right within one sequence of non-negative integers."""

    def __init__(self, sequence: np.ndarray):
        self.n = len(sequence)
        # the sentinel ends every comparison at the end of the text
        self.x = np.concatenate([sequence, np.full(2 * _COVER_MOD, -1, sequence.dtype)])
        self._rank = self._table = None

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from positions ``a`` and ``b`` on (a < b <= n, elementwise)."""
        steps = _STEPS[a % _COVER_MOD, b % _COVER_MOD]
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))  # equal so far, and not yet on the cover
        synced = []
        for step in range(_COVER_MOD):
            there = steps[live] == step
            synced.append(live[there])
            live = live[~there]
            live = live[self.x[a[live] + step] == self.x[b[live] + step]]
            out[live] = step + 1
            if not len(live):
                break
        both = np.concatenate(synced)
        both = both[b[both] + steps[both] < self.n]
        both = both[self.x[a[both] + steps[both]] == self.x[b[both] + steps[both]]]
        if len(both):
            out[both] += self._sampled(a[both] + steps[both], b[both] + steps[both])
        return out

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self._table is None:
            self._build()
        one, two = self._rank[a], self._rank[b]
        low, high = np.minimum(one, two), np.maximum(one, two)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self._table[level, low], self._table[level, high - (1 << level)])

    def _build(self) -> None:
        """Sort the cover's suffixes, and set up minima over the LCPs of neighbours in that order."""
        parts = [np.arange(d, self.n, _COVER_MOD) for d in _COVER]
        # windows of 13 words, ranked; each class of residues is one stretch of the reduced text, ended by a 0
        at = np.concatenate(parts)
        window = self.x[at[:, None] + np.arange(_COVER_MOD)]
        order = np.lexsort(window.T[::-1])
        new = np.concatenate([[True], (window[order][1:] != window[order][:-1]).any(axis=1)])
        ranked = np.empty(len(at), np.int64)
        ranked[order] = np.cumsum(new)
        ends = np.cumsum([len(p) for p in parts])
        size = len(at) + len(parts)
        place = np.arange(len(at)) + np.searchsorted(ends, np.arange(len(at)), side="right")
        text = np.zeros(size, np.int64)
        text[place] = ranked
        # prefix doubling over the reduced text; the levels also give the LCPs of neighbours
        levels, width = [_dense(text)], 1
        while levels[-1].max() + 1 < size and width < size:
            ahead = np.full(size, -1, np.int64)
            ahead[:-width] = levels[-1][width:]
            levels.append(_dense(levels[-1] * (size + 1) + ahead + 1))
            width *= 2
        suffix = levels[-1][place]
        order = np.argsort(suffix, kind="stable")
        self._rank = np.zeros(self.n, np.int64)
        self._rank[at[order]] = np.arange(len(at))
        left, right = place[order[:-1]], place[order[1:]]
        windows = np.zeros(len(left), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            i, j = left + windows, right + windows
            inside = (i < size) & (j < size)
            same = inside & (levels[k][np.minimum(i, size - 1)] == levels[k][np.minimum(j, size - 1)])
            # equal separators end both suffixes and are no words
            same &= (text[np.minimum(i, size - 1)] > 0)
            windows += np.where(same, 1 << k, 0)
        lcp = windows * _COVER_MOD
        p, q = at[order[:-1]], at[order[1:]]
        live = np.arange(len(lcp))
        for _ in range(_COVER_MOD):
            i, j = p[live] + lcp[live], q[live] + lcp[live]
            live = live[(np.maximum(i, j) < self.n) & (self.x[np.minimum(i, self.n)] == self.x[np.minimum(j, self.n)])]
            lcp[live] += 1
        rows = [lcp]
        while (1 << len(rows)) <= len(lcp):
            last, half = rows[-1], 1 << (len(rows) - 1)
            row = last.copy()
            row[:-half] = np.minimum(last[:-half], last[half:])
            rows.append(row)
        self._table = np.stack(rows)


def _grid(x: np.ndarray):
    """(i, p) arrays of the grid positions at which word i equals word i + p."""
    n = len(x)
    root = isqrt(n)
    for p in range(1, min(root, n // 2) + 1):
        hit = np.flatnonzero(x[:n - p:p] == x[p::p])
        if len(hit):
            yield hit * p, np.full(len(hit), p, np.int64)
    low, k = root + 1, 0  # longer periods: one slice for the k-th grid position of all of them
    while low <= n // 2 and (k + 1) * low < n:
        high = min(n // 2, (n - 1) // (k + 1))
        first = x[k * low:k * high + 1:k] if k else x[0]
        hit = low + np.flatnonzero(first == x[(k + 1) * low:(k + 1) * high + 1:k + 1])
        if len(hit):
            yield k * hit, hit
        k += 1


def _blocks(parts, size: int):
    """The small arrays joined to blocks of some ``size`` pairs."""
    held, count = [], 0
    for part in parts:
        held.append(part)
        count += len(part[0])
        if count >= size:
            yield [np.concatenate(c) for c in zip(*held)]
            held, count = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def find_runs(ids: np.ndarray, min_words: int = 12) -> np.ndarray:
    """Runs of a sequence of non-negative integers: rows (start, length, period) by start, then period."""
    n = len(ids)
    ahead, back, found = Extensions(ids), Extensions(ids[::-1]), []
    if n < max(2, min_words):
        return np.zeros((0, 3), np.int64)
    for some in _blocks(_grid(ids), _PAIRS):
        for cut in range(0, len(some[0]), _PAIRS):
            i, p = some[0][cut:cut + _PAIRS], some[1][cut:cut + _PAIRS]
            right, left = ahead(i, i + p), back(n - i - p, n - i)
            length = left + p + right
            ok = length >= np.maximum(min_words, 2 * p)
            if ok.any():
                found.append(np.unique(np.stack([(i - left)[ok], length[ok], p[ok]], axis=1), axis=0))
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)  # by start, length, period: the least period of a stretch is first
    first = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def dropped_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words that some run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def runs_of_text(text: bytes | None, min_words: int = 12) -> tuple[np.ndarray, int, bytes]:
    """(runs, words, text with each run cut to its first period) of one UTF-8 text."""
    words = (text or b"").split()  # of bytes: exactly the blanks 0x20 and 0x09-0x0D
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):  # no word twice, so no run
        return np.zeros((0, 3), np.int64), len(words), b" ".join(words)
    runs = find_runs(ids, min_words)
    if len(runs):
        gone = dropped_words(runs, len(words)).tolist()
        return runs, len(words), b" ".join([w for w, out in zip(words, gone) if not out])
    return runs, len(words), b" ".join(words)


def periodic_runs(documents: DataFrame, min_words: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row for each row of ``documents``; no shuffle.

    ``runs`` lists (start, length, period) in words from 0, by start, then
    period.  ``collapsed`` is the text with every run cut to its first period,
    the kept words joined by one space.  Words are case-sensitive.  A null,
    empty or blank text has no words, no runs and an empty collapsed text; a
    null doc_id stays null; repeated rows stay repeated; further columns are
    not read.  A text is searched whole in one task, in memory of some hundred
    bytes a word.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    def search(batches):
        for piece in slices(batches):
            found = [runs_of_text(t, min_words) for t in piece.column(1).cast(pa.binary()).to_pylist()]
            runs = [[dict(zip(("start", "length", "period"), r)) for r in f[0].tolist()] for f in found]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([f[1] for f in found], pa.int64()), pa.array(runs, schema.field("runs").type),
                 pa.array([f[2] for f in found], pa.binary()).cast(pa.string())], schema=schema)

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     search, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
