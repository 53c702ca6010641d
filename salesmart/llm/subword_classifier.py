"""Quality classifier: supervised subword embeddings.

Words and their character n-grams are hashed to buckets, each with a learned
vector.  A document is the average of its features' vectors; a softmax layer
gives the class.  Two word bigrams that no vocabulary holds get buckets of
their own: a word after itself, and a line after itself.  Training is numpy
stochastic gradient descent on a bounded labelled sample; scoring reads every
whole text.

Since average and output layer are linear, scoring needs one number a bucket
(its vector times the difference of the output rows): a word's sum is looked
up once and cached.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import held_out, labelled_sample, map_arrow, map_rows, slices

BUCKETS = 1 << 18
#: Words that a worker keeps sums of; the cache starts anew when it is full.
CACHE_WORDS = 300_000
_SAME_WORD, _SAME_LINE = b" same word", b" same line"


def features(word: bytes, buckets: int, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of the word itself and of its n-grams, taken over its bytes between end marks."""
    marked, mask = b"<" + word + b">", buckets - 1
    return [crc32(marked) & mask] + [crc32(marked[i:i + n]) & mask for n in range(shortest, longest + 1)
                                     for i in range(len(marked) - n + 1)]


def repeats(text: bytes, words: list[bytes]) -> tuple[int, int]:
    """Words equal to the word before, and lines with words equal to the line before."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return sum(map(eq, words, words[1:])), sum(map(eq, lines, lines[1:]))


class Model:
    """``weights``: a number for each bucket; score = sigmoid(average + bias)."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self._cache = weights, bias, {}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def _sum(self, word: bytes) -> tuple[float, int]:
        f = features(word, len(self.weights))
        got = float(self.weights[f].sum()), len(f)
        if len(self._cache) >= CACHE_WORDS:
            self._cache.clear()
        self._cache[word] = got
        return got

    def score(self, text: str | None) -> float:
        """Chance of class 1; a text without words has the bias alone."""
        raw = (text or "").encode()
        words = raw.split()
        cache, total, n = self._cache, 0.0, 0
        for w in words:
            s, c = cache.get(w) or self._sum(w)
            total += s
            n += c
        mask = len(self.weights) - 1
        for name, times in zip((_SAME_WORD, _SAME_LINE), repeats(raw, words)):
            total += times * float(self.weights[crc32(name) & mask])
            n += times
        z = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0


def document_features(texts: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and their shares."""
    of_word: dict[bytes, np.ndarray] = {}
    out = []
    for text in texts:
        raw = text.encode()
        words = raw.split()
        for w in set(words).difference(of_word):
            of_word[w] = np.array(features(w, buckets), np.int64)
        same = [np.full(k, crc32(name) & (buckets - 1)) for name, k in
                zip((_SAME_WORD, _SAME_LINE), repeats(raw, words))]
        found, times = np.unique(np.concatenate([of_word[w] for w in words] + same), return_counts=True) if words \
            else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        out.append((found, (times / max(1, times.sum())).astype(np.float32)))
    return out


def train(sample: list[tuple[str, int]], counts: dict[int, int], buckets: int = BUCKETS, dim: int = 8,
          epochs: int = 6, rate: float = 4.0, batch: int = 16, seed: int = 7) -> Model:
    """Stochastic gradient descent on the sample; ``counts`` restore the classes' true odds afterwards.

    Without rows of both classes the model scores the share of class 1 (one half without labels).
    """
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    prior = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    y = np.array([label for _, label in sample], np.float32)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(buckets, np.float32), prior)
    docs = document_features([t for t, _ in sample], buckets)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out = rng.uniform(-1, 1, (2, dim)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    total = epochs * len(y)
    seen = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            step = rate * (1 - seen / total)
            seen += len(rows)
            sizes = [len(docs[i][0]) for i in rows]
            found = np.concatenate([docs[i][0] for i in rows])
            share = np.concatenate([docs[i][1] for i in rows])
            owner = np.repeat(np.arange(len(rows)), sizes)
            picked = vectors[found] * share[:, None]
            hidden = np.stack([np.bincount(owner, picked[:, k], len(rows)) for k in range(dim)], 1)
            z = hidden @ out.T + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), y[rows].astype(int)] -= 1
            # with two classes the rows of ``error`` are (-e, e): all vectors move along one direction
            pull = np.bincount(found, share * error[owner, 1], buckets)
            moved, along = np.flatnonzero(pull), out[1] - out[0]
            out -= (step / len(rows) * error.T @ hidden).astype(np.float32)
            bias -= (step / len(rows) * error.sum(axis=0)).astype(np.float32)
            vectors[moved] -= (step * pull[moved, None] * along).astype(np.float32)
    shift = prior - float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]) + shift)


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1000,
        max_chars: int = 50_000, **options) -> Model:
    """Train on at most ``per_class`` documents of each class (see ``labelled_sample`` for the bounds)."""
    return train(*labelled_sample(documents, labels, label, per_class, max_chars), **options)


def scores(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    Null and blank texts are scored by the bias alone; a null doc_id is not held out.
    """
    known = documents.sparkSession.sparkContext.broadcast(model)  # 4 bytes a bucket

    def make():
        score = known.value.score

        def work(rows):
            got = [score(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": got,
                    "predicted": [int(s >= threshold) for s in got]}
        return work

    return map_rows(documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"),
                    "doc_id long, held_out boolean, score double, predicted int", make)


def keep_good(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``documents`` without the rows whose text scores below ``threshold``; rows and columns otherwise as they were."""
    known = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = known.value.score
        for piece in slices(batches):
            yield piece.filter(pa.array([score(t) >= threshold for t in piece.column(at).to_pylist()], pa.bool_()))

    return map_arrow(documents, run, documents.schema)
