"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the sum of hashed vectors: two hashes of the word and one
of each of its first four and five characters, so that inflected forms share
what they begin with and single collisions stay weak.  Filters of several
widths run over the words, each keeps its maximum over the whole text, and a
dense layer gives the score.  Training is numpy stochastic gradient descent by
mini-batches on a bounded labelled sample, from a random start that has seen no
label.  A maximum teaches the one position that won it, and the first winners
are chance; so it starts as a smooth maximum (a logarithm of mean exponentials),
which teaches all positions, is sharpened from epoch to epoch, and is the plain
maximum in the last ones.

A filter is linear before its maximum, so a word's share in every filter
position is computed once and cached; a text is then lookups, sums and maxima.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import broadcast_if_small, held_out, labelled_sample, map_rows, stored

BUCKETS = 1 << 18
WIDTHS = (1, 2, 3)
#: Lengths of the beginnings that are hashed besides the whole word.
STEMS = (4, 5)
_MARKS = ".,;:!?\"'()[]*#$%&|"
#: Parts of the sample; each is scored by a network trained on the others.
FOLDS = 3
#: A missed row of class 1 counts as so many false alarms when the cut is set.
MISS = 2.0
#: Training documents that must hold a bucket before it gets a vector.
SEEN_IN = 4
#: Spread of the random start; documents of a mini-batch; sharpness of the smooth maximum in its first and last epoch,
#: and epochs with the plain maximum after them.
START, BATCH, SHARPNESS, PLAIN_EPOCHS = 0.3, 24, (1.0, 20.0), 2
#: Words that a worker keeps projections of; the cache starts anew when it is full.
CACHE_WORDS = 150_000
#: Word positions convolved at a time, so that very long texts need little memory.
_POSITIONS = 4096


def word_buckets(word: str, buckets: int) -> tuple[int, ...]:
    """The word itself by two hashes, and its first characters for each of ``STEMS``."""
    own, mask = word.encode(), buckets - 1
    return (crc32(own) & mask, crc32(own, 1) & mask, *[crc32(word[:n].encode(), n) & mask for n in STEMS])


def words(text: str | None) -> list[str]:
    """Lower-cased words without the marks at their ends."""
    return [w.strip(_MARKS) for w in (text or "").lower().split()]


class Model:
    """Embeddings, filters by width (width x dim x filters), their biases and the dense layer."""

    def __init__(self, vectors: np.ndarray, filters: list[np.ndarray], biases: list[np.ndarray],
                 dense: np.ndarray, bias: float):
        self.vectors, self.filters, self.biases, self.dense, self.bias = vectors, filters, biases, dense, bias
        self._clear()

    def __reduce__(self):
        return Model, (self.vectors, self.filters, self.biases, self.dense, self.bias)

    def _clear(self, room: int = CACHE_WORDS) -> None:
        self._rows: dict[str, int] = {}
        self._shares = [np.zeros((room, f.shape[0], f.shape[2]), np.float32) for f in self.filters]

    def _learn(self, new: list[str]) -> None:
        """Projections of new words for every filter position."""
        at = np.array([word_buckets(w, len(self.vectors)) for w in new], np.int64)
        vectors = self.vectors[at].sum(axis=1)
        first = len(self._rows)
        for shares, f in zip(self._shares, self.filters):
            shares[first:first + len(new)] = np.einsum("nd,wdf->nwf", vectors, f)
        self._rows.update(zip(new, range(len(self._rows), len(self._rows) + len(new))))

    def prepare(self, texts: list[list[str]]) -> None:
        new = list({w for t in texts for w in t}.difference(self._rows))
        if len(self._rows) + len(new) > len(self._shares[0]):
            new = list({w for t in texts for w in t})
            self._clear(max(CACHE_WORDS, len(new)))
        if new:
            self._learn(sorted(new))

    def score(self, text: list[str]) -> float:
        """Chance of class 1 for the words of a prepared text; no words: every filter at zero."""
        look, pooled = self._rows, []
        ids = np.fromiter((look[w] for w in text), np.int64, len(text))
        for shares, bias in zip(self._shares, self.biases):
            width, best = shares.shape[1], np.full(len(bias), -np.inf, np.float32)
            for at in range(0, max(0, len(ids) - width + 1), _POSITIONS):
                part = ids[at:at + _POSITIONS + width - 1]
                n = len(part) - width + 1
                total = shares[part[:n], 0]
                for k in range(1, width):
                    total = total + shares[part[k:k + n], k]
                np.maximum(best, total.max(axis=0), out=best)
            pooled.append(np.maximum(0, best + bias))
        z = float(np.concatenate(pooled) @ self.dense) + self.bias
        return float(1 / (1 + np.exp(-max(-500.0, min(500.0, z)))))


def train(sample: list[tuple[str, int]], counts: dict[int, int], buckets: int = BUCKETS, dim: int = 8,
          per_width: int = 8, epochs: int = 6, rate: float = 0.1, seed: int = 11) -> Model:
    """The network of the whole sample, its bias set so that 0.5 parts texts it has not seen best.

    The cut comes from ``FOLDS`` networks, each scoring the part of the sample
    it was not trained on; copies of a text fall into the same part.  Without
    rows of both classes every score is the share of class 1 (0 without labels).
    """
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    y = np.array([label for _, label in sample], np.int64)
    if len(set(y)) < 2:
        shape = [(w, dim, per_width) for w in WIDTHS]
        odds = float(np.log((n1 + 1e-9) / (n0 + 1e-9))) if n0 + n1 else -500.0
        return Model(np.zeros((buckets, dim), np.float32), [np.zeros(s, np.float32) for s in shape],
                     [np.zeros(per_width, np.float32) for _ in shape], np.zeros(per_width * len(shape), np.float32), odds)
    options = dict(buckets=buckets, dim=dim, per_width=per_width, epochs=epochs, rate=rate, seed=seed)
    model = _descend(sample, **options)
    part = np.array([crc32(text.encode()) % FOLDS for text, _ in sample])
    z, told = [], []
    for k in range(FOLDS):
        rest, own = [r for r, p in zip(sample, part) if p != k], [r for r, p in zip(sample, part) if p == k]
        if own and len({label for _, label in rest}) == 2:
            z += list(_logits(_descend(rest, **options), [words(t) for t, _ in own]))
            told += [label for _, label in own]
    if len(set(told)) < 2:
        z, told = list(_logits(model, [words(t) for t, _ in sample])), list(y)
    model.bias -= _best_cut(np.array(z), np.array(told), n0, n1)
    return model


class _Adaptive:
    """Parameters with a step size of their own for each (AdaGrad)."""

    def __init__(self, value: np.ndarray):
        self.value, self.seen = value, np.full(value.shape, 1e-3, np.float32)

    def learn(self, gradient, step: float, at=slice(None)) -> None:
        self.seen[at] += gradient * gradient
        self.value[at] -= step * gradient / np.sqrt(self.seen[at])


def _pool(total: np.ndarray, text: np.ndarray, sharpness: float | None):
    """Each text's (smooth) maximum over its positions by filter, and each position's share in it.

    Returns the texts that have positions, the maxima, each position's place
    among these texts, and the shares; without sharpness the maximum is plain.
    """
    first = np.flatnonzero(np.diff(text, prepend=-1))
    count = np.diff(np.append(first, len(text)))
    place = np.repeat(np.arange(len(first)), count)
    most = np.maximum.reduceat(total, first)
    if sharpness is None:
        share = (total == most[place]).astype(np.float32)
        return text[first], most, place, share / np.add.reduceat(share, first)[place]
    raised = np.exp(sharpness * (total - most[place]))
    whole = np.add.reduceat(raised, first)
    return text[first], most + np.log(whole / count[:, None]) / sharpness, place, raised / whole[place]


def _descend(sample: list[tuple[str, int]], buckets: int, dim: int, per_width: int, epochs: int, rate: float,
             seed: int) -> Model:
    """Stochastic gradient descent by mini-batches; the classes weigh the same.  No epochs: the random start.

    Only buckets in ``SEEN_IN`` documents or more hold a vector, so that a word
    of one training document cannot stand for its class.
    """
    rng = np.random.default_rng(seed)
    y = np.array([label for _, label in sample], np.float32)
    of_word: dict[str, tuple] = {}
    texts = []
    for text, _ in sample:
        own = words(text)
        for w in set(own).difference(of_word):
            of_word[w] = word_buckets(w, buckets)
        texts.append(np.array([of_word[w] for w in own], np.int64).reshape(-1, 2 + len(STEMS)))
    documents = np.zeros(buckets, np.int64)
    for t in texts:
        documents[np.unique(t)] += 1
    often = documents >= SEEN_IN
    vectors = _Adaptive((rng.normal(0, START, (buckets, dim)) * often[:, None]).astype(np.float32))
    filters = [_Adaptive(rng.normal(0, START, (w, dim, per_width)).astype(np.float32)) for w in WIDTHS]
    biases = [_Adaptive(np.full(per_width, 0.1, np.float32)) for _ in WIDTHS]
    dense, bias = _Adaptive(rng.normal(0, START, per_width * len(WIDTHS)).astype(np.float32)), _Adaptive(np.zeros(1, np.float32))
    weight = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum()))).astype(np.float32)
    smooth = epochs - PLAIN_EPOCHS
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        low, high = SHARPNESS
        sharpness = low * (high / low) ** (epoch / max(1, smooth - 1)) if epoch < smooth else None
        order = rng.permutation(len(y))
        for cut in range(0, len(order), BATCH):
            batch = [i for i in order[cut:cut + BATCH] if len(texts[i])]
            if batch:
                _step([texts[i] for i in batch], y[batch], weight[batch], vectors, filters, biases, dense, bias, often,
                      step, sharpness)
    return Model(vectors.value, [f.value for f in filters], [b.value for b in biases], dense.value, float(bias.value[0]))


def _step(texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, vectors: _Adaptive, filters: list[_Adaptive],
          biases: list[_Adaptive], dense: _Adaptive, bias: _Adaptive, often: np.ndarray, step: float,
          sharpness: float | None) -> None:
    """One mini-batch: forward over all its positions at once, and back to filters and vectors."""
    ids = np.concatenate(texts)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    own, per_width, hidden, found = vectors.value[ids].sum(axis=1), len(biases[0].value), [], []
    for f, b in zip(filters, biases):
        width, pooled = len(f.value), np.zeros((len(texts), per_width), np.float32)
        n = len(ids) - width + 1
        # windows that lie in one text
        at = np.flatnonzero(text[:n] == text[width - 1:]) if n > 0 else np.zeros(0, np.int64)
        if len(at):
            total = sum(own[at + k] @ f.value[k] for k in range(width))
            have, most, place, share = _pool(total, text[at], sharpness)
            pooled[have] = np.maximum(0, most + b.value)
            found.append((at, have, place, share, most + b.value > 0))
        else:
            found.append(None)
        hidden.append(pooled)
    hidden = np.concatenate(hidden, axis=1)
    chance = 1 / (1 + np.exp(-np.clip(hidden @ dense.value + bias.value, -50, 50)))
    error = ((chance - y) * weight / len(y)).astype(np.float32)
    back, down = error[:, None] * dense.value, np.zeros_like(own)
    dense.learn(hidden.T @ error, step)
    bias.learn(error.sum(keepdims=True), step)
    for k, (f, b, one) in enumerate(zip(filters, biases, found)):
        if one is None:
            continue
        at, have, place, share, live = one
        pull = back[have, k * per_width:(k + 1) * per_width] * live
        part = share * pull[place]
        turn = np.stack([own[at + j].T @ part for j in range(len(f.value))])
        for j in range(len(f.value)):
            down[at + j] += part @ f.value[j].T
        f.learn(turn, step)
        b.learn(pull.sum(axis=0), step)
    rows, which = np.unique(ids.reshape(-1), return_inverse=True)
    each = np.stack([np.bincount(which, weights=np.repeat(c, ids.shape[1]), minlength=len(rows)) for c in down.T], axis=1)
    vectors.learn((each * often[rows, None]).astype(np.float32), step, rows)


def _logits(model: Model, texts: list[list[str]]) -> np.ndarray:
    out = []
    for at in range(0, len(texts), 256):
        model.prepare(texts[at:at + 256])
        out += [model.score(t) for t in texts[at:at + 256]]
    p = np.clip(np.array(out), 1e-12, 1 - 1e-12)
    return np.log(p / (1 - p))


def _best_cut(z: np.ndarray, y: np.ndarray, n0: int, n1: int) -> float:
    """Logit with the least cost of errors when classes are as frequent as among all labels; the middle of ties."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    weight = np.where(y > 0, MISS * n1 / max(1, (y > 0).sum()), n0 / max(1, (y == 0).sum()))
    missed = np.concatenate([[0], np.cumsum(weight * (y > 0))])  # class 1 below the cut
    raised = np.concatenate([np.cumsum((weight * (y == 0))[::-1])[::-1], [0]])  # class 0 above it
    best = np.flatnonzero(np.isclose(missed + raised, (missed + raised).min()))
    k = int(best[len(best) // 2])
    low, high = (z[k - 1] if k else z[0] - 1), (z[k] if k < len(z) else z[-1] + 1)
    return float((low + high) / 2)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 1200,
        max_chars: int = 50_000, **options) -> Model:
    """Train on at most ``per_class`` documents of each class (see ``labelled_sample`` for the bounds)."""
    return train(*labelled_sample(documents, labels, label, per_class, max_chars), **options)


def scores(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, lang, held_out, score, predicted) for every row; ``lang`` is carried, not used.

    Null and blank texts leave every filter at zero; a null doc_id is not held
    out; without a column ``lang`` it is null.
    """
    known = documents.sparkSession.sparkContext.broadcast(model)  # 4 * dim bytes a bucket

    def make():
        own = known.value

        def work(rows):
            texts = [words(t) for t in rows["text"]]
            own.prepare(texts)
            got = [own.score(t) for t in texts]
            return {"doc_id": rows["doc_id"], "lang": rows["lang"], "held_out": rows["held_out"], "score": got,
                    "predicted": [int(s >= threshold) for s in got]}
        return work

    lang = F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string")
    return map_rows(documents.select("doc_id", lang.alias("lang"), held_out(F.col("doc_id")).alias("held_out"), "text"),
                    "doc_id long, lang string, held_out boolean, score double, predicted int", make)


def language_thresholds(scored: DataFrame, labels: DataFrame, label: str = "toxic", bins: int = 200,
                        most_false: float = 0.01, default: float = 0.5) -> DataFrame:
    """(lang, lang_threshold): the lowest cut whose share of flagged class-0 rows is at most ``most_false``.

    Uses the scores of all labelled rows that are not held out, counted in
    ``bins`` equal steps; languages without class-0 labels get the default.
    """
    known = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("label = 0").distinct())
    counts = (scored.where("NOT held_out").join(known, "doc_id")
              .groupBy("lang", F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).alias("bin"))
              .agg(F.count("*").alias("n")))
    above = Window.partitionBy("lang").orderBy(F.desc("bin"))
    whole = Window.partitionBy("lang")
    # one more than a bin's index: flagging starts above all rows of the highest bin that breaks the limit
    return (counts.withColumn("share", F.sum("n").over(above) / F.sum("n").over(whole))
            .groupBy("lang").agg(F.max(F.when(F.col("share") > most_false, F.col("bin") + 1)).alias("cut"))
            .select(F.col("lang").alias("of_lang"), F.coalesce(F.col("cut") / bins, F.lit(default)).alias("lang_threshold")))


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, most_false: float = 0.01) -> DataFrame:
    """``scores`` plus lang_threshold and flagged, the verdict by the threshold of the row's language.

    Languages without labels, and null, use ``threshold``.
    """
    scored = stored(scores(documents, fit(documents, labels), threshold), "toxicity")
    cuts = broadcast_if_small(stored(
        language_thresholds(scored, labels, most_false=most_false, default=threshold), "cuts"))
    return (scored.join(cuts, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
            .withColumn("lang_threshold", F.coalesce("lang_threshold", F.lit(threshold)))
            .select("doc_id", "held_out", "score", "predicted", "lang", "lang_threshold",
                    (F.col("score") >= F.col("lang_threshold")).alias("flagged")))
