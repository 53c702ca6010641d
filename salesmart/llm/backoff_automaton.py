"""N-gram scoring by a weighted backoff automaton whose arcs are fetched for each block of documents.

Model: smoothed n-grams.  With c for counts in the training documents, h for a
context and h' for the same context without its first token,

    p(w | h) = (c(hw) + m * p(w | h')) / (c(h) + m),

and at the root p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)), where V distinct
tokens and one unknown share the mass.  Each context seen is a state; each
n-gram seen is an arc of weight p; an unseen token leaves a state by its
failure arc of weight m / (c(h) + m) towards h'.  The weights of a state sum to
one.  m is the one of ``priors`` that gives the training documents the greatest
leave-one-out probability.

The model grows with the corpus and is never in one place:

1. Tasks turn documents into blocks of tokens, written to the shared folder.
2. A block sends each of its distinct n-grams (63-bit hashes) once, with its
   own count, to the hash's bucket.  A bucket adds up the counts of all blocks
   and answers each block in the order of its question.
3. A block with its answers is the part of the automaton that its documents can
   reach.  Each document is read once from left to right; the state is carried
   along and the weights of the arcs taken are added up.

Words are told apart by 64-bit hashes.  A frequent n-gram is asked for at most
once by a block, so no key is hot.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_arrow, ship_package, slices, stored

#: Tokens of a block, but for a longer document, which is one of its own.
_BLOCK_TOKENS = 1 << 21
#: Questions that a bucket answers, about, and the least number of buckets.
_BUCKET_KEYS, _LEAST_BUCKETS = 4_000_000, 64
#: Tokens whose arcs are held in Python objects at a time.
_READ_TOKENS = 1 << 15
#: Begin and end of a text; no word holds a blank.
_BEGIN, _END = b"\t", b"\n"

PRIORS = (10.0, 100.0, 1000.0, 10000.0)


def _pack(values: np.ndarray) -> bytes:
    """An array by byte planes, compressed: high bytes are mostly zero."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes, kind) -> np.ndarray:
    size, wide = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size * wide, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(wide, size).T).reshape(-1).view(kind)


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashes, in order (the finish of a public 64-bit mixer)."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BLOCKS = ("block long, n_tokens long, n_train long, doc_id array<bigint>, held array<boolean>, size array<bigint>, "
          "words binary, tokens binary")
_ARROW_BLOCKS = pa.schema([
    ("block", pa.int64()), ("n_tokens", pa.int64()), ("n_train", pa.int64()), ("doc_id", pa.list_(pa.int64())),
    ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary())])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held, text) to blocks: local word numbers, and the words' hashes."""
    task, made = TaskContext.get().partitionId(), 0

    def block():
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        total = sum(sizes)
        return pa.RecordBatch.from_pydict({
            "block": [(task << 32) + made], "n_tokens": [total],
            "n_train": [sum(n for n, h in zip(sizes, held) if not h)], "doc_id": [ids], "held": [held], "size": [sizes],
            "words": [_pack(words)], "tokens": [_pack(np.frombuffer(tokens, np.uint32))]}, schema=_ARROW_BLOCKS)

    known, tokens, ids, held, sizes = {_BEGIN: 0, _END: 1}, array("I"), [], [], []
    for piece in slices(batches):
        for doc_id, out, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(),
                                     piece.column(2).cast(pa.binary()).to_pylist()):
            words = (text or b"").lower().split()  # of bytes: A-Z only, and exactly the blanks 0x20 and 0x09-0x0D
            tokens.extend([known.setdefault(w, len(known)) for w in words])
            tokens.append(1)
            ids.append(doc_id)
            held.append(out)
            sizes.append(len(words) + 1)
            if len(tokens) >= _BLOCK_TOKENS:
                yield block()
                made += 1
                known, tokens, ids, held, sizes = {_BEGIN: 0, _END: 1}, array("I"), [], [], []
    if ids:
        yield block()


class _Grams(NamedTuple):
    """Distinct n-grams of one order in a block."""
    at: np.ndarray       # n-gram that ends at each position; -1: none
    context: np.ndarray  # its first tokens, as an n-gram one order lower
    word: np.ndarray     # its last token
    suffix: np.ndarray   # its last tokens, as an n-gram one order lower


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts the values; in it, the number of each one's distinct value, and where these begin."""
    order = np.argsort(values)
    values = values[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])[:len(values)]
    return order, np.cumsum(new, dtype=np.int32) - np.int32(1), np.flatnonzero(new)


class Block:
    """A block's n-grams; every document has its begin before its tokens.

    Positions and n-grams are numbered in 32 bits: a text has below 2 ** 31 bytes.
    """

    def __init__(self, row: dict, order: int):
        self.doc_id, self.held, self.size = row["doc_id"], np.array(row["held"], bool), np.array(row["size"], np.int64)
        self.words, tokens = _unpack(row["words"], np.uint64), _unpack(row["tokens"], np.uint32)
        self.first = np.concatenate([[0], np.cumsum(self.size + 1)])  # begins, and the end of the block
        self.x = np.zeros(self.first[-1], np.int32)
        place = np.ones(len(self.x), bool)
        place[self.first[:-1]] = False
        self.x[place] = tokens
        del place, tokens
        self.inside = np.arange(len(self.x), dtype=np.int32) - np.repeat(self.first[:-1].astype(np.int32), self.size + 1)
        self.train = np.repeat(~self.held, self.size + 1)
        wide, ones = len(self.words), np.arange(len(self.words), dtype=np.int32)
        none = np.zeros(wide, np.int32)
        key = _mix(self.words, np.uint64(1)) | np.uint64(1)  # the last bit marks single tokens
        key[0] &= ~np.uint64(1)  # a begin is a context only
        self.grams, keys = [_Grams(self.x, none, ones, none)], [key]
        for k in range(2, order + 1):
            low, at = self.grams[-1], np.full(len(self.x), -1, np.int32)
            ends = np.flatnonzero(self.inside >= k - 1).astype(np.int32)
            by, rank, begins = _ranks(low.at[ends - 1].astype(np.int64) * wide + self.x[ends])
            ends = ends[by]
            del by
            at[ends] = rank
            some = ends[begins]  # a position of each
            del ends, rank, begins
            context, word = low.at[some - 1], self.x[some]
            self.grams.append(_Grams(at, context, word, low.at[some]))
            keys.append(_mix(keys[-1][context], self.words[word]) & ~np.uint64(1))
        keys = np.concatenate(keys)
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]

    def counts(self) -> np.ndarray:
        """Counts in the block's training documents, in the order of ``keys``."""
        own = []
        for g in self.grams:
            seen = g.at[self.train & (g.at >= 0)]
            own.append(np.bincount(seen, minlength=len(g.word)))
        return np.concatenate(own)[self.order]

    def by_order(self, totals: np.ndarray) -> list[np.ndarray]:
        """Totals in the order of ``keys``, for the n-grams of each order."""
        own = np.empty(len(totals), np.int64)
        own[self.order] = totals
        return np.split(own, np.cumsum([len(g.word) for g in self.grams])[:-1])


def _bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in the sorted keys; buckets are equal ranges of the hash."""
    step = (1 << 64) // buckets
    edges = np.array([step * b for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _questions(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(bucket, block, keys, counts): the sorted distinct n-grams of each block by bucket, with the block's counts."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 1):
            row = piece.to_pylist()[0]
            block = Block(row, order)
            counts, edges = block.counts().astype(np.uint32), _bucket_edges(block.keys, buckets)
            for b in range(buckets):
                i, j = edges[b], edges[b + 1]
                if j > i:
                    steps = np.diff(block.keys[i:j], prepend=np.uint64(0))
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": [b], "block": [row["block"]], "keys": [_pack(steps)], "counts": [_pack(counts[i:j])]},
                        schema=schema)

    return map_arrow(blocks, ask, "bucket int, block long, keys binary, counts binary")


def _answer(asked: pa.Table) -> pa.Table:
    """One bucket: the counts of all blocks added up, and given back to each block in its own order."""
    keys = [np.cumsum(_unpack(k, np.uint64), dtype=np.uint64) for k in asked["keys"].to_pylist()]
    counts = np.concatenate([_unpack(c, np.uint32) for c in asked["counts"].to_pylist()])
    ends = np.cumsum([len(k) for k in keys])[:-1]
    order, rank, begins = _ranks(np.concatenate(keys))
    del keys
    totals = np.empty(len(counts), np.int64)
    totals[order] = np.add.reduceat(counts[order], begins, dtype=np.int64)[rank]
    del order, rank, counts
    return pa.table({"block": asked["block"], "bucket": asked["bucket"],
                     "totals": pa.array([_pack(t) for t in np.split(totals, ends)], pa.binary())})


class Scorer:
    """One block's part of the automaton, and its documents' scores for each prior.

    State 0 is the root, state 1 + w the context of the single token w; longer
    contexts, and the arcs of n-grams, are numbered among the documents read
    at a time.
    """

    def __init__(self, block: Block, totals: np.ndarray, train_tokens: int, train_words: int, priors: tuple[float, ...]):
        self.block, self.priors = block, np.array(priors)[:, None]
        self.n, self.v = train_tokens, train_words
        self.count = block.by_order(totals)
        self.p = (self.count[0] + 0.5) / (self.n + 0.5 * (self.v + 1))  # of single tokens
        self.known = self.count[0] > 0
        self.after = np.where(self.known, 1 + np.arange(len(self.known)), 0).tolist()  # state after a token from the root
        leave = np.log10(self.priors / (self.count[0] + self.priors))
        self.leave = np.concatenate([np.zeros((len(priors), 1)), leave], axis=1)  # failure arcs of root and single tokens
        self.single = np.broadcast_to(np.log10(self.p), leave.shape)

    def base(self) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability by single tokens, and the number of known tokens, of each document."""
        first, at = self.block.first[:-1], self.block.x
        real = self.block.inside > 0
        logs = np.where(real, np.log10(self.p)[at], 0.0)
        return np.add.reduceat(logs, first), np.add.reduceat((real & self.known[at]).astype(np.int64), first)

    def _parts(self) -> Iterator[tuple[int, int]]:
        """Ranges of documents with some ``_READ_TOKENS`` tokens, or one longer document."""
        first, begin, count = self.block.first, 0, len(self.block.size)
        while begin < count:
            end = int(np.searchsorted(first, first[begin] + _READ_TOKENS, side="right")) - 1
            end = min(max(begin + 1, end), count)
            yield begin, end
            begin = end

    def left_out(self) -> np.ndarray:
        """Log10 probability of each training document if each token in turn is not counted; held-out documents: 0."""
        return np.concatenate([self._left_out(*part) for part in self._parts()], axis=1)

    def _left_out(self, begin: int, end: int) -> np.ndarray:
        block = self.block
        low, high = block.first[begin], block.first[end]
        one = np.maximum(self.count[0][block.x[low:high]] - 1, 0) + 0.5
        p = np.tile(one / max(self.n - 1 + 0.5 * (self.v + 1), 0.5), (len(self.priors), 1))
        for k, g in enumerate(block.grams[1:], 1):
            here = np.flatnonzero(g.at[low:high] >= 0)
            gram = g.at[low:high][here]
            mine, context = (np.maximum(c - 1, 0) for c in (self.count[k][gram], self.count[k - 1][g.context[gram]]))
            p[:, here] = (mine + self.priors * p[:, here]) / (context + self.priors)
        logs = np.where(block.train[low:high] & (block.inside[low:high] > 0), np.log10(p), 0.0)
        return np.add.reduceat(logs, block.first[begin:end] - low, axis=1)

    def read(self) -> np.ndarray:
        """Log10 probability of each document by traversal, for each prior."""
        return np.concatenate([self._read(*part) for part in self._parts()], axis=1)

    def _read(self, begin: int, end: int) -> np.ndarray:
        block, top, wide = self.block, len(self.block.grams), len(self.known)
        low, high = block.first[begin], block.first[end]
        arcs: dict[int, int] = {}  # by state and token
        target, fail = [], {}      # state after an arc; state after the failure arc, if it is not the root
        weight, leave = [], []     # of arcs; of failure arcs
        held, lower, made = None, self.p[None, :], 0  # n-grams of the order below, their weights, arcs before them
        for k in range(1, top):
            g, mask = block.grams[k], np.zeros(len(block.grams[k].word), bool)
            at = g.at[low:high]
            mask[at[at >= 0]] = True
            mine = np.flatnonzero(mask)
            if k == 1:
                source, shorter, weights = 1 + g.context[mine].astype(np.int64), 1 + g.suffix[mine], lower[:, g.suffix[mine]]
            else:
                begun, after = np.searchsorted(held, g.context[mine]), np.searchsorted(held, g.suffix[mine])
                source, shorter, weights = 1 + wide + made + begun, 1 + wide + made + after, lower[:, after]
                made += len(held)
            count, own = self.count[k][mine], 1 + wide + made + np.arange(len(mine))
            lower = (count + self.priors * weights) / (self.count[k - 1][g.context[mine]] + self.priors)
            seen = np.flatnonzero(count > 0)
            arcs.update(zip((source[seen] * wide + g.word[mine[seen]]).tolist(), (made + seen).tolist()))
            target += (own if k < top - 1 else shorter).tolist()
            if k < top - 1:
                fail.update(zip(own[seen].tolist(), shorter[seen].tolist()))
            leave.append(np.log10(self.priors / (count + self.priors)))
            weight.append(np.log10(lower))
            held = mine
        weights = np.concatenate([self.leave, *leave, self.single, *weight], axis=1)
        first_root = self.leave.shape[1] + len(target)
        first_arc = first_root + wide
        start = self.after[0] if top > 1 else 0
        after = self.after if top > 1 else [0] * wide
        text, path, ends = block.x[low:high].tolist(), [], [0]
        take, get, shorter = path.append, arcs.get, fail.get
        for d in range(begin, end):
            state = start
            for word in text[block.first[d] - low + 1:block.first[d + 1] - low]:
                while state:
                    arc = get(state * wide + word)
                    if arc is not None:
                        take(first_arc + arc)
                        state = target[arc]
                        break
                    take(state)  # its failure arc
                    state = shorter(state, 0)
                else:  # an arc of the root
                    take(first_root + word)
                    state = after[word]
            ends.append(len(path))
        return np.add.reduceat(weights[:, np.array(path, np.int64)], ends[:-1], axis=1)


def document_scores(documents: DataFrame, held_out: Column, order: int = 2, priors: tuple[float, ...] = PRIORS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, prior), one row for each document.

    Tokens are the words, A-Z in lower case, and one end.  Documents for which
    ``held_out`` is true add nothing to the model; a null there counts as
    false.  A null, empty or blank text has the end alone.  Repeated rows are
    learnt and scored as often as they occur; a null doc_id stays null; other
    columns are not read.  Without training documents every token is unknown
    and has probability 1.  ``prior`` is the m chosen (of equal ones the least).
    """
    ship_package(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                            F.col("text").cast("string").alias("text"))
    blocks = stored(map_arrow(rows, _gather, BLOCKS), "blocks")
    total, n = blocks.agg(F.sum("n_tokens"), F.sum("n_train")).first()
    n, v = n or 0, _known_words(blocks)
    buckets = max(_LEAST_BUCKETS, math.ceil(order * (total or 0) / _BUCKET_KEYS))
    answers = (_questions(blocks, order, buckets).groupBy("bucket")
               .applyInArrow(_answer, "block long, bucket int, totals binary"))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("scores", pa.list_(pa.float64())), ("left_out", pa.list_(pa.float64()))])

    def score(own: pa.Table, given: pa.Table) -> pa.Table:
        block = Block(own.to_pylist()[0], order)
        totals = [(b, _unpack(t, np.int64)) for b, t in zip(given["bucket"].to_pylist(), given["totals"].to_pylist())]
        scorer = Scorer(block, np.concatenate([t for _, t in sorted(totals, key=lambda x: x[0])]), n, v, priors)
        base, known = scorer.base()
        return pa.table({"doc_id": block.doc_id, "held_out": block.held, "n_tokens": block.size, "n_known": known,
                         "base_score": base, "scores": scorer.read().T.tolist(),
                         "left_out": scorer.left_out().T.tolist()}, schema=schema)

    scored = stored(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, "
               "left_out array<double>"), "scores")
    sums = scored.agg(*[F.sum(F.col("left_out")[k]) for k in range(len(priors))]).first()
    best = max(range(len(priors)), key=lambda k: (sums[k] or 0.0, -priors[k]))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", F.col("scores")[best].alias("score"), F.lit(priors[best]).alias("prior"))


def _known_words(blocks: DataFrame) -> int:
    """Distinct tokens of the training documents."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 1):
            row = piece.to_pylist()[0]
            train = np.repeat(~np.array(row["held"], bool), np.array(row["size"], np.int64))
            seen = np.unique(_unpack(row["tokens"], np.uint32)[train])
            yield pa.RecordBatch.from_pydict({"word": _unpack(row["words"], np.uint64)[seen].view(np.int64)})

    return map_arrow(blocks.select("held", "size", "words", "tokens"), words, "word long").distinct().count()
