import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from salesmart.llm import backoff_automaton as lm
from salesmart.llm.common import table
from salesmart.llm.queries import llm_queries

BEGIN, END = "<begin>", "<end>"


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


class ByHand:
    """The same model from its formula, with dictionaries of whole n-grams."""

    def __init__(self, train, order, prior):
        self.order, self.prior, self.grams = order, prior, Counter()
        for text in train:
            t = [BEGIN, *tokens(text)]
            for k in range(1, order + 1):
                self.grams.update(tuple(t[i - k + 1:i + 1]) for i in range(k - 1, len(t)))
        self.known = {g[0]: c for g, c in self.grams.items() if len(g) == 1 and g[0] != BEGIN}
        self.n, self.v = sum(self.known.values()), len(self.known)

    def base(self, w, less=0):
        return (max(self.known.get(w, 0) - less, 0) + 0.5) / (self.n - less + 0.5 * (self.v + 1))

    def p(self, w, h, less=0):
        if not h:
            return self.base(w, less)
        c, all_ = max(self.grams[(*h, w)] - less, 0), max(self.grams[h] - less, 0)
        return (c + self.prior * self.p(w, h[1:], less)) / (all_ + self.prior)

    def score(self, text, less=0):
        t = [BEGIN, *tokens(text)]
        return sum(math.log10(self.p(t[i], tuple(t[max(0, i - self.order + 1):i]), less)) for i in range(1, len(t)))


def chosen(train, order):
    found = [ByHand(train, order, m) for m in lm.PRIORS]
    return max(found, key=lambda f: (sum(f.score(t, 1) for t in train), -f.prior))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 1


def check(got, docs, order):
    train = [t for i, t in docs if not held(i)]
    model = chosen(train, order)
    want = sorted((i, held(i), len(tokens(t)), sum(w in model.known for w in tokens(t)),
                   sum(math.log10(model.base(w)) for w in tokens(t)), model.score(t)) for i, t in docs)
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score, r.train_tokens, r.prior) for r in got)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[6:] == (model.n, model.prior)
        assert g[4:6] == pytest.approx(w[4:6], rel=1e-9, abs=1e-9)


def test_query_against_brute_force(spark):
    got = llm_queries()["op13_backoff_scores"](spark, SF_SMALL).collect()
    check(got, [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()], 2)
    held_rows = [r for r in got if r.held_out]
    per_token = [sum(getattr(r, c) for r in held_rows) / sum(r.n_tokens for r in held_rows) for c in ("base_score", "score")]
    assert per_token[1] > per_token[0] + 0.05  # contexts help on texts that were not learnt


@pytest.mark.parametrize("order", (1, 2, 3))
def test_orders_blocks_and_odd_rows(spark, order):
    rng = np.random.default_rng(order)
    docs = [(i, " ".join(rng.choice(list("abcdefgh"), rng.integers(0, 40)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \t"), (103, "A a É é unseen"), (104, "a b " * 3000)] + [(7, "a b c")] * 3
    given = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS score")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    check(lm.document_scores(given.repartition(4), out, order).collect(), docs, order)


def test_no_training_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = lm.document_scores(docs, F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 2
    got = lm.document_scores(docs, F.lit(None).cast("boolean")).collect()
    assert {(r.doc_id, r.held_out, r.train_tokens) for r in got} == {(None, False, 4)}
    assert lm.document_scores(brute.empty_documents(spark), F.lit(False)).collect() == []


def test_weights_of_a_state_sum_to_one():
    rng = np.random.default_rng(0)
    train = [" ".join(rng.choice(list("abcde"), 12)) for _ in range(20)]
    for model in (ByHand(train, 3, m) for m in lm.PRIORS):
        for h in ((), ("a",), ("a", "b"), (BEGIN, "c"), ("zz", "a")):
            assert sum(model.p(w, h) for w in [*model.known, "never seen"]) == pytest.approx(1)


def _block(texts, out):
    rows = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "held": out, "text": texts})
    lm.TaskContext, kept = type("One", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda s: 0})())}), lm.TaskContext
    try:
        return [b.to_pylist()[0] for b in lm._gather(iter([rows]))]
    finally:
        lm.TaskContext = kept


@pytest.mark.parametrize("order", (1, 2, 3))
def test_traversal_in_parts_and_the_closed_form(monkeypatch, order):
    """The states carried along give what the n-gram probabilities give position by position."""
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("abcdefghij"), rng.integers(0, 60))) for _ in range(50)]
    out = [i % 5 == 1 for i in range(50)]
    monkeypatch.setattr(lm, "_READ_TOKENS", 100)
    (row,) = _block(texts, out)
    block = lm.Block(row, order)
    model = ByHand([t for t, h in zip(texts, out) if not h], order, lm.PRIORS[1])
    scorer = lm.Scorer(block, block.counts(), model.n, model.v, lm.PRIORS)
    assert scorer.read()[1] == pytest.approx([model.score(t) for t in texts])
    left = [0.0 if h else model.score(t, 1) for t, h in zip(texts, out)]
    assert scorer.left_out()[1] == pytest.approx(left)


def test_blocks_are_cut_between_documents(monkeypatch):
    monkeypatch.setattr(lm, "_BLOCK_TOKENS", 5)
    blocks = _block(["a b c", "d", "e f g h i j k l", None], [False] * 4)
    assert [b["doc_id"] for b in blocks] == [[0, 1], [2], [3]] and len({b["block"] for b in blocks}) == 3
    assert [b["size"] for b in blocks] == [[4, 2], [9], [1]]


def test_packed_arrays_round_trip():
    for values in (np.zeros(0, np.uint64), np.array([0, 1, (1 << 64) - 1], np.uint64), np.arange(1000, dtype=np.uint32)):
        assert (lm._unpack(lm._pack(values), values.dtype) == values).all()


def test_a_block_takes_little_memory_for_each_token():
    import tracemalloc
    rng = np.random.default_rng(3)
    size, words = 400, rng.integers(2, 2 ** 63, 30_000).astype(np.uint64)
    row = {"doc_id": list(range(1000)), "held": [False] * 1000, "size": [size] * 1000, "words": lm._pack(words),
           "tokens": lm._pack(rng.integers(1, len(words), 1000 * size).astype(np.uint32))}
    asked = pa.table({"bucket": pa.array([0, 0], pa.int32()), "block": [1, 2],
                      "keys": [lm._pack(np.full(200_000, k, np.uint64)) for k in (3, 5)],
                      "counts": [lm._pack(np.full(200_000, 2, np.uint32))] * 2})
    tracemalloc.start()
    block = lm.Block(row, 2)
    held, most = tracemalloc.get_traced_memory()
    assert len(block.keys) > 350_000 and held < 50 * 1000 * size and most < 75 * 1000 * size
    del block
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    totals = [lm._unpack(t, np.int64) for t in lm._answer(asked)["totals"].to_pylist()]
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert most < 60 * 400_000
    assert totals[0][:5].tolist() == [2, 2, 2, 2, 4] and totals[1][:3].tolist() == [2, 2, 4]
