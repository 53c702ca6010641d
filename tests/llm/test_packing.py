import random

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesmart.llm import best_fit_packing as P2
from salesmart.llm import histogram_packing as P7
from salesmart.llm.common import table
from salesmart.llm.token_ids import TokenEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


TRICKY = ["", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a\n b", "\n a\n\n b ", "it's we'll 12 345", "a\tb \tc", "  x  y",
          "x　 y", "a<|endoftext|>b", " <|endoftext|> ", "nul\0 byte \0", "中文 \U0001f600 \U0001f600", "don't\r\n stop",
          "\x1c x\x1d y", "\x85 z", "é à"]


def test_chunked_ids_equal_whole_ids(spark):
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choices(" \n\ta1.'é ", k=rng.randint(1, 40))) for _ in range(3000)]
    texts += [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = TokenEncoder(PATH).encode(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == ids_of(t), repr(t[:80])


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_decreasing_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 400))]
    rows = P2.best_fit_decreasing(lengths, capacity)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    room: list[int] = []
    for n in sorted(lengths, reverse=True):  # the plain form: scan all open rows
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            k = min(fits, key=lambda k: room[k])
            room[k] -= n
        else:
            room.append(capacity - n)
    assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(room)


def _check_rows(rows, want, capacity):
    back: dict = {}
    for r in rows:
        ids, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == capacity and r.cu_seqlens[-1] == r.n_tokens <= capacity
        assert (ids[r.n_tokens:] == 50256).all() and not places[r.n_tokens:].any()
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            back.setdefault(doc, []).append((start, ids[a:b].tolist()))
    assert len({r.sequence_id for r in rows}) == len(rows)
    joined = {d: [i for _, part in sorted(p) for i in part] for d, p in back.items()}
    assert joined == want


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_best_fit_round_trip(spark, block_rows):
    docs, rows = brute.odd_documents(spark, TRICKY)
    once = {r[0]: r for r in rows if r[0] is not None}
    docs = spark.createDataFrame(list(once.values()), docs.schema).repartition(3)
    got = P2.packed_rows(docs, PATH, capacity=512, block_rows=block_rows).collect()
    _check_rows(got, {i: ids_of(r[1]) + [50256] for i, r in once.items()}, 512)


def test_repeated_rows_and_null_ids_are_packed_each(spark):
    docs, rows = brute.odd_documents(spark)
    got = P2.packed_rows(docs, PATH, capacity=256).collect()
    assert sum(r.n_tokens for r in got) == sum(len(ids_of(r[1])) + 1 for r in rows)
    placed = P7.packed_documents(docs, PATH, 256).collect()
    assert sum(r.length for r in placed) == sum(len(ids_of(r[1])) + 1 for r in rows)


def test_empty_tables(spark):
    none = brute.empty_documents(spark)
    assert P2.packed_rows(none, PATH).count() == 0 and P7.packed_documents(none, PATH).count() == 0


def _places(histogram, capacity):
    out: dict = {}
    for length, lo, hi, first, copies, at in P7.plan_patterns(histogram, capacity):
        for rank in range(lo, hi):
            q = rank - lo
            out[length, rank] = (first + q // copies, at + q % copies * length)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_patterns_place_every_rank_once_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 100, 1024])
    histogram = {rng.randint(1, capacity): rng.randint(1, 300) for _ in range(rng.randint(1, 60))}
    places = _places(histogram, capacity)
    assert set(places) == {(n, r) for n, c in histogram.items() for r in range(c)}
    rows: dict = {}
    for (n, _), (row, at) in places.items():
        rows.setdefault(row, []).append((at, n))
    for held in rows.values():
        end = 0
        for at, n in sorted(held):
            assert at == end
            end += n
        assert end <= capacity
    assert sorted(rows) == list(range(len(rows)))


def test_patterns_pack_tightly():
    rng = random.Random(2)
    histogram: dict = {}
    for _ in range(200_000):
        n = rng.randint(1, 1024)
        histogram[n] = histogram.get(n, 0) + 1
    runs = P7.plan_patterns(histogram, 1024)
    rows = 1 + max(first + (hi - lo - 1) // copies for _, lo, hi, first, copies, _ in runs)
    assert sum(n * c for n, c in histogram.items()) / (1024 * rows) > 0.985
    assert P7.plan_patterns({1: 10_000}, 1024) and len(_places({1: 10_000}, 1024)) == 10_000
    assert len({row for row, _ in _places({1: 10_240}, 1024).values()}) == 10


@pytest.mark.parametrize("scale", [1, 10 ** 4, 10 ** 9])
def test_patterns_do_not_grow_with_the_corpus(scale):
    """What is broadcast follows the number of lengths, not of documents."""
    rng = random.Random(3)
    histogram = {n: scale * rng.randint(1, 400) + rng.randint(0, scale) for n in range(1, 1025)}
    assert len(P7.plan_patterns(histogram, 1024)) < 16 * 1024


def test_histogram_packing_round_trip(spark):
    docs, rows = brute.odd_documents(spark, TRICKY)
    once = {r[0]: r for r in rows if r[0] is not None}
    docs = spark.createDataFrame(list(once.values()), docs.schema).repartition(4)
    got = P7.packed_documents(docs, PATH, 128).collect()
    want = {i: ids_of(r[1]) + [0] for i, r in once.items()}
    back: dict = {}
    sequences: dict = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.doc_tokens == len(want[r.doc_id])
        back.setdefault(r.doc_id, []).append((r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {d: [i for _, p in sorted(v) for i in p] for d, v in back.items()} == want
    for held in sequences.values():
        end = 0
        for at, n in sorted(held):
            assert at == end
            end += n
        assert end <= 128
