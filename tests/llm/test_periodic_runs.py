import hashlib
import zlib

import brute
import numpy as np
import pytest
from conftest import SF_SMALL

from salesmart.llm import periodic_runs
from salesmart.llm.common import table
from salesmart.llm.queries import llm_queries, with_planted_periods


def runs_by_hand(words, least=12):
    """Every maximal stretch of every period, the least period of equal stretches."""
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i > start and i + p - start >= max(least, 2 * p):
                best.setdefault((start, i + p - start), p)
            i += i == start
    return sorted(((s, length, p) for (s, length), p in best.items()), key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted_by_hand(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_sequences(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        n, letters = int(rng.integers(0, 150)), int(rng.integers(1, 5))
        x = rng.integers(0, letters, n)
        if n > 20 and rng.random() < 0.6:
            a = int(rng.integers(0, n))
            x[a:] = x[a + np.arange(n - a) % (1 + (n - a) // int(rng.integers(3, 11)))]
        for least in (2, 12):
            got = [tuple(r) for r in periodic_runs.find_runs(x, least).tolist()]
            assert got == runs_by_hand(x.tolist(), least)


def test_extensions_against_plain_comparison():
    rng = np.random.default_rng(9)
    x = np.concatenate([np.tile(rng.integers(0, 3, 40), 6), rng.integers(0, 2, 60), np.tile(rng.integers(0, 3, 40), 3)])
    common = periodic_runs.Extensions(x)
    a = rng.integers(0, len(x), 4000)
    b = a + 1 + rng.integers(0, len(x), 4000) % (len(x) - a)
    want = [next((k for k in range(len(x)) if j + k >= len(x) or x[i + k] != x[j + k])) for i, j in zip(a, b)]
    assert common(a, b).tolist() == want
    assert max(want) > 100  # the sorted samples were needed


def test_long_texts():
    x = np.zeros(30000, np.int64)
    assert periodic_runs.find_runs(x).tolist() == [[0, 30000, 1]]
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 40, 60000)
    x[10000:50000] = x[10000 + np.arange(40000) % 777]
    assert periodic_runs.find_runs(x).tolist() == [[10000, 40000, 777]]


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in llm_queries()["op12_periodic_runs"](spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(docs)
    periodic = 0
    for d in docs:
        words = planted_by_hand(d.doc_id, d.text)
        if len(words) > 2500:  # the plain search is quadratic; long texts are covered above
            continue
        runs, r = runs_by_hand(words), got[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_hand(words, runs).encode()).hexdigest()
        periodic += bool(runs)
    assert periodic > 10


def test_odd_and_empty_tables(spark):
    line = "one two three four " * 5
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, line), (5, line), (5, line), (6, "x y z " * 40)]
    given = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' AS runs", "1 AS n_words")
    got = sorted(periodic_runs.periodic_runs(given).collect(), key=str)
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_words): (r.runs, r.collapsed) for r in got}
    assert by[1, 0] == by[2, 0] == by[3, 0] == ([], "")
    assert [tuple(r) for r in by[5, 20][0]] == [(0, 20, 4)] and by[5, 20][1] == "one two three four"
    assert by[None, 20] == by[5, 20] and by[6, 80][1] == "x y z"
    assert periodic_runs.periodic_runs(brute.empty_documents(spark)).collect() == []
    assert len(with_planted_periods(given).collect()) == len(rows)
