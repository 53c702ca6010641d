import math

import numpy as np
import pytest
from conftest import SF_SMALL

from salesmart.llm import whitening
from salesmart.llm.common import table
from salesmart.llm.queries import llm_queries

COLUMNS = "vec_id component n deviation whitened explained identity_error".split()


def by_hand(rows, components=16):
    """Brute force in numpy and Python integers over (vec_id, embedding) pairs of one length."""
    good = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in good})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, x in good:
        moved = np.array([(n * c - s) / n for c, s in zip(x, sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        out.setdefault(i, []).append((deviation, moved @ vectors / np.sqrt(values)))
    return n, out, values / np.trace(covariance)


def check(got, rows, components=16):
    n, want, shares = by_hand(rows, components)
    assert sum(len(v) for v in want.values()) * len(shares) == len(got)
    signs = {}
    for r in got:
        deviation, white = want[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
        value = white[r.component - 1]
        assert abs(r.whitened) == pytest.approx(abs(value), rel=1e-7, abs=1e-9)
        if abs(value) > 1e-6:  # one sign for all rows
            signs.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(value))
    assert all(len(s) == 1 for s in signs.values())


def test_query_against_brute_force(spark):
    got = llm_queries()["op11_embedding_whitening"](spark, SF_SMALL)
    assert got.columns == COLUMNS
    check(got.collect(), [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # one common vector
    odd = [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4),
           (204, [1e300] * 4), (205, [1.0]), (206, [])]
    given = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS index", "2 AS x", "3 AS part").repartition(3)
    got = whitening.whitened_rows(given, components=3).collect()
    check(got, rows, 3)
    assert {r.vec_id for r in got} == {i for i, _ in rows}


def test_lower_rank_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (None, [0.5, 0.5])], [(1, [])]):
        got = whitening.whitened_rows(spark.createDataFrame(rows, schema))
        assert got.columns == COLUMNS and got.collect() == []
    line = [(i, [float(i), float(2 * i)]) for i in range(5)] + [(None, [1.0, 2.0])]
    got = whitening.whitened_rows(spark.createDataFrame(line, schema)).collect()
    assert [r.component for r in got] == [1] * 6  # the second component has no variance
    assert {r.n for r in got} == {5} and sum(r.vec_id is None for r in got) == 1


def test_many_blocks_and_far_sums(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_BLOCK_ROWS", (7, 7))
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=5) * (1, 2, 3, 4, 5) + 1e6).tolist()) for i in range(100)]
    got = whitening.whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), 5)
    check(got.collect(), rows, 5)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(1 << 44) * i, 1.0]) for i in range(3)]
    got = whitening.whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in got} == {0: None, 1: 0, 2: None}
