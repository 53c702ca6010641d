import random

import brute
import numpy as np
import pytest

from salesmart.llm import simhash_vptree as S
from salesmart.llm.components import components


def test_fingerprints_match_plain_python(spark):
    docs, rows = brute.odd_documents(spark)
    got = sorted((repr(r.doc_id), r.fp) for r in S.fingerprints(docs).collect())
    want = sorted((repr(r[0]), int(np.array(brute.fingerprint(r[1]), np.uint64).astype(np.int64))) for r in rows)
    assert got == want


def _planted(seed, centers=40, each=6, flips=3):
    rng = random.Random(seed)
    out = set()
    for _ in range(centers):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
    for _ in range(500):
        out.add(rng.getrandbits(64))
    chain = rng.getrandbits(64)
    for b in rng.sample(range(64), 60):  # a chain: neighbours at 4 bits, ends far apart
        chain ^= 1 << b
        out.add(chain)
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [8, 100_000])
def test_trees_lose_no_link(spark, shard_rows):
    fps = _planted(shard_rows)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components(S.near_links(classes, 4, shard_rows=shard_rows)).collect()}
    u = np.array(fps, np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 4
    root = np.arange(len(u))
    while True:
        new = np.where(near, root[None, :], len(u)).min(axis=1)
        if (new == root).all():
            break
        root = new
    want, have = {}, {}
    for i, f in enumerate(signed):
        want.setdefault(int(root[i]), set()).add(f)
        have.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_dense_group_is_searched_without_all_pairs():
    base, rng = 0x0123456789ABCDEF, random.Random(5)
    fps = np.unique(np.array([base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)] + [base], np.uint64))
    found = S.links(fps, S.windows(4)[0], 1, 4)
    assert len(fps) > 2000 and found.shape[1] <= 40 * len(fps)
    root = {int(f): int(f) for f in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for mask in S.windows(4):
        for a, b in S.links(fps, mask, 1, 4).T:
            root[top(int(a))] = top(int(b))
    assert len({top(int(f)) for f in fps}) == 1 and rng


def test_components_of_chain_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 90)] + [(5, 5), (3, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 90)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _want(rows):
    fps = [brute.fingerprint(r[1]) for r in rows]
    root = brute.groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, g in zip(rows, root):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    return fps, root, least


def test_odd_documents(spark):
    docs, rows = brute.odd_documents(spark)
    _, root, least = _want(rows)
    got = sorted((repr(r.doc_id), repr(r.component_id)) for r in S.near_duplicates(docs).collect())
    assert got == sorted((repr(r[0]), repr(least.get(g))) for r, g in zip(rows, root))


def test_one_row_of_each_group_stays(spark):
    docs, rows = brute.odd_documents(spark)
    _, root, least = _want(rows)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == len(set(root))
    assert sorted(repr(r[0]) for r in got) == sorted(repr(least.get(g)) for g in set(root))
    assert set(got) <= set(rows)


def test_empty_table(spark):
    docs = brute.empty_documents(spark)
    assert S.near_duplicates(docs).count() == 0 and S.keep_one(docs).count() == 0
