import math
import random

import brute
import pytest

from salesmart.llm import quality_rules as Q


def test_counts_match_plain_python(spark):
    docs, rows = brute.odd_documents(spark, ["a b c d e f g h " * 2, "z " * 8, "p # q\n\n \np # q\nr | <s>", "A\rB\x0bC\x0cD"])
    got = Q.measure(docs).collect()
    assert len(got) == len(rows)
    have = sorted((repr(g.doc_id), *g[3:8]) for g in got)
    assert have == sorted((repr(r[0]), *brute.rule_counts(r[1])) for r in rows)
    for g in got:
        assert g.base_failed == (g.n_words < 20 or 100 * g.n_repeat_words > 30 * g.n_words)


@pytest.mark.parametrize("seed", range(20))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    words = [rng.choice("ab" if seed % 2 else "abcdefgh") for _ in range(rng.randint(0, 200))]
    assert Q.repeated_positions([w.encode() for w in words]) == brute.rule_counts(" ".join(words))[4]


def test_binomial_tail():
    for n, k, p in [(10, 3, 0.2), (50, 0, 0.01), (200, 7, 0.05), (5, 5, 0.5), (3, 9, 0.5)]:
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))
        assert Q.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_stop_at_the_first_failure_and_need_labels():
    none = {r.name: [0] * len(r.cutoffs) for r in Q.RULES}
    assert set(Q.select_cutoffs({"x": (20, none)})["x"].values()) == {None}
    got = Q.select_cutoffs({"x": (5000, none | {"symbols": [0, 0, 4000] + [0] * 21})})["x"]
    assert got["symbols"] == Q.RULES[0].cutoffs[1]  # nothing past the third, though later ones would pass
    assert all(got[r.name] == r.cutoffs[-1] for r in Q.RULES[1:])


def test_false_rejection_is_limited(monkeypatch):
    """Over many draws of labels, the true share of good documents rejected breaks alpha at most delta of the time."""
    rng, alpha, bad, runs = random.Random(4), 0.1, 0, 150
    monkeypatch.setattr(Q, "RULES", (Q.Rule("r", "a", "b", 1, tuple(i / 100 for i in range(99, 0, -1))),))
    for _ in range(runs):
        draw = [rng.random() for _ in range(400)]  # true share above a cutoff c: 1 - c
        k = [sum(d > c for d in draw) for c in Q.RULES[0].cutoffs]
        cut = Q.select_cutoffs({"x": (400, {"r": k})}, alpha=alpha, delta=0.05)["x"]["r"]
        bad += cut is not None and 1 - cut > alpha
    assert bad <= 0.05 * runs + 8


def test_verdict_by_stratum(spark):
    docs, rows = brute.odd_documents(spark)
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    got = Q.risk_controlled(docs, labels)
    assert got.count() == len(rows)
    assert got.where("kept = base_failed").count() == 0  # too few labels: only the base rules speak
    cuts = {"en": {r.name: 0.0 if r.sign > 0 else 99.0 for r in Q.RULES}}
    measured = Q.measure(docs)
    told = Q.apply_cutoffs(measured, cuts)
    assert told.where("kept AND stratum = 'en'").count() == 0
    assert told.where("kept AND stratum IS NULL").count() == measured.where("NOT base_failed AND stratum IS NULL").count() > 0


def test_junk_goes_and_clean_stays(spark):
    from salesmart.llm.common import table
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = Q.risk_controlled(docs, labels).join(labels, "doc_id").where("NOT base_failed").collect()
    good, junk = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.95
    assert sum(r.kept for r in junk) / len(junk) < 0.5


def test_without_labels_rows_or_stratum(spark):
    docs, rows = brute.odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.risk_controlled(docs, none).where("kept = base_failed").count() == 0
    assert Q.risk_controlled(brute.empty_documents(spark), none).count() == 0
    assert Q.measure(docs.drop("lang")).where("stratum IS NULL").count() == len(rows)
    kept = Q.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == Q.risk_controlled(docs, none).where("kept").count()
