from zlib import crc32

import brute
import numpy as np
import pytest

from salesmart.llm import cnn_toxicity as C
from salesmart.llm import subword_classifier as W
from salesmart.llm.common import held_out, labelled_sample, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def _quality(rows):
    told = [r for r in rows if r.held_out]
    ones, zeros = [r for r in told if r.label], [r for r in told if not r.label]
    return (np.mean([r.predicted for r in ones]), np.mean([r.predicted for r in zeros]), len(told))


def test_held_out_rows_are_those_of_the_contract(spark):
    ids = [*range(300), -5, 2 ** 40]
    got = {r.i for r in spark.createDataFrame([(i,) for i in ids], "i long").where(held_out(F.col("i"))).collect()}
    assert got == {i for i in ids if crc32(str(i).encode()) % 5 == 0}


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    ids = {t: i for i, t in docs.select("doc_id", "text").collect()}
    sample, counts = labelled_sample(docs, labels, "quality", 50, 5000)
    assert 0 < len(sample) <= 100 and all(len(t) <= 5000 for t, _ in sample)
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.text, set()).add(r.doc_id)
    assert all(any(crc32(str(i).encode()) % 5 for i in texts[t]) for t, _ in sample)
    assert sum(counts.values()) == sum(crc32(str(r.doc_id).encode()) % 5 > 0 for r in labels.collect()) and ids


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = W.scores(docs, W.fit(docs, labels)).join(labels.withColumnRenamed("quality", "label"), "doc_id")
    kept, junk, n = _quality(found.collect())
    assert n > 500 and kept > 0.98 and junk < 0.1


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = C.toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id")
    caught, raised, n = _quality(found.collect())
    assert n > 500 and caught > 0.8 and raised < 0.03  # some 350 toxic rows to learn from, in four languages


def test_scoring_equals_the_plain_average_of_vectors():
    rng = np.random.default_rng(0)
    model = W.Model(rng.normal(size=256).astype(np.float32), 0.25)
    text = "Same same same\nsame line\nsame line\n wörter"
    raw = text.encode()
    found = [f for w in raw.split() for f in W.features(w, 256)]
    found += [crc32(W._SAME_WORD) % 256] * 2 + [crc32(W._SAME_LINE) % 256]
    z = 0.25 + np.mean([model.weights[f] for f in found])
    assert model.score(text) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)
    shares = dict(zip(*W.document_features([text], 256)[0]))
    assert shares == pytest.approx({f: found.count(f) / len(found) for f in set(found)})


def test_convolution_equals_the_plain_form():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(64, 3)).astype(np.float32)
    filters = [rng.normal(size=(w, 3, 2)).astype(np.float32) for w in C.WIDTHS]
    biases, dense = [rng.normal(size=2).astype(np.float32) for _ in C.WIDTHS], rng.normal(size=6).astype(np.float32)
    for n in (0, 1, 2, 3, 50, 9000):
        text = C.words(" ".join(rng.choice(["aa", "bbbbb", "ccc.", "Dd", "eeeeeee"], n)))
        model = C.Model(vectors, filters, biases, dense, 0.1)
        model.prepare([text])
        own = np.array([vectors[list(C.word_buckets(w, 64))].sum(axis=0) for w in text]).reshape(-1, 3)
        pooled = []
        for f, b in zip(filters, biases):
            width = f.shape[0]
            best = [(own[i:i + width, :, None] * f).sum(axis=(0, 1)) for i in range(len(own) - width + 1)]
            pooled.append(np.maximum(0, np.max(best, axis=0) + b) if best else np.zeros(2))
        want = 1 / (1 + np.exp(-(np.concatenate(pooled) @ dense + 0.1)))
        assert model.score(text) == pytest.approx(want, abs=1e-4)


def test_smooth_maximum_and_its_shares():
    rng = np.random.default_rng(3)
    total, text = rng.normal(size=(9, 2)).astype(np.float32), np.array([0, 0, 0, 2, 2, 2, 2, 2, 5])
    for sharpness in (0.5, 20.0, None):
        have, most, place, share = C._pool(total, text, sharpness)
        assert have.tolist() == [0, 2, 5] and place.tolist() == [0] * 3 + [1] * 5 + [2]
        for k, d in enumerate(have):
            own = total[text == d].astype(float)
            want = own.max(axis=0) if sharpness is None else np.log(np.exp(sharpness * own).mean(axis=0)) / sharpness
            assert most[k] == pytest.approx(want, abs=1e-5)
            assert share[text == d].sum(axis=0) == pytest.approx([1, 1], abs=1e-5)


def test_gradients_are_those_of_the_loss():
    """A step against a numerical derivative: the seen squares of a first step give the gradient's size."""
    rng = np.random.default_rng(4)
    texts, y, weight = [rng.integers(0, 16, (n, 4)) for n in (5, 1, 7)], np.array([1, 0, 1], np.float32), np.ones(3, np.float32)

    def parts():
        r = np.random.default_rng(5)
        return (C._Adaptive(r.normal(size=(16, 3))), [C._Adaptive(r.normal(size=(w, 3, 2))) for w in C.WIDTHS],
                [C._Adaptive(r.normal(size=2)) for _ in C.WIDTHS], C._Adaptive(r.normal(size=6)), C._Adaptive(np.zeros(1)))

    def loss(v, f, b, d, bias):
        out = 0.0
        for t, label in zip(texts, y):
            own, hidden = v[t].sum(axis=1), []
            for one, c in zip(f, b):
                n = len(own) - len(one) + 1
                total = sum(own[k:k + n] @ one[k] for k in range(len(one))) if n > 0 else None
                hidden.append(np.maximum(0, np.log(np.exp(2.0 * total).mean(axis=0)) / 2.0 + c) if n > 0 else np.zeros(2))
            z = np.concatenate(hidden) @ d + bias[0]
            out += np.logaddexp(0, -z) if label else np.logaddexp(0, z)
        return out / len(y)

    v, f, b, d, bias = parts()
    C._step(texts, y, weight, v, f, b, d, bias, np.ones(16, bool), 0.0, 2.0)
    for which, at in (("v", (3, 1)), ("v", (9, 0)), ("f", (1, 1, 0)), ("d", (2,)), ("b", (1,))):
        v0, f0, b0, d0, bias0 = parts()
        value, seen = {"v": (v0.value, v.seen), "f": (f0[1].value, f[1].seen), "d": (d0.value, d.seen), "b": (b0[0].value, b[0].seen)}[which]
        ends = []
        for move in (1e-5, -2e-5):
            value[at] += move
            ends.append(loss(v0.value, [x.value for x in f0], [x.value for x in b0], d0.value, bias0.value))
        want = abs(ends[0] - ends[1]) / 2e-5
        assert np.sqrt(seen[at] - np.float32(1e-3)) == pytest.approx(want, abs=2e-3, rel=2e-2)


def _area(z, y):
    """Area under the curve by ranks."""
    rank = np.empty(len(z))
    rank[np.argsort(z, kind="stable")] = np.arange(len(z))
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def test_training_carries_the_toxicity_score():
    """Held-out rows of sf0.1: the random start is near chance, the trained network far from it."""
    import zlib

    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.1"
    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    rows = docs.merge(pq.read_table(f"{sf}/labels.parquet").to_pandas()[["doc_id", "toxic"]].dropna(), on="doc_id")
    out = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id])
    learn, test = rows[~out & (rows.text.str.len() <= 50_000)], rows[out]
    sample = [(t, 1) for t in learn[learn.toxic == 1].text] + [(t, 0) for t in learn[learn.toxic == 0].text[:1200]]
    y, texts = test.toxic.to_numpy().astype(int), [C.words(t) for t in test.text]
    options = dict(buckets=C.BUCKETS, dim=8, per_width=8, rate=0.1, seed=11)
    start = _area(C._logits(C._descend(sample, epochs=0, **options), texts), y)
    trained = _area(C._logits(C._descend(sample, epochs=6, **options), texts), y)
    assert 0.4 < start < 0.6 and trained > 0.95


def test_no_language_column_and_repeated_ids(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} other{i % 2} text") for i in range(40)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = C.toxicity(docs, labels).collect()
    assert len(got) == 80 and all(r.lang is None for r in got)
    sample, _ = labelled_sample(docs, labels, "toxic", 100, 1000)
    assert len(sample) == labels.where("crc32(string(doc_id)) % 5 <> 0").count()  # one text an id


def test_a_full_cache_changes_no_score(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 200, 30)) for _ in range(20)]
    cnn = C.Model(rng.normal(size=(1024, 2)).astype(np.float32), [rng.normal(size=(1, 2, 2)).astype(np.float32)],
                  [np.zeros(2, np.float32)], np.ones(2, np.float32), 0.0)
    avg = W.Model(rng.normal(size=1024).astype(np.float32), 0.0)

    def run():
        out = []
        for t in texts:
            cnn.prepare([C.words(t)])
            out.append((cnn.score(C.words(t)), avg.score(t)))
        return out

    want = run()
    monkeypatch.setattr(C, "CACHE_WORDS", 40)
    monkeypatch.setattr(W, "CACHE_WORDS", 7)
    cnn._clear(40)
    avg._cache.clear()
    assert run() == want


@pytest.mark.parametrize("operator", [W, C])
def test_odd_documents_and_missing_labels(spark, operator):
    docs, rows = brute.odd_documents(spark)
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 45)] + [(None, 1, 1), (7, None, None)],
                                 "doc_id long, quality int, toxic int")
    for labels in (some, some.where("quality = 1"), some.where("doc_id < 0")):
        got = operator.scores(docs, operator.fit(docs, labels)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert not any(r.held_out for r in got if r.doc_id is None)
    none = brute.empty_documents(spark)
    assert operator.scores(none, operator.fit(none, some)).count() == 0
    again = operator.scores(docs, operator.fit(docs, some)).select("doc_id", "score").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, operator.scores(docs, operator.fit(docs, some)).select("doc_id", "score").collect()))


def test_language_thresholds(spark):
    docs, rows = brute.odd_documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 45)], "doc_id long, toxic int")
    got = C.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(r.flagged == (r.score >= r.lang_threshold) for r in got)
    scored = spark.createDataFrame([(i, "en", False, i / 100) for i in range(100)], "doc_id long, lang string, held_out boolean, score double")
    clean = spark.createDataFrame([(i, 0) for i in range(100)], "doc_id long, toxic int")
    cut = C.language_thresholds(scored, clean, most_false=0.05).collect()[0].lang_threshold
    assert sum(i / 100 >= cut for i in range(100)) <= 5 and cut <= 0.96


def test_keep_good_keeps_rows_and_columns(spark):
    docs, rows = brute.odd_documents(spark)
    model = W.Model(np.zeros(64, np.float32), 5.0)
    assert sorted(map(repr, map(tuple, W.keep_good(docs, model).collect()))) == sorted(map(repr, rows))
    assert W.keep_good(docs, W.Model(np.zeros(64, np.float32), -5.0)).count() == 0
