import brute
import pytest
from conftest import SF_SMALL

import corpus_pipeline
from oracle_compare import compare, duck
from salesmart.llm import markov_secrets, subword_classifier
from salesmart.llm.common import table
from salesmart.llm.queries import llm_queries
from salesmart.llm.sql import llm_sql


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_matches_sql(spark, con, name):
    ok, report = compare(llm_queries()[name](spark, SF_SMALL), con, llm_sql()[name])
    assert ok, report


#: What the queries must return at least.
COLUMNS = {
    "op1": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id held_out score predicted", "op5": "doc_id held_out score predicted",
    "op7": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op8": "doc_id n_assign n_access n_hex base_sha256 spans", "op9": "doc_id fingerprint component_id",
    "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13": "doc_id held_out n_tokens n_known train_tokens base_score score",
}


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_columns_and_rows(spark, op):
    name = next(n for n in llm_queries() if n.startswith(f"{op}_"))
    got = llm_queries()[name](spark, SF_SMALL)
    assert set(COLUMNS[op].split()) <= set(got.columns)
    docs = table(spark, SF_SMALL, "documents")
    if op == "op7":
        want = {r.doc_id for r in docs.collect()}
        assert {r.doc_id for r in got.collect()} == want
    else:
        assert got.count() == docs.count()
    if op == "op9":
        rows, found = docs.collect(), {r.doc_id: r for r in got.collect()}
        fps = [brute.fingerprint(r.text) for r in rows]
        root = brute.groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
        least = {}
        for r, g in zip(rows, root):
            least[g] = min(r.doc_id, least.get(g, r.doc_id))
        for r, f, g in zip(rows, fps, root):
            assert (found[r.doc_id].fingerprint, found[r.doc_id].component_id) == (f"{f:016x}", least[g])


def _stages_by_hand(docs, model, bench, secret):
    """The filtering stages of the pipeline in plain Python, with the fitted models given."""
    docs = [r for r in docs if model.score(r.text) >= 0.3]
    yield docs
    fps = [brute.fingerprint(r.text) for r in docs]
    root = brute.groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, g in zip(docs, root):
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    docs = [r for r, g in zip(docs, root) if r.doc_id == least[g]]
    yield docs
    docs = [r for r in docs if not brute.contained([(r.doc_id, r.text)], bench)]
    yield docs


def test_pipeline_stages_match_plain_python(spark):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    model = subword_classifier.fit(docs, table(spark, SF_SMALL, "labels"))
    want = _stages_by_hand(docs.collect(), model, [tuple(r) for r in bench.select("item_id", "text").collect()], None)
    left = docs
    for (name, stage), rows in zip(corpus_pipeline.STAGES, want):
        left = stage(spark, left, SF_SMALL)
        assert left.columns == docs.columns
        assert sorted(left.collect()) == sorted(rows), name
    secret = markov_secrets.fit(left)
    masked = corpus_pipeline.STAGES[3][1](spark, left, SF_SMALL)
    assert masked.columns == docs.columns
    assert {r.doc_id: r.text for r in masked.collect()} == {
        r.doc_id: markov_secrets.masked(r.text, secret.spans(r.text)) for r in rows}
    packed = corpus_pipeline.STAGES[4][1](spark, masked, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}


def test_pipeline_over_odd_and_empty_tables(spark, tmp_path):
    docs, rows = brute.odd_documents(spark)
    for name, given in (("odd", docs), ("empty", brute.empty_documents(spark))):
        given.write.parquet(str(tmp_path / name / "documents.parquet"))
        for t in ("labels", "benchmark"):
            table(spark, SF_SMALL, t).write.parquet(str(tmp_path / name / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "odd")).count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
