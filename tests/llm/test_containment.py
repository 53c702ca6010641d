import brute
import duckdb
import pyarrow as pa
import pytest

from salesmart.llm import benchmark_containment as B
from salesmart.llm.sql import llm_sql


def _tables(spark):
    _, rows = brute.odd_documents(spark)
    prose = [r[1] for r in rows if r[1] and 15 <= len(r[1].split()) <= 80]
    items = [(i, " ".join(t.split()[:10 + 5 * i])) for i, t in enumerate(prose[:6])]
    changed = items[4][1].split()
    changed[3] = "changed"  # five of the shingles are lost
    items += [(20, None), (21, ""), (22, "two words"), (23, "short"), (4, " ".join(changed)), (0, items[0][1]),
              (25, rows[10][1][:3000]), (26, items[5][1].upper())]
    planted = [f"{prose[7]} {items[2][1]} {prose[8]}", " ".join(changed), f"x {items[5][1]}", "Two   Words"]
    docs, rows = brute.odd_documents(spark, planted)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return docs, rows, bench, items


@pytest.mark.parametrize("share", [0.8, 0.3, 1.0])
def test_matches_brute_force(spark, share):
    docs, rows, bench, items = _tables(spark)
    got = {(r.doc_id, r.item_id, r.shared, r.n_shingles) for r in B.contained_items(docs, bench, share=share).collect()}
    want = brute.contained([(r[0], r[1]) for r in rows], items, share=share)
    assert got == want and len(want) > 8


def test_contaminated_rows_go_and_others_stay(spark):
    docs, rows, bench, items = _tables(spark)
    bad = [r for r in rows if brute.contained([(r[0], r[1])], items)]
    got = B.remove_contaminated(docs, bench)
    assert got.columns == docs.columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(r) for r in rows if r not in bad)


def test_a_short_item_in_a_long_document_and_a_hot_passage(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"f{i}" for i in range(60_000))
    docs = spark.createDataFrame([(i, f"{passage} tail{i}") for i in range(300)] + [(999, f"{long} {passage} {long}")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = B.contained_items(docs, bench).collect()
    assert len(got) == 301 and all((r.shared, r.n_shingles) == (16, 16) for r in got)


def test_items_without_an_id_are_found(spark):
    one, two, both = (" ".join(f"{c}{i}" for i in range(20)) for c in "xyz")
    docs = spark.createDataFrame([(1, f"head {one} tail"), (2, f"head {two} tail"), (3, "nothing of it at all here"),
                                  (None, f"{both} tail")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, one), (None, two), (None, two), (7, two), (None, both), (None, None)],
                                  "item_id long, text string")
    got = B.contained_items(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id, r.shared, r.n_shingles) for r in got), key=repr) == sorted(
        [(1, None, 16, 16), (2, None, 16, 16), (2, 7, 16, 16), (None, None, 16, 16)], key=repr)
    assert [r.doc_id for r in B.remove_contaminated(docs, bench).collect()] == [3]


def test_items_below_a_shingle_are_found_in_longer_documents(spark):
    texts = ["the quick brown fox jumps over it", "Quick  Brown", "brown quick", "a quick brown", "quick brownish fox", "fox",
             "over the fox jumps", "one two three four five six", "two three four", "", None]
    items = [(1, "quick brown"), (2, "FOX"), (3, "fox jumps over it"), (4, "two three four"), (5, "one two three four five"),
             (6, "jumps fox over"), (7, ""), (8, None)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text in enumerate(texts):
        for i, item in items:
            if item and f" {' '.join(item.lower().split())} " in f" {' '.join((text or '').lower().split())} ":
                want.add((d, i, 1, 1))
    got = {tuple(r) for r in B.contained_items(docs, bench).select("doc_id", "item_id", "shared", "n_shingles").collect()}
    assert got == want and len(want) == 11
    assert {r.doc_id for r in B.remove_contaminated(docs, bench).collect()} == {2, 9, 10}


def test_sql_twin_finds_short_items_and_items_without_an_id(spark):
    long = " ".join(f"w{i}" for i in range(20))
    texts = [f"head {long} tail", "the quick brown fox jumps over it", "Quick  Brown", "brown quick", "fox", "", None,
             " ".join(long.split()[:17]), f"fox {long.upper()}", "x one two three four five"]
    docs = [*enumerate(texts), (None, f"quick brown {long}"), (None, None), (4, "fox"), (3, "another quick brown")]
    items = [(1, "quick brown"), (None, "FOX"), (None, long), (7, long), (7, "jumps over it"), (8, None), (9, " "),
             (10, "one two three four five"), (11, "a fox"), (1, "quick brown")]
    got = B.contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string"))
    db = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        ids, body = zip(*rows)
        db.register(name, pa.table({key: pa.array(ids, pa.int64()), "text": pa.array(body, pa.string())}))
    want = db.sql(llm_sql()["op10_benchmark_containment"]).fetchall()
    columns = ["doc_id", "item_id", "shared", "n_shingles"]
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want))
    assert len(want) > 12 and {(0, None, 16, 16), (8, None, 1, 1), (7, 7, 13, 16), (1, 7, 1, 1)} <= set(want)


def test_empty_tables(spark):
    docs, _, bench, _ = _tables(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert B.contained_items(brute.empty_documents(spark), bench).count() == 0
    assert B.contained_items(docs, none).count() == 0
    assert B.remove_contaminated(docs, none).count() == docs.count()


def test_main_path_has_no_python(spark):
    docs, _, bench, _ = _tables(spark)
    plan = B.contained_items(docs, bench)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
