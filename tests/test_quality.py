"""Data-quality fixtures: each check fails on a bad row and treats NULL as documented."""

import datetime as dt

import pytest

from salesmart.operators.quality import Check, failed_rows, failing_rows, record_run, run_checks, run_suite, run_trend
from salesmart.sources.freshness import Freshness, freshness

AS_OF = "2001-08-15"


def _failures(spark, rows, schema, check, tables=None):
    df = spark.createDataFrame(rows, schema)
    t = {"t": df, **(tables or {})}
    found = {r["check_id"]: r["failures"] for r in run_checks(t, [check], AS_OF).collect()}
    return found[check.check_id]


def test_not_null(spark):
    assert _failures(spark, [(1,), (None,)], "x int", Check("t", "not_null", "x")) == 1


def test_unique_ignores_nulls(spark):
    assert _failures(spark, [(1,), (1,), (2,), (None,), (None,)], "x int", Check("t", "unique", "x")) == 1


def test_accepted_values_counts_distinct_bad_values(spark):
    chk = Check("t", "accepted_values", "x", {"values": [0, 1, 2]})
    assert _failures(spark, [(0,), (3,), (3,), (4,), (None,)], "x int", chk) == 2


def test_accepted_values_on_bit(spark):
    chk = Check("t", "accepted_values", "b", {"values": [0, 1]})
    assert _failures(spark, [(True,), (False,), (None,)], "b boolean", chk) == 0


def test_relationships(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    chk = Check("t", "relationships", "x", {"to": "p", "field": "k"})
    assert _failures(spark, [(1,), (3,), (3,), (None,)], "x int", chk, {"p": parent}) == 2


def test_accepted_range_inclusive_null_passes(spark):
    chk = Check("t", "accepted_range", "x", {"min": 0, "max": 1})
    assert _failures(spark, [(-1.0,), (0.0,), (1.0,), (1.01,), (None,)], "x double", chk) == 2


def test_is_positive(spark):
    assert _failures(spark, [(0,), (-1,), (1,), (None,)], "x int", Check("t", "is_positive", "x")) == 2


def test_no_future_dates_timestamp_later_today_fails(spark):
    rows = [(dt.datetime(2001, 8, 15, 0, 0),), (dt.datetime(2001, 8, 15, 10, 0),),
            (dt.datetime(2001, 8, 16),), (None,)]
    assert _failures(spark, rows, "x timestamp_ntz", Check("t", "no_future_dates", "x")) == 2


def test_valid_date_range(spark):
    d = dt.date
    rows = [(d(2001, 1, 2), d(2001, 1, 1)), (d(2001, 1, 1), d(2001, 1, 1)), (None, d(2000, 1, 1))]
    chk = Check("t", "valid_date_range", None, {"start": "s", "end": "e"})
    assert _failures(spark, rows, "s date, e date", chk) == 1


def test_regex_like_and_table_checks(spark):
    rows = [("ann@mail.com",), ("broken",), (None,)]
    assert _failures(spark, rows, "e string", Check("t", "like", "e", {"pattern": "%_@__%.__%"})) == 1
    assert _failures(spark, rows, "e string", Check("t", "regex", "e", {"pattern": "^[^@]+@[^@]+$"})) == 1
    assert _failures(spark, rows, "e string", Check("t", "row_count_between", None, {"min": 4})) == 1
    assert _failures(spark, rows, "e string", Check("t", "completeness", "e", {"min_share": 0.99})) == 1


def test_failing_rows_reread(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    assert failing_rows(df, Check("t", "is_positive", "x")).count() == 1


@pytest.mark.parametrize("hours, status", [(11, "pass"), (13, "warn"), (25, "error")])
def test_freshness_classes(spark, hours, status):
    ts = dt.datetime(2001, 8, 15) - dt.timedelta(hours=hours)
    df = spark.createDataFrame([(ts,)], "ModifiedDate timestamp_ntz")
    out = freshness({"t": ("s", df, "ModifiedDate", Freshness())}, AS_OF).first()
    assert out["status"] == status and out["age_hours"] == float(hours)


def test_freshness_empty_table_is_error(spark):
    df = spark.createDataFrame([], "ModifiedDate timestamp_ntz")
    assert freshness({"t": ("s", df, "ModifiedDate", Freshness())}, AS_OF).first()["status"] == "error"


def test_freshness_override(spark):
    rule = Freshness(24, 48).override(6, 12)
    assert (rule.warn_hours, rule.error_hours) == (6, 12)
    assert Freshness(24, 48).override(None, 30).warn_hours == 24


def test_case_insensitive_sets_ignore_case_and_trailing_blanks(spark):
    rows = [("R ",), ("m",), ("x",), (None,)]
    chk = Check("t", "in_set", "c", {"values": ["r", "M"], "case_insensitive": True})
    assert _failures(spark, rows, "c string", chk) == 1
    chk = Check("t", "accepted_values", "c", {"values": ["r", "M"], "case_insensitive": True})
    assert _failures(spark, rows, "c string", chk) == 1
    assert _failures(spark, rows, "c string", Check("t", "in_set", "c", {"values": ["r", "M"]})) == 3


def test_all_whole_table_checks_share_one_job_and_absent_tables_fail(spark):
    t = {"t": spark.createDataFrame([(1, dt.datetime(2001, 8, 14)), (3, None)], "x int, at timestamp_ntz")}
    checks = [Check("t", "table_exists"), Check("t", "row_count_between", None, {"min": 2, "max": 2}),
              Check("t", "mean_between", "x", {"min": 3, "max": None}), Check("t", "completeness", "at", {"min_share": 0.9}),
              Check("t", "recency", "at", {"count": 2, "period": "day"}), Check("t", "not_null", "at"),
              Check("t", "column_type", "x", {"type": "int"}), Check("t", "column_exists", "y")]
    group = "one-fused-job"
    spark.sparkContext.setJobGroup(group, group)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    got = [r["failures"] for r in run_checks(t, checks, AS_OF, parallelism=1).collect()]
    assert len(jobs.getJobIdsForGroup()) - before <= 4 and sorted(got) == [0, 0, 0, 0, 1, 1, 1, 1]
    lost = run_checks(t, [Check("gone", "not_null", "x"), Check("gone", "unique", "x")], AS_OF).collect()
    assert [r["status"] for r in lost] == ["fail", "fail"]
    empty = {"t": t["t"].limit(0)}
    assert {r["kind"]: r["failures"] for r in run_checks(empty, checks[:5], AS_OF).collect()} == {
        "table_exists": 0, "row_count_between": 1, "mean_between": 0, "completeness": 1, "recency": 1}


# The declared checks by model and kind.
DECLARED = {
    "dim_customer_metrics": {"accepted_range": 10, "accepted_values": 2, "is_positive": 3, "no_future_dates": 2,
                             "not_null": 8, "unique": 1, "valid_date_range": 1},
    "fct_product_performance": {"accepted_range": 6, "accepted_values": 2, "is_positive": 4, "no_future_dates": 2,
                                "not_null": 11, "relationships": 1, "unique": 1, "valid_date_range": 1},
    "fct_sales_summary": {"accepted_range": 17, "is_positive": 3, "no_future_dates": 1, "not_null": 9},
    "int_customer_orders": {"accepted_range": 1, "accepted_values": 3, "is_positive": 6, "no_future_dates": 5,
                            "not_null": 13, "relationships": 1, "unique": 1, "valid_date_range": 2},
    "int_product_sales": {"accepted_values": 3, "is_positive": 4, "no_future_dates": 8, "not_null": 17,
                          "relationships": 2, "unique": 1, "valid_date_range": 3},
    "stg_customers": {"accepted_values": 1, "no_future_dates": 1, "not_null": 3, "unique": 2},
    "stg_products": {"accepted_range": 3, "accepted_values": 5, "is_positive": 2, "no_future_dates": 4, "not_null": 9,
                     "unique": 2, "valid_date_range": 1},
    "stg_sales_orders": {"accepted_range": 1, "accepted_values": 2, "is_positive": 7, "no_future_dates": 5,
                         "not_null": 10, "relationships": 2, "unique": 1, "valid_date_range": 2},
}


def test_declared_checks_by_model_and_kind():
    from salesmart.operators.rules import declared_checks
    found: dict = {}
    for c in declared_checks():
        kinds = found.setdefault(c.model, {})
        kinds[c.kind] = kinds.get(c.kind, 0) + 1
    assert found == DECLARED


def test_one_bad_check_does_not_end_the_others(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "x int, y string")
    df.write.parquet(str(tmp_path / "gone"))
    gone = spark.read.parquet(str(tmp_path / "gone"))
    import shutil
    shutil.rmtree(tmp_path / "gone")
    checks = [Check("t", "not_null", "x"), Check("t", "not_null", "absent"), Check("t", "unique", "absent"), Check("t", "unique", "x"),
              Check("t", "relationships", "x", {"to": "nowhere", "field": "k"}), Check("gone", "table_exists"), Check("gone", "not_null", "x"),
              Check("never", "unique", "x")]
    got = {r["check_id"]: (r["failures"], r["status"]) for r in run_checks({"t": df, "gone": gone}, checks, AS_OF).collect()}
    assert got == {"t.not_null.x": (1, "fail"), "t.not_null.absent": (None, "error"), "t.unique.absent": (None, "error"),
                   "t.unique.x": (1, "fail"), "t.relationships.x": (None, "error"), "gone.table_exists": (1, "fail"),
                   "gone.not_null.x": (None, "error"), "never.unique.x": (1, "fail")}
    passed, _ = run_suite("s", {"t": df}, [Check("t", "not_null", "absent")], AS_OF)
    assert not passed


def test_uniqueness_checks_share_one_shuffle_and_are_exact(spark, monkeypatch):
    from salesmart.operators import quality
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "b", 2), (None, "c", 3), (None, "d", None), (5, None, None)],
                               "x int, y string, z int")
    checks = [Check("t", "unique", "x"), Check("t", "unique", "y"), Check("t", "unique_combination", None, {"columns": ["x", "y"]}),
              Check("t", "duplicates", None, {"columns": ["z"]})]
    counted = []
    plain = quality._group_check
    monkeypatch.setattr(quality, "_group_check", lambda df, c: counted.append(c.check_id) or plain(df, c))
    got = [r["failures"] for r in run_checks({"t": df}, checks, AS_OF).collect()]
    assert got == [1, 1, 0, 2] and len(counted) == 3  # the combination needs no count by value
    # equal hashes of different keys (nulls are passed over) lead to the exact count, not to a failure
    twins = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    pair = Check("t", "unique_combination", None, {"columns": ["x", "y"]})
    assert quality._repeated_hashes(twins, [pair]) == {0}
    assert run_checks({"t": twins}, [pair], AS_OF).first()["failures"] == 0


def test_failing_rows_of_every_kind(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "b", None), (4, None, 9)], "k int, v string, p int")
    parent = spark.createDataFrame([(1,)], "id int")
    keys = lambda c: sorted(r.k for r in failing_rows(df, c, AS_OF, {"p": parent}).collect())
    assert keys(Check("t", "accepted_values", "v", {"values": ["a"]})) == [2, 3]
    assert keys(Check("t", "unique_combination", None, {"columns": ["v", "p"]})) == [2, 3]
    assert keys(Check("t", "duplicates", None, {"columns": ["p"]})) == [2, 3]
    assert keys(Check("t", "orphans", None, {"columns": ["p"], "fields": ["id"], "to": "p"})) == [4]
    with pytest.raises(ValueError):
        failing_rows(df, Check("t", "row_count_between", None, {"min": 1}))
    assert failed_rows({"t": df}, [Check("t", "not_null", "k"), Check("t", "row_count_between", None, {"min": 9})], {"t": "k"}).count() == 0


def test_history_of_runs_and_trend(spark, tmp_path):
    path = str(tmp_path / "h")
    check = [Check("t", "not_null", "x"), Check("t", "not_null", "y")]
    for run, at, xs in (("r1", "2001-01-01 00:00:00", [None, None]), ("r2", "2001-01-02 00:00:00", [None, 1]),
                        ("r3", "2001-01-03 00:00:00", [1, 1]), ("r4", "2001-01-04 00:00:00", [None, 1]),
                        ("r4", "2001-01-04 00:00:00", [None, 1])):  # a run written twice counts once
        record_run(run_checks({"t": spark.createDataFrame([(x,) for x in xs], "x int")}, check, AS_OF), path, run, at)
    got = {(r.check_id[-1], r.run): (r.failures, r.change, r.trend) for r in run_trend(spark.read.parquet(path)).collect()}
    assert [got["x", f"r{i}"] for i in (1, 2, 3, 4)] == [(2, None, "first"), (1, -1, "better"), (0, -1, "fixed"), (1, 1, "broken")]
    assert got["y", "r2"] == (None, None, "error") and len(got) == 8


def test_spellings_are_one_key_under_a_collation(spark):
    """'AW1 ' and 'aw1' are one key in unique, combination, set and integrity checks and in a join; patterns see the spelling."""
    from salesmart.functions.text import collated
    rows = spark.createDataFrame([("AW1 ", 1), ("aw1", 1), ("aw2", 2), (None, 3)], "a string, n int")
    t = {"t": collated(rows, "a"), "p": collated(spark.createDataFrame([("Aw1",)], "k string"), "k")}
    checks = [Check("t", "unique", "a"), Check("t", "unique_combination", None, {"columns": ["a", "n"]}),
              Check("t", "accepted_values", "a", {"values": ["AW1"]}), Check("t", "relationships", "a", {"to": "p", "field": "k"}),
              Check("t", "regex", "a", {"pattern": "^aw[0-9]$"}), Check("t", "like", "a", {"pattern": "aw%"})]
    found = {r.kind: r.failures for r in run_checks(t, checks, AS_OF).collect()}
    assert found == {"unique": 1, "unique_combination": 1, "accepted_values": 1, "relationships": 1, "regex": 1, "like": 1}
    assert {r.kind: r.failures for r in run_checks({"t": rows}, checks[:2], AS_OF).collect()} == {"unique": 0, "unique_combination": 0}
    spelled = lambda chk: sorted(str(r.a) for r in failing_rows(t["t"], chk, AS_OF, t).collect())
    assert [spelled(c) for c in checks] == [["AW1 ", "aw1"], ["AW1 ", "aw1"], ["aw2"], ["aw2"], ["AW1 "], ["AW1 "]]
    assert t["t"].join(t["p"], t["t"].a == t["p"].k).count() == 2


def test_checks_of_models_on_one_exchange_make_it_once(spark):
    from salesmart.operators.quality import counted_together
    lines = spark.range(1000).selectExpr("id % 100 AS k", "id % 30 AS p").repartition("k")
    tables = {"a": lines.groupBy("k").count(), "b": lines.groupBy("k").agg({"p": "max"}).filter("k < 50"),
              "c": spark.createDataFrame([(i,) for i in range(28)], "p long"), "lines": lines, "none": lines.filter("k < 0")}
    checks = [Check("a", "row_count_between", None, {"min": 101, "max": None}), Check("b", "row_count_between", None, {"min": 1, "max": 49}),
              Check("b", "row_count_between", None, {"min": 50, "max": 50}), Check("lines", "relationships", "p", {"to": "c", "field": "p"}),
              Check("a", "equal_rowcount", None, {"to": "b"}), Check("none", "relationships", "p", {"to": "c", "field": "p"})]
    together = counted_together(tables, checks, AS_OF)
    assert {r["i"]: r["failures"] for r in together.collect()} == {0: 1, 1: 1, 2: 0, 3: 66, 4: 1, 5: 0}
    assert "ReusedExchange" in together._jdf.queryExecution().executedPlan().toString()


def test_row_counts_and_relationships_of_models_are_one_query(spark, monkeypatch):
    from salesmart.operators import quality
    t = spark.createDataFrame([(1,), (3,)], "x int")
    made, before = [], quality.counted_together
    monkeypatch.setattr(quality, "counted_together", lambda tables, cs, as_of=None: made.append(len(cs)) or before(tables, cs, as_of))
    checks = [Check("t", "row_count_between", None, {"min": 1, "max": 1}), Check("u", "row_count_between", None, {"min": 1, "max": None}),
              Check("t", "relationships", "x", {"to": "u", "field": "x"})]
    found = {r["check_id"]: (r["failures"], r["status"]) for r in run_checks({"t": t, "u": t.filter("x < 2")}, checks, AS_OF).collect()}
    assert made == [3] and found == {checks[0].check_id: (1, "fail"), checks[1].check_id: (0, "pass"), checks[2].check_id: (1, "fail")}
    # one that cannot be evaluated leaves the others as they are
    bad = Check("t", "relationships", "gone", {"to": "u", "field": "x"})
    found = {r["check_id"]: (r["failures"], r["status"]) for r in run_checks({"t": t, "u": t.filter("x < 2")}, [*checks, bad], AS_OF).collect()}
    assert found[bad.check_id] == (None, "error") and found[checks[2].check_id] == (1, "fail")


def test_a_check_that_is_not_evaluated_is_no_empty_result_of_failing_rows(spark):
    t = {"t": spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")}
    with pytest.raises(RuntimeError, match="t.not_null.absent"):
        failed_rows(t, [Check("t", "not_null", "x"), Check("t", "not_null", "absent")], {"t": "y"}, AS_OF)
    assert [r["row_key"] for r in failed_rows(t, [Check("t", "not_null", "x")], {"t": "y"}, AS_OF).collect()] == ["b"]


def test_a_failure_of_the_run_is_raised_and_no_result(spark, monkeypatch):
    import threading
    import time

    from py4j.protocol import Py4JJavaError

    from salesmart.operators import quality
    t = {"t": spark.createDataFrame([("1",), ("b",)], "x string")}
    # a wrong pattern and a value that cannot be cast are the check's own
    found = run_checks(t, [Check("t", "regex", "x", {"pattern": "("}), Check("t", "accepted_range", "x", {"min": 0, "max": 1})], AS_OF)
    assert [r["status"] for r in found.collect()] == ["error", "error"]

    def cancelled(df, checks):
        """A job that is ended from outside."""
        job = "ended-from-outside"
        ender = threading.Thread(target=lambda: (time.sleep(1), spark.sparkContext.cancelJobsWithTag(job)))
        spark.sparkContext.addJobTag(job)
        ender.start()
        return spark.range(0, 10 ** 13, 1, 2).selectExpr("sum(hash(id))").collect()
    monkeypatch.setattr(quality, "_repeats", cancelled)
    with pytest.raises(Py4JJavaError, match="CANCELLED"):
        run_checks(t, [Check("t", "unique", "x"), Check("t", "not_null", "x")], AS_OF)


def test_only_keys_with_a_repeated_hash_are_counted_by_value(spark, monkeypatch):
    from salesmart.operators import quality
    df = spark.createDataFrame([(i, i % 90, None) for i in range(100)] + [(None, None, 1)], "x int, y int, z int")
    checks = [Check("t", "unique", "y"), Check("t", "duplicates", None, {"columns": ["z", "x"]}), Check("t", "unique_combination", None, {"columns": ["z"]})]
    seen, plain = [], quality._group_check
    monkeypatch.setattr(quality, "_group_check", lambda rows, c: seen.append(rows.count()) or plain(rows, c))
    hashes: dict = {}
    want = [10, 0, 1]
    found = [r["failures"] for r in run_checks({"t": df}, checks, AS_OF, hashes=hashes).collect()]
    assert found == want and seen == [20, 2, 100]  # (null, 1) and (1, null) have one hash
    assert sorted(r["x"] for r in failing_rows(df, checks[0], AS_OF, hashes=hashes[checks[0].check_id]).collect()) == [
        *range(10), *range(90, 100)]
    assert failed_rows({"t": df}, checks, {"t": "x"}, AS_OF).count() == 120
    # too many to send to the driver: all keys are counted by value, with the same results
    monkeypatch.setattr(quality, "MOST_REPEATED", 3)
    assert [r["failures"] for r in run_checks({"t": df}, checks, AS_OF).collect()] == want
    assert failed_rows({"t": df}, checks, {"t": "x"}, AS_OF).count() == 120
