"""Operator tests: hand-written rows with expected values, NULLs and boundaries."""

import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

from salesmart.functions import business as B
from salesmart.functions.dates import days_between, day_name, month_name
from salesmart.functions.numbers import int_avg, pct, ratio
from salesmart.functions.text import full_name, surrogate_key


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_order_status_decode(spark):
    rows = [(x,) for x in (0, 1, 2, 3, 4, 5, 6, 7, None)]
    got = _col(spark, rows, "s smallint", B.order_status_name("s"))
    assert got == ["Unknown", "In Process", "Approved", "Backordered", "Rejected", "Shipped",
                   "Cancelled", "Unknown", "Unknown"]


def test_shipping_performance(spark):
    d = dt.date
    rows = [(d(2001, 1, 1), d(2001, 1, 2)), (d(2001, 1, 2), d(2001, 1, 2)), (d(2001, 1, 3), d(2001, 1, 2)),
            (None, d(2001, 1, 2)), (d(2001, 1, 3), None)]
    got = _col(spark, rows, "ship date, due date", B.shipping_performance("ship", "due"))
    assert got == ["On Time", "On Time", "Late", "Not Shipped", "Not Shipped"]


def test_full_name_middle_variants(spark):
    rows = [("Ann", "", "Lee"), ("Ann", None, "Lee"), ("Ann", " A ", "Lee"), ("Ann", "A", "Lee"), (None, None, None)]
    got = _col(spark, rows, "f string, m string, l string", full_name("f", "m", "l"))
    assert got == ["Ann Lee", "Ann Lee", "Ann A Lee", "Ann A Lee", " "]


def test_lifecycle_order(spark):
    d = dt.date
    rows = [(d(2000, 1, 1), None, d(1990, 1, 1)),            # discontinued
            (None, d(2001, 8, 14), d(1990, 1, 1)),           # ended
            (None, d(2001, 8, 15), d(1990, 1, 1)),           # ends on the as-of day: not ended at midnight
            (None, None, d(2001, 8, 16)),                    # starts tomorrow
            (None, None, None),                              # all NULL
            (d(2000, 1, 1), d(2000, 1, 1), d(1990, 1, 1))]   # discontinued and ended
    got = _col(spark, rows, "disc date, end date, start date",
               B.lifecycle_status("disc", "end", "start", "2001-08-15"))
    assert got == ["Discontinued", "Ended", "Active", "Not Started", "Active", "Discontinued"]


def test_ratio_guards_and_rounding(spark):
    rows = [(Decimal("1.0000"), Decimal("0.0000")), (Decimal("1.0000"), Decimal("3.0000")),
            (Decimal("2.0000"), Decimal("3.0000")), (Decimal("-2.0000"), Decimal("3.0000")), (None, Decimal("1"))]
    got = _col(spark, rows, "n decimal(19,4), d decimal(19,4)", ratio("n", "d"))
    assert got == [None, Decimal("0.333333333333333333"), Decimal("0.666666666666666667"), Decimal("-0.666666666666666667"), None]


def test_recency_boundaries(spark):
    days = [0, 30, 31, 60, 61, 90, 91, 180, 181, 366]
    got = _col(spark, [(x,) for x in days], "d int", B.recency_score("d"))
    assert got == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]


def test_frequency_boundaries(spark):
    vals = [0.0, 0.49, 0.5, 1.0, 2.0, 4.0, 3.99]
    got = _col(spark, [(x,) for x in vals], "f double", B.frequency_score("f"))
    assert got == [1, 1, 2, 3, 4, 5, 4]


def test_monetary_boundaries(spark):
    vals = [Decimal("999.99"), Decimal("1000"), Decimal("2000"), Decimal("5000"), Decimal("10000")]
    got = _col(spark, [(x,) for x in vals], "m decimal(38,6)", B.monetary_score("m"))
    assert got == [1, 2, 3, 4, 5]


def test_segments_lost_unreachable(spark):
    rows = [(Decimal(20000), 3.0, 10, 5), (Decimal(6000), 1.5, 50, 5), (Decimal(10), 0.1, 20, 3),
            (Decimal(10), 0.1, 400, 1), (Decimal(10), 0.1, 181, 1), (Decimal(10), 0.1, 100, 1),
            (Decimal(10), 0.1, 100, 2)]
    got = _col(spark, rows, "r decimal(38,6), f double, d int, n bigint", B.customer_segment("r", "f", "d", "n"))
    assert got == ["Champion", "Loyal Customer", "Potential Loyalist", "At Risk", "At Risk", "New Customer",
                   "Regular"]
    assert "Lost" not in got


def test_channel_preference_is_strict(spark):
    rows = [(2, 1), (3, 1), (1, 2), (1, 3), (1, 1)]
    got = _col(spark, rows, "a int, b int", B.channel_preference("a", "b"))
    assert got == ["Mixed", "Online Preferred", "Mixed", "Offline Preferred", "Mixed"]


def test_integer_average_truncates(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "q smallint")
    assert df.agg(int_avg("q")).first()[0] == 1


def test_performance_category_margin_is_a_ratio(spark):
    rows = [(Decimal("999.99"), 100.0), (Decimal("1000"), 0.3), (Decimal("10000"), 0.3),
            (Decimal("20000"), 20.0), (Decimal("50000"), 30.0), (Decimal("50000"), 0.3)]
    got = _col(spark, rows, "r decimal(38,6), m double", B.performance_category("r", "m"))
    assert got == ["Underperformer", "Low Performer", "Regular Performer", "High Performer", "Star Product",
                   "Regular Performer"]


def test_pct_zero_guard(spark):
    got = _col(spark, [(1, 0), (1, 4)], "a bigint, b bigint", pct("a", "b"))
    assert got == [0.0, 25.0]


def test_dates(spark):
    rows = [(dt.date(2001, 1, 1), dt.date(2001, 3, 1))]
    df = spark.createDataFrame(rows, "a date, b date")
    r = df.select(days_between("a", "b"), month_name("a"), day_name("a")).first()
    assert tuple(r) == (59, "January", "Monday")


def test_surrogate_key_matches_sql(spark):
    rows = [(1, dt.date(2001, 1, 2), 3), (None, None, 5)]
    got = _col(spark, rows, "a bigint, b date, c bigint", surrogate_key("a", "b", "c"))
    exp = [r[0] for r in duckdb.sql(
        "SELECT md5(concat_ws('-', COALESCE(CAST(a AS VARCHAR), '_dbt_utils_surrogate_key_null_'), "
        "COALESCE(CAST(b AS VARCHAR), '_dbt_utils_surrogate_key_null_'), "
        "COALESCE(CAST(c AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) "
        "FROM (VALUES (1, DATE '2001-01-02', 3), (NULL, NULL, 5)) t(a, b, c)").fetchall()]
    assert got == exp
