"""Speed view equals the batch aggregate; serving view; de-duplication within the watermark."""

import datetime as dt
import time

import pytest

from conftest import SF_SMALL

from salesmart.streaming.speed import (PROGRESS, batch_aggregate, late_events, late_report, run_deduplicated, run_speed_view,
                                       serving_view, user_sketches, users_between)


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_speed_equals_batch_and_serving(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    speed = run_speed_view(spark, f"{SF_SMALL}/events*.parquet")
    batch = batch_aggregate(events)
    _same(speed, batch)
    served = serving_view(batch, run_speed_view(spark, f"{SF_SMALL}/events*.parquet", after="2024-01-15"), "2024-01-15")
    _same(served.drop("layer"), batch)
    assert served.filter("(layer = 'batch') <> (event_date <= '2024-01-15')").count() == 0
    assert late_events(batch, speed).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _same(run_speed_view(spark, f"{SF_SMALL}/events*.parquet"),
              batch_aggregate(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_late_events_are_counted(spark, tmp_path):
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    src = str(tmp_path / "events")
    batches = [[(1, day(1, 10), 1, "a", 1.0, "")], [(2, day(3, 10), 1, "a", 2.0, "")], [(3, day(4, 10), 1, "a", 2.0, "")],
               [(4, day(1, 11), 2, "a", 4.0, ""), (5, day(4, 11), 2, "a", 5.0, "")]]
    for rows in batches:  # one file each, in this order; the fourth is days behind the watermark
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    events = spark.read.schema(schema).parquet(src)
    speed = run_speed_view(spark, src, max_files=1)
    got = [(str(r.event_date), r.late) for r in late_events(batch_aggregate(events), speed).collect()]
    assert got == [("2024-01-01", 1)]


def test_late_report_joins_the_streams_own_metric(spark):
    schema = "event_date date, event_type string, events bigint"
    day = dt.date(2024, 1, 1)
    batch = spark.createDataFrame([(day, "a", 5), (day, "b", 2), (day, "c", 1)], schema)
    speed = spark.createDataFrame([(day, "a", 3), (day, "c", 1)], schema)
    for dropped, explained in ((2, True), (1, False)):
        progress = spark.createDataFrame([(0, 5, 0, None), (1, 3, dropped, "x")], PROGRESS)
        got = {(r.event_type, r.late, r.dropped_groups, r.explained) for r in late_report(batch, speed, progress).collect()}
        assert got == {("a", 2, dropped, explained), ("b", 2, dropped, explained)}
    nothing = late_report(batch, batch, spark.createDataFrame([], PROGRESS))
    assert nothing.count() == 0


def test_sketches_merge_like_sets(spark):
    rows = spark.range(30000).selectExpr("id % 20000 AS user_id", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,CAST(id % 10 AS INT)) AS ts",
                                         "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS event_type")
    ranges = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (dt.date(2024, 1, 2), dt.date(2024, 1, 4)),
                                    (dt.date(2030, 1, 1), dt.date(2030, 1, 2))], "first_date date, last_date date")
    got = {r.first_date.day: r.users for r in users_between(user_sketches(rows), ranges).collect()}
    want = {1: 20000, 2: rows.filter("day(ts) BETWEEN 2 AND 4").select("user_id").distinct().count()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) <= 0.05 * want[d] for d in want)
    few = rows.filter("user_id < 7")
    assert users_between(user_sketches(few), ranges).filter("first_date = '2024-01-01'").first().users == 7
    # two layers with the same users count them once
    both = user_sketches(rows).unionByName(user_sketches(rows))
    assert {r.first_date.day: r.users for r in users_between(both, ranges).collect()} == got


def test_duplicates_dropped_within_watermark(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 10, 0)
    rows = [(1, t, 7, "click", 1.0, "{}"), (1, t + dt.timedelta(minutes=5), 7, "click", 1.0, "{}"),
            (2, t, 8, "view", 2.0, "{}")]
    src = str(tmp_path / "events")
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                "value double, props string").write.parquet(src)
    out = run_deduplicated(spark, src, str(tmp_path / "out"))
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2]
