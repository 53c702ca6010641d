"""History (SCD) and incremental fixtures and properties."""

import datetime as dt
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from salesmart.operators import history as H
from salesmart.operators import publish
from salesmart.operators.publish import incremental_load, newer_than_target, read_current, upsert

T1, T2 = dt.datetime(2001, 1, 1), dt.datetime(2001, 6, 1)
SCHEMA = "customer_id int, name string, email string, updated_at timestamp_ntz"
KEY, TRACKED = ["customer_id"], ["name", "email"]


def _snaps(spark):
    s1 = spark.createDataFrame([(1, "Ann", "a@x", T1), (2, "Bob", "b@x", T1), (3, "Cy", "c@x", T1)], SCHEMA)
    # 1 unchanged, 2 changed e-mail, 3 missing, 4 new
    s2 = spark.createDataFrame([(1, "Ann", "a@x", T1), (2, "Bob", "b@new", T2), (4, "Di", "d@x", T2)], SCHEMA)
    return s1, s2


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_scd0_keeps_original(spark):
    s1, s2 = _snaps(spark)
    assert _rows(H.scd0(s1, s2, KEY), "customer_id", "email") == [(1, "a@x"), (2, "b@x"), (3, "c@x"), (4, "d@x")]


def test_scd1_overwrites_and_keeps_missing(spark):
    s1, s2 = _snaps(spark)
    assert _rows(H.scd1(s1, s2, KEY), "customer_id", "email") == [(1, "a@x"), (2, "b@new"), (3, "c@x"), (4, "d@x")]


def test_scd2_batch_equals_merge_and_intervals_do_not_overlap(spark):
    s1, s2 = _snaps(spark)
    batch = H.scd2_history(s1.unionByName(s2), KEY, TRACKED)
    merged = H.scd2_merge(H.scd2_init(s1, KEY, TRACKED), s2, KEY, TRACKED)
    cols = ["customer_id", "name", "email", "valid_from", "valid_to", "is_current"]
    assert _rows(batch, *cols) == _rows(merged, *cols)
    got = _rows(batch, "customer_id", "email", "valid_to", "is_current")
    assert got == [(1, "a@x", None, True), (2, "b@new", None, True), (2, "b@x", T2, False),
                   (3, "c@x", None, True), (4, "d@x", None, True)]
    # one current row per key, and each closed row ends where the next begins
    assert batch.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("c")) \
        .filter("c != 1").count() == 0


def test_scd2_drops_duplicate_timestamp_repeats(spark):
    s1, _ = _snaps(spark)
    batch = H.scd2_history(s1.unionByName(s1), KEY, TRACKED)
    assert batch.count() == 3


def test_scd3_previous_only_when_changed(spark):
    s1, s2 = _snaps(spark)
    got = _rows(H.scd3(s1, s2, KEY, "email"), "customer_id", "current_email", "previous_email")
    assert got == [(1, "a@x", None), (2, "b@new", "b@x"), (3, "c@x", None), (4, "d@x", None)]


def test_scd4_history_table(spark):
    s1, s2 = _snaps(spark)
    cur, hist = H.scd4(s1, s2, KEY, TRACKED)
    assert _rows(hist, "customer_id", "email", "valid_to") == [(2, "b@x", T2)]
    assert cur.count() == 4


def test_high_water_mark_filter_is_lazy_and_exact(spark):
    s1, s2 = _snaps(spark)
    assert _rows(newer_than_target(s2, s1, "updated_at"), "customer_id") == [(2,), (4,)]
    empty = s1.limit(0)
    assert newer_than_target(s2, empty, "updated_at").count() == 3


def test_incremental_twice_equals_once_and_full_rebuild(spark, tmp_path):
    s1, s2 = _snaps(spark)
    target = str(tmp_path / "t")
    incremental_load(spark, s1, target, "updated_at", KEY)
    incremental_load(spark, s2, target, "updated_at", KEY)
    once = _rows(read_current(spark, target, "data"), "customer_id", "email")
    incremental_load(spark, s2, target, "updated_at", KEY)
    assert _rows(read_current(spark, target, "data"), "customer_id", "email") == once
    full = _rows(upsert(s1, s2, KEY), "customer_id", "email")
    assert once == full


def test_incremental_append_without_key(spark, tmp_path):
    s1, s2 = _snaps(spark)
    target = str(tmp_path / "a")
    incremental_load(spark, s1, target, "updated_at")
    incremental_load(spark, s2, target, "updated_at")
    # only rows newer than the mark are appended: key 2's new version and key 4
    assert _rows(read_current(spark, target, "data"), "customer_id") == [(1,), (2,), (2,), (3,), (4,)]


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    schema = "order_id int, status string, order_year int, updated_at timestamp_ntz"
    first = spark.createDataFrame([(1, "open", 1999, T1), (2, "open", 2000, T1), (3, "open", 2001, T1)], schema)
    change = spark.createDataFrame([(3, "shipped", 2001, T2), (4, "open", 2001, T2)], schema)
    root = str(tmp_path / "orders")
    incremental_load(spark, first, root, "updated_at", ["order_id"], partition_by="order_year")
    incremental_load(spark, first.unionByName(change), root, "updated_at", ["order_id"], partition_by="order_year")
    got = _rows(read_current(spark, root, "data"), "order_id", "status", "order_year")
    assert got == [(1, "open", 1999), (2, "open", 2000), (3, "shipped", 2001), (4, "open", 2001)]


@pytest.mark.parametrize("partition_by", [None, "order_year"])
def test_upsert_null_partition_moved_key_and_repeated_change(spark, tmp_path, partition_by):
    schema = "order_id int, status string, order_year int, updated_at timestamp_ntz"
    first = [(1, "open", 1999, T1), (2, "open", None, T1), (3, "open", 2001, T1), (None, "open", 2001, T1)]
    later = [(1, "moved", 2000, T2), (4, "new", None, T2), (3, "a", 2001, T2), (3, "b", 2001, datetime(2001, 9, 1)),
             (None, "shipped", 2001, T2)]
    root = str(tmp_path / "t")
    for rows in (first, later):
        incremental_load(spark, spark.createDataFrame(rows, schema), root, "updated_at", ["order_id"], partition_by=partition_by)
    got = {(r.order_id, r.status, r.order_year) for r in read_current(spark, root, "data").collect()}
    assert got == {(1, "moved", 2000), (2, "open", None), (3, "b", 2001), (4, "new", None), (None, "shipped", 2001)}
    only_null = spark.createDataFrame([(9, "x", None, datetime(2003, 1, 1))], schema)
    incremental_load(spark, only_null, root, "updated_at", ["order_id"], partition_by=partition_by)
    assert read_current(spark, root, "data").count() == 6


def test_every_load_is_a_run_that_can_be_rolled_back(spark, tmp_path):
    s1, s2 = _snaps(spark)
    s3 = s2.withColumn("updated_at", F.lit(datetime(2003, 1, 1)).cast("timestamp_ntz"))
    root = str(tmp_path / "r")
    for key in (KEY, None):
        for s in (s1, s2, s3):
            incremental_load(spark, s, root, "updated_at", key, table=f"t{bool(key)}")
    counts = []
    for _ in range(4):
        counts.append((read_current(spark, root, "tTrue").count(), read_current(spark, root, "tFalse").count()))
        publish.rollback(spark, root)
        if "tFalse" not in publish.published_tables(spark, root):
            break
    # the last three runs wrote tFalse; each rollback undoes one of them and leaves tTrue alone
    assert counts == [(4, 8), (4, 5), (4, 3)]
    with pytest.raises(FileNotFoundError):
        read_current(spark, root, "tFalse")
    assert publish.rollback(spark, root) and publish.rollback(spark, root) and publish.rollback(spark, root) is None
    assert read_current(spark, root, "tTrue").count() == 3  # the first run stays


def test_retire_deletes_what_no_run_uses(spark, tmp_path):
    s1, _ = _snaps(spark)
    root = str(tmp_path / "r")
    for i in range(4):
        incremental_load(spark, s1.withColumn("updated_at", F.lit(datetime(2003, 1, 1 + i)).cast("timestamp_ntz")), root,
                         "updated_at", KEY)
    gone = publish.retire(spark, root, keep=2)
    assert len(gone) == 2 and len(os.listdir(f"{root}/data")) == 2 and len(os.listdir(f"{root}/release_state")) == 2
    assert read_current(spark, root, "data").count() == 3 and publish.rollback(spark, root)
    assert read_current(spark, root, "data").count() == 3 and publish.rollback(spark, root) is None


def test_a_damaged_release_is_an_error_not_a_first_load(spark, tmp_path):
    import shutil
    s1, s2 = _snaps(spark)
    root = str(tmp_path / "d")
    version = incremental_load(spark, s1, root, "updated_at", KEY)
    shutil.rmtree(publish.folder(root, "data", version))
    spark.catalog.refreshTable(f"{publish.schema_of(root)}.data__store")
    with pytest.raises(RuntimeError, match="damaged"):
        incremental_load(spark, s2, root, "updated_at", KEY)
    assert publish.current_version(spark, root) == version


def test_rebuild_of_a_partitioned_table_leaves_no_old_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    for years in ((1999, 2000), (2000,)):
        publish.write_table(spark.createDataFrame([(y, y) for y in years], "v int, y int"), path, ["y"])
    assert [r.y for r in spark.read.parquet(path).collect()] == [2000]


def test_scd2_late_repeated_and_tied_versions(spark):
    schema = "customer_id int, email string, updated_at timestamp_ntz"
    day = lambda m: datetime(2001, m, 1)
    history = H.scd2_init(spark.createDataFrame([(1, "a", day(1)), (2, "x", day(1))], schema), ["customer_id"], ["email"])
    for rows in ([(1, "c", day(6))], [(1, "b", day(3)), (1, "b2", day(3)), (1, "d", day(9))], [(1, "d", day(9)), (3, "n", day(2))]):
        history = H.scd2_merge(history, spark.createDataFrame(rows, schema), ["customer_id"], ["email"])
    got = sorted((r.customer_id, r.valid_from.month, r.email, r.valid_to and r.valid_to.month, r.is_current) for r in history.collect())
    assert got == [(1, 1, "a", 3, False), (1, 3, "b2", 6, False), (1, 6, "c", 9, False), (1, 9, "d", None, True),
                   (2, 1, "x", None, True), (3, 2, "n", None, True)]
    plan = H.scd2_merge(history, spark.createDataFrame(rows, schema), ["customer_id"], ["email"])
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_types_0_and_1_with_repeated_and_null_keys(spark):
    schema = "customer_id int, email string, updated_at timestamp_ntz"
    old = spark.createDataFrame([(1, "a", T1), (None, "n", T1)], schema)
    new = spark.createDataFrame([(2, "first", T1), (2, "last", T2), (None, "m", T2), (1, "b", T2), (1, "b", T2)], schema)
    key = ["customer_id"]
    rows = lambda df: sorted(((r.customer_id, r.email) for r in df.collect()), key=str)
    assert rows(H.scd0(old, new, key)) == sorted([(1, "a"), (None, "n"), (2, "first")], key=str)
    assert rows(H.scd1(old, new, key)) == sorted([(1, "b"), (None, "m"), (2, "last")], key=str)
    assert rows(H.scd4(old, new, key, ["email"])[0]) == rows(H.scd1(old, new, key))


def _many_versions(spark, n):
    """One key with half of all versions, some without a change, some at one instant, null keys, values and times."""
    rows = spark.range(n).select(
        F.expr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 31 = 1 THEN NULL ELSE id % 101 END").cast("int").alias("customer_id"),
        F.expr("CASE WHEN id % 13 = 0 THEN NULL ELSE hash(id div 6) % 3 END").cast("string").alias("email"),
        F.expr("CASE WHEN id % 997 = 5 THEN NULL ELSE timestamp_ntz'2001-01-01' + make_dt_interval(0, 0, id div 3) END").alias("updated_at"))
    # plain histories keep every version without a time: one a key here
    return rows.filter("updated_at IS NOT NULL").unionByName(
        rows.filter("updated_at IS NULL").groupBy("customer_id").agg(F.max("email").alias("email")).withColumn(
            "updated_at", F.lit(None).cast("timestamp_ntz")))


@pytest.mark.parametrize("hours", [1, 24 * 3650])
def test_scd2_in_blocks_equals_the_window(spark, hours):
    rows = _many_versions(spark, 6000)
    want = H.scd2_history(rows, ["customer_id"], ["email"])
    got = H.scd2_history_blocks(rows, ["customer_id"], ["email"], hours=hours)
    assert got.columns == want.columns
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(got) == order(want) and len(order(got)) > 1000


def test_scd2_in_blocks_without_rows_and_with_one_unchanging_key(spark):
    rows = _many_versions(spark, 300)
    assert H.scd2_history_blocks(rows.limit(0), ["customer_id"], ["email"]).count() == 0
    one = rows.withColumn("customer_id", F.lit(1)).withColumn("email", F.lit("a")).filter("updated_at IS NOT NULL")
    got = H.scd2_history_blocks(one, ["customer_id"], ["email"], hours=1).collect()
    assert [(r.valid_from, r.valid_to, r.is_current) for r in got] == [(T1, None, True)]
    with pytest.raises(ValueError):
        H.scd2_history_blocks(one, ["customer_id"], ["email"], hours=0)


def test_scd2_in_blocks_spreads_a_hot_key(spark):
    """No window over versions is partitioned by the key alone: those read one row a block."""
    p = H.scd2_history_blocks(_many_versions(spark, 300), ["customer_id"], ["email"])._jdf.queryExecution().optimizedPlan().toString()
    alone = [line for line in p.splitlines() if "Window [" in line and "_block" not in line.split("], [")[1]]
    assert alone and all("_end" in line for line in alone)
