"""Queries over the history and incremental operators (HIST-0..4, SNK-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import history as H
from salesmart.plans.output import comparable
from salesmart.sources import conform

KEY, TRACKED = ["customer_id"], ["name", "email", "segment"]
# Fixed value: the first load of the incremental target holds rows modified up to this instant.
FIRST_LOAD_UNTIL = "1999-12-31 00:00:00"


def _snaps(spark, sf_dir):
    return conform.customer_snapshots(spark, sf_dir)


def scd0(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2 = _snaps(spark, sf_dir)
    return comparable(H.scd0(s1, s2, KEY))


def scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2 = _snaps(spark, sf_dir)
    return comparable(H.scd1(s1, s2, KEY))


def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2 = _snaps(spark, sf_dir)
    return comparable(H.scd2_history(s1.unionByName(s2), KEY, TRACKED))


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots merged one after the other; the last one is late: its versions lie between the first two."""
    s1, s2 = _snaps(spark, sf_dir)
    late = (s1.filter(F.col("customer_id") % 6 == 0).withColumn("segment", F.lit("LATE"))
            .withColumn("updated_at", F.to_timestamp_ntz(F.lit("2001-03-01 00:00:00")).cast(s1.schema["updated_at"].dataType)))
    history = H.scd2_init(s1, KEY, TRACKED)
    for snapshot in (s2, late):
        history = H.scd2_merge(history, snapshot, KEY, TRACKED)
    return comparable(history)


def scd2_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HIST-2 for keys with very many versions: every event is a version of its user's last event type, and of all users'."""
    e = conform.read_table(spark, sf_dir, "events")
    of_user = e.select("user_id", F.col("event_type").alias("last_event"), F.col("ts").alias("updated_at"))
    of_all = of_user.withColumn("user_id", F.lit(-1).cast("bigint"))
    return comparable(H.scd2_history_blocks(of_user.unionByName(of_all), ["user_id"], ["last_event"], hours=24))


def scd3(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2 = _snaps(spark, sf_dir)
    return comparable(H.scd3(s1, s2, KEY, "email"))


def scd4_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2 = _snaps(spark, sf_dir)
    return comparable(H.scd4(s1, s2, KEY, TRACKED)[0])


def scd4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2 = _snaps(spark, sf_dir)
    return comparable(H.scd4(s1, s2, KEY, TRACKED)[1])


def _order_changes(h: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first load, all later rows): new orders, and every seventh loaded order changed.

    Every fourteenth is changed twice, and every twenty-first moves to the next year.
    """
    first = h.filter(F.col("ModifiedDate") <= F.to_timestamp_ntz(F.lit(FIRST_LOAD_UNTIL)))
    order = F.col("SalesOrderID")

    def change(every: int, status: int, at: str) -> DataFrame:
        out = (first.filter(order % every == 0).withColumn("Status", F.lit(status).cast(h.schema["Status"].dataType))
               .withColumn("ModifiedDate", F.to_timestamp_ntz(F.lit(at)).cast(h.schema["ModifiedDate"].dataType)))
        return out.withColumn("order_year", F.when(order % 21 == 0, F.col("order_year") + 1).otherwise(F.col("order_year")))
    return first, h.unionByName(change(7, 6, "2002-01-01 00:00:00")).unionByName(change(14, 3, "2002-02-01 00:00:00"))


def _incremental(spark: SparkSession, sf_dir: str, partition_by: str | None) -> DataFrame:
    import uuid

    from salesmart.operators.publish import incremental_load, read_current
    from salesmart.session import scratch_path
    h = conform.sales_order_header(spark, sf_dir).select(
        "SalesOrderID", "Status", "TotalDue", "ModifiedDate", F.year("OrderDate").alias("order_year"))
    first, rows = _order_changes(h)
    root = scratch_path(spark, f"incremental-{uuid.uuid4().hex}")
    for load in (first, rows):
        incremental_load(spark, load, root, "ModifiedDate", ["SalesOrderID"], partition_by=partition_by)
    return comparable(read_current(spark, root, "data"))


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 on order headers: first load up to a date, then a keyed run with new and changed orders."""
    return _incremental(spark, sf_dir, None)


def incremental_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 on a year-partitioned table: as ``incremental_merge``, joining only the years concerned."""
    return _incremental(spark, sf_dir, "order_year")


HISTORY_QUERIES = {
    "incremental_partitioned": incremental_partitioned,
    "scd0": scd0, "scd1": scd1, "scd2": scd2, "scd2_merge": scd2_merge, "scd2_blocks": scd2_blocks, "scd3": scd3,
    "scd4_current": scd4_current, "scd4_history": scd4_history, "incremental_merge": incremental_merge,
}
