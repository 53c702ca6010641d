"""Registered streaming queries over the ``events`` table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.plans.output import comparable
from salesmart.session import scratch_path
from salesmart.streaming.speed import (batch_aggregate, late_report, run_deduplicated, run_speed_view, run_user_sketches,
                                       run_with_progress, serving_view, user_sketches, users_between)

# Fixed value: the serving view takes batch rows up to this date, speed rows after it.
SERVING_CUTOFF = "2024-01-15"


#: Allowed error of the approximate user count: three standard errors of 5 %, and one user.
APPROX_ERROR = 0.15


def _events_glob(sf_dir: str) -> str:
    return f"{sf_dir}/events*.parquet"


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def speed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(run_speed_view(spark, _events_glob(sf_dir)))


def speed_view_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate form beside the exact user count, and whether it keeps its error bound."""
    exact = (_batch(spark, sf_dir).groupBy(F.to_date("ts").alias("event_date"), "event_type")
             .agg(F.countDistinct("user_id").alias("users")))
    found = run_speed_view(spark, _events_glob(sf_dir), include_approx=True).join(exact, ["event_date", "event_type"])
    kept = F.abs(F.col("approx_users") - F.col("users")) <= F.col("users") * APPROX_ERROR + 1
    return comparable(found.withColumn("within_bound", kept).drop("approx_users"))


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    speed = run_speed_view(spark, _events_glob(sf_dir), after=SERVING_CUTOFF)
    return comparable(serving_view(batch_aggregate(_batch(spark, sf_dir)), speed, SERVING_CUTOFF))


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored stream in which every third event arrives three times."""
    events, path = _batch(spark, sf_dir), scratch_path(spark, f"repeated-events-{uuid.uuid4().hex}")
    again = events.filter(F.col("event_id") % 3 == 0)
    events.unionByName(again).unionByName(again).write.parquet(path)
    return comparable(run_deduplicated(spark, path))


def late_events_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-2: a stored stream of several files, read one by one; the last file brings events of the first days late.

    Returns, for each day and type, the events that the watermark kept out of the speed view.
    """
    path = scratch_path(spark, f"late-events-{uuid.uuid4().hex}")
    first, last = _batch(spark, sf_dir).agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    third = (last - first) // 3
    day, late = F.to_date("ts"), (F.col("event_id") % 7 == 0) & (F.to_date("ts") < F.lit(first + third))
    bounds = [(None, first + third), (first + third, first + 2 * third), (first + 2 * third, None)]
    for low, high in bounds:
        rows = _batch(spark, sf_dir).filter(~late)
        rows = rows.filter(day >= F.lit(low)) if low else rows
        rows.filter(day < F.lit(high) if high else F.lit(True)).coalesce(1).write.mode("append").parquet(path)
    _batch(spark, sf_dir).filter(late).coalesce(1).write.mode("append").parquet(path)
    view, progress = run_with_progress(spark, path, max_files=1)
    found = late_report(batch_aggregate(spark.read.parquet(path)), view, progress)
    return comparable(found.select("event_date", "event_type", "late", "explained"))


#: Allowed error of merged sketches: three standard errors of 1.63 %, and one user.
SKETCH_ERROR = 0.05


def users_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-1: users of each month and of all days, from daily sketches of the batch and the speed layer.

    The batch layer's sketches go up to the cut-off, the speed layer's follow;
    both are stored and only sketches are merged.  Returned are the exact
    counts and whether the estimate keeps its bound.
    """
    events, path = _batch(spark, sf_dir), scratch_path(spark, f"user-sketches-{uuid.uuid4().hex}")
    user_sketches(events.filter(F.to_date("ts") <= F.to_date(F.lit(SERVING_CUTOFF)))).write.parquet(path)
    run_user_sketches(spark, _events_glob(sf_dir), after=SERVING_CUTOFF).write.mode("append").parquet(path)
    months = events.select(F.trunc(F.to_date("ts"), "month").alias("first_date")).distinct().withColumn(
        "last_date", F.last_day("first_date"))
    whole = events.agg(F.min(F.to_date("ts")).alias("first_date"), F.max(F.to_date("ts")).alias("last_date"))
    ranges = months.unionByName(whole)
    found = users_between(spark.read.parquet(path), ranges)
    day = F.to_date("ts")
    exact = (events.select(day.alias("day"), "user_id").distinct()
             .join(F.broadcast(ranges), F.col("day").between(F.col("first_date"), F.col("last_date")))
             .groupBy("first_date", "last_date").agg(F.countDistinct("user_id").alias("exact")))
    kept = F.abs(F.col("users") - F.col("exact")) <= F.col("exact") * SKETCH_ERROR + 1
    return comparable(found.join(exact, ["first_date", "last_date"]).select(
        "first_date", "last_date", F.col("exact").alias("users"), kept.alias("within_bound")))


STREAMING_QUERIES = {"late_events_report": late_events_report, "users_by_range": users_by_range,
                     "speed_view": speed_view, "speed_view_approx": speed_view_approx,
                     "serving_view": serving, "dedup_events": dedup_events}
