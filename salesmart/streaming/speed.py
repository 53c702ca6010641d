"""Speed layer (STM-1..3) with Structured Streaming.

* ``speed_aggregate``: a streaming daily aggregate over event time — tumbling
  one-day windows, a watermark bounding late data and state, exact counts and
  integer-cent sums, plus an approximate distinct user count (the speed layer
  may be approximate);
* ``deduplicated``: late/duplicate events dropped with
  ``dropDuplicatesWithinWatermark`` (STM-2);
* ``run_speed_view``: drives the stream with ``availableNow`` into a parquet
  folder through ``foreachBatch`` (update mode: each micro-batch writes the
  windows it changed, tagged with the batch id) and resolves the latest row of
  each window — a keyed upsert without a table format;
* ``user_sketches`` / ``users_between``: stored sketches of the users of a day
  and type, merged for any range of days, types and layers without a recount;
* ``late_report``: events that the watermark dropped, per day, from the
  reconciliation with the batch view, beside what the stream's own progress says;
* ``serving_view``: batch rows up to a cut-off date ∪ speed rows after it.

Checkpoints and outputs go under the session's shared checkpoint folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import checkpoint_dir

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
# Window length and lateness bound of the speed view.
WINDOW = "1 day"
WATERMARK = "1 hour"


#: Base-2 logarithm of a user sketch's registers: a standard error of 1.63 %, and at most some 4 KB a sketch.
SKETCH_LG_K = 12


def _users():
    return F.hll_sketch_agg("user_id", SKETCH_LG_K).alias("users")


def _measures(include_approx: bool):
    total = F.sum(F.col("value").cast("decimal(18,6)"))  # exact; rounded to cents once
    out = [F.count(F.lit(1)).alias("events"), F.round(total * 100).cast("bigint").alias("value_cents"),
           F.max("value").alias("max_value")]
    if include_approx:
        out.append(F.approx_count_distinct("user_id").alias("approx_users"))
    return out


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # watermarks need an instant: the zone-less ts is read as UTC, whatever the session's zone
    at_utc = "make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), extract(SECOND FROM ts), 'UTC')"
    return reader.parquet(path).withColumn("event_time", F.expr(at_utc))


def deduplicated(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """STM-2: drop repeated event ids arriving within the watermark."""
    return events.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


def speed_aggregate(events: DataFrame, watermark: str = WATERMARK, include_approx: bool = True) -> DataFrame:
    """STM-1: per (day window, event type) counts and sums over event time."""
    return (events.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", WINDOW).alias("w"), "event_type")
            .agg(*_measures(include_approx))
            .select(F.expr("date_from_unix_date(int(unix_seconds(w.start) div 86400))").alias("event_date"), "event_type",
                    *[c for c in ("events", "value_cents", "max_value", "approx_users")
                      if include_approx or c != "approx_users"]))


def batch_aggregate(events: DataFrame, include_approx: bool = False) -> DataFrame:
    """The batch layer's version of the same daily aggregate (exact)."""
    return (events.groupBy(F.to_date("ts").alias("event_date"), "event_type")
            .agg(*_measures(include_approx)))


def sketch_aggregate(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """STM-1, mergeable form: per (day window, event type) a sketch of the users, from a stream."""
    return (events.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", WINDOW).alias("w"), "event_type").agg(_users())
            .select(F.expr("date_from_unix_date(int(unix_seconds(w.start) div 86400))").alias("event_date"), "event_type", "users"))


def user_sketches(events: DataFrame) -> DataFrame:
    """The batch layer's sketches: (event_date, event_type, users), one row for each day and type."""
    return events.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(_users())


def users_between(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """(first_date, last_date, users): estimated distinct users of each range of days, all types together.

    Only sketches are read and merged, whichever layer they come from.  With
    2 ** ``SKETCH_LG_K`` registers the standard error is 1.63 %; a range of few
    users is counted exactly.  Ranges without events have no row.
    """
    inside = F.col("event_date").between(F.col("first_date"), F.col("last_date"))
    # ranges are a short list; sketches are first merged by day, so a day is one row whatever its events
    daily = sketches.groupBy("event_date").agg(F.hll_union_agg("users").alias("users"))
    return (daily.join(F.broadcast(ranges), inside).groupBy("first_date", "last_date")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users")))


def _run_to_table(spark: SparkSession, aggregate: DataFrame, base: str) -> tuple[DataFrame, list]:
    """Run a streaming daily aggregate to completion; the latest row of each day and type, and the progress rows."""
    table = f"{base}/table"

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(table)

    q = (aggregate.writeStream.outputMode("update").foreachBatch(upsert_batch)
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.parquet(table)
    cols = [c for c in rows.columns if c not in ("event_date", "event_type", "batch_id")]
    latest = rows.groupBy("event_date", "event_type").agg(F.max_by(F.struct(*cols), "batch_id").alias("r"))
    return latest.select("event_date", "event_type", *[F.col(f"r.{c}").alias(c) for c in cols]), list(q.recentProgress)


def run_user_sketches(spark: SparkSession, source: str, after: str | None = None, out: str | None = None) -> DataFrame:
    """The speed layer's sketches, of events past the day ``after`` if given."""
    return _run_to_table(spark, sketch_aggregate(_after(event_stream(spark, source), after)), out or _base(spark))[0]


def _base(spark: SparkSession) -> str:
    return os.path.join(checkpoint_dir(spark), f"speed-{uuid.uuid4().hex}")


def _after(events: DataFrame, day: str | None) -> DataFrame:
    return events if day is None else events.filter(F.col("ts") >= F.expr(f"timestamp_ntz'{day}' + INTERVAL 1 DAY"))


PROGRESS = "batch_id bigint, input_rows bigint, dropped_groups bigint, watermark string"


def run_with_progress(spark: SparkSession, source: str, max_files: int | None = None,
                      out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The speed view and the stream's progress: a row for each micro-batch.

    ``dropped_groups`` is Spark's count of rows dropped by the watermark.  They
    are dropped after the partial aggregation, so it counts (day, type) groups
    of a task, not events.
    """
    base = out or _base(spark)
    view, progress = _run_to_table(spark, speed_aggregate(event_stream(spark, source, max_files), include_approx=False), base)
    rows = [(p["batchId"], p["numInputRows"], sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]),
             (p["eventTime"] or {}).get("watermark")) for p in progress]
    return view, spark.createDataFrame(rows, PROGRESS)


def run_speed_view(spark: SparkSession, source: str, include_approx: bool = False,
                   out: str | None = None, max_files: int | None = None, after: str | None = None) -> DataFrame:
    """Run the streaming aggregate to completion (``availableNow``) and return its table.

    ``after`` keeps events past that day only, before anything is aggregated.
    Events later than the watermark are not in it; ``late_events`` counts them.
    """
    events = _after(event_stream(spark, source, max_files), after)
    return _run_to_table(spark, speed_aggregate(events, include_approx=include_approx), out or _base(spark))[0]


def serving_view(batch_rows: DataFrame, speed_rows: DataFrame, cutoff: str) -> DataFrame:
    """STM-3: batch results up to ``cutoff`` (inclusive) ∪ speed results after it, each row with its ``layer``."""
    d = F.to_date(F.lit(cutoff))
    return (batch_rows.filter(F.col("event_date") <= d).withColumn("layer", F.lit("batch"))
            .unionByName(speed_rows.filter(F.col("event_date") > d).withColumn("layer", F.lit("speed"))))


def late_events(batch_rows: DataFrame, speed_rows: DataFrame) -> DataFrame:
    """(event_date, event_type, late): events of the batch view that the speed view lacks, if any."""
    seen = speed_rows.select("event_date", "event_type", F.col("events").alias("seen"))
    late = F.col("events") - F.coalesce("seen", F.lit(0))
    return (batch_rows.select("event_date", "event_type", "events").join(seen, ["event_date", "event_type"], "left")
            .select("event_date", "event_type", late.alias("late")).filter("late <> 0"))


def late_report(batch_rows: DataFrame, speed_rows: DataFrame, progress: DataFrame) -> DataFrame:
    """(event_date, event_type, late, dropped_groups, explained): the late events of each day and type.

    ``late`` is exact, from the batch view; ``dropped_groups`` is the whole
    stream's metric.  ``explained`` is false if the stream has dropped fewer
    groups than are missing, that is if events were lost in another way.
    """
    late = late_events(batch_rows, speed_rows)
    metric = progress.agg(F.coalesce(F.sum("dropped_groups"), F.lit(0)).alias("dropped_groups"))
    missing = late.agg(F.count(F.lit(1)).alias("missing"))
    totals = metric.join(missing).select("dropped_groups", (F.col("dropped_groups") >= F.col("missing")).alias("explained"))
    return late.join(F.broadcast(totals))  # one row


def run_deduplicated(spark: SparkSession, source: str, out: str | None = None) -> DataFrame:
    """STM-2 driven to completion: first occurrence of each event id, appended to parquet."""
    base = out or os.path.join(checkpoint_dir(spark), f"dedup-{uuid.uuid4().hex}")
    q = (deduplicated(event_stream(spark, source)).drop("event_time")
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
         .start(f"{base}/table"))
    q.awaitTermination()
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{base}/table")
