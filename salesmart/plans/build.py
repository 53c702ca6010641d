"""A full build run (PIPE-1): sources → staging → intermediate → marts → checks → publish.

Differences from a scheduler-driven run, by design:

* checks run on the *staged* version, before anything becomes visible, and
  the swap happens only when no error-severity check fails (SNK-5);
* the staging views (each read by several models and checks) and every
  written table are read back from parquet, which cuts lineage: a lost
  executor recomputes from the written files, not from the sources;
* lines and orders are written in buckets by the key that their readers group
  or join by, which are known as such while the build runs: those exchange less;
* all checks of a table are fused into one scan (see ``operators.quality``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import publish
from salesmart.operators.quality import run_checks
from salesmart.operators.rules import declared_checks
from salesmart.plans import intermediate, marts, models
from salesmart.sources.freshness import freshness
from salesmart.plans.incremental import PARTITION_COLUMN, with_partition_column
from salesmart.session import dropping_shuffles, small_tasks
from salesmart.types import check_schema


def _materialise(spark: SparkSession, df: DataFrame, path: str,
                 partition_by: list[str] | None = None) -> DataFrame:
    publish.write_table(df, path, partition_by)
    return spark.read.parquet(path)


# Tables of one row a line or order, by the key that most of their readers group or join by.
CLUSTERED = {"stg_sales_orders": "sales_order_id", "int_customer_orders": "customer_id", "int_product_sales": "product_id"}


# Fixed value: a run slower than this is reported as a warning (DQ-28).
SLOW_RUN_SECONDS = 3600


# Tables stored partitioned (by the year of the order) so refreshes can prune to recent years.
PARTITIONED = {"int_product_sales": [PARTITION_COLUMN]}


def _layer(spark: SparkSession, jobs: dict, root: str, version: str, threads: int, buckets: int,
           names: list[str]) -> dict[str, DataFrame]:
    """Write the independent models of one layer concurrently (one Spark job each); ``names`` gets those of clustered tables."""
    from concurrent.futures import ThreadPoolExecutor

    def run(item):
        name, make = item
        df = make()
        if name in PARTITIONED:
            df = with_partition_column(df)
        path = publish.folder(root, name, version)
        if name in CLUSTERED:
            df, known_as = publish.write_clustered(df, path, CLUSTERED[name], buckets, PARTITIONED.get(name))
            names.append(known_as)
            return name, df
        return name, _materialise(spark, df, path, PARTITIONED.get(name))
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return dict(pool.map(run, jobs.items()))


def _freshness_rows(sources: dict[str, DataFrame], rules: dict, as_of) -> DataFrame:
    """One result row per source: a stale one fails (error) or warns, as its rule says (DQ-9)."""
    found = freshness({n: rules[n] for n in sources if n in rules}, as_of)
    bad = F.col("status") != "pass"
    return found.select(
        F.concat_ws(".", F.lit("source"), "table_name", F.lit("freshness")).alias("check_id"),
        F.col("table_name").alias("model"), F.lit("freshness").alias("kind"),
        F.lit("loaded_at").alias("column_name"),
        F.when(F.col("status") == "warn", "warn").otherwise("error").alias("severity"),
        bad.cast("bigint").alias("failures"), F.when(bad, F.when(F.col("status") == "warn", "warn").otherwise("fail"))
        .otherwise("pass").alias("status"))


def build(spark: SparkSession, sources: dict[str, DataFrame], root: str, as_of=None,
          checks=None, publish_on_success: bool = True, version: str | None = None,
          slow_run_seconds: float = SLOW_RUN_SECONDS, threads: int = 4,
          freshness_rules: dict | None = None) -> DataFrame:
    """Run one build into new folders under ``root``; return the run result.

    Layers run in dependency order.  The staging models are submitted
    concurrently from ``threads`` driver threads (Spark shares the executors
    between the jobs); those after them, each over all order lines or orders,
    run one after another, so that only one has its shuffle files on disk.  The
    result has one row per check, one per source with a freshness rule (as
    ``sources.freshness.declared_freshness`` gives them), plus a final ``run`` row with the elapsed
    seconds and the publish decision (DQ-27/28).  Shuffle files are kept no longer than their job.
    """
    names: list[str] = []
    try:
        with dropping_shuffles(spark), small_tasks(spark):
            return _run(spark, sources, root, as_of, checks, publish_on_success, version, slow_run_seconds, threads,
                        freshness_rules, names)
    finally:
        publish.forget(spark, names)


def _run(spark: SparkSession, sources: dict[str, DataFrame], root: str, as_of, checks, publish_on_success: bool,
         version: str | None, slow_run_seconds: float, threads: int, freshness_rules: dict | None, names: list[str]) -> DataFrame:
    t0 = time.time()
    if as_of is None:  # one clock for all models and checks of the run
        as_of = spark.sql("SELECT localtimestamp()").first()[0]
    v = publish.new_run(version)
    if publish.state_of(spark, root, v):
        raise ValueError(f"run {v} is published already")
    stg = models.stage(sources)
    # staging models are views in the model graph, but each is read several
    # times (joins, checks, relationship parents): written once per build
    buckets = publish.bucket_count(spark, stg["stg_sales_orders"])
    t = _layer(spark, {n: (lambda n=n: stg[n]) for n in models.STAGING}, root, v, threads, buckets, names)
    t.update(_layer(spark, {
        "int_customer_orders": lambda: intermediate.int_customer_orders(t["stg_sales_orders"], t["stg_customers"]),
        "int_product_sales": lambda: intermediate.int_product_sales(t["stg_sales_orders"], t["stg_products"], as_of),
    }, root, v, 1, buckets, names))
    t.update(_layer(spark, {
        "dim_customer_metrics": lambda: marts.dim_customer_metrics(t["int_customer_orders"], t["int_product_sales"], as_of),
        "fct_sales_summary": lambda: marts.fct_sales_summary(t["int_product_sales"]),
        "fct_product_performance": lambda: marts.fct_product_performance(t["int_product_sales"], t["stg_products"], as_of),
    }, root, v, 1, buckets, names))
    results = run_checks(t, checks if checks is not None else declared_checks(), as_of, parallelism=threads * 2)
    # schema drift of every written model against its declared schema (DQ-13)
    drift = [(f"{n}.schema", n, "schema", None, "error",
              len(check_schema(df, n, tuple(PARTITIONED.get(n, ())))))
             for n, df in t.items()]
    results = results.unionByName(
        spark.createDataFrame(drift, results.drop("status").schema).withColumn(
            "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))
    if freshness_rules:
        results = results.unionByName(_freshness_rows(sources, freshness_rules, as_of).select(*results.columns))
    results = _materialise(spark, results, publish.folder(root, "_checks", v))
    errors = results.filter(F.col("status").isin("fail", "error")).count()  # not evaluated is not passed
    published = publish_on_success and errors == 0
    if published:
        publish.swap(spark, root, v, {n: df.schema for n, df in t.items()}, {n: c for n, (c,) in PARTITIONED.items()})
        for name in models.STAGING:  # the session's staging views follow the release, never an unchecked build
            publish_view(publish.read_current(spark, root, name), name)
    elapsed = time.time() - t0
    severity = "error" if errors else ("warn" if elapsed > slow_run_seconds else "info")
    run = spark.createDataFrame(
        [(f"run.{v}", "run", "run", None, severity, errors,
          "published" if published else "kept_previous", float(elapsed))],
        "check_id string, model string, kind string, column_name string, severity string, "
        "failures bigint, status string, elapsed_s double")
    return results.withColumn("elapsed_s", F.lit(None).cast("double")).unionByName(run)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    return publish.publish_view(df, name)
