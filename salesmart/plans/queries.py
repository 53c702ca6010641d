"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through the conform adapter and ends in
the engine-neutral output projection (``output.comparable``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.plans.models import TEST_AS_OF, models_on_stored_lines, models_on_testdata
from salesmart.plans.output import comparable
from salesmart.session import dropping_shuffles

Query = Callable[[SparkSession, str], DataFrame]


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(models_on_testdata(spark, sf_dir, TEST_AS_OF)[name])
    run.__name__ = name
    return run


MODEL_NAMES = ("stg_customers", "stg_products", "stg_sales_orders", "int_customer_orders",
               "int_product_sales", "fct_sales_summary", "dim_customer_metrics",
               "fct_product_performance")


def model_queries() -> dict[str, Query]:
    return {n: _model_query(n) for n in MODEL_NAMES}


# ------------------------------------------------------------------ data quality
DQ_KINDS = ("not_null", "unique", "accepted_values", "relationships", "accepted_range",
            "is_positive", "no_future_dates", "valid_date_range")


def _dq_query(kinds) -> Query:
    from salesmart.operators.quality import run_checks
    from salesmart.operators.rules import declared_checks

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checks = declared_checks(kinds=kinds)
        with dropping_shuffles(spark):
            return comparable(run_checks(_models_for(spark, sf_dir, checks), checks, TEST_AS_OF, AT_ONCE))
    return run


#: Fixed value: jobs over all order lines that run at once; each has its shuffle files on disk until it ends.
AT_ONCE = 2


#: Fixed value: kinds whose declared checks read few narrow columns; joining the lines for each costs less than storing them.
NARROW_KINDS = {"unique", "relationships", "accepted_values", "valid_date_range"}


def _models_for(spark: SparkSession, sf_dir: str, checks: list) -> dict[str, DataFrame]:
    """The models under checks of many columns of many models: over order lines that are stored once."""
    if {c.kind for c in checks} <= NARROW_KINDS:
        return models_on_testdata(spark, sf_dir, TEST_AS_OF)
    return models_on_stored_lines(spark, sf_dir, TEST_AS_OF, checks)


def _dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.operators.quality import run_checks, summary
    from salesmart.operators.rules import declared_checks
    checks = declared_checks()
    with dropping_shuffles(spark):
        return comparable(summary(run_checks(_models_for(spark, sf_dir, checks), checks, TEST_AS_OF, AT_ONCE)))


def _guide_query(group: str) -> Query:
    from salesmart.operators.quality import run_checks
    from salesmart.operators.rules import guide_checks

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = models_on_testdata(spark, sf_dir, TEST_AS_OF)
        return comparable(run_checks(models, guide_checks()[group], TEST_AS_OF))
    return run


GUIDE_GROUPS = ("recency", "equal_rowcount", "unique_combination", "regex", "between", "in_set",
                "row_count", "mean", "non_negative", "email", "orphans", "smoke", "contract")


def _freshness_query(kind: str) -> Query:
    from salesmart.sources import conform
    from salesmart.sources.freshness import declared_freshness, freshness, guide_freshness

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = conform.sources(spark, sf_dir)
        spec = declared_freshness(src) if kind == "declared" else guide_freshness(src)
        return comparable(freshness(spec, TEST_AS_OF))
    return run


def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.operators.quality import duplicates
    ps = models_on_testdata(spark, sf_dir, TEST_AS_OF)["int_product_sales"]
    return comparable(duplicates(ps, ["product_id", "order_date", "sales_order_id"]))


def _schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.operators.quality import run_checks
    from salesmart.operators.rules import CONTRACT, expand_contract
    models = models_on_testdata(spark, sf_dir, TEST_AS_OF)
    return comparable(run_checks(models, expand_contract(CONTRACT)[1], TEST_AS_OF))


#: The models' key columns.
KEY_COLUMNS = {"stg_customers": "customer_id", "stg_products": "product_id", "stg_sales_orders": "sales_order_detail_id",
               "int_customer_orders": "sales_order_id", "int_product_sales": "sales_order_detail_id",
               "dim_customer_metrics": "customer_id", "fct_sales_summary": "order_date", "fct_product_performance": "product_id"}


def _failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows, by key, of every declared check that fails."""
    from salesmart.operators.quality import failed_rows
    from salesmart.operators.rules import declared_checks
    checks = declared_checks()
    with dropping_shuffles(spark):
        return failed_rows(_models_for(spark, sf_dir, checks), checks, KEY_COLUMNS, TEST_AS_OF, AT_ONCE)


def _isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-24/27: checks on an absent column and on a table that cannot be read stand beside others that report."""
    from salesmart.operators import publish
    from salesmart.operators.quality import Check, run_checks
    models = models_on_testdata(spark, sf_dir, TEST_AS_OF)
    path = _publish_root(spark, "gone")
    models["stg_products"].write.parquet(path)
    unreadable = spark.read.parquet(path)
    at, files = publish.path_and_files(spark, path)
    files.delete(at, True)
    tables = {"int_product_sales": models["int_product_sales"], "stg_customers": models["stg_customers"], "stg_products": unreadable}
    return comparable(run_checks(tables, [
        Check("stg_customers", "not_null", "customer_id"), Check("stg_customers", "not_null", "fax_number"),
        Check("stg_customers", "unique", "fax_number"), Check("stg_customers", "unique", "customer_id"),
        Check("int_product_sales", "unique", "product_sale_surrogate_key"),
        Check("int_product_sales", "is_positive", "line_profit", severity="warn"),
        Check("stg_products", "table_exists"), Check("no_such_model", "table_exists")], TEST_AS_OF))


#: The checks whose history ``dq_history`` keeps.
HISTORY_CHECKS = (("is_positive", "line_profit"), ("unique", "product_sale_surrogate_key"), ("not_null", "color"),
                  ("not_null", "ship_date"))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-27 over runs: the results of an earlier state of the sales, and of today's, with what has changed."""
    from salesmart.operators.quality import Check, record_run, run_checks, run_trend
    path, rows = _publish_root(spark, "check-history"), _publish_root(spark, "checked-sales")
    columns = {c for _, c in HISTORY_CHECKS} | {"order_date", "sales_order_id", "order_status_name"}
    models_on_testdata(spark, sf_dir, TEST_AS_OF)["int_product_sales"].select(*sorted(columns)).write.parquet(rows)
    sales = spark.read.parquet(rows)  # both runs read them several times
    checks = [Check("int_product_sales", kind, column) for kind, column in HISTORY_CHECKS]
    for run, at, rows in (("r1", "2001-08-14 00:00:00", _earlier(sales)), ("r2", "2001-08-15 00:00:00", sales)):
        record_run(run_checks({"int_product_sales": rows}, checks, TEST_AS_OF), path, run, at)
    return comparable(run_trend(spark.read.parquet(path)))


def _respelled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from salesmart.functions.text import collated
    from salesmart.plans.models import all_models
    from salesmart.sources import conform
    src = conform.respelled_sources(spark, sf_dir)
    return all_models(src, TEST_AS_OF, collate=True) | {"accounts": collated(src["accounts"], "account")}


def _collation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique, set and integrity checks on text that is spelled in several ways, by the source database's comparison."""
    from salesmart.operators.quality import Check, run_checks
    return comparable(run_checks(_respelled(spark, sf_dir), [
        Check("stg_products", "unique", "product_name"), Check("stg_products", "unique", "product_number"),
        Check("stg_products", "unique", "color"), Check("stg_products", "accepted_values", "color", {"values": ["UNKNOWN"]}),
        Check("stg_sales_orders", "relationships", "account_number", {"to": "accounts", "field": "account"})], TEST_AS_OF))


def color_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-5 on collated text: lines and revenue by colour, however it is spelled, of the accounts in a directory."""
    from salesmart.functions.text import plain
    m = _respelled(spark, sf_dir)
    orders = m["stg_sales_orders"].join(m["accounts"], F.col("account_number") == F.col("account"), "left_semi")
    sold = m["int_product_sales"].join(orders.select("sales_order_id").distinct(), "sales_order_id", "left_semi")
    return comparable(sold.groupBy("color").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("line_total").alias("revenue"))
                      .withColumn("color", F.lower(plain("color"))))


def _suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import reduce

    from salesmart.operators.quality import run_suite
    from salesmart.operators.rules import SUITES
    models = models_on_testdata(spark, sf_dir, TEST_AS_OF)
    parts = []
    for name, checks in SUITES.items():
        passed, results = run_suite(name, models, checks, TEST_AS_OF)
        parts.append(results.withColumn("suite_passed", F.lit(passed)))
    return comparable(reduce(DataFrame.unionByName, parts))


def dq_queries() -> dict[str, Query]:
    out = {f"dq_{k}": _dq_query({k}) for k in DQ_KINDS}
    out.update({f"dq_{g}": _guide_query(g) for g in GUIDE_GROUPS})
    out["dq_freshness"] = _freshness_query("declared")
    out["dq_freshness_override"] = _freshness_query("guide")
    out["dq_duplicates"] = _duplicates
    out["dq_schema"] = _schema_checks
    out["dq_failing_rows"] = _failing_rows
    out["dq_isolated"] = _isolated
    out["dq_history"] = _history
    out["dq_suite"] = _suites
    out["dq_collation"] = _collation
    out["dq_declared"] = _dq_query(None)
    out["dq_summary"] = _dq_summary
    return out


def _report_query(name: str) -> Query:
    from salesmart.plans.reports import REPORTS
    fn = REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = models_on_testdata(spark, sf_dir, TEST_AS_OF)
        df = fn(m, TEST_AS_OF) if name == "lifecycle_counts" else fn(m)
        return comparable(df)
    run.__name__ = name
    return run


#: How the sources of ``customers_by_name`` are stored.
STORED_AS = {"customer": ("orc", {}), "person": ("csv", {"header": "true"})}


def customers_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: MOD-1 from sources that are stored as ORC and CSV and read by their logical names."""
    from salesmart.plans import staging
    from salesmart.sources import conform
    from salesmart.sources.specs import default_specs, load_sources
    root, src = _publish_root(spark, "sources"), conform.sources(spark, sf_dir)
    specs = default_specs(root)
    for name, (fmt, options) in STORED_AS.items():
        specs[name] = specs[name].with_override(fmt=fmt, path=f"{root}/{name}.{fmt}", options=options)
        src[name].write.format(fmt).options(**options).save(specs[name].path)
    csv = specs["person"].options | {"emptyValue": "", "nullValue": "\\N"}
    specs["person"] = specs["person"].with_override(options=csv)
    found = load_sources(spark, {n: specs[n] for n in STORED_AS})
    return comparable(staging.stg_customers(found["customer"], found["person"]))


def _revenue_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.plans.reports import revenue_since
    return comparable(revenue_since(spark, models_on_testdata(spark, sf_dir, TEST_AS_OF)))


def _event_value_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.plans.reports import event_value_dollars
    return comparable(event_value_dollars(spark, spark.read.parquet(f"{sf_dir}/events.parquet")))


def report_queries() -> dict[str, Query]:
    from salesmart.plans.reports import REPORTS
    out = {n: _report_query(n) for n in REPORTS}
    out["revenue_since"] = _revenue_since
    out["customers_by_name"] = customers_by_name
    out["color_sales"] = color_sales
    out["event_value_dollars"] = _event_value_dollars
    return out


# ------------------------------------------------------------------ publishing (rows-only checks)
def _publish_root(spark: SparkSession, label: str) -> str:
    import uuid

    from salesmart.session import scratch_path
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex}")


def blue_green_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: build into a staged version; the declared checks decide whether it goes live."""
    from salesmart.plans.build import build
    from salesmart.sources import conform
    out = build(spark, conform.sources(spark, sf_dir), _publish_root(spark, "bluegreen"), TEST_AS_OF,
                version="v1")
    # the data checks and the run row (schema-drift rows are covered by tests/test_types.py)
    return comparable(out.filter("kind != 'schema'").drop("elapsed_s"))


def publish_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-1: a run that goes live: freshness of every source, smoke and key checks on the staged tables, swap."""
    from salesmart.operators.rules import release_checks
    from salesmart.plans.build import build
    from salesmart.sources import conform
    from salesmart.sources.freshness import Freshness, freshness_rules
    src = conform.sources(spark, sf_dir)
    out = build(spark, src, _publish_root(spark, "run"), TEST_AS_OF, checks=release_checks(), version="v1",
                freshness_rules=freshness_rules(src, Freshness(12, STALE_HOURS)))
    return comparable(out.filter("kind != 'schema'").drop("elapsed_s"))


#: Fixed value: when the clean stand-in was loaded; the run's clock is six hours later.
LOADED_AT, RUN_AT = "2001-08-14 18:00:00", "2001-08-15"


def publish_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-1 under the declared rules: all 218 checks and the declared freshness decide; the data meets them, so it goes live.

    Returns the results, and in a last row the number of product sales that are live (a refused run has none).
    """
    from salesmart.operators import publish
    from salesmart.plans.build import build
    from salesmart.sources import conform
    from salesmart.sources.freshness import declared_freshness
    src, root = conform.clean_sources(spark, sf_dir, LOADED_AT), _publish_root(spark, "declared")
    out = build(spark, src, root, RUN_AT, version="v1", freshness_rules=declared_freshness(src))
    if not publish.published_tables(spark, root):
        return comparable(out.filter("kind != 'schema'").drop("elapsed_s"))
    live = publish.read_current(spark, root, "int_product_sales").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("live.int_product_sales").alias("check_id"), F.lit("int_product_sales").alias("model"), F.lit("live").alias("kind"),
        F.lit(None).cast("string").alias("column_name"), F.lit("info").alias("severity"), F.col("n").alias("failures"),
        F.lit("rows").alias("status"))
    return comparable(out.filter("kind != 'schema'").drop("elapsed_s").unionByName(live))


def publish_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5/6: three runs over three tables; the last is rolled back.

    The first run publishes the daily summary, the customer metrics and the
    product performance of all orders.  The second replaces the summary, the
    third the other two, by those of recent orders.  After one rollback the
    second run's state is live: the number of rows and the orders counted in
    each table are returned.
    """
    with dropping_shuffles(spark):
        return _three_runs(spark, sf_dir)


def _three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.operators import publish
    from salesmart.plans import marts
    root = _publish_root(spark, "rollback")
    m = models_on_stored_lines(spark, sf_dir, TEST_AS_OF)
    sales, orders = m["int_product_sales"], m["int_customer_orders"]
    recent = F.year("order_date") >= REFRESH_SINCE_YEAR
    days = lambda rows: marts.fct_sales_summary(rows)
    people = lambda o, rows: marts.dim_customer_metrics(o, rows, TEST_AS_OF)
    goods = lambda rows: marts.fct_product_performance(rows, m["stg_products"], TEST_AS_OF)
    some = sales.filter(recent)
    for run, tables in (
            ("v1", {"fct_sales_summary": days(sales), "dim_customer_metrics": people(orders, sales),
                    "fct_product_performance": goods(sales)}),
            ("v2", {"fct_sales_summary": days(some)}),
            ("v3", {"dim_customer_metrics": people(orders.filter(recent), some), "fct_product_performance": goods(some)})):
        for name, rows in tables.items():
            publish.write_table(rows, publish.folder(root, name, run))
        publish.swap(spark, root, run, {n: df.schema for n, df in tables.items()})
    publish.rollback(spark, root)
    counted = {"fct_sales_summary": "total_orders", "dim_customer_metrics": "total_orders",
               "fct_product_performance": "total_orders"}
    parts = [publish.read_current(spark, root, n).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(c).cast("bigint").alias("orders"))
             .select(F.lit(n).alias("table_name"), "n_rows", "orders") for n, c in counted.items()]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# Fixed value: the test data ends long before its reference date, so sources older than 12 hours
# only warn and those older than this fail.
STALE_HOURS = 24 * 3650

# Fixed value: the refresh recomputes the summary from this order year on.
REFRESH_SINCE_YEAR = 2000


def _earlier(rows: DataFrame) -> DataFrame:
    """What a table held before its last load: recent orders were missing in part, and none of them had shipped."""
    recent = F.year("order_date") >= REFRESH_SINCE_YEAR
    return (rows.filter(~recent | (F.col("sales_order_id") % 3 != 0))
            .withColumn("order_status_name", F.when(recent, F.lit("In Process")).otherwise(F.col("order_status_name"))))


def sales_summary_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of an earlier state of the sales, refreshed for recent years from year-partitioned product sales."""
    from salesmart.plans import marts
    from salesmart.plans.incremental import PARTITION_COLUMN, refresh_sales_summary, with_partition_column
    m = models_on_testdata(spark, sf_dir, TEST_AS_OF)
    path, before = _publish_root(spark, "ips-by-year"), _publish_root(spark, "summary-before")
    sales = m["int_product_sales"].select(*marts.SUMMARY_COLUMNS)
    with_partition_column(sales).write.partitionBy(PARTITION_COLUMN).parquet(path)
    stored = spark.read.parquet(path)
    marts.fct_sales_summary(_earlier(stored)).write.parquet(before)
    return comparable(refresh_sales_summary(spark.read.parquet(before), stored, REFRESH_SINCE_YEAR))


def _refreshed_states(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    """The states of an earlier state of the tables, refreshed for recent years; and the models."""
    from salesmart.plans import mart_state
    m = models_on_testdata(spark, sf_dir, TEST_AS_OF)
    root, tables = _publish_root(spark, "mart-states"), _publish_root(spark, "mart-state-tables")
    for name, columns in (("int_customer_orders", mart_state.ORDER_COLUMNS), ("int_product_sales", mart_state.SALES_COLUMNS)):
        m[name].select(*columns).write.parquet(f"{tables}/{name}")  # twelve states read them
        m[name] = spark.read.parquet(f"{tables}/{name}")
    orders, lines = m["int_customer_orders"], m["int_product_sales"]
    mart_state.store(spark, root, "v1", mart_state.states(_earlier(orders), _earlier(lines)))
    years = [r[0] for r in orders.select(F.year("order_date").alias("y")).distinct().collect() if r[0] >= REFRESH_SINCE_YEAR]
    return mart_state.refresh(spark, root, "v2", orders, lines, years), m


def customer_metrics_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-6 refreshed from stored states and sets of keys after recent orders were added and changed."""
    from salesmart.plans import mart_state
    state, m = _refreshed_states(spark, sf_dir)
    return comparable(mart_state.customer_metrics(state, m["stg_customers"], TEST_AS_OF))


def product_performance_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-8 refreshed from stored states and sets of keys after recent orders were added and changed."""
    from salesmart.plans import mart_state
    state, m = _refreshed_states(spark, sf_dir)
    return comparable(mart_state.product_performance(state, m["stg_products"], TEST_AS_OF))


PUBLISH_QUERIES = {"blue_green_publish": blue_green_publish, "publish_run": publish_run, "publish_rollback": publish_rollback,
                   "publish_declared": publish_declared,
                   "sales_summary_refresh": sales_summary_refresh,
                   "customer_metrics_refresh": customer_metrics_refresh,
                   "product_performance_refresh": product_performance_refresh}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(model_queries())
    out.update(dq_queries())
    out.update(report_queries())
    from salesmart.plans.history_queries import HISTORY_QUERIES
    out.update(HISTORY_QUERIES)
    from salesmart.streaming.queries import STREAMING_QUERIES
    out.update(STREAMING_QUERIES)
    out.update(PUBLISH_QUERIES)
    return out
