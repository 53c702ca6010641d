"""Skewed input: one customer owns a third of all orders.

Results must stay whole and equal to the literal plans, and the hot group
must not be funnelled into one exchange key for its distinct counts.
"""

import contextlib
import io

from conftest import SF_CHECK
from plain import DAYS, ORDERS, same
from pyspark.sql import functions as F

from salesmart.operators.quality import Check, run_checks
from salesmart.plans import marts, models
from salesmart.plans.models import TEST_AS_OF
from salesmart.sources import conform


def _skewed_models(spark):
    src = conform.sources(spark, SF_CHECK)
    hot = (src["customer"].filter(F.col("PersonID").isNotNull()).agg(F.min("CustomerID")).first()[0])
    h = src["sales_order_header"]
    src["sales_order_header"] = h.withColumn(
        "CustomerID", F.when(F.col("SalesOrderID") % 3 == 0, F.lit(hot)).otherwise(F.col("CustomerID")))
    return models.all_models(src, TEST_AS_OF), hot


def test_hot_customer_results_whole_and_equal(spark):
    m, hot = _skewed_models(spark)
    so = m["stg_sales_orders"]
    same(spark, m["int_customer_orders"], ORDERS, lines=so, customers=m["stg_customers"])
    same(spark, m["fct_sales_summary"], DAYS, lines=m["int_product_sales"])
    hot_orders = so.filter(F.col("customer_id") == hot).select("sales_order_id").distinct().count()
    assert hot_orders > so.select("sales_order_id").distinct().count() / 3 - 1
    row = m["dim_customer_metrics"].filter(F.col("customer_id") == hot).first()
    assert row["total_orders"] == hot_orders
    res = run_checks(m, [Check("int_product_sales", "relationships", "customer_id",
                               {"to": "stg_customers", "field": "customer_id"})], TEST_AS_OF).first()
    direct = m["int_product_sales"].join(m["stg_customers"].select("customer_id"), "customer_id", "left_anti").count()
    assert res["failures"] == direct


def test_distinct_counts_exchange_on_group_and_value(spark, tmp_path):
    # as in a build: the customer-order table is read back from parquet, so the
    # customer aggregation shuffles; its distinct count must exchange on (customer…, date)
    m, _ = _skewed_models(spark)
    path = str(tmp_path / "ico")
    m["int_customer_orders"].write.parquet(path)
    dim = marts.dim_customer_metrics(spark.read.parquet(path), m["int_product_sales"], TEST_AS_OF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        dim.explain()
    exchanges = [ln for ln in buf.getvalue().splitlines() if "Exchange hashpartitioning(" in ln]
    assert any("customer_id" in ln and "order_date" in ln for ln in exchanges)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
