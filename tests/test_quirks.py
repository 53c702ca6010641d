"""The reference's business-rule quirks, kept as they are."""

from conftest import SF_CHECK
from pyspark.sql import functions as F

from salesmart.plans.models import TEST_AS_OF, models_on_testdata


def test_quirks(spark):
    m = models_on_testdata(spark, SF_CHECK, TEST_AS_OF)
    dim, ips, ico = m["dim_customer_metrics"], m["int_product_sales"], m["int_customer_orders"]
    # Q1: 'Lost' is unreachable ('At Risk' is tested first)
    assert dim.filter(F.col("customer_segment") == "Lost").count() == 0
    assert dim.filter(F.col("days_since_last_order") > 365).count() > 0
    # Q2: 'New Customer' only when the last order is at most 180 days old
    assert dim.filter((F.col("customer_segment") == "New Customer")
                      & (F.col("days_since_last_order") > 180)).count() == 0
    # Q5: the (product, date, order) key repeats when a product occurs twice in one order
    dups = ips.groupBy("product_sale_surrogate_key").count().filter("count > 1").count()
    assert dups == 55
    # Q7: all orders on one day → frequency 0 → score 1
    one_day = dim.filter(F.col("customer_lifetime_days") == 0)
    assert one_day.filter((F.col("orders_per_month") != 0) | (F.col("frequency_score") != 1)).count() == 0
    # Q9: customers without a person: orders kept in product sales, dropped from customer orders
    no_person = m["src_customer"].filter(F.col("PersonID").isNull()).select(F.col("CustomerID").alias("customer_id"))
    assert ips.join(no_person, "customer_id").count() > 0
    assert ico.join(no_person, "customer_id").count() == 0


def test_product_line_counts_can_exceed_orders(spark):
    # Q4: product online/shipped counts are lines while percentages divide by distinct orders
    m = models_on_testdata(spark, SF_CHECK, TEST_AS_OF)
    f = m["fct_product_performance"]
    assert f.filter(F.col("online_orders") + F.col("offline_orders") < F.col("total_orders")).count() == 0
