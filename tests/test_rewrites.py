"""The two-pass plans of the models equal plain one-pass SQL, column by column."""

from conftest import SF_CHECK, SF_SMALL

from plain import ORDERS, PRODUCTS, DAYS, same

from salesmart.plans.models import TEST_AS_OF, models_on_testdata


def test_int_customer_orders(spark):
    m = models_on_testdata(spark, SF_CHECK, TEST_AS_OF)
    same(spark, m["int_customer_orders"], ORDERS, lines=m["stg_sales_orders"], customers=m["stg_customers"])


def test_fct_sales_summary(spark):
    for sf in (SF_SMALL, SF_CHECK):
        m = models_on_testdata(spark, sf, TEST_AS_OF)
        same(spark, m["fct_sales_summary"], DAYS, lines=m["int_product_sales"])


def test_daily_revenue_sums_to_month_and_total(spark):
    from pyspark.sql import functions as F
    m = models_on_testdata(spark, SF_CHECK, TEST_AS_OF)
    f = m["fct_sales_summary"]
    bad = (f.groupBy("order_year", "order_month")
           .agg(F.sum("total_revenue").alias("s"), F.max("monthly_total_revenue").alias("m"))
           .filter("s != m").count())
    assert bad == 0
    total = f.agg(F.sum("total_revenue")).first()[0]
    assert total == m["int_product_sales"].agg(F.sum("line_total")).first()[0]


def test_fct_product_performance(spark):
    m = models_on_testdata(spark, SF_CHECK, TEST_AS_OF)
    same(spark, m["fct_product_performance"], PRODUCTS, lines=m["int_product_sales"])


def test_int_customer_orders_with_repeated_customers(spark):
    """Equal customer rows count an order's lines as often, differing ones give it a row each."""
    from pyspark.sql import functions as F

    from salesmart.plans.intermediate import int_customer_orders
    m = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)
    c = m["stg_customers"]
    customers = (c.unionByName(c.filter("customer_id % 3 = 0")).unionByName(c.filter("customer_id % 6 = 0"))
                 .unionByName(c.filter("customer_id % 5 = 0").withColumn("email_promotion", F.lit(9)))
                 .unionByName(c.filter("customer_id % 4 = 0").withColumn("modified_date", F.lit("2001-09-01").cast("timestamp_ntz"))))
    sql = ORDERS.replace("c.customer_id,", "c.customer_id, c.email_promotion, max(c.modified_date) AS customer_modified_date,")
    after = int_customer_orders(m["stg_sales_orders"], customers)
    assert after.schema == int_customer_orders(m["stg_sales_orders"], c).schema
    same(spark, after, sql + ", c.email_promotion", lines=m["stg_sales_orders"], customers=customers)
