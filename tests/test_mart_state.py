"""Refreshing MOD-6 and MOD-8 from stored states equals a rebuild and reads the changed years only."""

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from salesmart.operators import publish
from salesmart.plans import mart_state, marts
from salesmart.plans.models import TEST_AS_OF, models_on_testdata


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_refresh_after_changed_new_and_deleted_orders(spark, tmp_path):
    m, root = models_on_testdata(spark, SF_SMALL, TEST_AS_OF), str(tmp_path / "states")
    for name in ("int_customer_orders", "int_product_sales"):
        m[name].write.parquet(str(tmp_path / name))
    orders, lines = (spark.read.parquet(str(tmp_path / n)) for n in ("int_customer_orders", "int_product_sales"))
    first, order = F.year("order_date") < 2000, F.col("sales_order_id")
    # before: some orders of 2000 and later were missing, and there were others that have gone since
    gone = lines.filter(~first & (order % 5 == 1)).withColumn("product_id", F.lit(10 ** 6).cast("bigint"))
    old_lines = lines.filter(first | (order % 3 != 0)).unionByName(gone)
    old_orders = orders.filter(first | (order % 3 != 0)).withColumn(
        "order_channel", F.when(first, F.col("order_channel")).otherwise("Online"))
    mart_state.store(spark, root, "v1", mart_state.states(old_orders, old_lines))
    before = {t: {p.name for p in parts} for t, parts in publish.state_of(spark, root).items()}
    years = sorted(r[0] for r in lines.select(F.year("order_date")).distinct().collect() if r[0] >= 2000)
    state = mart_state.refresh(spark, root, "v2", orders, lines, years)
    # no other year's part was written again
    for table, parts in publish.state_of(spark, root).items():
        assert {p.name for p in parts} == {p for p in before[table] if int(p.split("/")[1]) < 2000} | {f"v2/{y}" for y in years}
        assert sorted(d for d in os.listdir(publish.folder(root, table, "v2")) if "=" in d) == [f"order_year={y}" for y in years]
    _same(mart_state.customer_metrics(state, m["stg_customers"], TEST_AS_OF), marts.dim_customer_metrics(orders, lines, TEST_AS_OF))
    _same(mart_state.product_performance(state, m["stg_products"], TEST_AS_OF),
          marts.fct_product_performance(lines, m["stg_products"], TEST_AS_OF))
    assert publish.rollback(spark, root) == "v1"  # the earlier states are still there
    assert publish.read_current(spark, root, "state_product").filter("product_id = 1000000").count() > 0


def test_keys_spread_thinly_cost_a_row_a_value(spark):
    import datetime as dt
    day = dt.date(2000, 3, 1)
    lines = spark.createDataFrame([(1, 7, day), (1, 10 ** 9, day), (1, 7, day), (1, None, day), (2, 10 ** 9, day)],
                                  "product_id long, customer_id long, order_date date").withColumn("order_year", F.year("order_date"))
    pairs = mart_state._pairs(lines, "product_id", "customer_id")
    assert pairs.count() == 3 and all(f.dataType.typeName() != "binary" for f in pairs.schema)  # a bitmap takes 4 KB
    later = pairs.unionByName(pairs.withColumn("order_year", F.lit(2001)))
    counted = mart_state._distinct(later, "product_id", "customer_id", "n").collect()
    assert {(r["product_id"], r["n"]) for r in counted} == {(1, 2), (2, 1)}
