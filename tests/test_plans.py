"""Plan shape: pruning/pushdown reach the scan, rewrites avoid Expand, joins stay co-partitioned."""

import contextlib
import io

from conftest import SF_SMALL

from salesmart.plans import marts
from salesmart.plans.models import TEST_AS_OF, models_on_testdata


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


def main_exchanges(p: str) -> int:
    """Hash exchanges of the plan."""
    return p.count("Exchange hashpartitioning")


def test_scan_pruning_and_pushdown(spark):
    p = plan(models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["stg_sales_orders"])
    assert "o_totalprice" not in p          # unused order column never read
    assert "IsNotNull(o_orderkey)" in p      # key filter pushed to the parquet scan
    assert "BroadcastExchange" not in p      # no estimate-based broadcast of the line side
    # one scan of the lines for the header totals and one for the numbering; ids need no third
    assert p.count("lineitem.parquet") == 2 and "Subquery" not in p


def test_header_detail_join_is_co_partitioned(spark):
    p = plan(models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["stg_sales_orders"])
    # orders, lineitem (header totals) and lineitem (line numbering): one exchange each, none for the join
    assert main_exchanges(p) == 3


def test_int_customer_orders_aggregates_without_new_exchange(spark):
    p = plan(models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["int_customer_orders"])
    # 3 for the order lines, 2 for customer × person, 2 for the join with customers
    assert main_exchanges(p) == 7


def test_marts_scan_the_line_fact_twice_and_expand_keys_only(spark, tmp_path):
    ips = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["int_product_sales"]
    ips.write.parquet(str(tmp_path / "ips"))
    ips = spark.read.parquet(str(tmp_path / "ips"))
    products = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["stg_products"]
    for mart in (marts.fct_sales_summary(ips), marts.fct_product_performance(ips, products, TEST_AS_OF)):
        p = plan(mart)
        assert p.count(f"{tmp_path}/ips") == 2
        expands = [line for line in p.splitlines() if "Expand" in line]
        assert expands and not any("line_total" in line or "profit" in line for line in expands)


def test_refresh_prunes_partitions_and_equals_full_rebuild(spark, tmp_path):
    from pyspark.sql import functions as F

    from salesmart.plans.incremental import PARTITION_COLUMN, refresh_sales_summary, with_partition_column
    m = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)
    path = str(tmp_path / "ips")
    with_partition_column(m["int_product_sales"]).write.partitionBy(PARTITION_COLUMN).parquet(path)
    stored = spark.read.parquet(path)
    full = marts.fct_sales_summary(stored)
    refreshed = refresh_sales_summary(full, stored, 2000)
    assert "PartitionFilters: [isnotnull(order_year" in plan(
        marts.fct_sales_summary(stored.filter(F.col(PARTITION_COLUMN) >= 2000)))
    assert refreshed.exceptAll(full).count() == 0 and full.exceptAll(refreshed).count() == 0


def _tables(spark, path):
    """Three lines of two orders, one of them without a key."""
    import datetime as dt
    day = dt.datetime(2000, 1, 5)
    spark.createDataFrame([(1, 7, "F", 10.0, day, "1-URGENT"), (2, 7, "O", 10.0, day, "5-LOW")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(1, 5, 1, 2, 2.0, 40.0, 0.05, 0.01, "N", "O", day), (1, 5, 1, 1, 1.0, 30.0, 0.0, 0.02, "N", "O", day),
                           (None, 5, 1, 1, 1.0, 20.0, 0.0, 0.0, "N", "O", day)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{path}/lineitem.parquet")


def test_lines_are_numbered_for_readers_of_their_ids_only(spark, tmp_path):
    from salesmart.plans import staging
    from salesmart.sources import conform
    _tables(spark, str(tmp_path))
    detail = conform.sales_order_detail(spark, str(tmp_path))
    lines = staging.stg_sales_orders(conform.sales_order_header(spark, str(tmp_path)), detail)
    assert "Window" in plan(lines) and "Window" not in plan(lines.drop("sales_order_detail_id"))
    assert detail.filter("SalesOrderDetailID IS NULL").count() == 1  # the line without an order
    found = {(r["sales_order_detail_id"], float(r["line_total"])) for r in lines.collect()}
    assert found == {(2 ** 24 + 1, 0.3), (2 ** 24 + 2, 0.38)}
    assert lines.drop("sales_order_detail_id").count() == 2


def test_lines_are_exchanged_before_their_money_columns_are_made(spark, tmp_path):
    from salesmart.sources import conform
    _tables(spark, str(tmp_path))
    p = plan(conform.sales_order_detail(spark, str(tmp_path)))
    assert p.count("Exchange hashpartitioning(l_orderkey") == 1
    assert "decimal" not in p[p.index("Exchange hashpartitioning(l_orderkey"):]


def test_relationship_checks_exchange_lines_by_three_sets_of_columns_and_number_none(spark, tmp_path, monkeypatch):
    import re

    from salesmart.operators import quality
    from salesmart.plans.queries import all_queries
    path = str(tmp_path)
    _tables(spark, path)
    spark.createDataFrame([(7, "Customer#7", 1, "BUILDING"), (8, "Customer#8", 1, "MACHINERY")],
                          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(6, "p", "Brand#1", "t", 3, 9.0)],  # the lines' product 5 is not there
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(f"{path}/part.parquet")
    made, before = [], quality.counted_together
    monkeypatch.setattr(quality, "counted_together", lambda *args: made.append(before(*args)) or made[-1])
    found = {r["check_id"]: r["failures"] for r in all_queries()["dq_relationships"](spark, path).collect()}
    assert len(found) == 6 and {k: n for k, n in found.items() if n} == {"stg_sales_orders.relationships.product_id": 2}
    ran = made[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(made) == 1 and "Window" not in ran
    # by order go the keys alone (products are only asked for nulls), with the product, and with the ship date, each once
    scans = [re.sub(r"#\d+L?", "", s) for s in re.findall(r"FileScan parquet \[(l_[^]]*)\]", ran)]
    assert sorted(scans) == ["l_orderkey,l_partkey", "l_orderkey,l_partkey", "l_orderkey,l_shipdate"]
    assert ran.count("+- Exchange hashpartitioning(l_orderkey") == 3


def test_checks_of_many_models_join_the_lines_once(spark):
    from salesmart.operators.rules import declared_checks
    from salesmart.plans.queries import _models_for
    lazy = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)
    checks = declared_checks()
    stored = _models_for(spark, SF_SMALL, checks)
    for c in checks:  # every column that a check reads is there, with its type
        for name in (c.column, c.params.get("start"), c.params.get("end")):
            assert name is None or stored[c.model].schema[name].dataType == lazy[c.model].schema[name].dataType
    for name in ("int_product_sales", "int_customer_orders", "fct_sales_summary", "fct_product_performance", "dim_customer_metrics"):
        assert "lineitem.parquet" not in plan(stored[name]) and stored[name].columns == lazy[name].columns
    a, b = lazy["int_product_sales"], stored["int_product_sales"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stored_lines_are_clustered_by_order_and_by_product(spark):
    from salesmart.operators.rules import declared_checks
    from salesmart.plans.queries import _models_for
    stored = _models_for(spark, SF_SMALL, declared_checks())
    assert "Exchange hashpartitioning(sales_order_id" not in plan(stored["int_customer_orders"])
    sold = stored["int_product_sales"]
    # the lines have their products' attributes and are not exchanged by product again
    assert "part.parquet" not in plan(sold) and "Exchange" not in plan(sold.groupBy("product_id").agg({"line_profit": "sum"}))
    assert "Exchange" not in plan(sold.filter("line_profit < 0"))


def test_summary_exchanges_no_sums_by_order(spark):
    p = plan(models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["fct_sales_summary"])
    by_order = [line for line in p.splitlines() if "HashAggregate(keys=[" in line and "sales_order_id" in line]
    assert by_order and not any("sum(" in line for line in by_order)


def test_summary_of_lines_without_a_date(spark):
    """Their orders and sums are counted, their customers and products are not."""
    from pyspark.sql import functions as F
    ips = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)["int_product_sales"]
    some = ips.filter("sales_order_id % 3 = 0").withColumn("order_date", F.lit(None).cast("date"))
    rows = marts.fct_sales_summary(ips.filter("sales_order_id % 3 <> 0").unionByName(some))
    row = rows.filter("order_date IS NULL").first()
    assert row["total_orders"] == some.select("sales_order_id").distinct().count() > 0
    assert row["online_orders"] == some.filter("order_channel = 'Online'").select("sales_order_id").distinct().count()
    assert row["total_revenue"] == some.agg({"line_total": "sum"}).first()[0]
    assert row["unique_customers"] is None and row["unique_products_sold"] is None
    assert rows.filter("order_date IS NOT NULL AND unique_customers > 0").count() == rows.count() - 1
