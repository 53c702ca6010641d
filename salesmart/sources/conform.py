"""Test-data adapter: derive the seven retail sources from the TPC-H-like tables.

The driver's test data is a TPC-H-style star schema, not a retail OLTP
database, so every column below is a *synthetic stand-in* chosen to exercise
the models (NULL persons, unshipped orders, several order statuses, products
with lifecycle dates, money with 2-4 decimals).  All money is built from
integer cents so decimal arithmetic stays exact in any engine.

Plan shape: ``lineitem`` is read once per branch; the per-order header totals
and the detail lines are both dealt by ``l_orderkey`` so the header × detail
join downstream reuses that hash partitioning (no extra exchange).  The lines
are numbered only for readers of their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the adapter.
DIMENSION_MODIFIED = "2001-08-01 00:00:00"   # ModifiedDate of dimension rows
DUE_DAYS = 730                               # DueDate = OrderDate + 730 days
NO_PERSON_SEGMENT = "MACHINERY"              # customers without a person (store accounts)
ONLINE_PRIORITIES = ("1-URGENT", "2-HIGH")
PRODUCT_LINES = ("R ", "M ", "T ", "S ")      # by partkey % 5 (4 → NULL)
PRODUCT_CLASSES = ("H ", "M ", "L ")          # by size % 4 (3 → NULL)
PRODUCT_STYLES = ("U ", "M ", "W ")           # by partkey % 4 (3 → NULL)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(s: str):
    return F.to_timestamp_ntz(F.lit(s))


def _cents_to_money(cents, scale_lit: str = "0.01"):
    """Integer cents (or ten-thousandths) → decimal(19,4), exactly."""
    return (cents.cast("decimal(19,4)") * F.lit(scale_lit).cast("decimal(9,8)")).cast("decimal(19,4)")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("CustomerID"),
        F.when(F.col("c_mktsegment") != NO_PERSON_SEGMENT, F.col("c_custkey")).alias("PersonID"),
        F.col("c_name").alias("AccountNumber"),
        F.lit(None).cast("bigint").alias("StoreID"),
        F.col("c_nationkey").cast("bigint").alias("TerritoryID"),
        _ts(DIMENSION_MODIFIED).alias("ModifiedDate"),
        F.md5(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("rowguid"),
    )


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("BusinessEntityID"),
        F.lit("Customer").alias("FirstName"),
        F.substring_index("c_name", "#", -1).alias("LastName"),
        F.when(k % 3 == 1, F.lit(" M ")).when(k % 3 == 2, F.lit("")).alias("MiddleName"),
        (k % 3).cast("int").alias("EmailPromotion"),
        # every 7th address is malformed, to exercise the e-mail checks
        F.concat(F.lit("customer"), k.cast("string"),
                 F.when(k % 7 == 0, F.lit("-at-example.com")).otherwise(F.lit("@example.com"))).alias("EmailAddress"),
        _ts(DIMENSION_MODIFIED).alias("ModifiedDate"),
    )


#: Line numbers that fit beside the order key in a line's id.
LINES_AN_ORDER = 1 << 24


#: Columns that tell the lines of an order apart, in the order that numbers them.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem dealt by order key as it is stored: the money columns are made after this exchange, so that
    it carries no decimals (24 bytes each) and the header × detail join reuses it."""
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER).repartition("l_orderkey")


def _priced(lines: DataFrame) -> DataFrame:
    """Lines with exact money columns (shared by header totals and detail)."""
    qty = F.col("l_quantity").cast("smallint")
    ext_cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    unit_int = F.call_function("div", ext_cents, qty.cast("bigint") * 100)
    disc_pct = F.round(F.col("l_discount") * 100).cast("bigint")
    tax_pct = F.round(F.col("l_tax") * 100).cast("bigint")
    return (lines.select("*", qty.alias("OrderQty"),
                         _cents_to_money(unit_int).alias("UnitPrice"),
                         _cents_to_money(disc_pct).alias("UnitPriceDiscount"),
                         tax_pct.alias("tax_pct"))
            .withColumn("LineTotal", (F.col("OrderQty") * F.col("UnitPrice")
                                      * (F.lit(1) - F.col("UnitPriceDiscount"))).cast("decimal(38,6)")))


def sales_order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    # (l_orderkey, l_linenumber) repeats in the test data; full rows do not, so
    # number the lines of each order by all columns for a stable detail id.
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    # ids of different orders never meet; a longer order, or a key beyond 2 ** 39, is an error and no wrong id
    line = F.when(F.col("_line") < LINES_AN_ORDER, F.col("_line")).otherwise(
        F.raise_error(F.lit(f"an order has {LINES_AN_ORDER} lines or more")).cast("int"))
    # null only with the order key, and said so (the coalesce never applies): a filter on ids that are not
    # null then asks for the key alone, and where no id is read, Catalyst drops the numbering and its sort
    key = F.col("l_orderkey")
    line_id = F.when(key.isNotNull(), F.coalesce(key * LINES_AN_ORDER + line, F.lit(0).cast("bigint")))
    # window first, rename after: the output then stays hash-partitioned by the
    # order key under its new name, so the header × detail join adds no exchange
    numbered = _lines_by_order(spark, sf_dir).withColumn("_line", F.row_number().over(w))
    return _priced(numbered).select(
        F.col("l_orderkey").alias("SalesOrderID"),
        line_id.alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
        F.col("l_shipdate").alias("ModifiedDate"),
    )


def sales_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    totals = (_priced(_lines_by_order(spark, sf_dir))
              .groupBy("l_orderkey")
              .agg(F.max("l_shipdate").alias("last_ship"),
                   F.sum("LineTotal").alias("sub_total"),
                   F.sum(F.floor(F.col("LineTotal") * F.col("tax_pct"))).alias("tax_cents")))
    h = o.join(totals, o.o_orderkey == totals.l_orderkey, "left")
    online = F.col("o_orderpriority").isin(*ONLINE_PRIORITIES)
    status = (F.when(F.col("o_orderstatus") == "O", 1)
              .when(F.col("o_orderstatus") == "F", 5)
              .when(F.col("o_orderstatus") == "P",
                    F.when(F.col("o_orderpriority") == "5-LOW", 6).otherwise(2)))
    sub = F.coalesce(F.col("sub_total"), F.lit(0)).cast("decimal(19,4)")
    tax = _cents_to_money(F.coalesce(F.col("tax_cents"), F.lit(0)))
    freight = _cents_to_money(F.floor(sub * F.lit(2.5).cast("decimal(2,1)")))
    ship = F.when(F.col("last_ship") >= F.col("o_orderdate"), F.col("last_ship"))
    return h.select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_orderdate").alias("OrderDate"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {DUE_DAYS} DAYS")).alias("DueDate"),
        ship.alias("ShipDate"),
        status.cast("smallint").alias("Status"),
        online.alias("OnlineOrderFlag"),
        F.concat(F.lit("so"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
        F.when(~online, F.concat(F.lit("PO"), F.col("o_orderkey").cast("string"))).alias("PurchaseOrderNumber"),
        F.concat(F.lit("AW"), F.col("o_custkey").cast("string")).alias("AccountNumber"),
        F.col("o_custkey").alias("CustomerID"),
        F.when(~online, 270 + F.col("o_orderkey") % 20).alias("SalesPersonID"),
        (1 + F.col("o_custkey") % 10).alias("TerritoryID"),
        F.col("o_custkey").alias("ShipToAddressID"),
        F.col("o_custkey").alias("BillToAddressID"),
        F.when(online, F.lit(1)).otherwise(F.lit(5)).cast("bigint").alias("ShipMethodID"),
        sub.alias("SubTotal"),
        tax.alias("TaxAmt"),
        freight.alias("Freight"),
        (sub + tax + freight).cast("decimal(19,4)").alias("TotalDue"),
        F.coalesce(ship, F.col("o_orderdate")).alias("ModifiedDate"),
        F.md5(F.concat(F.lit("h"), F.col("o_orderkey").cast("string"))).alias("rowguid"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    retail_cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    cost_e4 = ((retail_cents * 6) - (retail_cents * 6) % 10) / 10

    def by_mod(x, m, values):
        expr = None
        for i, v in enumerate(values):
            expr = F.when(x % m == i, F.lit(v)) if expr is None else expr.when(x % m == i, F.lit(v))
        return expr

    return p.select(
        k.alias("ProductID"),
        F.when(size <= 48, F.substring_index("p_brand", "#", -1).cast("bigint")).alias("ProductSubcategoryID"),
        (k % 50).alias("ProductModelID"),
        F.concat(F.lit("pn-"), k.cast("string")).alias("ProductNumber"),
        F.col("p_name").alias("Name"),
        (size % 2 == 0).alias("MakeFlag"),
        F.when(size % 7 != 0, size > 10).alias("FinishedGoodsFlag"),
        F.when(k % 6 != 0, F.lower("p_type")).alias("Color"),
        size.cast("string").alias("Size"),
        F.when(size > 25, F.lit("CM ")).alias("SizeUnitMeasureCode"),
        F.when(size % 2 == 1, F.lit("LB ")).alias("WeightUnitMeasureCode"),
        F.when(size % 3 != 0, (size.cast("decimal(8,2)") * F.lit(1.5).cast("decimal(2,1)")).cast("decimal(8,2)")).alias("Weight"),
        by_mod(k, 5, PRODUCT_LINES).alias("ProductLine"),
        by_mod(size, 4, PRODUCT_CLASSES).alias("Class"),
        by_mod(k, 4, PRODUCT_STYLES).alias("Style"),
        (size * 10).alias("SafetyStockLevel"),
        (size * 7).alias("ReorderPoint"),
        (size % 5).alias("DaysToManufacture"),
        _cents_to_money(cost_e4.cast("bigint"), "0.0001").alias("StandardCost"),
        _cents_to_money(retail_cents, "0.0001").alias("ListPrice"),
        F.when(size == 1, _ts("2030-01-01 00:00:00")).otherwise(_ts("1994-01-01 00:00:00")).alias("SellStartDate"),
        F.when(size > 45, _ts("2000-12-31 00:00:00")).alias("SellEndDate"),
        F.when(size == 50, _ts("2001-01-01 00:00:00")).alias("DiscontinuedDate"),
        _ts(DIMENSION_MODIFIED).alias("ModifiedDate"),
        F.md5(F.concat(F.lit("p"), k.cast("string"))).alias("rowguid"),
    )


def product_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    sub = F.substring_index("p_brand", "#", -1).cast("bigint")
    return (p.select(sub.alias("ProductSubcategoryID")).distinct()
            .select("ProductSubcategoryID",
                    F.concat(F.lit("Subcategory "), F.col("ProductSubcategoryID").cast("string")).alias("Name"),
                    (1 + F.col("ProductSubcategoryID") % 4).alias("ProductCategoryID"),
                    _ts(DIMENSION_MODIFIED).alias("ModifiedDate")))


def product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = product_subcategory(spark, sf_dir)
    return (sub.select(F.col("ProductCategoryID")).distinct()
            .select("ProductCategoryID", _ts(DIMENSION_MODIFIED).alias("ModifiedDate")))


BUILDERS = {
    "customer": customer,
    "person": person,
    "sales_order_header": sales_order_header,
    "sales_order_detail": sales_order_detail,
    "product": product,
    "product_subcategory": product_subcategory,
    "product_category": product_category,
}


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven sources as lazy DataFrames over the test tables."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


def clean_sources(spark: SparkSession, sf_dir: str, loaded_at: str) -> dict[str, DataFrame]:
    """The sources without the rows that break a declared rule, all loaded at one time (synthetic stand-in).

    Kept are shipped and taxed orders of customers with a person that fell due
    and were shipped before ``loaded_at``, and of their lines those of a product that was on
    sale by then and stands once in the order.
    """
    src = sources(spark, sf_dir)
    now = _ts(loaded_at)
    src["product"] = src["product"].filter(F.col("SellStartDate") <= now)
    people = src["customer"].filter(F.col("PersonID").isNotNull()).select("CustomerID")
    orders = src["sales_order_header"].filter((F.col("Status") == 5) & (F.col("TaxAmt") > 0) & (F.col("DueDate") <= now)
                                              & (F.col("ShipDate") <= now))
    src["sales_order_header"] = orders.join(people, "CustomerID", "left_semi").select(*orders.columns)
    lines = src["sales_order_detail"].join(src["product"].select("ProductID"), "ProductID", "left_semi")
    once = lines.groupBy("SalesOrderID", "ProductID").agg(F.max("SalesOrderDetailID").alias("SalesOrderDetailID"))
    src["sales_order_detail"] = (lines.join(once.select("SalesOrderDetailID"), "SalesOrderDetailID", "left_semi")
                                 .select(*src["sales_order_detail"].columns))
    return {n: df.withColumn("ModifiedDate", now) for n, df in src.items()}


def respelled_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The sources with every second product's name and colour in capitals, and a directory of accounts (synthetic stand-in).

    The directory lacks every fifth customer and spells the others' accounts in small letters with a trailing blank.
    """
    src = sources(spark, sf_dir)
    src["product"] = src["product"].withColumns({
        c: F.when(F.col("ProductID") % 2 == 0, F.upper(c)).otherwise(F.col(c)) for c in ("Name", "Color")})
    k = F.col("CustomerID")
    src["accounts"] = src["customer"].filter(k % 5 != 0).select(F.concat(F.lit("aw"), k.cast("string"), F.lit(" ")).alias("account"))
    return src


# Fixed values of the two customer snapshots used by the history operators.
SNAPSHOT_1_AT = "2001-01-01 00:00:00"
SNAPSHOT_2_AT = "2001-06-01 00:00:00"


def customer_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the customer dimension (synthetic stand-in).

    Snapshot 2 drops keys ending in 8, adds keys ending in 9, changes the
    e-mail of every 5th key and the segment of every 4th key; changed and new
    rows carry the later timestamp.
    """
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.com"))
    snap1 = c.filter(k % 10 != 9).select(
        k.alias("customer_id"), F.col("c_name").alias("name"), email.alias("email"),
        F.col("c_mktsegment").alias("segment"), _ts(SNAPSHOT_1_AT).alias("updated_at"))
    new_email = F.when(k % 5 == 0, F.concat(F.lit("customer"), k.cast("string"), F.lit("@new.example.com"))) \
        .otherwise(email)
    new_segment = F.when(k % 4 == 0, F.lit("AUTOMOBILE")).otherwise(F.col("c_mktsegment"))
    touched = (k % 10 == 9) | (k % 5 == 0) | ((k % 4 == 0) & (F.col("c_mktsegment") != "AUTOMOBILE"))
    snap2 = c.filter(k % 10 != 8).select(
        k.alias("customer_id"), F.col("c_name").alias("name"), new_email.alias("email"),
        new_segment.alias("segment"),
        F.when(touched, _ts(SNAPSHOT_2_AT)).otherwise(_ts(SNAPSHOT_1_AT)).alias("updated_at"))
    return snap1, snap2
