"""Staging models (MOD-1..3): rename, type, clean, and join each source pair.

Staging models are views in the reference: here they are lazy DataFrames.
Keys keep the source's integer width (bigint with the test data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.business import bit
from salesmart.functions.text import clean, clean_upper, varchar


def stg_customers(customer: DataFrame, person: DataFrame) -> DataFrame:
    """MOD-1: customers with a person; NULL person/customer keys are dropped."""
    c = customer.filter(F.col("CustomerID").isNotNull() & F.col("PersonID").isNotNull()).alias("c")
    p = person.alias("p")
    return c.join(p, F.col("c.PersonID") == F.col("p.BusinessEntityID"), "left").select(
        F.col("c.CustomerID").cast("bigint").alias("customer_id"),
        F.col("c.PersonID").cast("bigint").alias("person_id"),
        clean_upper("c.AccountNumber").alias("account_number"),
        F.col("c.StoreID").cast("bigint").alias("store_id"),
        F.col("c.TerritoryID").cast("bigint").alias("territory_id"),
        clean("p.FirstName", "").alias("first_name"),
        clean("p.LastName", "").alias("last_name"),
        clean("p.MiddleName", "").alias("middle_name"),
        F.coalesce(F.col("p.EmailPromotion"), F.lit(0)).cast("int").alias("email_promotion"),
        F.col("c.ModifiedDate").cast("timestamp_ntz").alias("modified_date"),
        varchar("c.rowguid", 36).alias("row_guid"),
    )


def stg_products(product: DataFrame, subcategory: DataFrame) -> DataFrame:
    """MOD-2: products with their subcategory name and category id."""
    p = product.filter(F.col("ProductID").isNotNull()).alias("p")
    ps = subcategory.select("ProductSubcategoryID", "Name", "ProductCategoryID").alias("ps")
    return p.join(ps, F.col("p.ProductSubcategoryID") == F.col("ps.ProductSubcategoryID"), "left").select(
        F.col("p.ProductID").cast("bigint").alias("product_id"),
        F.col("p.ProductSubcategoryID").cast("bigint").alias("product_subcategory_id"),
        F.col("p.ProductModelID").cast("bigint").alias("product_model_id"),
        clean_upper("p.ProductNumber").alias("product_number"),
        clean("p.Name").alias("product_name"),
        bit("p.MakeFlag").alias("make_flag"),
        bit("p.FinishedGoodsFlag").alias("finished_goods_flag"),
        clean("p.Color", "Unknown").alias("color"),
        clean("p.Size", "").alias("size"),
        clean("p.SizeUnitMeasureCode", "").alias("size_unit_measure_code"),
        clean("p.WeightUnitMeasureCode", "").alias("weight_unit_measure_code"),
        F.coalesce(F.col("p.Weight"), F.lit(0)).cast("decimal(8,2)").alias("weight"),
        clean("p.ProductLine", "").alias("product_line"),
        clean("p.Class", "").alias("product_class"),
        clean("p.Style", "").alias("product_style"),
        F.col("p.SafetyStockLevel").cast("int").alias("safety_stock_level"),
        F.col("p.ReorderPoint").cast("int").alias("reorder_point"),
        F.col("p.DaysToManufacture").cast("int").alias("days_to_manufacture"),
        F.col("p.StandardCost").cast("decimal(19,4)").alias("standard_cost"),
        F.col("p.ListPrice").cast("decimal(19,4)").alias("list_price"),
        F.col("p.SellStartDate").cast("date").alias("sell_start_date"),
        F.col("p.SellEndDate").cast("date").alias("sell_end_date"),
        F.col("p.DiscontinuedDate").cast("date").alias("discontinued_date"),
        clean("ps.Name", "").alias("subcategory_name"),
        F.coalesce(F.col("ps.ProductCategoryID"), F.lit(0)).cast("int").alias("product_category_id"),
        F.col("p.ModifiedDate").cast("timestamp_ntz").alias("modified_date"),
        varchar("p.rowguid", 36).alias("row_guid"),
    )


def stg_sales_orders(header: DataFrame, detail: DataFrame) -> DataFrame:
    """MOD-3: one row per order line (inner join of header and detail)."""
    h = header.filter(F.col("SalesOrderID").isNotNull() & F.col("CustomerID").isNotNull()).alias("h")
    d = detail.filter(F.col("SalesOrderDetailID").isNotNull() & F.col("ProductID").isNotNull()).alias("d")
    return h.join(d, F.col("h.SalesOrderID") == F.col("d.SalesOrderID"), "inner").select(
        F.col("h.SalesOrderID").cast("bigint").alias("sales_order_id"),
        F.col("d.SalesOrderDetailID").cast("bigint").alias("sales_order_detail_id"),
        F.col("h.OrderDate").cast("date").alias("order_date"),
        F.col("h.DueDate").cast("date").alias("due_date"),
        F.col("h.ShipDate").cast("date").alias("ship_date"),
        F.col("h.Status").cast("smallint").alias("order_status"),
        bit("h.OnlineOrderFlag").alias("is_online_order"),
        clean_upper("h.SalesOrderNumber").alias("sales_order_number"),
        clean("h.PurchaseOrderNumber", "").alias("purchase_order_number"),
        clean("h.AccountNumber", "").alias("account_number"),
        F.col("h.CustomerID").cast("bigint").alias("customer_id"),
        F.coalesce(F.col("h.SalesPersonID"), F.lit(0)).cast("bigint").alias("sales_person_id"),
        F.col("h.TerritoryID").cast("bigint").alias("territory_id"),
        F.col("h.ShipToAddressID").cast("bigint").alias("ship_to_address_id"),
        F.col("h.BillToAddressID").cast("bigint").alias("bill_to_address_id"),
        F.col("h.ShipMethodID").cast("bigint").alias("ship_method_id"),
        F.col("d.ProductID").cast("bigint").alias("product_id"),
        F.col("d.OrderQty").cast("smallint").alias("order_quantity"),
        F.col("d.UnitPrice").cast("decimal(19,4)").alias("unit_price"),
        F.col("d.UnitPriceDiscount").cast("decimal(19,4)").alias("unit_price_discount"),
        F.col("d.LineTotal").cast("decimal(38,6)").alias("line_total"),
        (F.col("d.OrderQty") * F.col("d.UnitPrice") * (F.lit(1) - F.col("d.UnitPriceDiscount")))
        .cast("decimal(38,6)").alias("calculated_line_total"),
        F.col("h.SubTotal").cast("decimal(19,4)").alias("order_subtotal"),
        F.col("h.TaxAmt").cast("decimal(19,4)").alias("order_tax_amount"),
        F.col("h.Freight").cast("decimal(19,4)").alias("order_freight"),
        F.col("h.TotalDue").cast("decimal(19,4)").alias("order_total_due"),
        F.col("h.ModifiedDate").cast("timestamp_ntz").alias("header_modified_date"),
        F.col("d.ModifiedDate").cast("timestamp_ntz").alias("detail_modified_date"),
        varchar("h.rowguid", 36).alias("header_row_guid"),
    )
