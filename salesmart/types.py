"""Declared output schemas of the sources and models (§1.3).

Fixed values: column names and types, in order, of every model and adapted
source (nullability is not part of the contract: parquet reads every column
as nullable).  ``check_schema`` reports drift; builds record it as a check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SCHEMAS = {
    "stg_customers": "customer_id BIGINT,person_id BIGINT,account_number STRING,store_id BIGINT,territory_id BIGINT,first_name STRING,last_name STRING,middle_name STRING,email_promotion INT,modified_date TIMESTAMP_NTZ,row_guid STRING",
    "stg_products": "product_id BIGINT,product_subcategory_id BIGINT,product_model_id BIGINT,product_number STRING,product_name STRING,make_flag BOOLEAN,finished_goods_flag BOOLEAN,color STRING,size STRING,size_unit_measure_code STRING,weight_unit_measure_code STRING,weight DECIMAL(8,2),product_line STRING,product_class STRING,product_style STRING,safety_stock_level INT,reorder_point INT,days_to_manufacture INT,standard_cost DECIMAL(19,4),list_price DECIMAL(19,4),sell_start_date DATE,sell_end_date DATE,discontinued_date DATE,subcategory_name STRING,product_category_id INT,modified_date TIMESTAMP_NTZ,row_guid STRING",
    "stg_sales_orders": "sales_order_id BIGINT,sales_order_detail_id BIGINT,order_date DATE,due_date DATE,ship_date DATE,order_status SMALLINT,is_online_order BOOLEAN,sales_order_number STRING,purchase_order_number STRING,account_number STRING,customer_id BIGINT,sales_person_id BIGINT,territory_id BIGINT,ship_to_address_id BIGINT,bill_to_address_id BIGINT,ship_method_id BIGINT,product_id BIGINT,order_quantity SMALLINT,unit_price DECIMAL(19,4),unit_price_discount DECIMAL(19,4),line_total DECIMAL(38,6),calculated_line_total DECIMAL(38,6),order_subtotal DECIMAL(19,4),order_tax_amount DECIMAL(19,4),order_freight DECIMAL(19,4),order_total_due DECIMAL(19,4),header_modified_date TIMESTAMP_NTZ,detail_modified_date TIMESTAMP_NTZ,header_row_guid STRING",
    "int_customer_orders": "customer_order_surrogate_key STRING,customer_id BIGINT,person_id BIGINT,account_number STRING,first_name STRING,last_name STRING,middle_name STRING,full_name STRING,email_promotion INT,territory_id BIGINT,store_id BIGINT,sales_order_id BIGINT,order_date DATE,due_date DATE,ship_date DATE,order_status_name STRING,order_status_code SMALLINT,order_channel STRING,is_online_order BOOLEAN,days_until_due INT,days_to_ship INT,shipping_performance STRING,total_order_quantity BIGINT,total_line_total DECIMAL(38,6),total_calculated_line_total DECIMAL(38,6),total_gross_line_total DECIMAL(35,4),total_discount_amount DECIMAL(38,6),has_discount_flag INT,order_subtotal DECIMAL(19,4),order_tax_amount DECIMAL(19,4),order_freight DECIMAL(19,4),order_total_due DECIMAL(19,4),sales_person_id BIGINT,order_territory_id BIGINT,header_modified_date TIMESTAMP_NTZ,customer_modified_date TIMESTAMP_NTZ",
    "int_product_sales": "product_sale_surrogate_key STRING,product_id BIGINT,product_number STRING,product_name STRING,product_subcategory_id BIGINT,subcategory_name STRING,product_category_id INT,product_model_id BIGINT,color STRING,size STRING,product_line STRING,product_class STRING,product_style STRING,make_flag BOOLEAN,finished_goods_flag BOOLEAN,standard_cost DECIMAL(19,4),list_price DECIMAL(19,4),sale_unit_price DECIMAL(19,4),unit_profit DECIMAL(20,4),profit_margin_pct DECIMAL(38,18),discount_from_list_pct DECIMAL(38,18),sales_order_id BIGINT,sales_order_detail_id BIGINT,order_date DATE,due_date DATE,ship_date DATE,customer_id BIGINT,order_status_name STRING,order_status_code SMALLINT,order_channel STRING,order_quantity SMALLINT,unit_price DECIMAL(19,4),unit_price_discount DECIMAL(19,4),line_total DECIMAL(38,6),calculated_line_total DECIMAL(38,6),gross_line_total DECIMAL(25,4),discount_amount DECIMAL(38,6),line_profit DECIMAL(26,4),net_line_profit DECIMAL(38,6),sell_start_date DATE,sell_end_date DATE,discontinued_date DATE,product_lifecycle_status STRING,safety_stock_level INT,reorder_point INT,days_to_manufacture INT,territory_id BIGINT,sales_person_id BIGINT,detail_modified_date TIMESTAMP_NTZ,product_modified_date TIMESTAMP_NTZ",
    "dim_customer_metrics": "customer_id BIGINT,person_id BIGINT,account_number STRING,full_name STRING,first_name STRING,last_name STRING,email_promotion INT,territory_id BIGINT,store_id BIGINT,total_orders BIGINT,unique_order_dates BIGINT,first_order_date DATE,last_order_date DATE,customer_lifetime_days INT,orders_per_month DOUBLE,days_since_last_order INT,total_lifetime_revenue DECIMAL(38,6),total_gross_revenue DECIMAL(38,4),total_discounts_received DECIMAL(38,6),avg_order_value DOUBLE,max_order_value DECIMAL(38,6),min_order_value DECIMAL(38,6),total_items_purchased BIGINT,avg_items_per_order BIGINT,unique_products_purchased BIGINT,total_products_quantity BIGINT,total_profit_generated DECIMAL(36,4),total_net_profit_generated DECIMAL(38,6),avg_profit_margin_pct DOUBLE,online_orders BIGINT,offline_orders BIGINT,online_revenue DECIMAL(38,6),offline_revenue DECIMAL(38,6),channel_preference STRING,online_order_pct DOUBLE,shipped_orders BIGINT,cancelled_orders BIGINT,on_time_orders BIGINT,late_orders BIGINT,on_time_shipment_pct DOUBLE,orders_with_discount BIGINT,total_discounts_used DECIMAL(38,6),discount_usage_pct DOUBLE,recency_score INT,frequency_score INT,monetary_score INT,rfm_score INT,customer_segment STRING",
    "fct_sales_summary": "order_date DATE,order_year INT,order_month INT,order_day INT,order_month_name STRING,order_day_name STRING,total_orders BIGINT,unique_customers BIGINT,unique_products_sold BIGINT,total_quantity_sold BIGINT,total_revenue DECIMAL(38,6),total_gross_revenue DECIMAL(38,4),total_discount_amount DECIMAL(38,6),total_profit DECIMAL(38,4),total_net_profit DECIMAL(38,6),avg_profit_margin_pct DOUBLE,avg_order_value DECIMAL(38,6),online_orders BIGINT,offline_orders BIGINT,online_revenue DECIMAL(38,6),offline_revenue DECIMAL(38,6),online_order_pct DOUBLE,shipped_orders BIGINT,cancelled_orders BIGINT,shipment_rate_pct DOUBLE,orders_with_discount BIGINT,total_discounts_applied DECIMAL(38,6),avg_discount_pct DOUBLE,discount_order_pct DOUBLE,monthly_total_orders BIGINT,monthly_total_revenue DECIMAL(38,6),monthly_avg_order_value DOUBLE,daily_revenue_pct_of_month DOUBLE",
    "fct_product_performance": "product_id BIGINT,product_number STRING,product_name STRING,product_subcategory_id BIGINT,subcategory_name STRING,product_category_id INT,product_model_id BIGINT,color STRING,size STRING,product_line STRING,product_class STRING,product_style STRING,make_flag BOOLEAN,finished_goods_flag BOOLEAN,product_lifecycle_status STRING,standard_cost DECIMAL(19,4),list_price DECIMAL(19,4),avg_sale_price DOUBLE,min_sale_price DECIMAL(19,4),max_sale_price DECIMAL(19,4),avg_price_vs_list_pct DOUBLE,avg_discount_from_list_pct DOUBLE,total_orders BIGINT,unique_customers BIGINT,days_sold BIGINT,first_sale_date DATE,last_sale_date DATE,sales_period_days INT,total_quantity_sold BIGINT,avg_quantity_per_order BIGINT,max_quantity_per_order SMALLINT,units_sold_per_day DOUBLE,total_revenue DECIMAL(38,6),total_gross_revenue DECIMAL(35,4),total_discount_amount DECIMAL(38,6),avg_line_total DOUBLE,max_line_total DECIMAL(38,6),min_line_total DECIMAL(38,6),revenue_per_day DOUBLE,total_profit DECIMAL(36,4),total_net_profit DECIMAL(38,6),avg_unit_profit DOUBLE,avg_profit_margin_pct DOUBLE,overall_profit_margin_pct DOUBLE,profit_margin_pct DOUBLE,markup_pct DOUBLE,online_orders BIGINT,offline_orders BIGINT,online_revenue DECIMAL(38,6),offline_revenue DECIMAL(38,6),online_order_pct DOUBLE,online_revenue_pct DOUBLE,shipped_orders BIGINT,cancelled_orders BIGINT,shipment_rate_pct DOUBLE,customers_per_order DOUBLE,performance_category STRING,safety_stock_level INT,reorder_point INT,days_to_manufacture INT",
    "src_customer": "CustomerID BIGINT,PersonID BIGINT,AccountNumber STRING,StoreID BIGINT,TerritoryID BIGINT,ModifiedDate TIMESTAMP_NTZ,rowguid STRING",
    "src_person": "BusinessEntityID BIGINT,FirstName STRING,LastName STRING,MiddleName STRING,EmailPromotion INT,EmailAddress STRING,ModifiedDate TIMESTAMP_NTZ",
    "src_header": "SalesOrderID BIGINT,OrderDate TIMESTAMP_NTZ,DueDate TIMESTAMP_NTZ,ShipDate TIMESTAMP_NTZ,Status SMALLINT,OnlineOrderFlag BOOLEAN,SalesOrderNumber STRING,PurchaseOrderNumber STRING,AccountNumber STRING,CustomerID BIGINT,SalesPersonID BIGINT,TerritoryID BIGINT,ShipToAddressID BIGINT,BillToAddressID BIGINT,ShipMethodID BIGINT,SubTotal DECIMAL(19,4),TaxAmt DECIMAL(19,4),Freight DECIMAL(19,4),TotalDue DECIMAL(19,4),ModifiedDate TIMESTAMP_NTZ,rowguid STRING",
    "src_detail": "SalesOrderID BIGINT,SalesOrderDetailID BIGINT,ProductID BIGINT,OrderQty SMALLINT,UnitPrice DECIMAL(19,4),UnitPriceDiscount DECIMAL(19,4),LineTotal DECIMAL(38,6),ModifiedDate TIMESTAMP_NTZ",
    "src_product": "ProductID BIGINT,ProductSubcategoryID BIGINT,ProductModelID BIGINT,ProductNumber STRING,Name STRING,MakeFlag BOOLEAN,FinishedGoodsFlag BOOLEAN,Color STRING,Size STRING,SizeUnitMeasureCode STRING,WeightUnitMeasureCode STRING,Weight DECIMAL(8,2),ProductLine STRING,Class STRING,Style STRING,SafetyStockLevel INT,ReorderPoint INT,DaysToManufacture INT,StandardCost DECIMAL(19,4),ListPrice DECIMAL(19,4),SellStartDate TIMESTAMP_NTZ,SellEndDate TIMESTAMP_NTZ,DiscontinuedDate TIMESTAMP_NTZ,ModifiedDate TIMESTAMP_NTZ,rowguid STRING",
    "src_subcategory": "ProductSubcategoryID BIGINT,Name STRING,ProductCategoryID BIGINT,ModifiedDate TIMESTAMP_NTZ",
    "src_category": "ProductCategoryID BIGINT,ModifiedDate TIMESTAMP_NTZ",
}


def declared(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def check_schema(df: DataFrame, name: str, ignore: tuple[str, ...] = ()) -> list[str]:
    """Differences between ``df`` and the declared schema of ``name`` (empty when equal)."""
    want = [(f.name, f.dataType.simpleString()) for f in declared(name).fields]
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in ignore]
    problems = [f"missing {n}" for n, _ in want if n not in dict(got)]
    problems += [f"unexpected {n}" for n, _ in got if n not in dict(want)]
    problems += [f"{n}: {dict(got)[n]} != {t}" for n, t in want if n in dict(got) and dict(got)[n] != t]
    if not problems and [n for n, _ in got] != [n for n, _ in want]:
        problems.append("column order differs")
    return problems
