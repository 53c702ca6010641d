"""SQL text for the adapter, the eight models and the output projection."""

from __future__ import annotations

AS_OF = "2001-08-15"
SK_NULL = "_dbt_utils_surrogate_key_null_"


def ratio(num: str, den: str, scale: int = 4) -> str:
    """num/den rounded half away from zero at 18 decimals, exactly (inputs of scale ≤ 4)."""
    f = 10 ** scale
    n = f"CAST(({num}) * {f} AS HUGEINT)"
    d = f"CAST(({den}) * {f} AS HUGEINT)"
    q = f"(sign({n}) * sign({d}) * ((2 * abs({n}) * 1000000000000000000 + abs({d})) // (2 * abs({d}))))"
    return (f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL OR ({num}) IS NULL THEN NULL ELSE "
            f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST(0.000000000000000001 AS DECIMAL(19,18)) AS DECIMAL(38,18)) END)")


def div6(num: str, den: str) -> str:
    """Decimal (scale ≤ 6) divided by a positive integer count, half-up at 6 decimals."""
    n = f"CAST(({num}) * 1000000 AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"
    return (f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL THEN NULL ELSE "
            f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(38,6)) END)")


def avg(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def int_avg(x: str) -> str:
    return f"(CAST(SUM({x}) AS BIGINT) // COUNT({x}))"


def money(x: str, unit: str = "0.01") -> str:
    return f"CAST(CAST({x} AS DECIMAL(19,4)) * CAST({unit} AS DECIMAL(9,8)) AS DECIMAL(19,4))"


def sk(*cols: str) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '{SK_NULL}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


_KIND = {
    "i": "CAST({c} AS BIGINT)",
    "d": "CAST({c} AS DOUBLE)",
    "r": "CAST(CAST({c} AS DECIMAL(38,8)) AS DOUBLE)",
    "s": "{c}",
    "b": "{c}",
    "dt": "CAST({c} AS VARCHAR)",
    "ts": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
}


def project(body: str, kinds: str, source: str = "q") -> str:
    """Wrap ``body`` (a SELECT or CTE chain ending in ``source``) in the output projection.

    ``kinds`` is "name:kind name:kind ..." with kind in i, d, r, s, b, dt, ts (r: ratios, rounded to 8 places).
    """
    cols = []
    for item in kinds.split():
        name, kind = item.split(":")
        cols.append(_KIND[kind].format(c=name) + f" AS {name}")
    return f"{body}\nSELECT {', '.join(cols)} FROM {source}"


# ---------------------------------------------------------------- adapter CTEs
_LINES = f"""
priced AS (
  SELECT l.*,
         CAST(l_quantity AS SMALLINT) AS OrderQty,
         {money("(CAST(round(l_extendedprice * 100) AS BIGINT) // (CAST(l_quantity AS BIGINT) * 100))")} AS UnitPrice,
         {money("CAST(round(l_discount * 100) AS BIGINT)")} AS UnitPriceDiscount,
         CAST(round(l_tax * 100) AS BIGINT) AS tax_pct
  FROM lineitem l
),
priced_lines AS (
  SELECT *, CAST(OrderQty * UnitPrice * (1 - UnitPriceDiscount) AS DECIMAL(38,6)) AS LineTotal FROM priced
)"""

SOURCES = f"""
src_customer AS (
  SELECT c_custkey AS CustomerID,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS PersonID,
         c_name AS AccountNumber, CAST(NULL AS BIGINT) AS StoreID,
         CAST(c_nationkey AS BIGINT) AS TerritoryID,
         TIMESTAMP '2001-08-01 00:00:00' AS ModifiedDate,
         md5('c' || CAST(c_custkey AS VARCHAR)) AS rowguid
  FROM customer
),
src_person AS (
  SELECT c_custkey AS BusinessEntityID, 'Customer' AS FirstName,
         split_part(c_name, '#', 2) AS LastName,
         CASE WHEN c_custkey % 3 = 1 THEN ' M ' WHEN c_custkey % 3 = 2 THEN '' END AS MiddleName,
         CAST(c_custkey % 3 AS INTEGER) AS EmailPromotion,
         'customer' || CAST(c_custkey AS VARCHAR) ||
           CASE WHEN c_custkey % 7 = 0 THEN '-at-example.com' ELSE '@example.com' END AS EmailAddress,
         TIMESTAMP '2001-08-01 00:00:00' AS ModifiedDate
  FROM customer
),{_LINES},
src_detail AS (
  SELECT l_orderkey AS SalesOrderID,
         l_orderkey * 16777216 + row_number() OVER (PARTITION BY l_orderkey ORDER BY
            l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
            l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
            l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS SalesOrderDetailID,
         l_partkey AS ProductID, OrderQty, UnitPrice, UnitPriceDiscount, LineTotal,
         l_shipdate AS ModifiedDate
  FROM priced_lines
),
order_totals AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship, sum(LineTotal) AS sub_total,
         sum(floor(LineTotal * tax_pct)) AS tax_cents
  FROM priced_lines GROUP BY l_orderkey
),
hdr AS (
  SELECT o.*, t.last_ship,
         CAST(COALESCE(t.sub_total, 0) AS DECIMAL(19,4)) AS sub,
         {money("COALESCE(t.tax_cents, 0)")} AS tax,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS online,
         CASE WHEN t.last_ship >= o.o_orderdate THEN t.last_ship END AS ship
  FROM orders o LEFT JOIN order_totals t ON o.o_orderkey = t.l_orderkey
),
hdr2 AS (SELECT *, {money("floor(sub * CAST(2.5 AS DECIMAL(2,1)))")} AS freight FROM hdr),
src_header AS (
  SELECT o_orderkey AS SalesOrderID, o_orderdate AS OrderDate,
         o_orderdate + INTERVAL 730 DAY AS DueDate, ship AS ShipDate,
         CAST(CASE WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'F' THEN 5
                   WHEN o_orderstatus = 'P' THEN (CASE WHEN o_orderpriority = '5-LOW' THEN 6 ELSE 2 END) END
              AS SMALLINT) AS Status,
         online AS OnlineOrderFlag,
         'so' || CAST(o_orderkey AS VARCHAR) AS SalesOrderNumber,
         CASE WHEN NOT online THEN 'PO' || CAST(o_orderkey AS VARCHAR) END AS PurchaseOrderNumber,
         'AW' || CAST(o_custkey AS VARCHAR) AS AccountNumber,
         o_custkey AS CustomerID,
         CASE WHEN NOT online THEN 270 + o_orderkey % 20 END AS SalesPersonID,
         1 + o_custkey % 10 AS TerritoryID, o_custkey AS ShipToAddressID, o_custkey AS BillToAddressID,
         CAST(CASE WHEN online THEN 1 ELSE 5 END AS BIGINT) AS ShipMethodID,
         sub AS SubTotal, tax AS TaxAmt, freight AS Freight,
         CAST(sub + tax + freight AS DECIMAL(19,4)) AS TotalDue,
         COALESCE(ship, o_orderdate) AS ModifiedDate,
         md5('h' || CAST(o_orderkey AS VARCHAR)) AS rowguid
  FROM hdr2
),
src_product AS (
  SELECT p_partkey AS ProductID,
         CASE WHEN p_size <= 48 THEN CAST(split_part(p_brand, '#', 2) AS BIGINT) END AS ProductSubcategoryID,
         p_partkey % 50 AS ProductModelID,
         'pn-' || CAST(p_partkey AS VARCHAR) AS ProductNumber,
         p_name AS Name,
         p_size % 2 = 0 AS MakeFlag,
         CASE WHEN p_size % 7 <> 0 THEN p_size > 10 END AS FinishedGoodsFlag,
         CASE WHEN p_partkey % 6 <> 0 THEN lower(p_type) END AS Color,
         CAST(p_size AS VARCHAR) AS Size,
         CASE WHEN p_size > 25 THEN 'CM ' END AS SizeUnitMeasureCode,
         CASE WHEN p_size % 2 = 1 THEN 'LB ' END AS WeightUnitMeasureCode,
         CASE WHEN p_size % 3 <> 0 THEN CAST(CAST(p_size AS DECIMAL(8,2)) * CAST(1.5 AS DECIMAL(2,1)) AS DECIMAL(8,2)) END AS Weight,
         CASE p_partkey % 5 WHEN 0 THEN 'R ' WHEN 1 THEN 'M ' WHEN 2 THEN 'T ' WHEN 3 THEN 'S ' END AS ProductLine,
         CASE p_size % 4 WHEN 0 THEN 'H ' WHEN 1 THEN 'M ' WHEN 2 THEN 'L ' END AS Class,
         CASE p_partkey % 4 WHEN 0 THEN 'U ' WHEN 1 THEN 'M ' WHEN 2 THEN 'W ' END AS Style,
         p_size * 10 AS SafetyStockLevel, p_size * 7 AS ReorderPoint, p_size % 5 AS DaysToManufacture,
         {money("(CAST(round(p_retailprice * 100) AS BIGINT) * 6) // 10", "0.0001")} AS StandardCost,
         {money("CAST(round(p_retailprice * 100) AS BIGINT)", "0.0001")} AS ListPrice,
         CASE WHEN p_size = 1 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE TIMESTAMP '1994-01-01 00:00:00' END AS SellStartDate,
         CASE WHEN p_size > 45 THEN TIMESTAMP '2000-12-31 00:00:00' END AS SellEndDate,
         CASE WHEN p_size = 50 THEN TIMESTAMP '2001-01-01 00:00:00' END AS DiscontinuedDate,
         TIMESTAMP '2001-08-01 00:00:00' AS ModifiedDate,
         md5('p' || CAST(p_partkey AS VARCHAR)) AS rowguid
  FROM part
),
src_subcategory AS (
  SELECT ProductSubcategoryID, 'Subcategory ' || CAST(ProductSubcategoryID AS VARCHAR) AS Name,
         1 + ProductSubcategoryID % 4 AS ProductCategoryID,
         TIMESTAMP '2001-08-01 00:00:00' AS ModifiedDate
  FROM (SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS ProductSubcategoryID FROM part)
),
src_category AS (
  SELECT DISTINCT ProductCategoryID, TIMESTAMP '2001-08-01 00:00:00' AS ModifiedDate FROM src_subcategory
)"""

# ---------------------------------------------------------------- staging CTEs
STAGING = """
stg_customers AS (
  SELECT CAST(c.CustomerID AS BIGINT) AS customer_id, CAST(c.PersonID AS BIGINT) AS person_id,
         trim(upper(c.AccountNumber)) AS account_number,
         CAST(c.StoreID AS BIGINT) AS store_id, CAST(c.TerritoryID AS BIGINT) AS territory_id,
         trim(COALESCE(p.FirstName, '')) AS first_name, trim(COALESCE(p.LastName, '')) AS last_name,
         trim(COALESCE(p.MiddleName, '')) AS middle_name,
         CAST(COALESCE(p.EmailPromotion, 0) AS INTEGER) AS email_promotion,
         c.ModifiedDate AS modified_date, substr(CAST(c.rowguid AS VARCHAR), 1, 36) AS row_guid
  FROM src_customer c LEFT JOIN src_person p ON c.PersonID = p.BusinessEntityID
  WHERE c.CustomerID IS NOT NULL AND c.PersonID IS NOT NULL
),
stg_products AS (
  SELECT CAST(p.ProductID AS BIGINT) AS product_id,
         CAST(p.ProductSubcategoryID AS BIGINT) AS product_subcategory_id,
         CAST(p.ProductModelID AS BIGINT) AS product_model_id,
         trim(upper(p.ProductNumber)) AS product_number, trim(p.Name) AS product_name,
         COALESCE(CAST(p.MakeFlag AS BOOLEAN), FALSE) AS make_flag,
         COALESCE(CAST(p.FinishedGoodsFlag AS BOOLEAN), FALSE) AS finished_goods_flag,
         trim(COALESCE(p.Color, 'Unknown')) AS color, trim(COALESCE(p.Size, '')) AS size,
         trim(COALESCE(p.SizeUnitMeasureCode, '')) AS size_unit_measure_code,
         trim(COALESCE(p.WeightUnitMeasureCode, '')) AS weight_unit_measure_code,
         CAST(COALESCE(p.Weight, 0) AS DECIMAL(8,2)) AS weight,
         trim(COALESCE(p.ProductLine, '')) AS product_line, trim(COALESCE(p.Class, '')) AS product_class,
         trim(COALESCE(p.Style, '')) AS product_style,
         CAST(p.SafetyStockLevel AS INTEGER) AS safety_stock_level,
         CAST(p.ReorderPoint AS INTEGER) AS reorder_point,
         CAST(p.DaysToManufacture AS INTEGER) AS days_to_manufacture,
         CAST(p.StandardCost AS DECIMAL(19,4)) AS standard_cost,
         CAST(p.ListPrice AS DECIMAL(19,4)) AS list_price,
         CAST(p.SellStartDate AS DATE) AS sell_start_date, CAST(p.SellEndDate AS DATE) AS sell_end_date,
         CAST(p.DiscontinuedDate AS DATE) AS discontinued_date,
         trim(COALESCE(ps.Name, '')) AS subcategory_name,
         CAST(COALESCE(ps.ProductCategoryID, 0) AS INTEGER) AS product_category_id,
         p.ModifiedDate AS modified_date, substr(CAST(p.rowguid AS VARCHAR), 1, 36) AS row_guid
  FROM src_product p LEFT JOIN src_subcategory ps ON p.ProductSubcategoryID = ps.ProductSubcategoryID
  WHERE p.ProductID IS NOT NULL
),
stg_sales_orders AS (
  SELECT CAST(h.SalesOrderID AS BIGINT) AS sales_order_id,
         CAST(d.SalesOrderDetailID AS BIGINT) AS sales_order_detail_id,
         CAST(h.OrderDate AS DATE) AS order_date, CAST(h.DueDate AS DATE) AS due_date,
         CAST(h.ShipDate AS DATE) AS ship_date, CAST(h.Status AS SMALLINT) AS order_status,
         COALESCE(CAST(h.OnlineOrderFlag AS BOOLEAN), FALSE) AS is_online_order,
         trim(upper(h.SalesOrderNumber)) AS sales_order_number,
         trim(COALESCE(h.PurchaseOrderNumber, '')) AS purchase_order_number,
         trim(COALESCE(h.AccountNumber, '')) AS account_number,
         CAST(h.CustomerID AS BIGINT) AS customer_id,
         CAST(COALESCE(h.SalesPersonID, 0) AS BIGINT) AS sales_person_id,
         CAST(h.TerritoryID AS BIGINT) AS territory_id,
         CAST(h.ShipToAddressID AS BIGINT) AS ship_to_address_id,
         CAST(h.BillToAddressID AS BIGINT) AS bill_to_address_id,
         CAST(h.ShipMethodID AS BIGINT) AS ship_method_id,
         CAST(d.ProductID AS BIGINT) AS product_id, CAST(d.OrderQty AS SMALLINT) AS order_quantity,
         CAST(d.UnitPrice AS DECIMAL(19,4)) AS unit_price,
         CAST(d.UnitPriceDiscount AS DECIMAL(19,4)) AS unit_price_discount,
         CAST(d.LineTotal AS DECIMAL(38,6)) AS line_total,
         CAST(d.OrderQty * d.UnitPrice * (1 - d.UnitPriceDiscount) AS DECIMAL(38,6)) AS calculated_line_total,
         CAST(h.SubTotal AS DECIMAL(19,4)) AS order_subtotal, CAST(h.TaxAmt AS DECIMAL(19,4)) AS order_tax_amount,
         CAST(h.Freight AS DECIMAL(19,4)) AS order_freight, CAST(h.TotalDue AS DECIMAL(19,4)) AS order_total_due,
         h.ModifiedDate AS header_modified_date, d.ModifiedDate AS detail_modified_date,
         substr(CAST(h.rowguid AS VARCHAR), 1, 36) AS header_row_guid
  FROM src_header h INNER JOIN src_detail d ON h.SalesOrderID = d.SalesOrderID
  WHERE h.SalesOrderID IS NOT NULL AND d.SalesOrderDetailID IS NOT NULL
    AND h.CustomerID IS NOT NULL AND d.ProductID IS NOT NULL
)"""

STATUS_CASE = """CASE WHEN {s} = 1 THEN 'In Process' WHEN {s} = 2 THEN 'Approved' WHEN {s} = 3 THEN 'Backordered'
            WHEN {s} = 4 THEN 'Rejected' WHEN {s} = 5 THEN 'Shipped' WHEN {s} = 6 THEN 'Cancelled'
            ELSE 'Unknown' END"""

INTERMEDIATE = f"""
line AS (
  SELECT *, order_quantity * unit_price AS gross_line_total,
         order_quantity * unit_price * unit_price_discount AS discount_amount,
         {STATUS_CASE.format(s="order_status")} AS order_status_name,
         CASE WHEN is_online_order THEN 'Online' ELSE 'Offline' END AS order_channel
  FROM stg_sales_orders
),
whole_order AS (
  SELECT sales_order_id, max(customer_id) AS customer_id, max(order_date) AS order_date, max(due_date) AS due_date,
         max(ship_date) AS ship_date, max(order_status_name) AS order_status_name, max(order_status) AS order_status_code,
         max(order_channel) AS order_channel, any_value(is_online_order) AS is_online_order,
         sum(order_quantity) AS total_order_quantity, sum(line_total) AS total_line_total,
         sum(calculated_line_total) AS total_calculated_line_total, sum(gross_line_total) AS total_gross_line_total,
         sum(discount_amount) AS total_discount_amount,
         CASE WHEN count(*) FILTER (WHERE unit_price_discount > 0) > 0 THEN 1 ELSE 0 END AS has_discount_flag,
         max(order_subtotal) AS order_subtotal, max(order_tax_amount) AS order_tax_amount, max(order_freight) AS order_freight,
         max(order_total_due) AS order_total_due, max(sales_person_id) AS sales_person_id,
         max(territory_id) AS order_territory_id, max(header_modified_date) AS header_modified_date
  FROM line GROUP BY sales_order_id
),
int_customer_orders AS (
  SELECT o.*, c.* EXCLUDE (customer_id, modified_date), c.modified_date AS customer_modified_date,
         {sk("o.customer_id", "o.sales_order_id", "o.order_date")} AS customer_order_surrogate_key,
         trim(COALESCE(c.first_name, '')) || COALESCE(' ' || nullif(trim(c.middle_name), ''), '') || ' '
           || trim(COALESCE(c.last_name, '')) AS full_name,
         date_diff('day', o.order_date, o.due_date) AS days_until_due, date_diff('day', o.order_date, o.ship_date) AS days_to_ship,
         COALESCE(CASE o.ship_date <= o.due_date WHEN TRUE THEN 'On Time' WHEN FALSE THEN 'Late' END, 'Not Shipped')
           AS shipping_performance
  FROM whole_order o JOIN stg_customers c USING (customer_id)
),
int_product_sales AS (
  SELECT l.* EXCLUDE (order_status), l.order_status AS order_status_code, l.unit_price AS sale_unit_price,
         p.* EXCLUDE (product_id, modified_date), p.modified_date AS product_modified_date,
         {sk("l.product_id", "l.order_date", "l.sales_order_id")} AS product_sale_surrogate_key,
         l.unit_price - p.standard_cost AS unit_profit,
         {ratio("l.unit_price - p.standard_cost", "p.standard_cost")} AS profit_margin_pct,
         {ratio("l.unit_price", "p.list_price")} AS discount_from_list_pct,
         l.order_quantity * (l.unit_price - p.standard_cost) AS line_profit,
         l.order_quantity * (l.unit_price - p.standard_cost) * (1 - l.unit_price_discount) AS net_line_profit,
         CASE WHEN p.discontinued_date IS NOT NULL THEN 'Discontinued'
              WHEN CAST(p.sell_end_date AS TIMESTAMP) < TIMESTAMP '{AS_OF} 00:00:00' THEN 'Ended'
              WHEN CAST(p.sell_start_date AS TIMESTAMP) > TIMESTAMP '{AS_OF} 00:00:00' THEN 'Not Started'
              ELSE 'Active' END AS product_lifecycle_status
  FROM line l JOIN stg_products p USING (product_id)
)"""


def with_models(*extra: str) -> str:
    """``WITH`` clause holding the adapter, staging, intermediate CTEs and ``extra``."""
    parts = [SOURCES, STAGING, INTERMEDIATE] + [e for e in extra if e]
    return "WITH " + ",".join(parts)
