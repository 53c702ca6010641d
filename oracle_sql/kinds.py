"""Output projection specs of the eight models (name:kind, see base.project)."""

STG_CUSTOMERS = "customer_id:i person_id:i account_number:s store_id:i territory_id:i first_name:s last_name:s middle_name:s email_promotion:i modified_date:ts row_guid:s"
STG_PRODUCTS = "product_id:i product_subcategory_id:i product_model_id:i product_number:s product_name:s make_flag:b finished_goods_flag:b color:s size:s size_unit_measure_code:s weight_unit_measure_code:s weight:d product_line:s product_class:s product_style:s safety_stock_level:i reorder_point:i days_to_manufacture:i standard_cost:d list_price:d sell_start_date:dt sell_end_date:dt discontinued_date:dt subcategory_name:s product_category_id:i modified_date:ts row_guid:s"
STG_SALES_ORDERS = "sales_order_id:i sales_order_detail_id:i order_date:dt due_date:dt ship_date:dt order_status:i is_online_order:b sales_order_number:s purchase_order_number:s account_number:s customer_id:i sales_person_id:i territory_id:i ship_to_address_id:i bill_to_address_id:i ship_method_id:i product_id:i order_quantity:i unit_price:d unit_price_discount:d line_total:d calculated_line_total:d order_subtotal:d order_tax_amount:d order_freight:d order_total_due:d header_modified_date:ts detail_modified_date:ts header_row_guid:s"
INT_CUSTOMER_ORDERS = "customer_order_surrogate_key:s customer_id:i person_id:i account_number:s first_name:s last_name:s middle_name:s full_name:s email_promotion:i territory_id:i store_id:i sales_order_id:i order_date:dt due_date:dt ship_date:dt order_status_name:s order_status_code:i order_channel:s is_online_order:b days_until_due:i days_to_ship:i shipping_performance:s total_order_quantity:i total_line_total:d total_calculated_line_total:d total_gross_line_total:d total_discount_amount:d has_discount_flag:i order_subtotal:d order_tax_amount:d order_freight:d order_total_due:d sales_person_id:i order_territory_id:i header_modified_date:ts customer_modified_date:ts"
INT_PRODUCT_SALES = "product_sale_surrogate_key:s product_id:i product_number:s product_name:s product_subcategory_id:i subcategory_name:s product_category_id:i product_model_id:i color:s size:s product_line:s product_class:s product_style:s make_flag:b finished_goods_flag:b standard_cost:d list_price:d sale_unit_price:d unit_profit:d profit_margin_pct:r discount_from_list_pct:r sales_order_id:i sales_order_detail_id:i order_date:dt due_date:dt ship_date:dt customer_id:i order_status_name:s order_status_code:i order_channel:s order_quantity:i unit_price:d unit_price_discount:d line_total:d calculated_line_total:d gross_line_total:d discount_amount:d line_profit:d net_line_profit:d sell_start_date:dt sell_end_date:dt discontinued_date:dt product_lifecycle_status:s safety_stock_level:i reorder_point:i days_to_manufacture:i territory_id:i sales_person_id:i detail_modified_date:ts product_modified_date:ts"
DIM_CUSTOMER_METRICS = "customer_id:i person_id:i account_number:s full_name:s first_name:s last_name:s email_promotion:i territory_id:i store_id:i total_orders:i unique_order_dates:i first_order_date:dt last_order_date:dt customer_lifetime_days:i orders_per_month:d days_since_last_order:i total_lifetime_revenue:d total_gross_revenue:d total_discounts_received:d avg_order_value:d max_order_value:d min_order_value:d total_items_purchased:i avg_items_per_order:i unique_products_purchased:i total_products_quantity:i total_profit_generated:d total_net_profit_generated:d avg_profit_margin_pct:r online_orders:i offline_orders:i online_revenue:d offline_revenue:d channel_preference:s online_order_pct:d shipped_orders:i cancelled_orders:i on_time_orders:i late_orders:i on_time_shipment_pct:d orders_with_discount:i total_discounts_used:d discount_usage_pct:d recency_score:i frequency_score:i monetary_score:i rfm_score:i customer_segment:s"
FCT_SALES_SUMMARY = "order_date:dt order_year:i order_month:i order_day:i order_month_name:s order_day_name:s total_orders:i unique_customers:i unique_products_sold:i total_quantity_sold:i total_revenue:d total_gross_revenue:d total_discount_amount:d total_profit:d total_net_profit:d avg_profit_margin_pct:r avg_order_value:d online_orders:i offline_orders:i online_revenue:d offline_revenue:d online_order_pct:d shipped_orders:i cancelled_orders:i shipment_rate_pct:d orders_with_discount:i total_discounts_applied:d avg_discount_pct:r discount_order_pct:d monthly_total_orders:i monthly_total_revenue:d monthly_avg_order_value:d daily_revenue_pct_of_month:d"
FCT_PRODUCT_PERFORMANCE = "product_id:i product_number:s product_name:s product_subcategory_id:i subcategory_name:s product_category_id:i product_model_id:i color:s size:s product_line:s product_class:s product_style:s make_flag:b finished_goods_flag:b product_lifecycle_status:s standard_cost:d list_price:d avg_sale_price:d min_sale_price:d max_sale_price:d avg_price_vs_list_pct:d avg_discount_from_list_pct:r total_orders:i unique_customers:i days_sold:i first_sale_date:dt last_sale_date:dt sales_period_days:i total_quantity_sold:i avg_quantity_per_order:i max_quantity_per_order:i units_sold_per_day:d total_revenue:d total_gross_revenue:d total_discount_amount:d avg_line_total:d max_line_total:d min_line_total:d revenue_per_day:d total_profit:d total_net_profit:d avg_unit_profit:d avg_profit_margin_pct:r overall_profit_margin_pct:d profit_margin_pct:d markup_pct:d online_orders:i offline_orders:i online_revenue:d offline_revenue:d online_order_pct:d online_revenue_pct:d shipped_orders:i cancelled_orders:i shipment_rate_pct:d customers_per_order:d performance_category:s safety_stock_level:i reorder_point:i days_to_manufacture:i"
