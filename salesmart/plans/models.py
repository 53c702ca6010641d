"""Model graph: sources → staging → intermediate → marts, as lazy DataFrames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesmart.functions.text import collated
from salesmart.operators import publish
from salesmart.plans import intermediate, marts, staging
from salesmart.session import dropping_shuffles, scratch_path, small_tasks
from salesmart.sources import conform

# Fixed value: the as-of date used with the driver's test data (its orders end
# on 2001-08-01), standing in for ``getdate()`` so results are reproducible.
TEST_AS_OF = "2001-08-15"

STAGING = ("stg_customers", "stg_products", "stg_sales_orders")
INTERMEDIATE = ("int_customer_orders", "int_product_sales")
MARTS = ("dim_customer_metrics", "fct_sales_summary", "fct_product_performance")


def stage(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_customers": staging.stg_customers(src["customer"], src["person"]),
        "stg_products": staging.stg_products(src["product"], src["product_subcategory"]),
        "stg_sales_orders": staging.stg_sales_orders(src["sales_order_header"], src["sales_order_detail"]),
    }


def intermediates(stg: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    return {
        "int_customer_orders": intermediate.int_customer_orders(stg["stg_sales_orders"], stg["stg_customers"]),
        "int_product_sales": intermediate.int_product_sales(stg["stg_sales_orders"], stg["stg_products"], as_of),
    }


def mart_models(m: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    return {
        "dim_customer_metrics": marts.dim_customer_metrics(m["int_customer_orders"], m["int_product_sales"], as_of),
        "fct_sales_summary": marts.fct_sales_summary(m["int_product_sales"]),
        "fct_product_performance": marts.fct_product_performance(m["int_product_sales"], m["stg_products"], as_of),
    }


#: Codes and names that are keys, groups or sets of values.  Text that is only concatenated stays binary.
COLLATED = {"stg_customers": ("account_number",),
            "stg_products": ("product_number", "product_name", "color", "size", "product_line", "product_class", "product_style",
                             "subcategory_name"),
            "stg_sales_orders": ("account_number", "sales_order_number", "purchase_order_number")}


def all_models(src: dict[str, DataFrame], as_of=None, collate: bool = False) -> dict[str, DataFrame]:
    """Every model as a lazy DataFrame (nothing is materialised here).

    With ``collate`` the codes and names of the staging models compare without
    regard to case and trailing blanks, in all that is built or checked on them.
    """
    m = stage(src)
    if collate:
        m = {name: collated(df, *COLLATED[name]) for name, df in m.items()}
    m.update(intermediates(m, as_of))
    m.update(mart_models(m, as_of))
    return m


# Names under which the seven sources appear next to the models (checks may target them).
SOURCE_ALIASES = {"customer": "src_customer", "person": "src_person", "sales_order_header": "src_header",
                  "sales_order_detail": "src_detail", "product": "src_product",
                  "product_subcategory": "src_subcategory", "product_category": "src_category"}


def models_on_testdata(spark: SparkSession, sf_dir: str, as_of: str = TEST_AS_OF) -> dict[str, DataFrame]:
    """All models over the driver's test tables (via the conform adapter), plus the sources."""
    src = conform.sources(spark, sf_dir)
    out = all_models(src, as_of)
    out.update({SOURCE_ALIASES[k]: v for k, v in src.items()})
    return out


def models_on_stored_lines(spark: SparkSession, sf_dir: str, as_of: str = TEST_AS_OF, checks=()) -> dict[str, DataFrame]:
    """The same models for a query with many jobs over them: the order lines are joined and written once by order, and
    once by product with its attributes.

    Only columns that MOD-4 and MOD-5 or the ``checks`` read are written (and are in ``stg_sales_orders``); the
    other models are lazy DataFrames over these lines.  Both tables are clustered, so that what groups the lines by
    order or product exchanges none of them; each job's shuffle files go when it ends.
    """
    src = conform.sources(spark, sf_dir)
    m = stage(src)
    used = set(intermediate.LINE_COLUMNS)
    for c in checks:
        if c.model == "stg_sales_orders":
            used |= {c.column, *c.params.get("columns", ()), c.params.get("start"), c.params.get("end")}
    buckets = publish.bucket_count(spark, m["stg_sales_orders"])

    def stored(df: DataFrame, label: str, key: str) -> DataFrame:
        df, name = publish.write_clustered(df, scratch_path(spark, f"{label}-{uuid.uuid4().hex}"), key, buckets)
        publish.forget(spark, [name])
        return df
    lines = m["stg_sales_orders"]
    with dropping_shuffles(spark), small_tasks(spark):
        m["stg_sales_orders"] = stored(lines.select(*[c for c in lines.columns if c in used]), "order-lines", "sales_order_id")
        sold = intermediate.with_products(m["stg_sales_orders"].select(*intermediate.SOLD_COLUMNS), m["stg_products"])
        sold = stored(sold, "sold-lines", "product_id")
    m["int_customer_orders"] = intermediate.int_customer_orders(m["stg_sales_orders"], m["stg_customers"])
    m["int_product_sales"] = intermediate.int_product_sales_joined(sold, as_of)
    m.update(mart_models(m, as_of))
    m.update({SOURCE_ALIASES[k]: v for k, v in src.items()})
    return m
