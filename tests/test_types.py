"""Every model and adapted source matches its declared schema."""

from conftest import SF_SMALL

from salesmart.plans.models import TEST_AS_OF, models_on_testdata
from salesmart.types import SCHEMAS, check_schema


def test_models_match_declared_schemas(spark):
    m = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)
    for name in SCHEMAS:
        assert check_schema(m[name], name) == [], name


def test_drift_is_reported(spark):
    m = models_on_testdata(spark, SF_SMALL, TEST_AS_OF)
    df = m["fct_sales_summary"].drop("total_orders").withColumn("order_year", m["fct_sales_summary"]["order_year"].cast("string"))
    problems = check_schema(df, "fct_sales_summary")
    assert "missing total_orders" in problems and any(p.startswith("order_year") for p in problems)
