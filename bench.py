"""Bench: headline models at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each timed item: one warm-up, then three runs, median.  A query is forced with
the ``noop`` sink (full computation, nothing collected to the driver).
Marts and checks are timed over materialised intermediate tables, as they run
inside a build; ``build`` is the end-to-end run from the raw test tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.session import get_session  # noqa: E402
from salesmart.plans import intermediate, marts, models  # noqa: E402
from salesmart.plans.build import build  # noqa: E402
from salesmart.operators.quality import run_checks  # noqa: E402
from salesmart.operators.rules import declared_checks  # noqa: E402
from salesmart.sources import conform  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn) -> float:
    fn()  # warm-up
    runs = []
    for _ in range(RUNS):
        t = time.time()
        fn()
        runs.append(time.time() - t)
    return round(statistics.median(runs), 3)


def main() -> None:
    spark = get_session(f"local[{CPUS}]", CPUS, app="salesmart-bench",
                        extra={"spark.driver.memory": "16g"})
    scratch = tempfile.mkdtemp(prefix="salesmart-bench-")
    src = conform.sources(spark, SF_DIR)
    stg = models.stage(src)
    stg["stg_sales_orders"].write.mode("overwrite").parquet(f"{scratch}/stg_sales_orders")
    so = spark.read.parquet(f"{scratch}/stg_sales_orders")
    stg_c, stg_p = stg["stg_customers"], stg["stg_products"]
    intermediate.int_customer_orders(so, stg_c).write.mode("overwrite").parquet(f"{scratch}/ico")
    intermediate.int_product_sales(so, stg_p, models.TEST_AS_OF).write.mode("overwrite").parquet(f"{scratch}/ips")
    ico, ips = spark.read.parquet(f"{scratch}/ico"), spark.read.parquet(f"{scratch}/ips")
    tables = dict(stg_customers=stg_c, stg_products=stg_p, stg_sales_orders=so,
                  int_customer_orders=ico, int_product_sales=ips)
    for name, df in models.mart_models(dict(tables), models.TEST_AS_OF).items():
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        tables[name] = spark.read.parquet(f"{scratch}/{name}")

    q = {}
    q["stg_sales_orders"] = _time(lambda: _force(stg["stg_sales_orders"]))
    q["int_customer_orders"] = _time(lambda: _force(intermediate.int_customer_orders(so, stg_c)))
    q["int_product_sales"] = _time(lambda: _force(intermediate.int_product_sales(so, stg_p, models.TEST_AS_OF)))
    q["fct_sales_summary"] = _time(lambda: _force(marts.fct_sales_summary(ips)))
    q["dim_customer_metrics"] = _time(lambda: _force(marts.dim_customer_metrics(ico, ips, models.TEST_AS_OF)))
    q["fct_product_performance"] = _time(
        lambda: _force(marts.fct_product_performance(ips, stg_p, models.TEST_AS_OF)))
    q["dq_declared_218"] = _time(lambda: run_checks(tables, declared_checks(), models.TEST_AS_OF).collect())
    counter = iter(range(100))
    q["build"] = _time(lambda: build(spark, conform.sources(spark, SF_DIR), f"{scratch}/published",
                                     models.TEST_AS_OF, version=f"b{next(counter)}").collect())
    total = round(sum(v for k, v in q.items() if k != "build" and not k.startswith("whole_")), 3)
    for name in ("fct_sales_summary", "fct_product_performance"):  # as registered: the chain from the raw tables
        q[f"whole_{name}"] = _time(lambda: _force(models.models_on_testdata(spark, SF_DIR, models.TEST_AS_OF)[name]))
    print(json.dumps({"metric": "salesmart_models_total", "value": total, "unit": "sec",
                      "queries": q, "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                      "cpus": CPUS, "runs": RUNS, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
