"""Build run: staged version, checks before the swap, rollback."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from salesmart.operators import publish
from salesmart.operators.quality import Check
from salesmart.plans.build import build
from salesmart.plans.models import TEST_AS_OF
from salesmart.sources import conform


def test_build_publishes_only_when_checks_pass_and_rolls_back(spark, tmp_path):
    root = str(tmp_path / "marts")
    src = conform.sources(spark, SF_SMALL)
    passing = [Check("fct_sales_summary", "not_null", "order_date"),
               Check("dim_customer_metrics", "unique", "customer_id")]
    r1 = build(spark, src, root, TEST_AS_OF, checks=passing, version="v1")
    assert r1.filter(F.col("kind") == "run").first()["status"] == "published"
    assert publish.current_version(spark, root) == "v1"
    r2 = build(spark, src, root, TEST_AS_OF, checks=passing, version="v2")
    assert r2.filter(F.col("kind") == "run").first()["status"] == "published"
    assert publish.current_version(spark, root) == "v2"
    # the declared checks fail on the test data (e.g. repeated product-sale keys): v3 stays staged
    r3 = build(spark, src, root, TEST_AS_OF, version="v3")
    run = r3.filter(F.col("kind") == "run").first()
    assert run["status"] == "kept_previous" and run["failures"] > 0
    assert publish.current_version(spark, root) == "v2"
    assert r3.filter(F.col("status") == "fail").count() == run["failures"]
    # rollback returns to v1; readers resolve the pointer
    assert publish.rollback(spark, root) == "v1"
    assert publish.read_current(spark, root, "fct_sales_summary").count() > 0


def test_a_build_keeps_no_shuffle_files_and_writes_zstd(spark, tmp_path):
    import re

    import pyarrow.parquet as pq

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files))

    before, setting = shuffles(), spark.conf.get(key, None)
    out = build(spark, conform.sources(spark, SF_SMALL), str(tmp_path), TEST_AS_OF, version="v1", checks=[])
    assert not shuffles() - before and spark.conf.get(key, None) == setting
    assert {r["kind"] for r in out.collect()} == {"schema", "run"}
    for table in ("stg_sales_orders", "int_product_sales", "dim_customer_metrics"):
        for path in (tmp_path / table / "release=v1").rglob("*.parquet"):
            group = pq.ParquetFile(path).metadata.row_group(0)
            assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}


def test_stored_order_lines_are_zstd(spark):
    import pyarrow.parquet as pq
    from salesmart.plans.models import models_on_stored_lines
    files = models_on_stored_lines(spark, SF_SMALL, TEST_AS_OF)["stg_sales_orders"].inputFiles()
    assert files
    for path in files:
        group = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0)
        assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}


def test_a_build_writes_its_marts_one_after_another_and_leaves_no_names(spark, tmp_path, monkeypatch):
    import threading

    from salesmart.plans import build as module
    running, most, before = [], [], publish.write_table

    def counted(df, path, partition_by=None):
        running.append(threading.get_ident())
        most.append(len(running))
        try:
            before(df, path, partition_by)
        finally:
            running.pop()
    monkeypatch.setattr(publish, "write_table", counted)
    layers, plain = [], module._layer
    monkeypatch.setattr(module, "_layer", lambda *args: (most.clear(), plain(*args), layers.append(max(most, default=0)))[1])
    build(spark, conform.sources(spark, SF_SMALL), str(tmp_path), TEST_AS_OF, version="v1", checks=[])
    assert len(layers) == 3 and layers[2] == 1
    assert not spark.sql("SHOW TABLES IN salesmart_clustered").where("NOT isTemporary").count()
    clustered = {n: list((tmp_path / n / "release=v1").rglob("*_0000[0-9].c000.zstd.parquet")) for n in module.CLUSTERED}
    assert all(clustered.values())
