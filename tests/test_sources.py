"""Production path: sources stored as tables are read through SourceSpecs and built."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from salesmart.operators import publish
from salesmart.plans.build import build
from salesmart.plans.models import TEST_AS_OF
from salesmart.sources import conform
from salesmart.sources.freshness import declared_freshness, freshness, spec_freshness
from salesmart.sources.specs import SOURCE_TABLES, SourceSpec, default_specs, load_sources


def test_specs_read_stored_sources_and_build(spark, tmp_path):
    root = str(tmp_path / "sources")
    for name, df in conform.sources(spark, SF_SMALL).items():
        df.write.parquet(f"{root}/{name}.parquet")
    specs = default_specs(root)
    assert sorted(specs) == sorted(name for _, name in SOURCE_TABLES)
    src = load_sources(spark, specs)
    out = build(spark, src, str(tmp_path / "marts"), TEST_AS_OF, checks=[], version="v1")
    assert out.filter(F.col("kind") == "run").first()["status"] == "published"
    assert freshness(declared_freshness(src), TEST_AS_OF).count() == 7


def test_freshness_follows_the_specs(spark):
    src = conform.sources(spark, SF_SMALL)
    specs = {n: s.with_override(warn_hours=None, error_hours=None) for n, s in default_specs("/x").items()}
    specs["customer"] = specs["customer"].with_override(warn_hours=1, error_hours=24 * 3650)
    specs["product"] = specs["product"].with_override(warn_hours=1, error_hours=2)
    got = {r.table_name: r.status for r in freshness(spec_freshness(specs, src), TEST_AS_OF).collect()}
    assert got == {n: {"customer": "warn", "product": "error"}.get(n, "pass") for n in specs}


def test_stale_sources_and_repeated_versions_stop_a_build(spark, tmp_path):
    src, root = conform.sources(spark, SF_SMALL), str(tmp_path / "marts")
    out = build(spark, src, root, TEST_AS_OF, checks=[], version="v1", freshness_rules=declared_freshness(src))
    assert out.filter("kind = 'run'").first()["status"] == "kept_previous"
    assert out.filter("kind = 'freshness'").count() == 7 and publish.current_version(spark, root) is None
    build(spark, src, root, TEST_AS_OF, checks=[], version="v2")
    with pytest.raises(ValueError):
        build(spark, src, root, TEST_AS_OF, checks=[], version="v2")


def test_scratch_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    from salesmart import session
    assert session.checkpoint_dir(spark)

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
    active = session.get_session(app="again", extra={"spark.sql.shuffle.partitions": "8"})
    assert active.conf.get("spark.sql.shuffle.partitions") == "8"
