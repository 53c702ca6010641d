"""One release for all tables: swaps, rollbacks, bounded appends, untouched partitions."""

import os
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from salesmart.operators import publish
from test_plans import plan

START = datetime(2001, 1, 1)


def _publish(spark, root, run, **values):
    tables = {}
    for name, value in values.items():
        df = spark.createDataFrame([(run, value)], "run string, value int")
        publish.write_table(df, publish.folder(root, name, run))
        tables[name] = df.schema
    publish.swap(spark, root, run, tables)


def _value(spark, root, name):
    return publish.read_current(spark, root, name).first()["run"]


def test_a_rollback_undoes_exactly_the_last_run(spark, tmp_path):
    root = str(tmp_path / "r")
    _publish(spark, root, "v1", x=1, y=1)
    _publish(spark, root, "v2", x=2)
    _publish(spark, root, "v3", y=3, z=3)
    assert publish.published_tables(spark, root) == ["x", "y", "z"]
    assert publish.rollback(spark, root) == "v2"
    assert (_value(spark, root, "x"), _value(spark, root, "y")) == ("v2", "v1")
    with pytest.raises(FileNotFoundError):
        publish.read_current(spark, root, "z")
    _publish(spark, root, "v4", y=4)  # a run after the rollback follows v2, not v3
    assert publish.runs(spark, root) == ["v4", "v2", "v1"]
    assert publish.rollback(spark, root) == "v2" and publish.rollback(spark, root) == "v1"
    assert (_value(spark, root, "x"), _value(spark, root, "y")) == ("v1", "v1")
    assert publish.rollback(spark, root) is None and publish.current_version(spark, root) == "v1"


def test_a_swap_is_one_catalog_change(spark, tmp_path):
    root, found, stop = str(tmp_path / "r"), [], threading.Event()
    _publish(spark, root, "r0", x=0, y=0)
    schema = publish.schema_of(root)

    def reader():
        while not stop.is_set():
            found.append(spark.sql(f"SELECT (SELECT max(value) FROM {schema}.x) AS x, (SELECT max(value) FROM {schema}.y) AS y").first())

    thread = threading.Thread(target=reader)
    thread.start()
    pinned = publish.snapshot(spark, root)
    for i in range(1, 6):
        _publish(spark, root, f"r{i}", x=i, y=i)
    stop.set()
    thread.join()
    assert len(found) > 2 and all(r.x == r.y for r in found)
    # frames of one run stay together after later swaps
    assert {n: df.first()["value"] for n, df in pinned.items()} == {"x": 0, "y": 0}


def test_only_live_folders_are_read(spark, tmp_path):
    root = str(tmp_path / "r")
    for i in range(3):
        _publish(spark, root, f"r{i}", x=i)
    rows = publish.read_current(spark, root, "x")
    p = plan(rows)
    assert "PartitionFilters" in p and "array_contains(" in p.split("PartitionFilters")[1], p
    rows.collect()
    scan = next(n for n in _nodes(rows._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet"))
    live = [f for f in os.listdir(publish.folder(root, "x", "r2")) if f.endswith(".parquet")]
    assert scan.metrics().apply("numFiles").value() == len(live)


def _nodes(node):
    while "AdaptiveSparkPlan" in node.nodeName() or "QueryStage" in node.nodeName():
        node = node.executedPlan() if "Adaptive" in node.nodeName() else node.plan()
    yield node
    for i in range(node.children().size()):
        yield from _nodes(node.children().apply(i))


def _append(spark, root, i, **more):
    rows = spark.createDataFrame([(i, START + timedelta(days=i))], "id int, at timestamp_ntz")
    return publish.incremental_load(spark, rows, root, "at", table="t", **more)


def test_many_appends_stay_bounded(spark, tmp_path):
    root, written, parts = str(tmp_path / "a"), 0, []
    for i in range(18):
        run = _append(spark, root, i, keep=3)
        parts.append(len(publish.state_of(spark, root)["t"]))
        written += spark.read.parquet(publish.folder(root, "t", run)).count()
    assert publish.read_current(spark, root, "t").agg(F.count("id"), F.sum("id")).first() == (18, sum(range(18)))
    assert max(parts) <= publish.MAX_PARTS and written < 5 * 18
    assert len(publish.runs(spark, root)) == 3
    assert len(os.listdir(f"{root}/t")) <= publish.MAX_PARTS + 2 * 3
    described = spark.sql(f"SHOW CREATE TABLE {publish.schema_of(root)}.t").first()[0]
    assert len(described) < 1000 and described.count("FROM") == 2


def test_compaction_keeps_parts_bounded_over_any_number_of_appends():
    """The policy alone, over 500 appends and sizes that differ widely."""
    parts, rewritten = [], 0
    for i in range(500):
        size = (1, 10, 1000)[i % 3]
        merged = publish._to_compact(parts)
        rewritten += sum(p.bytes for p in merged)
        parts = [p for p in parts if p not in merged] + [publish.Part(f"r{i}", size + sum(p.bytes for p in merged))]
        assert len(parts) <= publish.MAX_PARTS
    total = sum(p.bytes for p in parts)
    assert total == sum((1, 10, 1000)[i % 3] for i in range(500)) and rewritten < 30 * total


@pytest.mark.parametrize("key", [None, ["id"]])
def test_an_empty_increment_makes_no_run(spark, tmp_path, key):
    root = str(tmp_path / "e")
    first = _append(spark, root, 5, key=key)
    assert _append(spark, root, 5, key=key) == first and _append(spark, root, 4, key=key) == first
    assert publish.runs(spark, root) == [first] and os.listdir(f"{root}/t") == [f"release={first}"]


def test_untouched_partitions_are_named_again(spark, tmp_path):
    root = str(tmp_path / "p")
    schema = "id int, year int, at timestamp_ntz"

    def load(rows):
        return publish.incremental_load(spark, spark.createDataFrame(rows, schema), root, "at", ["id"], "t", "year")

    one = load([(1, 1999, START), (2, 2000, START), (3, 2001, START), (4, None, START)])
    day = lambda n: START + timedelta(days=n)
    two = load([(3, 2002, day(1))])  # moves from 2001 to 2002
    assert sorted(p.name for p in publish.state_of(spark, root)["t"]) == sorted(
        [f"{one}/1999", f"{one}/2000", f"{one}/", f"{two}/2002"])
    assert os.listdir(publish.folder(root, "t", two)).count("year=1999") == 0
    three = load([(4, None, day(2)), (5, 1999, day(2))])
    assert sorted(p.name for p in publish.state_of(spark, root)["t"]) == sorted(
        [f"{three}/1999", f"{one}/2000", f"{three}/", f"{two}/2002"])
    rows = lambda: sorted((r.id, r.year) for r in publish.read_current(spark, root, "t").collect())
    assert rows() == [(1, 1999), (2, 2000), (3, 2002), (4, None), (5, 1999)]
    assert publish.rollback(spark, root) == two
    assert rows() == [(1, 1999), (2, 2000), (3, 2002), (4, None)]
    publish.retire(spark, root, keep=1)
    assert rows() == [(1, 1999), (2, 2000), (3, 2002), (4, None)] and publish.runs(spark, root) == [two]


def test_new_columns_and_refused_changes(spark, tmp_path):
    root = str(tmp_path / "s")
    _publish(spark, root, "v1", x=1)
    wide = spark.createDataFrame([("v2", 2, "new")], "run string, value int, note string")
    publish.write_table(wide, publish.folder(root, "x", "v2"))
    publish.swap(spark, root, "v2", {"x": wide.schema})
    assert publish.read_current(spark, root, "x").collect() == [("v2", 2, "new")]
    publish.rollback(spark, root)
    assert publish.read_current(spark, root, "x").collect() == [("v1", 1, None)]
    other = spark.createDataFrame([("v3", "3")], "run string, value string")
    publish.write_table(other, publish.folder(root, "x", "v3"))
    with pytest.raises(ValueError):
        publish.swap(spark, root, "v3", {"x": other.schema})
    with pytest.raises(ValueError):
        publish.new_run("a/b")
    assert publish.current_version(spark, root) == "v1"


def test_clustered_tables_are_grouped_by_their_key_without_an_exchange(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 37 AS k", "id % 5 AS y", "id AS v")
    for i, split in enumerate((None, ["y"])):
        stored, name = publish.write_clustered(rows, str(tmp_path / f"a b{i}"), "k", 4, split)
        grouped = stored.groupBy("k", "v").count().groupBy("k").count()
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
        if split:  # partitions are looked up by the name
            assert grouped.count() == 37
        publish.forget(spark, [name])
        assert not spark.catalog.tableExists(name)
        if not split:
            assert grouped.count() == 37 and stored.exceptAll(rows).count() == 0 and stored.count() == 1000
        assert spark.read.parquet(str(tmp_path / f"a b{i}")).count() == 1000


def test_buckets_divide_the_shuffle_partitions_and_follow_the_size(spark, tmp_path, monkeypatch):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts == 8 and publish.bucket_count(spark, spark.createDataFrame([(1,)], "x int")) == 8  # of unknown size
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "a b"))
    source = spark.read.parquet(str(tmp_path / "a b"))
    assert publish.bucket_count(spark, source) == 1
    size = sum(f.stat().st_size for f in (tmp_path / "a b").glob("part-*.parquet"))
    monkeypatch.setattr(publish, "BUCKET_BYTES", size // 3)
    assert publish.bucket_count(spark, source) == 4
