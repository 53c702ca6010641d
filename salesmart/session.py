"""SparkSession construction shared by the library, tests and bench.

Settings submitted to the cluster or made by the caller win: a default below is
set only for a key that neither has.  The scratch folder is read from
``spark.checkpoint.dir``; only a single-process session may do without it.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    # AQE: coalesce small shuffle partitions, split skewed join partitions and
    # switch a sort-merge join to broadcast when the runtime size is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs an extra exchange
    # afterwards: the aggregation above it then pre-aggregates map-side, so a
    # hot key is collapsed instead of landing in one task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only below a *measured* size: the static rule trusts file-size
    # estimates (compressed parquet undercounts rows several-fold), so it is
    # off; AQE converts a sort-merge join to a broadcast join only when one
    # side's materialised shuffle output is below 16 MB.  Everything else
    # sort-merges, with AQE splitting skewed partitions.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# These cannot be set once a context runs.
_STATIC = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "salesmart", extra: dict | None = None) -> SparkSession:
    """A session with the defaults above wherever neither the cluster nor the caller has set a key.

    A session that is already active is returned with its settings as they are,
    but for what the caller asks for here.
    """
    active = SparkSession.getActiveSession()
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    asked = dict(extra or {})
    if shuffle_partitions:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in ({} if active else _STATIC | asked).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if not active and k not in asked and not given.contains(k):
            spark.conf.set(k, v)
    for k, v in asked.items():
        if active and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose executors share this process (master ``local`` or
    ``local[...]``) may do without the setting; it gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def dropping_shuffles(spark: SparkSession):
    """Delete each job's shuffle files when it has ended, not some time after the driver's garbage collection.

    For a run of many jobs that each read stored tables.  A DataFrame that is
    executed again has the same rows; its shuffles are made again.
    """
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_tasks(spark: SparkSession):
    """Join shuffle partitions to tasks of a quarter of the default size: wide rows are sorted for their files in memory."""
    return _set(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
