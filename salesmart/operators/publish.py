"""Materialisations and publishing (SNK-1..6).

* view (SNK-1): a temp view over a lazy DataFrame;
* table (SNK-2): full overwrite of a parquet table;
* incremental (SNK-3): high-water-mark append, or keyed upsert;
* staged publish + swap (SNK-5) and rollback (SNK-6): one release for all tables.

A publishing root has a catalog schema with these objects:

* ``<table>__store``: an external table over ``<root>/<table>``, partitioned by
  ``release`` (the run that wrote the rows) and, if asked, by one column more;
* ``release_state``: for each run, which parts (release, or release/value) make
  up every table, and the run before it;
* ``live_release``: a view of one run's rows of ``release_state``;
* ``<table>``: a view of the store's rows in the parts that ``live_release``
  names.  The parts are a scalar subquery over partition columns, so only their
  folders are read.

A swap and a rollback replace ``live_release`` and nothing else: one catalog
operation changes all tables together.  A query resolves it once; a DataFrame
made before a swap goes on reading its run until that run is retired.  Runs
that wrote some tables only name the other tables' parts again, so rolling back
undoes exactly the last run.  There is one writer at a time.  With a persistent
catalog this outlives the session.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
import zlib
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STATE, LIVE, STORE = "release_state", "live_release", "__store"
#: The catalog schema that names clustered tables while a query or build reads them.
CLUSTERED = "salesmart_clustered"
_STATE_COLUMNS = "table_name STRING, part STRING, bytes BIGINT, parent STRING"

#: Appended parts of a table; with more, the smaller ones are rewritten into one.
MAX_PARTS = 8
#: Runs that an incremental load leaves for rolling back.
KEEP_RUNS = 10


class Part(NamedTuple):
    """A folder of a published table: ``release`` or ``release/value`` below its root, and its size."""
    name: str
    bytes: int


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full overwrite: nothing of an earlier table stays, partitioned or not.

    Written with zstd: by far the most bytes of a build are its tables.
    """
    w = df.write.mode("overwrite").format("parquet").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


#: Fixed value: bytes of a query's source files for one bucket of a clustered table.
BUCKET_BYTES = 8 << 20


def bucket_count(spark: SparkSession, source: DataFrame) -> int:
    """Buckets for tables made from these sources: a divisor of the shuffle partitions, as many as their files' size asks for.

    A task that holds whole shuffle partitions then writes whole buckets, a file each.  Sources that are not files
    have an unknown size and get as many buckets as there are partitions.
    """
    parts, files = int(spark.conf.get("spark.sql.shuffle.partitions")), source.inputFiles()
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)) for f in files]
    size = sum(at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).getLen() for at in paths)
    return next(n for n in range(1, parts + 1) if n == parts or files and parts % n == 0 and n * BUCKET_BYTES >= size)


def write_clustered(df: DataFrame, path: str, key: str, buckets: int, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """``write_table`` in buckets by ``key``: readers that group or join by it need no exchange of these rows.

    Returns the table as a reader and the catalog name that it has for this; its caller drops the name when done
    (``forget``), the files stay.  Without ``partition_by`` the reader outlives the name.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {CLUSTERED}")
    name = f"{CLUSTERED}.t{uuid.uuid4().hex}"
    w = (df.write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd")
         .option("partitionOverwriteMode", "static").bucketBy(buckets, key))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return spark.table(name), name


def forget(spark: SparkSession, names: list[str]) -> None:
    """Drop the names of clustered tables; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def newer_than_target(new: DataFrame, target: DataFrame, updated_at: str) -> DataFrame:
    """Lazy high-water-mark filter: ``updated_at > (select max(updated_at) from target)``.

    The mark is a scalar subquery (one value), so nothing is collected; an
    empty target has a NULL mark and every row passes (first load).
    """
    mark = target.agg(F.max(updated_at)).scalar()
    return new.filter(mark.isNull() | (F.col(updated_at) > mark))


def newest_by_key(changes: DataFrame, key: list[str], updated_at: str) -> DataFrame:
    """One row per key: the last change; equal times are settled by a hash of the row."""
    order = F.struct(F.col(updated_at), F.xxhash64(*changes.columns))
    return (changes.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)])
            .agg(F.max_by(F.struct(*changes.columns), order).alias("_last")).select("_last.*"))


def _same_key(key: list[str], other: str = "_k"):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{i}")) for i, k in enumerate(key)])


def _keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).distinct()


def upsert(old: DataFrame | None, changes: DataFrame, key: list[str], updated_at: str | None = None) -> DataFrame:
    """Keyed merge: old rows whose key is not in ``changes``, plus the last change of each key.

    Null keys match null keys.  Without ``updated_at`` the changes must hold each key once.
    """
    if updated_at is not None:
        changes = newest_by_key(changes, key, updated_at)
    if old is None:
        return changes
    return old.join(_keys(changes, key), _same_key(key), "left_anti").unionByName(changes)


def _version_name() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("v%Y%m%dT%H%M%S%f")


def schema_of(root: str) -> str:
    """The catalog schema that holds the objects of a publishing root."""
    return f"published_{zlib.crc32(root.rstrip('/').encode()):08x}"


def new_run(version: str | None = None) -> str:
    """A name for the next run (nothing is visible yet)."""
    run = version or _version_name()
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"run name {run!r} has characters other than letters, digits, '_', '.' and '-'")
    return run


def folder(root: str, table: str, run: str) -> str:
    """Where a run writes its rows of a table."""
    return f"{root.rstrip('/')}/{table}/release={run}"


def _exists(spark: SparkSession, root: str, name: str) -> bool:
    schema = schema_of(root)
    return spark.catalog.databaseExists(schema) and spark.catalog.tableExists(f"{schema}.{name}")


def _live_rows(spark: SparkSession, root: str) -> list:
    return spark.table(f"{schema_of(root)}.{LIVE}").collect() if _exists(spark, root, LIVE) else []


def current_version(spark: SparkSession, root: str) -> str | None:
    """The live run; None if nothing is published."""
    rows = _live_rows(spark, root)
    return rows[0]["run"] if rows else None


def state_of(spark: SparkSession, root: str, run: str | None = None) -> dict[str, list[Part]]:
    """The parts of every table in a run (by default the live one), by name."""
    if run is None:
        rows = _live_rows(spark, root)
    else:
        rows = (spark.table(f"{schema_of(root)}.{STATE}").where(F.col("run") == run).collect()
                if _exists(spark, root, STATE) else [])
    out: dict[str, list[Part]] = {}
    for r in sorted(rows, key=lambda r: (r["table_name"], r["part"])):
        out.setdefault(r["table_name"], []).append(Part(r["part"], r["bytes"]))
    return out


def runs(spark: SparkSession, root: str) -> list[str]:
    """The live run and those before it that can be rolled back to, newest first."""
    if not _exists(spark, root, STATE):
        return []
    before = {r["run"]: r["parent"] for r in
              spark.table(f"{schema_of(root)}.{STATE}").select("run", "parent").distinct().collect()}
    chain, run = [], current_version(spark, root)
    while run in before:
        chain.append(run)
        run = before[run]
    return chain


def published_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables of the live run."""
    return sorted(state_of(spark, root))


def _go_live(spark: SparkSession, root: str, run: str) -> None:
    schema = schema_of(root)
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{LIVE} AS SELECT table_name, part, bytes, parent, run "
              f"FROM {schema}.{STATE} WHERE run = '{run}'")


def _part_name(partition_by: str | None) -> str:
    """SQL for the part that a stored row lies in; a null value is written as nothing."""
    return f"concat(release, '/', coalesce(CAST(`{partition_by}` AS STRING), ''))" if partition_by else "release"


def _declare(spark: SparkSession, root: str, table: str, given: StructType, partition_by: str | None) -> None:
    """The table's store and view; columns that are new to the store are added to both."""
    if table in (STATE, LIVE) or table.endswith(STORE):
        raise ValueError(f"{table} is a name of the library's own")
    schema, store = schema_of(root), f"{schema_of(root)}.{table}{STORE}"
    said = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in given}
    parts = ["release", *([partition_by] if partition_by else [])]
    if not _exists(spark, root, table + STORE):
        columns = ", ".join([c for n, c in said.items() if n != partition_by] + ["release STRING"]
                            + ([said[partition_by]] if partition_by else []))
        spark.sql(f"CREATE TABLE {store} ({columns}) USING parquet PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) "
                  f"LOCATION '{root.rstrip('/')}/{table}'")
        names, changed = given.names, True
    else:
        old = {f.name: f.dataType for f in spark.table(store).schema}
        found = [c.name for c in spark.catalog.listColumns(store) if c.isPartition]
        wrong = [f.name for f in given if f.name in old and old[f.name] != f.dataType]
        if wrong or sorted(found) != sorted(parts):
            raise ValueError(f"{table} is published with other types ({wrong}) or partitions ({found}): publish it by another name")
        added = [f.name for f in given if f.name not in old]
        if added:
            spark.sql(f"ALTER TABLE {store} ADD COLUMNS ({', '.join(said[n] for n in added)})")
        names, changed = [*spark.table(f"{schema}.{table}").columns, *added], bool(added)
    if changed:
        columns = ", ".join(f"`{n}`" for n in names)
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} AS SELECT {columns} FROM {store} WHERE array_contains("
                  f"(SELECT collect_list(part) FROM {schema}.{LIVE} WHERE table_name = '{table}'), {_part_name(partition_by)})")


def path_and_files(spark: SparkSession, path: str):
    """A path and its file system, whichever it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _written_parts(spark: SparkSession, root: str, table: str, run: str, partition_by: str | None) -> list[Part]:
    """The parts that a run has written, from its folder's listing."""
    at, files = path_and_files(spark, folder(root, table, run))
    if not partition_by:
        return [Part(run, files.getContentSummary(at).getLength())]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    out = []
    for status in files.listStatus(at):
        name, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and name == partition_by:
            value = "" if value == "__HIVE_DEFAULT_PARTITION__" else unescape(value)
            out.append(Part(f"{run}/{value}", files.getContentSummary(status.getPath()).getLength()))
    return out


def swap(spark: SparkSession, root: str, run: str, tables: dict[str, StructType],
         partition_by: dict[str, str] | None = None, kept: dict[str, list[Part]] | None = None) -> None:
    """SNK-5: make the run live for all ``tables``, whose rows it has written to ``folder(root, table, run)``.

    ``kept`` names parts of the live run that stay in a table beside the new
    rows (default: none).  Tables that the run has not written stay as they are.
    """
    schema, split = schema_of(root), partition_by or {}
    if not _exists(spark, root, STATE):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        spark.sql(f"CREATE TABLE {schema}.{STATE} ({_STATE_COLUMNS}, run STRING) USING parquet PARTITIONED BY (run) "
                  f"LOCATION '{root.rstrip('/')}/{STATE}'")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{LIVE} AS SELECT table_name, part, bytes, parent, run "
                  f"FROM {schema}.{STATE} WHERE false")
    rows = _live_rows(spark, root)
    parent = rows[0]["run"] if rows else None
    state = state_of(spark, root)
    for table, given in tables.items():
        by = split.get(table)
        _declare(spark, root, table, given, by)
        if by:
            spark.sql(f"ALTER TABLE {schema}.{table}{STORE} RECOVER PARTITIONS")
        else:
            spark.sql(f"ALTER TABLE {schema}.{table}{STORE} ADD IF NOT EXISTS PARTITION (release = '{run}')")
        state[table] = [*(kept or {}).get(table, []), *_written_parts(spark, root, table, run, by)]
    new = [(t, p.name, p.bytes, parent) for t, parts in state.items() for p in parts]
    (spark.createDataFrame(new, _STATE_COLUMNS).coalesce(1).write.mode("overwrite")
     .parquet(f"{root.rstrip('/')}/{STATE}/run={run}"))
    spark.sql(f"ALTER TABLE {schema}.{STATE} ADD IF NOT EXISTS PARTITION (run = '{run}')")
    _go_live(spark, root, run)


def rollback(spark: SparkSession, root: str) -> str | None:
    """SNK-6: the run before the live one is live again, for all tables; returns it.

    Rolling back again goes further back.  Nothing is changed, and None
    returned, if there is no run before.
    """
    chain = runs(spark, root)
    if len(chain) < 2:
        return None
    _go_live(spark, root, chain[1])
    return chain[1]


def read_run(spark: SparkSession, root: str, table: str, run: str) -> DataFrame:
    """A published table as a run left it."""
    parts = state_of(spark, root, run).get(table)
    if not parts:
        raise FileNotFoundError(f"no published version of {table} under {root}")
    return _rows_of(spark, root, table, parts)


def _rows_of(spark: SparkSession, root: str, table: str, parts: list[Part]) -> DataFrame:
    """Rows of some parts of a table; the parts are constants, so other folders are not listed."""
    store = f"{schema_of(root)}.{table}{STORE}"
    rows = spark.table(store).where(F.col("release").isin(sorted({p.name.split("/")[0] for p in parts})))
    rows = rows.where(F.expr(_part_name(_partitioned_by(spark, root, table))).isin([p.name for p in parts]))
    return rows.select(*spark.table(f"{schema_of(root)}.{table}").columns)


def snapshot(spark: SparkSession, root: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Tables of one and the same run, the one that is live now, also across several queries and swaps."""
    run = current_version(spark, root)
    if run is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return {t: read_run(spark, root, t, run) for t in tables or state_of(spark, root, run)}


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    if table not in state_of(spark, root):
        raise FileNotFoundError(f"no published version of {table} under {root}")
    return spark.table(f"{schema_of(root)}.{table}")


def _part_folder(spark: SparkSession, root: str, table: str, part: str, partition_by: str | None):
    """Path and file system of a part."""
    release, _, value = part.partition("/")
    path = folder(root, table, release)
    if partition_by:
        escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        path += f"/{partition_by}={escape(value) if value else '__HIVE_DEFAULT_PARTITION__'}"
    return path_and_files(spark, path)


def _partitioned_by(spark: SparkSession, root: str, table: str) -> str | None:
    columns = spark.catalog.listColumns(f"{schema_of(root)}.{table}{STORE}")
    return next((c.name for c in columns if c.isPartition and c.name != "release"), None)


def check_parts(spark: SparkSession, root: str, table: str) -> None:
    """Raise if a live part of the table is gone or has another size than it was published with.

    A reader would take a folder that is gone for an empty one.
    """
    by = _partitioned_by(spark, root, table)
    for part in state_of(spark, root)[table]:
        at, files = _part_folder(spark, root, table, part.name, by)
        if not files.exists(at) or files.getContentSummary(at).getLength() != part.bytes:
            raise RuntimeError(f"the live part {part.name} of {table} is damaged")


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` runs, and those rolled back, and delete the parts that none of the kept names.

    Returns the deleted parts as table/part.
    """
    schema = schema_of(root)
    if not _exists(spark, root, STATE):
        return []
    kept, named = set(runs(spark, root)[:keep]), {}
    for r in spark.table(f"{schema}.{STATE}").select("run", "table_name", "part").collect():
        named.setdefault((r["table_name"], r["part"]), set()).add(r["run"])
    gone = sorted(k for k, by in named.items() if not by & kept)
    for table, part in gone:
        at, files = _part_folder(spark, root, table, part, _partitioned_by(spark, root, table))
        files.delete(at, True)
    for table in {t for t, _ in gone}:
        spark.sql(f"MSCK REPAIR TABLE {schema}.{table}{STORE} SYNC PARTITIONS")
    for run in sorted(set().union(*named.values()) - kept):
        spark.sql(f"ALTER TABLE {schema}.{STATE} DROP IF EXISTS PARTITION (run = '{run}')")
        at, files = path_and_files(spark, f"{root.rstrip('/')}/{STATE}/run={run}")
        files.delete(at, True)
    return [f"{t}/{p}" for t, p in gone]


def _to_compact(parts: list[Part]) -> list[Part]:
    """The parts that the next append rewrites together with its rows: none, or the smaller half of too many."""
    return sorted(parts, key=lambda p: p.bytes)[:len(parts) + 1 - MAX_PARTS // 2] if len(parts) >= MAX_PARTS else []


def _touched(live: DataFrame, last: DataFrame, key: list[str], partition_by: str) -> list:
    """Values of the partitions that the changes are in, or move a key out of: as many as the table has at most."""
    moved = live.select(*key, partition_by).join(_keys(last, key), _same_key(key), "left_semi").select(partition_by)
    return [r[0] for r in last.select(partition_by).union(moved).distinct().collect()]


def incremental_load(spark: SparkSession, new: DataFrame, root: str, updated_at: str,
                     key: list[str] | None = None, table: str = "data",
                     partition_by: str | None = None, keep: int = KEEP_RUNS) -> str:
    """SNK-3: load the rows newer than the live table's high-water mark as a new run; returns the live run.

    The first load publishes all rows (with a key: the last of each).  Without
    newer rows there is no new run.  Without a key, the newer rows become a part
    beside the live ones; too many parts are compacted in the same write, the
    smaller ones first, so that a row is rewritten only some few times.  With a
    key, the last change of a key wins, also if it moves the key to another
    ``partition_by`` value or the value is null (such a column is an integer,
    string or date).  A table without partitions is written anew; of a
    partitioned one, only the partitions concerned are, and the release names
    the others' folders again.  A failed load leaves the live run as it was.
    The last ``keep`` runs stay.
    """
    run, live_run = new_run(), current_version(spark, root)
    state = state_of(spark, root).get(table, [])
    stay: list[Part] = []
    if not state:
        rows = newest_by_key(new, key, updated_at) if key else new
    else:
        check_parts(spark, root, table)
        live = read_current(spark, root, table)
        inc = newer_than_target(new, live, updated_at)
        if not key:
            merged = _to_compact(state)
            stay = [p for p in state if p not in merged]
        if inc.isEmpty():
            return live_run
        if not key:
            rows = inc if not merged else inc.unionByName(_rows_of(spark, root, table, merged), allowMissingColumns=True)
        elif partition_by:
            last = newest_by_key(inc, key, updated_at)
            values = _touched(live, last, key, partition_by)
            here = F.col(partition_by).isin([v for v in values if v is not None])
            here = here | F.col(partition_by).isNull() if None in values else here
            rows = upsert(live.where(here), last, key)
            names = {"" if v is None else str(v) for v in values}
            stay = [p for p in state if p.name.partition("/")[2] not in names]
        else:
            rows = upsert(live, inc, key, updated_at)
    rows = rows.select(*new.columns)
    write_table(rows, folder(root, table, run), [partition_by] if partition_by else None)
    swap(spark, root, run, {table: rows.schema}, {table: partition_by} if partition_by else None, {table: stay})
    if len(runs(spark, root)) > keep:
        retire(spark, root, keep)
    return run
