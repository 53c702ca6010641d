"""Slowly changing dimensions (HIST-0..4) and keyed merges, as DataFrame joins/windows.

All operators take snapshots ``(key, tracked columns..., updated_at)``.

* type 0 keeps the first value of a key (new keys only are added);
* type 1 overwrites (latest snapshot wins; keys absent from it are kept);
* type 2 keeps every version with ``valid_from / valid_to / is_current``;
  ``scd2_history`` builds it from observed versions in one window pass (per
  key, ordered by time), ``scd2_merge`` puts one more snapshot into an
  existing history by the same pass;
  ``scd2_history_blocks`` spreads keys with very many versions over tasks;
* type 3 keeps the current and the previous value side by side;
* type 4 splits current rows (type 1) from a separate history table.

Types 0, 1 and 4 are a left-anti join + union — no MERGE statement needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _without(rows: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key is not among ``known``; a null key equals a null key."""
    keys = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).distinct()
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)])
    return rows.join(keys, same, "left_anti")


def _one_each(snapshot: DataFrame, key: list[str], ts: str, newest: bool) -> DataFrame:
    """One row of each key, the newest or the oldest; equal times are settled by a hash of the row."""
    if ts not in snapshot.columns:
        return snapshot
    order = F.struct(F.col(ts), F.xxhash64(*snapshot.columns))
    pick = (F.max_by if newest else F.min_by)(F.struct(*snapshot.columns), order)
    return (snapshot.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(pick.alias("_row"))
            .select("_row.*"))


def scd0(old: DataFrame, new: DataFrame, key: list[str], ts: str = "updated_at") -> DataFrame:
    """Type 0: retain original values; only keys never seen before are added, of repeated ones the oldest row.

    Null keys match null keys, here and in type 1.
    """
    return old.unionByName(_one_each(_without(new, old, key), key, ts, newest=False))


def scd1(old: DataFrame, new: DataFrame, key: list[str], ts: str = "updated_at") -> DataFrame:
    """Type 1: overwrite with the new snapshot, of repeated keys the newest row; keys missing from it stay as they were."""
    return _one_each(new, key, ts, newest=True).unionByName(_without(old, new, key))


def scd2_history(versions: DataFrame, key: list[str], tracked: list[str], ts: str = "updated_at") -> DataFrame:
    """Type 2 from observed versions (e.g. the union of several snapshots), in any order of arrival.

    Of several versions of a key at one instant the greatest (by the tracked
    columns) counts; then a version is kept only when a tracked column differs
    from the version before.  ``valid_to`` is the next kept version's
    ``valid_from``, so a key's versions never overlap and one is current.
    All windows share one partitioning by the key: one exchange.
    """
    w = Window.partitionBy(*key).orderBy(ts, *tracked)
    v = versions.select(*key, *tracked, ts).withColumn("_next_ts", F.lead(ts).over(w))
    v = v.filter(F.col("_next_ts").isNull() | (F.col("_next_ts") != F.col(ts)) | F.col(ts).isNull())
    by_time = Window.partitionBy(*key).orderBy(ts)
    marked = v.select(*key, *tracked, ts, F.row_number().over(by_time).alias("_rn"),
                      *[F.lag(c).over(by_time).alias(f"_prev_{c}") for c in tracked])
    differs = reduce(lambda x, y: x | y, [~F.col(c).eqNullSafe(F.col(f"_prev_{c}")) for c in tracked])
    kept = marked.filter((F.col("_rn") == 1) | differs).select(*key, *tracked, ts)
    nxt = F.lead(ts).over(by_time)
    return kept.select(*key, *tracked, F.col(ts).alias("valid_from"), nxt.alias("valid_to"),
                       nxt.isNull().alias("is_current"))


def _neighbour(ends: DataFrame, key: list[str], of) -> DataFrame:
    """(key, block, _near): the end of the nearest block that has one; a window over a row a block, not a row a version."""
    over = Window.partitionBy(*key).orderBy("_block")
    return ends.select(*key, "_block", of("_end").over(over).alias("_near"), of(F.lit(True)).over(over).alias("_has")).filter("_has")


def scd2_history_blocks(versions: DataFrame, key: list[str], tracked: list[str], ts: str = "updated_at",
                        hours: int = 24) -> DataFrame:
    """Type 2 as ``scd2_history``, for keys with so many versions that one task cannot order them.

    A key's versions are ordered in blocks of ``hours``.  The last version of a
    block is carried to the key's next block, to be compared with the first one
    there; the first version kept in a block is carried back, to close the last
    one kept before.  Both carries are found among one row for each key and
    block, so no task orders more than the instants of one key in one block, or
    the blocks of one key.  Versions at one instant are reduced to the greatest
    before, in part where they are read.  Versions without a time count as one
    instant before all others, null keys as one key.  For ordinary keys
    ``scd2_history`` is cheaper: it has one exchange.
    """
    if hours < 1:
        raise ValueError("a block has an hour at least")
    block = F.expr(f"(unix_date(cast(`{ts}` as date)) * 24L + hour(`{ts}`)) div {int(hours)}")
    instants = (versions.groupBy(*key, ts).agg(F.max(F.struct(*tracked)).alias("_v")).withColumn("_block", block))
    in_order = Window.partitionBy(*key, "_block").orderBy("_ord", ts)

    last = instants.groupBy(*key, "_block").agg(F.max_by("_v", F.struct(ts)).alias("_end"))
    before = _neighbour(last, key, F.lag).select(
        *key, "_block", F.lit(None).cast(instants.schema[ts].dataType).alias(ts), F.col("_near").alias("_v"), F.lit(0).alias("_ord"))
    marked = instants.select(*key, "_block", ts, "_v", F.lit(1).alias("_ord")).unionByName(before).select(
        "*", F.row_number().over(in_order).alias("_rn"), F.lag("_v").over(in_order).alias("_prev"))
    kept = marked.filter((F.col("_ord") == 1) & ((F.col("_rn") == 1) | ~F.col("_v").eqNullSafe(F.col("_prev"))))
    kept = kept.select(*key, "_block", ts, "_v", F.lit(1).alias("_ord"))

    first = kept.groupBy(*key, "_block").agg(F.min(ts).alias("_end"))
    after = _neighbour(first, key, F.lead).select(
        *key, "_block", F.col("_near").alias(ts), F.lit(None).cast(kept.schema["_v"].dataType).alias("_v"), F.lit(2).alias("_ord"))
    closed = kept.unionByName(after).select("*", F.lead(ts).over(in_order).alias("valid_to")).filter("_ord = 1")
    return closed.select(*key, *[F.col("_v")[c].alias(c) for c in tracked], F.col(ts).alias("valid_from"), "valid_to",
                         F.col("valid_to").isNull().alias("is_current"))


def scd2_init(snapshot: DataFrame, key: list[str], tracked: list[str], ts: str = "updated_at") -> DataFrame:
    """The history of a first snapshot."""
    return scd2_history(snapshot, key, tracked, ts)


def scd2_merge(history: DataFrame, new: DataFrame, key: list[str], tracked: list[str],
               ts: str = "updated_at") -> DataFrame:
    """Type 2 merge of one more snapshot, late or repeated versions included.

    The stored versions and the new ones are put in order together: no join.
    A history holds changes only; an unchanged repeat seen earlier is not in
    it, so a late version between two such repeats stands until the next change.
    """
    stored = history.select(*key, *tracked, F.col("valid_from").alias(ts))
    return scd2_history(stored.unionByName(new.select(*key, *tracked, ts)), key, tracked, ts)


def scd3(old: DataFrame, new: DataFrame, key: list[str], column: str) -> DataFrame:
    """Type 3: current and previous value of ``column`` (previous only when it changed)."""
    o, n = old.alias("o"), new.alias("n")
    on = reduce(lambda x, y: x & y, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key])
    j = o.join(n, on, "full_outer")
    cur = F.coalesce(F.col(f"n.{column}"), F.col(f"o.{column}"))
    prev = F.when(F.col(f"n.{key[0]}").isNotNull() & F.col(f"o.{key[0]}").isNotNull()
                  & ~F.col(f"n.{column}").eqNullSafe(F.col(f"o.{column}")), F.col(f"o.{column}"))
    return j.select(*[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in key],
                    cur.alias(f"current_{column}"), prev.alias(f"previous_{column}"))


def scd4(old: DataFrame, new: DataFrame, key: list[str], tracked: list[str],
         ts: str = "updated_at") -> tuple[DataFrame, DataFrame]:
    """Type 4: (current table, history table of replaced versions with their end time)."""
    current = scd1(old, new, key, ts)
    o, n = old.alias("o"), new.alias("n")
    on = reduce(lambda x, y: x & y, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key])
    replaced = o.join(n, on, "inner").filter(
        reduce(lambda x, y: x | y, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in tracked]))
    history = replaced.select(*[F.col(f"o.{c}").alias(c) for c in (*key, *tracked)],
                              F.col(f"o.{ts}").alias("valid_from"), F.col(f"n.{ts}").alias("valid_to"))
    return current, history
