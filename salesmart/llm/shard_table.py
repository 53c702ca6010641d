"""Sharding by a permutation-filled lookup table.

Every shard ranks the slots of a prime-sized table by a permutation of its
own; the shards take turns, each claiming its next free slot, until the table
is full.  Shards get equal shares (within one slot), and when a shard comes or
goes nearly all other slots keep their owner.  A document's key hashes to a
slot and the broadcast table names the shard in constant time.

The table has a fixed number of slots whatever the data's size, so it is filled
on the driver in plain Python; placement is DataFrame functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 2053
SHARDS = 16
#: Hex digits of an md5 that make a number: 60 bits, which both engines hold exactly.
_DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:_DIGITS], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Owner (index in ``shards``) of each slot.

    Shard s prefers slots (offset + k * skip) % slots for k = 0, 1, ...; offset
    and skip come from md5 of its name.  Since ``slots`` is prime, that is a permutation.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be given and differ")
    if slots < len(shards) or slots < 3 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime, at least the number of shards")
    at = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    owner: list[int | None] = [None] * slots
    for turn in range(slots):
        s = turn % len(shards)
        while owner[at[s]] is not None:
            at[s] = (at[s] + skip[s]) % slots
        owner[at[s]] = s
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key by the md5 of its text; a null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") % slots


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard, shard_name): exactly ``slots`` rows."""
    owners = F.split(F.lit(",".join(map(str, fill_table(shards, slots)))), ",")
    names = F.array(*map(F.lit, shards))
    return (spark.range(slots).select(F.col("id").alias("slot"), F.element_at(owners, (F.col("id") + 1).cast("int"))
                                      .cast("int").alias("shard"))
            .withColumn("shard_name", F.element_at(names, F.col("shard") + 1)))


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with (slot, shard, shard_name); other columns of these names are replaced.

    Rows keep their order and partitions: one hash and one lookup each.  Null
    keys share one slot.  Equal keys always go to the same shard.
    """
    added = ("slot", "shard", "shard_name")
    if key.lower() in added:
        raise ValueError(f"the key cannot be named {key}")
    rows = rows.drop(*[c for c in rows.columns if c.lower() in added])
    table = lookup_table(rows.sparkSession, shards, slots)  # its size is ``slots``, so it is broadcast
    return rows.withColumn("slot", slot_of(F.col(key), slots)).join(F.broadcast(table), "slot").select(
        *rows.columns, "slot", "shard", "shard_name")


def write_shards(placed: DataFrame, path: str, files: int = 1) -> None:
    """Write a folder for each shard name.

    Rows are dealt to ``files`` writers for each shard by a hash of the whole
    row, so a shard with a third of the rows is written by several tasks.
    """
    spread = F.pmod(F.xxhash64(*placed.columns), F.lit(files))
    placed.repartition(F.col("shard"), spread).write.partitionBy("shard_name").parquet(path)
