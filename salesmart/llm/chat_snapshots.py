"""Chat formatting: collapse cumulative snapshots, then render the maximal conversations.

A conversation is often logged again after each turn, so that earlier logs are
prefixes of later ones.  Each turn gets a rolling hash of its conversation up
to there; a log whose last hash is an inner hash of another log is dropped by
an anti-join, and of equal logs the smallest id stays.  DataFrame functions
only; texts are hashed before any shuffle, and only the turns of the kept
conversations are moved for rendering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stored

#: Turn numbers rendered into one row; longer conversations get several rows.
TURNS_PER_ROW = 512
#: Turns whose rolling hash one window computes; block totals carry over to the next.
_BLOCK = 4096


def _parts(h: Column) -> list[Column]:
    """A 128-bit hash as two longs."""
    return [F.conv(F.substring(h, a, 16), 16, -10).cast("long") for a in (1, 17)]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, turn_hash): distinct turns without their texts.

    Null roles and texts count as empty; rows without conv_id or turn are left out.
    """
    return (conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
            .select("conv_id", "turn", F.md5(F.concat(
                F.coalesce(F.col("role"), F.lit("")).cast("binary"), F.unhex(F.lit("00")),
                F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("turn_hash"))
            .distinct())


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, h1, h2, n_turns): the rolling hash after the first n turns, for every n.

    The hash is the xor of 128-bit hashes of (position, turn), so that blocks of
    one very long conversation are hashed apart and put together afterwards.
    Position counts the distinct turns in the order of ``turn``; turns of equal
    number follow in the order of their hash.
    """
    block = F.floor(F.col("turn") / _BLOCK).alias("block")
    rows = turns(conversations).select("conv_id", block, "turn", "turn_hash")
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "turn_hash")
    blocks = Window.partitionBy("conv_id").orderBy("block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    sizes = sizes.select("conv_id", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("earlier"),
                         F.sum("size").over(Window.partitionBy("conv_id")).alias("n_turns"))
    placed = rows.join(sizes, ["conv_id", "block"]).withColumn("n", F.col("earlier") + F.row_number().over(in_block))
    h1, h2 = _parts(F.md5(F.concat_ws(":", F.col("n").cast("string"), "turn_hash").cast("binary")))
    placed = placed.select("conv_id", "block", "n", "n_turns", h1.alias("p1"), h2.alias("p2"))
    running = Window.partitionBy("conv_id", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.groupBy("conv_id", "block").agg(F.bit_xor("p1").alias("t1"), F.bit_xor("p2").alias("t2"))
    carried = totals.select("conv_id", "block", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(c)
                                                  for t, c in (("t1", "c1"), ("t2", "c2"))])
    return placed.join(carried, ["conv_id", "block"]).select(
        "conv_id", "n", *[F.bit_xor(p).over(running).bitwiseXOR(F.col(c)).alias(h)
                          for p, c, h in (("p1", "c1", "h1"), ("p2", "c2", "h2"))], "n_turns")


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns): conversations that are no prefix of a longer one; of equal ones the smallest id."""
    every = stored(prefixes(conversations), "prefixes")
    key = ["n", "h1", "h2"]
    logs = every.where("n = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    inner = every.where("n < n_turns").select(*key).distinct()  # copies collapse before the shuffle
    return logs.join(inner, key, "left_anti").select("conv_id", F.col("n").alias("n_turns"))


def render(conversations: DataFrame, keep: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """(conv_id, part, n_turns, text): the kept conversations in chat markup.

    Each turn is ``<|role|>``, a line break, its text and a line break.  A row
    holds the turns numbered part * turns_per_row and on, so a long conversation
    is no single group; joined in order of ``part`` the rows are the whole of it.
    Repeated rows collapse in the group's set, so texts are shuffled once.
    """
    said = (conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
            .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
            .join(keep, "conv_id"))
    tie = F.md5(F.concat(F.col("role").cast("binary"), F.unhex(F.lit("00")), F.col("text").cast("binary")))
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n"))
    rows = said.select("conv_id", "n_turns", F.floor(F.col("turn") / turns_per_row).alias("part"),
                       F.struct("turn", tie.alias("tie"), line.alias("line")).alias("said"))
    return rows.groupBy("conv_id", "part").agg(
        F.max("n_turns").alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_set("said")), lambda x: x["line"]), "").alias("text"))


def collapsed_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered; see ``turns`` and ``maximal`` for nulls, ties and repeated rows."""
    return render(conversations, stored(maximal(conversations), "maximal"))
