"""Shortest-pack-first packing over the length histogram.

1. Every text becomes token ids plus an end id and is cut into pieces of at
   most ``capacity`` ids.  A task numbers its pieces of each length as it goes.
2. The histogram of lengths (at most ``capacity`` rows) is all that the
   driver sees.  It places the lengths longest first, each into the shortest
   open packing pattern that has room, and counts patterns instead of packs.
3. The patterns join back to the pieces by the piece's rank within its length.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import map_rows, stored
from salesmart.llm.token_ids import encoder

#: (length, first rank, end rank, first sequence, copies in a sequence, offset of the first copy)
Run = tuple[int, int, int, int, int, int]


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, part, rank): pieces of every text, in order.

    ``ids`` are unsigned 32-bit little-endian; ``rank`` numbers the pieces of
    one length within the task ``part``.  A null or empty text is the end id alone.
    """
    def make():
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64).tolist()
        tokens, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()

        def work(rows):
            out = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "part", "rank")}
            for doc_id, ids in zip(rows["doc_id"], tokens.encode(rows["text"])):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start:4 * (start + capacity)]
                    length = len(piece) // 4
                    for k, v in zip(out, (doc_id, start, length, piece, total, part, seen[length])):
                        out[k].append(v)
                    seen[length] += 1
            return out
        return work

    return map_rows(documents.select("doc_id", "text"), "doc_id long, start long, length long, ids binary, "
                    "doc_tokens long, part int, rank long", make)


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Where each rank of each length goes.  A pattern is a set of sequences with equal contents.

    Lengths run longest first.  Each takes the open pattern with the fewest ids
    while it has room; a pattern with more sequences than are needed splits.
    What is left opens new patterns, each filled with this length.
    """
    runs: list[Run] = []
    by_fill: list[tuple[int, int, int]] = []  # (ids so far, first sequence, sequences)
    next_sequence = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left and by_fill and by_fill[0][0] + length <= capacity:
            fill, first, count = heappop(by_fill)
            used = min(left, count)
            runs.append((length, rank, rank + used, first, 1, fill))
            if fill + length < capacity:
                heappush(by_fill, (fill + length, first, used))
            if used < count:
                heappush(by_fill, (fill, first + used, count - used))
            left, rank = left - used, rank + used
        copies = capacity // length
        for each, count in ((copies, left // copies), (left % copies, 1)):
            if each and count:
                runs.append((length, rank, rank + each * count, next_sequence, each, 0))
                if each * length < capacity:
                    heappush(by_fill, (each * length, next_sequence, count))
                rank, next_sequence = rank + each * count, next_sequence + count
    return runs


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with ``length``, ``part``, ``rank``) plus sequence_id and offset, gapless from 0.

    The counts by (part, length) give each task's first rank of a length, so no
    length, however common, is ranked in one task.
    """
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    ranked = pieces.join(first, ["part", "length"]).withColumn("_rank", F.col("_first") + F.col("rank"))
    # bounded by the patterns: lengths times splits, whatever the number of pieces
    runs = spark.createDataFrame(plan_patterns(histogram, capacity) or [(0, 0, 0, 0, 1, 0)],
                                 "length long, lo long, hi long, seq long, copies long, at long")
    runs = runs.withColumnRenamed("length", "_length")
    q = F.col("_rank") - F.col("lo")
    return (ranked.join(F.broadcast(runs), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("lo"))
                        & (F.col("_rank") < F.col("hi")))
            .select(*[c for c in pieces.columns if c not in ("part", "rank")],
                    (F.col("seq") + F.floor(q / F.col("copies"))).cast("long").alias("sequence_id"),
                    (F.col("at") + q % F.col("copies") * F.col("length")).cast("long").alias("offset")))


def packed_documents(documents: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0,
                     with_ids: bool = True) -> DataFrame:
    """Pieces with their places and ids (or, to store less, only the crc32 of the ids).

    Rows with a null doc_id, repeated rows and repeated ids are packed like any
    other.  An empty table gives an empty result.
    """
    pieces = token_pieces(documents, tokenizer, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    return pack(stored(pieces if with_ids else pieces.drop("ids"), "pieces"), capacity)
