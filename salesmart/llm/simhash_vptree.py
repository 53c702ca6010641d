"""SimHash near-duplicates: vantage-point trees over Hamming distance.

1. Fingerprints: 64 majority bits over the XXH64 of all word shingles.
2. Equal fingerprints become one class, so copies never meet as pairs.
3. The 64 bits fall into windows, so many that fingerprints at most ``d`` bits
   apart differ by at most ``r = d // windows`` bits in one window at least.
   In each window a vantage-point tree shards the classes by their distance
   to a vantage point.  By the triangle bound, near pairs differ by at most
   ``r`` in that distance; classes within ``r`` of a boundary are sent to both
   sides, so every near pair meets in some shard.
4. A task continues the tree inside its shard and compares whole fingerprints
   at the leaves.  It returns a spanning forest of the links, not all pairs.
5. Connected components over the forests give the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import broadcast_if_small, fresh, map_arrow, map_rows, stored, text_key
from salesmart.llm.components import components

#: Shingles hashed, or fingerprints compared, at a time, so that memory stays small.
_CHUNK = 1 << 15
_LEAF = 256
_SEED = 20
#: Classes with more than this part of all rows are joined by broadcast.
HOT = 1024


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """The unsigned fingerprint of one text; no words: 0; fewer words than a shingle: one shingle of all."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the blanks 0x20, 0x09-0x0D
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle_words:
        return xxhash.xxh64_intdigest(line, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    first, last = (ends - size)[: len(words) - shingle_words + 1], ends[shingle_words - 1:]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(first), _CHUNK):
        hashes = b"".join([digest(line[i:j], 42) for i, j in
                           zip(first[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist())])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle_words: int = 4) -> DataFrame:
    """(doc_id, text_key, fp): fp holds the 64 bits as a signed long."""

    def make():
        def work(rows):
            fps = np.array([fingerprint(t, shingle_words) for t in rows["text"]], np.uint64).view(np.int64)
            return {"doc_id": rows["doc_id"], "text_key": rows["text_key"], "fp": fps}
        return work

    return map_rows(documents.select("doc_id", "text", text_key(F.col("text")).alias("text_key")),
                    "doc_id long, text_key long, fp long", make)


def windows(max_distance: int, count: int = 3) -> list[int]:
    """Bit masks that split 64 bits into ``count`` runs of nearly equal width."""
    cuts = [64 * k // count for k in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _distance(fps: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((fps ^ np.uint64(vantage)) & np.uint64(mask))


def plan_tree(sample: np.ndarray, mask: int, depth: int, seed: int) -> tuple[list[int], list[np.ndarray]]:
    """Vantage points, one a level, and each node's splitting distance (the sample's median there).

    A node that no sampled fingerprint reaches splits at half the window's width.
    """
    rng, cell = np.random.default_rng(seed), np.zeros(len(sample), np.int64)
    vantages, cuts = [], []
    for level in range(depth):
        vantage = int(rng.integers(0, 1 << 63, dtype=np.uint64)) * 2 + int(rng.integers(0, 2))
        d = _distance(sample, vantage, mask)
        cut = np.full(1 << level, mask.bit_count() // 2, np.int16)
        order = np.argsort(cell, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else []
        for part in parts:
            cut[cell[part[0]]] = int(np.median(d[part]))
        vantages.append(vantage)
        cuts.append(cut)
        cell = 2 * cell + (d > cut[cell])
    return vantages, cuts


def shards_of(fps: np.ndarray, mask: int, radius: int, vantages: list[int],
              cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Index and shard of every fingerprint in every shard that its ball may reach (see step 3)."""
    index, cell = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    for vantage, cut in zip(vantages, cuts):
        d = _distance(fps[index], vantage, mask).astype(np.int16)
        at = cut[cell]
        far, near_edge = d > at, (d <= at) & (d > at - radius)
        index = np.concatenate([index, index[near_edge]])
        cell = np.concatenate([2 * cell + far, 2 * cell[near_edge] + 1])
    return index, cell


def _spanning(fps: np.ndarray, limit: int) -> list[np.ndarray]:
    """Edges of a spanning forest of the links, by breadth-first search against what is not yet reached.

    A dense group is reached in a few steps, so the work is near the group's
    size, not its square; blocks keep the memory at some tens of megabytes.
    """
    left, found = np.arange(len(fps)), []
    while len(left) > 1:
        queue, left = left[:1], left[1:]
        while len(queue) and len(left):
            now, queue = queue[:64], queue[64:]
            rest = []
            for at in range(0, len(left), _CHUNK):
                part = left[at:at + _CHUNK]
                near = np.bitwise_count(fps[part][:, None] ^ fps[now][None, :]) <= limit
                hit = near.any(axis=1)
                if hit.any():
                    found.append(np.stack([now[near[hit].argmax(axis=1)], part[hit]]))
                    queue = np.concatenate([queue, part[hit]])
                rest.append(part[~hit])
            left = np.concatenate(rest)
    return found


def links(fps: np.ndarray, mask: int, radius: int, limit: int) -> np.ndarray:
    """Spanning links (2 x n fingerprints) among distinct fingerprints of one shard, by a tree inside it."""
    found, stack, rng = [], [np.arange(len(fps))], np.random.default_rng(_SEED)
    while stack:
        own = stack.pop()
        if len(own) < 2:
            continue
        some = fps[own]
        if len(own) > _LEAF:
            d = _distance(some, int(some[rng.integers(len(own))]), mask).astype(np.int16)
            cut = int(np.median(d))
            low, high = own[d <= cut], own[d > cut - radius]
            if max(len(low), len(high)) <= 0.9 * len(own):
                stack += [low, high]
                continue
            # the window does not part these (one dense group): search it without listing its pairs
            found += [own[e] for e in _spanning(some, limit)]
            continue
        near = np.triu(np.bitwise_count(some[:, None] ^ some[None, :]) <= limit, 1)
        if near.any():
            pairs = np.stack(np.nonzero(near))
            found += [own[pairs]] if pairs.shape[1] <= len(own) else [own[e] for e in _spanning(some, limit)]
    return fps[np.concatenate(found, axis=1)] if found else np.zeros((2, 0), np.uint64)


def near_links(classes: DataFrame, max_distance: int = 4, shard_rows: int = 32768,
               sample_rows: int = 20000, max_depth: int = 16) -> DataFrame:
    """(a, b): links that join all distinct fingerprints ``fp`` within ``max_distance`` bits as a forest per shard.

    The sample that sets the splitting distances has at most ``sample_rows``
    fingerprints; every fingerprint is placed and compared.
    """
    spark = classes.sparkSession
    masks, total = windows(max_distance), classes.count()
    radius = max_distance // len(masks)
    depth = min(max_depth, max(0, math.ceil(math.log2(max(1, total) / shard_rows))))
    sample = np.array([r["fp"] for r in classes.select("fp").orderBy(F.xxhash64("fp")).limit(sample_rows).collect()],
                      np.int64).view(np.uint64) if depth else np.zeros(0, np.uint64)
    trees = [plan_tree(sample, mask, depth, _SEED + k) for k, mask in enumerate(masks)]
    known = spark.sparkContext.broadcast(trees)  # 2 bytes a node, at most 2 ** max_depth nodes a window
    out = pa.schema([("shard", pa.int64()), ("fp", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k, (mask, (vantages, cuts)) in enumerate(zip(masks, known.value)):
                index, cell = shards_of(fps, mask, radius, vantages, cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell * len(masks) + k), pa.array(fps[index].view(np.int64))], schema=out)

    def search(shard: pa.Table) -> pa.Table:
        fps = np.unique(shard["fp"].to_numpy().astype(np.int64).view(np.uint64))
        mask = masks[int(shard["shard"][0].as_py()) % len(masks)]
        found = links(fps, mask, radius, max_distance)
        return pa.table({"a": pa.array(found[0].view(np.int64)), "b": pa.array(found[1].view(np.int64))})

    return (map_arrow(classes.select("fp"), place, "shard long, fp long")
            .groupBy("shard").applyInArrow(search, "a long, b long"))


def near_duplicates(documents: DataFrame, shingle_words: int = 4, max_distance: int = 4) -> DataFrame:
    """(doc_id, text_key, fp, component_id, component_fp), one row for each row of ``documents``.

    ``component_id`` is the smallest doc_id that links of at most
    ``max_distance`` bits reach, ``component_fp`` the group's least fingerprint.
    Null or blank texts have fingerprint 0 and link like any other.  Rows
    without a doc_id keep their place in a group but never name it; a group
    with no id at all has a null component_id.  Repeated rows stay repeated.
    """
    docs = stored(fingerprints(documents, shingle_words), "fingerprints")
    classes = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("rows")), "classes")
    member = stored(components(near_links(classes, max_distance)), "members").withColumnRenamed("node", "fp")
    grouped = member.join(classes, "fp")
    ids = grouped.groupBy("root").agg(F.min("least_id").alias("group_id"))
    named = member.join(ids, "root")
    of_class = classes.join(named, "fp", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("group_id")).alias("component_id"),
        F.coalesce("root", "fp").alias("component_fp"), "rows")
    # a much-copied text is one class: those with more than 1/HOT of all rows are fewer than HOT, and go to every task
    total = docs.count()
    of_class = stored(of_class.withColumn("hot", F.col("rows") * HOT > F.lit(total)).drop("rows"), "groups")
    hot = F.broadcast(of_class.where("hot").drop("hot"))
    cold = docs.join(hot.select("fp"), "fp", "left_anti").join(of_class.where("NOT hot").drop("hot"), "fp")
    columns = ["doc_id", "text_key", "fp", "component_id", "component_fp"]
    return docs.join(hot, "fp").select(*columns).unionByName(cold.select(*columns))


def keep_one(documents: DataFrame, shingle_words: int = 4, max_distance: int = 4) -> DataFrame:
    """``documents`` with one row of each group: the one named by component_id.

    If that id is repeated in the group (or null), the first row by text,
    language, source and length stays.
    """
    columns = documents.columns
    own, id_, key, group, n = fresh(columns, "_own", "_id", "_key", "_group", "_n")
    found = stored(near_duplicates(documents, shingle_words, max_distance).select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("component_fp").alias(group),
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias(n)), "found")
    # rows of one id and text share a group, so ids and keys decide: texts move only if those that go are too many
    gone = found.where(f"NOT {n}").select(id_, key).distinct()
    named = found.where(n)
    tied = named.groupBy(id_, group).agg(F.count("*").alias(n)).where(F.col(n) > 1).drop(n).select(
        F.col(id_).alias("_i"), F.col(group).alias("_g"))
    tied = named.join(tied, F.col(id_).eqNullSafe(F.col("_i")) & (F.col(group) == F.col("_g")), "left_semi")
    gone, tied = (broadcast_if_small(stored(df, name)) for df, name in (
        (gone, "gone"), (tied.select(id_, key, group).distinct(), "tied")))
    rows = documents.withColumn(own, text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key))
    clear = rows.join(gone, same, "left_anti").join(tied, same, "left_anti").select(*columns)
    order = [F.col(c) for c in ("text", "lang", "source", "n_chars") if c in columns]
    first = F.row_number().over(Window.partitionBy("doc_id", group).orderBy(*order))
    return clear.unionByName(rows.join(tied, same).withColumn(n, first).where(F.col(n) == 1).select(*columns))
