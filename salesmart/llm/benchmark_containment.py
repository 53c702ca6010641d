"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by size: class ``c`` holds those with 2**c to
2**(c+1) - 1 distinct shingles.  An item's sketch is its minimum hashes, as
many as a class needs so that nothing is missed: if a document holds a share
``t`` of an item's ``n`` shingles, at most ``n - ceil(t * n)`` are absent, so
one of any ``n - ceil(t * n) + 1`` shingles must be present.  The sketch takes
that many for the largest size of the class.  All shingles of all documents
look the sketches up (documents too small for a class are passed over), and
every candidate is verified by exact containment of the shingles' text.  Items
shorter than a shingle are looked up by shingles of their own word count.

DataFrame functions only.  Short items inside very long documents are found
because the share is taken of the item alone; the signature-agreement form of
MinHash would estimate a Jaccard value near 0 there and miss them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import broadcast_if_small, fresh, stored, text_key

#: Items that may be broadcast with their shingles; at some 2 kB each, about 40 MB.
ITEM_ROWS = 20_000
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Lower-cased words between blanks (0x20, 0x09-0x0D); null or blank texts have none."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))


def _runs(w: Column, n: int, of) -> Column:
    """``of`` the words of each run of ``n`` words; fewer words have none."""
    return (F.when(F.size(w) < n, F.array())
            .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: of([w[i + j] for j in range(n)]))))


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def _text(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def item_shingles(w: Column, k: int, of) -> Column:
    """``of`` the words of each k-word shingle of an item; fewer words than k are one shingle."""
    out = _runs(w, k, of)
    for n in range(1, k):
        out = F.when(F.size(w) == n, F.array(of([F.get(w, F.lit(j)) for j in range(n)]))).otherwise(out)
    return out


def document_shingles(w: Column, sizes: list[int], of) -> Column:
    """``of`` the words of each shingle of a document, of each size."""
    return F.concat(*[_runs(w, n, of) for n in sizes]) if len(sizes) > 1 else _runs(w, sizes[0], of)


def _sizes(benchmark: DataFrame, k: int) -> list[int]:
    """``k`` and the word counts of the items below it: at most k numbers."""
    n = F.size(words(F.col("text")))
    return [k, *sorted(r["n"] for r in benchmark.select(n.alias("n")).where((F.col("n") > 0) & (F.col("n") < k)).distinct().collect())]


def _item_key(w: Column) -> Column:
    """What joins an item's derived rows: ids may be null or shared, and equal keys of different texts are told apart later."""
    return F.xxhash64(w)


def sketches(benchmark: DataFrame, shingle_words: int = 5, share: float = 0.8) -> DataFrame:
    """(item_key, size_class, needed, h): a row for each minimum hash of each item's sketch."""
    top = F.lit(2) * F.pow(2.0, "size_class") - 1
    return (benchmark.select(words(F.col("text")).alias("w")).where(F.size("w") > 0)
            .select(_item_key(F.col("w")).alias("item_key"), F.sort_array(F.array_distinct(item_shingles(F.col("w"), shingle_words, _hash))).alias("hashes"))
            .withColumn("n", F.size("hashes"))
            .withColumn("size_class", F.floor(F.log2(F.col("n"))).cast("int"))
            .withColumn("take", (top - F.ceil(F.lit(share) * top) + 1).cast("int"))
            .select("item_key", "size_class", F.ceil(F.lit(share) * F.col("n")).cast("int").alias("needed"),
                    F.explode(F.slice("hashes", 1, F.col("take"))).alias("h"))
            .distinct())


def contained_items(documents: DataFrame, benchmark: DataFrame, shingle_words: int = 5,
                    share: float = 0.8) -> DataFrame:
    """(doc_id, text_key, item_id, shared, n_shingles) where shared >= share * n_shingles, exactly.

    Counts are of distinct shingles.  Null and blank texts or items match
    nothing; an item without an id is found like others and has a null item_id.  Items below
    ``shingle_words`` words are one shingle, looked up among all runs of as many
    words: an item of one word is in every document with this word.  Repeated rows and items of the same
    id and text give one result; an item id with several texts gives one result
    for each text's counts.
    """
    sketch = broadcast_if_small(stored(sketches(benchmark, shingle_words, share), "sketch"))
    sizes = _sizes(benchmark, shingle_words)
    docs = documents.select("doc_id", "text")
    found = (docs.select("doc_id", text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("w"))
             .select("doc_id", "text_key", F.greatest(F.size("w") - shingle_words + 1, F.lit(1)).alias("places"),
                     F.explode(document_shingles(F.col("w"), sizes, _hash)).alias("h"))
             .join(sketch, "h").where("places >= needed")
             .groupBy("doc_id", "text_key", "item_key").agg(F.lit(1).alias("_one")).drop("_one"))
    candidates = stored(found, "candidates")
    by_doc = stored(candidates.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set("item_key").alias("item_keys")), "by_doc")  # of one document: at most the benchmark's texts
    of_doc = broadcast_if_small(by_doc)
    items = broadcast_if_small(stored(
        benchmark.select("item_id", words(F.col("text")).alias("w"))
        .select("item_id", _item_key(F.col("w")).alias("item_key"), F.array_distinct(item_shingles(F.col("w"), shingle_words, _text)).alias("item"))
        .where(F.size("item") > 0).distinct(), "items"), ITEM_ROWS)
    whole = docs.withColumn("text_key", text_key(F.col("text")))
    pairs = (whole.join(of_doc, whole["doc_id"].eqNullSafe(by_doc["_id"]) & (whole["text_key"] == by_doc["_key"]))
             .select("doc_id", "text_key", "item_keys", words(F.col("text")).alias("w"))
             .select("doc_id", "text_key", F.array_distinct(document_shingles(F.col("w"), sizes, _text)).alias("own"),
                     F.explode("item_keys").alias("item_key"))
             .join(items, "item_key"))
    return (pairs.select("doc_id", "text_key", "item_id",
                         F.size(F.array_intersect("item", "own")).cast("long").alias("shared"),
                         F.size("item").cast("long").alias("n_shingles"))
            .where(F.col("shared") >= F.ceil(F.lit(share) * F.col("n_shingles"))).distinct())


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, shingle_words: int = 5,
                        share: float = 0.8) -> DataFrame:
    """``documents`` without the rows that contain a benchmark item."""
    id_, key = fresh(documents.columns, "_id", "_key")
    bad = broadcast_if_small(stored(contained_items(documents, benchmark, shingle_words, share)
                                    .select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct(),
                                    "contaminated"))
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col(id_))
                          & (text_key(F.col("text")) == F.col(key)), "left_anti")
