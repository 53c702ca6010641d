"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import salesmart
from salesmart.session import scratch_path

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not the whole job,
    and the planner sees the table's real size.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a written table that a join may broadcast; at some 100 bytes each, about 20 MB.
BROADCAST_ROWS = 200_000


def broadcast_if_small(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A table that was just written, marked for broadcast if it has been counted and is small.

    A larger one is left to the planner, which then shuffles both sides.
    """
    return F.broadcast(written) if written.count() <= rows else written


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores before it until it clashes with no column (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_key(text: Column) -> Column:
    """With the document id, what joins derived rows back to their rows: null texts count as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut small, so that Python never holds more than ``size`` texts as objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once an application, as ``--py-files`` would.

    A package that already came as an archive is left as it is.
    """
    context, home = spark.sparkContext, Path(salesmart.__file__).parent
    if context.applicationId in _shipped or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="salesmart-")) / "salesmart_package.zip"  # the driver serves it from here
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, source.relative_to(home.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """``mapInArrow`` with a function from a slice's columns to the result's columns.

    ``make`` runs once in each task and may load models or open caches there.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for piece in slices(batches):
            yield pa.RecordBatch.from_pydict(work(piece.to_pydict()), schema=arrow)

    return map_arrow(df, run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                    max_chars: int) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """A bounded training sample of whole texts and the label counts of all learnable rows.

    The ``per_class`` ids of each class with the smallest id hash are taken from
    the labels alone; only their texts are read to the driver, of an id that
    several rows have the one with the least text hash.  Texts over ``max_chars``
    characters are left out of the sample (never out of scoring).  So the driver
    gets ``2 * per_class`` texts of ``max_chars`` at most.  Held-out rows are not used.
    """
    known = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("label = 0").orderBy(*order).limit(per_class).union(
        known.where("label = 1").orderBy(*order).limit(per_class))
    rows = [(r["doc_id"], r["label"]) for r in chosen.collect()]  # at most 2 * per_class ids
    if not rows:
        return [], counts
    spark = documents.sparkSession
    picked = spark.createDataFrame(rows, "doc_id long, label int")
    texts = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
             .join(F.broadcast(picked), "doc_id").groupBy("doc_id")
             .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")).collect())
    texts.sort(key=lambda r: (r["doc_id"], r["text"]))
    return [(r["text"], r["label"]) for r in texts], counts
