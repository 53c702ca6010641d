"""Embedding whitening with Spark MLlib's BlockMatrix.

1. Vectors become exact integers, floor(scale * entry) + shift, and every row
   gets a dense index.
2. The fit list is each distinct vector once, with an index of its own.  Its
   sums are exact integers, so rows are centred without cancellation before
   anything is multiplied.
3. Centred rows are gathered to blocks by index and written as matrices; the
   stored blocks are the BlockMatrix.  (IndexedRowMatrix.toBlockMatrix would
   serialize each entry as an object of its own.)
4. The fit list's blocks are transposed and multiplied by themselves; the
   products of its blocks are summed in many tasks (``numMidDimSplits``), so
   that no task sees all rows.
5. The scatter matrix (dimension by dimension) is taken apart on the driver by
   numpy's eigh.
6. The blocks of all rows are multiplied by the whitening matrix.
7. The whitened fit list is centred and multiplied in the same way, which
   measures how far its covariance is from the identity.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from salesmart.llm.common import stored
from salesmart.session import scratch_path

#: Rows of a block: so many that the driver, which plans the products, sees some 20,000 block numbers, within these.
_BLOCK_ROWS = (1024, 65536)
#: A block with its place, as MLlib's matrix and as the plain struct that it is stored as.
_PLACE = StructType([StructField(n, LongType(), False) for n in ("row", "column")])
_AS_MATRIX = StructType([StructField("place", _PLACE, False), StructField("matrix", MatrixUDT(), False)])
_AS_STRUCT = StructType([StructField("place", _PLACE, False), StructField("matrix", MatrixUDT().sqlType(), False)])
#: Eigenvalues below this share of the largest are rounding noise of a singular covariance.
_RANK = 1e-11
#: Sums of integers are kept in two halves, so that they stay inside a long.
_HALF = 20

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


class Fit(NamedTuple):
    """The fit list's size and exact sums, its leading components, and their matrix."""
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the covariance, falling
    matrix: np.ndarray  # dimension x components: unit eigenvectors over the roots of their values
    trace: float


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows with a dense ``index`` from 0, written to the shared folder: the place within the writing task, after
    the rows of the tasks before it."""
    written = stored(rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), name)
    counts = written.groupBy("part").agg(F.count("*").alias("n")).collect()  # a row for each writing task
    start, offsets = 0, []
    for r in sorted(counts):
        offsets.append((r["part"], start - (r["part"] << 33)))
        start += r["n"]
    known = rows.sparkSession.createDataFrame(offsets, "part int, offset long")
    return (written.join(F.broadcast(known), "part").withColumn("index", F.col("at") + F.col("offset"))
            .drop("part", "at", "offset"))


def integer_vectors(embeddings: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(index, vec_id, x): the usable rows as integer vectors with a dense index from 0.

    Left out are rows whose vector is null, has a null, NaN or infinite entry,
    or an entry beyond 2 ** 52 after scaling (it has no exact integer), and rows
    whose length is not the commonest one (ties: the longer).
    """
    entry = F.col("embedding")
    good = entry.isNotNull() & F.forall(entry, lambda e: F.coalesce(
        ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) * scale < float(1 << 52)), F.lit(False)))
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(good)
            .select("vec_id", F.transform(entry, lambda e: F.floor(e.cast("double") * scale) + shift).alias("x")))
    found = numbered(rows, "vectors")
    lengths = {r["d"]: r["n"] for r in found.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()}
    if len(lengths) > 1:  # the rest is numbered anew, without gaps
        dimension = max(lengths, key=lambda d: (lengths[d], d))
        found = numbered(found.where(F.size("x") == dimension).drop("index"), "vectors")
    return found


def _sums(fit_list: DataFrame) -> tuple[int, list[int]]:
    rows = (fit_list.select(F.posexplode("x").alias("d", "v")).groupBy("d")
            .agg(F.count("*").alias("n"), F.sum(F.shiftright("v", _HALF)).alias("high"),
                 F.sum(F.col("v").bitwiseAND((1 << _HALF) - 1)).alias("low")).collect())  # a row for each dimension
    found = {r["d"]: (r["n"], (int(r["high"]) << _HALF) + int(r["low"])) for r in rows}
    return (found[0][0], [found[d][1] for d in range(len(found))]) if found else (0, [])


def _centre(n: int, sums: list[int]) -> tuple[Column, Column]:
    """Whole and remaining parts of the mean: sums = n * whole + rest, with 0 <= rest < n."""
    return (F.array(*[F.lit(s // n).cast("long") for s in sums]), F.array(*[F.lit(s % n).cast("long") for s in sums]))


def _centred(n: int, sums: list[int]) -> Column:
    """x - S / n, as doubles without cancellation."""
    whole, rest = _centre(n, sums)
    moved = F.zip_with("x", whole, lambda v, m: (v - m).cast("double"))
    return F.zip_with(moved, rest, lambda v, r: v - r.cast("double") / float(n))


def _deviation(n: int, sums: list[int]) -> Column:
    """The exact sum over dimensions of (n * x - S) ** 2; null if it is beyond a long."""
    whole, rest = _centre(n, sums)
    terms = F.zip_with(F.zip_with("x", whole, lambda v, m: F.try_multiply(v - m, F.lit(n))), rest, F.try_subtract)
    return F.aggregate(terms, F.lit(0).cast("long"), lambda total, t: F.try_add(total, F.try_multiply(t, t)))


def _create(stored_blocks: DataFrame, block_rows: int, count: int, columns: int) -> BlockMatrix:
    java = callMLlibFunc("createBlockMatrix", stored_blocks, block_rows, columns, count, columns)
    return BlockMatrix(java, block_rows, columns)


def _blocks(rows: DataFrame, count: int, columns: int) -> BlockMatrix:
    """Rows (dense index, vector as array of doubles) as distributed blocks, written to the shared folder."""
    low, high = _BLOCK_ROWS
    size = max(low, min(high, count // 20_000))
    own = F.sort_array(F.collect_list(F.struct("index", "vector")))  # of at most ``size`` rows
    blocks = rows.groupBy(F.expr(f"index div {size}").alias("row")).agg(own.alias("rows"))
    matrix = F.struct(
        F.lit(1).cast("byte").alias("type"), F.size("rows").alias("numRows"), F.lit(columns).alias("numCols"),
        F.lit(None).cast("array<int>").alias("colPtrs"), F.lit(None).cast("array<int>").alias("rowIndices"),
        F.flatten(F.transform("rows", lambda r: r["vector"])).alias("values"), F.lit(True).alias("isTransposed"))
    spark, path = rows.sparkSession, f"{scratch_path(rows.sparkSession, 'llm')}/blocks-{uuid.uuid4().hex}"
    blocks.select(F.struct("row", F.lit(0).cast("long").alias("column")).alias("place"),
                  matrix.alias("matrix")).write.parquet(path)
    return _create(spark.read.schema(_AS_MATRIX).parquet(path), size, count, columns)


def _scatter(rows: DataFrame, count: int, columns: int) -> np.ndarray:
    """Transpose times matrix of centred rows, summed over many tasks."""
    blocks = _blocks(rows, count, columns)
    splits = max(1, min(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-count // blocks.rowsPerBlock)))
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    total = BlockMatrix(product, columns, columns).toLocalMatrix().toArray()
    return (total + total.T) / 2


def _times(rows: DataFrame, count: int, matrix: np.ndarray) -> DataFrame:
    """(index, vector): the rows times a small matrix, by blocks, written to the shared folder."""
    spark, (columns, width) = rows.sparkSession, matrix.shape
    small = BlockMatrix(spark.sparkContext.parallelize(
        [((0, 0), Matrices.dense(columns, width, matrix.flatten(order="F").tolist()))], 1), columns, width)
    blocks = _blocks(rows, count, columns)
    product = callMLlibFunc("getMatrixBlocks", blocks.multiply(small)._java_matrix_wrapper._java_model)
    path = f"{scratch_path(spark, 'llm')}/whitened-{uuid.uuid4().hex}"
    product.select(F.struct(F.col("_1._1").cast("long").alias("row"), F.col("_1._2").cast("long").alias("column"))
                   .alias("place"), F.col("_2").alias("matrix")).write.parquet(path)
    at = F.col("matrix.numRows")
    rows_of = F.transform(F.sequence(F.lit(0), at - 1), lambda r: F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda c: F.get("matrix.values", F.when(
            F.col("matrix.isTransposed"), r * width + c).otherwise(c * at + r))))
    return (spark.read.schema(_AS_STRUCT).parquet(path).select("place", F.posexplode(rows_of).alias("at", "vector"))
            .select((F.col("place").getField("row") * blocks.rowsPerBlock + F.col("at")).alias("index"), "vector"))


def fit(fit_list: DataFrame, components: int = 16) -> Fit | None:
    """Components of the distinct integer vectors (dense index, x); None if there is no row or no variance.

    The number of components may be less than asked if the covariance has a
    lower rank.  Of either sign of a component, the one whose largest entry is
    positive is taken.
    """
    n, sums = _sums(fit_list)
    if not n:
        return None
    covariance = _scatter(fit_list.select("index", _centred(n, sums).alias("vector")), n, len(sums)) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > _RANK * max(values[0], 0)).sum()) if values[0] > 0 else 0
    if not rank:
        return None
    width = min(components, rank)
    chosen = vectors[:, :width]
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(width)])
    return Fit(n, sums, values[:width], chosen / np.sqrt(values[:width]), float(np.trace(covariance)))


def identity_error(whitened: DataFrame, n: int, width: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list (dense index, vector) minus the identity."""
    means = whitened.agg(*[F.avg(F.col("vector")[k]).alias(f"m{k}") for k in range(width)]).first()
    centred = F.zip_with("vector", F.array(*[F.lit(float(m)) for m in means]), lambda v, m: v - m)
    found = _scatter(whitened.select("index", centred.alias("vector")), n, width) / n
    return float(np.abs(found - np.eye(width)).max())


def whitened_rows(embeddings: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row for each usable row of ``embeddings`` and component (see ``SCHEMA``).

    ``n`` is the size of the fit list, ``deviation`` the exact sum of
    (n * x - S) ** 2 (null if beyond a long), ``explained`` the component's
    share of the covariance's trace.  Rows are left out as ``integer_vectors``
    says; equal vectors have equal results, repeated rows stay repeated and a
    null vec_id stays null.  An empty table, one usable vector, or vectors
    without variance or entries give no rows.  Other columns are not read.
    The driver holds one matrix of the dimension squared.
    """
    spark: SparkSession = embeddings.sparkSession
    rows = integer_vectors(embeddings, scale, shift)
    fit_list = numbered(rows.groupBy("x").agg(F.min("index").alias("row")), "fit")
    found = fit(fit_list, components)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    count, width = rows.count(), len(found.values)
    white = _times(rows.select("index", _centred(found.n, found.sums).alias("vector")), count, found.matrix)
    firsts = white.join(fit_list.select(F.col("row").alias("index")), "index", "left_semi")
    error = identity_error(numbered(firsts.select("vector"), "first"), found.n, width)
    shares = F.array(*[F.lit(float(v / found.trace)) for v in found.values])
    own = rows.select("index", "vec_id", _deviation(found.n, found.sums).alias("deviation"))
    return (own.join(white, "index")
            .select("vec_id", "deviation", F.posexplode("vector").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation",
                    "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))
