"""Embedding whitening with MLlib's distributed block matrices.

Vectors become integer vectors x = floor(256 * c).  The fit list holds each
distinct x once; its rows, centred on the exact mean, are indexed and cut into
blocks of ``ROWS`` x ``COLS``.  The scatter matrix is the blocks' transpose
times the blocks (the products of row blocks are made apart and summed by a
shuffle); only the matrix of dimension squared comes to the driver, where eigh
gives the components.  All rows are projected by a second block
multiplication with the whitening matrix.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out, and so are vectors whose length is not the commonest one (ties:
the longer).  Rows may repeat: each is a row of the result, the fit list counts
its x once.  Fewer dimensions than asked give fewer components.  A component
without variance (eigenvalue at most 1e-12 of the trace) has null ``whitened``
and does not enter ``identity_error``; one distinct vector alone gives null
``whitened`` and ``explained``.  An empty table gives an empty result.  Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import storage

ROWS, COLS = 4096, 1024
LEAST_SHARE = 1e-12
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows whose entries are all finite."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("v is not null")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.where(finite).select("vec_id", F.transform("v", lambda c: F.floor(c * 256.0).cast("long")).alias("x"))


def _indexed(rows: DataFrame) -> DataFrame:
    """Adds ``row``, 0 to count - 1: place within the partition plus the rows of the partitions before it.

    ``rows`` must carry ``at`` = monotonically_increasing_id() as written."""
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("p")).agg(F.max("at").alias("last"))
    size = F.col("last") - F.shiftleft("p", 33) + 1
    before = sizes.select("p", F.coalesce(F.sum(size).over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)),
                                          F.lit(0)).alias("before"))  # one row a partition
    return (rows.withColumn("p", part).join(F.broadcast(before), "p")
            .withColumn("row", (F.col("at") - F.shiftleft("p", 33) + F.col("before")).cast("long")).drop("p", "before"))


def _blocks(rows: DataFrame, vector: F.Column, count: int, dims: int) -> BlockMatrix:
    """Block matrix of a (row, vector) table, built on the JVM."""
    ml = rows.select("row", array_to_vector(vector).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(ml, "vector"), count, dims).toBlockMatrix(ROWS, COLS)


def scatter(centred: BlockMatrix) -> np.ndarray:
    """Transpose times matrix; each block of rows is a step of its own, so no task meets them all."""
    steps = max(1, -(-centred.numRows() // ROWS))
    java = centred.transpose()._java_matrix_wrapper._java_model.multiply(centred._java_matrix_wrapper._java_model, steps)
    return BlockMatrix(java, COLS, COLS).toLocalMatrix().toArray()


def components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the k largest."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], vectors[:, order]


def _local_blocks(spark, matrix: np.ndarray) -> BlockMatrix:
    """A matrix of dimension x components as blocks that fit ``_blocks``."""
    rows = [((i // COLS, 0), Matrices.dense(*part.shape, part.ravel(order="F").tolist()))
            for i in range(0, matrix.shape[0], COLS) for part in [matrix[i:i + COLS]]]
    return BlockMatrix(spark.sparkContext.parallelize(rows, len(rows)), COLS, COLS, *matrix.shape)


def whiten(vectors: DataFrame, folder: str, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns ``RESULT``: one row per remaining row and component (1 to k); stages go below ``folder``."""
    spark = vectors.sparkSession
    typed = integer_rows(vectors, id_col, vector_col)
    length = typed.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], RESULT)
    dims = length["d"]
    rows = storage.stage(typed.where(F.size("x") == dims).withColumn("at", F.monotonically_increasing_id()), folder, "rows")
    all_rows = _indexed(rows)
    fit = _indexed(storage.stage(rows.select("x").distinct().withColumn("at", F.monotonically_increasing_id()), folder, "fit"))
    total, n = length["count"], fit.count()
    sums = [r["s"] for r in fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"))
            .orderBy("i").collect()]  # one number a dimension
    mean = F.array(*[F.lit(s / n) for s in sums])
    centred = F.zip_with("x", mean, lambda c, m: c.cast("double") - m)
    covariance = scatter(_blocks(fit, centred, n, dims)) / n
    trace = float(np.trace(covariance))
    values, axes = components(covariance, min(k, dims))
    alive = values > LEAST_SHARE * max(trace, 0.0) if trace > 0 else np.zeros(len(values), bool)
    white = axes / np.sqrt(np.where(alive, values, 1.0))

    def projected(table: DataFrame, count: int) -> DataFrame:
        product = _blocks(table, centred, count, dims).multiply(_local_blocks(spark, white))
        got = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        return got.select(F.col("index").alias("row"), vector_to_array("vector").alias("y"))

    live = [i for i in range(len(values)) if alive[i]]
    error = None
    if live:
        pairs = [(i, j) for i in live for j in live if i <= j]
        got = projected(fit, n).agg(*[F.covar_pop(F.col("y")[i], F.col("y")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(got[f"c{i}_{j}"] - (1.0 if i == j else 0.0)) for i, j in pairs)
    distance = F.aggregate(F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in sums]), lambda c, s: F.lit(n).cast("long") * c - s),
                           F.lit(0).cast("long"), lambda a, c: a + c * c)
    parts = F.array(*[F.struct(F.lit(i + 1).alias("component"),
                               (F.col("y")[i] if alive[i] else F.lit(None).cast("double")).alias("whitened"),
                               F.lit(float(values[i] / trace) if trace > 0 else None).cast("double").alias("explained"))
                      for i in range(len(values))])
    out = (all_rows.join(projected(all_rows, total), "row")
           .select("vec_id", distance.alias("deviation"), F.inline(parts)))
    result = out.select(F.col("vec_id").cast("long").alias("vec_id"), "component", F.lit(n).cast("long").alias("n"), "deviation",
                        "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))
    return storage.stage(result, folder, "whitened")
