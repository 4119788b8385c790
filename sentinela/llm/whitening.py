"""Whitening of embeddings with block matrices."""

from __future__ import annotations

import numpy as np
from pyspark.mllib.linalg import DenseMatrix, DenseVector
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRow, IndexedRowMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.common import kept

BLOCK_ROWS = 1024
SCALE = 256
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def finite(vector: Column) -> Column:
    """The vector is there and all of its components are finite."""
    inside = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(inside, F.lit(False))


def gram(rows: BlockMatrix, cuts: int) -> np.ndarray:
    """The transposed matrix times the matrix.

    The product is a single block, and by default all work for a block meets in one task. Cutting
    the common dimension gives each cut a task of its own, whose sums are added. The Python
    wrapper's ``multiply`` lacks that argument of the JVM method.
    """
    turned = rows.transpose()
    product = turned._java_matrix_wrapper.call("multiply", rows._java_matrix_wrapper._java_model, cuts)
    return BlockMatrix(product, turned.rowsPerBlock, rows.colsPerBlock).toLocalMatrix().toArray()


def whitened(vectors: DataFrame, components: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries become integers floor(256 * c); the distinct integer vectors are the fit list. Its centred
    rows, indexed, form a block matrix; the transposed product gives the scatter matrix, whose
    eigenvectors come from a local solver (dimension squared, whatever the number of rows); the block
    matrix times the whitening matrix projects the rows.

    Nulls: vectors that are null, empty or hold a null or non-finite entry are dropped; a null vec_id
    stays. Repeated vectors count once in the fit and come out each. A component without variance
    (fewer distinct vectors than components) has a null ``whitened`` and is left out of
    ``identity_error``; with a single distinct vector ``explained`` is null too. Vectors of different
    lengths have no covariance and raise ValueError. Empty tables give no rows; a deviation beyond 64
    bits is null; columns other than vec_id and embedding are not read.
    """
    spark = vectors.sparkSession
    entries = F.transform("embedding", lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    rows = vectors.where(finite(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("x"))
    distinct = kept(rows.groupBy("x").agg(F.count("*")).select("x"), "fit")
    shortest, dimension, n = distinct.select(F.min(F.size("x")), F.max(F.size("x")), F.count("*")).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    if shortest != dimension:
        raise ValueError(f"vectors of {shortest} to {dimension} entries cannot be whitened together")
    exact = distinct.select(*[F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")) for i in range(dimension)]).first()
    sums = [int(total) for total in exact]
    mean = np.array([total / n for total in sums])

    # Rows get their numbers from a written table, so that a task that runs again numbers them alike.
    indexed = distinct.rdd.zipWithIndex().map(lambda pair: (pair[1], pair[0]["x"]))
    numbered = kept(spark.createDataFrame(indexed, "index long, x array<bigint>"), "numbered")
    centred = IndexedRowMatrix(
        numbered.rdd.map(lambda row: IndexedRow(row["index"], DenseVector(np.asarray(row["x"], dtype=float) - mean))), n, dimension
    ).toBlockMatrix(block_rows, dimension)
    cuts = max(1, min(-(-n // block_rows), 4 * spark.sparkContext.defaultParallelism))
    values, directions = np.linalg.eigh(gram(centred, cuts) / n)
    order = np.argsort(-values, kind="stable")[: min(components, dimension)]
    trace = float(values.sum())
    # What rounding leaves of a variance of zero does not count.
    real = values[order] > max(trace, 0.0) * 1e-13 * dimension
    directions = directions[:, order] * np.where(real, 1 / np.sqrt(np.where(real, values[order], 1.0)), 0.0)
    columns = len(order)
    matrix = DenseMatrix(dimension, columns, directions.ravel(order="F"))
    whitening = BlockMatrix(spark.sparkContext.parallelize([((0, 0), matrix)], 1), dimension, columns, dimension, columns)
    projected = centred.multiply(whitening).toIndexedRowMatrix().rows
    projected = projected.map(lambda row: (row.index, [float(value) for value in row.vector.toArray()]))
    points = kept(spark.createDataFrame(projected, "index long, z array<double>"), "projected")

    means = points.select(*[F.avg(F.get("z", F.lit(i))) for i in range(columns)]).first()
    off = [F.get("z", F.lit(i)) - F.lit(float(means[i])) for i in range(columns)]
    products = points.select(*[F.avg(off[i] * off[j]) for i in range(columns) for j in range(columns)]).first()
    covariance = np.array(products, dtype=float).reshape(columns, columns)[np.ix_(real, real)]
    error = float(np.abs(covariance - np.eye(len(covariance))).max()) if real.any() else None

    totals = F.array(*[F.lit(total) for total in sums])
    gaps = F.zip_with("x", totals, lambda x, total: (F.lit(n) * x - total).cast("decimal(19,0)"))
    squares = F.aggregate(gaps, F.lit(0).cast("decimal(38,0)"), lambda sum, gap: (sum + gap * gap).cast("decimal(38,0)"))
    parts = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("component"),
                (F.get("z", F.lit(i)) if real[i] else F.lit(None).cast("double")).alias("whitened"),
                F.lit(float(values[order[i]]) / trace if trace > 0 else None).cast("double").alias("explained"),
            )
            for i in range(columns)
        ]
    )
    placed = numbered.join(points, "index").select("x", "z", squares.try_cast("long").alias("deviation"))
    return (
        rows.join(placed, "x")
        .select("vec_id", "deviation", F.explode(parts).alias("part"))
        .select(
            "vec_id", "part.component", F.lit(n).cast("long").alias("n"), "deviation", "part.whitened", "part.explained",
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
