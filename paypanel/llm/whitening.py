"""Whitening of embeddings with distributed block matrices of Spark MLlib.

Entries become whole numbers on a grid of 1/1024. Their number and sums are counted exactly; rows are
centred in whole numbers (n * x - S, divided by n only at the end), numbered without gaps and cut into blocks of
``BLOCK_ROWS`` rows. The blocks' transpose times the blocks is the scatter matrix; its eigenvectors are found on the
driver, whose share is dimensions squared and no more; and the blocks times the whitening matrix are the whitened rows, which go back
to their ids by row number.

Scale: the product of transpose and blocks has a single block as its result, so the multiplication is split along the rows:
a task gets ``TOGETHER`` row blocks, and only the small partial products meet. MLlib pairs the blocks of a
product on the driver, in the square of their number, so rows are taken in panels of ``PANEL_BLOCKS`` blocks whose
scatter matrices are added. The driver gets the rows of each partition as a number, one sum a dimension, and the
scatter matrix. No key is involved, so equal vectors and hot sources do not matter; blocks have equal sizes.

Defined results: rows without a vector, or with a null, NaN or infinite entry, are left out. All others count, repeated
ones as often as they stand. Vectors have one length; where a table mixes lengths, only the vectors of the most frequent one (of
ties the largest) are taken. Components without variance have no whitened value and are left out, so a single
vector or a table of equal ones has no rows, nor has an empty table. Of equal eigenvalues any orthogonal vectors serve. The sign makes the
largest entry of each component positive. ``deviation`` is null where it does not fit into 64 bits;
``deviation_exact`` holds it always. Only the id and the vector are read, whatever other columns are named.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paypanel.llm.tables import hinted
from paypanel.plans.stages import discard, written

GRID, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS = 4096
BLOCK_COLS = 1024
PANEL_BLOCKS = 4096
TOGETHER = 2
#: Eigenvalues below this share of the largest are rounding.
NO_VARIANCE = 1e-12
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def gridded(rows: DataFrame, vector_col: str) -> Column:
    """The vector on the grid, or null where the row is to be left out."""
    finite = F.forall(vector_col, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.when(finite, F.transform(vector_col, lambda c: F.floor(GRID * c.cast("double")).cast("long") + SHIFT))


def numbered(layer: DataFrame) -> DataFrame:
    """Rows of a written layer with their ``place`` turned into a number from 0 on, without gaps."""
    part = F.shiftright("place", 33)
    counts = sorted(layer.groupBy(part.alias("part")).count().collect())
    starts = [0, *accumulate(r["count"] for r in counts)]
    table = layer.sparkSession.createDataFrame([(r["part"], s) for r, s in zip(counts, starts)], "part long, start long")
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return layer.withColumn("part", part).join(hinted(table, 16), "part").withColumn("index", F.col("start") + within)


def block_matrix(rows: DataFrame, n: int, d: int, block_rows: int, block_cols: int) -> BlockMatrix:
    """Rows (index, vector as an array) as distributed blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("vector").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(block_rows, block_cols)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times blocks; the rows' dimension is split over tasks."""
    splits = max(1, -(-blocks.numRowBlocks // TOGETHER))
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def projected(spark: SparkSession, blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """(index, vector as an array): the blocks times a small matrix."""
    d, k = matrix.shape
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(matrix.tolist())], "index long, vector array<double>")
    product = blocks.multiply(block_matrix(rows, d, k, blocks.colsPerBlock, k))
    out = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return out.select("index", vector_to_array("vector").alias("vector"))


def components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues that have variance, falling, and their unit eigenvectors as columns."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    kept = values > max(NO_VARIANCE * values[0], 0.0) if values.size else np.zeros(0, bool)
    values, vectors = values[kept], vectors[:, kept]
    if values.size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(values.size)] < 0, -1.0, 1.0)
    return values, vectors


def identity_error(rows: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of the arrays ``w`` minus the identity."""
    means = rows.agg(*[F.avg(F.col("w")[i]) for i in range(k)]).first()
    apart = [F.col("w")[i] - F.lit(m) for i, m in enumerate(means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.avg(apart[i] * apart[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = COMPONENTS,
    block_rows: int = BLOCK_ROWS,
    panel_blocks: int = PANEL_BLOCKS,
) -> DataFrame:
    """A row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error, deviation_exact."""
    spark = vectors.sparkSession
    x = gridded(vectors, vector_col)
    given = vectors.select(F.col(id_col).alias("id"), x.alias("x")).where(F.size("x") > 0)
    raw = written(given.withColumn("place", F.monotonically_increasing_id()), "grid")
    lengths = raw.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    if len(lengths) > 1:
        raw = written(given.where(F.size("x") == lengths[0].d).withColumn("place", F.monotonically_increasing_id()), "grid")
    n, d = (lengths[0]["count"], lengths[0].d) if lengths else (0, 0)
    sums = [r.s for r in raw.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()]

    exact = F.transform("x", lambda v, i: n * v - F.get(F.lit(sums) if sums else F.array(), i))
    wide = "decimal(38,0)"
    square = F.aggregate("apart", F.lit(0).cast(wide), lambda a, v: (a + v.cast("decimal(18,0)") * v.cast("decimal(18,0)")).cast(wide))
    centred = numbered(raw).select("id", "index", exact.alias("apart"))
    rows = written(centred.select("id", "index", square.alias("deviation"), F.transform("apart", lambda v: v / F.lit(n)).alias("vector")), "centred")

    panels, total = [], np.zeros((d, d))
    step = block_rows * panel_blocks
    for start in range(0, n, step):
        size = min(step, n - start)
        panel = rows.where(F.col("index").between(start, start + size - 1)).select((F.col("index") - start).alias("index"), "vector")
        panels.append((start, block_matrix(panel, size, d, block_rows, min(d, BLOCK_COLS))))
        total += scatter(panels[-1][1])
    covariance = total / max(n, 1)
    values, axes = components(covariance, k)
    if not values.size:
        return spark.createDataFrame([], f"id {dict(rows.dtypes)['id']}, {OUT}")
    matrix = axes / np.sqrt(values)
    parts = [projected(spark, blocks, matrix).withColumn("index", F.col("index") + start) for start, blocks in panels]
    together = reduce(DataFrame.unionByName, parts).withColumnRenamed("vector", "w")
    whitened = written(rows.select("id", "index", "deviation").join(together, "index").drop("index"), "whitened")
    discard(rows)
    error = identity_error(whitened, values.size)
    explained = F.lit((values / np.trace(covariance)).tolist())
    return whitened.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )


def report(vectors: DataFrame) -> DataFrame:
    return whiten(vectors).withColumnRenamed("id", "vec_id")
