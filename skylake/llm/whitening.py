"""Whitening of embedding vectors with MLlib's distributed block matrices.

Entries become whole numbers (256 steps a unit), so that equal vectors are equal exactly and means and deviations are exact. The
distinct vectors are numbered, centred and laid out as a BlockMatrix; its transpose times itself is the scatter matrix, whose
eigenvectors are found on the driver (d x d numbers, d the dimension). A second product, of the centred rows with the whitening
matrix, projects every row. Products are dealt by blocks of ROWS_PER_BLOCK rows; the middle dimension of the scatter product is
split, so no task meets more than BLOCKS_PER_TASK blocks of either side. Equal vectors, however many, are rows of their own there and
one row in the fit, where partial aggregation merges them before the shuffle.

Over PANEL rows there are several matrices: their scatters are added and their projections put together. The driver holds d x d matrices, d sums, a
number for each write task and the places of one panel's blocks.

Cases: rows whose vector is null or holds null or non-finite entries are left out. Shorter vectors are filled up with zeros to the
longest. Components without variance (eigenvalue below TINY of the greatest) cannot be whitened and are not returned; so a table of equal vectors, of
empty vectors or without rows gives no rows. Entries of 2^45 or more, and deviations beyond a bigint, are errors. Equal rows each come out.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylake.session import settle

STEPS = 256
COMPONENTS = 4
ROWS_PER_BLOCK, COLS_PER_BLOCK = 1024, 1024
BLOCKS_PER_TASK = 8
PANEL = 1 << 29  # rows of one BlockMatrix; MLlib counts rows of a product with 32 bits
TINY = 1e-12
_LARGEST = float(1 << 45)
_PLACE_BITS = 33  # of `monotonically_increasing_id`: the row's place in its task


def whole(vector: Column) -> Column:
    """Entries as whole numbers of steps, rounded down."""
    def entry(c: Column) -> Column:
        fits = F.abs(c.cast("double")) < _LARGEST
        return F.when(fits, F.floor(c.cast("double") * STEPS)).otherwise(F.raise_error(F.lit("an entry is too large")).cast("bigint"))

    return F.transform(vector, entry)


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


class Numbered(NamedTuple):
    """`table` with the place of each row as `index`, 0, 1, 2 and on without gaps; `n` rows. `panels`: (first index, rows, lowest and
    highest `__at`) of runs of whole files, of PANEL rows and the last file's each; a filter on `__at` skips the other files."""

    table: DataFrame
    n: int
    panels: list[tuple[int, int, int, int]]

    def panel(self, at: int) -> DataFrame:
        first, _, low, high = self.panels[at]
        return self.table.where(F.col("__at").between(low, high)).withColumn("index", F.col("index") - first)


def numbered(df: DataFrame, label: str) -> Numbered:
    """Write `df` once and number its rows: a row's place is that in its write task plus the rows of the tasks before, of which
    the driver holds one count each."""
    table = settle(df.withColumn("__at", F.monotonically_increasing_id()), label)
    task = F.shiftright("__at", _PLACE_BITS)
    counts = table.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("rows")).orderBy("task").collect()
    before, panels, n = [], [], 0
    for c in counts:
        before.append((c.task, n))
        low, high = c.task << _PLACE_BITS, (c.task + 1 << _PLACE_BITS) - 1
        if panels and panels[-1][1] < PANEL:
            first, held, low, _ = panels.pop()
            panels.append((first, held + c.rows, low, high))
        else:
            panels.append((n, c.rows, low, high))
        n += c.rows
    offsets = F.broadcast(df.sparkSession.createDataFrame(before, "__task bigint, __before bigint"))
    place = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1).cast("bigint"))
    placed = table.join(offsets, F.col("__task") == task).withColumn("index", F.col("__before") + place).drop("__task", "__before")
    return Numbered(placed, n, panels)


def blocks(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """(index, array of doubles) as a matrix of n rows in distributed blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(ROWS_PER_BLOCK, min(width, COLS_PER_BLOCK))


def matrices(rows: Numbered, values: Column, width: int) -> list[tuple[int, int, BlockMatrix]]:
    """(first index, rows, matrix) of each panel."""
    return [(first, n, blocks(rows.panel(i).select("index", values.alias("values")), n, width)) for i, (first, n, _, _) in enumerate(rows.panels)]


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """left x right, the blocks along the inner dimension dealt to `splits` groups of tasks and their products added."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(panels: list[tuple[int, int, BlockMatrix]]) -> np.ndarray:
    """Transpose times itself, the panels added, as a local matrix."""
    def one(n: int, matrix: BlockMatrix) -> np.ndarray:
        splits = max(1, -(-n // (ROWS_PER_BLOCK * BLOCKS_PER_TASK)))
        return product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()

    return sum(one(n, matrix) for _, n, matrix in panels)


def project(spark: SparkSession, panels: list[tuple[int, int, BlockMatrix]], by: np.ndarray) -> DataFrame:
    """(index, values) of the rows of matrix x by."""
    d, k = by.shape
    step = panels[0][2].colsPerBlock
    parts = [((i // step, 0), Matrices.dense(len(by[i:i + step]), k, by[i:i + step].ravel(order="F"))) for i in range(0, d, step)]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), step, k, d, k)
    out = []
    for first, _, matrix in panels:
        rows = callMLlibFunc("getIndexedRows", product(matrix, right).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        out.append(rows.select((F.col("index") + first).alias("index"), vector_to_array("vector").alias("values")))
    return reduce(DataFrame.union, out)


class Fit(NamedTuple):
    """n distinct vectors, the exact sums of their entries, the whitening matrix (a column per component) and the share of the variance
    each component explains; `error` is the largest difference of the whitened vectors' covariance from the identity."""

    n: int
    sums: list[int]
    matrix: np.ndarray
    explained: list[float]
    error: float


def _array(values: list) -> Column:
    return F.array(*(F.lit(v) for v in values))


def centred(x: Column, sums: list[int], n: int) -> Column:
    return F.zip_with(x, _array([s / n for s in sums]), lambda a, m: a.cast("double") - m)


def fit(rows: DataFrame, width: int, components: int = COMPONENTS) -> Fit | None:
    """Whitening of the distinct vectors `x`, all `width` long; None if nothing varies."""
    spark = rows.sparkSession
    distinct = numbered(rows.select("x").distinct(), "vectors")
    n = distinct.n
    found = distinct.table.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("s")).collect()  # a row per dimension
    sums = [r.s for r in sorted(found, key=lambda r: r.at)]
    if not sums:
        return None
    panels = matrices(distinct, centred(F.col("x"), sums, n), width)
    cov = scatter(panels) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:components] > max(values[0], 0.0) * TINY).sum())
    if not k:
        return None
    by = vectors[:, :k] / np.sqrt(values[:k])
    white = numbered(project(spark, panels, by).select("values"), "whitened")
    means = white.table.select(F.posexplode("values").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m")).collect()
    middle = _array([r.m for r in sorted(means, key=lambda r: r.at)])
    error = float(np.abs(scatter(matrices(white, F.zip_with("values", middle, lambda a, m: a - m), k)) / n - np.eye(k)).max())
    return Fit(n, sums, by, [float(v) for v in values[:k] / np.trace(cov)], error)


OUTPUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row of `df` and component: the id as `__id`, and the columns of OUTPUT."""
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`")
    x = df.where(usable(vector)).select(F.col(f"`{id_col}`").alias("__id"), whole(vector).alias("x"))
    rows = numbered(x, "rows")
    least, width = rows.table.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != width:
        rows = rows._replace(table=rows.table.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x")))))
    done = fit(rows.table, width, components) if width else None
    if done is None:
        return df.select(F.col(f"`{id_col}`").alias("__id"), *(F.lit(None).cast(t).alias(c) for c, t in (p.split() for p in OUTPUT.split(", ")))).limit(0)
    panels = matrices(rows, centred(F.col("x"), done.sums, done.n), width)
    away = F.zip_with("x", _array(done.sums), lambda a, s: (a * done.n - s) * (a * done.n - s))
    known = rows.table.select("index", "__id", F.aggregate(away, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("deviation"))
    both = known.join(project(spark, panels, done.matrix), "index").select("__id", "deviation", F.posexplode("values").alias("at", "whitened"))
    return both.select(
        "__id", (F.col("at") + 1).alias("component"), F.lit(done.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(_array(done.explained), F.col("at") + 1).alias("explained"), F.lit(done.error).alias("identity_error"))


def op11_whitening(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings).withColumnRenamed("__id", "vec_id")
