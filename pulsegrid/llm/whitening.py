"""Whitened vectors: decorrelated to unit variance along the largest principal components, with MLlib's block matrices.

Components are whole numbers, floor(scale * x). The fit list is each distinct vector once. Its rows, centred, are indexed into the
blocks of a distributed matrix C; the product of C's transpose with C is the scatter matrix, which alone comes to the driver, where
its eigenvectors are found. All rows, centred in the same way, form a second block matrix, and its product with the
eigenvectors over the roots of their eigenvalues gives the whitened rows. The covariance of the whitened fit list is measured
in the same way and held against the identity.

Sums are decimals, and centred entries are exact, as n * x - S, before they are divided by n, so no digits are lost by large means. The middle
dimension of the transposed product is split, so that a task multiplies ``TASK_BLOCKS`` blocks of either side; a block has as
many rows as keep the number of blocks, which the driver lists, at ``MOST_BLOCKS``. The driver holds a matrix of dimensions squared,
so vectors may have some thousands of dimensions. Copies of a vector are one row of the fit list, found by an aggregation that
combines them before the shuffle; rows meet their whitened values by row number, so no key is hot.

Defined cases: vectors that are NULL, hold a NULL or an entry that is not finite, or not a 64-bit number once scaled, are left out;
vectors of differing lengths are fitted each length for itself, and empty ones have no component; equal rows stay rows of their own; NULL
keys are carried; a component without variance has NULL values and is not held against the identity; the share is NULL where all vectors
are equal; a deviation outside 64 bits is NULL; an empty table gives no rows; other columns are not carried.
"""

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored
from .columns import let

SCALE = 256.0
COMPONENTS = 4
BLOCK_ROWS, BLOCK_COLUMNS = 1024, 1024
#: Blocks that the driver lists at most; beyond, blocks get more rows.
MOST_BLOCKS = 1 << 16
#: Row blocks that one task of the transposed product multiplies.
TASK_BLOCKS = 16
_PART_BITS = 33  # monotonically_increasing_id(): partition above, place in it below
_WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Whitening:
    """``matrix`` projects centred rows: eigenvectors over the roots of their eigenvalues, a column per component."""

    centre: "Centre"
    eigenvalues: np.ndarray
    trace: float
    matrix: np.ndarray
    identity_error: float | None

    @property
    def explained(self):
        return [float(e / self.trace) if self.trace > 0 else None for e in self.eigenvalues]

    @property
    def varies(self):
        return [bool(column.any()) for column in self.matrix.T]


# ---- Rows ----

def whole_vectors(df, key="vec_id", vector="embedding", scale=SCALE):
    """(key, x): the vectors that take part, as whole numbers."""
    rows = df.select(F.col(key).alias("key"), F.transform(F.col(vector), lambda v: v.cast("double") * scale).alias("v"))
    fine = F.col("v").isNotNull() & F.coalesce(F.forall("v", lambda v: v.isNotNull() & (F.abs(v) < 2.0 ** 63)), F.lit(False))
    return rows.where(fine).select("key", F.transform("v", lambda v: F.floor(v)).alias("x"))


def indexed(df, name):
    """``df`` written once, with ``idx``: 0 and up without gaps, which block matrices need."""
    rows = stored(df.withColumn("place", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("part", F.shiftright("place", _PART_BITS)).withColumn(
        "at", F.col("place").bitwiseAND(F.lit(2 ** _PART_BITS - 1)))
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "part").withColumn("idx", F.col("start") + F.col("at")).drop("part", "place", "at", "start")


@dataclass(frozen=True)
class Centre:
    """The number of fitted vectors, their sums, and the largest absolute entry among them.

    Entries of ``n * x - S`` are exact: 64-bit numbers where the largest entry leaves room, decimals of 38 digits beyond.
    """

    n: int
    sums: tuple
    most: int

    @property
    def largest_gap(self):
        return self.n * self.most + max(map(abs, self.sums), default=0)

    def gaps(self):
        """n * x - S for each entry of ``x``; NULL for one beyond 38 digits."""
        if self.largest_gap < 2 ** 63:
            return F.zip_with("x", F.array(*[F.lit(s).cast("bigint") for s in self.sums]), lambda x, s: x * F.lit(self.n).cast("bigint") - s)
        sums = F.array(*[F.lit(Decimal(s)).cast(_WHOLE) for s in self.sums])
        return F.zip_with("x", sums, lambda x, s: F.try_subtract(
            F.try_multiply(F.lit(Decimal(self.n)).cast("decimal(18,0)"), x.cast("decimal(19,0)")), s).cast(_WHOLE))

    def centred(self):
        return F.transform(self.gaps(), lambda g: g.cast("double") / F.lit(float(self.n)))

    def deviation(self):
        """The sum of squared ``gaps``; NULL where it is no 64-bit number."""
        if len(self.sums) * self.largest_gap ** 2 < 2 ** 63:
            return F.aggregate(self.gaps(), F.lit(0).cast("bigint"), lambda a, g: a + g * g)
        zero = F.lit(Decimal(0)).cast(_WHOLE)
        return let(self.gaps(), lambda gs: F.aggregate(F.transform(gs, lambda g: g.cast(_WHOLE)), zero, lambda a, g: F.try_add(
            a, F.try_multiply(g, g)).cast(_WHOLE))).try_cast("bigint")


# ---- Matrices ----

def block_matrix(rows, n):
    """(idx, v) as a block matrix of ``n`` rows."""
    vectors = rows.select("idx", array_to_vector("v").alias("v"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), n)
    return matrix.toBlockMatrix(max(BLOCK_ROWS, -(-n // MOST_BLOCKS)), BLOCK_COLUMNS)


def scatter(matrix, n):
    """The transpose times the matrix, as a local array. PySpark's ``multiply`` doesn't take the number of middle splits."""
    splits = max(1, -(-n // (matrix.rowsPerBlock * TASK_BLOCKS)))
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(spark, matrix, by):
    """(idx, values): the rows of ``matrix`` times the local array ``by``."""
    step = matrix.colsPerBlock
    parts = [((i // step, 0), Matrices.dense(*by[i:i + step].shape, by[i:i + step].ravel(order="F").tolist()))
             for i in range(0, len(by), step)]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), step, by.shape[1])
    product, height = matrix.multiply(right), matrix.rowsPerBlock

    def rows(block):
        (i, _), values = block
        return ((i * height + r, row) for r, row in enumerate(values.toArray().tolist()))

    return product.blocks.flatMap(rows).toDF("idx long, values array<double>")


def fit(spark, fit_rows, dimensions, components=COMPONENTS):
    """The whitening of (idx, x), all distinct."""
    sums = fit_rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(
        F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("total"),
        F.max("x").alias("high"), F.min("x").alias("low")).orderBy("at").collect()
    centre = Centre(sums[0].n, tuple(int(r.total) for r in sums), max(max(abs(r.high), abs(r.low)) for r in sums))
    n = centre.n
    matrix = block_matrix(fit_rows.select("idx", centre.centred().alias("v")), n)
    covariance = scatter(matrix, n) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    e, v = values[order], vectors[:, order]
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    varies = e > max(values.max(), 0) * dimensions * np.finfo(float).eps
    by = np.where(varies, v / np.sqrt(np.where(varies, e, 1.0)), 0.0)
    error = None
    if varies.any():
        white = stored(projected(spark, matrix, by[:, varies]), "whitened-fit")
        k = int(varies.sum())
        means = white.agg(*[F.avg(F.col("values")[i]) for i in range(k)]).first()
        again = white.select("idx", F.zip_with("values", F.array(*map(F.lit, means)), lambda x, m: x - m).alias("v"))
        error = float(np.abs(scatter(block_matrix(again, n), n) / n - np.eye(k)).max())
    return Whitening(centre, np.maximum(e, 0), float(np.trace(covariance)), by, error)


def transform(rows, n_rows, whitening):
    """(idx, x, ...) with ``values``, the whitened entries."""
    matrix = block_matrix(rows.select("idx", whitening.centre.centred().alias("v")), n_rows)
    return rows.join(projected(rows.sparkSession, matrix, whitening.matrix), "idx")


def whitened(df, key="vec_id", vector="embedding", scale=SCALE, components=COMPONENTS):
    """A row per vector that takes part and component: key, component (from 1), n, deviation, whitened, explained, identity_error."""
    spark, result = df.sparkSession, None
    vectors = stored(whole_vectors(df, key, vector, scale), "whole-vectors")
    for size, in sorted(vectors.select(F.size("x")).distinct().collect()):
        if not size:
            continue
        rows = indexed(vectors.where(F.size("x") == size), "indexed-vectors")
        w = fit(spark, indexed(rows.select("x").distinct(), "fit-list"), size, components)
        found = transform(rows, rows.count(), w).select(
            "key", F.lit(w.centre.n).cast("long").alias("n"), w.centre.deviation().alias("deviation"), F.posexplode(F.zip_with(
                "values", F.array(*[F.struct(F.lit(a).cast("double").alias("share"), F.lit(b).alias("varies"))
                                    for a, b in zip(w.explained, w.varies)]),
                lambda x, c: F.struct(F.when(c["varies"], x).alias("x"), c["share"].alias("share")))).alias("at", "c"))
        found = found.select(
            F.col("key").alias(key), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.x").alias("whitened"),
            F.col("c.share").alias("explained"), F.lit(w.identity_error).cast("double").alias("identity_error"))
        result = found if result is None else result.unionByName(found)
    if result is None:
        kind = df.select(F.col(key)).schema[0].dataType.simpleString()
        return spark.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    return result
