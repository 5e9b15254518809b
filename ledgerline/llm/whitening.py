"""Embedding whitening with MLlib's BlockMatrix.

Vectors are quantised to whole numbers and written as blocks of rows, each block one row of a
table, numbered from 0. Centred blocks form the distributed matrix C of the fit list; the
transpose-product of C is the scatter matrix, whose eigenvectors (d x d, on the driver)
give the whitening matrix; the product of all rows' blocks with it projects them. Short
blocks are filled up with rows of zeros, which add nothing to a scatter.

MLlib groups the blocks of a product by partitions of its result. A tall matrix has one
result block, or one column of them, and would meet in one task or in the square root of
the partitions, so the scatter is split along the rows (``numMidDimSplits``), and rows to
be projected are folded into a grid as wide as it is high against a block-diagonal matrix.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common

#: Rows of a block; 2 MB of doubles at 64 dimensions. The driver holds one key for each block.
BLOCK_ROWS = 4096
#: Blocks that one task multiplies when the scatter is summed.
SPLIT_BLOCKS = 4
#: Entries are whole multiples of 1 / SCALE, rounded down.
SCALE = 256.0
#: Quantised entries beyond this can't be told apart as doubles; such vectors count as not finite.
LARGEST = float(1 << 53)
#: Components whose variance is a smaller share of the largest are noise of the arithmetic.
LEAST_SHARE = 1e-12

_MATRIX = pa.struct(
    [
        ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
        ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
    ]
)
_INDEX = pa.struct([("_1", pa.int64()), ("_2", pa.int64())])
_BLOCK = StructType(
    [
        StructField("index", StructType([StructField("_1", LongType()), StructField("_2", LongType())])),
        StructField("matrix", MatrixUDT()),
    ]
)


def quantised(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, x of the rows whose vector has finite entries only and the commonest length (the longer of
    equally common ones)."""
    scaled = F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < LARGEST))
    kept = rows.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0)).where(fits)
    kept = kept.select(F.col(vec_id).alias("vec_id"), scaled.alias("x"))
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common_size = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return kept.where(F.size("x") == (common_size["d"] if common_size else 0))


def blocks(rows: DataFrame, d: int, block_rows: int, name: str) -> DataFrame:
    """``rows`` (vec_id, x) as a written table of blocks: block (from 0, without gaps), vec_ids, x (flat, row
    by row). Only the last block of a task is short."""

    def batch(ids, flat):
        columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (ids, pa.array(flat))]
        return pa.RecordBatch.from_arrays(columns, ["vec_ids", "x"])

    def run(batches):
        ids, held, n = [], [], 0
        for b in batches:
            ids.append(b.column(0))
            held.append(b.column(1).flatten().to_numpy())
            n += len(b)
            if n >= block_rows:
                own, flat, whole = pa.concat_arrays(ids), np.concatenate(held), n // block_rows * block_rows
                for at in range(0, whole, block_rows):
                    yield batch(own[at : at + block_rows], flat[at * d : (at + block_rows) * d])
                ids, held, n = [own[whole:]], [flat[whole * d :]], n - whole
        if n:
            yield batch(pa.concat_arrays(ids), np.concatenate(held))

    made = rows.select(F.col("vec_id").cast("long"), "x").mapInArrow(run, "vec_ids array<long>, x array<long>")
    found = common.written(made.withColumn("at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = found.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row for each task that wrote
    first = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    numbered = found.withColumn("part", part).join(F.broadcast(counts.select("part", first.alias("first"))), "part")
    return numbered.select((F.col("first") + place).alias("block"), "vec_ids", "x")


def _grid(numbered: DataFrame) -> tuple[int, int]:
    """How many blocks there are and the rows of the highest, to which the others are filled up."""
    return tuple(numbered.agg(F.count(F.lit(1)), F.max(F.size("vec_ids"))).first())


def block_matrix(numbered: DataFrame, found: int, means: np.ndarray, block_rows: int, width: int = 1) -> BlockMatrix:
    """The centred rows of ``found`` blocks as a matrix; block b stands at row b // width, column b % width."""
    d = len(means)

    def run(batches):
        for b in batches:
            for number, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                values = np.zeros((block_rows, d))
                own = x.values.to_numpy().reshape(-1, d)
                values[: len(own)] = own - means
                flat = pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values.ravel()))
                none = pa.nulls(1, pa.list_(pa.int32()))
                fields = [pa.array([1], pa.int8()), pa.array([block_rows], pa.int32()), pa.array([d], pa.int32()), none, none, flat, pa.array([True])]
                index = pa.array([{"_1": number // width, "_2": number % width}], _INDEX)
                yield pa.RecordBatch.from_arrays([index, pa.StructArray.from_arrays(fields, fields=list(_MATRIX))], ["index", "matrix"])

    made = numbered.select("block", "x").mapInArrow(run, _BLOCK)
    size = -(-found // width) * block_rows, width * d
    return BlockMatrix(callMLlibFunc("createBlockMatrix", made, block_rows, d, *size), block_rows, d)


def _scatter(m: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose of ``m`` times ``m``, summed over ``splits`` ranges of its rows. (The number of splits
    is an argument of MLlib's multiply that the Python class doesn't pass on.)"""
    model = m._java_matrix_wrapper._java_model
    product = BlockMatrix(model.transpose().multiply(model, splits), m.colsPerBlock, m.colsPerBlock)
    return product.toLocalMatrix().toArray()


def _times(m: BlockMatrix, w: np.ndarray, width: int) -> BlockMatrix:
    """``m``, folded to ``width`` columns of blocks, times ``w`` in each of them."""
    sc = SparkSession.getActiveSession().sparkContext
    own = Matrices.dense(*w.shape, w.ravel(order="F"))
    same = sc.parallelize([((i, i), own) for i in range(width)], min(width, 64))
    diagonal = BlockMatrix(same, *w.shape, w.shape[0] * width, w.shape[1] * width)
    return m.multiply(diagonal)


def _products(m: BlockMatrix, k: int, width: int) -> DataFrame:
    """block, z (row by row, k each) of a product."""

    def run(batches):
        for b in batches:
            index, matrix = b.column(0), b.column(1)
            at = zip(index.field(0).to_pylist(), index.field(1).to_pylist(), strict=True)
            values, turned = matrix.field("values"), matrix.field("isTransposed").to_pylist()
            for (i, j), v, by_row in zip(at, values, turned, strict=True):
                z = v.values.to_numpy().reshape((-1, k) if by_row else (k, -1))
                flat = (z if by_row else z.T).ravel()
                column = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array([i * width + j], pa.int64()), column], ["block", "z"])

    found = callMLlibFunc("getMatrixBlocks", m._java_matrix_wrapper._java_model)
    return found.mapInArrow(run, "block long, z array<double>")


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Each column with its entry of largest size positive, so that a run again gives the same sign."""
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return vectors * np.where(top < 0, -1.0, 1.0)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over dimensions of (n * x - S) ** 2 of each row; beyond a long it raises."""
    largest = n * max(int(np.abs(x).max()), 1) + max(map(abs, sums))
    exact = np.int64 if largest < 1 << 31 and largest**2 * x.shape[1] < 1 << 63 else object
    part = x.astype(exact) * n - np.array(sums, dtype=exact)
    return [int(v) for v in (part * part).sum(axis=1)]


def whiten(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 4, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each remaining row and component.

    Left out are rows whose vector is null, empty, holds null or non-finite entries (or such as ``LARGEST``
    bounds), or has another than the commonest length. The fit list holds each distinct quantised vector
    once, however many rows have it. Rows that repeat are given each; a null id is kept. There are fewer
    components where the fit list spans fewer directions (``LEAST_SHARE``), so a single distinct vector and
    an empty table give no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept = quantised(rows, vec_id, embedding)
    fit = common.written(kept.select("x").distinct().select(F.lit(None).cast("long").alias("vec_id"), "x"), "fit-list")
    totals = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.count("c").alias("n"), F.sum("c").alias("s"))
    totals = sorted(totals.collect())  # one row for each dimension
    if not totals:
        return spark.createDataFrame([], schema)
    n, sums, d = totals[0]["n"], [t["s"] for t in totals], len(totals)
    means = np.array([s / n for s in sums])

    fit_blocks = blocks(fit, d, block_rows, "fit-blocks")
    found, height = _grid(fit_blocks)
    variance = _scatter(block_matrix(fit_blocks, found, means, height), -(-found // SPLIT_BLOCKS)) / n
    values, vectors = np.linalg.eigh(variance)
    order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > LEAST_SHARE * values[-1] > 0]
    if not order:
        return spark.createDataFrame([], schema)
    k = len(order)
    w = _signed(vectors[:, order]) / np.sqrt(values[order])

    def project(numbered: DataFrame, found: int, height: int) -> DataFrame:
        width = max(1, math.isqrt(found))
        return _products(_times(block_matrix(numbered, found, means, height, width), w, width), k, width)

    error = _identity_error(project(fit_blocks, found, height), k, n)
    all_blocks = blocks(kept, d, block_rows, "row-blocks")
    projected = project(all_blocks, *_grid(all_blocks))
    explained = (values[order] / np.trace(variance)).tolist()

    def out(batches):
        for b in batches:
            for own_ids, x, z in zip(b.column(0), b.column(1), b.column(2), strict=True):
                x, m = x.values.to_numpy().reshape(-1, d), len(own_ids)
                deviation = pa.array(deviations(x, n, sums), pa.int64())
                z = z.values.to_numpy().reshape(-1, k)[:m]  # without the rows that fill up a block
                for i in range(k):
                    columns = [
                        own_ids.values, pa.array(np.full(m, i + 1, np.int32)), pa.array(np.full(m, n)), deviation,
                        pa.array(np.ascontiguousarray(z[:, i])), pa.array(np.full(m, explained[i])), pa.array(np.full(m, error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return all_blocks.join(projected, "block").select("vec_ids", "x", "z").mapInArrow(out, schema)


def _identity_error(whitened: DataFrame, k: int, n: int) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity."""

    def run(batches):
        total, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            for z in b.column(1):
                own = z.values.to_numpy().reshape(-1, k)
                total += own.T @ own
                sums += own.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k)), pa.array(np.concatenate([total.ravel(), sums]))], ["i", "v"])

    found = whitened.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # k * k + k rows
    v = np.array([r["v"] for r in sorted(found)])
    mean = v[k * k :] / n
    return float(np.abs(v[: k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def op11_embedding_whitening(spark, sf_dir) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))
