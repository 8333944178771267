"""Embedding whitening with Spark MLlib's distributed block matrices.

Entries become whole numbers; each distinct vector counts once.  Its rows, centred, are cut
into blocks of bounded size and stored.  The scatter matrix is the transposed block matrix
times itself, its inner dimension split over many tasks; only this one matrix (dimensions
squared) comes to the driver, for ``eigh``.  The whitening matrix goes back as a block matrix,
and one more block multiplication projects all rows.

The product is laid out as a square: block b of the rows stands at (b // side, b % side), and
the whitening matrix on the diagonal.  MLlib partitions a result by its grid, so a square
grid is dealt out over all tasks, where a tall one would be cut into the square root of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom.llm.common import Scratch, read_table

#: Steps to one unit of an entry.
STEPS = 256
COMPONENTS = 4
#: Entries of a block: 2 MB of doubles.
BLOCK_ENTRIES = 1 << 18
#: Blocks of the inner dimension that one task multiplies.
BLOCKS_A_TASK = 8

_MATRIX = MatrixUDT.sqlType()
_BLOCKS = T.StructType([
    T.StructField("task", T.IntegerType()), T.StructField("k", T.LongType()),
    T.StructField("h1", T.ArrayType(T.LongType())), T.StructField("h2", T.ArrayType(T.LongType())),
    T.StructField("matrix", _MATRIX),
])
_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: the mean is ``sums / n``; ``matrix`` has one column a component."""

    n: int
    sums: list[int]
    values: np.ndarray
    matrix: np.ndarray
    trace: float
    rows_a_block: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def steps(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): rows whose vector and all its entries are there and finite, as whole steps."""
    whole = F.forall(column, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(F.col(column).isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(column, lambda c: F.floor(c.cast("double") * float(STEPS))).alias("x"))


def _matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _fits(x: np.ndarray, times: int) -> bool:
    """Whether sums of ``times`` entries stay inside 62 bits."""
    return not x.size or max(-int(x.min()), int(x.max()), 1) * times < 1 << 62


def _partial_sums(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            x = _matrix_of(batch.column(0), width)
            n += len(x)
            own = x.sum(0) if _fits(x, len(x)) else x.astype(object).sum(0)
            sums = [a + int(b) for a, b in zip(sums, own, strict=True)] if len(x) else sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, width), pa.int32()),
             pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))], ["place", "total"])

    return run


def _block_rows(width: int, rows: int, mean: np.ndarray):
    """Centred rows as blocks; a task's last block is filled up with zeros, which add nothing."""
    def block(task: int, k: int, x: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> dict:
        full = np.zeros((rows, width))
        full[:len(x)] = x.astype(np.float64) - mean
        matrix = {"type": 1, "numRows": rows, "numCols": width, "colPtrs": None, "rowIndices": None,
                  "values": full.ravel(), "isTransposed": True}
        return {"task": task, "k": k, "h1": h1, "h2": h2, "matrix": matrix}

    schema = pa.schema([
        ("task", pa.int32()), ("k", pa.int64()), ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int64())),
        ("matrix", pa.struct([
            pa.field("type", pa.int8(), False), pa.field("numRows", pa.int32(), False),
            pa.field("numCols", pa.int32(), False),
            pa.field("colPtrs", pa.list_(pa.field("element", pa.int32(), False))),
            pa.field("rowIndices", pa.list_(pa.field("element", pa.int32(), False))),
            pa.field("values", pa.list_(pa.field("element", pa.float64(), False))),
            pa.field("isTransposed", pa.bool_(), False)]))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count, k, task = 0, 0, 0

        def cut(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, count, k
            if count < least or not count:
                return
            x, h1, h2 = (np.concatenate(part) for part in zip(*held, strict=True))
            at = 0
            while count - at >= least and at < count:
                yield pa.RecordBatch.from_pylist(
                    [block(task, k, x[at:at + rows], h1[at:at + rows], h2[at:at + rows])], schema)
                at, k = at + rows, k + 1
            held, count = [(x[at:], h1[at:], h2[at:])], max(count - at, 0)

        for batch in batches:
            if batch.num_rows:
                task = batch.column(0)[0].as_py()
                held.append((_matrix_of(batch.column(1), width),
                             batch.column(2).to_numpy(), batch.column(3).to_numpy()))
                count += batch.num_rows
                yield from cut(rows)
        yield from cut(1)

    return run


def identity(x: str) -> tuple:
    """Two independent 64-bit hashes of a vector, 128 bits together."""
    return F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("w"), x).alias("h2")


def centred_blocks(fit: DataFrame, sums: list[int], n: int, rows: int, scratch: Scratch) -> DataFrame:
    """Stored blocks of the fit list (column x): b from 0, hashes of the block's rows, matrix."""
    mean = np.array([s / n for s in sums])
    cut = scratch.save(
        fit.select(F.spark_partition_id().alias("task"), "x", *identity("x"))
        .mapInArrow(_block_rows(len(sums), rows, mean), _BLOCKS), "cut")
    # One row a task: its first block follows the last one of the task before.
    counts = cut.groupBy("task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return scratch.save(
        cut.join(first, "task").select((F.col("_first") + F.col("k")).alias("b"), "h1", "h2", "matrix"), "blocks")


def _block_matrix(cells: DataFrame, scratch: Scratch, name: str, rows: int, columns: int) -> BlockMatrix:
    """A block matrix of (i, j, matrix), read from a table so that blocks never leave the JVM."""
    path = f"{scratch.root}/{name}"
    cells.select(F.struct(F.col("i").cast("long").alias("_1"), F.col("j").cast("long").alias("_2")).alias("at"),
                 "matrix").write.parquet(path)
    typed = T.StructType([
        T.StructField("at", T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])),
        T.StructField("matrix", MatrixUDT())])
    made = callMLlibFunc("createBlockMatrix", scratch.spark.read.schema(typed).parquet(path), rows, columns, 0, 0)
    return BlockMatrix(made, rows, columns)


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; its inner dimension is dealt out over ``splits`` tasks a result part."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def eigen(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues of scatter / n, unit vectors as columns, and the trace.

    Components without variance (below the rounding of the largest one) are left out.
    """
    covariance = scatter / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    least = max(values[0], 0.0) * len(values) * np.finfo(float).eps
    k = min(components, int((values > least).sum()))
    return values[:k], vectors[:, :k], float(np.trace(covariance))


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS,
           ) -> tuple[DataFrame, DataFrame, Whitening] | None:
    """Fits on the distinct vectors of ``vectors`` and projects them.

    Returns the rows as (vec_id, x), the projected fit list as (h1, h2, whitened array) and the
    whitening; None where no component has any variance.  A vector shorter than the longest one
    is taken to end in zeros.
    """
    scratch = Scratch(vectors.sparkSession, "whiten")
    rows = steps(vectors, column)
    shortest, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not width:
        return None
    if shortest < width:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))
    fit = scratch.save(rows.select("x").distinct(), "fit")
    found = {r["place"]: int(r["total"]) for r in fit.mapInArrow(
        _partial_sums(width), "place int, total decimal(38,0)").groupBy("place").agg(
        F.sum("total").alias("total")).collect()}  # one row a dimension
    n, sums = found[-1], [found[i] for i in range(width)]

    per_block = max(1, BLOCK_ENTRIES // width)
    blocks = centred_blocks(fit, sums, n, per_block, scratch)
    count = blocks.count()
    tall = _block_matrix(blocks.select(F.col("b").alias("i"), F.lit(0).alias("j"), "matrix"), scratch, "tall",
                         per_block, width)
    scatter = times(tall.transpose(), tall, ceil(count / BLOCKS_A_TASK)).toLocalMatrix().toArray()
    values, vectors_, trace = eigen(scatter, n, components)
    scratch.drop("tall")
    if not len(values):
        return None
    model = Whitening(n, sums, values, vectors_ / np.sqrt(values), trace, per_block)
    return rows, projected(blocks, count, model, scratch), model


def projected(blocks: DataFrame, count: int, model: Whitening, scratch: Scratch) -> DataFrame:
    """(h1, h2, whitened) of every row of the stored blocks, by one block multiplication."""
    spark, side = scratch.spark, isqrt(count - 1) + 1
    width, k = model.matrix.shape
    square = _block_matrix(
        blocks.select(F.floor(F.col("b") / side).alias("i"), (F.col("b") % side).alias("j"), "matrix"),
        scratch, "square", model.rows_a_block, width)
    small = DenseMatrix(width, k, model.matrix.T.ravel())
    diagonal = BlockMatrix(
        spark.sparkContext.parallelize(range(side), min(side, 64)).map(lambda q: ((q, q), small)), width, k)
    product = callMLlibFunc("getMatrixBlocks", times(square, diagonal)._java_matrix_wrapper._java_model)
    path = f"{scratch.root}/product"
    product.toDF("at", "matrix").write.parquet(path)
    plain = T.StructType([
        T.StructField("at", T.StructType([T.StructField("_1", T.IntegerType()), T.StructField("_2", T.IntegerType())])),
        T.StructField("matrix", _MATRIX)])
    scratch.drop("square")
    made = spark.read.schema(plain).parquet(path).select(
        (F.col("at._1").cast("long") * side + F.col("at._2")).alias("b"), "matrix.values", "matrix.isTransposed")
    named = blocks.select("b", "h1", "h2").join(made, "b")
    row = F.posexplode(F.arrays_zip("h1", "h2")).alias("r", "h")

    def cell(c: int) -> F.Column:
        by_row = F.col("r") * k + c
        by_column = F.lit(c * model.rows_a_block) + F.col("r")
        return F.element_at("values", F.when(F.col("isTransposed"), by_row).otherwise(by_column) + 1)

    return scratch.save(
        named.select("values", "isTransposed", row).select(
            "h.h1", "h.h2", F.array(*[cell(c) for c in range(k)]).alias("whitened")), "whitened")


def identity_error(white: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity."""
    part = [F.col("whitened")[c] for c in range(k)]
    means = white.agg(*[F.avg(p) for p in part]).first()
    centred = [p - F.lit(m) for p, m in zip(part, means, strict=True)]
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    found = white.agg(*[F.avg(centred[a] * centred[b]) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs, strict=True))


def deviations(model: Whitening):
    """A function from x to the sum of (n x - S)^2, exact; null where a long cannot hold it."""
    n, sums = model.n, model.sums
    width = len(sums)

    @F.arrow_udf("long")
    def deviation(column: pa.Array) -> pa.Array:
        x = _matrix_of(column, width)
        high = max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
        widest = n * high + max(map(abs, sums))
        if widest * widest * width < 1 << 62:
            return pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(1))
        exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
        return pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())

    return deviation


def whitened_rows(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row a remaining row of ``vectors`` (vec_id, embedding) and component.

    Null vectors, and vectors with a null or non-finite entry, have no row.  Repeated rows and
    null ids are carried along, each with its own result rows.  Entries beyond the long range
    stay at its ends.  Equal vectors count once in the fit.  Components without variance have no
    row, so a table of one vector, or an empty one, gives an empty result.
    """
    spark = vectors.sparkSession
    found = whiten(vectors, column, components)
    if found is None:
        return spark.createDataFrame([], _RESULT)
    rows, white, model = found
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    error = identity_error(white, len(model.values))
    narrow = rows.select("vec_id", deviations(model)("x").alias("deviation"), *identity("x"))
    return narrow.join(white, ["h1", "h2"]).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("c", "whitened")).select(
        "vec_id", (F.col("c") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", explained[F.col("c")].alias("explained"),
        F.lit(float(error)).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their first four whitened components."""
    return whitened_rows(read_table(spark, sf_dir, "embeddings"))
