"""Embedding whitening with MLlib's BlockMatrix.

1. Entries become whole numbers (``floor(256 c)``); rows are dealt into blocks
   of ``BLOCK_ROWS``, numbered without gaps by prefix sums over the tasks; a
   short block is filled up with null rows.
2. Of the rows of one vector the first (by block and place) is in the fit list:
   a map-side minimum per vector, so copies never meet in one group. Row count
   and sums per dimension of the fit list are exact whole numbers.
3. Blocks of centred rows (x - S/n) make a BlockMatrix B; with the rows outside
   the fit list set to 0 it is A, and A^T x B is the scatter matrix of the fit
   list. Its middle dimension is split, so every task multiplies a few blocks.
4. ``eigh`` of the (dimensions x dimensions) scatter on the driver.
5. B x W, with W the first components over the roots of their eigenvalues,
   projects all rows. The covariance of the projected fit list is measured
   from these rows.

Steps 3 and 5 go over the blocks in strips; what a strip shuffled is removed
before the next one begins.

Defined results: a row is dropped if its vector is null, holds a null or an
entry that is not finite (or of which 256 times does not fit a long), or has
not the table's commonest length (of several the greatest). A null id is kept.
Repeated rows get a result each. A component without variance (a vector set of
lower rank, or one vector only) has a null ``whitened``; ``identity_error``
covers the others, and ``explained`` is null where nothing varies.
``deviation`` is null if it does not fit a long. Equal eigenvalues keep
``eigh``'s order. No rows, or vectors of no entries: no result rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, release, staged, table

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 1024
BLOCK_ENTRIES = 1 << 20  # of a block at most: long vectors make blocks of fewer rows
STRIPS = 4               # strips of a table of many blocks, at least
STRIP_BLOCKS = 64, 8192  # blocks of a strip: at least, at most
TASK_BLOCKS = 8          # blocks that one task multiplies
RANK = 1e-12             # eigenvalues below this share of the greatest count as 0
MAX_LONG = (1 << 63) - 1


# --- blocks ---------------------------------------------------------------------

def quantised(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x (array of longs) of the rows that are not dropped."""
    c = F.col(f"`{vector_col}`").cast("array<double>")
    fits = F.forall(c, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float(1 << 63) / SCALE), F.lit(False)))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), c.alias("c")).where(F.col("c").isNotNull() & fits)
    return rows.select("id", F.transform("c", lambda v: F.floor(v * SCALE) + F.lit(0)).alias("x"))


def dealt(rows: DataFrame, rows_per_block: int) -> DataFrame:
    """Rows as blocks: task, place of the block in it, size, ids, and all x one
    after the other."""
    arrow_batches(rows.sparkSession)
    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("size", T.IntegerType()),
                           T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
                           T.StructField("x", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        waiting: list[pa.Table] = []
        at = 0

        def cut(whole: pa.Table, size: int) -> pa.RecordBatch:
            nonlocal at
            part = whole.slice(0, size).combine_chunks()
            ids, x = part.column("id").combine_chunks(), part.column("x").combine_chunks().flatten()
            out = pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([size], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), ids),
                 pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)], ["at", "size", "ids", "x"])
            at += 1
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            n = sum(t.num_rows for t in waiting)
            if n >= rows_per_block:
                whole = pa.concat_tables(waiting)
                while whole.num_rows >= rows_per_block:
                    yield cut(whole, rows_per_block)
                    whole = whole.slice(rows_per_block)
                waiting = [whole] if whole.num_rows else []
        if waiting:
            whole = pa.concat_tables(waiting)
            yield cut(whole, whole.num_rows)

    return rows.mapInArrow(run, schema).select(F.spark_partition_id().alias("part"), "*")


def numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Blocks with gapless numbers, and how many there are. One row per task
    of the writing job reaches the driver."""
    sizes = sorted((r.part, r.blocks) for r in blocks.groupBy("part").agg(F.count(F.lit(1)).alias("blocks")).collect())
    ends = np.cumsum([n for _, n in sizes]).tolist()
    bases = blocks.sparkSession.createDataFrame(
        [(part, end - n) for (part, n), end in zip(sizes, ends)], "part int, base long")
    with_base = blocks.join(F.broadcast(bases), "part")
    return with_base.select((F.col("base") + F.col("at")).alias("block"), "size", "ids", "x"), (ends or [0])[-1]


def with_fit(blocks: DataFrame, dims: int, rows_per_block: int) -> DataFrame:
    """Blocks with ``fit``: places of the rows that are in the fit list."""
    cut = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda p: F.struct(
        (F.col("block") * rows_per_block + p).alias("row"), F.slice("x", p * dims + 1, dims).alias("x")))
    first = blocks.select(F.inline(cut)).groupBy("x").agg(F.min("row").alias("row"))
    fit = first.groupBy(F.floor(F.col("row") / rows_per_block).alias("block")).agg(  # at most a block each
        F.sort_array(F.collect_list((F.col("row") % rows_per_block).cast("int"))).alias("fit"))
    return blocks.join(fit, "block", "left").withColumn("fit", F.coalesce("fit", F.array().cast("array<int>")))


def _matrix(x: pa.ListScalar, dims: int) -> np.ndarray:
    return np.asarray(x.values, dtype=np.int64).reshape(-1, dims)


def fit_sums(blocks: DataFrame, dims: int) -> tuple[int, list[int]]:
    """n and S of the fit list, exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            for x, fit in zip(batch.column("x"), batch.column("fit")):
                mine = _matrix(x, dims)[np.asarray(fit.values, dtype=np.int64)]
                n += len(mine)
                # in halves: entries may be as large as a long
                high += (mine >> 32).sum(axis=0)
                low += (mine & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int64()), pa.array([n] * dims, pa.int64()),
                                              pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                                             ["dim", "n", "high", "low"])

    parts = blocks.select("x", "fit").mapInArrow(run, "dim long, n long, high long, low long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), whole("high"), whole("low")).orderBy("dim").collect()
    return (int(rows[0].n) if rows else 0), [(int(r.high) << 32) + int(r.low) for r in rows]


# --- BlockMatrix ----------------------------------------------------------------

class Centre:
    """Centring of whole-number rows: x - S/n as (n x - S) / n where that is
    exact, else in doubles."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def shifted(self, x: np.ndarray) -> np.ndarray:
        """n x - S: longs if they fit, else Python numbers."""
        most = max(map(abs, self.sums), default=0) + self.n * int(max(np.abs(x.astype(np.float64)).max(initial=0), 1) + 1)
        if most < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (self.shifted(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        shifted = self.shifted(x)
        most = int(np.abs(shifted).max(initial=0))
        if most * most * max(x.shape[1], 1) > MAX_LONG:
            shifted = shifted.astype(object)
        return [int(v) if v <= MAX_LONG else None for v in (shifted * shifted).sum(axis=1)]


def _blocks(strip: DataFrame, centre: Centre, dims: int, base: int, count: int, rows_per_block: int,
            fit_only: bool) -> BlockMatrix:
    """Centred rows of a strip of blocks as a BlockMatrix; a row outside the fit
    list (``fit_only``) or beyond a short block's end is 0."""
    def block(row) -> tuple[tuple[int, int], DenseMatrix]:
        full = np.zeros((rows_per_block, dims))
        x = centre(np.array(row.x, np.int64).reshape(-1, dims))
        keep = np.array(row.fit if fit_only else range(len(x)), np.int64)
        full[keep] = x[keep]
        return (int(row.block) - base, 0), DenseMatrix(rows_per_block, dims, full.ravel(order="F"))

    made = strip.select("block", "x", "fit").rdd.map(block)
    return BlockMatrix(made, rows_per_block, dims, count * rows_per_block, dims)


def _multiply(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """Product with the middle dimension dealt over ``splits`` tasks at least."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _forget(product: BlockMatrix) -> None:
    """Remove the shuffle files behind a product that has been used."""
    product._java_matrix_wrapper._java_model.blocks().cleanShuffleDependencies(True)


def _strips(count: int) -> list[tuple[int, int]]:
    """(first block, blocks) of each strip."""
    least, most = STRIP_BLOCKS
    size = min(most, max(least, -(-count // STRIPS)))
    return [(at, min(size, count - at)) for at in range(0, count, size)]


def scatter(blocks: DataFrame, centre: Centre, dims: int, count: int, rows_per_block: int) -> np.ndarray:
    total = np.zeros((dims, dims))
    for base, size in _strips(count):
        strip = blocks.where(F.col("block").between(base, base + size - 1))
        a, b = (_blocks(strip, centre, dims, base, size, rows_per_block, fit_only) for fit_only in (True, False))
        product = _multiply(a.transpose(), b, -(-size // TASK_BLOCKS))
        total += product.toLocalMatrix().toArray()
        _forget(product)
    return (total + total.T) / 2


def project(blocks: DataFrame, centre: Centre, weights: np.ndarray, count: int, rows_per_block: int) -> DataFrame:
    """(block, values): the projected rows of each block, component by component."""
    spark = blocks.sparkSession
    dims, wide = weights.shape
    right = spark.sparkContext.parallelize([((0, 0), DenseMatrix(dims, wide, weights.ravel(order="F")))], 1)
    parts = []
    for base, size in _strips(count):
        strip = blocks.where(F.col("block").between(base, base + size - 1))
        left = _blocks(strip, centre, dims, base, size, rows_per_block, False)
        product = _multiply(left, BlockMatrix(right, dims, wide, dims, wide), 1)
        made = product.blocks.map(lambda b, base=base: (b[0][0] + base, b[1].toArray().ravel(order="F").tolist()))
        parts.append(staged(spark, spark.createDataFrame(made, "block long, values array<double>"), "projected"))
        _forget(product)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


# --- operator -------------------------------------------------------------------

def _identity_error(joined: DataFrame, rows_per_block: int, n: int, used: list[int]) -> float | None:
    """Largest entry of (covariance of the projected fit list - identity), over
    the components ``used``."""
    wide = len(used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sums, products = np.zeros(wide), np.zeros((wide, wide))
        for batch in batches:
            for values, fit in zip(batch.column("values"), batch.column("fit")):
                y = np.asarray(values.values).reshape(-1, rows_per_block)[used][:, np.asarray(fit.values, dtype=np.int64)]
                sums += y.sum(axis=1)
                products += y @ y.T
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64())),
                                          pa.array([products.ravel().tolist()], pa.list_(pa.float64()))], ["s", "p"])

    if not wide:
        return None
    parts = joined.select("values", "fit").mapInArrow(run, "s array<double>, p array<double>")
    at = lambda c, k: [F.sum(F.col(c)[i]) for i in range(k)]
    row = parts.agg(F.array(*at("s", wide)).alias("s"), F.array(*at("p", wide * wide)).alias("p")).first()
    mean = np.array(row.s) / n
    covariance = np.array(row.p).reshape(wide, wide) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(wide)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           rows_per_block: int | None = None) -> DataFrame:
    """Per row and component up to ``components``: id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    rows = quantised(df, id_col, vector_col)
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None or lengths.dims == 0:
        return spark.createDataFrame([], schema)
    dims = int(lengths.dims)
    rows_per_block = rows_per_block or max(1, min(BLOCK_ROWS, BLOCK_ENTRIES // dims))
    made = staged(spark, dealt(rows.where(F.size("x") == dims), rows_per_block), "vector_blocks")
    blocks, count = numbered(made)
    blocks = staged(spark, with_fit(blocks, dims, rows_per_block), "fit_blocks")
    n, sums = fit_sums(blocks, dims)
    centre = Centre(n, sums)
    values, vectors = np.linalg.eigh(scatter(blocks, centre, dims, count, rows_per_block) / n)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    wide = min(components, dims)
    used = [c for c in range(wide) if values[c] > RANK * values[0]]
    trace = float(values.sum())
    weights = np.zeros((dims, wide))
    weights[:, used] = vectors[:, used] / np.sqrt(values[used])
    projected = project(blocks, centre, weights, count, rows_per_block)
    joined = staged(spark, blocks.join(projected, "block"), "whitened_blocks")
    error = _identity_error(joined, rows_per_block, n, used)
    explained = [float(values[c]) / trace if trace else None for c in range(wide)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for ids, x, y in zip(batch.column("ids"), batch.column("x"), batch.column("values")):
                mine = _matrix(x, dims)
                size = len(mine)
                y = np.asarray(y.values).reshape(wide, rows_per_block)[:, :size]
                repeat = np.repeat(np.arange(size), wide)
                absent = np.tile([c not in used for c in range(wide)], size)
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(repeat)), pa.array(np.tile(np.arange(1, wide + 1), size), pa.int32()),
                    pa.array([n] * (size * wide), pa.int64()),
                    pa.array(centre.deviations(mine), pa.int64()).take(pa.array(repeat)),
                    pa.array(y.T.ravel(), pa.float64(), mask=absent), pa.array(explained * size, pa.float64()),
                    pa.array([error] * (size * wide), pa.float64())], schema.fieldNames())

    return joined.select("ids", "x", "values").mapInArrow(spread, schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
