"""Shared plumbing: table reads, staged intermediates, byte-bounded batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Text handed to one numpy pass; several work arrays of eight bytes a byte
# live at once, so a pass stays within some tens of MB.
PASS_BYTES = 1 << 20
# returns the free memory of the C allocator, where it can
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
# Text in one Arrow batch sent to a Python worker.
BATCH_BYTES = 2 << 20

# words are runs of anything but space, \t, \n, \v, \f, \r
WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(col: Column | str) -> Column:
    """crc32 of an id written as decimal text: the split contracts use it."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary"))


def ship(spark: SparkSession) -> None:
    """Hand this package's sources to the executors' Python workers, once per
    application, through Spark's own file distribution."""
    sc = spark.sparkContext
    if getattr(sc, "_unitmart_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    package = os.path.basename(root)
    path = os.path.join(sc._temp_dir, f"{package}-{uuid.uuid4().hex[:8]}.zip")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.join(package, os.path.relpath(full, root)))
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    sc._unitmart_shipped = True


@contextlib.contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def staged(spark: SparkSession, df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage so
    lost executors cost one stage, and releases the shuffle files behind it."""
    path = scratch_path(spark, "llm", label)
    with _conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrowed(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """The same rows in no more tasks than ``rows`` of about ``each`` need, for
    small tables on a session with very many shuffle partitions."""
    return df.coalesce(max(8, -(-rows // each)))


def arrow_batches(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes, not only by rows: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    ship(spark)


# what a Python worker remembers between tasks: functions with an lru_cache
_REMEMBERED: dict[str, Callable] = {}


def remembered(name: str, cached: Callable) -> None:
    _REMEMBERED[name] = cached


def release(keep: str | None = None) -> None:
    """Workers outlive tasks: forget what other operators remembered in this
    one, and give memory that is free back to the system, so that it does not
    add up over a pipeline."""
    full = [c for name, c in _REMEMBERED.items() if name != keep and c.cache_info().currsize]
    for cached in full:
        cached.cache_clear()
    if full:
        gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
              schema: str, remembers: str | None = None) -> DataFrame:
    """``mapInArrow`` over byte-bounded batches."""
    arrow_batches(df.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(remembers)
        for batch in it:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: int | str, limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (one row at least)."""
    import numpy as np

    lens = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, size = 0, 0
    for i, n in enumerate(lens):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(arr: pa.Array):
    """The UTF-8 bytes of a string column (null: empty) and its row offsets."""
    import numpy as np

    arr = arr.cast(pa.large_string()).fill_null("")
    if arr.offset or len(arr) == 0:
        arr = pa.concat_arrays([arr, pa.array([], pa.large_string())]) if len(arr) else arr
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64, len(arr) + 1 + arr.offset)[arr.offset:]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]
