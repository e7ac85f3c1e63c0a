"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Format. One part per range of document ids, in ascending order of ids (ties by
a hash of the text). A part is three flat little-endian files beside each
other: ``.ids`` (unsigned 16-bit where the vocabulary allows, else 32-bit),
``.offsets`` (n+1 unsigned 64-bit, in ids, from 0) and ``.docs`` (n signed
64-bit document ids; the least value stands for null). The manifest holds the
parts in order with their bases: prefix sums of the parts' lengths, so an id's
place in the whole is base + offset. Names are unique for each attempt, and
only parts whose task has reported are in the manifest, so a lost executor
leaves stray files but no wrong ones. Parts go to the shared folder.

Defined results: a null or empty text is one end id; a null document id comes
first; repeated rows are separate documents; an empty table has no parts.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .chunk_cache import encoder, token_file
from .common import arrow_batches, documents, release, slices

NULL_ID = -(1 << 63)


def _local(uri: str) -> str | None:
    p = urlparse(uri)
    return p.path if p.scheme in ("", "file") else None


def create(uri: str):
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        f, rest = fs.FileSystem.from_uri(uri)
        return f.open_output_stream(rest)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    return open(path, "wb")


def mapped(uri: str, dtype) -> np.ndarray:
    """A part file as an array: memory-mapped on a mounted file system."""
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        f, rest = fs.FileSystem.from_uri(uri)
        with f.open_input_file(rest) as src:
            return np.frombuffer(src.read_buffer(), dtype)
    if os.path.getsize(path) == 0:
        return np.zeros(0, dtype)
    return np.memmap(path, dtype, "r")


def write(df: DataFrame, key: str, text: str, path: str, end_id: int, folder: str) -> DataFrame:
    """Encode and write all rows; returns the manifest (part, name, docs, ids,
    base, width), one row per non-empty part."""
    spark = df.sparkSession
    arrow_batches(spark)
    src = (df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
           .withColumn("tie", F.xxhash64("text"))
           .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release("encoder")
        enc, files = encoder(path), []
        kind = "<u2" if max(enc.vocab_size, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        total, n = 0, 0
        try:
            for batch in it:
                if not batch.num_rows:
                    continue
                if not files:
                    files += [create(f"{name}.{x}") for x in ("ids", "offsets", "docs")]
                    files[1].write(np.zeros(1, "<u8").tobytes())
                for rows in slices(batch, "text"):
                    made = [b + end for b in enc.ids(rows.column("text").to_pylist())]
                    at = total + np.cumsum([len(b) // 4 for b in made]).astype("<u8")
                    total = int(at[-1])
                    files[0].write(np.frombuffer(b"".join(made), "<u4").astype(kind).tobytes())
                    files[1].write(at.astype("<u8").tobytes())
                files[2].write(np.asarray(batch.column("id").fill_null(NULL_ID)).astype("<i8").tobytes())
                n += batch.num_rows
        finally:
            for f in files:
                f.close()
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([name]), pa.array([n], pa.int64()),
                 pa.array([total], pa.int64()), pa.array([int(kind[2])], pa.int32())],
                names=["part", "name", "docs", "ids", "width"])

    schema = "part bigint, name string, docs bigint, ids bigint, width int"
    parts = sorted(src.mapInArrow(run, schema).collect())  # one row per part
    rows, base = [], 0
    for p in parts:
        rows.append((p.part, p.name, p.docs, p.ids, p.width, base))
        base += p.ids
    return spark.createDataFrame(rows, f"{schema}, base bigint")


def read(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    arrow_batches(spark)
    parts = manifest.count()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for p in batch.to_pylist():
                ids = mapped(f"{p['name']}.ids", f"<u{p['width']}")
                offsets = mapped(f"{p['name']}.offsets", "<u8").astype(np.int64)
                docs = np.asarray(mapped(f"{p['name']}.docs", "<i8"))
                for a in range(0, len(docs), 4096):
                    b = min(a + 4096, len(docs))
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes())
                           for x, y in zip(offsets[a:b].tolist(), offsets[a + 1:b + 1].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[a:b], pa.int64(), mask=docs[a:b] == NULL_ID),
                         pa.array(p["base"] + offsets[a:b]),
                         pa.array(np.diff(offsets[a:b + 1])), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (manifest.select("name", "width", "base").repartition(max(parts, 1))
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def op3_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    folder = scratch_path(spark, "llm", "token_files")
    manifest = write(documents(spark, sf_dir), "doc_id", "text",
                     tokenizer or token_file("word_bpe_49k.json"), 1, folder)
    return read(manifest)
