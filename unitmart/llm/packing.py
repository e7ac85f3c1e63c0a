"""Packing: best-fit decreasing with a segment tree over remaining capacities.

Each document (its ids and an end id) is cut into full windows of ``capacity``
ids, which are sequences by themselves, and one shorter rest. Rests are packed
in blocks of about ``BLOCK`` documents, dealt by a hash, so that the work is
spread and a block's waste is small against its size. Within a block the rests
go, longest first, each into the open window with the least room that still
holds it; a segment tree with a leaf for each remaining capacity finds it in
log2(capacity) steps. What is left open at the end is padding, unless the
window's length is a power of two.

Only lengths and checksums travel; ids are made once, where the text is.

Defined results: a null or empty text is a document of one id; repeated rows
are separate documents; a null document id is kept; an empty table has no
pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_cache import encoder, token_file
from .common import documents, map_arrow, slices, staged

CAPACITY = 1024
BLOCK = 50_000
# sequence numbers: block, then place within the block (or the window's own)
BLOCK_BITS = 36


class RoomTree:
    """Windows by remaining capacity; a node says whether any leaf below it
    has a window."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.used = bytearray(2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        at = room + self.size
        while at and not self.used[at]:
            self.used[at] = 1
            at >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out a window with the least room of at least ``need``."""
        used, at = self.used, need + self.size
        if not used[at]:
            while at > 1 and (at & 1 or not used[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at *= 2
                if not used[at]:
                    at += 1
        room = at - self.size
        window = self.windows[room].pop()
        if not self.windows[room]:
            used[at] = 0
            at >>= 1
            while at and not (used[2 * at] or used[2 * at + 1]):
                used[at] = 0
                at >>= 1
        return room, window


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each rest (every length under ``capacity``), taken
    in the given order, which is to be longest first."""
    tree, opened = RoomTree(capacity), 0
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        found = tree.tightest(n)
        if found is None:
            room, w = capacity, opened
            opened += 1
        else:
            room, w = found
        window[i], offset[i] = w, capacity - room
        if room > n:
            tree.add(room - n, w)
    return window, offset


def cut(df: DataFrame, key: str, text: str, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens,
    and a number that deals documents into blocks."""
    src = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch):
        enc, end = encoder(path), np.array([end_id], "<u4").tobytes()
        for part in slices(batch, "text"):
            out = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), enc.ids(part.column("text").to_pylist())):
                b = memoryview(ids + end)
                n = len(b) // 4
                for a in range(0, n, capacity):
                    m = min(capacity, n - a)
                    out.append((doc, a, m, zlib.crc32(b[4 * a:4 * (a + m)]), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return map_arrow(src, run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint", "encoder")


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. ``pieces`` has to be a stored table:
    it is read for its count, its full windows and its rests."""
    spark = pieces.sparkSession
    rests = pieces.where(F.col("length") < capacity)
    blocks = max(1, -(-rests.count() // block))
    # a full window is a sequence by itself, numbered within its partition
    full = (pieces.where(F.col("length") >= capacity)
            .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("bigint")))
    dealt = rests.withColumn("block", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks)))

    def run(t: pa.Table) -> pa.Table:
        cols = {c: np.asarray(t.column(c).combine_chunks().fill_null(0)) for c in ("doc_id", "start", "ids_crc32", "length")}
        order = np.lexsort((cols["ids_crc32"], cols["start"], cols["doc_id"], -cols["length"]))
        t = t.take(pa.array(order))
        window, offset = best_fit(cols["length"][order], capacity)
        number = t.column("block")[0].as_py()
        return (t.drop_columns(["block"])
                .append_column("sequence_id", pa.array((number << BLOCK_BITS) + window))
                .append_column("offset", pa.array(offset)))

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return full.unionByName(dealt.groupBy("block").applyInArrow(run, schema))


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                   end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    pieces = cut(df, key, text, path or token_file("byte_bpe_50k.json"), end_id, capacity)
    return pack(staged(df.sparkSession, pieces, "pieces"), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
