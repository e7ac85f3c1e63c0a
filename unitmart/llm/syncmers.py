"""Document fingerprints from closed syncmers.

A k-mer (``K`` bytes of the UTF-8 text) is a closed syncmer if the least of
its inner s-mers (``S`` bytes, in hash order) is the first or the last. That
depends on the k-mer alone, so equal passages have equal anchors in any
context. A fingerprint holds the ``SIZE`` anchors with the least hashes and
their places; it is written as hex, six bytes an anchor (32 bits of hash, then
the place in units of ``UNIT`` bytes, doubled until the places fit 16 bits). A text without any syncmer has one
anchor: the hash of the whole. The likeness of two fingerprints estimates the
share of anchors in common (twice the common ones through the sum), and counts
of the common anchors the longest chain that comes in the same order in both
texts, however far insertions move it.

To pair each document with the next one, ids are dealt into ranges whose first
keys are known; each range also receives the first row of the one after it (the
last range that of the first), so only one row per range travels twice.

Defined results: a null text is empty; an empty text has an empty fingerprint,
like 1 to another empty one and 0 to any other; rows are ordered by id (null
first), then by a hash of the text, so repeated rows follow each other; a
single row is its own next document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PASS_BYTES, arrow_batches, documents, text_bytes
from .words import BYTE_CODE, prefix_sums, run_starts, span_hash

K, S = 20, 8
SIZE = 32
# a range of ids holds about so many bytes of text, and there are at most so many ranges
RANGE_BYTES = 12 << 20
MOST_RANGES = 50_000
UNIT = 16
_ANCHOR = np.dtype([("hash", ">u4"), ("place", ">u2")])


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and first byte (within its row) of every closed syncmer."""
    raw, offsets = text_bytes(arr)
    none = np.zeros(0, np.int64)
    if len(raw) < K:
        return none, none.astype(np.uint64), none
    sums = prefix_sums(BYTE_CODE[raw])
    first = np.arange(len(raw) - S + 1)
    inner = span_hash(sums, first, first + S)
    least = _sliding_min(inner, K - S + 1)
    n = len(least)
    edge = (inner[:n] == least) | (inner[K - S:K - S + n] == least)
    at = np.flatnonzero(edge & run_starts(offsets, len(raw), K))
    row = np.searchsorted(offsets, at, "right") - 1
    return row, span_hash(sums, at, at + K), at - offsets[row]


def _different(row: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row and hash, each hash once in a row: at its first place."""
    order = np.lexsort((at, h, row))
    row, h, at = row[order], h[order], at[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new], at[new]


def fingerprints(texts: list[str | None]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= PASS_BYTES:
            out += _fingerprints(part)
            part, size = [], 0
    return out + (_fingerprints(part) if part else [])


def _fingerprints(texts: list[str]) -> list[np.ndarray]:
    row, h, at = anchors(pa.array(texts, pa.large_string()))
    count = np.bincount(row, minlength=len(texts))
    # far fewer than all can be among the least: sort only those under a bound,
    # and texts that have too few different ones there in full
    bound = np.minimum(4.0 * SIZE / np.maximum(count, 1), 1.0)
    near = h <= (bound * (2.0**64 - 2**11)).astype(np.uint64)[row]
    least = _different(row[near], h[near], at[near])
    under = np.bincount(row[near], minlength=len(texts))
    short = (np.bincount(least[0], minlength=len(texts)) < SIZE) & (under < count)
    if short.any():
        full, done = short[row], ~short[least[0]]
        rest = _different(row[full], h[full], at[full])
        least = tuple(np.concatenate([x[done], y]) for x, y in zip(least, rest))
        order = np.argsort(least[0], kind="stable")
        least = tuple(x[order] for x in least)
    row, h, at = least
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    made = np.empty(len(row), _ANCHOR)
    made["hash"] = (h >> np.uint64(32)).astype(np.uint32)
    last = np.zeros(len(texts), np.int64)
    np.maximum.at(last, row, at // UNIT)
    while (last > 0xFFFF).any():
        far = last > 0xFFFF
        last[far] >>= 1
        at = np.where(far[row], at >> 1, at)
    made["place"] = at // UNIT
    out = []
    for i, t in enumerate(texts):
        own = made[bounds[i]:min(bounds[i + 1], bounds[i] + SIZE)]
        if len(own) == 0 and t:
            own = np.frombuffer(hashlib.sha256(t.encode()).digest()[:4] + b"\0\0", _ANCHOR)
        out.append(own)
    return out


def _chain(x: list[int], y: list[int]) -> int:
    """Length of the longest chain of points that descends in neither place."""
    ends: list[int] = []
    for _, v in sorted(zip(x, y)):
        k = bisect_right(ends, v)
        ends[k:k + 1] = [v]
    return len(ends)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two fingerprints, from 0 to 1."""
    if a.tobytes() == b.tobytes():
        return 1.0
    if len(a) == 0 or len(b) == 0:
        return 0.0
    x, y = a["hash"].astype(np.uint32), b["hash"].astype(np.uint32)
    both, i, j = np.intersect1d(x, y, return_indices=True)
    if len(both) == 0:
        return 0.0
    either = np.union1d(x, y)[:SIZE]
    use = both <= either[-1]
    share = _chain(a["place"][i][use].tolist(), b["place"][j][use].tolist()) / len(either)
    return 2 * share / (1 + share)


def parse(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), _ANCHOR)


def _sort_key(ids: pd.Series, tie: pd.Series) -> np.ndarray:
    """(id, tie) as 16 bytes that sort alike."""
    key = np.empty((len(ids), 2), ">u8")
    for k, s in enumerate((ids, tie)):
        key[:, k] = s.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return key.view("S16").ravel()


def in_order_with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """(slice, guest, id, text), partitioned by slice and sorted; in each slice
    the rows of a range of ids in order, then one row: the next range's first."""
    spark = df.sparkSession
    arrow_batches(spark)
    src = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).withColumn(
        "tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    least = F.lit(-(1 << 63))
    keys = src.select(F.coalesce("id", least).alias("id"), "tie")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(max(-(-size // RANGE_BYTES), 1), MOST_RANGES)
    # one row per range of ids, however many documents there are
    heads = (keys.repartitionByRange(ranges, "id", "tie").groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct("id", "tie")).alias("h")).select("h.id", "h.tie").orderBy("id", "tie").toPandas())
    n = max(len(heads), 1)
    shipped = spark.sparkContext.broadcast(_sort_key(heads["id"], heads["tie"]) if len(heads) else np.zeros(0, "S16"))

    @F.pandas_udf("bigint")
    def place(ids: pd.Series, tie: pd.Series) -> pd.Series:
        """Twice the slice, and one more for a row that is the first of it."""
        k = _sort_key(ids, tie)
        at = np.searchsorted(shipped.value, k, "right") - 1
        return pd.Series(2 * at + (shipped.value[at] == k))

    slot = F.shiftright("place", 1)
    own = F.struct(slot.cast("int").alias("slice"), F.lit(0).alias("guest"))
    before = F.struct(F.pmod(slot - 1, F.lit(n)).cast("int").alias("slice"), F.lit(1).alias("guest"))
    return (src.withColumn("place", place(F.coalesce("id", least), "tie"))
            .withColumn("to", F.explode(F.when(F.col("place") % 2 == 1, F.array(own, before)).otherwise(F.array(own))))
            .select("to.slice", "to.guest", "id", "tie", "text")
            .repartitionById(n, "slice")
            .sortWithinPartitions("slice", "guest", "id", "tie").drop("tie"))


def fingerprint_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the contract: one per document."""
    ordered = in_order_with_next(df, key, text)

    def emit(ids: list, texts: list[str], prints: list[np.ndarray], used: list[int]) -> pa.RecordBatch:
        edited = []
        for i in used:
            half = len(texts[i]) // 2
            edited.append(texts[i][:len(texts[i]) - half] + texts[i + 1][:half])
        changed = fingerprints(edited)
        return pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in used], pa.int64()),
            pa.array([len(texts[i]) for i in used], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array([prints[i].tobytes().hex() for i in used]),
            pa.array([p.tobytes().hex() for p in changed]),
            pa.array([likeness(prints[i], p) for i, p in zip(used, changed)]),
            pa.array([likeness(prints[i], prints[i + 1]) for i in used])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guest: list[int] = []
        ids: list = []
        texts: list[str] = []
        prints: list[np.ndarray] = []
        for batch in it:
            if not batch.num_rows:
                continue
            new = [t or "" for t in batch.column("text").to_pylist()]
            guest += batch.column("guest").to_pylist()
            ids += batch.column("id").to_pylist()
            texts += new
            prints += fingerprints(new)
            used = [i for i in range(len(ids) - 1) if not guest[i]]
            if used:
                yield emit(ids, texts, prints, used)
            guest, ids, texts, prints = guest[-1:], ids[-1:], texts[-1:], prints[-1:]

    return ordered.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))
