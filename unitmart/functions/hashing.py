"""Content-addressed batch ids.

A batch's digest depends only on (object, previous watermark, multiset of
rows). Each row is hashed over its columns in name order, every value with its
column's name and a null marker (the hash functions skip nulls, so without
them a value could move between nullable columns unseen). Two hashes with
different seeds are summed exactly as ``decimal(38,0)`` (a plain long sum
overflows under ANSI; XOR would cancel duplicate rows) beside the row count:
partial aggregates, one pass, the same after any repartitioning or reordering.
The batch id is the digest's first characters.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_LENGTH = 16
DIGESTS = ("_digest_a", "_digest_b")


def row_hash(df: DataFrame, exclude: tuple[str, ...] = (), seed: str = "") -> Column:
    parts = [F.lit(seed)]
    for c in sorted(c for c in df.columns if c not in exclude):
        parts += [F.lit(c), F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


def digest_measures(df: DataFrame) -> dict[str, tuple[Column, str]]:
    """The same totals as ``digest_aggs``, as row expressions and how to combine
    them, for a writer that takes them in passing."""
    return {d: (row_hash(df, seed=d).cast("decimal(38,0)"), "sum") for d in DIGESTS} | {"_rows": (F.lit(1), "sum")}


def digest_text(object_name: str, watermark_before: str | None, totals: dict) -> str:
    """``content_digest`` of totals that the driver holds already."""
    parts = [object_name, watermark_before if watermark_before is not None else "None",
             *(str(int(totals[d] or 0)) for d in DIGESTS), str(int(totals["_rows"] or 0))]
    return hashlib.sha256("|".join(parts).encode()).hexdigest()


def digest_aggs(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[Column]:
    return [F.sum(row_hash(df, exclude, d).cast("decimal(38,0)")).alias(d) for d in DIGESTS] + [
        F.count(F.lit(1)).alias("_rows")]


def content_digest(object_name: str, watermark_before: str | None) -> Column:
    """Hex digest of an aggregate with ``digest_aggs``."""
    text = F.concat_ws(
        "|", F.lit(object_name), F.lit(watermark_before if watermark_before is not None else "None"),
        *[F.coalesce(F.col(d).cast("string"), F.lit("0")) for d in DIGESTS], F.col("_rows").cast("string"))
    return F.sha2(text, 256)


def batch_id(object_name: str, watermark_before: str | None) -> Column:
    return F.substring(content_digest(object_name, watermark_before), 1, ID_LENGTH)


def content_id(df: DataFrame, object_name: str, watermark_before: str | None) -> DataFrame:
    """One-row frame: rows, batch_id."""
    return df.agg(*digest_aggs(df)).select(
        F.col("_rows").alias("rows"), batch_id(object_name, watermark_before).alias("batch_id"))
