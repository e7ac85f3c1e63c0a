"""Search terms of texts, as UTF-8 byte strings, and query sets cut into blocks.

``bytes.translate`` lower-cases A-Z and turns every byte that is not part of a
term into a space, so ``bytes.split`` gives the terms: bytes of 0x80 and above
(all of any non-ASCII character) belong to terms.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text of one block of queries, which is handed to every task. A single longer
# query makes a block of its own.
QUERY_BYTES = 4 << 20
QUERY_ROWS = 1024
# Text that is split at a time: bounds the lists of words of a very long text.
SPLIT_BYTES = 4 << 20


def byte_table() -> bytes:
    """For ``bytes.translate``: A-Z to a-z; 0-9, a-z and non-ASCII bytes stay;
    anything else becomes a space."""
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in keep else 0x20 for b in range(256))


TERM_BYTES = byte_table()


def terms(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "replace").translate(TERM_BYTES).split()


def term_chunks(text: str | None, limit: int = SPLIT_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    if text is None:
        return
    raw = text.encode("utf-8", "replace").translate(TERM_BYTES)
    start = 0
    while len(raw) - start > limit:
        cut = raw.find(b" ", start + limit)
        if cut < 0:
            break
        yield raw[start:cut].split()
        start = cut
    yield raw[start:].split()


def query_blocks(queries: DataFrame, key: str, text: str, limit: int = QUERY_BYTES,
                 most: int = QUERY_ROWS) -> Iterator[list[tuple]]:
    """Queries as (key, text) in blocks of at most ``most`` and about ``limit`` bytes, one block on
    the driver at a time, by key and text. Rows that repeat a key and a text
    are one query; a null text is none."""
    rows = (queries.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
            .where(F.col("text").isNotNull()).distinct().orderBy("key", "text"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        n = len(row.text.encode("utf-8", "replace"))
        if block and (size + n > limit or len(block) >= most):
            yield block
            block, size = [], 0
        block.append((row.key, row.text))
        size += n
    if block:
        yield block
