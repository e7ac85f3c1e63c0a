"""Ranked lexical search over bit-sliced Bloom signatures.

Index (``build_index``): documents of one task with about as many distinct
terms form blocks. A block is a bit matrix of one column per document and
``BITS`` rows per key of its largest document, stored row by row as bitmaps
("slices"). Keys are (term, level): a term that occurs tf times sets ``HASHES``
bits for every level of ``LEVELS`` up to tf.

Search (``search``), for a block of queries:

1. the bitmaps of a term's bits, and-ed, show which documents may hold it that
   often; a false positive can only add documents. So the level found is never
   below the real one, and the greatest contribution that a tf below the next
   level can make, times the term's weight, summed over the terms of a query,
   is an upper bound of every document's score;
2. some documents are scored exactly: those with the greatest sums when each
   term's weight is lowered by the chance that its bits are set by other keys
   (else the false positives of rare terms would fill the list). The k-th of
   these scores is a floor of the k-th best one, whichever were tried;
3. every document whose bound reaches its query's floor is scored exactly.
   What is passed by is provably below the floor; nothing else is left out.

Scores are sums of whole numbers below 2^53, so bounds in doubles are exact.

Defined results: a null text and a text without terms score 0 and never rank;
rows that repeat an id are documents of their own; a null id ranks after the
others of its score. A query row that repeats id and text is one query; rows
of one id and several texts are queries of their own, each ranked from 1. A
query without terms has no rows. Other columns are not read.

Scaling: the text is read for the index, for the document counts of the query
terms, and twice through a join with scored ids; only bounded lists per task
and query are shuffled. Copies of one document cost one exact score each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, documents, release, staged, table
from .terms import query_blocks, term_chunks, terms

# Signature parameters: a key sets 8 bits of 16 per key, so that in the fullest
# documents of a block a foreign key is found by chance in CHANCE of all cases.
BITS, HASHES = 16, 8
CHANCE = (1 - math.exp(-HASHES / BITS)) ** HASHES
LEVELS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128)
GROUP_BYTES = 4 << 20    # text that is cut into blocks at a time
BLOCK_DOCS = 1024
BLOCK_CELLS = 1 << 25    # bits of a block, but for a single larger document
TOP = 50
# Candidates are broadcast up to this many rows (of at most 1,024 queries) and
# pairs with queries; beyond it documents and candidates are joined by shuffle.
BROADCAST_ROWS, BROADCAST_PAIRS = 200_000, 2_000_000

# added to a term's hash, one per level
_LEVEL_SHIFT = np.arange(len(LEVELS), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


# --- signatures -----------------------------------------------------------------

def term_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """Rows of the bits of (term, level) keys in a matrix of ``width`` rows."""
    h = hashes + _LEVEL_SHIFT[level]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    at = first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (at % np.uint64(width)).astype(np.int64)


class Counts:
    """Terms of a document: hashes, occurrences, and the total."""

    def __init__(self, text: str | None):
        counted: Counter[bytes] = Counter()
        for chunk in term_chunks(text):
            counted.update(chunk)
        self.hashes = term_hashes(list(counted))
        self.tf = np.fromiter(counted.values(), np.int64, len(counted))
        self.n = int(self.tf.sum())
        self.keys = int(np.searchsorted(LEVELS, self.tf, "right").sum())


def pack(docs: Sequence[Counts]) -> tuple[int, np.ndarray]:
    """(rows, slices) of a block: slices are packed bits, rows x bytes."""
    width = max(64, BITS * max(d.keys for d in docs))
    cells = np.zeros((width, -(-len(docs) // 8) * 8), bool)
    column = np.repeat(np.arange(len(docs)), [len(d.tf) for d in docs])
    hashes, tf = np.concatenate([d.hashes for d in docs]), np.concatenate([d.tf for d in docs])
    for level, least in enumerate(LEVELS):
        if level:
            some = tf >= least
            hashes, tf, column = hashes[some], tf[some], column[some]
        if not len(tf):
            break
        cells[_places(hashes, level, width), column[:, None]] = True
    return width, np.packbits(cells, axis=1, bitorder="little")


def cut_blocks(keys: Sequence[int]) -> Iterator[list[int]]:
    """Documents in order of their keys, cut where a block would be too large
    or its largest document half as large again as its smallest."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    block: list[int] = []
    for i in order:
        if block and (len(block) >= BLOCK_DOCS or keys[i] > 1.5 * max(keys[block[0]], 32)
                      or BITS * keys[i] * (len(block) + 1) > BLOCK_CELLS):
            yield block
            block = []
        block.append(i)
    if block:
        yield block


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block: ids, lens (terms of each), total (their sum), width
    and slices. Documents without terms are in no block."""
    arrow_batches(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(plain.schema["id"].dataType)),
                           T.StructField("lens", T.ArrayType(T.LongType())), T.StructField("total", T.LongType()),
                           T.StructField("width", T.LongType()), T.StructField("slices", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        ids, counts, size = [], [], 0
        id_type = None

        def blocks():
            for block in cut_blocks([c.keys for c in counts]):
                width, slices = pack([counts[i] for i in block])
                lens = [counts[i].n for i in block]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([[ids[i] for i in block]], pa.list_(id_type)), pa.array([lens], pa.list_(pa.int64())),
                     pa.array([sum(lens)], pa.int64()), pa.array([width], pa.int64()),
                     pa.array([slices.tobytes()], pa.binary())], ["ids", "lens", "total", "width", "slices"])

        for batch in batches:
            id_type = batch.schema.field("id").type
            for key, text in zip(batch.column("id"), batch.column("text")):
                text = text.as_py()
                found = Counts(text)
                if not found.n:
                    continue
                ids.append(key.as_py())
                counts.append(found)
                size += len(text)
                if size >= GROUP_BYTES:
                    yield from blocks()
                    ids, counts, size = [], [], 0
        if counts:
            yield from blocks()

    return plain.mapInArrow(run, schema)


# --- queries --------------------------------------------------------------------

class Queries:
    """A block of queries: distinct terms, and each query's term numbers."""

    def __init__(self, block: Sequence[tuple]):
        number: dict[bytes, int] = {}
        self.keys = [key for key, _ in block]
        self.terms = [np.array(sorted({number.setdefault(w, len(number)) for w in terms(text)}), np.int64)
                      for _, text in block]
        self.vocabulary = list(number)
        self.number = number


class Weighted:
    """Queries with the corpus statistics that scores need."""

    def __init__(self, queries: Queries, docs: int, total: int, df: dict[int, int]):
        self.queries, self.docs, self.total = queries, docs, total
        self.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(t, 0) + 1)))
                                 for t in range(len(queries.vocabulary))], np.float64)
        held = np.array([df.get(t, 0) for t in range(len(queries.vocabulary))], np.float64)
        self.likely = self.weights * held / (held + CHANCE * docs)

    def damping(self, n):
        """20 * m of documents of ``n`` terms."""
        return 20 * (50 + (50 * n * self.docs) // self.total)

    def bounds(self, lens: np.ndarray, width: int, slices: np.ndarray, hashes: np.ndarray,
               likely: bool = False) -> np.ndarray:
        """Upper bounds of all scores of a block: queries x documents. ``likely``:
        the same sums with lowered weights, for the choice of what to try."""
        weights = self.likely if likely else self.weights
        size = len(lens)
        damping = np.array([self.damping(int(n)) for n in lens], np.int64)
        gain = np.zeros((len(hashes), size))
        live, before = np.arange(len(hashes)), None
        for level in range(len(LEVELS)):
            bits = np.bitwise_and.reduce(slices[_places(hashes[live], level, width)], axis=1)
            if before is not None:
                bits &= before
            some = bits.any(axis=1)
            live, before = live[some], bits[some]
            if not len(live):
                break
            most = np.minimum(lens, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else lens
            reach = (1_000_000_000 * most) // (1000 * most + damping)
            found = np.unpackbits(before, axis=1, count=size, bitorder="little").view(bool)
            if level == 0:
                gain[live] = found * reach.astype(np.float64)
            else:
                row, column = np.nonzero(found)
                gain[live[row], column] = reach[column]
        return np.stack([weights[t] @ gain[t] for t in self.queries.terms])

    def scores(self, text: str | None, wanted: Sequence[int]) -> list[int]:
        """Exact scores of one document for the queries ``wanted``."""
        counted: Counter[bytes] = Counter()
        for chunk in term_chunks(text):
            counted.update(chunk)
        damping = self.damping(sum(counted.values()))
        tf = {}
        for i in wanted:
            for t in self.queries.terms[i]:
                if t not in tf:
                    f = counted.get(self.queries.vocabulary[t], 0)
                    tf[t] = int(self.weights[t]) * ((1_000_000_000 * f) // (1000 * f + damping)) if f else 0
        return [sum(tf[t] for t in self.queries.terms[i]) for i in wanted]


def document_counts(docs: DataFrame, queries: Queries, text_col: str = "text") -> dict[int, int]:
    """Documents that hold each query term, over all documents."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: Counter[bytes] = Counter()
        vocabulary = frozenset(queries.vocabulary)
        for batch in batches:
            for text in batch.column(0):
                found: set[bytes] = set()
                for chunk in term_chunks(text.as_py()):
                    found |= vocabulary.intersection(chunk)
                held.update(found)
        yield pa.RecordBatch.from_arrays([pa.array([queries.number[w] for w in held], pa.int64()),
                                          pa.array(list(held.values()), pa.int64())], ["term", "df"])

    part = docs.select(F.col(f"`{text_col}`")).mapInArrow(run, "term long, df long")
    return {r.term: r.df for r in part.groupBy("term").agg(F.sum("df").alias("df")).collect()}


# --- search ---------------------------------------------------------------------

def _each_block(index: DataFrame, weighted: Weighted, per_block, at_end, schema, likely: bool = False) -> DataFrame:
    """Map the index: ``per_block(ids, bounds)`` and ``at_end()`` of a new state
    per task yield (columns) of the schema."""
    names = schema.fieldNames()
    types = [pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.float64() if isinstance(f.dataType, T.DoubleType)
             else pa.list_(pa.int32()) if isinstance(f.dataType, T.ArrayType) else None for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hashes = term_hashes(weighted.queries.vocabulary)
        state: dict = {}
        id_type = None

        def out(columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(columns, types)], names)

        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                lens = np.array(batch.column("lens")[i].values, np.int64)
                slices = np.frombuffer(batch.column("slices")[i].as_buffer(), np.uint8).reshape(-1, -(-len(lens) // 8))
                bounds = weighted.bounds(lens, batch.column("width")[i].as_py(), slices, hashes, likely)
                columns = per_block(state, batch.column("ids")[i].values.to_pylist(), bounds)
                if columns is not None:
                    yield out(columns)
        if state:
            yield out(at_end(state))

    return index.mapInArrow(run, schema)


def _likely_best(index: DataFrame, weighted: Weighted, top: int) -> DataFrame:
    """(query, id) of the ``top`` documents of each query that are tried first."""
    def per_block(state: dict, ids: list, bounds: np.ndarray):
        ids = np.array([*ids, None], object)[:-1]  # one-dimensional whatever the ids are
        if state:
            bounds = np.concatenate([state["bounds"], bounds], axis=1)
            ids = np.concatenate([state["ids"], np.broadcast_to(ids, (len(bounds), len(ids)))], axis=1)
        else:
            ids = np.broadcast_to(ids, bounds.shape)
        if bounds.shape[1] > top:
            best = np.argpartition(-bounds, top - 1, axis=1)[:, :top]
            bounds, ids = np.take_along_axis(bounds, best, 1), np.take_along_axis(ids, best, 1)
        state["bounds"], state["ids"] = bounds, ids

    def at_end(state: dict):
        row, column = np.nonzero(state["bounds"] > 0)
        return row, state["bounds"][row, column], state["ids"][row, column].tolist()

    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("bound", T.DoubleType()),
                           T.StructField("id", index.schema["ids"].dataType.elementType)])
    best = _each_block(index, weighted, per_block, at_end, schema, likely=True)
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "id")
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select("query", "id")


def _reaching(index: DataFrame, weighted: Weighted, floors: np.ndarray) -> DataFrame:
    """(id, queries) of every document whose bound reaches a query's floor."""
    def per_block(state: dict, ids: list, bounds: np.ndarray):
        reached = bounds >= floors[:, None]
        some = np.flatnonzero(reached.any(axis=0))
        if len(some):
            return [ids[d] for d in some], [np.flatnonzero(reached[:, d]).tolist() for d in some]

    schema = T.StructType([T.StructField("id", index.schema["ids"].dataType.elementType),
                           T.StructField("queries", T.ArrayType(T.IntegerType()))])
    return _each_block(index, weighted, per_block, None, schema)


def _scored(docs: DataFrame, weighted: Weighted, wanted: DataFrame, top: int, small: bool) -> DataFrame:
    """(query, id, score) of the best ``top`` documents of each task, exactly, of
    the documents and queries of ``wanted`` (one row per id)."""
    pairs = wanted.select(F.col("id").alias("want"), "queries")
    joined = docs.join(F.broadcast(pairs) if small else pairs, F.col("id").eqNullSafe(F.col("want"))) \
        .select("id", "text", "queries")
    schema = T.StructType([T.StructField("query", T.IntegerType()), docs.schema["id"],
                           T.StructField("score", T.LongType())])

    def order(found):
        return -found[0], found[1] is None, found[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        best: dict[int, list] = {}
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for key, text, queries in zip(*(batch.column(c) for c in ("id", "text", "queries"))):
                queries, key = queries.as_py(), key.as_py()
                for q, score in zip(queries, weighted.scores(text.as_py(), queries)):
                    if score > 0:
                        mine = best.setdefault(q, [])
                        mine.append((score, key))
                        if len(mine) >= 4 * top:
                            mine.sort(key=order)
                            del mine[top:]
        flat = [(q, key, score) for q, mine in best.items() for score, key in sorted(mine, key=order)[:top]]
        if flat:
            q, key, score = zip(*flat)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(key, id_type),
                                              pa.array(score, pa.int64())], ["query", "id", "score"])

    return joined.mapInArrow(run, schema)


def _by_id(pairs: DataFrame) -> DataFrame:
    """One row per id with its queries: at most a block of queries a group."""
    return pairs.groupBy("id").agg(F.collect_set("query").alias("queries"))


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           query_col: str = "item_id", query_text: str = "text", index: DataFrame | None = None) -> DataFrame:
    """The ``top`` documents of each query: query_col, rank, id_col, score.
    ``index``: one that ``build_index`` made of these documents."""
    spark = docs.sparkSession
    if index is None:
        index = staged(spark, build_index(docs, id_col, text_col), "signatures")
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    size = index.agg(F.sum(F.size("ids")).alias("docs"), F.sum("total").alias("total")).first()
    key_type = queries.schema[query_col].dataType
    result = T.StructType([T.StructField(query_col, key_type), T.StructField("rank", T.IntegerType()),
                           T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    ranked = []
    for block in (query_blocks(queries, query_col, query_text) if size.docs else ()):
        asked = Queries(block)
        if not asked.vocabulary:
            continue
        weighted = Weighted(asked, int(size.docs), int(size.total), document_counts(plain, asked, "text"))
        # at most top rows of each of at most QUERY_ROWS queries
        probes = staged(spark, _by_id(_likely_best(index, weighted, top)), "probes")
        tried = _best(_scored(plain, weighted, probes, top, small=True), top)
        floors = np.ones(len(asked.keys))
        for r in tried.where(F.col("rank") == top).select("query", "score").collect():
            floors[r["query"]] = r["score"]
        pairs = _reaching(index, weighted, floors).select("id", F.explode("queries").alias("query"))
        wanted = staged(spark, _by_id(pairs), "candidates")
        many = wanted.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("queries")).alias("pairs")).first()
        small = many.rows <= BROADCAST_ROWS and (many.pairs or 0) <= BROADCAST_PAIRS
        keys = spark.createDataFrame(list(enumerate(asked.keys)), T.StructType(
            [T.StructField("query", T.IntegerType()), T.StructField(query_col, key_type)]))
        best = _best(_scored(plain, weighted, wanted, top, small), top)
        ranked.append(best.join(keys, "query").select(query_col, "rank", F.col("id").alias(id_col), "score"))
    if not ranked:
        return spark.createDataFrame([], result)
    return reduce(DataFrame.unionAll, ranked)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
