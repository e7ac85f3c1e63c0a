"""Benchmark decontamination with suffix arrays of the training text.

Every task cuts its documents into shards of about a million words, numbers
the words of a shard and sorts all its suffixes (by prefix doubling; a round
sorts only what earlier rounds left tied, up to the length of the longest
benchmark item). Every suffix of every item is then looked up: its interval
of the suffix array is narrowed word by word, by binary search for all
suffixes at once, which gives

* the longest verbatim match of the suffix in the shard, and
* at ``window`` words (or the whole item, if it is shorter) all its locations.

A word of a document within any such location is hit. A shard borders on the
next one only inside a document that is longer than a shard; such a document's
pieces overlap, so that no window is lost between them.

Defined results: a null text has no words; an item of null text or without
words has no windows; items that repeat an id are one item with the windows of
all its rows; an item with a null id hits like any other and counts as one
item, but has no id to list. Repeated documents are rows of their own; other
columns are not read. An empty table of items hits nothing.

Scaling: documents are only mapped, never shuffled. Items are handed out in
blocks of a bounded size; each block is one further pass in the same stage.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, documents, release, table
from .terms import SPLIT_BYTES, query_blocks, term_chunks, terms

WINDOW = 10
SHARD_WORDS = 1 << 20  # words in one suffix array: some 60 MB of work arrays


# --- suffix array ---------------------------------------------------------------

def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``words`` (numbers from 0) in the order of their suffixes, each
    compared by its first ``depth`` words at least; a suffix that ends is less
    than one that goes on."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    if n < 2:
        return order
    sorted_words = words[order]
    # rank of a suffix: place of the first one that is equal to it so far, plus 1
    fresh = np.r_[True, sorted_words[1:] != sorted_words[:-1]]
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    tied = _tied(fresh)
    known = 1
    while known < depth and len(tied):
        at = order[tied]
        first = rank[at]
        then = rank[np.minimum(at + known, n)]  # rank 0: the text has ended
        key = first * (n + 1) + then
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        new = np.r_[True, key[1:] != key[:-1]]
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        tied = tied[_tied(new)]
        known *= 2
    return order


def _tied(fresh: np.ndarray) -> np.ndarray:
    """Places of those that equal a neighbour, given which begin a group."""
    last = np.r_[fresh[1:], True]
    return np.flatnonzero(~(fresh & last))


class Found:
    """What a lookup found: longest match and its interval of the suffix array
    per pattern, and the interval at each pattern's ``need`` words (empty if
    the match is shorter)."""

    def __init__(self, n: int):
        self.longest = np.zeros(n, np.int64)
        self.low, self.high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.longest_low = np.zeros(n, np.int64)


def look_up(words: np.ndarray, order: np.ndarray, patterns: np.ndarray, start: np.ndarray, end: np.ndarray,
            need: np.ndarray) -> Found:
    """Binary search of every pattern ``patterns[start:end]`` (-1: a word that
    the shard lacks)."""
    found = Found(len(start))
    n = len(words)
    ended = np.r_[words, -2]  # a suffix that has ended
    live = np.flatnonzero(start < end)
    low, high = np.zeros(len(live), np.int64), np.full(len(live), n, np.int64)
    depth = 0
    while len(live) and n:
        word = patterns[start[live] + depth]
        low, high = (_bound(ended, order, low, high, depth, word, False),
                     _bound(ended, order, low, high, depth, word, True))
        some = (low < high) & (word >= 0)
        live, low, high = live[some], low[some], high[some]
        depth += 1
        found.longest[live], found.longest_low[live] = depth, low
        here = need[live] == depth
        found.low[live[here]], found.high[live[here]] = low[here], high[here]
        more = start[live] + depth < end[live]
        live, low, high = live[more], low[more], high[more]
    return found


def _bound(ended: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray,
           above: bool) -> np.ndarray:
    """First place of [low, high) whose word at ``depth`` is not less than
    (``above``: is greater than) the pattern's."""
    low, high = low.copy(), high.copy()
    last = len(ended) - 1
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) >> 1
        got = ended[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, last)]
        right = (got <= word) if above else (got < word)
        low = np.where(open_ & right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)


# --- benchmark items ------------------------------------------------------------

class Items:
    """A block of items: word numbers of all, and every suffix of each."""

    def __init__(self, block: Sequence[tuple], window: int):
        self.ids: list = []          # distinct item ids
        self.vocabulary: list[bytes] = []
        number: dict[bytes, int] = {}
        ids: dict = {}
        words, start, end, need, item = [], [], [], [], []
        for key, text in block:
            own = [number.setdefault(w, len(number)) for w in terms(text)]
            if not own:
                continue
            k = ids.setdefault(key, len(ids))
            base, size = len(words), min(window, len(own))
            words += own
            for p in range(len(own)):
                start.append(base + p)
                end.append(base + len(own))
                need.append(size)
                item.append(k)
        self.ids, self.vocabulary = list(ids), list(number)
        self.words = np.array(words, np.int64)
        self.start, self.end = np.array(start, np.int64), np.array(end, np.int64)
        self.need, self.item = np.array(need, np.int64), np.array(item, np.int64)
        self.depth = int((self.end - self.start).max()) if words else 0


# --- shards ---------------------------------------------------------------------

class Shard:
    """Word numbers of consecutive pieces of documents; 0 parts the pieces."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict(itertools.count(1).__next__)
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.pieces: list[tuple[int, int, int]] = []  # (row, first word of the row, place in the shard)

    def add(self, row: int, first: int, words: list[bytes]) -> None:
        self.pieces.append((row, first, self.size))
        own = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.parts += [own, np.zeros(1, np.int64)]
        self.size += len(words) + 1

    def search(self, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[int], int]]:
        """Per piece with a match: (row, starts and ends of hit runs of words in
        the row, item numbers, words of the longest match)."""
        words = np.concatenate(self.parts)
        order = suffix_array(words, items.depth)
        known = np.array([self.number.get(w, -1) for w in items.vocabulary], np.int64)
        found = look_up(words, order, known[items.words], items.start, items.end, items.need)
        size = found.high - found.low
        hit = np.flatnonzero(size)
        if not len(hit):
            return
        # all locations of all windows, dealt to pieces
        take = np.repeat(found.low[hit] - np.r_[0, np.cumsum(size[hit])[:-1]], size[hit]) + np.arange(size[hit].sum())
        places, of = order[take], np.repeat(hit, size[hit])
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + items.need[of], -1)
        covered = np.r_[False, np.cumsum(cover[:-1]) > 0, False]
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        run_start, run_end = edges[::2], edges[1::2]
        bounds = np.array([p[2] for p in self.pieces])
        piece = np.searchsorted(bounds, places, "right") - 1
        pairs = np.unique(piece * len(items.ids) + items.item[of])
        longest = np.zeros(len(self.pieces), np.int64)
        np.maximum.at(longest, piece, found.longest[of])
        run_piece = np.searchsorted(bounds, run_start, "right") - 1
        for i in np.unique(piece):
            row, first, at = self.pieces[i]
            mine = slice(*np.searchsorted(run_piece, [i, i + 1]))
            lo, hi = np.searchsorted(pairs, [i * len(items.ids), (i + 1) * len(items.ids)])
            yield (row, run_start[mine] - at + first, run_end[mine] - at + first,
                   (pairs[lo:hi] - i * len(items.ids)).tolist(), int(longest[i]))


def scan(texts: Iterable[str | None], items: Items, shard_words: int = SHARD_WORDS,
         split_bytes: int = SPLIT_BYTES) -> tuple[list, list, list, list]:
    """Of each text: its number of words, hit runs [(start, end)...] merged,
    item numbers and the longest match among those that hold a window."""
    count, runs, hits, longest = [], {}, {}, {}
    overlap = max(items.depth - 1, 0)

    def close(shard: Shard) -> None:
        for row, a, b, numbers, most in shard.search(items):
            runs.setdefault(row, []).append(np.stack([a, b]))
            hits.setdefault(row, set()).update(numbers)
            longest[row] = max(longest.get(row, 0), most)

    shard = Shard()
    for row, text in enumerate(texts):
        n, before = 0, []
        for words in term_chunks(text, split_bytes):
            n += len(words)
            if not items.depth:
                continue
            at = n - len(words) - len(before)
            words = before + words
            for cut in range(0, max(len(words) - overlap, 1), shard_words):
                piece = words[cut:cut + shard_words + overlap]
                shard.add(row, at + cut, piece)
                if shard.size >= shard_words:
                    close(shard)
                    shard = Shard()
            before = words[len(words) - overlap:] if overlap else []
        count.append(n)
    if shard.size:
        close(shard)
    return (count, [_merged(runs.get(r)) for r in range(len(count))],
            [sorted(hits.get(r, ())) for r in range(len(count))], [longest.get(r, 0) for r in range(len(count))])


def _merged(runs: list[np.ndarray] | None) -> np.ndarray:
    """Disjoint runs in order: 2 x n starts and ends."""
    both = np.concatenate([np.zeros((2, 0), np.int64), *(runs or ())], axis=1)
    if not both.size:
        return both
    both = both[:, np.argsort(both[0], kind="stable")]
    reach = np.maximum.accumulate(both[1])
    new = np.r_[True, both[0][1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(new) - 1]
    return np.stack([both[0][new], reach[last]])


# --- operator -------------------------------------------------------------------

def find_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                 carry: str | None = None) -> DataFrame:
    """Per row of ``docs``: its id, n_words, ``hits`` (disjoint runs of hit
    words, array of start and length in words), ``items`` (ids whose windows
    occur, as strings, sorted), n_items, ``longest`` (words of the longest
    verbatim match that holds a window; 0 without one), and the column
    ``carry``, if given."""
    spark = docs.sparkSession
    arrow_batches(spark)
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                        *([F.col(f"`{carry}`").alias("carry")] if carry else []))
    run = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    added = [T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(run)),
             T.StructField("items", T.ArrayType(T.StringType())), T.StructField("n_items", T.LongType()),
             T.StructField("longest", T.LongType())]
    found = plain
    for block in itertools.chain(query_blocks(items, item_col, item_text), [None]):
        if block is None and found is not plain:
            break  # at least one pass, so that words are counted
        schema = T.StructType(plain.schema.fields + added)
        found = found.mapInArrow(_searcher(block or [], window, found is plain), schema)
    return found.drop("text")


def _searcher(block: Sequence[tuple], window: int, first: bool):
    names = [None if key is None else str(key) for key, _ in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        items = Items(list(zip(names, (t for _, t in block))), window)
        for batch in batches:
            if not batch.num_rows:
                continue
            count, runs, hits, longest = scan((t.as_py() for t in batch.column("text")), items)
            ids = [[items.ids[i] for i in h] for h in hits]
            if first:
                columns, total = list(batch.columns), [len(i) for i in ids]
            else:  # what earlier blocks of items found
                keep = batch.num_columns - 5
                columns = list(batch.columns[:keep])
                old = [c.to_pylist() for c in batch.columns[keep:]]
                runs = [_merged([r, np.array([[x["start"] for x in o], [x["start"] + x["length"] for x in o]], np.int64)])
                        for r, o in zip(runs, old[1])]
                # blocks follow the ids' order, so one id may end a block and begin the next
                total = [n + len(i) - sum(x in o or (x is None and n > len(o)) for x in i)
                         for n, i, o in zip(old[3], ids, map(set, old[2]))]
                ids = [[*o, *(x for x in i if x not in set(o))] for o, i in zip(old[2], ids)]
                longest = [max(a, b) for a, b in zip(longest, old[4])]
            ids = [sorted((x for x in i if x is not None), key=lambda x: x.encode()) for i in ids]
            hit = [[{"start": int(a), "length": int(b - a)} for a, b in r.T] for r in runs]
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            columns += [pa.array(count, pa.int64()), pa.array(hit, span), pa.array(ids, pa.list_(pa.string())),
                        pa.array(total, pa.int64()), pa.array(longest, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:len(columns) - 5], "n_words", "hits",
                                                       "items", "n_items", "longest"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no window of an item."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kept = find_matches(whole, items, "id", "text", carry="row", **kw).where(F.col("n_items") == 0)
    return kept.select(*(F.col(f"carry.`{c}`").alias(c) for c in docs.columns))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_matches(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
