"""Substring dedup: repeated word windows, found with FM-indexes per shard.

A word is removed if a window of ``WINDOW`` words that covers it also starts
in a document with a smaller id. Windows are judged on the input.

1. *Anchors.* In every window the least hash of its runs of ``GRAM`` words is
   its anchor; equal windows have equal anchors. Spark keeps the anchors that
   occur under two ids or more (a map-side minimum and maximum), and joins them
   back to their places.
2. *Segments.* Around each such place the windows that share the anchor form
   one segment of words. Equal segments become one, with the least id, so
   thousands of copies of a passage are one row before anything is searched.
3. *Search.* Segments are dealt into shards by anchor, so all equal windows
   meet in one shard, of a bounded size: segments of an anchor with very many
   different ones are cut into single windows, dealt by their own hash. Each
   shard builds a compressed FM-index over its segments and streams their
   windows through it by backward search. The windows of an interval of
   suffixes get the least id of that interval. A segment that is the only one
   of its anchor has no other to meet: its windows keep its own least id.
4. *Removal.* The windows found under a smaller id go back to their documents,
   whose words are then removed and digested.

Words travel as 48 bits of their hash.

Defined results: null and empty texts have no words; a null id is neither
smaller nor larger than another, so nothing is removed from its rows nor
because of them; rows under one id are one document to the rule (a passage
repeated only among them stays); columns beyond key and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow, slices, staged
from .fm_index import FMIndex
from .words import Words, gram_hash, mix, prefix_sums, run_starts, span_hash, split_words

WINDOW = 13
GRAM = 5
SHARD = 2_000        # pieces in one index, about
HOT = 500            # different segments of one anchor beyond which they are cut
_REACH = WINDOW - GRAM + 1
_SALT = np.uint64(0xA0761D6478BD642F)
_WORD_BYTES = 6


def _slide(h: np.ndarray, width: int, best) -> np.ndarray:
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def _grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the run of words at each place, and for each place the least of
    the window that starts there (0 where no window does)."""
    g = gram_hash(w.hash, GRAM) | np.uint64(1)
    if len(w.hash) < WINDOW:
        return g, np.zeros(0, np.uint64)
    least = _slide(g, _REACH, np.minimum)
    least[~run_starts(w.bounds, len(w.hash), WINDOW)] = 0
    return g, least


def _anchors(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places that are the anchor of some window, and their hashes."""
    g, least = _grams(w)
    if len(least) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edge = np.zeros(_REACH - 1, np.uint64)
    top = _slide(np.concatenate([edge, least, edge]), _REACH, np.maximum)
    at = np.flatnonzero(top == g)
    return at, g[at]


def _source(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).withColumn(
        "tie", F.xxhash64(F.coalesce("text", F.lit(""))))


def anchor_table(src: DataFrame, places: bool) -> DataFrame:
    """(anchor, id) or, with ``places``, (anchor, id, tie, place) for every anchor."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            w = split_words(part.column("text"))
            at, h = _anchors(w)
            row = np.searchsorted(w.bounds, at, "right") - 1
            ids = np.asarray(part.column("id"))
            cols = [pa.array(h.view(np.int64)), pa.array(ids[row])]
            if places:
                ties = np.asarray(part.column("tie"))
                cols += [pa.array(ties[row]), pa.array((at - w.bounds[row]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["anchor", "id", "tie", "place"])
            else:
                yield pa.RecordBatch.from_arrays(cols, names=["anchor", "id"])

    known = src.where(F.col("id").isNotNull())
    if places:
        return map_arrow(known, run, "anchor bigint, id bigint, tie bigint, place int")
    return map_arrow(known.select("id", "text"), run, "anchor bigint, id bigint")


def _packed(values: np.ndarray) -> np.ndarray:
    """48 bits of each hash, as bytes (n x 6)."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:])


def _unpacked(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // _WORD_BYTES, 8), np.uint8)
    out[:, :_WORD_BYTES] = data.reshape(-1, _WORD_BYTES)
    return out.view("<u8").ravel().astype(np.uint64)


def _spans(data: np.ndarray, first: np.ndarray, after: np.ndarray) -> pa.Array:
    """Binary column of the rows ``data[first:after]``."""
    size = after - first
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - ends + size, size)
    offsets = np.concatenate([[0], ends]).astype(np.int64) * data.shape[1]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[at].tobytes())]).cast(pa.binary())


def _keys(sums: tuple[np.ndarray, np.ndarray], first: np.ndarray, after: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Two independent hashes of runs of words."""
    size = mix((after - first).astype(np.uint64))
    return tuple(pa.array((span_hash(s, first, after) ^ size).view(np.int64)) for s in sums)


def _two_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return prefix_sums(values), prefix_sums(mix(values ^ _SALT))


def segment_table(src: DataFrame, places: DataFrame) -> DataFrame:
    """Segments around the given places (id, tie, places), one row each:
    id, tie, first, windows, key_a, key_b, anchor, words."""
    rows = src.join(places, ["id", "tie"]).select("id", "tie", "text", "places")

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            w = split_words(part.column("text"))
            g, least = _grams(w)
            lists = part.column("places")
            row = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths()))
            at = np.asarray(lists.flatten()).astype(np.int64) + w.bounds[row]
            low, high = np.full(len(at), -1, np.int64), np.full(len(at), -1, np.int64)
            for d in range(_REACH):  # windows that start d words before the anchor
                s = at - d
                own = (s >= 0) & (s < len(least))
                own[own] = least[s[own]] == g[at[own]]
                low = np.where(own, s, low)
                high = np.where(own & (high < 0), s, high)
            # each run of windows once, though it may hold its anchor twice
            row, at, low, high = (x[low >= 0] for x in (row, at, low, high))
            first, after = low, high + WINDOW
            values = _unpacked(_packed(w.hash).ravel())
            key_a, key_b = _keys(_two_sums(values), first, after)
            yield pa.RecordBatch.from_arrays([
                part.column("id").take(pa.array(row)), part.column("tie").take(pa.array(row)),
                pa.array((first - w.bounds[row]).astype(np.int32)), pa.array((high - low + 1).astype(np.int32)),
                key_a, key_b, pa.array(g[at].view(np.int64)), _spans(_packed(w.hash), first, after)],
                names=["id", "tie", "first", "windows", "key_a", "key_b", "anchor", "words"])

    return map_arrow(rows, run, "id bigint, tie bigint, first int, windows int, key_a bigint, key_b bigint, "
                                "anchor bigint, words binary")


def _least(words: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window of the pieces the least id under which it starts."""
    index = FMIndex(_unpacked(np.frombuffer(b"".join(words.to_pylist()), np.uint8)), lengths, WINDOW)
    n = np.maximum(lengths - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    low, high = index.search(index.start[owner] + offset, WINDOW)
    of_suffix = ids[np.minimum(np.searchsorted(index.start, index.suffixes, "right") - 1, len(ids) - 1)]
    # intervals of one length are equal or apart
    start, back = np.unique(low, return_inverse=True)
    stop = np.zeros(len(start), np.int64)
    stop[back] = high
    return np.minimum.reduceat(np.append(of_suffix, 0), np.column_stack([start, stop]).ravel())[::2][back]


def search(pieces: DataFrame, count: int) -> DataFrame:
    """For pieces (key_a, key_b, route, id, words): the least id under which
    each of their windows starts, as (key_a, key_b, least array<bigint>).
    Pieces with an equal window have to have an equal route."""
    shards = max(1, -(-count // SHARD))

    def run(t: pa.Table) -> pa.Table:
        words = t.column("words").combine_chunks()
        lengths = np.asarray(pc.binary_length(words)).astype(np.int64) // _WORD_BYTES
        ids = np.asarray(t.column("id").combine_chunks())
        n = np.maximum(lengths - WINDOW + 1, 0)
        least = np.repeat(ids, n)
        # the windows of a piece alone on its route start under no other id
        _, back, pieces_on = np.unique(np.asarray(t.column("route").combine_chunks()), return_inverse=True, return_counts=True)
        met = pieces_on[back] > 1
        if met.any():
            least[np.repeat(met, n)] = _least(words.filter(pa.array(met)), lengths[met], ids[met])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(least))
        return pa.table({"key_a": t.column("key_a"), "key_b": t.column("key_b"), "least": lists})

    return (pieces.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
            .groupBy("shard").applyInArrow(run, "key_a bigint, key_b bigint, least array<bigint>"))


def _windows(pieces: DataFrame) -> DataFrame:
    """The single windows of pieces: (of_a, of_b, offset, key_a, key_b, id, words)."""

    def run(batch: pa.RecordBatch):
        words = batch.column("words")
        raw = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
        lengths = np.asarray(pc.binary_length(words)).astype(np.int64) // _WORD_BYTES
        n = lengths - WINDOW + 1
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(np.cumsum(lengths) - lengths, n) + offset
        key_a, key_b = _keys(_two_sums(_unpacked(raw)), first, first + WINDOW)
        take = pa.array(owner)
        yield pa.RecordBatch.from_arrays([
            batch.column("key_a").take(take), batch.column("key_b").take(take), pa.array(offset.astype(np.int32)),
            key_a, key_b, batch.column("id").take(take), _spans(raw.reshape(-1, _WORD_BYTES), first, first + WINDOW)],
            names=["of_a", "of_b", "offset", "key_a", "key_b", "id", "words"])

    return map_arrow(pieces.select("key_a", "key_b", "id", "words"), run,
                     "of_a bigint, of_b bigint, offset int, key_a bigint, key_b bigint, id bigint, words binary")


def _least_by_piece(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """(key_a, key_b, least) of all segments."""
    hot = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("anchor")
    hot = staged(spark, hot, "hot")
    plain = pieces.join(hot, "anchor", "left_anti").withColumnRenamed("anchor", "route")
    found = staged(spark, search(plain, pieces.count()), "found")
    if hot.isEmpty():
        return found
    cut = staged(spark, _windows(pieces.join(hot, "anchor", "left_semi")), "windows")
    single = staged(spark, cut.groupBy("key_a", "key_b").agg(F.min("id").alias("id"), F.first("words").alias("words"))
                    .withColumn("route", F.col("key_a")), "single")
    least = search(single, single.count()).select("key_a", "key_b", F.get("least", F.lit(0)).alias("least"))
    back = (cut.select("of_a", "of_b", "offset", "key_a", "key_b").join(least, ["key_a", "key_b"])
            .groupBy(F.col("of_a").alias("key_a"), F.col("of_b").alias("key_b"))
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("offset", "least"))), lambda x: x["least"]).alias("least")))
    return found.unionByName(staged(spark, back, "found"))


def repeated_windows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, tie, spans): the runs of windows of each document that also start
    under a smaller id, as arrays of (first word, number of windows)."""
    spark = df.sparkSession
    src = _source(df, key, text)
    shared = (anchor_table(src, False).groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
              .where("low < high").select("anchor"))
    shared = staged(spark, shared, "anchors")
    places = (anchor_table(src, True).join(shared, "anchor", "left_semi")
              .groupBy("id", "tie").agg(F.array_sort(F.collect_set("place")).alias("places")))
    places = staged(spark, places, "places")
    segments = staged(spark, segment_table(src, places), "segments")
    pieces = (segments.groupBy("key_a", "key_b").agg(
        F.min("id").alias("id"), F.first("words").alias("words"), F.first("anchor").alias("anchor")))
    pieces = staged(spark, pieces, "pieces")
    least = _least_by_piece(spark, pieces)
    marked = (segments.select("id", "tie", "first", "key_a", "key_b").distinct().join(least, ["key_a", "key_b"])
              .select("id", "tie", "first", F.posexplode("least").alias("i", "x")).where("x < id")
              .select("id", "tie", (F.col("first") + F.col("i")).alias("window")))
    return staged(spark, marked.groupBy("id", "tie").agg(F.collect_set("window").alias("windows")), "marked")


def removed_words(n: int, windows: list[int] | None) -> np.ndarray:
    """Which of n words a window covers, given the windows' first words."""
    if windows is None or len(windows) == 0:
        return np.zeros(n, bool)
    step = np.zeros(n + WINDOW + 1, np.int32)
    at = np.asarray(windows, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return np.cumsum(step[:n]) > 0


def cut_text(df: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """One row per input row: the ``keep`` columns, n_words, n_removed and kept
    (the kept words, joined by one space)."""
    marked = repeated_windows(df, key, text).select(
        F.col("id").alias("_id"), F.col("tie").alias("_tie"), F.col("windows").alias("_windows"))
    rows = df.select(*keep, F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    kept_schema = rows.drop("_key", "_text").schema
    rows = (rows.withColumn("_tied", F.xxhash64(F.coalesce("_text", F.lit(""))))
            .join(marked, (F.col("_key") == F.col("_id")) & (F.col("_tied") == F.col("_tie")), "left")
            .select(*keep, "_text", "_windows"))

    def run(batch: pa.RecordBatch):
        for part in slices(batch, batch.num_columns - 2):
            texts, windows = part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1)
            n_words, n_removed, kept = [], [], []
            for t, own in zip(texts, windows):
                words = (t or "").encode().split()
                gone = removed_words(len(words), np.asarray(own.values) if own.is_valid else None)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                if n_removed[-1]:
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-2], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*part.schema.names[:-2], "n_words", "n_removed", "kept"])

    kept_ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept_schema)
    return map_arrow(rows, run, f"{kept_ddl}n_words bigint, n_removed bigint, kept string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_text(documents(spark, sf_dir), "doc_id", "text", "doc_id").select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
