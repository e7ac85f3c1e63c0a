"""Near-duplicates by order MinHash, verified by banded alignment.

1. *Sketch.* Words are runs without white space; k-mers are consecutive words,
   labelled by which occurrence in the text they are. ``TIERS`` gives their
   size by the number of words, as changes leave short texts few long k-mers;
   ranges overlap so that two texts of a similar length are in one. For each of
   ``SKETCHES`` hash functions the ``PICK`` least labelled k-mers are taken
   and joined in text order to one key, so the key agrees where the same
   k-mers come in the same order: that follows edit similarity.
2. *Copies.* Texts with equal words are one node (a 128-bit digest), grouped
   with a map-side minimum; only nodes go on.
3. *Candidates.* Nodes with an equal key of the same sketch share a bucket, and
   every pair of a bucket is verified unless links found so far put it in one
   class. In a bucket of at most ``BLOCK`` nodes all pairs are candidates. In a
   larger one every node is first paired with the least and with the greatest
   one, and the links make components. Where a bucket then holds several
   components it is cut into blocks of at most about ``NODES`` nodes and
   ``WORDS`` words, and every pair of blocks is one work item: it passes by
   pairs whose length or word counts rule the similarity out (exact bounds) and
   verifies the others, the likeliest first, until those left are linked.
   Blocks of one large component are not compared with each other. Two nodes
   that share several buckets are compared in that of their first common key.
4. *Verify.* A pair is a link if the edit distance of its word sequences is at
   most (1 - ``SIMILAR``) of the longer one, found by banded alignment over
   the whole sequences.
5. *Classes* are the connected components of the links and copies.

Defined results: texts with fewer than four words match only copies (no other
text is similar enough); null
texts count as empty, and all empty texts are copies of each other; a class id
is the least document id in the class (null if it has none); repeated rows are
copies; columns beyond key and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import within
from .common import documents, map_arrow, narrowed, slices, staged
from .components import components
from .words import Words, gram_hash, mix, run_starts, split_words

# size of k-mers, and least and most words of a text; where a range begins, the
# one before goes on to 1 / SIMILAR of that
TIERS = ((2, 4, 40), (3, 32, 125), (5, 100, 1 << 62))
SIMILAR = 0.8
SKETCHES = 80
PICK = 2
BLOCK = 8
PAIRS = 2_000  # pairs of texts in a task, about
NODES, WORDS = 2048, 1 << 19  # of a block, about
# bins of the word counts that are compared before an alignment: first the few,
# then, for pairs that these leave, the many
BINS, FINE_BINS = 64, 1024
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, SKETCHES, dtype=np.uint64)
_SALTS = np.arange(1, SKETCHES * len(TIERS) + 1, dtype=np.uint64).reshape(len(TIERS), SKETCHES)
LONG = 10_000  # k-mers of a text beyond which its hash functions are not taken at once
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def digest(text: str | None) -> bytes:
    """Of the words, whatever white space is between them."""
    return hashlib.blake2b(b" ".join((text or "").encode().split()), digest_size=16).digest()


def labelled_kmers(w: Words, k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash (k-mer and occurrence) of every k-mer of the wanted rows,
    row by row."""
    g = gram_hash(w.hash, k)
    at = np.flatnonzero(run_starts(w.bounds, len(w.hash), k))
    row = np.searchsorted(w.bounds, at, "right") - 1
    at, row = at[wanted[row]], row[wanted[row]]
    g = g[at]
    own = g ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    same = np.zeros(len(own), np.int64)
    if len(own):
        s = own[order]
        new = np.concatenate([[True], s[1:] != s[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
        same[order] = np.arange(len(s)) - first
    return row, mix(g + same.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(arr: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys (of each of its tiers) and words of each text."""
    w = split_words(arr)
    size = np.diff(w.bounds)
    keys = [np.zeros(0, np.uint64)] * len(size)
    for (k, least, most), salts in zip(TIERS, _SALTS):
        wanted = (size >= least) & (size <= most)
        if not wanted.any():
            continue
        row, h = labelled_kmers(w, k, wanted)
        rows, first = np.unique(row, return_index=True)
        for r, a, b in zip(rows.tolist(), first.tolist(), [*first[1:].tolist(), len(h)]):
            keys[r] = np.concatenate([keys[r], _keys(h[a:b], salts)])
    return keys, size


def _keys(own: np.ndarray, salts: np.ndarray) -> np.ndarray:
    if len(own) <= LONG:
        picked = _least(own[None, :], _SEEDS[:, None])
    else:  # one hash function at a time
        picked = np.concatenate([_least(own[None, :], seed[None, None]) for seed in _SEEDS])
    picked.sort(axis=1)  # text order; -1 (too few k-mers) first
    key = salts
    for p in range(PICK):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.where(picked[:, p] >= 0, own[picked[:, p]], np.uint64(0)))
    return key


def _least(h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Places of the ``PICK`` least hashes for each seed; -1 where there are
    fewer k-mers."""
    v = (h ^ seeds) * np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    picked = np.full((len(v), PICK), -1, np.int64)
    every = np.arange(len(v))
    for p in range(min(PICK, v.shape[1])):
        at = v.argmin(axis=1)
        picked[:, p] = at
        v[every, at] = _MOST
    return picked


def node_of(text: str):
    """The node of a text column."""

    @F.pandas_udf("binary")
    def nodes(texts: pd.Series) -> pd.Series:
        return texts.map(digest, na_action=None)

    return nodes(F.coalesce(text, F.lit("")))


def sketch_table(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, node, n, keys) of every row."""
    src = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            keys, size = sketches(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([digest(t) for t in part.column("text").to_pylist()], pa.binary()),
                 pa.array(size, pa.int64()), pa.array([k.view(np.int64) for k in keys], pa.list_(pa.int64()))],
                names=["id", "node", "n", "keys"])

    return map_arrow(src, run, "id bigint, node binary, n bigint, keys array<bigint>")


def _close(n: str, m: str):
    """Lengths that leave room for the similarity."""
    return F.least(n, m) >= SIMILAR * F.greatest(n, m)


def _block_pairs(members: DataFrame) -> DataFrame:
    """All pairs of buckets of a bounded size."""
    a = members.select("bucket", F.col("node").alias("a"), F.col("n").alias("n_a"))
    b = members.select("bucket", F.col("node").alias("b"), F.col("n").alias("n_b"))
    return a.join(b, "bucket").where((F.col("a") > F.col("b")) & _close("n_a", "n_b")).select("a", "b")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each member with its bucket's least and greatest node."""
    def to_end(end: str) -> DataFrame:
        return (members.where((F.col("node") != F.col(f"{end}.node")) & _close("n", f"{end}.n"))
                .select(F.greatest("node", f"{end}.node").alias("a"), F.least("node", f"{end}.node").alias("b")))

    return to_end("least").union(to_end("most"))


def _sized(members: DataFrame) -> DataFrame:
    """Members (bucket, node, n) of buckets with more than one, with the
    bucket's size and its least and greatest node."""
    spark = members.sparkSession
    sizes = staged(spark, members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    shared = staged(spark, members.join(sizes, "bucket"), "shared")
    both = F.struct("node", "n")
    ends = shared.where(F.col("size") > BLOCK).groupBy("bucket").agg(F.min(both).alias("least"), F.max(both).alias("most"))
    return shared.join(ends, "bucket", "left")


def payload_table(df: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """(node, words) for the given nodes (node, id), from one row of each:
    31 bits a word."""
    src = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            w = split_words(part.column("text"))
            short = (w.hash >> np.uint64(33)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([digest(t) for t in part.column("text").to_pylist()], pa.binary()),
                 pa.array([short[a:b].tobytes() for a, b in zip(w.bounds, w.bounds[1:])], pa.binary())],
                names=["id", "node", "words"])

    wanted = nodes.select(F.col("node").alias("wanted"), F.col("id").alias("wanted_id"))
    rows = map_arrow(src, run, "id bigint, node binary, words binary")
    return (rows.join(wanted, (F.col("node") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
            .groupBy("node").agg(F.first("words").alias("words")))


def verify(pairs: DataFrame, payload: DataFrame) -> DataFrame:
    """(a, b, linked) of distinct candidate pairs."""
    left = payload.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = payload.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    n = pairs.count()
    both = narrowed(pairs.join(right, "b"), n, PAIRS).join(left, "a").select("a", "b", "words_a", "words_b")

    def run(batch: pa.RecordBatch):
        a, b = (batch.column(c).to_pylist() for c in ("words_a", "words_b"))
        seqs = [(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) for x, y in zip(a, b)]
        limit = [int((1 - SIMILAR) * max(len(x), len(y)) + 1e-9) for x, y in seqs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(within(seqs, limit))], names=["a", "b", "linked"])

    return map_arrow(narrowed(both, n, PAIRS), run, "a binary, b binary, linked boolean")


def _blocks(large: DataFrame) -> DataFrame:
    """Members (bucket, node, n, root) of the buckets that hold several roots,
    with their block; ``solid`` is the root of a block that has only this one.
    A root with more than a block's share has blocks of its own."""
    parts = F.ceil(F.greatest(F.col("c") / NODES, F.col("w") / WORDS))
    roots = large.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    roots = roots.withColumn("parts", parts).withColumn("solid", F.when(F.col("parts") > 1, F.col("root")))
    mixed = roots.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("roots"), F.sum(F.when(F.col("solid").isNull(), F.col("c"))).alias("c"),
        F.sum(F.when(F.col("solid").isNull(), F.col("w"))).alias("w")).where("roots > 1")
    shares = roots.select("bucket", "root", "solid", "parts").join(
        mixed.select("bucket", parts.alias("mixed_parts")), "bucket").withColumn(
        "parts", F.when(F.col("solid").isNull(), F.col("mixed_parts")).otherwise(F.col("parts"))).drop("mixed_parts")
    return large.join(shares, ["bucket", "root"]).withColumn(
        "block", F.xxhash64("bucket", "solid", F.pmod(F.xxhash64("node"), "parts"))).drop("parts")


def _work(blocks: DataFrame) -> DataFrame:
    """(bucket, p, q, second, node, root): the members of every pair of blocks
    that may hold an unverified pair; a block with itself where p = q."""
    one = blocks.select("bucket", "block", "solid").distinct()
    pairs = one.select("bucket", F.col("block").alias("p"), F.col("solid").alias("solid_p")).join(
        one.select("bucket", F.col("block").alias("q"), F.col("solid").alias("solid_q")), "bucket").where(
        (F.col("p") <= F.col("q")) & ~F.coalesce(F.col("solid_p") == F.col("solid_q"), F.lit(False)))
    ends = pairs.select("bucket", "p", "q", F.explode(F.when(
        F.col("p") == F.col("q"), F.array(F.struct(F.col("p").alias("block"), F.lit(False).alias("second")))).otherwise(
        F.array(F.struct(F.col("p").alias("block"), F.lit(False).alias("second")),
                F.struct(F.col("q").alias("block"), F.lit(True).alias("second"))))).alias("end"))
    return blocks.join(ends.select("bucket", "p", "q", "end.block", "end.second"), ["bucket", "block"]).select(
        "bucket", "p", "q", "second", "node", "root")


def key_table(keys: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """Keys of all tiers, one row per text; 0 in the tiers that it is not in."""
    out = np.zeros((len(keys), len(TIERS) * SKETCHES), np.int64)
    for row, own, n in zip(out, keys, size.tolist()):
        tiers = [t for t, (_, least, most) in enumerate(TIERS) if least <= n <= most]
        for k, t in enumerate(tiers):
            row[t * SKETCHES:(t + 1) * SKETCHES] = own[k * SKETCHES:(k + 1) * SKETCHES]
    return out


def links_between(seqs: list[np.ndarray], root: np.ndarray, second: np.ndarray, keys: np.ndarray | None = None,
                  bucket: int = 0) -> list[tuple[int, int]]:
    """Links that join all components (first given by ``root``) that a link
    between the first and the second part joins; within the whole if there is
    no second part. With a table of ``keys`` only pairs whose first common key
    is ``bucket`` are compared."""
    size = np.array([len(x) for x in seqs])
    counts = np.array([np.bincount(x % BINS, minlength=BINS) for x in seqs], np.int32)
    fine = np.array([np.bincount((x // BINS) % FINE_BINS, minlength=FINE_BINS) for x in seqs], np.int32)

    def first_here(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        same = (keys[i] == keys[j]) & (keys[i] != 0)
        return keys[i, same.argmax(axis=1)] == bucket

    left = np.flatnonzero(~second)
    right = np.flatnonzero(second) if second.any() else left
    ia, ib, far = [], [], []
    for at in range(0, len(left), 32):
        a = left[at:at + 32]
        most = np.maximum(size[a][:, None], size[right][None, :])
        limit = ((1 - SIMILAR) * most + 1e-9).astype(np.int64)
        room = (root[a][:, None] != root[right][None, :]) & (most - np.minimum(size[a][:, None], size[right][None, :]) <= limit)
        if right is left:
            room &= a[:, None] < right[None, :]
        x, y = np.nonzero(room)
        for k in range(0, len(x), 1 << 14):
            i, j = x[k:k + (1 << 14)], y[k:k + (1 << 14)]
            # an edit changes the counts by two at most
            apart = np.abs(counts[a[i]] - counts[right[j]]).sum(axis=1)
            near = apart <= 2 * limit[i, j]
            i, j, apart = i[near], j[near], apart[near]
            if keys is not None and len(i):
                own = first_here(a[i], right[j])
                i, j, apart = i[own], j[own], apart[own]
            for c in range(0, len(i), 1 << 12):
                s = slice(c, c + (1 << 12))
                more = np.abs(fine[a[i[s]]] - fine[right[j[s]]]).sum(axis=1)
                near = more <= 2 * limit[i[s], j[s]]
                ia.append(a[i[s][near]])
                ib.append(right[j[s][near]])
                far.append(np.maximum(apart[s], more)[near] / np.maximum(most[i[s], j[s]][near], 1))
    if not ia:
        return []
    order = np.argsort(np.concatenate(far), kind="stable")
    a, b = np.concatenate(ia)[order], np.concatenate(ib)[order]
    part = root.copy()  # now: the component of each node
    links, take = [], 64
    while len(a):
        pairs = [(seqs[i], seqs[j]) for i, j in zip(a[:take], b[:take])]
        good = within(pairs, [int((1 - SIMILAR) * max(len(x), len(y)) + 1e-9) for x, y in pairs])
        for i, j in zip(a[:take][good].tolist(), b[:take][good].tolist()):
            if part[i] != part[j]:
                part[part == part[j]] = part[i]
                links.append((i, j))
        a, b = a[take:], b[take:]
        open_ = part[a] != part[b]
        a, b, take = a[open_], b[open_], min(2 * take, 4096)
    return links


def _links_within(large: DataFrame, roots: DataFrame, payload: DataFrame, nodes: DataFrame) -> DataFrame:
    """Further links (a, b) of large buckets: all that join components."""
    rooted = large.join(roots, "node", "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("root"))
    spark = large.sparkSession
    work = _work(staged(spark, _blocks(staged(spark, rooted, "rooted")), "blocks"))

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_pylist()
        _, root = np.unique(np.array([x.hex() for x in table.column("root").to_pylist()]), return_inverse=True)
        seqs = [np.frombuffer(x, "<u4") for x in table.column("words").to_pylist()]
        own = [np.asarray(x.values) for x in table.column("keys")]
        found = links_between(seqs, root, np.array(table.column("second").to_pylist(), bool),
                              key_table(own, np.array([len(x) for x in seqs])), table.column("bucket")[0].as_py())
        return pa.table({"a": pa.array([max(node[i], node[j]) for i, j in found], pa.binary()),
                         "b": pa.array([min(node[i], node[j]) for i, j in found], pa.binary())})

    known = payload.join(nodes.select("node", "keys"), "node")
    return work.join(known, "node").groupBy("bucket", "p", "q").applyInArrow(run, "a binary, b binary")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, node (digest), class_id, first (whether it
    stands for its class: the row with the least id, and of several texts under
    that id the one with the least digest; repeated rows are alike)."""
    spark = df.sparkSession
    rows = staged(spark, sketch_table(df, key, text), "sketches")
    nodes = staged(spark, rows.groupBy("node").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.first("keys").alias("keys")), "nodes")
    keys = nodes.where(F.size("keys") > 0).select("node", "n", F.explode("keys").alias("bucket"))
    members = staged(spark, _sized(keys), "buckets")
    size = members.count()
    small, large = members.where(F.col("size") <= BLOCK), members.where(F.col("size") > BLOCK)
    pairs = staged(spark, narrowed(narrowed(_block_pairs(small), size).union(_star_pairs(large)).distinct(), size), "pairs")
    wanted = (pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
              .union(large.select("node")).distinct())
    payload = staged(spark, payload_table(df, key, text, nodes.join(wanted, "node").select("node", "id")), "payload")
    links = staged(spark, verify(pairs, payload).where("linked").select("a", "b"), "verified")
    roots = components(links)
    more = staged(spark, _links_within(large.select("bucket", "node", "n"), roots, payload, nodes), "within")
    if not more.isEmpty():
        roots = components(links.union(more))
    classed = nodes.select("node", "id").join(roots, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"))
    least = classed.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("l")).select(
        "root", F.col("l.id").alias("class_id"), F.col("l.node").alias("first_node"))
    labels = staged(spark, classed.join(least, "root").select("node", "class_id", "first_node"), "classes")
    return rows.select("id", "node").join(labels, "node").select(
        F.col("id").alias(key), "node", "class_id",
        ((F.col("node") == F.col("first_node")) & F.col("id").eqNullSafe(F.col("class_id"))).alias("first"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", "class_id", F.col("first").alias("kept"))
