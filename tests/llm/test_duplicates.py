"""Near-duplicates, substring dedup and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from unitmart.llm import align, near_dedup, substring_dedup
from unitmart.llm.components import components
from unitmart.llm.fm_index import FMIndex

from .conftest import CLASHES, DOC_FIELDS, odd_texts, sentence


def edit_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_banded_alignment_is_exact():
    rng = random.Random(1)
    pairs, limit, want = [], [], []
    for _ in range(300):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 25)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = [rng.randint(0, 6)] * rng.randint(0, 2)
        pairs.append((np.array(a, np.uint32), np.array(b, np.uint32)))
        limit.append(rng.randint(0, 20))
        want.append(edit_distance(a, b) <= limit[-1])
    assert align.within(pairs, limit, start=2).tolist() == want and True in want and False in want


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 470)]
    links += [(500, k) for k in range(501, 600)] + [(7, 7), (3, None)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = list(range(600))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if b is not None:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    want = {x: top(x) for p in links if p[1] is not None for x in p}
    assert {k: found.get(k, k) for k in want} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_docs(n_groups: int = 12) -> list[tuple[int, str]]:
    """Groups of copies with a few changed words, among unrelated texts."""
    rng, out, k = random.Random(8), [], 0
    for g in range(n_groups):
        words = sentence(rng, rng.randint(60, 160)).split()
        for c in range(1 + 3 * (g % 4)):
            new = list(words)
            for _ in range(len(new) // 40):
                new[rng.randrange(len(new))] = f"new{k}"
            out.append((k, " ".join(new)))
            k += 1
    return out


def brute_classes(docs) -> dict:
    root = {i: i for i, _ in docs}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in docs:
        for j, b in docs:
            x, y = a.split(), b.split()
            if i < j and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
                if edit_distance(x, y) <= 0.2 * max(len(x), len(y)):
                    p, q = top(i), top(j)
                    root[max(p, q)] = min(p, q)
    return {i: top(i) for i, _ in docs}


@pytest.mark.parametrize("block", [8, 2])
def test_near_duplicate_classes(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = near_docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    assert found == brute_classes(docs)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    out = near_dedup.near_duplicates(odd_docs).collect()
    assert len(out) == len(odd_texts())
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.class_id)
    assert by[1] == by[2] == by[10] == by[11] == by[12] == {1} and by[3] == by[4] == by[7] == {3}
    assert by[13] == {13} and by[14] == {14} and by[20] == {20} and by[None] == {1, None}
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_backward_search_finds_all_occurrences():
    rng = np.random.default_rng(6)
    pieces = [rng.integers(0, 3, n) for n in rng.integers(4, 30, 60)]
    lengths = np.array([len(p) for p in pieces])
    index = FMIndex(np.concatenate(pieces).astype(np.uint64), lengths, 4)
    begin = np.concatenate([s + np.arange(n - 3) for s, n in zip(index.start, lengths)])
    low, high = index.search(begin, 4)
    grams = {}
    for p in pieces:
        for k in range(len(p) - 3):
            grams.setdefault(tuple(p[k:k + 4]), 0)
            grams[tuple(p[k:k + 4])] += 1
    flat = [tuple(p[k:k + 4]) for p in pieces for k in range(len(p) - 3)]
    assert [grams[g] for g in flat] == (high - low).tolist()
    for b, lo, hi in list(zip(begin, low, high))[::17]:
        assert b in index.suffixes[lo:hi]


def brute_removal(rows) -> list[tuple]:
    first: dict = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [500, 2])
def test_substring_dedup(spark, odd_docs, no_docs, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD", 40)
    out = substring_dedup.cut_text(odd_docs, "doc_id", "text", "doc_id").collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute_removal(odd_texts())
    rng = random.Random(3)
    shared = [sentence(rng, n) for n in (13, 20, 40)]
    rows = [(k, " ".join([sentence(rng, rng.randint(0, 9)), rng.choice(shared), sentence(rng, 5), rng.choice(shared)]))
            for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = substring_dedup.cut_text(df, "doc_id", "text", "doc_id").collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute_removal(rows)
    assert substring_dedup.cut_text(no_docs, "doc_id", "text", "doc_id").count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(12)
    toxic = [" ".join(rng.choice(["scum", "idiot", "loser", "fine", "word"]) for _ in range(40)) for _ in range(12)]
    plain = [sentence(rng, 70) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(plain + toxic)]
    rows += [(100, plain[3]), (101, plain[4] + " more"), (102, None), (103, "12 34 !"), (103, "12 34 !"),
             (104, f"{sentence(rng, 60)} {' '.join(plain[5].split()[:50])} {sentence(rng, 60)}"), (None, sentence(rng, 60)),
             (105, sentence(rng, 50))]
    extra = [(i, t, "en", "s", len(t or ""), *["x"] * len(CLASHES)) for i, t in rows]
    ddl = DOC_FIELDS + "".join(f", `{c}` string" for c in CLASHES)
    spark.createDataFrame(extra, ddl).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int(t in toxic)) for k, t in rows if k is not None and k < 60]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    columns = docs.columns
    for name, stage in C.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        left[name] = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=repr)
        if name != "packing":
            assert docs.columns == columns
    assert 102 not in left["language_id"] and 103 not in left["language_id"]
    assert set(left["language_id"]) == {i for i, _ in rows} - {102, 103}
    assert set(left["toxicity"]) >= set(range(40)) | {105} and not set(left["toxicity"]) & set(range(40, 52))
    assert set(left["near_dedup"]) == set(left["toxicity"]) - {100, 101}
    cut = spark.read.parquet(str(tmp_path / "substring_dedup")).where("doc_id = 104").first()
    want = dict(brute_removal([r for r in rows if r[0] in (5, 104)]) and [
        (r[0], r[3]) for r in brute_removal([r for r in rows if r[0] in (5, 104)])])
    assert cut.text == want[104] and cut.n_chars == len(cut.text)
    run = C.run(spark, str(tmp_path)).toPandas()
    assert len(run) == docs.count() and run.length.sum() == docs.toPandas().length.sum()


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as C

    spark.createDataFrame([], DOC_FIELDS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_digest_is_of_the_words():
    assert near_dedup.digest("a  b\n") == near_dedup.digest("a b") != near_dedup.digest("ab")
    assert near_dedup.digest(None) == near_dedup.digest(" ") == hashlib.blake2b(b"", digest_size=16).digest()


def edited(rng: random.Random, words: list[str], share: float) -> list[str]:
    """With that share of the words replaced, at random places."""
    new = list(words)
    for k in rng.sample(range(len(new)), int(share * len(new))):
        new[k] = "e" + str(rng.randrange(1 << 40))
    return new


def test_large_group_of_edited_copies(spark, monkeypatch):
    """Copies whose similarities straddle the threshold, all in one bucket."""
    monkeypatch.setattr(near_dedup, "NODES", 7, raising=False)
    monkeypatch.setattr(near_dedup, "sketches", lambda arr: (np.ones((len(arr), 1), np.uint64), np.full(len(arr), 60)))
    rng = random.Random(100)
    words = sentence(rng, 60).split()
    docs = [(k, " ".join(edited(rng, words, 0.14))) for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    assert found == brute_classes(docs)


@pytest.mark.parametrize("share", [0.1, 0.12, 0.13, 0.15, 0.2])
def test_links_of_blocks(share):
    rng = random.Random(int(100 * share))
    words = sentence(rng, 60).split()
    texts = [edited(rng, words, share) for _ in range(50)]
    seqs = [np.array([zlib.crc32(w.encode()) >> 1 for w in t], np.uint32) for t in texts]
    root = np.array([k // 2 for k in range(50)])
    for second in (np.zeros(50, bool), np.arange(50) % 3 == 0):
        found = near_dedup.links_between(seqs, root, second)
        part, want = root.copy(), root.copy()
        for i, j in found:
            assert edit_distance(texts[i], texts[j]) <= 12
            part[part == part[j]] = part[i]
        for i in range(50):
            for j in range(i):
                if (not second.any() or second[i] != second[j]) and edit_distance(texts[i], texts[j]) <= 12:
                    want[want == want[j]] = want[i]
        assert [list(part).index(x) for x in part] == [list(want).index(x) for x in want]


@pytest.mark.parametrize("n,share,least", [(5, 0.2, 0.9), (10, 0.1, 0.9), (10, 0.2, 0.9), (20, 0.1, 0.9), (20, 0.2, 0.9), (36, 0.2, 0.9),
                                           (60, 0.2, 0.9), (110, 0.2, 0.9), (200, 0.2, 0.9), (500, 0.2, 0.9), (500, 0.1, 0.99)])
def test_similar_texts_share_a_key(n, share, least):
    rng, hit = random.Random(n), 0
    for _ in range(200):
        words = sentence(rng, n).split()
        (a, b), _ = near_dedup.sketches(pa.array([" ".join(words), " ".join(edited(rng, words, share))]))
        hit += len(np.intersect1d(a, b)) > 0
    assert hit >= 200 * least


def test_pipeline_keeps_the_least_of_rows_alike(spark, tmp_path):
    import corpus_pipeline as C

    rows = [(5, "one two  three four", "fr", "a", 1), (5, "one two three four", "fr", "b", 1), (5, "one two three four", "en", "b", 1),
            (6, "one two three four", "de", "a", 1), (None, "six seven", "en", "a", 1), (None, "six  seven", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for part in (docs, docs.repartition(3).orderBy(F.desc("text"))):
        out = sorted((tuple(r) for r in C.near_dedup_stage(spark, part, str(tmp_path)).collect()), key=str)
        assert out == sorted([(5, "one two  three four", "fr", "a", 1), (None, "six  seven", None, None, None)], key=str)


def test_only_pieces_that_share_a_route_are_indexed(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(5)
    own, shared, other = (rng.integers(0, 1 << 47, n).astype(np.uint64) for n in (15, 16, 13))
    as_bytes = lambda w: substring_dedup._packed(w).tobytes()
    rows = [(1, 1, 7, 50, as_bytes(np.concatenate([own, own]))), (2, 2, 8, 9, as_bytes(shared)),
            (3, 3, 8, 4, as_bytes(shared[1:])), (4, 4, 9, 6, as_bytes(other))]
    pieces = spark.createDataFrame([tuple(map(lambda x: bytearray(x) if isinstance(x, bytes) else x, r)) for r in rows],
                                   "key_a long, key_b long, route long, id long, words binary")
    got = {r.key_a: r.least for r in substring_dedup.search(pieces, 4).collect()}
    assert got == {1: [50] * 18, 2: [9, 4, 4, 4], 3: [4, 4, 4], 4: [6]}
    # a shard of pieces that meet no other builds no index
    monkeypatch.setattr(substring_dedup, "FMIndex", None)
    alone = {r.key_a: r.least for r in substring_dedup.search(pieces.where("key_a <> 3"), 3).collect()}
    assert alone == {1: [50] * 18, 2: [9] * 4, 4: [6]}
