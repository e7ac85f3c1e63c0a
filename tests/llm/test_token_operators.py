"""Token files, packing and BPE, against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from unitmart.llm import bpe, chunk_cache, packing, token_files
from unitmart.llm.chunk_cache import encoder, token_file
from unitmart.session import scratch_path

from .conftest import odd_texts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PIECES = [*(chr(i) for i in range(0, 0x250)), "<|endoftext|>", "<|startoftext|>", "ﬁ", "Σ", "漢", "🙂", "é", "  ", "\n\n",
          " \n", "'s", "'LL", ".,", *["the ", " ", "a", "ing"] * 60]


def library(name):
    return encoder(token_file(name)).lib


def fuzz(n: int) -> list[str]:
    rng = random.Random(4)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 16))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_chunked_ids_are_the_librarys(name):
    texts = [*fuzz(3000), *(t for _, t in odd_texts())]
    got = encoder(token_file(name)).ids(texts)
    for t, b in zip(texts, got):
        assert np.frombuffer(b, "<u4").tolist() == library(name).encode(t or "", add_special_tokens=False).ids


def test_bpe_by_speculation():
    c, lib = bpe.codec(token_file("word_bpe_49k.json")), library("word_bpe_49k.json")
    assert c.sound
    texts = [*fuzz(2000), *(t for _, t in odd_texts())]
    n, ids, decoded = c.digests(texts)
    for t, *got in zip(texts, n, ids, decoded):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert c.encode(t) == want
        back = lib.decode(want, skip_special_tokens=False)
        assert c.decode(want) == back
        assert got == [len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(),
                       hashlib.sha256(back.encode()).hexdigest()]


def test_pairs_are_judged_as_exact_merging_does():
    c = bpe.codec(token_file("word_bpe_49k.json"))
    name = {i: t for t, i in c.vocab.items()}
    rng = np.random.default_rng(2)
    whole = np.array([i for i in name if not name[i].endswith(bpe.END) and len(name[i]) > 1])
    tail = np.array([i for i in name if name[i].endswith(bpe.END)])
    a, b = rng.choice(whole, 3000), np.concatenate([rng.choice(whole, 1500), rng.choice(tail, 1500)])
    exact = [c.merge(name[x] + name[y]) == [x, y] for x, y in zip(a, b)]
    alone = np.array([c.merge(name[x]) == [x] and c.merge(name[y]) == [y] for x, y in zip(a, b)])
    assert (c.compatible(a, b)[alone] == np.array(exact)[alone]).all() and 0 < sum(exact) < len(exact)


def test_words_side_by_side_are_those_merged_alone():
    c = bpe.codec(token_file("word_bpe_49k.json"))
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshrdluq.9") for _ in range(rng.randint(1, 70))) for _ in range(1500)]
    words += ["the", "x", "q" * 5000, "é", ""]  # a character the file's words cannot have, and none
    assert c.encode_words(words) == [c.merge(w + bpe.END) if w else [] for w in words]


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(chunk_cache, "KEEP", 50)
    for name in FILES:
        enc = chunk_cache.Encoder(token_file(name))
        texts = fuzz(400)
        for a in range(0, 400, 20):
            got = enc.ids(texts[a:a + 20])
            assert [np.frombuffer(b, "<u4").tolist() for b in got] == [
                enc.lib.encode(t, add_special_tokens=False).ids for t in texts[a:a + 20]]
        assert len(enc.known.old) < 50 + 20 * 17


def test_bpe_rows(odd_docs, no_docs):
    path = token_file("word_bpe_49k.json")
    out = bpe.digests(odd_docs, "doc_id", "text", path)
    assert out.count() == len(odd_texts()) and bpe.digests(no_docs, "doc_id", "text", path).count() == 0
    assert {r.n_tokens for r in out.where("doc_id in (3, 4, 7)").collect()} == {0}
    rows = bpe.encode(odd_docs.where("doc_id = 6"), "text", path, "doc_id").collect()
    assert rows[0].ids == library("word_bpe_49k.json").encode("a b c d").ids


@pytest.mark.parametrize("end_id,width", [(1, 2), (70_000, 4)])
def test_token_files_round_trip(spark, odd_docs, end_id, width):
    folder = scratch_path(spark, "token_files")
    manifest = token_files.write(odd_docs, "doc_id", "text", token_file(FILES[0]), end_id, folder)
    parts = manifest.orderBy("part").collect()
    assert [p.base for p in parts] == np.concatenate([[0], np.cumsum([p.ids for p in parts])[:-1]]).tolist()
    assert {p.width for p in parts} == {width}
    out = sorted(token_files.read(manifest).collect(), key=lambda r: r.start)
    rows = sorted(odd_texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in out] == [i for i, _ in rows]
    lib, start, want = library(FILES[0]), 0, []
    for i, t in rows:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, end_id], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in out if r.doc_id) == sorted(w for w in want if w[0])
    for r in out:
        assert r.start == start
        start += r.n_tokens
    flat = np.fromfile(parts[0].name + ".ids", f"<u{width}")
    offsets = np.fromfile(parts[0].name + ".offsets", "<u8")
    assert offsets[0] == 0 and offsets[-1] == len(flat) == parts[0].ids


def test_token_files_of_nothing(spark, no_docs):
    manifest = token_files.write(no_docs, "doc_id", "text", token_file(FILES[0]), 1, scratch_path(spark, "none"))
    assert manifest.count() == 0 and token_files.read(manifest).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(9)
    lengths = np.sort(rng.integers(1, 64, 500))[::-1]
    window, offset = packing.best_fit(lengths, 64)
    room: list[int] = []
    for n, w, o in zip(lengths.tolist(), window.tolist(), offset.tolist()):
        fits = [r for r in room if r >= n]
        if fits:
            assert room[w] == min(fits)
        else:
            assert w == len(room)
            room.append(64)
        assert o == 64 - room[w]
        room[w] -= n
    assert min(room) >= 0 and len(packing.best_fit(np.zeros(0, np.int64), 64)[0]) == 0


def test_packing_rows(odd_docs, no_docs):
    out = packing.pack_documents(odd_docs).toPandas()
    lib = library(FILES[1])
    want = sorted(((i if i is not None else -1, len(lib.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in odd_texts()))
    assert sum(n for _, n in want) == out.length.sum()
    for seq, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 1024
    ids = np.array([*lib.encode(odd_texts()[13][1], add_special_tokens=False).ids, 0], "<u4")
    pieces = out[out.doc_id == 15].sort_values("start")
    assert pieces.start.tolist() == [0, *pieces.length.cumsum()[:-1]] and pieces.length.sum() == len(ids)
    assert pieces.ids_crc32.tolist() == [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(pieces.start, pieces.length)]
    assert packing.pack_documents(no_docs).count() == 0
