"""Ranked search, decontamination and whitening against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from unitmart.llm import decontamination as D
from unitmart.llm import ranked_search as R
from unitmart.llm import terms as terms_module
from unitmart.llm import whitening as W

from .conftest import sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


@pytest.fixture(scope="module")
def odd_items(spark):
    """Items cut from the documents, short ones, repeated and useless ones."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    words = base.split()
    rows = [(1, " ".join(words[:30])), (2, " ".join(words[50:63]).upper()), (3, "x y z w"), (3, "x y z w"),
            (3, "one"), (4, None), (5, ""), (6, "? ! -"), (None, " ".join(words[5:16])), (7, sentence(rng, 25)),
            (10, "ünïcode ﬁ 漢字"), (9, "line one here line one"), (8, "nothing has these terms zzzz")]
    return spark.createDataFrame(rows, "item_id long, text string")


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_terms_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in terms_module.terms(text)] == plain_terms(text)
    assert [t for c in terms_module.term_chunks(text, 1) for t in c] == terms_module.terms(text)
    assert terms_module.terms(None) == []


def test_query_blocks_bound_rows_and_bytes(spark):
    rows = [(i, "w" * (10 + i % 3)) for i in range(50)] + [(3, "w" * 10), (99, "w" * 500), (7, None)]
    df = spark.createDataFrame(rows, "item_id long, text string")
    blocks = list(terms_module.query_blocks(df, "item_id", "text", limit=100, most=6))
    assert all(len(b) <= 6 and (len(b) == 1 or sum(len(t) for _, t in b) <= 100) for b in blocks)
    assert sorted(q for b in blocks for q in b) == sorted({r for r in rows if r[1] is not None})


# --- ranked search --------------------------------------------------------------

def brute_ranking(docs, items, top):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for key, text in set(items):
        asked = set(plain_terms(text))
        scores = []
        for i, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(key, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("top", [1, 3, 50])
def test_ranked_search_equals_brute_force(spark, odd_docs, odd_items, top):
    got = R.search(odd_docs, odd_items, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(r.item_id, r.text) for r in odd_items.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranking(docs, items, top)


def test_ranked_search_of_common_terms_in_small_blocks(spark, monkeypatch):
    """Few terms, many ties and repeats; tiny blocks, blocks of queries, and a
    join of candidates without broadcast."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abcdefghijkl") for _ in range(rng.choice([1, 5, 30, 300])))) for i in range(300)]
    docs += [(1000 + i, "a b c d a a b") for i in range(150)]
    items = [(i, " ".join(rng.choice("abcdefghijklmn") for _ in range(rng.randint(1, 12)))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(R, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(R, "query_blocks", lambda q, k, t: terms_module.query_blocks(q, k, t, most=15))
    got = R.search(frame, asked, 20)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranking(docs, items, 20)


def test_bounds_are_never_below_scores():
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["w%d" % rng.randint(0, 400), "a", "b"]) for _ in range(rng.randint(1, 400)))
             for _ in range(300)]
    queries = R.Queries([(i, " ".join("w%d" % rng.randint(0, 500) for _ in range(8)) + " a") for i in range(30)])
    counts = [R.Counts(t) for t in texts]
    weighted = R.Weighted(queries, len(texts), sum(c.n for c in counts), {t: 1 + t for t in range(20)})
    hashes = R.term_hashes(queries.vocabulary)
    seen = 0
    for block in R.cut_blocks([c.keys for c in counts]):
        width, slices = R.pack([counts[i] for i in block])
        bounds = weighted.bounds(np.array([counts[i].n for i in block]), width, slices, hashes)
        exact = np.array([weighted.scores(texts[i], range(30)) for i in block]).T
        assert (bounds >= exact).all()
        assert np.median(bounds[exact > 0] / exact[exact > 0]) < 1.2
        seen += len(block)
    assert seen == len(texts)


def test_search_of_nothing(spark, no_docs, odd_docs, odd_items):
    assert R.search(no_docs, odd_items).count() == 0
    assert R.search(odd_docs, odd_items.limit(0)).count() == 0
    assert R.search(odd_docs.where("doc_id = 7 or doc_id = 3"), odd_items).count() == 0  # null and empty only


# --- decontamination ------------------------------------------------------------

def brute_hits(text, items, window):
    words, covered, ids, null = plain_terms(text), set(), set(), False
    for key, item in items:
        own = plain_terms(item)
        size = min(window, len(own))
        wins = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in wins:
                covered |= set(range(i, i + size))
                ids.add(key)
    names = sorted((str(i) for i in ids if i is not None), key=str.encode)
    return len(words), len(covered), len(ids), names


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=50), st.integers(1, 70))
def test_suffix_array(words, depth):
    order = D.suffix_array(np.array(words, np.int64), depth)
    assert sorted(order) == list(range(len(words)))
    assert [tuple(words[i:i + depth]) for i in order] == sorted(tuple(words[i:i + depth]) for i in range(len(words)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("abc ", max_size=120)), max_size=5),
       st.lists(st.tuples(st.sampled_from(["1", "2", None]), st.text("abcd ", max_size=25)), max_size=4),
       st.integers(1, 5), st.sampled_from([1, 3, 10, 1000]), st.sampled_from([1, 7, 1000]))
def test_scan_equals_brute_force(texts, block, window, shard_words, split_bytes):
    items = D.Items(block, window)
    count, runs, hits, longest = D.scan(texts, items, shard_words, split_bytes)
    for i, text in enumerate(texts):
        n, n_hit, n_items, _ = brute_hits(text, block, window)
        assert (count[i], int((runs[i][1] - runs[i][0]).sum()), len(hits[i])) == (n, n_hit, n_items)
        assert (longest[i] > 0) == (n_hit > 0)


@pytest.mark.parametrize("most", [1024, 2])
def test_decontamination_equals_brute_force(spark, odd_docs, odd_items, monkeypatch, most):
    """Also with items handed out in several blocks."""
    monkeypatch.setattr(D, "query_blocks", lambda q, k, t: terms_module.query_blocks(q, k, t, most=most))
    items = [(r.item_id, r.text) for r in odd_items.collect()]
    got = sorted(((r.doc_id, r.n_words, sum(h.length for h in r.hits), r.n_items, r["items"])
                  for r in D.find_matches(odd_docs, odd_items).collect()), key=repr)
    assert got == sorted(((r.doc_id, *brute_hits(r.text, items, 10)) for r in odd_docs.collect()), key=repr)
    kept = D.decontaminate(odd_docs, odd_items)
    assert kept.columns == odd_docs.columns
    clean = [r for r in odd_docs.collect() if not brute_hits(r.text, items, 10)[1]]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, clean))


def test_longest_match_and_runs_are_located(spark):
    docs = spark.createDataFrame([(1, "p q a b c d e f g h i j k l r s"), (2, "a b c d e f g h i x")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "z a b c d e f g h i j k l m")], "item_id long, text string")
    one, two = D.find_matches(docs, items).orderBy("doc_id").collect()
    assert (one.longest, [tuple(h) for h in one.hits], one["items"]) == (12, [(2, 12)], ["1"])
    assert (two.longest, two.hits, two.n_items) == (0, [], 0)


def test_decontamination_of_nothing(spark, no_docs, odd_docs, odd_items):
    assert D.find_matches(no_docs, odd_items).count() == 0
    found = D.find_matches(odd_docs, odd_items.limit(0))
    assert found.where("n_items > 0 or size(hits) > 0").count() == 0 and found.count() == odd_docs.count()
    assert found.agg({"n_words": "sum"}).first()[0] == sum(len(plain_terms(r.text)) for r in odd_docs.collect())


def test_op13_digest(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, "b c"), (9, "c d")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    one, two = D.op13_decontamination(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert tuple(one) == (1, 4, 3, 2, hashlib.sha256(b"10,9").hexdigest(), True)
    assert tuple(two) == (2, 0, 0, 0, hashlib.sha256(b"").hexdigest(), False)


# --- whitening ------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, x string, block string, fit int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "b", 1) for i, v in rows], VECTORS)


def brute_whitening(rows, components=4):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    x = np.array([v for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ (vecs / np.sqrt(values)), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("rows_per_block", [7, None])
def test_whitening_equals_numpy(spark, rows_per_block, monkeypatch):
    monkeypatch.setattr(W, "STRIP_BLOCKS", (1, 3))
    rng = np.random.default_rng(2)
    data = rng.normal(size=(60, 6)) * [4, 3, 2, 1, 0.5, 0.2] + 1
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(5, rows[5][1]), (None, rows[7][1])]
    bad = [(900, None), (901, []), (902, [None] + rows[0][1][1:]), (903, [float("nan")] * 6),
           (904, [float("inf")] * 6), (905, [1.0, 2.0]), (906, [3e38] * 6)]
    got = W.whiten(vectors(spark, rows + bad).repartition(5), rows_per_block=rows_per_block).collect()
    n, deviation, white, explained = brute_whitening(rows)
    want = {}
    for (i, _), d, y in zip(rows, deviation, white):
        want.setdefault(i, []).append((int(d), y))
    assert len(got) == 4 * len(rows) and {r.vec_id for r in got} == set(want)
    sign = {}
    for r in got:
        d, y = want[r.vec_id][0]
        assert (r.n, r.deviation) == (n, d)
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        s = sign.setdefault(r.component, 1 if r.whitened * y[r.component - 1] > 0 else -1)
        assert abs(r.whitened * s - y[r.component - 1]) < 1e-9


def test_whitening_of_vectors_that_vary_little_or_not(spark):
    got = W.whiten(vectors(spark, [(1, [1.0, 2.0, 5.0]), (2, [2.0, 4.0, 5.0]), (3, [1.0, 2.0, 5.0])])).orderBy("vec_id", "component").collect()
    assert [r.component for r in got] == [1, 2, 3] * 3 and {r.n for r in got} == {2}
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert abs(abs(got[0].whitened) - 1) < 1e-9 and got[0].identity_error < 1e-9 and abs(got[0].explained - 1) < 1e-9
    one = W.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).collect()
    assert len(one) == 6 and all((r.whitened, r.explained, r.identity_error, r.deviation, r.n) == (None, None, None, 0, 1) for r in one)


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        out = W.whiten(vectors(spark, rows))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]


def test_deviation_beyond_doubles():
    centre = W.Centre(3_000_000, [1])
    assert centre.deviations(np.array([[700]])) == [(3_000_000 * 700 - 1) ** 2]
    assert centre.deviations(np.array([[1 << 20]])) == [None]
