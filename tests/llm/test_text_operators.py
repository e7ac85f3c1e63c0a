"""Quality rules, toxicity, language ID, fingerprints and main text."""

from __future__ import annotations

import hashlib
import itertools
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from unitmart.llm import html_text, language_id, quality_rules, syncmers, toxicity
from unitmart.llm.html_examples import Writer
from unitmart.llm.common import documents, id_crc, table
from unitmart.llm.words import split_words

from .conftest import odd_texts

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_statistics(text: str | None) -> tuple:
    x = text or ""
    w = WORD.findall(x)
    at: dict = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    again = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    lines = [s for s in x.split("\n") if WORD.search(s)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(again),
            len(w) < 10 or 100 * len(again) > 20 * len(w))


def test_words_match_the_pattern():
    texts = [t for _, t in odd_texts()]
    w = split_words(pa.array(texts))
    found = [bytes(w.raw[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert found == [x for t in texts for x in WORD.findall(t or "")]
    by_word = dict(zip(found, w.hash))
    assert all(by_word[f] == h for f, h in zip(found, w.hash)) and len(set(by_word.values())) == len(by_word)


def test_quality_statistics(odd_docs):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = quality_rules.apply(quality_rules.statistics(odd_docs, "doc_id", "text"), []).select("doc_id", *cols, "kept").collect()
    want = sorted(((i, *base_statistics(t)) for i, t in odd_texts()), key=repr)
    assert sorted((tuple(r)[:-1] for r in out), key=repr) == want
    assert all(r.kept != r.base_failed for r in out)


def test_quality_list_is_learned_and_ordered(spark):
    docs, labels = documents(spark, SF), table(spark, SF, "labels")
    rules = quality_rules.learn(docs, labels)
    assert rules and all(r.low >= 3 and r.low > 5 * r.high for r in rules)
    judged = quality_rules.apply(quality_rules.statistics(docs, "doc_id", "text"), rules).join(labels, "doc_id").toPandas()
    assert judged[judged.quality == 1].kept.mean() > 0.95
    assert judged[(judged.quality == 0) & ~judged.base_failed].kept.mean() < 0.1


def test_quality_without_labels(spark, odd_docs, no_docs):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.learn(odd_docs, empty) == []
    one_kind = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], "doc_id bigint, quality int, toxic int")
    assert quality_rules.learn(odd_docs, one_kind) == []
    assert quality_rules.apply(quality_rules.statistics(no_docs, "doc_id", "text"), []).count() == 0


def brute_segments(score: np.ndarray) -> float:
    return max((score[i:j].sum() for i, j in itertools.combinations(range(len(score) + 1), 2)), default=0.0)


def test_segments_hold_the_best_one():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.normal(-0.3, 1, rng.integers(0, 25))
        found = toxicity.segments(s)
        assert all(abs(s[a:b].sum() - x) < 1e-9 and x > 0 for a, b, x in found)
        assert all(b <= c for (_, b, _), (c, _, _) in zip(found, found[1:]))
        if (s > 0).any():
            assert abs(max(x for _, _, x in found) - brute_segments(s)) < 1e-9


def maximal(s: list[float], a: int, b: int) -> list[tuple[int, int]]:
    """By definition: the best segment, then those on both sides of it."""
    found = [(sum(s[i:j]), -i, -j) for i in range(a, b) for j in range(i + 1, b + 1)]
    best, i, j = max(found, default=(0, 0, 0))
    return [*maximal(s, a, -i), (-i, -j), *maximal(s, -j, b)] if best > 0 else []


def test_segments_are_all_maximal_ones():
    rng = np.random.default_rng(7)
    for _ in range(150):
        s = rng.normal(-0.2, 1, rng.integers(0, 22)).tolist()
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(s))] == maximal(s, 0, len(s))


def test_many_hits_in_one_text():
    alone = np.where(np.arange(400_000) % 2 == 0, 1.0, -1.5)
    assert len(toxicity.segments(alone)) == 200_000
    assert len(toxicity.segments(np.where(alone > 0, 1.0, -0.5))) == 1


def test_equal_texts_with_different_labels(spark):
    rows = [(i, f"vile words number {i % 4}" if i % 2 else f"calm words number {i % 6}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    either = spark.createDataFrame([(i, i % 2 if i > 20 else 0) for i, _ in rows], "doc_id bigint, toxic int")
    clear = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    a, b = toxicity.learn(docs, either), toxicity.learn(docs, clear)
    assert (a.token == b.token).all() and np.allclose(a.score, b.score) and np.allclose(a.weights, b.weights)


def test_toxicity_held_out(spark):
    docs, labels = documents(spark, SF), table(spark, SF, "labels")
    held = id_crc("doc_id") % 4 == 2
    model = toxicity.learn(docs, labels.where(~held))
    p = toxicity.score(docs, model, "text", "doc_id").join(labels.where(held), "doc_id").toPandas()
    flagged = p.score >= 0.3
    assert flagged[p.toxic == 0].mean() < 0.05 and flagged[p.toxic == 1].mean() > 0.5
    spans = toxicity.passage_spans(docs, model, "text", "doc_id").limit(20).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert spans and all(texts[r.key].encode()[r.first_byte:r.after_byte].decode().strip() for r in spans)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (99, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.learn(odd_docs, labels)
    out = toxicity.score(odd_docs, model, "text", "doc_id").collect()
    assert len(out) == len(odd_texts()) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.learn(no_docs, labels) is None
    assert {r.score for r in toxicity.score(odd_docs, None, "text", "doc_id").collect()} == {0.0}
    assert toxicity.score(no_docs, model, "text", "doc_id").count() == 0


def test_language_held_out(spark):
    docs = documents(spark, SF)
    held = id_crc("doc_id") % 5 == 0
    model = language_id.learn(docs.where(~held), "text", "lang")
    p = language_id.predict(docs.where(held), model, "text", "doc_id", "lang").toPandas()
    assert (p.lang == p.lang_pred).mean() > 0.98
    assert zlib.crc32(b"17") == spark.range(17, 18).select(id_crc("id")).first()[0]


def test_language_is_learned_from_different_texts(spark):
    rows = [(f"text number {k} of {lang}", lang) for lang in ("en", "de") for k in range(30)]
    plain = language_id.learn(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 20)
    hot = spark.createDataFrame(rows + rows[::2] * 40, "text string, lang string").repartition(3)
    copied = language_id.learn(hot, "text", "lang", 20)
    assert copied.langs == plain.langs and np.array_equal(copied.logp, plain.logp)


def test_language_odd_rows(odd_docs, no_docs):
    model = language_id.learn(odd_docs, "text", "lang")
    assert set(model.langs) == {"en", "fr"}
    out = {(r.doc_id, r.text): r for r in language_id.predict(odd_docs, model, "text", "doc_id", "text").collect()}
    for (i, t), r in out.items():
        letters = any(c.isalpha() for c in t or "")
        assert (r.lang_pred == "und" and r.score == 0) if not letters else (r.lang_pred in model.langs and 0 < r.score <= 1)
    assert language_id.learn(no_docs, "text", "lang") is None
    assert language_id.predict(odd_docs, None, "text", "doc_id").where("lang_pred <> 'und'").count() == 0


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    out = syncmers.fingerprint_documents(odd_docs).collect()
    rows = sorted(odd_texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [i for i, _ in rows]
    unique = [k for k, (i, _) in enumerate(rows) if ids.count(i) == 1 and ids.count(rows[(k + 1) % len(rows)][0]) == 1]
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and len(unique) > 10
    for k in unique:
        t, after = rows[k][1] or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = by[rows[k][0]]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == syncmers.likeness(syncmers.parse(r.fingerprint), syncmers.parse(r.edited_fingerprint))
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1.0
    one = syncmers.fingerprint_documents(odd_docs.where("doc_id = 5")).first()
    assert one.near_next == 1.0
    assert syncmers.fingerprint_documents(no_docs).count() == 0


def test_fingerprints_do_not_depend_on_ranges(odd_docs, monkeypatch):
    order = ["doc_id", "edited_sha256", "fingerprint", "near_next"]
    one = sorted(map(str, syncmers.fingerprint_documents(odd_docs).select(order).collect()))
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 20_000)
    many = syncmers.fingerprint_documents(odd_docs)
    assert many.rdd.getNumPartitions() > 3 and sorted(map(str, many.select(order).collect())) == one


def test_syncmers_do_not_depend_on_context():
    rng = np.random.default_rng(3)
    make = lambda n: "".join(rng.choice(list("abcdefg "), n))
    core = make(400)
    a, b = make(100) + core + make(50), make(10) + core + make(300)
    found = []
    for t, at in ((a, 100), (b, 10)):
        _, h, place = syncmers.anchors(pa.array([t]))
        inside = (place >= at) & (place + syncmers.K <= at + len(core))
        found.append(dict(zip((place - at)[inside].tolist(), h[inside].tolist())))
    assert found[0] == found[1] and len(found[0]) > 20
    inner = lambda s: [hashlib.md5(s[i:i + 8].encode()).digest() for i in range(13)]
    assert len(inner(core[:20])) == syncmers.K - syncmers.S + 1


def test_fingerprints_of_repeated_passages():
    rng = np.random.default_rng(4)
    make = lambda n: "".join(rng.choice(list("abcdefg "), n))
    texts = [make(n) * times for n in (30, 400, 1500, 9000) for times in (1, 2, 5, 10, 50)] + ["", "short", "ab" * 5000]
    for t, found in zip(texts, syncmers.fingerprints(texts)):
        _, h, place = syncmers.anchors(pa.array([t]))
        first: dict = {}
        for x, p in zip(h.tolist(), place.tolist()):
            first.setdefault(x, p)
        want = [(x >> 32, first[x] // syncmers.UNIT & 0xFFFF) for x in sorted(first)[:syncmers.SIZE]]
        assert len(h) == 0 or [(int(x), int(p)) for x, p in found.tolist()] == want


@pytest.mark.parametrize("n", [1000, 20_000, 400_000])
def test_likeness_of_long_texts_with_insertions(n):
    rng = np.random.default_rng(n)
    words = ["".join(map(chr, w)) for w in rng.integers(97, 123, (n, 5))]
    more = [w + (" inserted" if k % 200 == 7 else "") for k, w in enumerate(words)]
    a, b = syncmers.fingerprints([" ".join(words), " ".join(more)])
    common = len(np.intersect1d(a["hash"], b["hash"]))
    assert common > 20 and syncmers.likeness(a, b) >= 0.75
    swapped = " ".join(words[n // 2:] + words[:n // 2])
    assert syncmers.likeness(a, syncmers.fingerprints([swapped])[0]) < 0.95


PAGE = """<!doctype html><html><head><title>no</title><style>p{}</style></head><body class="main">
<!-- <p>hidden</p> --><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad-box">Buy now!</div>
<article><h1>A &amp; B</h1><p>First&nbsp;par   with <b>bold</b> and
<a href="x>y">a link</a>.<p>Sh&#246;rt.<ul><li>Item</li></ul><script>var x="</p>";</script>
<aside>Read more here</aside><form><p>Your name</p></form></article><section id="comments"><p>I disagree with all of it.</p></section>
<footer>&copy; 2020</footer>"""


@pytest.mark.parametrize("page,text", [
    (PAGE, "A & B\n\nFirst par with bold and a link.\n\nShört.\n\nItem"), (None, ""), ("", ""), ("<p>", ""),
    ("<article><p>unclosed <b>bold", "unclosed bold"), ("<article><p>a</p><script>never closed <p>b", "a"),
    ("<article>x<!-- open", "x"), ("<div hidden><p>secret words that nobody is to see here</p></div>", ""),
])
def test_main_text(page, text):
    assert html_text.main_text(page, html_text.trained()) == text


def test_main_text_of_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "<article>" + "<p>word</p>" * 20_000, "y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = html_text.extract(df, "html", "page_id", "url").collect()
    assert sorted(r.n_chars for r in out) == sorted([0, 20_000 * 6 - 2] + [len(html_text.main_text(PAGE, html_text.trained()))] * 2)
    assert html_text.extract(df.limit(0), "html", "page_id", "url").count() == 0


def test_tree_fits_its_examples():
    x, y = html_text.labelled()
    assert (html_text.classify(html_text.trained(), x) == y.astype(bool)).mean() > 0.95


def _held_out_pages():
    """Layouts that the examples lack, without a telling element or name: link
    lines by <br> or in table cells, articles of bare divs, lists or sections."""
    w = Writer(99)

    def text(least, most):
        return "+" + w.words(least, most)

    def body(tag):
        parts = [f"<{tag}>{text(n, n + 8)}</{tag}>" for n in (40, w.of(2, 6, 15), w.of(30, 90), w.of(1, 4, 25), 60, w.of(3, 9), 35)]
        return f"<h1>{text(2, 9)}</h1>" + "".join(parts)

    def cells():
        return "<table><tr>" + "".join(f"<td>{w.link()}</td>" for _ in range(6)) + "</tr></table>"

    for _ in range(40):
        lines = "<br>".join(w.link() for _ in range(7))
        yield f"<div>{lines}</div><hr>{body('div')}<hr><div>{lines} {w.words(1, 3)}</div>"
        yield f"{cells()}<section>{body('dd')}</section>{cells()}"
        yield f"<dl><dt>{w.link()}</dt><dt>{w.link()}</dt><dt>{w.link()}</dt></dl>{body('section')}<p>{w.link(3, 9)}</p><p>{w.link(2, 7)}</p>"


def test_held_out_layouts_without_names():
    x, y = html_text.labelled(list(_held_out_pages()))
    assert set(x[:, -1]) == {0.0}  # nothing but lengths, links and headings to go by
    right = (html_text.classify(html_text.trained(), x) == y.astype(bool)).mean()
    print("held-out layouts:", len(y), "blocks, right:", right)
    assert right >= 0.95


def test_lengths_and_links_come_first_in_the_tree():
    def tested(tree):
        return [] if len(tree) == 1 else [html_text.FEATURES[tree[0]], *tested(tree[2]), *tested(tree[3])]

    names = tested(html_text.trained())
    assert names[0] != "place" and names.count("place") < len(names) / 2
    assert {"words_after", "links_before", "words_before", "links_after", "words_near", "links_near"} & set(names)


LINE = "This paragraph tells at some length what happened there, who took part in it and why people still speak of it."


@pytest.mark.parametrize("outer", ['<div class="content">', "<article>"])
def test_names_that_merely_contain_a_telling_word(outer):
    page = (f'{outer}<h1>On shares</h1><p>{LINE}</p><div class="share-prices"><p>{LINE} One.</p></div>'
            f'<div class="social-issues-story"><p>{LINE} Two.</p></div><p>{LINE}</p>')
    want = ["On shares", LINE, f"{LINE} One.", f"{LINE} Two.", LINE]
    assert html_text.main_text(page, html_text.trained()) == "\n\n".join(want)


def test_a_link_alone_in_a_plain_container_goes():
    page = f'<div class="content"><p>{LINE}</p><p>{LINE}</p><p><a href="/o">Read all about our offers</a></p></div>'
    assert html_text.main_text(page, html_text.trained()) == f"{LINE}\n\n{LINE}"


@pytest.mark.parametrize("part,n", [
    ("<a ", 333_000), ("<a '", 250_000), ("<a \"'", 200_000), ("<!", 500_000), ("</script ", 110_000), ("<div>", 200_000), ("<", 1_000_000),
])
def test_broken_markup_takes_linear_time(part, n):
    start = time.process_time()
    html_text.main_text(part * n + "</ul>" * 1_000, html_text.trained())
    assert time.process_time() - start < 5
