"""Toxicity: maximum-scoring segments over token log-odds.

1. *Token log-odds with a Dirichlet prior.* From a bounded sample of labelled
   rows (``max_labelled``, equal texts once) Spark counts the toxic and other
   texts that hold each word and each word stem (its first ``STEM`` bytes).
   The log-odds of a token are shrunk by a Dirichlet prior proportional to its
   frequency in both, and kept where they are large and significant. A word scores by
   itself where the sample knows it well enough, else by its stem.
2. *Segments.* Every other word costs a small penalty, so a passage stands
   out only where toxic tokens are close. One linear scan per text finds all
   maximal scoring segments.
3. *Extreme-value calibration.* The best segment of a harmless text of n words
   follows a Gumbel law: with its decay rate and constant estimated from the
   harmless texts of the sample, a segment's expected number of chance
   occurrences is K n exp(-lambda S). The segments with an expectation under
   ``SIGNIFICANT`` add up to a text's evidence, which a logistic fit on the
   sample turns into a score between 0 and 1.

Defined results: null and empty texts have the score of a text without any
toxic token; ids, languages and sources are never read by a score; labels of
ids not in the documents are ignored, null labels too; an id labelled more
than once, or equal texts with different labels, count as toxic if any label
says so. Without labels of both kinds
every score is 0.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_crc, map_arrow, slices, staged, table
from .words import BYTE_CODE, LOWER, NON_LETTER, Words, mix, prefix_sums, span_hash, split_words

MAX_LABELLED = 12_000
STEM = 6
PRIOR = 30.0         # weight of the prior, in texts
MIN_Z = 3.0          # significance of a token's log-odds
MIN_ODDS = 1.0       # log-odds of a toxic token at least
MIN_COUNT = 4
PENALTY = 0.15       # cost of a word without toxic log-odds
SIGNIFICANT = 0.5
_CODE = BYTE_CODE[LOWER]
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)


class Model(NamedTuple):
    token: np.ndarray   # sorted hashes of known tokens (words and salted stems)
    score: np.ndarray   # their scores; nan where a stem has to decide
    rate: float         # lambda of the Gumbel law
    constant: float     # K
    weights: np.ndarray  # logistic weights: intercept, log evidence, best


def tokens(arr: pa.Array) -> tuple[Words, np.ndarray]:
    """Letter words of each row, lower-cased in ASCII, and the hash of each
    one's stem. Bytes beyond ASCII count as letters."""
    w = split_words(arr, NON_LETTER, _CODE)
    if len(w.start) == 0:
        return w, w.hash
    stop = np.minimum(w.end, w.start + STEM)
    return w, span_hash(prefix_sums(_CODE[w.raw]), w.start, stop) ^ _STEM_SALT


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, after last, score) of one sequence,
    in one pass: candidates are kept with the running totals at both ends and
    joined while that raises them. Each also keeps the place of the nearest one
    before it that began at a smaller total; no link is followed twice, so the
    scan is linear."""
    out: list[tuple[int, int, float, float, int]] = []  # first, after, total before, total after, link
    total = 0.0
    for i, s in zip(*_runs(score)):
        first, after = i
        if s <= 0:
            total += s
            continue
        first_total, total = total, total + s
        at = len(out) - 1
        while True:
            while at >= 0 and out[at][2] >= first_total:
                at = out[at][4]
            if at < 0 or out[at][3] >= total:
                out.append((first, after, first_total, total, at))
                break
            first, _, first_total, _, nearer = out[at]
            del out[at:]
            at = nearer
    return [(a, b, y - x) for a, b, x, y, _ in out]


def _runs(score: np.ndarray):
    """Runs of positive and of other scores, each as one item."""
    if len(score) == 0:
        return [], []
    cut = np.flatnonzero(np.diff(score > 0)) + 1
    first = np.concatenate([[0], cut])
    after = np.concatenate([cut, [len(score)]])
    return list(zip(first.tolist(), after.tolist())), np.add.reduceat(score, first).tolist()


def lookup(model: Model, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(model.token, known), max(len(model.token) - 1, 0))
    hit = model.token[at] == known if len(model.token) else np.zeros(len(known), bool)
    return np.where(hit, model.score[at] if len(model.token) else 0.0, np.nan)


def word_scores(model: Model, word: np.ndarray, stem: np.ndarray) -> np.ndarray:
    s = lookup(model, word)
    s = np.where(np.isnan(s), lookup(model, stem), s)
    return np.where(np.isnan(s) | (s <= 0), -PENALTY, s)


def passages(model: Model, arr: pa.Array):
    """For each text with a toxic token: row, its words, and its segments as
    (first word, after last word, score)."""
    w, stem = tokens(arr)
    s = word_scores(model, w.hash, stem)
    count = np.concatenate([[0], np.cumsum(s > 0)])[w.bounds]
    for row in np.flatnonzero(np.diff(count)):
        a, b = w.bounds[row], w.bounds[row + 1]
        yield int(row), w, segments(s[a:b])


def evidence(model: Model, arr: pa.Array) -> np.ndarray:
    """Per text: sum over significant segments of -log of their expectation,
    the best score corrected for length, the number of such segments."""
    out = np.zeros((len(arr), 3))
    for row, w, segs in passages(model, arr):
        n = max(int(w.bounds[row + 1] - w.bounds[row]), 1)
        best = np.array([x for _, _, x in segs])
        surprise = model.rate * best - np.log(max(model.constant, 1e-12) * n)
        strong = surprise > -np.log(SIGNIFICANT)
        out[row] = surprise[strong].sum(), max(surprise.max(), 0.0), strong.sum()
    return out


def _features(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), np.log1p(x[:, 0]), np.log1p(x[:, 1])])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _log_odds(counts, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """Shrunk log-odds of each token and their standard scores."""
    y1, y0 = counts["toxic"].to_numpy(float), counts["other"].to_numpy(float)
    prior = PRIOR * (y1 + y0) / (n1 + n0) + 0.25
    odds = (np.log((y1 + prior) / (n1 + PRIOR + 0.5 - y1 - prior))
            - np.log((y0 + prior) / (n0 + PRIOR + 0.5 - y0 - prior)))
    return odds, odds / np.sqrt(1 / (y1 + prior) + 1 / (y0 + prior))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
          label: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model | None:
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).alias("id")).agg(F.max(label).alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    # at most max_labelled rows, stored once as they are read three times
    sample = staged(docs.sparkSession, docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
                    .join(F.broadcast(known), "id").groupBy("text").agg(F.max("y").alias("y")), "labelled")

    def count(batch: pa.RecordBatch):
        y = np.asarray(batch.column("y").cast(pa.int64()))
        for part, lab in _with(batch, y):
            w, stem = tokens(part.column("text"))
            row = lab[w.row] if len(w.hash) else np.zeros(0, int)
            every = np.concatenate([w.hash, stem])
            kind = np.concatenate([np.zeros(len(stem), bool), np.ones(len(stem), bool)])
            where = np.concatenate([w.row, w.row]) if len(row) else row
            once = np.unique(every ^ mix(where.astype(np.uint64)), return_index=True)[1]  # a token counts once a text
            every, kind, both = every[once], kind[once], lab[where[once]] if len(row) else row
            t, first, back = np.unique(every, return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(t.view(np.int64)), pa.array(kind[first]),
                pa.array(np.bincount(back, both == 1, len(t)).astype(np.int64)),
                pa.array(np.bincount(back, both != 1, len(t)).astype(np.int64))],
                names=["token", "stem", "toxic", "other"])

    counts = (map_arrow(sample, count, "token bigint, stem boolean, toxic bigint, other bigint")
              .groupBy("token", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    n_toxic, n_other = sample.agg(F.count(F.when(F.col("y") == 1, 1)), F.count(F.when(F.col("y") != 1, 1))).first()
    if not n_toxic or not n_other:
        return None
    pdf = counts.where(F.col("toxic") + F.col("other") >= MIN_COUNT).toPandas()
    token, score = [], []
    for is_stem, part in pdf.groupby("stem"):
        odds, z = _log_odds(part, n_toxic, n_other)
        h = part["token"].to_numpy(np.int64).view(np.uint64)
        toxic = (z >= MIN_Z) & (odds >= MIN_ODDS)
        seen = (part["toxic"] + part["other"]).to_numpy() >= 3 * MIN_COUNT
        keep = toxic if is_stem else toxic | (seen & (odds < 0))
        token.append(h[keep])
        score.append(np.where(toxic, odds, -1.0)[keep])
    token, score = np.concatenate(token), np.concatenate(score)
    order = np.argsort(token)
    draft = Model(token[order], score[order], 1.0, 1.0, np.zeros(3))
    shipped = docs.sparkSession.sparkContext.broadcast(draft)

    def best(batch: pa.RecordBatch):
        y = np.asarray(batch.column("y").cast(pa.int64()))
        for part, lab in _with(batch, y):
            out = []
            for row, w, segs in passages(shipped.value, part.column("text")):
                out.append((int(lab[row]), int(w.bounds[row + 1] - w.bounds[row]), [float(x) for _, _, x in segs]))
            rest = np.bincount(lab, minlength=2)
            for yy, _, _ in out:
                rest[yy] -= 1
            out += [(k, int(rest[k]), []) for k in (0, 1) if rest[k]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.list_(pa.float64())))], names=["y", "n", "segs"])

    # one small row per text with a toxic token (at most max_labelled), the others as counts
    seen = map_arrow(sample, best, "y bigint, n bigint, segs array<double>").toPandas()
    return _calibrate(draft, seen)


def _with(batch: pa.RecordBatch, y: np.ndarray):
    at = 0
    for part in slices(batch, "text"):
        yield part, y[at:at + part.num_rows]
        at += part.num_rows


def _calibrate(draft: Model, seen) -> Model:
    some = seen["segs"].map(len) > 0
    hits = seen[some]
    plain = hits[hits["y"] == 0]
    tops = np.array([max(s) for s in plain["segs"]]) if len(plain) else np.zeros(0)
    # exceedances of the harmless texts' best segments give the decay rate,
    # their number among all words the constant
    rate = 1 / max(tops.mean() if len(tops) else 1.0, 0.5)
    words = plain["n"].sum() + 200 * seen.loc[~some & (seen["y"] == 0), "n"].sum()
    constant = max(len(tops), 1) / max(words, 1)
    model = draft._replace(rate=float(rate), constant=float(constant))
    x, y, weight = [], [], []
    for yy, n, segs in hits.itertuples(index=False):
        s = model.rate * np.array(segs) - np.log(max(model.constant, 1e-12) * max(n, 1))
        strong = s > -np.log(SIGNIFICANT)
        x.append((s[strong].sum(), max(s.max(), 0.0), strong.sum()))
        y.append(yy)
    for yy, n, _ in seen[~some].itertuples(index=False):
        x += [(0.0, 0.0, 0.0)] * int(n)
        y += [yy] * int(n)
    return model._replace(weights=_logistic(_features(np.array(x)), np.array(y, float)))


def score(df: DataFrame, model: Model | None, text: str, *keep: str) -> DataFrame:
    """``keep`` columns plus ``score``, ``n_passages`` and ``best`` (the
    calibrated surprise of the best segment), one row per input row."""
    src = df.select(*keep, F.col(text).alias("_text"))
    shipped = df.sparkSession.sparkContext.broadcast(model)
    names = [*keep, "score", "n_passages", "best"]

    def run(batch: pa.RecordBatch):
        m = shipped.value
        for part in slices(batch, batch.num_columns - 1):
            if m is None:
                x, p = np.zeros((part.num_rows, 3)), np.zeros(part.num_rows)
            else:
                x = evidence(m, part.column(part.num_columns - 1))
                p = 1 / (1 + np.exp(-np.clip(_features(x) @ m.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(p), pa.array(x[:, 2].astype(np.int64)), pa.array(x[:, 1])], names=names)

    kept = src.drop("_text").schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept),
                        "score double, n_passages bigint, best double"])
    return map_arrow(src, run, schema)


def passage_spans(df: DataFrame, model: Model, text: str, key: str) -> DataFrame:
    """Every significant passage: (key, first character byte, byte after,
    score), as byte offsets into the UTF-8 text."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        m = shipped.value
        for part in slices(batch, "text"):
            keys, out = part.column("key"), []
            base = None
            for row, w, segs in passages(m, part.column("text")):
                if base is None:
                    from .common import text_bytes
                    base = text_bytes(part.column("text"))[1]
                a, n = int(w.bounds[row]), max(int(w.bounds[row + 1] - w.bounds[row]), 1)
                for i, j, x in segs:
                    if m.rate * x - np.log(max(m.constant, 1e-12) * n) > -np.log(SIGNIFICANT):
                        out.append((keys[row].as_py(), int(w.start[a + i] - base[row]),
                                    int(w.end[a + j - 1] - base[row]), float(x)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], keys.type), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.float64())],
                    names=["key", "first_byte", "after_byte", "score"])

    kind = src.schema["key"].dataType.simpleString()
    return map_arrow(src, run, f"key {kind}, first_byte bigint, after_byte bigint, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = id_crc("doc_id") % 4 == 2
    model = learn(docs, table(spark, sf_dir, "labels").where(~held))
    out = score(docs.select("doc_id", held.alias("held_out"), "text"), model, "text", "doc_id", "held_out")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                      "n_passages", "best")
