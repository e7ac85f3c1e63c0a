"""Language identification: multinomial naive Bayes over hashed character
n-grams; the log-probability matrix is broadcast, scoring is batched numpy.

Learning takes a bounded sample of different labelled texts per language
(``per_language``); every row is scored, over its whole text. Hashed n-gram
counts are summed by Spark, so the driver receives at most
``languages x buckets`` counts.

Defined results: a null text, an empty text or one without a letter is
``und`` with score 0; rows with a null language are not learned from; a null
id belongs to no learning fold (it is scored as held in); repeated rows are
scored alike; other columns of the input are ignored.
"""

from __future__ import annotations

import sys
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, id_crc, map_arrow, slices

BUCKETS = 1 << 15
PER_LANGUAGE = 1500
# weight of one n-gram occurrence beyond the first few hundred: long texts
# would otherwise all score exactly 0 or 1
EVIDENCE = 400.0
_MUL = np.uint32(0x9E3779B1)


class Model(NamedTuple):
    langs: list[str]
    logp: np.ndarray  # buckets x languages, float32


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else a space."""
    code = np.full(sys.maxunicode + 1, 32, np.uint32)
    for c in range(sys.maxunicode + 1):
        if chr(c).isalpha():
            code[c] = c
    return code


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams (n = 1 to 3) of the lower-cased letters, runs of
    other characters as one space; the offsets of each text among them; and
    whether each text has a letter."""
    low = [(t or "").lower() for t in texts]
    lens = np.array([len(t) for t in low])
    chars = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = _letters()[chars]
    row = np.repeat(np.arange(len(low)), lens)
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (row[1:] != row[:-1])
    chars, row = chars[keep], row[keep]
    size = np.bincount(row, minlength=len(low))
    has = np.bincount(row, weights=chars != 32, minlength=len(low)) > 0
    n = len(chars)
    bucket = np.empty((n, 3), np.uint32)
    h = np.zeros(n, np.uint32)
    for k in range(3):  # the k+1 characters up to each place, within its row
        part = np.zeros(n, np.uint32)
        part[k:] = chars[:n - k] if k else chars
        if k:
            part[k:][row[k:] != row[:n - k]] = 32
        h = (h ^ part) * _MUL
        h = h ^ (h >> np.uint32(15))
        bucket[:, k] = ((h + np.uint32(k)) * _MUL) >> np.uint32(17)
    return bucket, np.concatenate([[0], np.cumsum(size)]), has


def learn(df: DataFrame, text: str, lang: str, per_language: int = PER_LANGUAGE,
          smoothing: float = 0.05) -> Model | None:
    """Fit on at most ``per_language`` different texts of each language (chosen
    by a hash of the text); None where there is no labelled row."""
    src = (df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
           .select(F.col(lang).alias("lang"), F.xxhash64(text).alias("pick"), F.col(text).alias("text")))
    cut = (src.select("lang", "pick").distinct()
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("pick")))
           .where(F.col("rank") <= per_language).select("lang", "pick"))
    # a copy of a chosen text adds nothing to learn
    sample = (src.join(F.broadcast(cut), ["lang", "pick"], "left_semi")
              .dropDuplicates(["lang", "pick"]).select("lang", "text"))

    def count(batch: pa.RecordBatch):
        total: dict[str, np.ndarray] = {}
        for part in slices(batch, "text"):
            bucket, bounds, _ = grams(part.column("text").to_pylist())
            names = np.array(part.column("lang").to_pylist(), object)
            owner = np.repeat(names, np.diff(bounds))
            for name in set(names):
                own = np.bincount(bucket[owner == name].ravel(), minlength=BUCKETS)
                total[name] = total.get(name, 0) + own
        for name, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())],
                names=["lang", "bucket", "n"])

    counts = (map_arrow(sample, count, "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    if counts.empty:
        return None
    langs = sorted(counts["lang"].unique())
    full = np.full((BUCKETS, len(langs)), smoothing)
    full[counts["bucket"], counts["lang"].map({x: i for i, x in enumerate(langs)})] += counts["n"]
    return Model(langs, np.log(full / full.sum(axis=0)).astype(np.float32))


def score_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    bucket, bounds, has = grams(texts)
    first, size = bounds[:-1], np.diff(bounds)
    loglik = np.zeros((len(texts), len(model.langs)))
    some = size > 0
    if some.any():
        for k in range(3):
            loglik[some] += np.add.reduceat(model.logp[bucket[:, k]], first[some], axis=0, dtype=np.float64)
    seen = 3 * np.maximum(size, 1)
    loglik *= (np.minimum(seen, EVIDENCE) / seen)[:, None]  # uniform prior
    loglik -= loglik.max(axis=1, keepdims=True)
    p = np.exp(loglik)
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    names = [model.langs[b] if h else "und" for b, h in zip(best, has)]
    return names, np.where(has, p.max(axis=1), 0.0)


def predict(df: DataFrame, model: Model | None, text: str, *keep: str) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score``, one row per input row."""
    src = df.select(*keep, F.col(text).alias("_text"))
    kept = src.drop("_text").schema
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        m = shipped.value
        for part in slices(batch, batch.num_columns - 1):
            texts = part.column(part.num_columns - 1).to_pylist()
            if m is None:
                names, p = ["und"] * len(texts), np.zeros(len(texts))
            else:
                names, p = score_texts(m, texts)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(names, pa.string()), pa.array(p, pa.float64())],
                names=[*part.schema.names[:-1], "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double"])
    return map_arrow(src, run, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = id_crc("doc_id") % 5 == 0
    model = learn(docs.where(~held), "text", "lang")
    out = predict(docs.select("doc_id", held.alias("held_out"), "text"), model, "text", "doc_id", "held_out")
    return out.select("doc_id", "held_out", "lang_pred", "score")
