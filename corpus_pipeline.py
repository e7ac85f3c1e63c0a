"""The corpus pipeline: five stages over ``documents``, each stored and reread.

1. language_id: documents whose language cannot be told go (no letter, or a
   posterior under ``LEAST_LANGUAGE``).
2. toxicity: documents scored ``TOXIC`` or more go.
3. near_dedup: one document of each class of near-duplicates stays.
4. substring_dedup: words in windows that an earlier document has too are cut
   out; a document of which nothing is left goes. A document that loses no
   word keeps its text as it is.
5. packing: the rest is packed into sequences; one row per piece.

All but the last stage return the columns of ``documents`` (doc_id, text,
lang, source, n_chars; further ones are kept where a stage keeps rows as they
are). Models are learned from the stage's own input and the labels table, from
the same folds of ids as the operators' own queries.

Defined results: a document with a null or empty text has no language and goes
in stage 1; rows with a null id pass all stages (they are never earlier or
later than another); repeated rows are near-duplicates, so one stays; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitmart.llm import language_id, near_dedup, packing, substring_dedup, toxicity
from unitmart.llm.common import id_crc, staged, table

LEAST_LANGUAGE = 0.4
TOXIC = 0.3


def _with_columns_of(docs: DataFrame, decided: DataFrame) -> DataFrame:
    return decided.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def _rows(docs: DataFrame) -> DataFrame:
    """Each document as one struct beside the columns that stages read, so that
    no column of the input can clash with a stage's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs.where(id_crc("doc_id") % 5 != 0), "text", "lang")
    found = language_id.predict(_rows(docs), model, "text", "row")
    return _with_columns_of(docs, found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(id_crc("doc_id") % 4 != 2))
    found = toxicity.score(_rows(docs), model, "text", "row")
    return _with_columns_of(docs, found.where(F.col("score") < TOXIC))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class the document with the least id stays; of rows with this id
    and the same words the one with the least text, then columns."""
    found = near_dedup.near_duplicates(docs)
    null_id = F.lit(-(1 << 63))
    stay = found.where("first").select(F.coalesce("doc_id", null_id).alias("id"), F.col("node").alias("words")).distinct()
    rows = _rows(docs).select("row", F.coalesce("doc_id", null_id).alias("id"), near_dedup.node_of("text").alias("words"))
    # copies of the first text under its id (or under none) are one document: that of the least text, then of the
    # least other columns
    others = F.to_json(F.struct(*(F.col(f"row.`{c}`") for c in docs.columns if c != "text")))
    kept = rows.join(stay, ["id", "words"], "left_semi").groupBy("id", "words").agg(
        F.min_by("row", F.struct(F.col("row.text"), others)).alias("row"))
    return _with_columns_of(docs, kept)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = substring_dedup.cut_text(_rows(docs), "doc_id", "text", "row")
    kept = marked.where((F.col("n_removed") < F.col("n_words")) | (F.col("n_words") == 0))
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return kept.select(*(
        F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col(f"row.`{c}`")).alias(c)
        if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

# stages 1 to 3 learn models or align texts: SQL cannot state run()'s rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
