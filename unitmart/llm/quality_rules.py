"""Quality rules: a decision list learned by sequential covering, applied as
ordered Spark conditional expressions. DataFrame functions only.

Statistics of each text are built-in expressions over its words and lines; no
row leaves its task. The list is learned from the statistics of a bounded
sample of labelled rows (``max_labelled``): quantiles give the candidate
thresholds, Spark counts low- and high-quality rows for each cell of the
thresholds, and on those counts rules are grown one condition at a time by
information gain, pruned on counts held back, and kept while they are precise.
Rows covered by a rule are set aside before the next one is grown. The first
rule that matches decides; a text that no rule matches is kept.

Defined results: a null or empty text has no words and fails the base rule; a
line without a word is never a duplicate; with no labelled rows, or labels of
one kind, the list is empty; an id labelled more than once counts as low
quality if any label says so; null labels and ids are ignored; repeated rows
are judged alike; columns of the input beyond key and text are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BREAK, documents, table

MAX_LABELLED = 6000
WINDOW = 5            # words of a repeated window
SYMBOLS = r"[#*$%&|<>]"
CAPITALS = r"[A-ZÀ-ÖØ-Þ]"
CUTS = 24             # candidate thresholds of a statistic
MAX_RULES = 12
MAX_CONDITIONS = 3
LEAST_PRECISION = 0.85  # of a rule, on the counts it was pruned on and on all



def _rates() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "repeats": F.col("n_repeat_words") / n,
        "duplicate_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "capitals": F.col("n_capitals") / n,
        "variety": F.col("n_distinct") / n,
    }


class Condition(NamedTuple):
    rate: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.rate) > self.threshold if self.above else F.col(self.rate) <= self.threshold


class Rule(NamedTuple):
    conditions: tuple[Condition, ...]
    low: int   # labelled low-quality rows it matched when learned
    high: int

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(f"{c.rate} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


def statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """Counts of every text. Each array that later steps read several times is
    a projected column, so that it is made once per row; store the result
    before filtering by it, as a filter pushed below would make it again."""
    after = [lambda w, i, k=k: F.get("words", i + k) for k in range(1, WINDOW)]
    out = (
        df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumns({
            "words": F.array_remove(F.split("text", WORD_BREAK), ""),
            "lines": F.filter(F.split("text", "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", " ")) != ""),
            "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint"),
            "n_capitals": F.regexp_count("text", F.lit(CAPITALS)).cast("bigint"),
        })
        .withColumns({
            "n_words": F.size("words").cast("bigint"),
            "n_lines": F.size("lines").cast("bigint"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_distinct": F.size(F.array_distinct("words")).cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
            # one hash for each window of words, by its first word
            "windows": F.slice(
                F.transform("words", lambda w, i: F.xxhash64(w, *(a(w, i) for a in after))),
                F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
        })
        .drop("words", "lines", "text")
    )
    # only texts with a repeated window go on to look where they are
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    out = out.withColumn("ordered", F.when(again, F.array_sort(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn("at", F.array_sort(F.array_compact(F.transform("ordered", lambda e, k: F.when(
        (e["h"] == F.get("ordered", k - 1)["h"]) | (e["h"] == F.get("ordered", k + 1)["h"]), e["i"])))))
    covered = F.aggregate(F.transform("at", lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get("at", k + 1), p + WINDOW) - p)), F.lit(0), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("windows", "ordered", "at")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    if p == 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


class Cells(NamedTuple):
    """Counts by cell, and for each condition the set of cells it holds for
    (a bit mask)."""

    low: list[int]
    high: list[int]
    held: int  # cells kept back for pruning
    options: list[Condition]
    masks: list[int]

    def count(self, mask: int) -> tuple[int, int]:
        low = high = 0
        while mask:
            bit = mask & -mask
            i = bit.bit_length() - 1
            low += self.low[i]
            high += self.high[i]
            mask ^= bit
        return low, high


def cells_of(rows: list[dict], cuts: dict[str, list[float]]) -> Cells:
    options, masks = [], []
    for f, ts in cuts.items():
        for t in ts:
            below = sum(1 << i for i, r in enumerate(rows) if r[f] <= t)
            options += [Condition(f, True, t), Condition(f, False, t)]
            masks += [((1 << len(rows)) - 1) ^ below, below]
    return Cells([r["low"] for r in rows], [r["high"] for r in rows],
                 sum(1 << i for i, r in enumerate(rows) if r["fold"] == 0), options, masks)


def cover(cells: Cells) -> list[Rule]:
    """Sequential covering: grow a rule on the grow cells, prune it on those
    held back, keep it if precise, set aside what it covers."""
    left = (1 << len(cells.low)) - 1
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grow, chosen = left & ~cells.held, []
        while len(chosen) < MAX_CONDITIONS:
            p0, n0 = cells.count(grow)
            if p0 == 0 or n0 == 0:
                break
            best, i = max((_gain(p0, n0, *cells.count(grow & m)), -k) for k, m in enumerate(cells.masks))
            if best <= 1e-9:
                break
            chosen.append(-i)
            grow &= cells.masks[-i]
        if not chosen:
            break

        def matched(ks: list[int]) -> int:
            mask = left
            for k in ks:
                mask &= cells.masks[k]
            return mask

        def worth(ks: list[int]) -> float:
            p, n = cells.count(matched(ks) & cells.held)
            return (p - n) / (p + n) if p + n else -1.0

        chosen = max((chosen[:k] for k in range(len(chosen), 0, -1)), key=worth)  # the longest among equals
        mask = matched(chosen)
        p, n = cells.count(mask)
        hp, hn = cells.count(mask & cells.held)
        if p < max(3, LEAST_PRECISION * (p + n)) or hp < LEAST_PRECISION * (hp + hn):
            break
        rules.append(Rule(tuple(cells.options[k] for k in chosen), p, n))
        left &= ~mask
    return rules


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          max_labelled: int = MAX_LABELLED) -> list[Rule]:
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).alias("id")).agg(F.min(label).alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    sample = (docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
              .select(F.struct("id", "y").alias("of"), "text"))
    rates = _rates()
    stats = statistics(sample, "of", "text").persist()  # a bounded sample's few numbers a row
    rows = stats.where(~base_failed()).select("doc_id", *(c.alias(k) for k, c in rates.items()))
    try:
        marks = [k / (CUTS + 1) for k in range(1, CUTS + 1)] + [0.99, 0.995]
        found = rows.agg(*(F.percentile_approx(k, marks, 100_000).alias(k) for k in rates)).first()
        cuts = {k: sorted(set(found[k] or [])) for k in rates}
        # a cell is the least threshold that a rate does not exceed
        cells = rows.select("doc_id", *(
            F.coalesce(*(F.when(F.col(k) <= t, F.lit(float(t))) for t in cuts[k]), F.lit(math.inf)).alias(k)
            if cuts[k] else F.lit(0.0).alias(k) for k in rates))
        counts = (cells.groupBy(F.pmod(F.xxhash64("doc_id.id"), F.lit(3)).alias("fold"), *rates)
                  .agg(F.sum((F.col("doc_id.y") == 0).cast("int")).alias("low"),
                       F.sum((F.col("doc_id.y") != 0).cast("int")).alias("high"))
                  .orderBy("fold", *rates).collect())  # at most max_labelled cells
    finally:
        stats.unpersist()
    return cover(cells_of([r.asDict() for r in counts], cuts))


def apply(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed``, ``rule`` (the first rule that matches, from 1; 0
    if none does) and ``kept``."""
    out = stats.withColumns(_rates())
    rule = F.lit(0)
    if rules:
        rule = F.when(rules[0].column(), F.lit(1))
        for i, r in enumerate(rules[1:], 2):
            rule = rule.when(r.column(), F.lit(i))
        rule = rule.otherwise(F.lit(0))
    return (out.withColumns({"base_failed": base_failed(), "rule": rule})
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)).drop(*_rates()))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = learn(docs, table(spark, sf_dir, "labels"))
    return apply(statistics(docs, "doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
