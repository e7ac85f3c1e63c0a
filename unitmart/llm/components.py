"""Connected components of a link table, as rounds of grouped minima.

Alternating large-star and small-star steps: every round hangs each node's
neighbours onto the least node of its neighbourhood, until all links point at
the least node of their component. Each step groups by node with a map-side
minimum and joins it back, so a node with very many links is a skewed join
key, which adaptive execution splits; no neighbourhood is gathered in one
place. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrowed, staged


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
    return narrowed(narrowed(hung, n).distinct(), n)


def _small_star(links: DataFrame, n: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    to_least = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    hung = narrowed(to_least, n).union(narrowed(least.select("a", F.col("m").alias("b")), n))
    return narrowed(hung.distinct(), n)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots: root is
    the least node of its component. Links may be repeated or point both ways;
    null ends and self-links are ignored."""
    spark = links.sparkSession
    now = staged(spark, links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "links")
    before, n = None, now.count()
    while True:
        now = staged(spark, _small_star(_large_star(now, n), n), "links")
        # settled when no node is both above and below, and none is below two
        mark = now.agg(F.count("a"), F.sum(F.hash("a", "b").cast("bigint")),
                       F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
