"""Enterprise roll-ups over the unit marts, and the unit ranking.

The marts are one ``bu_id``-keyed table each, so a roll-up is a single scan
and ``groupBy("bu_id")``. ``union_units`` keeps the layout where every unit
owns a separate mart table (isolated catalogs): a by-name union, which fails
on a missing column instead of silently shifting columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_units(marts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), marts)


def bu_sales_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("bu_id").agg(
        F.sum("deal_count").alias("deal_count"),
        F.sum("pipeline_value_usd").alias("pipeline_value_usd"),
        F.sum("won_revenue_usd").alias("won_revenue_usd"),
    )


def bu_finance_performance(finance: DataFrame) -> DataFrame:
    # vendor_count is not additive over groups, so it is not rolled up.
    return finance.groupBy("bu_id").agg(
        F.sum("invoice_count").alias("invoice_count"),
        F.sum("total_spend_usd").alias("total_spend_usd"),
    )


def vendor_reach(bitmaps: DataFrame) -> DataFrame:
    """Distinct vendors of every unit and group, of every unit (no group) and of
    the enterprise (neither), from the stored bitmaps of ``vendor_bitmaps``."""
    units = bitmaps.groupBy("bu_id", "bucket").agg(F.bitmap_or_agg("vendors").alias("vendors"))
    whole = units.groupBy("bucket").agg(F.bitmap_or_agg("vendors").alias("vendors"))
    none = F.lit(None).cast("string")
    levels = [bitmaps.select(F.lit("group").alias("level"), "bu_id", "business_group", "vendors"),
              units.select(F.lit("unit"), "bu_id", none, "vendors"),
              whole.select(F.lit("enterprise"), none, none, "vendors")]
    return reduce(DataFrame.unionAll, levels).groupBy("level", "bu_id", "business_group").agg(
        F.sum(F.bitmap_count("vendors")).alias("vendor_count"))


def bu_customer_performance(customers: DataFrame) -> DataFrame:
    return customers.groupBy("bu_id").agg(
        F.sum("company_count").alias("company_count"),
        F.sum("contact_count").alias("contact_count"),
        F.sum("customer_revenue_usd").alias("customer_revenue_usd"),
    )


RANKED_METRICS = (
    ("won_revenue_usd", "sales_rank"),
    ("total_spend_usd", "spend_rank"),
    ("company_count", "customer_rank"),
)


def bu_ranking(sales_perf: DataFrame, finance_perf: DataFrame,
               customer_perf: DataFrame) -> DataFrame:
    """Which unit sells most, spends most, has the largest customer base.

    The three roll-ups are stacked into one long (unit, metric, value) table,
    ranked per metric (a window partitioned by metric over one row per unit)
    and turned back into one row per unit by a group-by: no joins. Values
    are exact decimals, so ranking and output keep full precision.
    """
    inputs = (sales_perf, finance_perf, customer_perf)
    value_type = "decimal(38,2)"
    stacked = None
    for df, (metric, _) in zip(inputs, RANKED_METRICS):
        part = df.select("bu_id", F.lit(metric).alias("metric"),
                         F.col(metric).cast(value_type).alias("value"))
        stacked = part if stacked is None else stacked.unionByName(part)
    w = Window.partitionBy("metric").orderBy(F.col("value").desc_nulls_last())
    ranked = stacked.withColumn("rank", F.rank().over(w).cast("bigint"))
    out = []
    for df, (metric, rank_name) in zip(inputs, RANKED_METRICS):
        pick = F.col("metric") == metric
        out += [F.max(F.when(pick, F.col("value"))).cast(df.schema[metric].dataType).alias(metric),
                F.max(F.when(pick, F.col("rank"))).alias(rank_name)]
    return ranked.groupBy("bu_id").agg(*out)
