"""Gold marts per (business unit, business group).

Inputs are silver tables (one row per key, tombstones removed), so
``count(key)`` equals the distinct count and no ``Expand``/extra exchange is
planned for it. Money stays ``decimal`` until ``report`` casts it; sums of
decimals are exact and therefore independent of partitioning.

Group cardinality is tiny (units x groups), so every final aggregation is a
map-side partial aggregate followed by a shuffle of a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import WON_STAGES

GROUP = ("bu_id", "business_group")


def report(df: DataFrame) -> DataFrame:
    """Output projection: decimals become double (only here)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def to_usd(df: DataFrame, fx_rates: DataFrame | None, amount_cols: tuple[str, ...],
           currency_col: str = "currency") -> DataFrame:
    """Convert amounts with a ``(currency, rate_to_usd)`` table; an amount in a
    currency without a rate becomes null rather than being summed as USD.
    Without rates the amounts pass through unchanged (the ``*_usd`` columns
    then add currencies as they come, like the original marts)."""
    if fx_rates is None:
        return df
    rates = fx_rates.select(F.col("currency").alias("_fx_currency"), F.col("rate_to_usd"))
    joined = df.join(rates, F.col(currency_col) == F.col("_fx_currency"), "left")
    return joined.withColumns({
        c: (F.col(c) * F.col("rate_to_usd")).cast(df.schema[c].dataType) for c in amount_cols
    }).drop("_fx_currency", "rate_to_usd")


def sales_mart(deals: DataFrame, fx_rates: DataFrame | None = None) -> DataFrame:
    deals = to_usd(deals, fx_rates, ("amount",))
    amount = F.col("amount")
    won = F.when(F.lower(F.col("stage")).isin(*WON_STAGES), amount).otherwise(F.lit(0))
    return deals.groupBy(*GROUP).agg(
        F.count("deal_id").alias("deal_count"),
        F.sum(amount).alias("pipeline_value_usd"),
        F.sum(won).alias("won_revenue_usd"),
        F.try_divide(F.sum(amount).cast("double"), F.count(amount)).alias("avg_deal_value_usd"),
    )


def finance_mart(invoices: DataFrame, cost_centers: DataFrame) -> DataFrame:
    """Invoices left-joined to their unit's cost centre, by cost-centre group.

    Invoices are pre-aggregated per (cost centre, unit, vendor) before the
    join: exact (the cost-centre side is unique per join key) and it bounds
    the join input by distinct combinations instead of invoice rows, which
    also absorbs hot cost centres in the map-side partial aggregate.
    """
    per_cc = invoices.groupBy("cc_key", "bu_id", "vendor_key").agg(
        F.count("invoice_id").alias("_n"), F.sum("amount").alias("_spend"))
    cc = cost_centers.select("cc_key", "bu_id", "business_group")
    joined = per_cc.join(cc, ["cc_key", "bu_id"], "left")
    return joined.groupBy(*GROUP).agg(
        F.sum("_n").alias("invoice_count"),
        F.count_distinct("vendor_key").alias("vendor_count"),
        F.sum("_spend").alias("total_spend_usd"),
    )


def vendor_bitmaps(invoices: DataFrame, cost_centers: DataFrame) -> DataFrame:
    """Which vendors invoiced each (unit, group), as exact bitmaps: one row of
    4 KB per 32,768 vendor numbers that occur. Unlike distinct counts, bitmaps
    add up over groups, units and time. Vendor keys are whole numbers; a null
    is no vendor."""
    if not isinstance(invoices.schema["vendor_key"].dataType, T.IntegralType):
        raise TypeError("bitmaps need whole-number vendor keys: number text keys first")
    pairs = invoices.where(F.col("vendor_key").isNotNull()).groupBy("cc_key", "bu_id", "vendor_key").agg(F.lit(1).alias("_"))
    cc = cost_centers.select("cc_key", "bu_id", "business_group")
    vendor = F.col("vendor_key").cast("bigint")
    return pairs.join(cc, ["cc_key", "bu_id"], "left") \
        .groupBy(*GROUP, F.bitmap_bucket_number(vendor).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(vendor)).alias("vendors"))


def customer_mart(companies: DataFrame, contacts: DataFrame, deals: DataFrame) -> DataFrame:
    """Companies with their contact and deal aggregates (aggregated before the
    joins, so contacts x deals never fan out)."""
    keys = ["company_id", "bu_id"]
    contact_agg = contacts.groupBy(*keys).agg(F.count("contact_id").alias("contact_count"))
    deal_agg = deals.groupBy(*keys).agg(
        F.count("deal_id").alias("deal_count"), F.sum("amount").alias("customer_revenue_usd"))
    customers = (
        companies.select("company_id", "bu_id", "business_group")
        .join(contact_agg, keys, "left")
        .join(deal_agg, keys, "left")
        .select(
            "company_id", "bu_id", "business_group",
            F.coalesce("contact_count", F.lit(0)).alias("contact_count"),
            F.coalesce("deal_count", F.lit(0)).alias("deal_count"),
            F.coalesce("customer_revenue_usd", F.lit(0)).alias("customer_revenue_usd"),
        )
    )
    return customers.groupBy(*GROUP).agg(
        F.count("company_id").alias("company_count"),
        F.sum("contact_count").alias("contact_count"),
        F.sum("deal_count").alias("deal_count"),
        F.sum("customer_revenue_usd").alias("customer_revenue_usd"),
    )
