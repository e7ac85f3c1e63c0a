"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the binding) over whole tables;
outputs are passed through ``report`` so money is double and names are fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cluster import clustered
from ..model import BUSINESS_UNITS, OBJECTS, REQUIRED_COLUMNS
from ..operators import governance, quality, reads
from ..operators.cdc import latest_per_key
from ..operators.enterprise import bu_customer_performance, bu_ranking, bu_sales_performance, vendor_reach
from ..operators import marts
from ..operators.gate import admit_object, rejection_metrics
from ..operators.marts import report
from ..session import ensure_conf, scratch_path
from ..sources import binding
from ..sources.extract import incremental
from . import gold
from .refresh import refresh
from .silver import silver, to_silver, unit_filter

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return report(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return wrap


@register("sales_mart")
def q_sales_mart(spark, sf_dir):
    """Deals per unit and business group: count, pipeline, won revenue, mean."""
    return gold.sales_mart(spark, sf_dir)


@register("scd1_events")
def q_scd1_events(spark, sf_dir):
    """Generic CDC feed (key user_id, sequence ts, error = delete) to current state."""
    return latest_per_key(binding.event_changes(spark, sf_dir), ["user_id"], sequence="ts")


@register("finance_mart")
def q_finance_mart(spark, sf_dir):
    """Invoices joined to cost centres (shared ones re-homed) per unit/group."""
    return gold.finance_mart(spark, sf_dir)


@register("customer_mart")
def q_customer_mart(spark, sf_dir):
    """Companies with contact and deal aggregates per unit/group."""
    return gold.customer_mart(spark, sf_dir)


@register("bu_sales_performance")
def q_bu_sales(spark, sf_dir):
    return gold.sales_performance(spark, sf_dir)


@register("bu_finance_performance")
def q_bu_finance(spark, sf_dir):
    return gold.finance_performance(spark, sf_dir)


@register("bu_customer_performance")
def q_bu_customer(spark, sf_dir):
    return gold.customer_performance(spark, sf_dir)


@register("bu_ranking")
def q_bu_ranking(spark, sf_dir):
    """Rank of every unit by won revenue, spend and customer count. The deals'
    state serves two roll-ups, so it is stored once, with the columns they read;
    the other objects' states go straight into theirs."""
    path = scratch_path(spark, "bu_ranking")
    silver(spark, sf_dir, "deals", columns=(*gold.DEAL_COLUMNS, "company_id")).write.parquet(path)
    deals = spark.read.parquet(path)
    customers = marts.customer_mart(silver(spark, sf_dir, "companies", columns=("business_group",)),
                                    silver(spark, sf_dir, "contacts", columns=("company_id",)), deals)
    return bu_ranking(bu_sales_performance(marts.sales_mart(deals)), gold.finance_performance(spark, sf_dir),
                      bu_customer_performance(customers))


@register("distinct_vendor_rollup")
def q_distinct_vendor_rollup(spark, sf_dir):
    """Distinct vendors per unit and group, per unit and of the enterprise, from
    bitmaps that a refresh has stored per unit and group."""
    paths = refresh(spark, sf_dir, scratch_path(spark, "distinct_vendor_rollup"), mart_names=("vendor_bitmaps",))
    return vendor_reach(spark.read.parquet(paths["vendor_bitmaps"]))


# --- tenant scope, CDC, reads and governance ----------------------------------

# Fixed parameters of the registered queries.
DIVESTED_UNITS = ("bu_06",)
LOOKUP_DEAL_ID = 42
NO_AMOUNT_EVERY = 17  # vendors whose invoices lack the amount
PAGE_OFFSET, PAGE_LIMIT = 200, 100
EXTRACT_WATERMARK = "2024-01-15T00:00:00Z"
CLUSTERED_WATERMARK = "1997-06-01T00:00:00Z"
INVOICE_ORDER = ("invoice_id", "updated_at", "cc_key", "vendor_key", "amount", "is_deleted")
DEEP_PAGE_FROM_END = 150
VIEWING_PERSONAS = ("corporate_executive", "partner_group_executive", "bu_02_and_online_executive", "nobody")
ENTITLEMENTS = (
    ("corporate_executive", None, None),
    ("bu_03_executive", "bu_03", None),
    ("partner_group_executive", None, "bg_partner"),
    ("bu_02_online_executive", "bu_02", "bg_online"),
    # overlapping policies: a row that both allow is one row
    ("bu_02_and_online_executive", "bu_02", None),
    ("bu_02_and_online_executive", None, "bg_online"),
)


@register("shared_vendor_scope")
def q_shared_vendor_scope(spark, sf_dir):
    """Vendors per entitled unit (shared rows re-homed), current state."""
    return silver(spark, sf_dir, "vendors")


@register("shared_cost_center_scope")
def q_shared_cost_center_scope(spark, sf_dir):
    return silver(spark, sf_dir, "cost_centers")


@register("scd1_invoices")
def q_scd1_invoices(spark, sf_dir):
    """Invoice change feed (repeated keys, ties) to current state."""
    return silver(spark, sf_dir, "gl_invoices")


@register("dq_key_unique")
def q_dq_key_unique(spark, sf_dir):
    """Invoice keys that arrive more than once, with their version counts."""
    return quality.duplicate_keys(binding.gl_invoice_changes(spark, sf_dir), ["invoice_id"])


@register("source_rule_violations")
def q_source_rule_violations(spark, sf_dir):
    """NOT NULL and key rules of the source relations, per object."""
    feeds = {obj: binding.ENTITIES[obj](spark, sf_dir) for obj in REQUIRED_COLUMNS}
    feeds["gl_invoices"] = feeds["gl_invoices"].withColumn(
        "amount", F.when(F.col("vendor_key") % NO_AMOUNT_EVERY != 0, F.col("amount")))
    found = [quality.relation_violations(feed, REQUIRED_COLUMNS[obj], OBJECTS[obj].keys)
             .select(F.lit(obj).alias("source_object"), "*") for obj, feed in feeds.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@register("dq_fail_gate")
def q_dq_fail_gate(spark, sf_dir):
    """Scoped cost-centre rows behind the fail-the-batch tenant gate, which
    sees the incoming rows: one of no or of an unconfigured unit raises."""
    return admit_object(binding.cost_centers(spark, sf_dir), "cost_centers", strict=True).drop("_own")


@register("bu_slice")
def q_bu_slice(spark, sf_dir):
    """Isolated current deals of the divested unit (gate checked)."""
    feed = unit_filter(admit_object(binding.deals(spark, sf_dir), "deals", strict=True), DIVESTED_UNITS)
    return to_silver(feed, "deals", DIVESTED_UNITS)


@register("gated_sales_mart")
def q_gated_sales_mart(spark, sf_dir):
    """Sales mart over deals of which some have no unit, an unconfigured unit
    or no update time: none of those reaches the mart."""
    return marts.sales_mart(to_silver(binding.flawed_deals(spark, sf_dir), "deals", columns=gold.DEAL_COLUMNS))


@register("gate_counts")
def q_gate_counts(spark, sf_dir):
    """What the gate sees and rejects of the flawed deals."""
    spec = OBJECTS["deals"]
    return binding.flawed_deals(spark, sf_dir).agg(
        *rejection_metrics(spec.shared, spec.sequence, BUSINESS_UNITS))


@register("point_lookup")
def q_point_lookup(spark, sf_dir):
    return reads.point_lookup(binding.deals(spark, sf_dir), "deal_id", LOOKUP_DEAL_ID)


@register("page_read")
def q_page_read(spark, sf_dir):
    return reads.page(binding.deals(spark, sf_dir), ["deal_id"], PAGE_OFFSET, PAGE_LIMIT)


@register("deep_page")
def q_deep_page(spark, sf_dir):
    """A page near the end of the invoice changes, found by row counts of key
    ranges: one range is sorted, not the table."""
    feed = binding.gl_invoice_changes(spark, sf_dir)
    return reads.deep_page(feed, INVOICE_ORDER, feed.count() - DEEP_PAGE_FROM_END, PAGE_LIMIT)


@register("clustered_slice")
def q_clustered_slice(spark, sf_dir):
    """Invoices of one unit changed after the watermark, from a table written in
    the order of a space-filling key over unit and update time."""
    path = scratch_path(spark, "clustered_slice")
    state = silver(spark, sf_dir, "gl_invoices")
    clustered(state, ("bu_id", "updated_at"), {"bu_id": BUSINESS_UNITS}).write.parquet(path)
    return incremental(spark.read.parquet(path).filter(F.col("bu_id").isin(*DIVESTED_UNITS)), CLUSTERED_WATERMARK)


@register("ordered_extract")
def q_ordered_extract(spark, sf_dir):
    """Contacts after the watermark in the order of their update time: the place
    of each row, and whether times never fall from one file to the next."""
    path = scratch_path(spark, "ordered_extract")
    incremental(binding.contacts(spark, sf_dir), EXTRACT_WATERMARK, ordered=True).write.parquet(path)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("updated_at").alias("first"), F.max("updated_at").alias("last"))
    order = Window.orderBy("file")  # one row per file
    return files.withColumn("_fell", F.lag("last").over(order) > F.col("first")).agg(
        F.sum("rows").alias("records"), F.min("first").alias("first_at"), F.max("last").alias("last_at"),
        (F.count(F.when(F.col("_fell"), 1)) == 0).alias("in_order"))


@register("incremental_extract")
def q_incremental_extract(spark, sf_dir):
    """Contacts changed after the stored watermark."""
    return incremental(binding.contacts(spark, sf_dir), EXTRACT_WATERMARK)


@register("entitled_sales")
def q_entitled_sales(spark, sf_dir):
    """Sales mart rows each persona may see."""
    policy = governance.entitlements_frame(spark, ENTITLEMENTS)
    return governance.entitled_rows(gold.sales_mart(spark, sf_dir), policy)


@register("persona_sales")
def q_persona_sales(spark, sf_dir):
    """What three personas see through one view of the sales mart: the same SQL
    text, with another session variable."""
    policy = governance.entitlements_frame(spark, ENTITLEMENTS)
    path = scratch_path(spark, "persona_sales")
    gold.sales_mart(spark, sf_dir).write.parquet(path)
    governance.persona_view(spark, spark.read.parquet(path), policy, "my_sales")
    seen = None
    for persona in VIEWING_PERSONAS:
        governance.as_persona(spark, persona)
        mine = spark.sql("SELECT *, session.persona AS persona FROM my_sales")
        seen = mine if seen is None else seen.unionByName(mine)
    governance.as_persona(spark, None)
    return seen


@register("divest_enterprise")
def q_divest_enterprise(spark, sf_dir):
    """Enterprise sales roll-up of the units that remain after the divestiture."""
    _, remainder = governance.divest(gold.sales_mart(spark, sf_dir), DIVESTED_UNITS)
    return bu_sales_performance(remainder)


@register("divest_check")
def q_divest_check(spark, sf_dir):
    """Slice and remainder of the sales mart against the whole: rows of each,
    and whether counts and sums add up."""
    path = scratch_path(spark, "divest_check")
    gold.sales_mart(spark, sf_dir).write.parquet(path)
    whole = spark.read.parquet(path)
    out, remainder = governance.divest(whole, DIVESTED_UNITS)
    check = governance.partition_check(whole, [out, remainder], ["deal_count", "pipeline_value_usd", "won_revenue_usd"])
    sizes = whole.agg(F.count(F.when(F.col("bu_id").isin(*DIVESTED_UNITS), 1)).alias("slice_rows"),
                      F.count(F.lit(1)).alias("rows"))
    return check.join(sizes, "rows").select("rows", "slice_rows", "consistent")
