"""Binding of the driver's TPC-H-like tables onto the CRM/ERP entities.

Each function returns the *change feed* of one object as it would arrive from
its source system: one row per version, ``updated_at`` as sequence and an
``is_deleted`` 0/1 flag. The rules are plain column expressions, so scans stay
pruned and every entity grows with its base table.

Binding rules (our own convention, not source data):
  bu(k)  = 'bu_0' || (k % 6 + 1)
  bg(k)  = bg_direct / bg_partner / bg_online by floor(k / 6) % 3
  shared dimension rows: supplier key % 10 = 0, part key % 20 = 0
  deletes: key % 33 = 0 (customer, orders, events), key % 10 = 7 (supplier,
  part), returned-and-final lines (lineitem); error events in the generic feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import MONEY, SHARED_BU
from .tables import read_table

# Fixed values of the binding.
SHARED_WITH_LIST = "bu_02|bu_03|bu_06"
STATIC_VERSION_TS = "2024-01-01 00:00:00"  # dimensions without a time column
NOT_SPECIFIED_PRIORITY = "4-NOT SPECIFIED"
URGENT_PRIORITY = "1-URGENT"


def bu_of(key: Column) -> Column:
    return F.concat(F.lit("bu_0"), (key % 6 + 1).cast("string"))


def group_of(key: Column) -> Column:
    g = F.floor(key / 6).cast("bigint") % 3
    return (F.when(g == 0, "bg_direct").when(g == 1, "bg_partner").otherwise("bg_online"))


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _static_ts() -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{STATIC_VERSION_TS}'")


# keys whose deals are flawed: no unit, an unconfigured unit, no update time
NO_UNIT_EVERY, FOREIGN_UNIT_EVERY, NO_TIME_EVERY = 41, 43, 37
FOREIGN_UNIT = "bu_09"


def flawed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deals feed with rows that must not reach a mart."""
    k = F.col("deal_id")
    return deals(spark, sf_dir).withColumns({
        "bu_id": F.when(k % NO_UNIT_EVERY == 0, None).when(k % FOREIGN_UNIT_EVERY == 0, FOREIGN_UNIT).otherwise(F.col("bu_id")),
        "updated_at": F.when(k % NO_TIME_EVERY != 0, F.col("updated_at")),
    })


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("company_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_acctbal").alias("annual_revenue"),
        bu_of(k).alias("bu_id"),
        group_of(k).alias("business_group"),
        _flag(k % 33 == 0).alias("is_deleted"),
        _static_ts().alias("updated_at"),
    )


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    stage = (
        F.when((status == "F") & (prio == URGENT_PRIORITY), "Closed Won")
        .when(status == "F", "WON")
        .when(status == "P", "proposal")
    )
    amount = F.when(prio != NOT_SPECIFIED_PRIORITY, F.col("o_totalprice").cast(MONEY))
    return o.select(
        F.col("o_orderkey").alias("deal_id"),
        F.col("o_custkey").alias("company_id"),
        bu_of(F.col("o_custkey")).alias("bu_id"),
        group_of(F.col("o_custkey")).alias("business_group"),
        amount.alias("amount"),
        stage.alias("stage"),
        F.col("o_orderdate").alias("updated_at"),
        _flag(F.col("o_orderkey") % 33 == 0).alias("is_deleted"),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("contact_id"),
        F.col("user_id").alias("company_id"),
        bu_of(F.col("user_id")).alias("bu_id"),
        F.col("event_type").alias("lifecycle_stage"),
        F.col("ts").alias("updated_at"),
        _flag(F.col("event_id") % 33 == 0).alias("is_deleted"),
    )


def _shared_dimension(key: Column, shared_mod: int) -> tuple[Column, Column, Column]:
    shared = key % shared_mod == 0
    bu = F.when(shared, F.lit(SHARED_BU)).otherwise(bu_of(key))
    shared_with = F.when(shared, F.lit(SHARED_WITH_LIST))
    return bu, shared_with, _flag(shared)


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    bu, shared_with, is_shared = _shared_dimension(k, 10)
    return s.select(
        k.alias("vendor_key"),
        F.col("s_name").alias("name"),
        is_shared.alias("is_shared"),
        shared_with.alias("shared_with"),
        bu.alias("bu_id"),
        _flag(k % 10 == 7).alias("is_deleted"),
        _static_ts().alias("updated_at"),
    )


def cost_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    bu, shared_with, is_shared = _shared_dimension(k, 20)
    return p.select(
        k.alias("cc_key"),
        F.col("p_name").alias("name"),
        group_of(k).alias("business_group"),
        is_shared.alias("is_shared"),
        shared_with.alias("shared_with"),
        bu.alias("bu_id"),
        _flag(k % 10 == 7).alias("is_deleted"),
        _static_ts().alias("updated_at"),
    )


def gl_invoice_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_id"),
        bu_of(F.col("l_partkey")).alias("bu_id"),
        F.col("l_suppkey").alias("vendor_key"),
        F.col("l_partkey").alias("cc_key"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_shipdate").alias("updated_at"),
        _flag((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("is_deleted"),
    )


# what the invoice documents say beside the ledger columns
CURRENCIES = ("USD", "EUR", "GBP")


def invoice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with every field of the landing contract, instants as text."""
    li = read_table(spark, sf_dir, "lineitem")
    at = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    currency = F.col("l_suppkey") % 3
    return li.select(
        F.concat(F.lit("INV-"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("invoice_id"),
        bu_of(F.col("l_partkey")).alias("bu_id"),
        F.concat(F.lit("V-"), F.col("l_suppkey").cast("string")).alias("vendor_key"),
        F.concat(F.lit("CC-"), F.col("l_partkey").cast("string")).alias("cc_key"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.when(currency == 0, CURRENCIES[0]).when(currency == 1, CURRENCIES[1]).otherwise(CURRENCIES[2]).alias("currency"),
        F.col("l_quantity").cast(MONEY).alias("tax_amount"),
        at.alias("invoice_date"), at.alias("due_date"),
        F.when(F.col("l_linestatus") == "F", "PAID").otherwise("OPEN").alias("status"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("NET"), F.col("l_linenumber").cast("string"))).alias("payment_terms"),
        _flag(F.col("l_returnflag") == "A").alias("is_deleted"),
        at.alias("updated_at"),
    )


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic CDC feed: key ``user_id``, sequence ``ts``, an error event deletes."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "user_id", "event_id", "ts", "event_type", "value", "props",
        _flag(F.col("event_type") == "error").alias("is_deleted"),
    )


ENTITIES = {
    "companies": companies,
    "contacts": contacts,
    "deals": deals,
    "vendors": vendors,
    "cost_centers": cost_centers,
    "gl_invoices": gl_invoice_changes,
}
