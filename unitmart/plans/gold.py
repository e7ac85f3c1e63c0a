"""Gold and enterprise layers composed from batch silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..model import BUSINESS_UNITS
from ..operators import enterprise, marts
from .silver import silver


# what the sales mart reads of a deal
DEAL_COLUMNS = ("business_group", "amount", "stage")


def sales_mart(spark: SparkSession, sf_dir: str,
               units: Sequence[str] = BUSINESS_UNITS) -> DataFrame:
    return marts.sales_mart(silver(spark, sf_dir, "deals", units, columns=DEAL_COLUMNS))


def finance_mart(spark: SparkSession, sf_dir: str,
                 units: Sequence[str] = BUSINESS_UNITS) -> DataFrame:
    return marts.finance_mart(silver(spark, sf_dir, "gl_invoices", units, columns=()),
                              silver(spark, sf_dir, "cost_centers", units, columns=("business_group",)))


def customer_mart(spark: SparkSession, sf_dir: str,
                  units: Sequence[str] = BUSINESS_UNITS) -> DataFrame:
    return marts.customer_mart(silver(spark, sf_dir, "companies", units, columns=("business_group",)),
                               silver(spark, sf_dir, "contacts", units, columns=("company_id",)),
                               silver(spark, sf_dir, "deals", units, columns=("company_id", "amount")))


def sales_performance(spark: SparkSession, sf_dir: str,
                      units: Sequence[str] = BUSINESS_UNITS) -> DataFrame:
    return enterprise.bu_sales_performance(sales_mart(spark, sf_dir, units))


def finance_performance(spark: SparkSession, sf_dir: str,
                        units: Sequence[str] = BUSINESS_UNITS) -> DataFrame:
    return enterprise.bu_finance_performance(finance_mart(spark, sf_dir, units))


def customer_performance(spark: SparkSession, sf_dir: str,
                         units: Sequence[str] = BUSINESS_UNITS) -> DataFrame:
    return enterprise.bu_customer_performance(customer_mart(spark, sf_dir, units))
