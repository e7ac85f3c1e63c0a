"""Data model: tenants, object schemas and keys.

Every tenant-scoped table carries a ``bu_id`` column; isolation is a
partition filter, not a separate catalog. Money is ``decimal(18,2)`` inside
the engine and becomes ``double`` only in report projections.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the behaviour being rebuilt.
# ---------------------------------------------------------------------------
BUSINESS_UNITS = ("bu_01", "bu_02", "bu_03", "bu_04", "bu_05", "bu_06")
SHARED_BU = "SHARED"
UNKNOWN_BU = "UNKNOWN"
BUSINESS_GROUPS = ("bg_direct", "bg_partner", "bg_online")
WON_STAGES = ("closed won", "won")
SHARED_WITH_SEPARATOR = r"\|"
SOURCE_SYSTEMS = {
    "crm": ("companies", "contacts", "deals"),
    "erp": ("vendors", "cost_centers", "gl_invoices"),
}
AUDIT_SUCCESS = "SUCCESS"
AUDIT_FAILED = "FAILED"
PAGE_DEFAULT_LIMIT = 100
PAGE_MAX_LIMIT = 500
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)

LINEAGE_FIELDS = [
    T.StructField("_ingested_at", T.StringType()),
    T.StructField("_source_system", T.StringType()),
    T.StructField("_source_object", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
]


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields] + LINEAGE_FIELDS)


S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

# The landing contract of the source objects, field names and
# types in source order (instants stay strings until staging normalises them;
# unknown fields are dropped by ``from_json``).
LANDING_SCHEMAS: dict[str, T.StructType] = {
    "companies": _schema(
        ("company_id", S), ("name", S), ("domain", S), ("industry", S), ("country", S),
        ("employee_count", L), ("annual_revenue", D), ("owner_rep", S), ("is_active", B),
        ("business_group", S), ("bu_id", S), ("is_deleted", I), ("created_at", S),
        ("updated_at", S),
    ),
    "contacts": _schema(
        ("contact_id", S), ("company_id", S), ("first_name", S), ("last_name", S),
        ("email", S), ("phone", S), ("job_title", S), ("lifecycle_stage", S), ("bu_id", S),
        ("is_deleted", I), ("created_at", S), ("updated_at", S),
    ),
    "deals": _schema(
        ("deal_id", S), ("company_id", S), ("name", S), ("amount", MONEY), ("currency", S),
        ("stage", S), ("probability", D), ("close_date", S), ("owner_rep", S),
        ("business_group", S), ("bu_id", S), ("is_deleted", I), ("created_at", S),
        ("updated_at", S),
    ),
    "vendors": _schema(
        ("vendor_key", S), ("name", S), ("category", S), ("country", S), ("is_shared", I),
        ("shared_with", S), ("bu_id", S), ("is_deleted", I), ("updated_at", S),
    ),
    "cost_centers": _schema(
        ("cc_key", S), ("name", S), ("department", S), ("business_group", S),
        ("is_shared", I), ("shared_with", S), ("bu_id", S), ("is_deleted", I),
        ("updated_at", S),
    ),
    "gl_invoices": _schema(
        ("invoice_id", S), ("bu_id", S), ("vendor_key", S), ("cc_key", S), ("amount", MONEY),
        ("currency", S), ("tax_amount", MONEY), ("invoice_date", S), ("due_date", S),
        ("status", S), ("payment_terms", S), ("is_deleted", I), ("updated_at", S),
    ),
}


# What each source relation requires of its rows.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "vendors": ("vendor_key", "name", "bu_id", "updated_at"),
    "cost_centers": ("cc_key", "name", "bu_id", "updated_at"),
    "gl_invoices": ("invoice_id", "bu_id", "vendor_key", "cc_key", "amount", "updated_at"),
}


@dataclass(frozen=True)
class ObjectSpec:
    """How one source object becomes a silver table."""

    name: str
    source_system: str
    keys: tuple[str, ...]
    shared: bool = False  # dimension rows may be shared between tenants
    sequence: str = "updated_at"
    delete_flag: str = "is_deleted"
    # Extra ordering after (sequence, delete) so equal timestamps resolve
    # deterministically; the reference has none.
    tie_breakers: tuple[str, ...] = ()


OBJECTS: dict[str, ObjectSpec] = {
    "companies": ObjectSpec("companies", "crm", ("company_id",)),
    "contacts": ObjectSpec("contacts", "crm", ("contact_id",)),
    "deals": ObjectSpec("deals", "crm", ("deal_id",)),
    "vendors": ObjectSpec("vendors", "erp", ("vendor_key", "bu_id"), shared=True),
    "cost_centers": ObjectSpec("cost_centers", "erp", ("cc_key", "bu_id"), shared=True),
    "gl_invoices": ObjectSpec(
        "gl_invoices", "erp", ("invoice_id",),
        tie_breakers=("cc_key", "vendor_key", "amount"),
    ),
}

AUDIT_SCHEMA = T.StructType([
    T.StructField("batch_id", S),
    T.StructField("source_system", S),
    T.StructField("source_object", S),
    T.StructField("run_timestamp", T.TimestampType()),
    T.StructField("records_extracted", L),
    T.StructField("watermark_before", T.TimestampNTZType()),
    T.StructField("watermark_after", T.TimestampNTZType()),
    T.StructField("status", S),
    T.StructField("content_digest", S),
    T.StructField("run_id", S),
])
