"""Registered queries that land files, run streams and write packages.

Each run writes under a fresh directory below the shared checkpoint root and
returns a DataFrame over what it wrote, so the result proves the round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import batch_id, digest_aggs
from ..model import BUSINESS_UNITS, LANDING_SCHEMAS, MONEY, OBJECTS, SHARED_BU
from ..operators import governance, marts
from ..operators.publish import materialize, read_table, table_path
from ..session import move_path, scratch_path
from ..sources import binding
from ..sources.extract import instant, parse_instant
from ..sources.ingest import RUNS, audit_table, ingest, object_path, run_of
from ..sources.landing import (JSON_OPTIONS, TENANT, instant_columns, landing_schema,
                               parse_landing, read_landing, write_landing)
from ..sources.drift import rescued_fields
from ..streaming.flows import run_bronze, run_silver, run_staging_to_table
from ..streaming.quality_log import QualityLog, quality_counts
from ..streaming.staging import stage
from ..streaming.state import ChangeTable
from .registry import DIVESTED_UNITS, EXTRACT_WATERMARK, register
from .silver import to_silver, unit_filter

# Fixed parameters of these queries.
SWAPPED = {"vendor_key": "cc_key", "cc_key": "vendor_key"}
LATER_SHARED_WITH = "bu_02|bu_06"  # bu_03 has left the list
LATER_SHARED_AT = "2024-06-01T00:00:00Z"
AUDIT_FIRST_RUN_CUTOFF = "2024-01-15T00:00:00Z"
ROUNDTRIP_RECORDS_PER_FILE = 20_000
OUT_OF_ORDER_BATCHES = 4
CHANGED_UNITS, CHANGED_AT = ("bu_02", "bu_05"), "2030-01-01T00:00:00Z"
LOGGED_BATCHES, ARCHIVED_BATCHES = 2, 3
DRIFT_EVERY = 11
CHANGED_GROUP = "bg_online"
# dq_drop binding: contact changes derived from error events arrive with an
# unparseable timestamp text.
MALFORMED_STAGE = "error"


def _stage_fn(feed: DataFrame, obj: str | None = None, sequence: str = "updated_at"):
    schema = landing_schema(feed.schema)
    instants = instant_columns(feed.schema) or [sequence]
    shared = bool(obj and OBJECTS[obj].shared)
    keys = OBJECTS[obj].keys if obj else ()
    return lambda raw: stage(raw, schema, instants, shared=shared, sequence=sequence, keys=keys)


@register("landing_split")
def q_landing_split(spark, sf_dir):
    """Invoice feed landed as one batch split by tenant; rows and latest change per tenant."""
    root = scratch_path(spark, "landing_split")
    feed = binding.gl_invoice_changes(spark, sf_dir)
    ingest(spark, feed, "erp", "gl_invoices", f"{root}/landing", f"{root}/audit")
    raw = read_landing(spark, f"{root}/landing/erp/gl_invoices")
    rows = parse_landing(raw, landing_schema(feed.schema))
    return rows.groupBy(F.col(TENANT).alias("bu_id")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max(parse_instant("updated_at")).alias("max_updated_at"))


@register("ingest_audit")
def q_ingest_audit(spark, sf_dir):
    """Two incremental runs of the contacts feed; the audit trail they leave."""
    root = scratch_path(spark, "ingest_audit")
    feed = binding.contacts(spark, sf_dir)
    land, audit = f"{root}/landing", f"{root}/audit"
    first = feed.filter(F.col("updated_at") <= instant(AUDIT_FIRST_RUN_CUTOFF))  # feed as of run 1
    ingest(spark, first, "crm", "contacts", land, audit)
    ingest(spark, feed, "crm", "contacts", land, audit)  # run 2 resumes from the stored mark
    return audit_table(spark, audit).drop("batch_id", "run_timestamp", "content_digest")


@register("batch_id_stable")
def q_batch_id_stable(spark, sf_dir):
    """Digests of the invoice feed: the same for the columns in another order,
    another one when two columns swap their values."""
    feed = binding.gl_invoice_changes(spark, sf_dir)
    moved = feed.select(*[F.col(SWAPPED.get(c, c)).alias(c) for c in feed.columns])
    variants = [feed, feed.select(*reversed(feed.columns)), moved]
    digests = [v.agg(*digest_aggs(v), F.sum("amount").alias("_amount")).select(
        F.lit(i).alias("_variant"), "_rows", "_amount", batch_id("gl_invoices", None).alias("_id"))
        for i, v in enumerate(variants)]
    every = digests[0].unionByName(digests[1]).unionByName(digests[2])
    pick = lambda i, c: F.max(F.when(F.col("_variant") == i, F.col(c)))
    return every.agg(
        F.lit("gl_invoices").alias("source_object"),
        pick(0, "_rows").alias("records"), pick(0, "_amount").alias("total_amount"),
        ((pick(0, "_id") == pick(1, "_id")) & (pick(0, "_id") != pick(2, "_id"))).alias("id_stable"),
    )


@register("moved_null_batches")
def q_moved_null_batches(spark, sf_dir):
    """Two batches with one watermark that differ only in which nullable column
    holds a value: both are landed."""
    root = scratch_path(spark, "moved_null_batches")
    feed = binding.deals(spark, sf_dir).select("deal_id", "bu_id", "stage", "updated_at")
    text, none = F.concat(F.lit("s"), "deal_id"), F.lit(None).cast("string")
    first = feed.withColumns({"stage": text, "note": none})
    second = feed.withColumns({"stage": none, "note": text})
    for batch in (first, second):
        ingest(spark, batch, "crm", "deals", f"{root}/landing", f"{root}/audit", use_stored_watermark=False)
    rows = parse_landing(read_landing(spark, f"{root}/landing/crm/deals"), landing_schema(first.schema))
    return rows.groupBy("bu_id").agg(
        F.count("stage").alias("with_stage"), F.count("note").alias("with_note"),
        F.count_distinct("batch").alias("batches"))


@register("two_systems_one_feed")
def q_two_systems_one_feed(spark, sf_dir):
    """One feed landed under two systems with one audit: each system has its
    own batch and watermark, and replays of each land nothing."""
    root = scratch_path(spark, "two_systems_one_feed")
    feed = binding.contacts(spark, sf_dir)
    land, audit = f"{root}/landing", f"{root}/audit"
    for system in ("crm", "erp", "crm", "erp"):
        ingest(spark, feed, system, "contacts", land, audit, use_stored_watermark=False)
    parts = [parse_landing(read_landing(spark, f"{land}/{system}/contacts"), landing_schema(feed.schema))
             for system in ("crm", "erp")]
    return parts[0].unionByName(parts[1]).groupBy(F.col("_source_system").alias("source_system"), "bu_id").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("_batch_id").alias("batches"),
        F.max(parse_instant("updated_at")).alias("max_updated_at"))


@register("landing_recovery")
def q_landing_recovery(spark, sf_dir):
    """A run that crashed before its audit row and one that crashed after it:
    the first leaves nothing, the second is published by the next run."""
    root = scratch_path(spark, "landing_recovery")
    feed = binding.contacts(spark, sf_dir)
    land, audit = f"{root}/landing", f"{root}/audit"
    path = object_path(land, "crm", "contacts")
    first = feed.filter(F.col("updated_at") <= instant(AUDIT_FIRST_RUN_CUTOFF))
    write_landing(feed, f"{path}/{RUNS}/lost")  # never audited
    done = ingest(spark, first, "crm", "contacts", land, audit)
    move_path(spark, done.path, f"{path}/{RUNS}/{run_of(spark, audit, done.batch_id)}")  # audited, not yet renamed
    ingest(spark, feed, "crm", "contacts", land, audit)
    rows = parse_landing(read_landing(spark, path), landing_schema(feed.schema))
    log = audit_table(spark, audit).select(F.col("batch_id").alias("_batch_id"), "watermark_before", "records_extracted")
    return rows.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("records")).join(log, "_batch_id") \
        .select("records", "records_extracted", "watermark_before")


@register("replay_idempotent")
def q_replay_idempotent(spark, sf_dir):
    """Land a batch and replay it twice: one copy is landed."""
    root = scratch_path(spark, "replay_idempotent")
    feed = binding.contacts(spark, sf_dir)
    land, audit = f"{root}/landing", f"{root}/audit"
    runs = [ingest(spark, feed, "crm", "contacts", land, audit, watermark=EXTRACT_WATERMARK) for _ in range(3)]
    if len({r.batch_id for r in runs}) != 1 or [r.status for r in runs[1:]] != ["SKIPPED"] * 2:
        raise RuntimeError(f"replay was not idempotent: {runs}")
    staged = stage(read_landing(spark, f"{land}/crm/contacts"), landing_schema(feed.schema),
                   instant_columns(feed.schema))
    return staged.select(*feed.columns)


@register("landing_roundtrip")
def q_landing_roundtrip(spark, sf_dir):
    """Deals landed as JSON arrays, streamed into bronze, parsed and staged."""
    root = scratch_path(spark, "landing_roundtrip")
    feed = binding.deals(spark, sf_dir)
    ingest(spark, feed, "crm", "deals", f"{root}/landing", f"{root}/audit", fmt="array",
           records_per_file=ROUNDTRIP_RECORDS_PER_FILE)
    run_bronze(spark, f"{root}/landing/crm/deals", f"{root}/bronze", f"{root}/ck/bronze", "array")
    run_staging_to_table(spark, f"{root}/bronze", f"{root}/staged", f"{root}/ck/staged",
                         _stage_fn(feed, "deals"))
    return spark.read.parquet(f"{root}/staged").select(*feed.columns)


@register("landed_invoice_documents")
def q_landed_invoice_documents(spark, sf_dir):
    """Invoices with the full landing contract: landed as JSON arrays that are
    pretty-printed over many lines, streamed, parsed with the declared schema
    and staged."""
    root = scratch_path(spark, "landed_invoice_documents")
    feed = binding.invoice_documents(spark, sf_dir)
    landing, schema = f"{root}/landing", LANDING_SCHEMAS["gl_invoices"]
    write_landing(feed, f"{landing}/batch=0", "array", records_per_file=ROUNDTRIP_RECORDS_PER_FILE, pretty=True)
    run_bronze(spark, landing, f"{root}/bronze", f"{root}/ck/bronze", "array")
    run_staging_to_table(spark, f"{root}/bronze", f"{root}/staged", f"{root}/ck/staged",
                         lambda raw: stage(raw, schema, ("updated_at", "invoice_date", "due_date"),
                                           keys=OBJECTS["gl_invoices"].keys))
    return spark.read.parquet(f"{root}/staged").select(*feed.columns)


@register("dq_drop")
def q_dq_drop(spark, sf_dir):
    """Contacts whose instant text is malformed are dropped."""
    root = scratch_path(spark, "dq_drop")
    feed = binding.contacts(spark, sf_dir)
    text = F.when(F.col("lifecycle_stage") == MALFORMED_STAGE, F.lit("not-a-timestamp")) \
        .otherwise(F.date_format("updated_at", JSON_OPTIONS["timestampNTZFormat"]))
    write_landing(feed.withColumn("updated_at", text), f"{root}/landing/batch=0")
    staged = stage(read_landing(spark, f"{root}/landing"), landing_schema(feed.schema))
    return staged.select(*feed.columns)


@register("scd1_out_of_order")
def q_scd1_out_of_order(spark, sf_dir):
    """The events CDC feed applied by the streaming silver flow in batches that
    arrive newest first; must equal the one-shot current state."""
    root = scratch_path(spark, "scd1_out_of_order")
    feed = binding.event_changes(spark, sf_dir)
    lo, hi = feed.agg(F.unix_micros(F.min("ts").cast("timestamp")),
                      F.unix_micros(F.max("ts").cast("timestamp"))).first()
    step = (hi - lo) // OUT_OF_ORDER_BATCHES + 1
    part = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(lo)) / F.lit(step))
    table = ChangeTable(spark, f"{root}/state", ["user_id"], sequence="ts")
    stage_fn = _stage_fn(feed, sequence="ts")
    for i in reversed(range(OUT_OF_ORDER_BATCHES)):
        own = F.coalesce(part, F.lit(0)) == i  # a change without a time comes last
        write_landing(feed.filter(own), f"{root}/landing/batch={i}", tenant_col=None)
        run_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ck/bronze",
                   partitions=("batch",))
        run_silver(spark, f"{root}/bronze", f"{root}/ck/silver", stage_fn, table,
                   partitions=("batch",))
        if i == OUT_OF_ORDER_BATCHES // 2:
            table.compact()  # later batches are merged with a snapshot
    return table.view().select(*feed.columns)


@register("divest_manifest")
def q_divest_manifest(spark, sf_dir):
    """Hand-over package of the divested unit (silver incl. shared dimensions,
    gold slice) written to its own directory, with a verified manifest."""
    root = scratch_path(spark, "divest_manifest")
    units = DIVESTED_UNITS
    deals = to_silver(unit_filter(binding.deals(spark, sf_dir), units), "deals", units)
    tables = {
        "deals": (deals, "amount"),
        "gl_invoices": (to_silver(unit_filter(binding.gl_invoice_changes(spark, sf_dir), units),
                                  "gl_invoices", units), "amount"),
        "cost_centers": (to_silver(binding.cost_centers(spark, sf_dir), "cost_centers", units), None),
        "vendors": (to_silver(binding.vendors(spark, sf_dir), "vendors", units), None),
        "sales_mart": (lambda path: marts.sales_mart(spark.read.parquet(f"{path}/deals")), "pipeline_value_usd"),
    }
    return governance.handover_package(spark, f"{root}/package", tables)



@register("package_tree")
def q_package_tree(spark, sf_dir):
    """Digest tree of a package whose deals lie in partitions by group, checked
    after one partition was changed: rows of every part, and what still holds."""
    path = scratch_path(spark, "package_tree")
    units = DIVESTED_UNITS
    deals = to_silver(unit_filter(binding.deals(spark, sf_dir), units), "deals", units)
    deals.write.partitionBy("business_group").parquet(f"{path}/deals")
    to_silver(binding.vendors(spark, sf_dir), "vendors", units).write.parquet(f"{path}/vendors")
    tables = ("deals", "vendors")
    stored = governance.write_digest_tree(spark, path, tables)
    part = f"{path}/deals/business_group={CHANGED_GROUP}"
    altered = scratch_path(spark, "package_tree_altered")
    spark.read.parquet(part).withColumn("stage", F.lit("altered")).write.parquet(altered)
    spark.read.parquet(altered).write.mode("overwrite").parquet(part)
    checked = governance.check_entries(stored, governance.digest_tree(spark, path, tables))
    return checked.where("level <> 'file'").drop("file")


@register("mart_refresh")
def q_mart_refresh(spark, sf_dir):
    """Sales mart of all units, then one unit published anew after its amounts
    doubled; the table read back is the whole mart with that unit's new rows."""
    from .refresh import refresh
    base = scratch_path(spark, "mart_refresh")
    paths = refresh(spark, sf_dir, base, mart_names=("sales_mart",), rollups=False)
    doubled = binding.deals(spark, sf_dir).withColumn("amount", (F.col("amount") * 2).cast(MONEY))
    refresh(spark, sf_dir, base, units=("bu_02",), mart_names=("sales_mart",), rollups=False,
            feeds={"deals": doubled})
    return spark.read.parquet(paths["sales_mart"])


@register("refresh_forgets")
def q_refresh_forgets(spark, sf_dir):
    """Two units lose all rows: one before a full refresh, one before a refresh
    of its own; nothing of them is left in the sales mart."""
    from .refresh import refresh
    base = scratch_path(spark, "refresh_forgets")
    feed = binding.deals(spark, sf_dir)
    run = lambda lost, **kw: refresh(
        spark, sf_dir, base, mart_names=("sales_mart",), rollups=False,
        feeds={"deals": feed.filter(~F.col("bu_id").isin(lost))}, **kw)
    run([])
    run(["bu_03"])
    return spark.read.parquet(run(["bu_03", "bu_05"], units=("bu_05",))["sales_mart"])


@register("changed_units_refresh")
def q_changed_units_refresh(spark, sf_dir):
    """Deals in two batches, the second with doubled amounts of two units: after
    the second publication only these units' files are new."""
    from .lakehouse import publish_changed
    from .stream_refresh import stream_object
    root = scratch_path(spark, "changed_units_refresh")
    feed = binding.deals(spark, sf_dir)
    later = feed.filter(F.col("bu_id").isin(*CHANGED_UNITS)).withColumns({
        "amount": (F.col("amount") * 2).cast(MONEY), "updated_at": instant(CHANGED_AT)})
    path, files = table_path(root, "gold", "sales_mart"), []
    for batch in (feed, later):
        ingest(spark, batch, "crm", "deals", f"{root}/landing", f"{root}/audit")
        table = stream_object(spark, root, "crm", "deals", feed.schema)
        publish_changed(spark, {"deals": table}, {"deals": feed.schema}, root, ("sales_mart",))
        # each unit's files, as they are after this publication
        listed = f"{root}/files{len(files)}"
        read_table(spark, path).select("bu_id", F.col("_metadata.file_path").alias("file")).distinct().write.parquet(listed)
        files.append(spark.read.parquet(listed))
    kept = files[1].join(files[0], ["bu_id", "file"], "left_semi").select("bu_id").distinct()
    mart = read_table(spark, path)
    return mart.join(kept.withColumn("_kept", F.lit(True)), "bu_id", "left").select(
        *mart.columns, F.col("_kept").isNull().alias("republished"))


@register("quality_log")
def q_quality_log(spark, sf_dir):
    """Flawed deals in two batches through the streaming gate: rows that each
    rule saw or rejected, per flow and batch, from the stored log."""
    from .stream_refresh import stream_object
    root = scratch_path(spark, "quality_log")
    feed = binding.flawed_deals(spark, sf_dir)
    with QualityLog(spark, f"{root}/quality_log") as log:
        for part in range(LOGGED_BATCHES):
            ingest(spark, feed.filter(F.col("deal_id") % LOGGED_BATCHES == part), "crm", "deals", f"{root}/landing",
                   f"{root}/audit", use_stored_watermark=False)
            stream_object(spark, root, "crm", "deals", feed.schema, log=log)
    return quality_counts(spark, f"{root}/quality_log").drop("detail")


def _drifted(spark, sf_dir, root):
    """Deals landed in two batches: the second has a field more and gives the
    amount as text. The state, with what was rescued."""
    from .stream_refresh import stream_object
    feed = binding.deals(spark, sf_dir)
    drifts = F.col("deal_id") % DRIFT_EVERY == 0
    later = feed.filter(drifts).withColumns({
        "amount": F.concat(F.lit("USD "), F.col("amount").cast("string")),
        "channel": F.struct((F.col("deal_id") % 3).alias("kind"), F.lit("web").alias("name"))})
    for batch in (feed.filter(~drifts), later):
        ingest(spark, batch, "crm", "deals", f"{root}/landing", f"{root}/audit", use_stored_watermark=False)
    return feed, stream_object(spark, root, "crm", "deals", feed.schema, rescue=True).view()


@register("drifted_deals")
def q_drifted_deals(spark, sf_dir):
    """Current deals after the feed drifted: typed columns as declared, and what
    was rescued of the text amounts and of the new field."""
    feed, view = _drifted(spark, sf_dir, scratch_path(spark, "drifted_deals"))
    return view.select(*feed.columns, F.try_variant_get("_rescued", "$.amount", "string").alias("rescued_amount"),
                       F.try_variant_get("_rescued", "$.channel.kind", "bigint").alias("rescued_kind"))


@register("rescued_fields")
def q_rescued_fields(spark, sf_dir):
    """Rescued fields of the current deals, counted by name, with their types."""
    return rescued_fields(_drifted(spark, sf_dir, scratch_path(spark, "rescued_fields"))[1])


@register("archived_landing")
def q_archived_landing(spark, sf_dir):
    """Contacts landed in batches, each followed by a run of the bronze flow that
    archives what is done with: rows per batch, and whether landed files of it
    are still listed."""
    root = scratch_path(spark, "archived_landing")
    feed = binding.contacts(spark, sf_dir)
    landing, batches = object_path(f"{root}/landing", "crm", "contacts"), []
    for part in range(ARCHIVED_BATCHES):
        done = ingest(spark, feed.filter(F.col("contact_id") % ARCHIVED_BATCHES == part), "crm", "contacts",
                      f"{root}/landing", f"{root}/audit", use_stored_watermark=False)
        batches.append((done.batch_id, part))
        run_bronze(spark, landing, f"{root}/bronze", f"{root}/ck/bronze", archive=f"{root}/archive")
    listed = read_landing(spark, landing).select("batch").distinct().withColumn("_listed", F.lit(True))
    bronze = spark.read.parquet(f"{root}/bronze").groupBy("batch").agg(F.count(F.lit(1)).alias("records"))
    return bronze.join(spark.createDataFrame(batches, "batch string, part bigint"), "batch").join(listed, "batch", "left") \
        .select("part", "records", F.col("_listed").isNull().alias("archived"))


@register("isolated_rollup")
def q_isolated_rollup(spark, sf_dir):
    """Enterprise roll-up of marts that each unit keeps under a place of its
    own, with a prefix: the by-name union of the unit marts."""
    from .refresh import refresh
    paths = refresh(spark, sf_dir, scratch_path(spark, "isolated_rollup"), mart_names=("sales_mart",),
                    prefix="ci_", layout="isolated")
    return spark.read.parquet(paths["bu_sales_performance"])


@register("streamed_gated_sales_mart")
def q_streamed_gated_sales_mart(spark, sf_dir):
    """The flawed deals landed, streamed and gated: the mart equals the batch
    path's (``gated_sales_mart``)."""
    from .stream_refresh import silver_view, stream_object
    root = scratch_path(spark, "streamed_gated_sales_mart")
    feed = binding.flawed_deals(spark, sf_dir)
    ingest(spark, feed, "crm", "deals", f"{root}/landing", f"{root}/audit")
    return marts.sales_mart(silver_view(stream_object(spark, root, "crm", "deals", feed.schema), feed.schema))


@register("empty_first_batch")
def q_empty_first_batch(spark, sf_dir):
    """A first batch of which the gate rejects every row, then all flawed deals:
    state and mart are empty tables first, with their columns, then the gated
    mart."""
    from .stream_refresh import silver_view, stream_object
    root = scratch_path(spark, "empty_first_batch")
    feed = binding.flawed_deals(spark, sf_dir)
    admitted = F.coalesce(F.col("bu_id").isin(list(BUSINESS_UNITS)), F.lit(False)) & F.col("updated_at").isNotNull()
    counts, path = [], table_path(root, "gold", "sales_mart")
    for batch in (feed.filter(~admitted), feed):
        ingest(spark, batch, "crm", "deals", f"{root}/landing", f"{root}/audit", use_stored_watermark=False)
        view = silver_view(stream_object(spark, root, "crm", "deals", feed.schema), feed.schema)
        materialize(marts.sales_mart(view), path)
        counts.append(read_table(spark, path).count())
    return read_table(spark, path).withColumn("rows_before", F.lit(counts[0]).cast("bigint"))


@register("streamed_lost_entitlement")
def q_streamed_lost_entitlement(spark, sf_dir):
    """Cost centres in two batches: in the second the shared ones are no longer
    shared with one unit, which then has none of them."""
    from .stream_refresh import silver_view, stream_object
    root = scratch_path(spark, "streamed_lost_entitlement")
    feed = binding.cost_centers(spark, sf_dir)
    later = feed.filter(F.col("bu_id") == SHARED_BU).withColumns({
        "shared_with": F.lit(LATER_SHARED_WITH), "updated_at": instant(LATER_SHARED_AT)})
    for batch in (feed, later):
        ingest(spark, batch, "erp", "cost_centers", f"{root}/landing", f"{root}/audit")
        table = stream_object(spark, root, "erp", "cost_centers", feed.schema, revoke=True)
    return silver_view(table, feed.schema)


@register("streamed_customer_mart")
def q_streamed_customer_mart(spark, sf_dir):
    """Companies, contacts and deals ingested, streamed through bronze and the
    tenant-keyed silver state (the three objects' flows run concurrently),
    then the customer mart from the state views (must equal the batch mart)."""
    from .stream_refresh import silver_view, stream_objects
    root = scratch_path(spark, "streamed_customer_mart")
    feeds = {obj: binding.ENTITIES[obj](spark, sf_dir) for obj in ("companies", "contacts", "deals")}
    for obj, feed in feeds.items():
        ingest(spark, feed, "crm", obj, f"{root}/landing", f"{root}/audit")
    tables = stream_objects(spark, root, {obj: ("crm", f.schema) for obj, f in feeds.items()})
    views = {obj: silver_view(tables[obj], feeds[obj].schema) for obj in feeds}
    return marts.customer_mart(views["companies"], views["contacts"], views["deals"])


@register("streamed_finance_mart")
def q_streamed_finance_mart(spark, sf_dir):
    """Invoice changes and cost centres (shared rows re-homed in staging)
    ingested, streamed through bronze and the tenant-keyed silver state, then
    the finance mart from the state views (must equal the batch mart)."""
    from .stream_refresh import silver_view, stream_objects
    root = scratch_path(spark, "streamed_finance_mart")
    feeds = {obj: binding.ENTITIES[obj](spark, sf_dir) for obj in ("gl_invoices", "cost_centers")}
    for obj, feed in feeds.items():
        ingest(spark, feed, "erp", obj, f"{root}/landing", f"{root}/audit")
    tables = stream_objects(spark, root, {obj: ("erp", f.schema) for obj, f in feeds.items()})
    views = {obj: silver_view(tables[obj], feeds[obj].schema) for obj in feeds}
    return marts.finance_mart(views["gl_invoices"], views["cost_centers"])
