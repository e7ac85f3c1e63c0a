"""Publication of changed units, vendor bitmaps, schema drift, the quality log
and archived landing files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMOKE_DIR, rows
from unitmart.model import LANDING_SCHEMAS, OBJECTS
from unitmart.operators import enterprise, marts
from unitmart.operators.publish import read_table, table_path
from unitmart.plans.lakehouse import publish_changed, published_upto
from unitmart.plans.stream_refresh import state_table, stream_object
from unitmart.session import list_names
from unitmart.sources.drift import rescued_fields
from unitmart.sources.ingest import ingest
from unitmart.sources.landing import parse_landing, read_landing, write_landing
from unitmart.streaming.flows import run_bronze
from unitmart.streaming.quality_log import QualityLog, quality_counts
from unitmart.streaming.staging import stage

DEAL = "deal_id long, bu_id string, business_group string, stage string, amount decimal(18,2), t string, is_deleted int"


def deals(spark, data):
    return spark.createDataFrame([(k, u, "bg_online", "won", None if a is None else __import__("decimal").Decimal(a), t, d)
                                  for k, u, a, t, d in data], DEAL).withColumn(
        "updated_at", F.col("t").cast("timestamp_ntz")).drop("t")


def files(spark, path):
    return {(r[0], r[1]) for r in read_table(spark, path).select("bu_id", "_metadata.file_path").distinct().collect()}


def test_only_touched_units_are_published(spark, scratch):
    schemas = {"deals": deals(spark, []).schema}
    table = state_table(spark, scratch, "deals")
    gold, perf = table_path(scratch, "gold", "sales_mart"), table_path(scratch, "enterprise", "bu_sales_performance")
    run = lambda: publish_changed(spark, {"deals": table}, schemas, scratch, ("sales_mart",))

    table.append(deals(spark, [(k, f"bu_0{k % 4 + 1}", 10, "2024-01-01 00:00:00", 0) for k in range(12)]), 0)
    assert run() == {"sales_mart": None} and run() == {"sales_mart": []}  # all, then nothing new
    first, first_perf = files(spark, gold), files(spark, perf)
    # one unit changes, one loses all its rows, one is new
    table.append(deals(spark, [(1, "bu_02", 99, "2024-02-01 00:00:00", 0), (50, "bu_06", 5, "2024-02-01 00:00:00", 0)]
                       + [(k, "bu_04", 10, "2024-02-01 00:00:00", 1) for k in (3, 7, 11)]), 1)
    assert table.touched(0) == ["bu_02", "bu_04", "bu_06"] and table.touched(1) == []
    assert run() == {"sales_mart": ["bu_02", "bu_04", "bu_06"]}
    for before, now in ((first, files(spark, gold)), (first_perf, files(spark, perf))):
        assert {u for u, _ in before & now} == {"bu_01", "bu_03"} and {u for u, _ in now - before} == {"bu_02", "bu_06"}
    whole = marts.sales_mart(table.view())
    assert rows(read_table(spark, gold).select(*whole.columns)) == rows(whole)
    assert rows(read_table(spark, perf), "bu_id", "deal_count") == [("bu_01", 3), ("bu_02", 3), ("bu_03", 3), ("bu_06", 1)]
    # a compaction hides which units its batches touched: all are published
    table.append(deals(spark, [(2, "bu_03", 7, "2024-03-01 00:00:00", 0)]), 2)
    table.compact()
    assert table.touched(1) is None and table.last_batch() == 2 and run() == {"sales_mart": None}
    assert run() == {"sales_mart": []} and published_upto(spark, scratch, "sales_mart") == {"deals": 2}
    table.append(deals(spark, []), 3)  # an empty batch touches nobody
    assert run() == {"sales_mart": []}


def test_a_crash_before_the_note_repeats_the_same_units(spark, scratch, monkeypatch):
    from unitmart.plans import lakehouse
    schemas, table = {"deals": deals(spark, []).schema}, state_table(spark, scratch, "deals")
    table.append(deals(spark, [(1, "bu_01", 1, "2024-01-01 00:00:00", 0), (2, "bu_02", 1, "2024-01-01 00:00:00", 0)]), 0)
    run = lambda: publish_changed(spark, {"deals": table}, schemas, scratch, ("sales_mart",))
    run()
    table.append(deals(spark, [(1, "bu_01", 5, "2024-01-02 00:00:00", 0)]), 1)
    with monkeypatch.context() as m:
        m.setitem(lakehouse.ROLLUPS, "bu_sales_performance", ("sales_mart", lambda df: df.select("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert run() == {"sales_mart": ["bu_01"]} and run() == {"sales_mart": []}
    assert rows(read_table(spark, table_path(scratch, "enterprise", "bu_sales_performance")), "bu_id", "deal_count") == [
        ("bu_01", 1), ("bu_02", 1)]


def test_vendor_bitmaps_count_exactly(spark):
    inv = spark.range(4000).select(
        F.col("id").alias("invoice_id"), F.concat(F.lit("bu_0"), (F.col("id") % 3 + 1).cast("string")).alias("bu_id"),
        (F.col("id") % 7).alias("cc_key"),
        F.when(F.col("id") % 13 != 0, F.pmod(F.hash("id"), F.lit(70_000)).cast("bigint") * 1_000_003 - 5).alias("vendor_key"))
    cc = spark.createDataFrame([(k, f"bu_0{u}", f"g{k % 2}") for k in range(6) for u in (1, 2, 3)],
                               "cc_key long, bu_id string, business_group string")
    reach = enterprise.vendor_reach(marts.vendor_bitmaps(inv, cc))
    joined = inv.join(cc, ["cc_key", "bu_id"], "left").where("vendor_key is not null")
    want = [("group", *r) for r in joined.groupBy("bu_id", "business_group").agg(F.count_distinct("vendor_key")).collect()]
    want += [("unit", r[0], None, r[1]) for r in joined.groupBy("bu_id").agg(F.count_distinct("vendor_key")).collect()]
    want += [("enterprise", None, None, joined.select("vendor_key").distinct().count())]
    assert rows(reach) == sorted((tuple(w) for w in want), key=repr)
    with pytest.raises(TypeError, match="whole-number"):
        marts.vendor_bitmaps(inv.withColumn("vendor_key", F.lit("V-1")), cc)


TEXTS = [
    '[{"deal_id": "1", "amount": "n/a", "extra": {"a": [1, 2]}, "bu_id": "bu_01", "updated_at": "2024-01-01T00:00:00Z"},'
    ' {"deal_id": "2", "amount": 3.5, "note": null, "bu_id": "bu_01", "updated_at": "2024-01-01T00:00:00Z"}]',
    '{"deal_id": "3", "channel": "web", "channel": "shop", "bu_id": "bu_01", "updated_at": "2024-01-01T00:00:00Z"}',
    '{"deal_id": "4", "is_deleted": "x", "channel": 5, "bu_id": "bu_01", "updated_at": "2024-01-01T00:00:00Z"}',
    "not json", "[null]", "[]", "",
]


def test_drifted_fields_are_rescued_beside_unchanged_typed_rows(spark):
    raw = spark.createDataFrame([(t, "bu_01") for t in TEXTS], "value string, tenant string")
    schema = LANDING_SCHEMAS["deals"]
    plain, kept = parse_landing(raw, schema), parse_landing(raw, schema, rescue=True)
    assert rows(kept.drop("_rescued")) == rows(plain)
    got = {r.deal_id: r.j for r in kept.select("deal_id", F.to_json("_rescued").alias("j")).collect()}
    assert got == {"1": '{"amount":"n/a","extra":{"a":[1,2]}}', "2": None, "3": got["3"], "4": '{"channel":5,"is_deleted":"x"}',
                   None: None}
    assert got["3"] in ('{"channel":"web"}', '{"channel":"shop"}')
    counted = {r.field: (r.records, r.type) for r in rescued_fields(stage(raw, schema, rescue=True)).collect()}
    assert {k: n for k, (n, _) in counted.items()} == {"amount": 1, "extra": 1, "channel": 2, "is_deleted": 1}
    assert counted["channel"][1] == "VARIANT" and counted["extra"][1] == "OBJECT<a: ARRAY<BIGINT>>"


def test_only_records_with_a_lost_field_are_parsed_again(spark):
    from unitmart.sources.drift import field_count, raw_fields
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    want = {  # text: (parsed again, rescued)
        '{"a": 1, "b": "x"}': (False, None), '{"a": 1}': (False, None), "{}": (False, None),
        '{"a": "n", "b": "x"}': (True, '{"a":"n"}'), '{"a": 1, "c": [2]}': (True, '{"c":[2]}'),
        '{"a": 1, "b": null}': (True, None), '{"b": "x", "b": "x"}': (True, None), ' {"c": {"a": 1}}': (True, '{"c":{"a":1}}'),
        "{'a': 1, 'c': 2}": (True, '{"c":2}'), '{"A": 1}': (True, '{"A":1}'),
    }
    raw = spark.createDataFrame([(t,) for t in want], "value string")
    got = {r.t: r.j for r in parse_landing(raw.withColumn("t", F.col("value")), schema, rescue=True)
           .select("t", F.to_json("_rescued").alias("j")).collect()}
    assert got == {t: j for t, (_, j) in want.items()}
    again = raw_fields(F.lit(None).cast("map<string,variant>"), F.col("value"), field_count(F.col("value")), F.col("typed"), schema)
    typed = raw.select("value", F.from_json("value", schema).alias("typed"))
    assert {r.value: r.p for r in typed.select("value", again.isNotNull().alias("p")).collect()} == {t: p for t, (p, _) in want.items()}


def test_rescued_fields_reach_the_state(spark, scratch):
    feed = deals(spark, [(1, "bu_01", 1, "2024-01-01 00:00:00", 0)]).withColumn("channel", F.lit("web"))
    ingest(spark, feed, "crm", "deals", f"{scratch}/landing", f"{scratch}/audit")
    table = stream_object(spark, scratch, "crm", "deals", feed.drop("channel").schema, rescue=True)
    table.compact()
    assert [r[0] for r in table.view().select(F.variant_get("_rescued", "$.channel", "string")).collect()] == ["web"]


def test_quality_log_keeps_counts_and_failures(spark, scratch):
    good = [(1, "bu_01", 1, "2024-01-01 00:00:00", 0), (2, "bu_09", 1, "2024-01-01 00:00:00", 0), (3, "bu_02", 1, None, 0)]
    path = f"{scratch}/quality_log"
    with QualityLog(spark, path) as log:
        ingest(spark, deals(spark, good), "crm", "deals", f"{scratch}/landing", f"{scratch}/audit", use_stored_watermark=False)
        stream_object(spark, scratch, "crm", "deals", deals(spark, []).schema, log=log)
        bad = deals(spark, [(9, "SHARED", 1, "2024-01-05 00:00:00", 0)])
        write_landing(bad, f"{scratch}/landing/crm/deals/batch=x")
        with pytest.raises(Exception, match="valid_bu"):
            stream_object(spark, scratch, "crm", "deals", bad.schema, log=log)
    got = quality_counts(spark, path).collect()
    assert {(r.rule, r["rows"]) for r in got if r.rule != "flow_failed"} == {
        ("seen", 3), ("unconfigured_unit", 1), ("dropped_valid_updated_at", 1), ("path_payload_mismatch", 0)}
    failed = [r for r in got if r.rule == "flow_failed"]
    assert len(failed) == 1 and failed[0].flow == "silver_deals" and failed[0]["rows"] == 1 and failed[0].detail


def test_quality_log_stores_while_flows_run(spark, scratch, monkeypatch):
    from unitmart.streaming import quality_log
    monkeypatch.setattr(quality_log, "STORE_ROWS", 1)
    with QualityLog(spark, f"{scratch}/quality_log") as log:
        for n in range(2):
            ingest(spark, deals(spark, [(n, "bu_01", 1, "2024-01-01 00:00:00", 0)]), "crm", "deals", f"{scratch}/landing",
                   f"{scratch}/audit", use_stored_watermark=False)
            stream_object(spark, scratch, "crm", "deals", deals(spark, []).schema, log=log)
    seen = quality_counts(spark, f"{scratch}/quality_log").filter("rule = 'seen'")
    assert rows(seen, "flow", "batch", "rows") == [("silver_deals", 0, 1), ("silver_deals", 1, 1)]


def test_consumed_landing_files_are_archived_whole(spark, scratch):
    landing, archive = f"{scratch}/landing", f"{scratch}/archive"
    for n in range(3):
        write_landing(deals(spark, [(n, "bu_01", 1, "2024-01-01 00:00:00", 0)]), f"{landing}/batch={n}")
        run_bronze(spark, landing, f"{scratch}/bronze", f"{scratch}/ck", archive=archive)
    assert rows(read_landing(spark, landing).select("batch").distinct()) == [("2",)]
    assert rows(spark.read.parquet(f"{scratch}/bronze").groupBy("batch").count()) == [("0", 1), ("1", 1), ("2", 1)]
    moved = spark.read.option("recursiveFileLookup", "true").text(archive).collect()
    assert len(moved) == 2 and all("deal_id" in r.value for r in moved)
    run_bronze(spark, landing, f"{scratch}/bronze", f"{scratch}/ck", archive=archive)  # nothing new
    assert spark.read.parquet(f"{scratch}/bronze").count() == 3


def test_a_run_of_all_objects_publishes_changed_units_only(spark, scratch):
    from unitmart.plans.lakehouse import run_all
    from unitmart.sources.binding import ENTITIES
    feeds = {obj: ENTITIES[obj](spark, SMOKE_DIR) for obj in ("deals", "companies", "contacts")}
    paths = run_all(spark, feeds, scratch)
    assert OBJECTS["deals"].source_system == "crm" and set(paths) == {
        "sales_mart", "customer_mart", "bu_sales_performance", "bu_customer_performance"}
    before = {m: files(spark, paths[m]) for m in ("sales_mart", "customer_mart")}
    new = feeds["deals"].filter("bu_id = 'bu_03'").withColumn("updated_at", F.lit("2031-01-01").cast("timestamp_ntz"))
    run_all(spark, {**feeds, "deals": feeds["deals"].unionByName(new)}, scratch)
    for m, old in before.items():
        assert {u for u, _ in files(spark, paths[m]) - old} == {"bu_03"}
    assert list_names(spark, f"{scratch}/landing/crm/contacts/_runs") == []
