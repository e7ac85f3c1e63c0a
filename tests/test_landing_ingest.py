"""Landing files, JSON parse semantics, batch ids, audit and watermarks, reads."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from unitmart.functions.hashing import content_id
from unitmart.model import LANDING_SCHEMAS
from unitmart.operators import reads
from unitmart.sources.extract import incremental, instant, parse_instant
from unitmart.sources.ingest import audit_table, current_watermark, ingest
from unitmart.sources.landing import landing_schema, parse_landing, quarantine, read_landing, write_landing
from unitmart.streaming.staging import stage

CC = LANDING_SCHEMAS["cost_centers"]


def raw(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_json_parse_semantics(spark):
    texts = [
        '[{"cc_key": "A", "updated_at": "2026-08-31T14:12:59+02:00"}, {"cc_key": "B"}]',
        '{"cc_key": "C", "updated_at": "2026-08-31T12:00:00Z"}',        # single object
        "[]", "not json", "",                                          # nothing
        '[null]',                                                      # all-null row
        '[{"cc_key": "D", "is_deleted": "x", "extra": 1}]',            # wrong type, extra field
    ]
    parsed = parse_landing(raw(spark, texts), CC)
    got = rows(parsed.select("cc_key", "is_deleted", parse_instant("updated_at").alias("u")))
    keys = sorted(r[0] for r in got if r[0] is not None)
    assert keys == ["A", "B", "C", "D"]
    assert sum(1 for r in got if r[0] is None) == 1
    by_key = {r[0]: r for r in got}
    assert str(by_key["A"][2]) == "2026-08-31 12:12:59" and str(by_key["C"][2]) == "2026-08-31 12:00:00"
    assert by_key["D"][1] is None
    assert quarantine(raw(spark, texts), CC).count() == 3


def test_staging_drops_null_instants_and_stamps_path_tenant(spark):
    texts = ['[{"deal_id": "1", "bu_id": "bu_02", "updated_at": "2024-01-01T00:00:00Z"},'
             ' {"deal_id": "2", "bu_id": "bu_01", "updated_at": "garbage"},'
             ' {"deal_id": "3", "bu_id": "bu_01"}]']
    r = raw(spark, texts).withColumn("tenant", F.lit("bu_01"))
    out = stage(r, LANDING_SCHEMAS["deals"])
    assert rows(out, "deal_id", "bu_id") == [("1", "bu_01")]


def test_microsecond_instants_and_decimals_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "bu_01", Decimal("12.34"), "2024-01-01 10:00:00.123456")],
                               "k long, bu_id string, amount decimal(18,2), t string") \
        .withColumn("updated_at", F.col("t").cast("timestamp_ntz")).drop("t")
    for fmt in ("lines", "array"):
        path = f"{scratch}/{fmt}/batch=0"
        write_landing(df, path, fmt=fmt, total_rows=1, records_per_file=1)
        back = stage(read_landing(spark, f"{scratch}/{fmt}", fmt=fmt), landing_schema(df.schema))
        assert rows(back.select(*df.columns)) == rows(df)


def test_array_files_hold_bounded_arrays(spark, scratch):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("bu_01").alias("bu_id"))
    write_landing(df, f"{scratch}/batch=0", fmt="array", total_rows=1000, records_per_file=100)
    r = read_landing(spark, scratch, fmt="array")
    sizes = [x[0] for x in r.select(F.size(F.from_json("value", "array<struct<k:long>>"))).collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 8 and max(sizes) < 200


def test_batch_id_depends_on_content_only(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("m"))
    a = content_id(df, "obj", None).first()
    b = content_id(df.repartition(5).select("m", "id").orderBy(F.desc("id")), "obj", None).first()
    c = content_id(df, "obj", "2024-01-01 00:00:00").first()
    d = content_id(df.union(df.limit(1)), "obj", None).first()
    assert a.batch_id == b.batch_id and len(a.batch_id) == 16
    assert c.batch_id != a.batch_id and d.batch_id != a.batch_id


def test_incremental_is_strict_and_handles_offsets(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:01",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("updated_at"))
    assert incremental(df, "2024-01-01T00:00:00Z").count() == 1
    assert incremental(df, "2024-01-01T02:00:00+02:00").count() == 1
    assert incremental(df, None).count() == 2
    assert incremental(df, "2024-01-01T00:00:00Z", lookback_seconds=5).count() == 2
    assert str(df.select(instant("2024-01-01T02:00:00+02:00")).first()[0]) == "2024-01-01 00:00:00"


def test_ingest_audit_watermark_and_replay(spark, scratch):
    src = spark.range(100).select(
        F.col("id").alias("k"), F.concat(F.lit("bu_0"), (F.col("id") % 2 + 1).cast("string")).alias("bu_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("updated_at"))
    land, audit = f"{scratch}/landing", f"{scratch}/audit"
    first = ingest(spark, src.filter("k < 60"), "crm", "things", land, audit)
    assert first.status == "SUCCESS" and first.records == 60
    assert current_watermark(spark, audit, "crm", "things") == "2024-01-01 00:00:59.000000"
    second = ingest(spark, src, "crm", "things", land, audit)
    assert second.records == 40 and second.watermark_before == "2024-01-01 00:00:59.000000"
    again = ingest(spark, src, "crm", "things", land, audit, watermark=first.watermark_after)
    assert again.status == "SKIPPED" and again.batch_id == second.batch_id
    assert ingest(spark, src, "crm", "things", land, audit).status == "EMPTY"
    assert audit_table(spark, audit).count() == 2
    landed = parse_landing(read_landing(spark, f"{land}/crm/things"), landing_schema(src.schema))
    assert landed.count() == 100
    assert rows(landed.groupBy("tenant").count()) == [("bu_01", 50), ("bu_02", 50)]


def test_pages_and_lookup(spark):
    df = spark.range(250).withColumnRenamed("id", "deal_id")
    assert [r[0] for r in reads.page(df, ["deal_id"], 200, 100).collect()] == list(range(200, 250))
    assert reads.next_offset(df, 100, 100) == 200 and reads.next_offset(df, 200, 100) is None
    assert reads.point_lookup(df, "deal_id", 1000).count() == 0
    for bad in ((0, 0), (501, 0), (10, -1)):
        with pytest.raises(ValueError):
            reads.validate_page(*bad)


def test_landing_schema_types():
    s = landing_schema(T.StructType([T.StructField("u", T.TimestampNTZType()),
                                     T.StructField("a", T.DecimalType(18, 2))]))
    assert s["u"].dataType == T.StringType() and s["a"].dataType == T.DecimalType(18, 2)
    assert "_batch_id" in s.fieldNames()


def test_path_payload_mismatch_is_counted(spark):
    from pyspark.sql import Observation
    texts = ['[{"deal_id": "1", "bu_id": "bu_02", "updated_at": "2024-01-01T00:00:00Z"},'
             ' {"deal_id": "2", "bu_id": "bu_01", "updated_at": "2024-01-01T00:00:00Z"}]']
    obs = Observation("staging")
    out = stage(raw(spark, texts).withColumn("tenant", F.lit("bu_01")), LANDING_SCHEMAS["deals"],
                observation=obs)
    assert out.count() == 2 and obs.get["path_payload_mismatch"] == 1


def test_refresh_republishes_one_unit_only(spark, scratch):
    from unitmart.plans.refresh import refresh
    from conftest import SMOKE_DIR
    paths = refresh(spark, SMOKE_DIR, scratch, mart_names=("sales_mart",))
    full = rows(spark.read.parquet(paths["sales_mart"]))
    refresh(spark, SMOKE_DIR, scratch, units=("bu_02",), mart_names=("sales_mart",))
    assert rows(spark.read.parquet(paths["sales_mart"])) == full
    perf = spark.read.parquet(paths["bu_sales_performance"])
    assert perf.count() == 6


def test_array_chunks_spread_identical_copies(spark, scratch):
    df = spark.range(1000).select(F.lit(7).alias("k"), F.lit("bu_01").alias("bu_id"))  # all copies
    write_landing(df, f"{scratch}/batch=0", fmt="array", total_rows=1000, records_per_file=100)
    r = read_landing(spark, scratch, fmt="array")
    sizes = [x[0] for x in r.select(F.size(F.from_json("value", "array<struct<k:long>>"))).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 150


def test_keyset_page_matches_offset_page(spark):
    df = spark.range(1000).withColumnRenamed("id", "deal_id")
    a = [r[0] for r in reads.page(df, ["deal_id"], 300, 50).collect()]
    b = [r[0] for r in reads.page_after(df, "deal_id", 299, 50).collect()]
    assert a == b == list(range(300, 350))


def test_absent_unit_lands_under_unknown_and_numeric_batch_ids_stay_text(spark, scratch):
    df = spark.createDataFrame([(1, None), (2, "bu_01")], "k long, bu_id string")
    write_landing(df, f"{scratch}/batch=1234567890123456")
    r = read_landing(spark, scratch)
    assert dict(r.dtypes)["batch"] == "string"
    assert rows(r.select("tenant").distinct()) == [("UNKNOWN",), ("bu_01",)]


def test_pretty_printed_arrays_under_shared_directory(spark, scratch):
    text = """[
  {
    "cc_key": "CC-SHARED-9",
    "business_group": "bg_online",
    "is_shared": 1,
    "shared_with": "bu_02|bu_05",
    "bu_id": "SHARED",
    "is_deleted": 0,
    "updated_at": "2026-08-31T14:12:59.123456+03:00"
  },
  {
    "cc_key": "CC-01-1",
    "bu_id": "bu_01",
    "is_deleted": 0,
    "updated_at": "2026-08-31T14:12:59+02:00"
  }
]"""
    for tenant in ("SHARED", "bu_01"):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(
            f"{scratch}/batch=b1/tenant={tenant}")
    raw = read_landing(spark, scratch, fmt="array")
    out = stage(raw, CC, shared=True).dropDuplicates(["cc_key", "bu_id"])
    assert rows(out, "cc_key", "bu_id") == [("CC-01-1", "bu_01"), ("CC-SHARED-9", "bu_02"),
                                            ("CC-SHARED-9", "bu_05")]
    assert str(out.filter("cc_key = 'CC-01-1'").first()["updated_at"]) == "2026-08-31 12:12:59"


def test_ordered_extract_is_in_update_order(spark):
    df = spark.range(500).select(
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * 7919) % 500)")
        .alias("updated_at")).repartition(5)
    got = [r[0] for r in incremental(df, "2024-01-01T00:00:10Z", ordered=True).collect()]
    assert len(got) == 489 and got == sorted(got)


def things(spark, n=100):
    return spark.range(n).select(
        F.col("id").alias("k"), F.concat(F.lit("bu_0"), (F.col("id") % 2 + 1).cast("string")).alias("bu_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("updated_at"))


def test_ingest_reads_its_source_once(spark, scratch):
    for fmt in ("lines", "array"):
        read, root = spark.sparkContext.accumulator(0), f"{scratch}/{fmt}"

        @F.udf("long")
        def counted(k, read=read):
            read.add(1)
            return k

        feed = things(spark).withColumn("k", counted.asNondeterministic()("k"))
        done = ingest(spark, feed, "crm", "things", f"{root}/landing", f"{root}/audit", fmt=fmt, records_per_file=7)
        assert (done.status, done.records, done.watermark_after) == ("SUCCESS", 100, "2024-01-01 00:01:39.000000")
        assert read.value == 100
        landed = parse_landing(read_landing(spark, f"{root}/landing/crm/things", fmt=fmt), landing_schema(feed.schema))
        assert landed.count() == 100 and rows(landed.select("_batch_id").distinct()) == [(done.batch_id,)]


def test_totals_of_the_write_equal_the_digest_of_the_feed(spark, scratch):
    from unitmart.functions.hashing import content_digest, digest_aggs, digest_measures, digest_text
    feed = things(spark).unionByName(things(spark, 3))
    want = feed.agg(*digest_aggs(feed)).select(content_digest("x", None)).first()[0]
    for fmt in ("lines", "array"):
        seen = write_landing(feed, f"{scratch}/{fmt}", fmt, records_per_file=10, measures=digest_measures(feed))
        assert digest_text("x", None, seen) == want


def test_a_crashed_run_is_dropped_before_its_audit_row(spark, scratch, monkeypatch):
    crashed_run(spark, scratch, monkeypatch, "append_audit", 1)


def test_a_crashed_run_is_published_after_its_audit_row(spark, scratch, monkeypatch):
    crashed_run(spark, scratch, monkeypatch, "_publish", 2)


def crashed_run(spark, scratch, monkeypatch, step, audited):
    from unitmart.session import list_names
    from unitmart.sources import ingest as module
    land, audit, path = f"{scratch}/landing", f"{scratch}/audit", f"{scratch}/landing/crm/things"

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(module, step, crash)
        with pytest.raises(RuntimeError, match="lost"):
            ingest(spark, things(spark, 60), "crm", "things", land, audit)
    assert len(list_names(spark, f"{path}/_runs")) == 1
    assert not [n for n in list_names(spark, path) if n.startswith("batch=")]  # nothing visible
    ingest(spark, things(spark), "crm", "things", land, audit)
    assert list_names(spark, f"{path}/_runs") == []
    landed = parse_landing(read_landing(spark, path), landing_schema(things(spark).schema))
    assert rows(landed.select("k")) == [(k,) for k in sorted(range(100), key=lambda k: repr((k,)))]
    assert audit_table(spark, audit).count() == audited


def test_a_failed_write_is_audited_and_leaves_no_run(spark, scratch):
    from unitmart.session import list_names
    bad = things(spark).withColumn("k", F.when(F.col("k") < 50, F.col("k")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        ingest(spark, bad, "crm", "things", f"{scratch}/landing", f"{scratch}/audit")
    assert rows(audit_table(spark, f"{scratch}/audit"), "status") == [("FAILED",)]
    assert list_names(spark, f"{scratch}/landing/crm/things/_runs") == []
    assert ingest(spark, things(spark), "crm", "things", f"{scratch}/landing", f"{scratch}/audit").records == 100


def test_systems_with_equal_feeds_keep_their_own_batches(spark, scratch):
    land, audit = f"{scratch}/landing", f"{scratch}/audit"
    done = [ingest(spark, things(spark), s, "things", land, audit, use_stored_watermark=False) for s in ("crm", "erp", "crm")]
    assert [d.status for d in done] == ["SUCCESS", "SUCCESS", "SKIPPED"] and done[0].batch_id != done[1].batch_id
    assert current_watermark(spark, audit, "erp", "things") == "2024-01-01 00:01:39.000000"


def test_an_empty_table_can_be_read_with_its_columns(spark, scratch):
    from unitmart.operators.publish import materialize, read_table
    full, empty = things(spark), things(spark).limit(0)
    materialize(empty, scratch)
    assert read_table(spark, scratch).count() == 0 and set(read_table(spark, scratch).columns) == set(full.columns)
    materialize(full, scratch, ["bu_01", "bu_02"])
    assert rows(read_table(spark, scratch).groupBy("bu_id").count()) == [("bu_01", 50), ("bu_02", 50)]
    materialize(empty, scratch, ["bu_01"])
    assert rows(read_table(spark, scratch).groupBy("bu_id").count()) == [("bu_02", 50)]
    materialize(empty, scratch, ["bu_02"])
    assert read_table(spark, scratch).count() == 0 and dict(read_table(spark, scratch).dtypes)["bu_id"] == "string"


def landed_bytes(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0]


def invoices(spark, n=3000):
    k = F.col("id")
    return spark.range(n, numPartitions=2).select(
        F.concat(F.lit("INV-"), k.cast("string")).alias("invoice_id"), F.concat(F.lit("bu_0"), (k % 2 + 1).cast("string")).alias("bu_id"),
        (k / 100).cast("decimal(18,2)").alias("amount"), F.when(k % 3 > 0, F.lit("a \"b\" [c]")).alias("status"))


def test_arrays_are_landed_compressed_without_a_shuffle(spark, scratch):
    df = invoices(spark)
    for pretty in (True, False):
        path, sc = f"{scratch}/{pretty}", spark.sparkContext
        sc.setJobGroup(path, "landing")
        write_landing(df, f"{path}/batch=0", "array", records_per_file=500, pretty=pretty)
        jobs = sc.statusTracker().getJobIdsForGroup(path)
        sc.setJobGroup("tests", "tests")
        assert sum(len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs) == 1
        texts = [r.value for r in read_landing(spark, path, fmt="array").collect()]
        assert landed_bytes(spark, path) * 2 < sum(map(len, texts))
        # 6 chunks of the 1500 rows of each task, in two units
        sizes = read_landing(spark, path, fmt="array").select(F.size(F.from_json("value", "array<map<string,string>>")).alias("n"))
        assert len(texts) == 12 and rows(sizes) == [(250,)] * 12
        back = parse_landing(read_landing(spark, path, fmt="array"), df.schema)
        assert rows(back.select(*df.columns)) == rows(df)
        one = parse_landing(spark.createDataFrame([(texts[0],)], "value string"), df.schema)
        again = one.agg(F.to_json(F.collect_list(F.struct(*df.columns)), {"pretty": str(pretty).lower()})).first()[0]
        assert texts[0].rstrip("\n") == again


def test_arrays_without_tenant_or_rows(spark, scratch):
    df = invoices(spark, 10)
    write_landing(df, f"{scratch}/some/batch=0", "array", tenant_col=None)
    back = parse_landing(read_landing(spark, f"{scratch}/some", fmt="array", partitions=("batch",)), df.schema)
    assert rows(back.select(*df.columns)) == rows(df)
    write_landing(df.limit(0), f"{scratch}/none/batch=0", "array", tenant_col=None)
    none = read_landing(spark, f"{scratch}/none", fmt="array", partitions=("batch",))
    assert parse_landing(none, df.schema).count() == 0


def test_lines_are_landed_compressed_in_bounded_files(spark, scratch):
    df = invoices(spark)
    write_landing(df, f"{scratch}/batch=0", records_per_file=500)
    lines = read_landing(spark, scratch)
    per_file = [r[0] for r in lines.groupBy("_file").count().select("count").collect()]
    assert sum(per_file) == 3000 and max(per_file) <= 500
    assert landed_bytes(spark, scratch) * 2 < lines.agg(F.sum(F.length("value"))).first()[0]
    assert rows(parse_landing(lines, df.schema).select(*df.columns)) == rows(df)
