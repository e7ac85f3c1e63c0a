"""Streaming flows and the keyed state table."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from unitmart.operators.cdc import latest_per_key
from unitmart.session import list_names, path_exists
from unitmart.sources.landing import landing_schema, write_landing
from unitmart.streaming.flows import run_bronze, run_silver
from unitmart.streaming.staging import stage
from unitmart.streaming.state import ChangeTable


def changes(spark, data):
    return spark.createDataFrame(data, "k long, v string, t string, is_deleted int").select(
        "k", "v", F.col("t").cast("timestamp_ntz").alias("updated_at"), "is_deleted")


def test_state_table_batches_equal_one_shot(spark, scratch):
    b1 = [(1, "a", "2024-01-05 00:00:00", 0), (2, "b", "2024-01-05 00:00:00", 0)]
    b2 = [(1, "old", "2024-01-01 00:00:00", 0), (2, "del", "2024-01-06 00:00:00", 1),
          (3, "c", "2024-01-02 00:00:00", 0)]
    b3 = [(2, "stale", "2024-01-03 00:00:00", 0), (3, "c2", "2024-01-03 00:00:00", 0)]
    one_shot = latest_per_key(changes(spark, b1 + b2 + b3), ["k"])
    want = [(1, "a", _ts("2024-01-05"), 0), (3, "c2", _ts("2024-01-03"), 0)]
    assert rows(one_shot) == want
    for compact_after in (None, 0, 1, 2):
        table = ChangeTable(spark, f"{scratch}/{compact_after}", ["k"])
        for batch, b in enumerate([b1, b2, b3]):
            table.append(changes(spark, b), batch)
            table.append(changes(spark, b), batch)  # a retried batch replaces itself
            if batch == compact_after:
                table.compact()
                table.compact()  # nothing new: no change
                table.append(changes(spark, [(9, "x", "2024-02-01 00:00:00", 0)]), batch)  # held by the snapshot
        assert rows(table.view()) == want
        assert table.state().filter("_deleted").count() == 1  # tombstone kept


def test_compaction_removes_what_it_supersedes(spark, scratch):
    table = ChangeTable(spark, scratch, ["k"])
    assert table.view() is None and table.compact() is None
    for batch in range(3):
        table.append(changes(spark, [(batch, "v", "2024-01-01 00:00:00", 0)]), batch)
        table.compact()
    assert table.pointer() == (2, 2) and table.view().count() == 3
    assert not path_exists(spark, f"{scratch}/snapshots/n=1") and path_exists(spark, f"{scratch}/snapshots/n=2")
    assert not path_exists(spark, f"{scratch}/changes/_batch=2")


def _ts(day):
    import datetime
    return datetime.datetime.fromisoformat(day)


def test_triggered_streams_take_each_file_once(spark, scratch):
    feed = changes(spark, [(1, "a", "2024-01-01 00:00:00", 0), (2, "b", "2024-01-01 00:00:00", 0)])
    later = changes(spark, [(1, "a2", "2024-01-02 00:00:00", 0), (2, "b", "2024-01-03 00:00:00", 1)])
    table = ChangeTable(spark, f"{scratch}/state", ["k"])
    schema = landing_schema(feed.schema)

    def run():
        run_bronze(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ck/b",
                   partitions=("batch",))
        run_silver(spark, f"{scratch}/bronze", f"{scratch}/ck/s",
                   lambda r: stage(r, schema), table, partitions=("batch",))

    write_landing(feed, f"{scratch}/landing/batch=0", tenant_col=None)
    run()
    assert rows(table.view(), "k", "v") == [(1, "a"), (2, "b")]
    write_landing(later, f"{scratch}/landing/batch=1", tenant_col=None)
    run()
    run()  # nothing new: no change
    assert rows(table.view(), "k", "v") == [(1, "a2")]
    assert spark.read.parquet(f"{scratch}/bronze").count() == 4


def test_a_late_older_change_never_revives_a_key(spark, scratch):
    table = ChangeTable(spark, scratch, ["k"])
    table.append(changes(spark, [(1, "a", "2024-01-02 00:00:00", 1)]), 0)
    table.compact()
    table.append(changes(spark, [(2, "b", "2024-09-01 00:00:00", 0)]), 1)
    table.compact()
    table.append(changes(spark, [(1, "a", "2024-01-01 00:00:00", 0)]), 2)
    assert rows(table.view(), "k") == [(2,)]


def test_streamed_shared_dimension_equals_batch_silver(spark, scratch):
    from conftest import SMOKE_DIR
    from unitmart.plans.silver import silver
    from unitmart.plans.stream_refresh import silver_view, stream_object
    from unitmart.sources import binding
    from unitmart.sources.ingest import ingest

    feed = binding.cost_centers(spark, SMOKE_DIR)
    ingest(spark, feed, "erp", "cost_centers", f"{scratch}/landing", f"{scratch}/audit")
    table = stream_object(spark, scratch, "erp", "cost_centers", feed.schema)
    streamed = silver_view(table, feed.schema)
    assert rows(streamed) == rows(silver(spark, SMOKE_DIR, "cost_centers"))
    assert streamed.filter("bu_id = 'SHARED'").count() == 0


def test_malformed_landed_file_goes_to_quarantine(spark, scratch):
    from unitmart.plans.stream_refresh import silver_view, stream_objects
    feed = spark.createDataFrame([(1, "bu_01", "2024-01-01 00:00:00", 0)],
                                 "contact_id long, bu_id string, t string, is_deleted int") \
        .select("contact_id", "bu_id", F.col("t").cast("timestamp_ntz").alias("updated_at"), "is_deleted")
    write_landing(feed, f"{scratch}/landing/crm/contacts/batch=good")
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.text(
        f"{scratch}/landing/crm/contacts/batch=bad/tenant=bu_01")
    tables = stream_objects(spark, scratch, {"contacts": ("crm", feed.schema)},
                            keep_quarantine=True)
    assert rows(silver_view(tables["contacts"], feed.schema), "contact_id") == [(1,)]
    q = spark.read.parquet(f"{scratch}/quarantine/contacts").collect()
    assert [r.value for r in q] == ["{not json"] and "batch=bad" in q[0]._file


def test_object_without_landed_files_yields_empty_silver(spark, scratch):
    from unitmart.plans.stream_refresh import silver_view, stream_objects
    feed = changes(spark, [(1, "a", "2024-01-01 00:00:00", 0)])
    tables = stream_objects(spark, scratch, {"contacts": ("crm", feed.schema)})
    view = silver_view(tables["contacts"], feed.schema)
    assert view.count() == 0 and view.columns == feed.columns


def test_streamed_run_of_all_objects_equals_batch_gold(spark, scratch):
    from conftest import SMOKE_DIR
    from unitmart.operators.marts import report
    from unitmart.plans import gold
    from unitmart.plans.lakehouse import run_all
    from unitmart.sources.binding import ENTITIES

    paths = run_all(spark, {obj: fn(spark, SMOKE_DIR) for obj, fn in ENTITIES.items()}, scratch)
    for name, batch in (("sales_mart", gold.sales_mart), ("finance_mart", gold.finance_mart),
                        ("customer_mart", gold.customer_mart)):
        streamed = report(spark.read.parquet(paths[name]))
        expected = report(batch(spark, SMOKE_DIR))
        assert rows(streamed.select(*expected.columns)) == rows(expected), name
    assert spark.read.parquet(paths["bu_finance_performance"]).count() == 6


def test_state_of_an_empty_first_batch(spark, scratch):
    def frame(data):
        return spark.createDataFrame(data, "k long, bu_id string, t string, is_deleted int").select(
            "k", "bu_id", F.col("t").cast("timestamp_ntz").alias("updated_at"), "is_deleted")

    table = ChangeTable(spark, scratch, ["k", "bu_id"])
    table.append(frame([]), 0)
    assert table.view().count() == 0
    table.compact()
    assert table.view().count() == 0
    table.append(frame([(1, "bu_01", "2024-01-01 00:00:00", 0)]), 1)
    table.append(frame([]), 2)
    assert rows(table.view(), "k", "bu_id") == [(1, "bu_01")]


def test_bronze_and_changes_are_compressed(spark, scratch):
    feed = changes(spark, [(k, "a", "2024-01-05 00:00:00", 0) for k in range(50)]).withColumn(
        "bu_id", F.concat(F.lit("bu_0"), (F.col("k") % 2 + 1).cast("string")))
    write_landing(feed, f"{scratch}/landing/batch=0")
    run_bronze(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ck/bronze")
    table = ChangeTable(spark, f"{scratch}/state", ["k"])
    run_silver(spark, f"{scratch}/bronze", f"{scratch}/ck/silver",
               lambda raw: stage(raw, landing_schema(feed.schema)), table)
    for path in (f"{scratch}/bronze/tenant=bu_01", f"{scratch}/state/changes/_batch=0/bu_id=bu_02"):
        files = [n for n in list_names(spark, path) if n.endswith(".parquet")]
        assert files and all(n.endswith(".zstd.parquet") for n in files)
    assert rows(table.view().select(*feed.columns)) == rows(feed)
