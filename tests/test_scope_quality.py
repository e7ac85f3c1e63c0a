"""Tenant scope of shared dimensions and the quality expectations."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from unitmart.operators import governance
from unitmart.operators.quality import duplicate_keys, expect_or_drop, expect_or_fail
from unitmart.operators.scope import expand_shared, scope_for_unit
from unitmart.plans.catalog import QUERIES
from unitmart.plans.silver import to_silver
from unitmart.sources import binding
from unitmart.sources.landing import landing_schema, read_landing, write_landing
from unitmart.streaming.staging import stage

DIM = "cc_key string, bu_id string, shared_with string, business_group string, is_deleted int, t string"


def dim(spark, data):
    return spark.createDataFrame(data, DIM).withColumn(
        "updated_at", F.col("t").cast("timestamp_ntz")).drop("t")


def test_shared_rows_copied_to_listed_units_only(spark):
    d = dim(spark, [
        ("CC-1", "bu_01", None, "g", 0, "2024-01-01 00:00:00"),
        ("CC-S", "SHARED", "bu_02|bu_03|bu_06", "g", 0, "2024-01-01 00:00:00"),
        ("CC-N", "SHARED", None, "g", 0, "2024-01-01 00:00:00"),           # null list: nobody
        ("CC-W", "SHARED", "bu_02 |bu_04", "g", 0, "2024-01-01 00:00:00"),  # no trimming
        ("CC-X", "bu_99", None, "g", 0, "2024-01-01 00:00:00"),            # unconfigured unit
    ])
    out = rows(expand_shared(d), "cc_key", "bu_id")
    assert out == [("CC-1", "bu_01"), ("CC-S", "bu_02"), ("CC-S", "bu_03"), ("CC-S", "bu_06"),
                   ("CC-W", "bu_04")]


def test_set_wise_scope_equals_per_unit_scope(spark):
    d = dim(spark, [("CC-1", "bu_01", None, "g", 0, "2024-01-01 00:00:00"),
                    ("CC-S", "SHARED", "bu_01|bu_05", "g", 0, "2024-01-01 00:00:00")])
    expanded = expand_shared(d)
    for unit in ("bu_01", "bu_02", "bu_05"):
        assert rows(expanded.filter(F.col("bu_id") == unit)) == rows(scope_for_unit(d, unit))


def test_own_row_and_shared_row_same_key(spark):
    same_time = dim(spark, [("CC-1", "bu_02", None, "own", 0, "2024-01-01 00:00:00"),
                            ("CC-1", "SHARED", "bu_02", "shared", 0, "2024-01-01 00:00:00")])
    assert rows(to_silver(same_time, "cost_centers"), "business_group") == [("own",)]
    later_shared = dim(spark, [("CC-1", "bu_02", None, "own", 0, "2024-01-01 00:00:00"),
                               ("CC-1", "SHARED", "bu_02", "shared", 0, "2024-02-01 00:00:00")])
    assert rows(to_silver(later_shared, "cost_centers"), "business_group") == [("shared",)]


def test_expect_or_drop_counts_dropped_rows(spark):
    df = spark.range(10).withColumn("updated_at", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")))
    obs = Observation("dq")
    kept = expect_or_drop(df, "valid_updated_at", "updated_at IS NOT NULL", obs)
    assert kept.count() == 6
    assert obs.get["dropped_valid_updated_at"] == 4 and obs.get["seen_valid_updated_at"] == 10


def test_expect_or_fail_raises_even_when_column_pruned(spark):
    df = spark.createDataFrame([("a", "bu_01"), ("b", "SHARED")], "k string, bu_id string")
    gated = expect_or_fail(df, "valid_bu", "bu_id IS NOT NULL AND bu_id <> 'SHARED'")
    with pytest.raises(Exception, match="valid_bu"):
        gated.select("k").collect()
    ok = expect_or_fail(df.filter("k = 'a'"), "valid_bu", "bu_id IS NOT NULL AND bu_id <> 'SHARED'")
    assert ok.count() == 1


def test_expect_or_fail_on_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, bu_id string")
    with pytest.raises(Exception, match="valid_bu"):
        expect_or_fail(df, "valid_bu", "bu_id IS NOT NULL").collect()


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "k string")
    assert rows(duplicate_keys(df, ["k"])) == [("a", 2), ("c", 3)]


def test_revoke_turns_lost_entitlement_into_delete(spark):
    d = dim(spark, [("CC-S", "SHARED", "bu_02|bu_03", "g", 0, "2024-01-01 00:00:00"),
                    ("CC-S", "SHARED", "bu_02", "g", 0, "2024-02-01 00:00:00")])
    kept = rows(to_silver(d, "cost_centers"), "bu_id", "updated_at")
    assert [u for u, _ in kept] == ["bu_02", "bu_03"]  # default: bu_03 keeps a stale copy
    revoked = rows(to_silver(d, "cost_centers", revoke=True), "bu_id")
    assert revoked == [("bu_02",)]


DEAL = "deal_id long, bu_id string, stage string, amount decimal(18,2), t string, is_deleted int"


def flawed(spark, *extra):
    data = [(1, None, "won", None, "2024-01-01 00:00:00", 0), (2, "bu_09", "won", None, "2024-01-01 00:00:00", 0),
            (3, "bu_01", "won", None, None, 0), (4, "bu_01", "won", None, "2024-01-01 00:00:00", 0), *extra]
    return spark.createDataFrame(data, DEAL).withColumn("updated_at", F.col("t").cast("timestamp_ntz")).drop("t")


def test_batch_and_streaming_admit_the_same_rows(spark, scratch):
    feed = flawed(spark)
    assert rows(to_silver(feed, "deals"), "deal_id") == [(4,)]
    write_landing(feed, f"{scratch}/landing/batch=0")
    obs = Observation("gate")
    staged = stage(read_landing(spark, f"{scratch}/landing"), landing_schema(feed.schema), observation=obs)
    assert rows(staged, "deal_id") == [(4,)]
    seen = obs.get
    assert (seen["seen"], seen["unconfigured_unit"], seen["dropped_valid_updated_at"]) == (4, 2, 1)


def test_shared_row_of_an_unshared_object_fails_both_paths(spark, scratch):
    feed = flawed(spark, (5, "SHARED", "won", None, "2024-01-01 00:00:00", 0))
    with pytest.raises(Exception, match="valid_bu"):
        to_silver(feed, "deals").collect()
    write_landing(feed, f"{scratch}/landing/batch=0")
    with pytest.raises(Exception, match="valid_bu"):
        stage(read_landing(spark, f"{scratch}/landing"), landing_schema(feed.schema)).collect()


@pytest.mark.parametrize("unit", [None, "garbage"])
def test_registered_gate_raises_on_incoming_rows(spark, monkeypatch, unit):
    bad = dim(spark, [("CC-1", unit, None, "secret", 0, "2024-01-01 00:00:00")])
    monkeypatch.setattr(binding, "cost_centers", lambda spark, sf_dir: bad)
    with pytest.raises(Exception, match="valid_bu") as e:
        QUERIES["dq_fail_gate"](spark, "").collect()
    assert "CC-1" in str(e.value) and "secret" not in str(e.value)


def test_overlapping_policies_give_one_row(spark):
    mart = spark.createDataFrame([("bu_02", "g", 1), ("bu_02", "g", 1), ("bu_07", None, 2)], "bu_id string, business_group string, n int")
    policy = governance.entitlements_frame(spark, [("p", "bu_02", None), ("p", None, "g"), ("p", "bu_02", "g"),
                                                   ("all", None, None), ("none", "bu_01", None)])
    assert rows(governance.visible_to_persona(mart, policy, "p")) == [("bu_02", "g", 1)] * 2
    assert rows(governance.visible_to_persona(mart, policy, "all")) == rows(mart)
    assert governance.visible_to_persona(mart, policy, "none").count() == 0
