"""Deep pages, clustered tables, persona views and the digest tree."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from unitmart.functions.cluster import clustered, place_among, quantile_bounds, z_key
from unitmart.operators import governance, reads


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- deep pages -------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 holds a third of all rows, some keys are null."""
    rng = random.Random(1)
    data = [(7 if i % 3 == 0 else None if i % 50 == 1 else rng.randint(-500, 500), i // 4, i) for i in range(6000)]
    return spark.createDataFrame(data, "k long, t long, v long").repartition(4).cache()


def test_deep_pages_equal_plain_ones(skewed, monkeypatch):
    for near, offsets in ((1, (2950,)), (50, (119, 5950)), (20_000, (0, 3400))):
        monkeypatch.setattr(reads, "NEAR", near)
        for offset in offsets:
            want = [tuple(r) for r in reads.page(skewed, ["k", "t", "v"], offset, 100).collect()]
            assert [tuple(r) for r in reads.deep_page(skewed, ["k", "t", "v"], offset, 100).collect()] == want, (near, offset)
    assert reads.deep_page(skewed, ["k", "t", "v"], 6000, 10).count() == 0
    assert reads.deep_page(skewed.limit(0), ["k"], 0, 10).count() == 0
    with pytest.raises(ValueError):
        reads.deep_page(skewed, ["k"], -1, 10)


def test_a_deep_page_passes_over_few_rows(skewed, monkeypatch):
    monkeypatch.setattr(reads, "NEAR", 40)
    for offset in (2500, 5990):
        parts = reads.page_parts(skewed, ["k", "t", "v"], offset, 60)
        assert sum(n for _, _, n in parts) == min(60, 6000 - offset)
        assert parts[0][1] < 40 and all(o == 0 for _, o, _ in parts[1:])
        assert skewed.filter(parts[0][0]).count() <= 40  # also inside the hot key


def test_a_deep_page_reads_one_range(spark, scratch):
    spark.range(200_000).select((F.col("id") * 3).alias("k"), "id").repartitionByRange(16, "k").sortWithinPartitions("k") \
        .write.parquet(scratch)
    df = spark.read.parquet(scratch)
    parts = reads.page_parts(df, ["k"], 199_800, 100)
    assert len(parts) == 1 and df.filter(parts[0][0]).count() < 200_000 / 32
    page = reads.deep_page(df, ["k"], 199_800, 100)
    assert "GreaterThanOrEqual(k," in plan_text(page) and "LessThanOrEqual(k," in plan_text(page)
    assert [r.k for r in page.collect()] == [3 * i for i in range(199_800, 199_900)]


# --- clustered tables ---------------------------------------------------------------

def test_place_and_key(spark):
    df = spark.createDataFrame([(None,), (-5,), (0,), (3,), (9,)], "v long")
    placed = df.select("v", place_among(F.col("v"), [-1, 3, 8]).alias("p"))
    assert rows(placed) == sorted([(None, None), (-5, 0), (0, 1), (3, 1), (9, 3)], key=repr)
    assert place_among(F.col("v"), []) is not None and quantile_bounds(df.limit(0), "v", 8) == []
    key = spark.range(1).select(z_key([F.lit(0b101), F.lit(0b011)], 3), z_key([F.lit(None).cast("int"), F.lit(1)], 3)).first()
    assert tuple(key) == (0b100111, 1)


def test_both_filters_skip_row_groups(spark, scratch):
    """A slice of one unit after a watermark reads under a fifth of the row
    groups; the rows are those of the table as it was."""
    src = spark.range(60_000).select(
        "id", F.concat(F.lit("bu_0"), (F.hash("id") % 3 + 3).cast("string")).alias("bu_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(hash(id, 7), 1000000))").alias("updated_at"))
    units = [f"bu_0{i}" for i in range(1, 6)]
    clustered(src, ("bu_id", "updated_at"), {"bu_id": units}, files=32).write.parquet(scratch)
    back = spark.read.parquet(scratch)
    assert rows(back.agg(F.count("id"), F.sum("id"))) == rows(src.agg(F.count("id"), F.sum("id")))
    import datetime
    import glob
    unit, after = "bu_04", datetime.datetime(2024, 1, 9)
    wanted = (F.col("bu_id") == unit) & (F.col("updated_at") > F.lit(str(after)).cast("timestamp_ntz"))
    assert rows(back.filter(wanted), "id") == rows(src.filter(wanted), "id")
    read = total = 0
    for path in glob.glob(f"{scratch.replace('file:', '')}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(3)}
            total += 1
            read += stats["bu_id"].min <= unit <= stats["bu_id"].max and stats["updated_at"].max > after
    assert total >= 30 and 0 < read < total / 5


# --- personas ------------------------------------------------------------------------

def test_one_view_serves_all_personas(spark):
    mart = spark.createDataFrame([("bu_01", "a", 1), ("bu_01", None, 2), ("bu_02", "a", 3), (None, "a", 4)],
                                 "bu_id string, business_group string, n long")
    policy = governance.entitlements_frame(spark, [("all", None, None), ("one", "bu_01", None), ("a", None, "a"),
                                                   ("both", "bu_02", None), ("both", None, "a")])
    governance.persona_view(spark, mart, policy, "seen")
    text = "SELECT n FROM seen"
    assert spark.sql(text).count() == 0  # nobody yet
    for persona, want in (("all", [1, 2, 3, 4]), ("one", [1, 2]), ("a", [1, 3, 4]), ("both", [1, 3, 4]), ("none", []),
                          (None, []), ("' OR true --", [])):
        governance.as_persona(spark, persona)
        assert [r[0] for r in rows(spark.sql(text))] == want, persona
    governance.as_persona(spark, "one")
    mine = spark.sql("SELECT * FROM seen")
    assert mine.columns == mart.columns and "Join" not in plan_text(mine)
    governance.as_persona(spark, None)


# --- digest tree ---------------------------------------------------------------------

def test_the_tree_names_what_changed(spark, scratch):
    deals = spark.range(300).select("id", (F.col("id") % 3).alias("v"), F.concat(F.lit("g"), F.col("id") % 4).alias("g"))
    deals.repartition(2).write.partitionBy("g").parquet(f"{scratch}/deals")
    deals.drop("g").repartition(2).write.parquet(f"{scratch}/plain")
    stored = governance.write_digest_tree(spark, scratch, ("deals", "plain"))
    assert rows(stored.groupBy("level").count()) == [("file", 10), ("package", 1), ("partition", 5), ("table", 2)]
    check = lambda: governance.check_entries(stored, governance.digest_tree(spark, scratch, ("deals", "plain")))
    assert check().filter("not verified").count() == 0
    part = f"{scratch}/deals/g=g1"
    assert governance.check_partition(spark, scratch, "deals", "g=g1").filter("not verified").count() == 0
    # one more row in a new file of one partition
    spark.createDataFrame([(999, 1)], "id long, v long").coalesce(1).write.mode("append").parquet(part)
    bad = check().filter("not verified")
    assert rows(bad, "level", "table_name", "part") == sorted(
        [("file", "deals", "g=g1"), ("partition", "deals", "g=g1"), ("table", "deals", None), ("package", None, None)], key=repr)
    alone = governance.check_partition(spark, scratch, "deals", "g=g1")
    assert rows(alone.groupBy("level", "verified").count()) == [("file", False, 1), ("file", True, 2), ("partition", False, 1)]
    assert governance.check_partition(spark, scratch, "deals", "g=g2").filter("not verified").count() == 0
    assert governance.check_partition(spark, scratch, "plain", "").filter("not verified").count() == 0


def test_equal_rows_in_another_partition_give_another_digest(spark, scratch):
    for name, g in (("a", "x"), ("b", "y")):
        spark.createDataFrame([(1, g)], "k long, g string").write.partitionBy("g").parquet(f"{scratch}/{name}/t")
    digests = [governance.digest_tree(spark, f"{scratch}/{n}", ("t",)).filter("level = 'table'").first().digest for n in "ab"]
    assert digests[0] != digests[1]
