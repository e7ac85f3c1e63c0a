"""Row entitlements and divestiture of a business unit.

Entitlements are a policy table ``(persona, bu_id, business_group)`` where a
null means "all". A persona sees a row once, however many of its policies
allow it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITLEMENT_SCHEMA = "persona string, bu_id string, business_group string"
ALL_UNITS = "*"


def entitlements_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), ENTITLEMENT_SCHEMA)


def entitled_rows(mart: DataFrame, policy: DataFrame) -> DataFrame:
    """Mart rows per persona allowed to see them (persona column added).

    Every row looks up its own unit and "all units": an equi-join whatever the
    units are. A policy for all groups of a unit makes the others of that unit
    redundant; what still overlaps is one row per persona and mart row.
    """
    rules = policy.select(
        "persona", F.coalesce("bu_id", F.lit(ALL_UNITS)).alias("_unit"), F.col("business_group").alias("_group"))
    rules = rules.groupBy("persona", "_unit").agg(
        F.max(F.col("_group").isNull()).alias("_every"), F.collect_set("_group").alias("_groups"))
    keyed = mart.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_unit", F.explode(F.array_compact(F.array("bu_id", F.lit(ALL_UNITS)))))
    allowed = F.col("_every") | F.coalesce(F.array_contains("_groups", F.col("business_group")), F.lit(False))
    return (keyed.join(rules, "_unit").filter(allowed).dropDuplicates(["persona", "_row"])
            .select(*mart.columns, "persona"))


def visible_to_persona(mart: DataFrame, policy: DataFrame, persona: str) -> DataFrame:
    """One persona's view: the mart's columns only."""
    return entitled_rows(mart, policy.filter(F.col("persona") == persona)).drop("persona")


PERSONA = "persona"  # name of the session variable


def persona_view(spark: SparkSession, mart: DataFrame, policy: DataFrame, name: str) -> None:
    """Create the temporary view ``name``: the rows of ``mart`` that the persona in
    the session variable may see. One SQL text then serves every persona; with
    no or an unknown persona it has no rows.

    The policies of one persona are read as one small array, so the mart is
    only filtered, not joined.
    """
    spark.sql(f"DECLARE OR REPLACE VARIABLE {PERSONA} STRING DEFAULT NULL")
    mart.createOrReplaceTempView(f"{name}_all")
    policy.createOrReplaceTempView(f"{name}_policy")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW {name} AS
        SELECT * EXCEPT (_rules) FROM (
          SELECT m.*, (SELECT collect_list(struct(bu_id, business_group)) FROM {name}_policy p
                       WHERE p.persona = session.{PERSONA}) AS _rules
          FROM {name}_all m) m
        WHERE exists(_rules, r -> coalesce((r.bu_id IS NULL OR r.bu_id = m.bu_id)
          AND (r.business_group IS NULL OR r.business_group = m.business_group), false))""")


def as_persona(spark: SparkSession, persona: str | None) -> None:
    """Set the session's persona."""
    spark.sql(f"SET VAR {PERSONA} = :persona", args={"persona": persona})


def divest(df: DataFrame, units: Sequence[str], bu_col: str = "bu_id") -> tuple[DataFrame, DataFrame]:
    """(slice of the divested units, remainder of the enterprise)."""
    is_out = F.col(bu_col).isin(list(units))
    return df.filter(is_out), df.filter(~is_out | F.col(bu_col).isNull())


def partition_check(whole: DataFrame, parts: Sequence[DataFrame], measures: Sequence[str]) -> DataFrame:
    """One row: do the parts add up to the whole (row counts and measure
    sums)? One aggregate over a tagged union, no join."""
    tagged = whole.select(*measures, F.lit(True).alias("_whole"))
    for part in parts:
        tagged = tagged.unionByName(part.select(*measures, F.lit(False).alias("_whole")))
    is_whole = F.col("_whole")
    aggs = [F.sum(is_whole.cast("long")).alias("whole_rows"),
            F.sum((~is_whole).cast("long")).alias("parts_rows")]
    for m in measures:
        aggs += [F.sum(F.when(is_whole, F.col(m))).alias(f"whole_{m}"),
                 F.sum(F.when(~is_whole, F.col(m))).alias(f"parts_{m}")]
    totals = tagged.agg(*aggs)
    ok = F.col("whole_rows") == F.col("parts_rows")
    for m in measures:
        ok = ok & F.col(f"whole_{m}").eqNullSafe(F.col(f"parts_{m}"))
    return totals.select(F.col("whole_rows").alias("rows"), ok.alias("consistent"))


# --- digest tree of a package ----------------------------------------------------
#
# Level "file": rows and content digest of one file. Levels "partition", "table"
# and "package": rows, and a digest of the names and digests one level below. So
# one partition can be checked from its own files and its entry alone, and the
# entry against the package's digest from entries only.

TREE_SCHEMA = "level string, table_name string, part string, file string, rows bigint, digest string"
_LEVELS = (("partition", ("table_name", "part"), "file"), ("table", ("table_name",), "part"),
           ("package", (), "table_name"))


def _file_entries(spark: SparkSession, path: str, table: str, part: str | None = None) -> DataFrame:
    """File entries of a table, or of one of its partitions (``column=value``)."""
    from ..functions.hashing import content_digest, digest_aggs

    rows = spark.read.option("basePath", f"{path}/{table}").parquet(f"{path}/{table}" + (f"/{part}" if part else ""))
    inside = F.regexp_extract(F.col("_metadata.file_path"), f"/{table}/(?:(.*)/)?([^/]+)$", 1)
    named = rows.withColumns({"_part": inside, "_file": F.col("_metadata.file_name")})
    found = named.groupBy("_part", "_file").agg(*digest_aggs(named, exclude=("_part", "_file")))
    return found.select(F.lit("file").alias("level"), F.lit(table).alias("table_name"), F.col("_part").alias("part"),
                        F.col("_file").alias("file"), F.col("_rows").alias("rows"), content_digest(table, None).alias("digest"))


def _above(entries: DataFrame, level: str, keys: Sequence[str], child: str) -> DataFrame:
    """Entries of a level from those below it. A group holds the names and
    digests of files of a partition, partitions of a table, or tables."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(child, "digest"))),
                                    lambda e: F.concat_ws(":", e[child], e["digest"])), "|")
    found = entries.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sha2(text, 256).alias("digest"))
    name = lambda c: F.col(c) if c in keys else F.lit(None).cast("string").alias(c)
    return found.select(F.lit(level).alias("level"), name("table_name"), name("part"),
                        F.lit(None).cast("string").alias("file"), "rows", "digest")


def digest_tree(spark: SparkSession, path: str, tables: Sequence[str]) -> DataFrame:
    """Entries of all levels, from the files as they are now."""
    below = None
    for table in tables:
        files = _file_entries(spark, path, table)
        below = files if below is None else below.unionAll(files)
    every = below
    for level, keys, child in _LEVELS:
        below = _above(below, level, keys, child)
        every = every.unionAll(below)
    return every


def write_digest_tree(spark: SparkSession, path: str, tables: Sequence[str]) -> DataFrame:
    """Store the tree beside the tables (``{path}/tree``) and return it."""
    digest_tree(spark, path, tables).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")
    return spark.read.schema(TREE_SCHEMA).parquet(f"{path}/tree")


def check_entries(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of both with ``verified``: same rows and digest. An entry of one
    side only is not verified."""
    keys = ["level", "table_name", "part", "file"]
    both = stored.select(*keys, F.lit(1).alias("_old"), "rows", "digest").unionAll(
        found.select(*keys, F.lit(0), "rows", "digest"))
    return both.groupBy(*keys).agg(
        F.max(F.when(F.col("_old") == 1, F.col("rows"))).alias("rows"),
        ((F.count(F.lit(1)) == 2) & (F.min(F.struct("rows", "digest")) == F.max(F.struct("rows", "digest")))).alias("verified"))


def check_partition(spark: SparkSession, path: str, table: str, part: str) -> DataFrame:
    """Check one partition of a package alone: only its files are read. Returns
    its file entries and its own, with ``verified``."""
    files = _file_entries(spark, path, table, part)
    found = files.unionAll(_above(files, *_LEVELS[0]))
    stored = spark.read.schema(TREE_SCHEMA).parquet(f"{path}/tree").where(
        (F.col("table_name") == table) & (F.col("part") == part))
    return check_entries(stored, found)


def handover_package(spark: SparkSession, path: str,
                     tables: dict[str, tuple[DataFrame | Callable[[str], DataFrame], str | None]]) -> DataFrame:
    """Write each table of a divested unit to ``{path}/{name}`` and return the
    manifest: rows, amount total and whether the package re-reads to the
    same content digest that was observed while writing it.

    The digest of what was written is taken with ``observe`` during the write
    (no second pass over the source); the check re-reads the files. The
    manifest, with content ids, is stored at ``{path}/manifest``.
    """
    from pyspark.sql import Observation

    from ..functions.hashing import DIGESTS, batch_id, digest_aggs

    parts = []
    for name, (df, amount) in tables.items():
        if callable(df):  # made from tables of the package that are written already
            df = df(path)
        obs = Observation(f"package_{name}")
        df.observe(obs, *digest_aggs(df)).write.mode("overwrite").parquet(f"{path}/{name}")
        seen = obs.get
        back = spark.read.parquet(f"{path}/{name}")
        total = F.sum(amount) if amount else F.lit(None)
        parts.append(back.agg(*digest_aggs(back), total.cast("double").alias("amount_total")).select(
            F.lit(name).alias("table_name"),
            F.col("_rows").alias("row_count"),
            "amount_total",
            F.forall(F.array(*[F.col(c).eqNullSafe(F.lit(seen[c])) for c in ("_rows", *DIGESTS)]),
                     lambda same: same).alias("id_verified"),
            batch_id(name, None).alias("content_id"),
        ))
    manifest = parts[0]
    for p in parts[1:]:
        manifest = manifest.unionByName(p)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest").drop("content_id")
