"""Landing zone: JSON files split by tenant, and their parse.

Layout: ``{root}/{source}/{object}/batch={id}/tenant={bu}/part-*.json``.
``tenant`` is a partition directory (the path tenant), while the payload keeps
its own ``bu_id``. Two file forms:

* ``lines`` (default): JSON lines, in files of at most ``records_per_file``
  rows; what large extracts should use.
* ``array``: one JSON array per file, the contract form of the original
  feeds. Rows are dealt by row position, not content (so even a mass of
  identical copies spreads), into chunks of at most about ``records_per_file``
  rows; no group is unbounded. Each task joins the arrays of its own rows,
  without a shuffle. Each array is written as its own file and read back with
  ``wholetext`` (one file = one row).

Files are compressed: the text repeats its field names in every record. No
file is large, so that it need not be split.

Instants are written with microseconds (the JSON default keeps
milliseconds, which would reorder CDC versions).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import LINEAGE_FIELDS, UNKNOWN_BU
from ..session import unsorted_writes
from .drift import RESCUED, field_count, lost_fields, raw_fields, typed_and_raw, variant_of

TENANT = "tenant"
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
DEFAULT_RECORDS_PER_FILE = 50_000
COMPRESSION = "snappy"
INSTANT_TYPES = (T.TimestampType, T.TimestampNTZType)


def stamp_lineage(df: DataFrame, source_system: str, object_name: str, batch: str | None = None,
                  ingested_at: Column | None = None) -> DataFrame:
    """Without a ``batch`` the id is left to the directory's name, from which
    ``parse_landing`` fills it in."""
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    return df.withColumns({
        "_ingested_at": F.date_format(at, JSON_OPTIONS["timestampFormat"]),
        "_source_system": F.lit(source_system),
        "_source_object": F.lit(object_name),
        "_batch_id": F.lit(batch).cast("string"),
    })


def landing_schema(feed_schema: T.StructType, lineage: bool = True) -> T.StructType:
    """Schema to parse landed files: instants as text, plus lineage fields."""
    fields = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, INSTANT_TYPES)
                            else f.dataType) for f in feed_schema.fields
              if not f.name.startswith("_")]
    return T.StructType(fields + (LINEAGE_FIELDS if lineage else []))


def instant_columns(feed_schema: T.StructType) -> list[str]:
    return [f.name for f in feed_schema.fields if isinstance(f.dataType, INSTANT_TYPES)]


def _joined(records_per_file: int, pretty: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Join (tenant, record text) rows into (tenant, array text), one array per
    tenant of every ``records_per_file`` rows of the task."""
    begin, between, end = ("[ ", ", ", " ]") if pretty else ("[", ",", "]")

    def arrays(held: dict[str | None, list[str]]) -> Iterator[pa.RecordBatch]:
        for tenant, records in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([tenant], pa.string()), pa.array([begin + between.join(records) + end], pa.string())],
                names=["tenant", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = {}, 0
        for batch in batches:
            for tenant, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(tenant, []).append(record)
                rows += 1
                if rows == records_per_file:
                    yield from arrays(held)
                    held, rows = {}, 0
        yield from arrays(held)

    return run


def write_landing(df: DataFrame, path: str, fmt: str = "lines", total_rows: int | None = None,
                  records_per_file: int = DEFAULT_RECORDS_PER_FILE,
                  tenant_col: str | None = "bu_id", pretty: bool = False,
                  measures: dict[str, tuple[Column, str]] | None = None) -> dict:
    """Write one batch; rewriting the same batch path replaces it. ``pretty``
    prints arrays over many lines. Arrays are dealt over the whole batch if
    ``total_rows`` is known, else within each task.

    ``measures`` (row expression, "sum" or "max") are totalled by the write
    itself and returned. They are observed in the stage that writes the files,
    whose tasks count once however often a lost executor has them repeated.
    """
    cols = df.columns
    obs = Observation() if measures else None
    if measures:
        df = df.withColumns({f"_measure_{m}": c for m, (c, _) in measures.items()})
    totals = [getattr(F, how)(f"_measure_{m}").alias(m) for m, (_, how) in (measures or {}).items()]
    seen = (lambda d: d.observe(obs, *totals).drop(*(f"_measure_{m}" for m in measures))) if measures else (lambda d: d)
    partition = []
    if tenant_col is not None:
        df = df.withColumn(TENANT, F.coalesce(F.col(tenant_col), F.lit(UNKNOWN_BU)))
        partition = [TENANT]
    json = {**JSON_OPTIONS, "pretty": str(pretty).lower()}
    if fmt == "lines":
        out = seen(df).write.options(**JSON_OPTIONS).option("maxRecordsPerFile", records_per_file)
        save = out.json
    elif fmt == "array":
        if total_rows is None:
            tenant = F.col(TENANT) if partition else F.lit(None).cast("string")
            records = seen(df).select(tenant.alias(TENANT), F.to_json(F.struct(*cols), json).alias("value"))
            arrays = records.mapInArrow(_joined(records_per_file, pretty), f"{TENANT} string, value string")
        else:
            place = F.monotonically_increasing_id()  # task in the upper bits, row of the task in the lower 33
            chunk = F.pmod(place, F.lit(max(1, math.ceil(total_rows / records_per_file))))
            per_array = [getattr(F, how)(f"_measure_{m}").alias(f"_measure_{m}") for m, (_, how) in (measures or {}).items()]
            arrays = seen(df.groupBy(*partition, chunk.alias("_chunk")).agg(
                F.to_json(F.collect_list(F.struct(*cols)), json).alias("value"), *per_array))
        out = arrays.select(*partition, "value").write.option("maxRecordsPerFile", 1)
        save = out.text
    else:
        raise ValueError(f"unknown landing format {fmt!r}")
    out.mode("overwrite").partitionBy(*partition).option("compression", COMPRESSION)
    with unsorted_writes(df.sparkSession):
        save(path)
    return obs.get if measures else {}


LANDING_PARTITIONS = ("batch", TENANT)


def read_landing(spark: SparkSession, path: str, fmt: str = "lines", stream: bool = False,
                 partitions: tuple[str, ...] = LANDING_PARTITIONS,
                 max_bytes: str | None = None, archive: str | None = None) -> DataFrame:
    """Raw landed text: ``value`` (+ partition columns, + source file).

    Partition columns are declared as strings: a batch id made only of
    digits must not be inferred as a number in one run and text in the next.
    """
    schema = ", ".join(["value string", *[f"{c} string" for c in partitions]])
    reader = spark.readStream if stream else spark.read
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    df = reader.schema(schema).format("text").option("wholetext", fmt == "array").load(path)
    return df.withColumn("_file", F.col("_metadata.file_path"))


def parse_landing(raw: DataFrame, schema: T.StructType, rescue: bool = False) -> DataFrame:
    """Array-of-struct parse; a JSON-lines object parses as a one-element
    array. Malformed text yields no rows (see ``quarantine``). A record without
    a batch id takes its directory's. ``rescue`` adds the fields that the schema
    does not take (see ``drift``)."""
    keep = [c for c in raw.columns if c != "value"]
    if rescue:
        counted, typed = raw.withColumn("_fields", field_count(F.col("value"))), F.col("_r.typed")
        each = counted.select(F.explode(typed_and_raw(F.col("value"), F.col("_fields"), schema)).alias("_r"),
                              "_fields", F.when(F.col("_fields").isNotNull(), F.col("value")).alias("_text"), *keep)
        each = each.withColumn("_raw", raw_fields(F.col("_r.raw"), F.col("_text"), F.col("_fields"), typed, schema))
        each = each.withColumn("_lost", lost_fields(F.col("_raw"), typed, schema))
        return _batch_filled(each.select("_r.typed.*", variant_of(F.col("_lost")).alias(RESCUED), *keep), schema)
    rows = raw.select(F.explode(F.from_json("value", T.ArrayType(schema))).alias("_r"), *keep)
    return _batch_filled(rows.select("_r.*", *keep), schema)


def _batch_filled(rows: DataFrame, schema: T.StructType) -> DataFrame:
    if "_batch_id" in schema.fieldNames() and "batch" in rows.columns:
        return rows.withColumn("_batch_id", F.coalesce("_batch_id", "batch"))
    return rows


def quarantine(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed texts that parse to nothing (malformed or empty), with their file."""
    parsed = F.from_json("value", T.ArrayType(schema))
    keep = [c for c in ("_file",) if c in raw.columns]
    return raw.filter(parsed.isNull() | (F.size(parsed) == 0)).select(*keep, "value")
