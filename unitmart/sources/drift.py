"""Schema drift of landed records: fields that the declared schema does not
take are rescued in a VARIANT beside the typed parse.

Rescued is a field that the schema does not name, and one that it names but
whose value the typed parse could not read (a text where a number was
declared). The typed columns are the same as without rescue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued"
_FIELDS = "map<string,variant>"


def field_count(value: Column) -> Column:
    """Fields (with repeats) of a landed text that is one record; null if it is
    anything else (an array of records, or malformed)."""
    return F.array_size(F.json_object_keys(value))


def typed_and_raw(value: Column, fields: Column, schema: T.StructType) -> Column:
    """Array of (typed record, map of its raw fields) of a landed text, which is
    an array of records or one record; null if it is malformed. The raw fields
    of one record (its ``fields`` are counted) are left to ``raw_fields``."""
    typed = F.from_json(value, T.ArrayType(schema))
    whole = F.coalesce(F.from_json(value, f"array<{_FIELDS}>"), F.array(F.from_json(value, _FIELDS)))
    raw = F.when(fields.isNull(), whole).otherwise(F.array(F.lit(None).cast(_FIELDS)))
    return F.arrays_zip(typed.alias("typed"), raw.alias("raw"))


def raw_fields(raw: Column, text: Column, fields: Column, typed: Column, schema: T.StructType) -> Column:
    """The raw fields of a record. Every value read comes from a field, so a
    record with as many fields as values has lost none: it is not parsed again
    (null)."""
    read = sum((F.when(typed[f.name].isNotNull(), 1).otherwise(0) for f in schema.fields), F.lit(0))
    return F.when(fields.isNull(), raw).when(fields > read, F.from_json(text, _FIELDS))


def lost_fields(raw: Column, typed: Column, schema: T.StructType) -> Column:
    """The raw fields that the typed record has no value of."""
    read = F.array(*[F.when(typed[f.name].isNotNull(), F.lit(f.name)) for f in schema.fields])
    return F.map_filter(raw, lambda k, v: v.isNotNull() & ~F.is_variant_null(v) & ~F.coalesce(
        F.array_contains(read, k), F.lit(False)))


def variant_of(lost: Column) -> Column:
    """Fields as one VARIANT (null if there are none)."""
    keys = F.array_distinct(F.map_keys(lost))  # a record may repeat a name
    once = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(lost, k)))
    return F.when(F.size(keys) > 0, F.to_variant_object(once))


def rescued_fields(rows: DataFrame) -> DataFrame:
    """Per rescued field: its name, records, and the type that holds all its values."""
    fields = rows.select(F.explode(F.col(RESCUED).cast(_FIELDS)).alias("field", "value"))
    return fields.groupBy("field").agg(F.count(F.lit(1)).alias("records"), F.schema_of_variant_agg("value").alias("type"))
