"""Data-quality expectations.

* drop: rows failing the rule are filtered; the dropped count is reported
  through ``DataFrame.observe`` (no extra job).
* fail: a failing row raises inside the filter, so column pruning cannot
  remove the check even when the tested column is not selected later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def expect_or_drop(df: DataFrame, name: str, rule: str,
                   observation: Observation | str | None = None,
                   extra_metrics: Sequence[Column] = ()) -> DataFrame:
    """``observation`` is an ``Observation`` (batch) or a metric name
    (streaming: reported in the query progress)."""
    ok = F.coalesce(F.expr(rule), F.lit(False))
    if observation is not None:
        df = df.observe(observation, F.sum(F.when(ok, 0).otherwise(1)).alias(f"dropped_{name}"),
                        F.count(F.lit(1)).alias(f"seen_{name}"), *extra_metrics)
    return df.filter(ok)


def expect_or_fail(df: DataFrame, name: str, rule: str, keys: Sequence[str] = ()) -> DataFrame:
    """The error names the row by ``keys`` only: rows may hold personal data."""
    ok = F.coalesce(F.expr(rule), F.lit(False))
    msg = F.lit(f"expectation '{name}' failed: {rule}")
    if keys:
        msg = F.concat(msg, F.lit("; row "), F.to_json(F.struct(*[F.col(c) for c in keys])))
    return df.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(msg).cast("boolean")))


def relation_violations(df: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a null in a required column, and keys of more
    than one row (a key with a null is not one)."""
    null = F.lit(False)
    for c in required:
        null = null | F.col(c).isNull()
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(null.cast("bigint")).alias("_null"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("_null"), F.lit(0)).alias("not_null_violations"),
        F.count(F.when((F.col("_n") > 1) & known, 1)).alias("key_violations"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_versions") -> DataFrame:
    """Keys seen more than once (partial counts combine map-side)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)
