"""Session settings and the shared scratch location.

Intermediate tables (landing files, bronze, CDC state, stream checkpoints,
hand-over packages) live under the cluster's shared ``spark.checkpoint.dir``,
or the checkpoint directory set on the context. There is no default: a folder
that only one machine sees would make later reads incomplete.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC instants, AQE (coalescing, skew
# splitting, runtime broadcast only under the size threshold).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "unitmart", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on (time zone) on a given session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


# Partition folders (units) that one task writes side by side. Up to so many it
# need not sort its rows by folder first, which would spill; beyond, it does.
OPEN_FOLDERS = 16


@contextlib.contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Within, partitioned writes keep a file open per partition folder instead
    of sorting by folder."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique directory under the shared root for one run."""
    return "/".join([shared_root(spark), "unitmart", *parts, uuid.uuid4().hex])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table directory exists, asked of its Hadoop filesystem (so
    first runs need no exception for control flow)."""
    jvm = getattr(spark, "_jvm", None)
    jsc = getattr(spark, "_jsc", None)
    if jvm is None or jsc is None:  # Spark Connect: fall back to a read attempt
        from pyspark.errors import AnalysisException
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise  # not allowed to look, or the like: never "absent"
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(jsc.hadoopConfiguration()).exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, sorted; none if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory (one step on HDFS and local file systems)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    src, dst = jvm_path(source), jvm_path(target)
    if not src.getFileSystem(spark._jsc.hadoopConfiguration()).rename(src, dst):
        raise OSError(f"cannot rename {source} to {target}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table directory that a newer one has superseded."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
