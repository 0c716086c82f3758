"""Shared-folder storage for intermediate tables.

Intermediate results that several plans read are written once to the folder the
session names in ``spark.checkpoint.dir`` and read back.  Losing an executor then
costs a re-read, not a recomputation, and Catalyst sees the real file size of the
table, so the choice between a broadcast and a shuffle join rests on a measured
number instead of a hint.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_tables: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session; only a local master may go without the setting."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="basketlab-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never used twice."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote below the shared folder; no table read from there may be used after."""
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return remove(spark, f"{shared_root(spark)}/{spark.sparkContext.applicationId}")


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system holds it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(
    df: DataFrame, key: str, buckets: int, label: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Write ``df`` once as a table bucketed and sorted by ``key``: joins on it need not move it again.

    Only the catalog knows buckets, so the table is registered under a name of its own
    until ``remove_scratch``.
    """
    spark = df.sparkSession
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.write.options(**(options or {})).bucketBy(buckets, key).sortBy(key)
    writer.option("path", scratch_path(spark, label)).saveAsTable(name)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)
