"""Session settings for local runs, tests and the benchmark.

On a cluster the session comes from ``spark-submit``; nothing in the library
depends on this module.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(
    app_name: str = "basketlab",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        # what MLlib shuffles as objects Kryo writes far more compactly
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="basketlab-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
