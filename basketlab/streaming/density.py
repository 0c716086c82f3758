"""Order density by hour, kept up to date while orders arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from basketlab import versions
from basketlab.sources.retail import day_of_week
from basketlab.storage import remove

DELAY = "2 hours"


def order_time_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    time_column: str = "ts",
    file_filter: str | None = None,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Order times from Parquet files: event time, day of week and hour."""
    reader = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    )
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    at = F.col(time_column)
    return reader.parquet(path).select(
        at.cast("timestamp").alias("event_time"),
        day_of_week(at).alias("dow"),
        F.hour(at).alias("hour"),
    )


def hourly_counts(times: DataFrame, delay: str = DELAY) -> DataFrame:
    """Orders per clock hour.

    State holds one row per open hour and day cell; the watermark closes hours that
    are older than the delay and drops orders that arrive later still.
    """
    return (
        times.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour").alias("w"), "dow", "hour")
        .agg(F.count(F.lit(1)).alias("orders_count"))
        .select(F.col("w.start").alias("hour_start"), "dow", "hour", "orders_count")
    )


CLOSED = "hour_start timestamp, dow int, hour int, orders_count long"
HOURS = f"{CLOSED}, closed boolean"


MERGED = "_merged"
MERGE_EVERY = 20


def store_hours(batch: DataFrame, batch_id: int, out_path: str, delay: str = DELAY) -> None:
    """Merge the hours a micro-batch changed into the store, one folder for each batch.

    Hours that can still change are taken over from the folder of the batch before; an
    hour that no later order can reach is marked closed, stays where it is and is never
    read again by a batch.  It is closed by the latest hour of the batches before this
    one, because that is what the next batch's orders are held against.  A replayed
    batch reads the folder of its predecessor and overwrites its own, so nothing
    changes; open hours of older folders are removed.  Every ``MERGE_EVERY`` batches the
    closed hours of the batches before move into one table.
    """
    spark = batch.sparkSession
    known = spark.createDataFrame([], HOURS)
    if batch_id > 0:
        known = spark.read.schema(HOURS).parquet(f"{out_path}/batch_id={batch_id - 1}").filter(~F.col("closed"))
    reached = known.agg(F.max("hour_start") - F.expr(f"INTERVAL {delay}")).scalar()
    newest = batch.withColumn("age", F.lit(1)).unionByName(known.drop("closed").withColumn("age", F.lit(0)))
    merged = newest.groupBy("hour_start", "dow", "hour").agg(F.max_by("orders_count", "age").alias("orders_count"))
    out_of_reach = F.col("hour_start") + F.expr("INTERVAL 1 hour") <= reached
    merged.withColumn("closed", F.coalesce(out_of_reach, F.lit(False))).write.mode("overwrite").partitionBy(
        "closed"
    ).parquet(f"{out_path}/batch_id={batch_id}")
    if batch_id > 1:
        remove(spark, f"{out_path}/batch_id={batch_id - 2}/closed=false")
    if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
        merge_closed(spark, out_path, batch_id - 1)


def _merged(spark: SparkSession, out_path: str) -> tuple[DataFrame, int]:
    """The closed hours merged so far and the last batch they cover, -1 before the first time."""
    stored = versions.current(spark, f"{out_path}/{MERGED}")
    if stored is None:
        return spark.createDataFrame([], CLOSED), -1
    return spark.read.schema(CLOSED).parquet(stored.folder), stored.notes["through"]


def merge_closed(spark: SparkSession, out_path: str, through: int) -> None:
    """Move the closed hours of all batches up to ``through`` into one sorted file.

    The file is a new version of the merged table and says which batches it covers, so a
    reader sees an hour either there or in the folder of its batch, never in both.
    Covered folders are removed afterwards, but for the last one, whose open hours a
    replay still reads.  The file has a row for each hour since the start, whatever the
    number of orders.
    """
    old, done = _merged(spark, out_path)
    if done >= through:
        return  # a replay
    hours = spark.read.schema(f"{HOURS}, batch_id long").parquet(out_path)
    new = hours.filter(F.col("closed") & F.col("batch_id").between(done + 1, through)).drop("batch_id", "closed")
    every = old.unionByName(new).repartition(1).sortWithinPartitions("hour_start", "dow", "hour")
    versions.replace(spark, f"{out_path}/{MERGED}", every.write.parquet, notes={"through": through})
    for batch_id in range(done, through):  # the last covered folder of the time before stayed then
        remove(spark, f"{out_path}/batch_id={batch_id}")
    remove(spark, f"{out_path}/batch_id={through}/closed=true")


def keep_hourly_counts(
    counts: DataFrame, out_path: str, checkpoint_path: str, delay: str = DELAY
) -> StreamingQuery:
    """Keep the store of hours up to date; ``delay`` is the one given to ``hourly_counts``."""
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: store_hours(batch, batch_id, out_path, delay))
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def current_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The count of every hour: the closed ones, merged or not, and those open after the last batch."""
    merged, through = _merged(spark, out_path)
    hours = spark.read.schema(f"{HOURS}, batch_id long").parquet(out_path)
    last = hours.filter(~F.col("closed")).agg(F.max("batch_id")).scalar()
    closed = F.col("closed") & (F.col("batch_id") > through)
    recent = hours.filter(closed | (~F.col("closed") & (F.col("batch_id") == last))).drop("batch_id", "closed")
    return merged.unionByName(recent)


def density_from_hours(hours: DataFrame) -> DataFrame:
    """The 168 cells from the hourly counts."""
    return hours.groupBy("dow", "hour").agg(F.sum("orders_count").alias("orders_count"))
