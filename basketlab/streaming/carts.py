"""Recommendations for a stream of carts against a static rule table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketlab.functions.labels import FALLBACK_ITEMS, RECOMMENDATIONS
from basketlab.operators.recommend import prepare, recommend_with_fallback
from basketlab.sources.schemas import CARTS


def cart_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Carts that arrive as Parquet files below ``path``."""
    return (
        spark.readStream.schema(CARTS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


def score_carts(
    carts: DataFrame,
    rules: DataFrame,
    popular: DataFrame,
    out_path: str,
    checkpoint_path: str,
    top_n: int = RECOMMENDATIONS,
    fallback_n: int = FALLBACK_ITEMS,
) -> StreamingQuery:
    """Score every cart that has arrived, then stop.

    Carts are independent, so no state is kept.  Each micro-batch overwrites its own
    folder: a batch replayed after a failure leaves the same rows, not a second copy.
    Rules and sales are numbered, keyed by the rarest item of what was sold and bucketed
    by it once, before the first batch; a batch moves its carts only.
    """
    buckets = int(carts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = prepare(rules, popular, buckets)

    def score(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # several joins read it; what an executor loses is read again
        recommend_with_fallback(batch, rules, popular, top_n, fallback_n, ready).write.mode("overwrite").parquet(
            f"{out_path}/batch_id={batch_id}"
        )
        batch.unpersist()

    return (
        carts.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
