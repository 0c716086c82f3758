"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the cores.
Every query runs once, to its last row, after a warm-up pass over the smallest data set
that pays for class loading and code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from basketlab.operators import evaluate as E  # noqa: E402
from basketlab.operators import recommend as R  # noqa: E402
from basketlab.plans import market_basket as MB  # noqa: E402
from basketlab.plans import queries as Q  # noqa: E402
from basketlab.session import local_session  # noqa: E402
from basketlab.sources import retail  # noqa: E402
from basketlab.storage import scratch_path  # noqa: E402

# The larger data set is independent by construction, so rules reach a lift of 1.2 on
# the small ones only; 1.0 keeps the serving queries busy.
BENCH_MINING = MB.Settings(
    min_item_freq=None, min_support=0.003, min_confidence=0.05, min_lift=1.0, split=None
)


# Serving and evaluation use the model that the "train" step left behind, as a service would.
MODELS: dict[str, MB.Model] = {}


def train(spark: SparkSession, sf: str) -> DataFrame:
    MODELS[sf] = MB.train(retail.load_star(spark, sf), BENCH_MINING)
    return MODELS[sf].rules


def serve(spark: SparkSession, sf: str) -> DataFrame:
    model = MODELS[sf]
    carts = Q.shopper_carts(spark, sf, model.baskets)
    return R.recommend_with_fallback(carts, model.rules, model.popular)


def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    model = MODELS[sf]
    return E.evaluate(model.baskets, model.rules, model.popular, Q.name_catalog_size(spark, sf))


def whole_job(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "job")
    MB.run_pipeline(spark, retail.load_star(spark, sf), BENCH_MINING, out, "bench")
    return spark.read.parquet(f"{out}/runs")


HEADLINE = {
    **{
        name: Q.REGISTRY[name]
        for name in (
            "table_audit",
            "integrity_report",
            "orders_per_dow_hour",
            "core_items",
            "top_items",
            "baskets",
            "exclusion_breakdown",
            "order_trace",
            "itemsets",
            "parameter_sweep",
            "stream_hourly",
        )
    },
    "train": train,
    "recommend": serve,
    "evaluate": evaluate,
    "whole_job": whole_job,
}


def seconds(query, spark: SparkSession, sf: str) -> float:
    started = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    small = os.path.join(os.path.dirname(sf), "sf0.001")
    if os.path.isdir(small) and small != sf:
        for query in HEADLINE.values():
            seconds(query, spark, small)
    timings = {name: seconds(query, spark, sf) for name, query in HEADLINE.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
