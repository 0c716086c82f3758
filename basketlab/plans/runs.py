"""Run metrics: rows and seconds of every step, measured on its action."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketlab.functions.labels import LIVE_CONFIG_PREFIX

METRICS_SCHEMA = (
    "run_id string, step_num int, step string, rows_in long, rows_out long, "
    "seconds double, finished_at string"
)


@dataclass
class RunRecorder:
    """Collects one row per step; the rows become a DataFrame at the end of the run."""

    spark: SparkSession
    run_id: str
    steps: list[tuple] = field(default_factory=list)

    def add(self, step: str, rows_in: int, rows_out: int, seconds: float) -> None:
        finished = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        self.steps.append(
            (self.run_id, len(self.steps) + 1, step, rows_in, rows_out, round(seconds, 3), finished)
        )

    def seconds(self, step: str) -> float:
        """How long a recorded step took."""
        return next(seconds for _, _, name, _, _, seconds, _ in self.steps if name == step)

    def run(self, step: str, rows_in: int, work: Callable[[], DataFrame]) -> DataFrame:
        """Run a step whose result is a written table, so counting it reads footers only."""
        started = time.perf_counter()
        result = work()
        rows_out = result.count()
        self.add(step, rows_in, rows_out, time.perf_counter() - started)
        return result

    @contextmanager
    def step(self, name: str, rows_in: int):
        """Time a block; the block sets ``rows_out`` on the yielded dict."""
        out = {"rows_out": 0}
        started = time.perf_counter()
        yield out
        self.add(name, rows_in, out["rows_out"], time.perf_counter() - started)

    def metrics(self) -> DataFrame:
        return self.spark.createDataFrame(self.steps, METRICS_SCHEMA)


def merge_live_row(experiments: DataFrame, live: DataFrame) -> DataFrame:
    """Show the live run in the row of the reference configuration.

    The live values replace the sweep's in that row; the sweep's own counts stay next
    to them, because the two runs use different baskets and must not be compared as
    one.  ``live`` has one row.
    """
    is_live = F.col("config_id").startswith(LIVE_CONFIG_PREFIX)
    replaced = [c for c in live.columns if c in experiments.columns]

    def value(name: str) -> Column:
        return F.when(is_live, F.coalesce(live.select(name).scalar(), F.col(name))).otherwise(
            F.col(name)
        )

    return experiments.select(
        *[value(c).alias(c) if c in replaced else F.col(c) for c in experiments.columns],
        F.col("frequent_itemsets").alias("sweep_frequent_itemsets"),
        F.col("association_rules").alias("sweep_association_rules"),
        F.when(is_live, F.lit("live run")).otherwise(F.lit("sweep")).alias("measured_by"),
    )
