"""Why an order became a basket, or did not."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlab.functions.labels import (
    REASON_G0,
    REASON_G1,
    REASON_G2,
    REASON_G3,
    REASON_G4,
    REASON_QUALIFIED,
    STATUS_EXCLUDED,
    STATUS_QUALIFIED,
)
from basketlab.operators.baskets import QUALIFIED


def trace_orders(
    profiles: DataFrame, first_order: int | None = None, last_order: int | None = None
) -> DataFrame:
    """Per order: item counts before and after, a sample, status and reason.

    The key range is optional and inclusive.  Qualified orders show their first four
    items, excluded ones every core item they have.
    """
    if first_order is not None and last_order is not None:
        profiles = profiles.filter(F.col("order_id").between(first_order, last_order))
    group = F.col("exclusion_group")
    qualified = group == QUALIFIED
    kept = F.size("core_items")
    only = F.try_element_at("core_items", F.lit(1))
    reason = (
        F.when(qualified, F.format_string(REASON_QUALIFIED, kept))
        .when(group == "G0", F.lit(REASON_G0))
        .when(group == "G1", F.lit(REASON_G1))
        .when(group == "G2", F.lit(REASON_G2))
        .when(group == "G3", F.format_string(REASON_G3, only))
        .otherwise(F.format_string(REASON_G4, only))
    )
    return profiles.select(
        "order_id",
        F.col("raw_lines").alias("items_before_count"),
        F.when(qualified, kept.cast("long")).otherwise(F.col("c_core")).alias("items_after_count"),
        F.when(qualified, F.slice("core_items", 1, 4))
        .otherwise(F.col("core_items"))
        .alias("items_after_sample"),
        F.when(qualified, F.lit(STATUS_QUALIFIED)).otherwise(F.lit(STATUS_EXCLUDED)).alias("status"),
        reason.alias("reason"),
    )


def sample_records(traces: DataFrame) -> DataFrame:
    """The qualified orders of a trace in the form of the report."""
    return traces.filter(F.col("status") == STATUS_QUALIFIED).select(
        "order_id",
        F.col("items_before_count").alias("raw_items_count"),
        F.col("items_after_sample").alias("cleaned_items"),
    )
