"""When orders are placed: hour and day profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketlab.functions.labels import HEAT_ROW_ORDER
from basketlab.functions.text import day_name, thousands
from basketlab.storage import materialize

HOURS = list(range(24))


# what a row of the profile counts
CELL, HOUR, ALL = "cell", "hour", "all"


def profile(orders: DataFrame) -> DataFrame:
    """Orders by day and hour, by hour, and in all: kind, dow, hour, orders_count, from one pass.

    Partial counts shrink each grouping to its few cells before anything moves; the
    result has at most a row for each of them.
    """
    day, hour = "order_dow", "order_hour_of_day"
    grouping = F.grouping_id().alias("grouping")
    counted = orders.select(day, hour).groupingSets([[day, hour], [hour], []], day, hour)
    rows = counted.agg(F.count(F.lit(1)).alias("orders_count"), grouping)
    kind = F.when(F.col("grouping") == 0, CELL).when(F.col("grouping") == 2, HOUR).otherwise(ALL)
    return rows.select(kind.alias("kind"), F.col(day).alias("dow"), F.col(hour).alias("hour"), "orders_count")


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind") == CELL).select("dow", "hour", "orders_count")


def orders_per_hour(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.col("order_hour_of_day").alias("hour"))
        .agg(F.count(F.lit(1)).alias("orders_count"))
        .orderBy("hour")
    )


def orders_per_dow_hour(orders: DataFrame) -> DataFrame:
    """The 7 x 24 density; at most 168 rows whatever the input."""
    return orders.groupBy(
        F.col("order_dow").alias("dow"), F.col("order_hour_of_day").alias("hour")
    ).agg(F.count(F.lit(1)).alias("orders_count"))


def heat_pivot(density: DataFrame) -> DataFrame:
    """One row per day, Monday first, one column per hour, empty cells 0.

    Hours are listed, so the pivot needs no extra pass to find them.  Orders of any other
    day or of none share the last row (day null), those of any other hour or of none the
    column ``other``, so the cells always add up to the orders.
    """
    row_order = F.array_position(F.array(*[F.lit(d) for d in HEAT_ROW_ORDER]), F.col("dow"))
    known_hour = F.col("hour").isin(HOURS)
    count = F.col("orders_count")
    cells = [F.coalesce(F.sum(F.when(F.col("hour") == h, count)), F.lit(0)).alias(f"h{h:02d}") for h in HOURS]
    other = F.coalesce(F.sum(F.when(~F.coalesce(known_hour, F.lit(False)), count)), F.lit(0)).alias("other")
    return (
        density.withColumn("dow", F.when(F.col("dow").between(0, 6), F.col("dow")))
        .groupBy("dow")
        .agg(*cells, other)
        .select(
            F.coalesce(row_order, F.lit(len(HEAT_ROW_ORDER) + 1)).cast("int").alias("day_order"),
            F.when(F.col("dow").isNotNull(), day_name(F.col("dow"))).alias("day"),
            *[f"h{h:02d}" for h in HOURS],
            "other",
        )
        .orderBy("day_order")
    )


def heat_total(heat: DataFrame) -> Column:
    """Sum of all cells of the map, as a scalar subquery."""
    return heat.agg(F.coalesce(F.sum(sum((F.col(f"h{h:02d}") for h in HOURS), F.col("other"))), F.lit(0))).scalar()


def reconciliation(orders: DataFrame) -> DataFrame:
    """Sums of the hours, of the cells and of the heat map, number of orders, and whether all agree.

    The orders are read once; all sums follow from the written profile.
    """
    return reconciled(materialize(profile(orders), "time-profile"))


def reconciled(rows: DataFrame) -> DataFrame:
    """The sums of a profile."""

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("orders_count"))), F.lit(0))

    return (
        rows.agg(
            total(HOUR).alias("hour_total"),
            total(CELL).alias("cell_total"),
            total(ALL).alias("total_orders"),
            F.count_if(F.col("kind") == CELL).alias("cells"),
        )
        .select("hour_total", "cell_total", heat_total(heat_pivot(cells_of(rows))).alias("heat_total"), "total_orders", "cells")
        .withColumn(
            "reconciled",
            (F.col("hour_total") == F.col("cell_total"))
            & (F.col("heat_total") == F.col("cell_total"))
            & (F.col("cell_total") == F.col("total_orders")),
        )
        .withColumn("total_orders_text", thousands(F.col("total_orders")))
    )


def day_labels(density: DataFrame) -> DataFrame:
    """Density with the name of the day; unknown days keep a generic label."""
    return density.withColumn("day", day_name(F.col("dow")))

