"""Numbers that follow a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlab.storage import materialize


def numbered(rows: DataFrame, order: Sequence[Column | str], column: str, label: str = "numbered") -> DataFrame:
    """The rows with ``column``, their number from 1 on in the given order.

    No task sees all rows: the sort is range-partitioned and rows are numbered within
    their partition; only the sizes of the partitions are summed up in one task.  The
    sorted rows are written, because a second evaluation could cut the ranges anew.
    """
    rows = materialize(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(before, part == F.col("_part")).withColumn(column, number).drop("_at", "_part", "_before")
