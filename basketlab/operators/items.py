"""Item frequency, core items and best sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlab.functions.labels import TOP_PRODUCTS


def item_frequency(lines: DataFrame) -> DataFrame:
    """Raw lines (duplicates included) per product: product_id, item_count."""
    return lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("item_count"))


def core_items(frequency: DataFrame, min_item_freq: int | None) -> DataFrame:
    """Products with at least ``min_item_freq`` lines; None keeps all."""
    if min_item_freq is None:
        return frequency
    return frequency.filter(F.col("item_count") >= min_item_freq)


def item_sales(frequency: DataFrame, products: DataFrame) -> DataFrame:
    """Lines per item name.

    Counted per product before names are attached, so the join and the second
    aggregation handle products, not lines; products sharing a name add up.
    """
    return (
        frequency.join(products.select("product_id", "product_name"), "product_id")
        .groupBy(F.col("product_name").alias("item"))
        .agg(F.sum("item_count").alias("total_sales"))
    )


def top_items(sales: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The ``n`` best-selling items; the name decides ties."""
    return sales.orderBy(F.desc("total_sales"), "item").limit(n)


def top_products(frequency: DataFrame, products: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The ``n`` best-selling products with their names; name and id decide ties."""
    return (
        frequency.join(products.select("product_id", "product_name"), "product_id")
        .orderBy(F.desc("item_count"), "product_name", "product_id")
        .limit(n)
    )
