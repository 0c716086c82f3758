"""The retail tables, from CSV files or from a TPC-H-like star schema.

Every operator works on these columns, whichever loader filled them:

* orders: order_id, user_id, eval_set, order_dow, order_hour_of_day
* lines: order_id, product_id, add_to_cart_order
* products: product_id, product_name
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketlab.sources import schemas
from basketlab.sources.tables import read_if_exists, read_table
from basketlab.storage import materialize

STATUS_AS_SPLIT = {"F": "prior", "O": "train", "P": "test"}


@dataclass(frozen=True)
class Audited:
    """A whole source table for the quality report: its key and its references
    (column, parent table, parent key)."""

    name: str
    table: DataFrame
    key: Sequence[str]
    references: Sequence[tuple[str, DataFrame, str]] = ()


@dataclass(frozen=True)
class Retail:
    """``lines_split``: the lines lie in a table of their own that holds this split.
    ``orders_of``: reads the orders of one split, where the source can skip the others.
    ``audited``: the source tables beside the lines, whole, as they were found.
    """

    orders: DataFrame
    lines: DataFrame
    products: DataFrame
    lines_split: str | None = None
    orders_of: Callable[[str], DataFrame] | None = None
    audited: Sequence[Audited] = ()


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.STAR[name]).parquet(f"{sf_dir}/{name}.parquet")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(ts) - 1


def star_orders(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    """All orders, or those of a split: filtered on the status itself, which the scan can skip by."""
    orders = star_table(spark, sf_dir, "orders")
    if split is not None:
        orders = orders.filter(F.col("o_orderstatus").isin([s for s, v in STATUS_AS_SPLIT.items() if v == split]))
    by_status = F.create_map(*[F.lit(v) for pair in STATUS_AS_SPLIT.items() for v in pair])
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.try_element_at(by_status, F.col("o_orderstatus")).alias("eval_set"),
        day_of_week(F.col("o_orderdate")).alias("order_dow"),
        F.hour("o_orderdate").alias("order_hour_of_day"),
    )


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
    )


def star_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )


def star_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as order times, since order dates carry no hour."""
    return star_table(spark, sf_dir, "events").select(
        "ts",
        day_of_week(F.col("ts")).alias("order_dow"),
        F.hour("ts").alias("order_hour_of_day"),
    )


def load_star(spark: SparkSession, sf_dir: str) -> Retail:
    return Retail(
        star_orders(spark, sf_dir),
        star_lines(spark, sf_dir),
        star_products(spark, sf_dir),
        orders_of=lambda split: star_orders(spark, sf_dir, split),
        audited=[
            Audited("products", star_table(spark, sf_dir, "part"), ["p_partkey"]),
            Audited(
                "orders",
                star_table(spark, sf_dir, "orders"),
                ["o_orderkey"],
                [("o_custkey", star_table(spark, sf_dir, "customer"), "c_custkey")],
            ),
        ],
    )


def load_csv(spark: SparkSession, data_dir: str) -> Retail:
    """The six-file CSV layout; train lines, and with them the orders of that split, stand in
    when the prior lines are absent.

    Lines and orders are parsed once and written in columns, all of them, because every
    step and the audit read them again, each its own columns.
    """

    def table(name: str, schema: T.StructType) -> DataFrame | None:
        return read_if_exists(spark, f"{data_dir}/{name}.csv", schema)

    lines = {split: table(f"order_products__{split}", schemas.ORDER_PRODUCTS) for split in ("prior", "train")}
    used = next((split for split, found in lines.items() if found is not None), None)
    if used is None:
        raise FileNotFoundError(f"no order lines in {data_dir}")
    orders = materialize(read_table(spark, f"{data_dir}/orders.csv", schemas.ORDERS), "orders")
    products = read_table(spark, f"{data_dir}/products.csv", schemas.PRODUCTS)
    parents = {"aisle": table("aisles", schemas.AISLES), "department": table("departments", schemas.DEPARTMENTS)}
    # a reference to a table that is not there is not valid
    empty = {"aisle": schemas.AISLES, "department": schemas.DEPARTMENTS}
    references = [
        (f"{name}_id", spark.createDataFrame([], empty[name]) if found is None else found, f"{name}_id")
        for name, found in parents.items()
    ]
    of_lines = [("product_id", products, "product_id"), ("order_id", orders, "order_id")]
    audited = [
        Audited("orders", orders, ["order_id"]),
        Audited("products", products, ["product_id"], references),
        *[Audited(f"{name}s", found, [f"{name}_id"]) for name, found in parents.items() if found is not None],
        *[
            Audited(f"order_products__{split}", found, ["order_id", "product_id"], of_lines)
            for split, found in lines.items()
            if found is not None and split != used
        ],
    ]
    return Retail(
        orders.select("order_id", "user_id", "eval_set", "order_dow", "order_hour_of_day"),
        materialize(lines[used], "lines"),
        products.select("product_id", "product_name"),
        lines_split=used,
        audited=audited,
    )


def denormalise(child: DataFrame, parents: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left joins of a chain of parents (parent, child key, parent key); a missing parent is null.

    Dimension tables are broadcast when their files are below the session's limit.
    """
    for parent, key, parent_key in parents:
        child = child.join(parent, F.col(key) == F.col(parent_key), "left")
    return child


def enriched_products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """Products with the names of their aisle and department."""
    return (
        products.join(aisles, "aisle_id", "left")
        .join(departments, "department_id", "left")
        .select("product_id", "product_name", "aisle", "department")
    )


def split_orders(orders: DataFrame, value: str, column: str = "eval_set") -> DataFrame:
    return orders.filter(F.col(column) == value)
