"""From order lines to baskets, and the account of what was left out.

Shuffles, in order: (order, product) to remove duplicates, then order to assemble.
The first one is what makes the second safe: after it an order has at most one row per
product, so even an order that holds a large share of all lines assembles from no more
rows than the catalog has products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketlab.functions.labels import (
    EXTRA_GROUP_NAMES,
    GROUP_NAMES,
    LOADER_DEFAULT_NAME,
    MIN_BASKET_SIZE,
)
from basketlab.functions.text import default_name, percent_text
from basketlab.operators.items import core_items, item_frequency
from basketlab.operators.quality import dedup_lines, order_facts
from basketlab.storage import materialize

GROUPS = ["G0", "G1", "G2", "G3", "G4"]
QUALIFIED = "qualified"


def core_catalog(
    lines: DataFrame,
    products: DataFrame,
    min_item_freq: int | None,
    frequency: DataFrame | None = None,
) -> DataFrame:
    """Core products: product_id, product_name.

    With a threshold the result is small (at most lines / threshold rows) and is
    written once, so the joins that use it know its real size: below the broadcast
    limit of the session it is broadcast, beyond it the join shuffles.  ``frequency``
    saves the counting pass when item counts are at hand.
    """
    names = products.select("product_id", "product_name")
    if min_item_freq is None:
        return names
    counts = item_frequency(lines) if frequency is None else frequency
    return materialize(
        core_items(counts, min_item_freq).join(names, "product_id").select(*names.columns),
        "core-catalog",
    )


def assemble(named_pairs: DataFrame, min_size: int = MIN_BASKET_SIZE) -> DataFrame:
    """Baskets from (order_id, item, add_to_cart_order): distinct items, sorted by name.

    ``first_item`` is the item that entered the cart first; the name decides ties.
    """
    return (
        named_pairs.groupBy("order_id")
        .agg(
            F.array_sort(F.collect_set("item")).alias("items"),
            F.min(F.struct("add_to_cart_order", "item"))["item"].alias("first_item"),
        )
        .filter(F.size("items") >= min_size)
        .select("order_id", F.size("items").alias("items_count"), "items", "first_item")
    )


def catalog_baskets(
    lines: DataFrame, catalog: DataFrame, min_size: int = MIN_BASKET_SIZE
) -> DataFrame:
    """Baskets of the catalog's products; lines of other products drop out before any shuffle.

    Names are attached after the duplicates are gone, so the wide shuffle carries ids.
    """
    core_lines = lines.join(catalog.select("product_id"), "product_id", "left_semi")
    named = dedup_lines(core_lines).join(catalog, "product_id")
    return assemble(
        named.select("order_id", F.col("product_name").alias("item"), "add_to_cart_order"), min_size
    )


def build_baskets(
    lines: DataFrame,
    products: DataFrame,
    min_item_freq: int | None = None,
    min_size: int = MIN_BASKET_SIZE,
) -> DataFrame:
    """Qualified baskets: core products only, at least ``min_size`` distinct items.

    Frequency counts raw lines; baskets hold distinct names.
    """
    return catalog_baskets(lines, core_catalog(lines, products, min_item_freq), min_size)


def build_unpruned_baskets(
    lines: DataFrame, orders: DataFrame, products: DataFrame, min_size: int = MIN_BASKET_SIZE
) -> DataFrame:
    """Loader variant: all products, default names, metadata null when the order is unknown."""
    names = products.select("product_id", "product_name")
    named = dedup_lines(lines).join(names, "product_id", "left").select(
        "order_id",
        default_name(F.col("product_name"), F.col("product_id"), LOADER_DEFAULT_NAME).alias("item"),
        "add_to_cart_order",
    )
    return basket_documents(assemble(named, min_size), orders, "left")


def basket_documents(baskets: DataFrame, orders: DataFrame, how: str = "inner") -> DataFrame:
    """Baskets with the metadata of their order."""
    meta = orders.select("order_id", "user_id", "order_dow", "order_hour_of_day")
    return baskets.join(meta, "order_id", how).select(
        "order_id", "user_id", "order_dow", "order_hour_of_day", "items_count", "items"
    )


def sample_baskets(baskets: DataFrame, n: int = 10, first: int = 6) -> DataFrame:
    """The first ``n`` baskets by order with their size and first few items."""
    return (
        baskets.orderBy("order_id")
        .limit(n)
        .select(
            "order_id",
            F.col("items_count").alias("raw_items_count"),
            F.slice("items", 1, first).alias("cleaned_items"),
        )
    )


def orders_with_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders that have at least one line; line ids are made distinct before they move."""
    return orders.join(lines.select("order_id").distinct(), "order_id", "left_semi")


def first_orders(orders: DataFrame, lines: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` orders with lines, by id, and the lines of exactly these orders."""
    chosen = orders_with_lines(orders, lines).orderBy("order_id").limit(n)
    return chosen, lines.join(chosen.select("order_id"), "order_id", "left_semi")


def basket_by_key(baskets: DataFrame, order_id: int) -> DataFrame:
    return baskets.filter(F.col("order_id") == order_id)


def baskets_by_size(baskets: DataFrame, items_count: int) -> DataFrame:
    return baskets.filter(F.col("items_count") == items_count)


def baskets_of(facts: DataFrame, min_size: int = MIN_BASKET_SIZE) -> DataFrame:
    """The baskets in a table of order facts, as ``catalog_baskets`` builds them from the lines."""
    return facts.filter(F.size("core_items") >= min_size).select(
        "order_id", F.size("core_items").alias("items_count"), F.col("core_items").alias("items"), "first_item"
    )


def order_profiles(
    facts: DataFrame, orders: DataFrame, min_size: int = MIN_BASKET_SIZE
) -> DataFrame:
    """One row per order with everything the exclusion audit needs.

    ``facts`` come from ``order_facts`` with the core catalog.  raw_lines counts lines,
    c_raw and c_core distinct products, core_items holds the distinct core names,
    exclusion_group says why an order is no basket: G0 no lines, G1 one product, G2 no
    core product, G3 one core product, G4 core products that share too few names.
    """
    zero = F.lit(0).cast("long")
    return (
        orders.select("order_id")
        .join(facts, "order_id", "left")
        .select(
            "order_id",
            F.coalesce("raw_lines", zero).alias("raw_lines"),
            F.coalesce("c_raw", zero).alias("c_raw"),
            F.coalesce("c_core", zero).alias("c_core"),
            F.coalesce("core_items", F.array().cast("array<string>")).alias("core_items"),
        )
        .withColumn("exclusion_group", exclusion_group(min_size))
    )


def audit_profiles(
    lines: DataFrame, orders: DataFrame, catalog: DataFrame, min_size: int = MIN_BASKET_SIZE
) -> DataFrame:
    """Profiles straight from the lines, which are read and shuffled by pair once."""
    return order_profiles(order_facts(lines, catalog), orders, min_size)


def exclusion_group(min_size: int) -> Column:
    """First matching reason; the groups exclude one another and cover every order."""
    return (
        F.when(F.size("core_items") >= min_size, F.lit(QUALIFIED))
        .when(F.col("c_raw") == 0, F.lit("G0"))
        .when(F.col("c_raw") == 1, F.lit("G1"))
        .when(F.col("c_core") == 0, F.lit("G2"))
        .when(F.col("c_core") == 1, F.lit("G3"))
        .otherwise(F.lit("G4"))
    )


def exclusion_breakdown(profiles: DataFrame) -> DataFrame:
    """Orders per exclusion group with shares of the excluded and of all orders.

    Counted in one aggregate; every group has a row, also with count 0.
    """
    names = {**EXTRA_GROUP_NAMES, **GROUP_NAMES}
    totals = profiles.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("exclusion_group") != QUALIFIED).alias("excluded"),
        *[F.count_if(F.col("exclusion_group") == g).alias(g) for g in GROUPS],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(g).alias("group_id"),
                F.lit(names[g]).alias("group_name"),
                F.col(g).alias("orders_count"),
            )
            for g in GROUPS
        ]
    )
    return totals.select("total", "excluded", F.explode(rows).alias("g")).select(
        "g.*",
        percent_text(F.col("g.orders_count"), F.col("excluded")).alias("percentage"),
        percent_text(F.col("g.orders_count"), F.col("total")).alias("percentage_total"),
    )


def before_after(profiles: DataFrame) -> DataFrame:
    """Orders and lines before and after cleaning.

    Removed lines are split into duplicates and lines of rare products, which the
    single removed figure would mix.
    """
    totals = profiles.agg(
        F.count(F.lit(1)).alias("orders_before"),
        F.count_if(F.col("exclusion_group") == QUALIFIED).alias("orders_after"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
            for c in ("raw_lines", "c_raw", "c_core")
        ],
    )
    nothing = F.lit(0).cast("long")

    def row(metric: str, before: Column, after: Column, dups: Column, rare: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            before.alias("before_cleaning"),
            after.alias("after_cleaning"),
            (before - after).alias("removed_records"),
            percent_text(before - after, before).alias("removed_rate"),
            dups.alias("removed_duplicates"),
            rare.alias("removed_rare"),
        )

    lines, raw, core = F.col("raw_lines"), F.col("c_raw"), F.col("c_core")
    rows = F.array(
        row("orders", F.col("orders_before"), F.col("orders_after"), nothing, nothing),
        row("transactions", lines, core, lines - raw, raw - core),
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")

