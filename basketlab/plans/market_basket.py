"""The whole job: order lines to recommendations."""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.functions.labels import (
    MIN_BASKET_SIZE,
    MIN_CONFIDENCE,
    MIN_ITEM_FREQ,
    MIN_LIFT,
    TOP_PRODUCTS,
)
from basketlab.functions.measures import min_support_for
from basketlab.operators import baskets as B
from basketlab.operators import items as I
from basketlab.operators import mining as M
from basketlab.operators import quality as Q
from basketlab.operators import temporal as T
from basketlab.operators import trace as TR
from basketlab.plans.runs import RunRecorder
from basketlab.sinks import publish as P
from basketlab.sources.retail import Retail, split_orders
from basketlab.sources.tables import read_table
from basketlab.storage import materialize


@dataclass(frozen=True)
class Settings:
    """``min_support`` None derives it from the item threshold; ``split`` None keeps all orders.

    ``mining_partitions`` is the number of partitions that the projected baskets are
    dealt to; None derives it from the frequent items and the baskets.
    ``hold_out`` keeps the orders whose id it divides out of what is learnt; 10 leaves
    every tenth for the evaluation, repeatable by any engine.  ``dataset_name`` is what
    the summary calls the data.
    """

    min_item_freq: int | None = MIN_ITEM_FREQ
    min_support: float | None = None
    min_confidence: float = MIN_CONFIDENCE
    min_lift: float = MIN_LIFT
    min_basket_size: int = MIN_BASKET_SIZE
    split: str | None = "prior"
    mining_partitions: int | None = None
    hold_out: int | None = None
    dataset_name: str = "retail"


@dataclass(frozen=True)
class Model:
    """What mining leaves behind; baskets, itemsets and rules are written tables."""

    baskets: DataFrame
    n_baskets: int
    min_support: float
    itemsets: DataFrame
    rules: DataFrame
    popular: DataFrame


def in_scope(retail: Retail, settings: Settings) -> Retail:
    """The orders of the split and their lines.

    Lines that lie in a table of their own are taken whole, so the integrity report
    sees those without an order; the orders are then those of that table's split.  Otherwise the lines are written once, three columns
    wide, because every later step reads them and the semi join moves the whole table.
    """
    if settings.split is None:
        return retail
    split = retail.lines_split or settings.split
    orders = retail.orders_of(split) if retail.orders_of else split_orders(retail.orders, split)
    if retail.lines_split:
        return replace(retail, orders=orders)
    lines = retail.lines.join(orders.select("order_id"), "order_id", "left_semi")
    return replace(retail, orders=orders, lines=materialize(lines, "lines"))


def popular_items(retail: Retail, frequency: DataFrame | None = None) -> DataFrame:
    """Sales of all items, written once; every reader takes the first it needs."""
    counts = I.item_frequency(retail.lines) if frequency is None else frequency
    return materialize(I.item_sales(counts, retail.products), "popular")


def _fold(retail: Retail, hold_out: int, held: bool) -> Retail:
    """Orders and lines on one side of the hold-out; a null id is learnt from."""
    out = F.coalesce(F.col("order_id") % hold_out == 0, F.lit(False))
    side = out if held else ~out
    return replace(retail, orders=retail.orders.filter(side), lines=retail.lines.filter(side))


def held_out(retail: Retail, settings: Settings) -> DataFrame:
    """Baskets of the orders that ``train`` with these settings does not see."""
    if settings.hold_out is None:
        raise ValueError("the settings hold no orders out")
    scope = _fold(in_scope(retail, settings), settings.hold_out, True)
    return B.build_baskets(scope.lines, scope.products, settings.min_item_freq, settings.min_basket_size)


def train(retail: Retail, settings: Settings) -> Model:
    """Baskets, itemsets, strong rules and best sellers of the orders in scope, without those held out."""
    scope = in_scope(retail, settings)
    if settings.hold_out is not None:
        scope = _fold(scope, settings.hold_out, False)
    frequency = materialize(I.item_frequency(scope.lines), "item-frequency")
    catalog = B.core_catalog(scope.lines, scope.products, settings.min_item_freq, frequency)
    baskets = materialize(
        B.catalog_baskets(scope.lines, catalog, settings.min_basket_size), "baskets"
    )
    n = baskets.count()
    support = _support(settings, n)
    itemsets = M.mine(baskets, support, n, settings.mining_partitions)
    rules = materialize(
        M.association_rules(itemsets, n, settings.min_confidence).filter(
            F.col("lift") > settings.min_lift
        ),
        "rules",
    )
    return Model(baskets, n, support, itemsets, rules, popular_items(scope, frequency))


def _support(settings: Settings, n_baskets: int) -> float:
    if settings.min_support is not None:
        return settings.min_support
    if settings.min_item_freq is None:
        raise ValueError("without an item threshold the minimum support must be given")
    return min_support_for(settings.min_item_freq, max(n_baskets, 1))


def run_pipeline(
    spark: SparkSession, retail: Retail, settings: Settings, out_dir: str, run_id: str
) -> Model:
    """Check, profile, assemble, mine and publish; every result lies below ``out_dir``.

    Each step is timed on the action that writes its result; reading is the first step
    and the last row is the whole run.
    """
    recorder = RunRecorder(spark, run_id)
    started = time.perf_counter()
    with recorder.step("read", retail.lines.count()) as read:
        scope = in_scope(retail, settings)
        lines, orders, products = scope.lines, scope.orders, scope.products
        n_lines, n_orders = lines.count(), orders.count()
        read["rows_out"] = n_lines

    density = recorder.run(
        "temporal", n_orders, lambda: materialize(T.orders_per_dow_hour(orders), "density")
    )
    frequency = recorder.run(
        "item_frequency", n_lines, lambda: materialize(I.item_frequency(lines), "item-frequency")
    )
    popular = recorder.run("best_sellers", n_lines, lambda: popular_items(scope, frequency))
    best_sellers = I.top_items(popular, TOP_PRODUCTS)
    catalog = recorder.run(
        "core_catalog", n_lines, lambda: B.core_catalog(lines, products, settings.min_item_freq, frequency)
    )
    facts = recorder.run(
        "order_facts", n_lines, lambda: materialize(Q.order_facts(lines, catalog), "order-facts")
    )
    integrity = recorder.run(
        "integrity",
        n_lines,
        lambda: materialize(
            Q.integrity_report(lines, orders, products, facts, frequency), "integrity"
        ),
    )
    baskets = B.baskets_of(facts, settings.min_basket_size)
    n = baskets.count()
    support = _support(settings, n)
    itemsets = recorder.run("itemsets", n, lambda: M.mine(baskets, support, n, settings.mining_partitions))
    rules = recorder.run(
        "rules",
        itemsets.count(),
        lambda: materialize(
            M.association_rules(itemsets, n, settings.min_confidence).filter(
                F.col("lift") > settings.min_lift
            ),
            "rules",
        ),
    )
    profiles = recorder.run(
        "exclusion_audit",
        n_orders,
        lambda: materialize(
            B.order_profiles(facts, orders, settings.min_basket_size), "profiles"
        ),
    )

    with recorder.step("publish", n) as published:
        P.write_baskets(B.basket_documents(baskets, orders), f"{out_dir}/baskets")
        published["rows_out"] = read_table(spark, f"{out_dir}/baskets").count()
        P.write_itemsets(itemsets, f"{out_dir}/itemsets")
        totals = M.itemset_counts(itemsets).withColumn("min_support", F.lit(support))
        P.write_table(totals, f"{out_dir}/itemset_totals", "json")
        P.write_rules(rules, [f"{out_dir}/rules_prior", f"{out_dir}/rules"])
        P.write_postings(rules, "antecedent", f"{out_dir}/rule_postings")
        P.write_postings(itemsets, "items", f"{out_dir}/itemset_postings")
        scalars = integrity.select(
            F.lit(settings.dataset_name).alias("dataset_name"),
            F.lit(n_orders).cast("long").alias("total_orders"),
            F.lit(n).cast("long").alias("total_valid_baskets"),
            F.col("total_lines").alias("total_transactions"),
            rules.agg(F.count(F.lit(1))).scalar().alias("total_rules"),
            F.round(F.lit(support * 100), 3).alias("min_support_percent"),
            F.round(F.lit(settings.min_confidence * 100), 1).alias("min_confidence_percent"),
            F.lit(recorder.seconds("itemsets")).alias("training_time_seconds"),
        )
        hourly = density.groupBy("hour").agg(F.sum("orders_count").alias("orders_count"))
        P.write_copies(
            P.summary_document(scalars, best_sellers, hourly, density),
            [f"{out_dir}/summary_prior", f"{out_dir}/summary"],
            "json",
        )
        P.write_table(integrity, f"{out_dir}/integrity")
        P.write_table(
            quality_report(run_id, settings, scope, profiles, integrity),
            f"{out_dir}/quality",
            "json",
        )
    recorder.add("total", n_lines, rules.count(), time.perf_counter() - started)
    P.append_run(recorder.metrics(), f"{out_dir}/runs")
    return Model(baskets, n, support, itemsets, rules, popular)


def quality_report(
    run_id: str,
    settings: Settings,
    scope: Retail,
    profiles: DataFrame,
    integrity: DataFrame,
    samples: int = 10,
    traced: tuple[int, int] = (2, 12),
) -> DataFrame:
    """The data-quality document: parameters, key figures and the report sections.

    ``profiles`` and ``integrity`` should be written tables; several sections read them.
    ``samples`` baskets are shown and the orders of the range ``traced`` are explained.
    The audit covers every source table whole, the lines by their integrity report.
    """
    base = profiles.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("exclusion_group") == B.QUALIFIED).alias("valid_baskets"),
    )
    tables = Q.stack(
        [
            *[Q.audit_table(t.table, t.name, t.key, t.references) for t in scope.audited],
            Q.audit_from_integrity(
                integrity,
                f"order_products__{scope.lines_split}" if scope.lines_split else "order_products",
                len(scope.lines.columns),
            ),
        ]
    )
    qualified = profiles.filter(F.col("exclusion_group") == B.QUALIFIED).select(
        "order_id", F.size("core_items").alias("items_count"), F.col("core_items").alias("items")
    )
    return P.report_document(
        {
            "run_id": F.lit(run_id),
            "timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
            "parameters": F.struct(
                F.lit(settings.min_item_freq).cast("long").alias("min_item_freq"),
                F.lit(settings.min_basket_size).alias("min_basket_size"),
                F.lit(settings.split).cast("string").alias("eval_set"),
            ),
            "kpis": F.struct(
                F.col("valid_baskets"),
                (F.col("total_orders") - F.col("valid_baskets")).alias("excluded_baskets"),
                F.col("total_orders").alias("total_prior_orders"),
            ),
        },
        {
            "tables": (tables, ["table_name"]),
            "cleaning_stages": (B.before_after(profiles), ["metric"]),
            "excluded_orders_breakdown": (B.exclusion_breakdown(profiles), ["group_id"]),
            "sample_records": (B.sample_baskets(qualified, samples), ["order_id"]),
            "sample_traceability_orders": (TR.trace_orders(profiles, *traced), ["order_id"]),
        },
        base,
    )
