"""Offline evaluation: show the first item of a basket, ask for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlab.functions.labels import EVALUATION_KS, EVALUATION_SAMPLE
from basketlab.operators.mining import rule_order
from basketlab.operators.recommend import not_in, popular_list


def evaluation_sample(baskets: DataFrame, n: int = EVALUATION_SAMPLE) -> DataFrame:
    """A repeatable sample of ``n`` baskets: order ids by multiplicative hash.

    The product needs more than 64 bits, so it is taken in decimals.
    """
    key = F.col("order_id").cast("decimal(20,0)") * F.lit(2654435761).cast("decimal(10,0)") % F.lit(4294967296).cast("decimal(10,0)")
    return baskets.orderBy(key, "order_id").limit(n)


def split_baskets(baskets: DataFrame) -> DataFrame:
    """Observed item and hidden rest of every basket with at least two items."""
    return baskets.filter(F.size("items") >= 2).select(
        "order_id",
        F.col("first_item").alias("observed"),
        F.array_remove("items", F.col("first_item")).alias("truth"),
    )


def ranked_consequents(rules: DataFrame, n: int) -> DataFrame:
    """Per item the first ``n`` distinct consequents of the rules it fires alone.

    With one item observed only rules whose antecedent is that item fire.  The list
    depends on the item, not on the basket, so it is built once per item; a consequent
    stands where its best rule stands.
    """
    single = rules.filter(F.size("antecedent") == 1).select(
        F.element_at("antecedent", 1).alias("observed"),
        F.explode("consequent").alias("item"),
        "antecedent",
        "consequent",
        "confidence",
        "lift",
    )
    first = W.partitionBy("observed", "item").orderBy(*rule_order())
    place = W.partitionBy("observed").orderBy(*rule_order(), "item")
    return (
        single.filter(F.col("item") != F.col("observed"))
        .repartition("observed")
        .withColumn("n", F.row_number().over(first))
        .filter(F.col("n") == 1)
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= n)
        .groupBy("observed")
        .agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("ranked"))
        .select("observed", F.transform("ranked", lambda r: r["item"]).alias("by_rules"))
    )


def recommendation_lists(
    observed: DataFrame, rules: DataFrame, popular: DataFrame, max_k: int
) -> DataFrame:
    """Adds ``fp_list`` (rules, padded with popular items) and ``base_list`` (popular only).

    One item is observed, so ``max_k`` + 1 best sellers always leave ``max_k``.
    """
    popular_items = popular_list(popular, max_k + 1)
    ranked = ranked_consequents(rules, max_k)
    own = F.array("observed")
    no_items = F.array().cast("array<string>")
    return (
        observed.join(ranked, "observed", "left")
        .withColumn("by_rules", F.coalesce("by_rules", no_items))
        .withColumn("base_list", F.slice(not_in(popular_items, own), 1, max_k))
        .withColumn(
            "fp_list",
            F.slice(F.concat("by_rules", not_in(F.col("base_list"), F.col("by_rules"))), 1, max_k),
        )
        .drop("by_rules")
    )


def evaluate(
    baskets: DataFrame,
    rules: DataFrame,
    popular: DataFrame,
    catalog_size: Column,
    ks: Sequence[int] = EVALUATION_KS,
) -> DataFrame:
    """Precision, recall, hit rate and coverage at every K, rules against popular items.

    Precision divides by K even when fewer items are recommended.  All K are measured
    in one pass over the baskets; coverage looks at the distinct observed items only,
    because the lists depend on nothing else.
    """
    cases = recommendation_lists(split_baskets(baskets), rules, popular, max(ks))
    measures = [F.count(F.lit(1)).alias("valid")]
    for k in ks:
        for side in ("fp", "base"):
            shown = F.slice(f"{side}_list", 1, k)
            hits = F.size(F.array_intersect(shown, F.col("truth")))
            measures += [
                F.avg(hits / F.lit(k)).alias(f"{side}_precision_{k}"),
                F.avg(hits / F.size("truth")).alias(f"{side}_recall_{k}"),
                F.avg((hits > 0).cast("double")).alias(f"{side}_hit_rate_{k}"),
            ]
    quality = cases.agg(*measures)
    reach = coverage(baskets, rules, popular, ks)
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                *[
                    F.col(f"{side}_{measure}_{k}").alias(f"{name}_{measure}")
                    for name, side in (("rules", "fp"), ("popular", "base"))
                    for measure in ("precision", "recall", "hit_rate")
                ],
            )
            for k in ks
        ]
    )
    flat = quality.select(F.explode(rows).alias("r")).select("r.*")
    size = F.when(catalog_size > 0, catalog_size)
    return flat.join(reach, "k").select(
        "k",
        *[
            F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c)
            for c in flat.columns
            if c != "k"
        ],
        F.round(F.coalesce(F.col("rules_items") / size, F.lit(0.0)), 6).alias("rules_coverage"),
        F.round(F.coalesce(F.col("popular_items") / size, F.lit(0.0)), 6).alias("popular_coverage"),
    )


def coverage(
    baskets: DataFrame, rules: DataFrame, popular: DataFrame, ks: Sequence[int] = EVALUATION_KS
) -> DataFrame:
    """Distinct recommended items per K for rules and for the popular list."""
    observed = split_baskets(baskets).select("observed").distinct()
    lists = recommendation_lists(observed, rules, popular, max(ks))
    best_place = (
        lists.select(
            F.explode(
                F.concat(
                    _placed("fp_list", "rules"),
                    _placed("base_list", "popular"),
                )
            ).alias("p")
        )
        .groupBy("p.side", "p.item")
        .agg(F.min("p.place").alias("place"))
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                F.col(f"rules_{k}").alias("rules_items"),
                F.col(f"popular_{k}").alias("popular_items"),
            )
            for k in ks
        ]
    )
    counts = best_place.agg(
        *[
            F.count_if((F.col("side") == side) & (F.col("place") <= k)).alias(f"{side}_{k}")
            for side in ("rules", "popular")
            for k in ks
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def _placed(column: str, side: str) -> Column:
    return F.transform(
        F.col(column),
        lambda item, i: F.struct(
            F.lit(side).alias("side"), item.alias("item"), (i + 1).alias("place")
        ),
    )


def evaluation_header(baskets: DataFrame) -> DataFrame:
    """Baskets looked at, evaluated, and skipped because they hold a single item."""
    return baskets.agg(
        F.count(F.lit(1)).alias("baskets_queried"),
        F.count_if(F.size("items") >= 2).alias("baskets_evaluated"),
        F.count_if(F.size("items") < 2).alias("baskets_skipped"),
    )
