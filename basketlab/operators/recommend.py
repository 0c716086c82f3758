"""Recommendations: which rules a cart fires, the best of them, and the fallback."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlab.functions.labels import (
    DEFAULT_SELECTOR_ITEMS,
    FALLBACK_ITEMS,
    FALLBACK_LABEL,
    RECOMMENDATIONS,
    TOP_PRODUCTS,
)
from basketlab.functions.text import rule_label
from basketlab.operators.mining import rule_order
from basketlab.operators.order import numbered
from basketlab.storage import bucketed, materialize

RULE_SOURCE = "rule"
POPULAR_SOURCE = "popular"


@dataclass(frozen=True)
class Offers:
    """Offers keyed for matching: key, second, rest, item_number and what the caller shows.

    ``longest`` is the number of items in the longest antecedent.
    """

    table: DataFrame
    longest: int


@dataclass(frozen=True)
class Serving:
    """What matching and fallback need of a rule table and the sales; written tables, built once.

    ``numbers`` (item, number) has the items of the rules, the rarest first, ``details``
    the texts and measures by rule rank, ``places`` (item, place) all best sellers from
    place 1 on, None without sales.
    """

    numbers: DataFrame
    offers: Offers
    details: DataFrame
    places: DataFrame | None


def number_items(rules: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Items on either side of a rule with ``number``, the smaller the rarer; a written table.

    Rarity is what the items sold (item, total_sales) in the baskets the rules come
    from; without sales it is the number of antecedents that name the item.
    """
    sides = rules.select(F.explode("antecedent").alias("item"), F.lit(1).alias("named")).unionByName(
        rules.select(F.explode("consequent").alias("item"), F.lit(0).alias("named"))
    )
    counted = sides.groupBy("item").agg(F.sum("named").alias("named"))
    if sales is not None:
        counted = counted.join(sales, "item", "left").select("item", F.coalesce("total_sales", F.lit(0)).alias("named"))
    ordered = counted.orderBy("named", "item").select("item")
    return materialize(ordered.withColumn("number", F.monotonically_increasing_id()), "item-numbers")


def keyed_offers(offers: DataFrame, numbers: DataFrame, buckets: int | None = None) -> Offers:
    """Offers (antecedent, item, ...) with their antecedents as numbers in ascending order.

    ``key`` is the rarest item, ``second`` the next one (the key again if there is none)
    and ``rest`` holds the others.  With ``buckets`` the table is bucketed by the key, so
    a join that is too large to broadcast moves the carts only.  An offer with an empty
    antecedent is an error.
    """
    checked = F.when(F.size("antecedent") > 0, F.array_distinct("antecedent")).otherwise(
        F.raise_error(F.lit("a rule has an empty antecedent")).cast("array<string>")
    )
    named = offers.select("antecedent").distinct().select("antecedent", F.explode(checked).alias("item"))
    needs = named.join(numbers, "item").groupBy("antecedent").agg(F.sort_array(F.collect_list("number")).alias("needs"))
    own = numbers.withColumnRenamed("number", "item_number")
    table = offers.join(needs, "antecedent").join(own, "item").select(
        F.get("needs", F.lit(0)).alias("key"),
        F.coalesce(F.get("needs", F.lit(1)), F.get("needs", F.lit(0))).alias("second"),
        F.slice("needs", 3, F.greatest(F.size("needs") - 2, F.lit(0))).alias("rest"),
        "item_number",
        *[c for c in offers.columns if c != "antecedent"],
        F.size("needs").alias("_size"),
    )
    table = materialize(table, "offers") if buckets is None else bucketed(table, "key", buckets, "offers")
    longest = table.agg(F.coalesce(F.max("_size"), F.lit(0))).first()[0]
    return Offers(table.drop("_size"), longest)


def prepare(rules: DataFrame, sales: DataFrame | None = None, buckets: int | None = None) -> Serving:
    """Number, key and rank the rules once for all carts that will be served."""
    ranked = rank_rules(rules)
    numbers = number_items(ranked, sales)
    offers = keyed_offers(ranked_offers(ranked), numbers, buckets)
    return Serving(numbers, offers, rule_details(ranked), None if sales is None else sale_places(sales))


def match_rules(carts: DataFrame, rules: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Every rule a cart fires: its antecedent is part of the cart, its consequent is not."""
    listed = materialize(rules.withColumn("rule_id", F.monotonically_increasing_id()), "listed-rules")
    numbers = number_items(listed, sales)
    offers = keyed_offers(listed.select("rule_id", "antecedent", F.explode("consequent").alias("item")), numbers)
    hits = fired(carts, offers, numbers).select("cart_id", "item", "rule_id")
    return hits.join(listed, "rule_id").select("cart_id", "item", *rules.columns)


def cart_items(carts: DataFrame, numbers: DataFrame) -> DataFrame:
    """(cart_id, number, n_items): the items of a cart that any rule names, one row each."""
    held = carts.select(
        "cart_id", F.explode(F.array_distinct("items")).alias("item"), F.size("items").alias("n_items")
    )
    return held.join(numbers, "item").select("cart_id", "number", "n_items")


def fired(carts: DataFrame, offers: Offers, numbers: DataFrame, top_n: int | None = None) -> DataFrame:
    """(cart_id, ...) for each offer a cart fires, with the columns of the offer.

    A prefix filter on the two rarest items: a cart probes with each of its items, one
    pair of numbers a row, and meets the offers whose rarest item it holds.  What is met
    must then have its second rarest item among the rows of the same cart, then its
    others, and its own item must not be there.  All of this is decided by joins on
    (cart, number); a cart never travels as a whole, so what is shuffled is in proportion
    to its items and to the offers it meets, whatever its size.

    With ``top_n`` offers of one antecedent are left out beyond that place plus the size
    of the cart: so many better ones of the same antecedent fire with them, and the cart
    rules out at most as many as it has items.
    """
    held = cart_items(carts, numbers)
    met = held.join(offers.table, F.col("number") == F.col("key")).drop("number")
    if top_n is not None:
        met = met.filter(F.col("place") <= F.lit(top_n) + F.col("n_items"))
    mine = held.select(F.col("cart_id").alias("_cart"), F.col("number").alias("_number"))

    def among_own(number: str) -> Column:
        return (F.col("cart_id") == F.col("_cart")) & (F.col(number) == F.col("_number"))

    if offers.longest > 1:
        met = met.join(mine, among_own("second"), "left_semi")
    if offers.longest > 2:
        # short offers ask for their key once more, which is there
        others = F.when(F.size("rest") > 0, F.col("rest")).otherwise(F.array("key"))
        asked = met.withColumn("_asked", F.size(others)).withColumn("_other", F.explode(others))
        same = [c for c in met.columns if c != "rest"]
        met = (
            asked.join(mine, among_own("_other"), "left_semi")
            .groupBy(*same, "_asked")
            .agg(F.count(F.lit(1)).alias("_found"))
            .filter(F.col("_found") == F.col("_asked"))
        )
    return met.join(mine, among_own("item_number"), "left_anti")


def rank_rules(rules: DataFrame) -> DataFrame:
    """Rules with ``rule_rank``, a number that follows the rule order; a written table.

    The sort is range-partitioned and the number grows with the partition, so no task
    sees all rules.  Written, because a second evaluation could cut the ranges anew.
    """
    if "rule_rank" in rules.columns:
        return rules
    ordered = rules.orderBy(*rule_order())
    return materialize(ordered.withColumn("rule_rank", F.monotonically_increasing_id()), "ranked-rules")


def ranked_offers(ranked: DataFrame) -> DataFrame:
    """Per antecedent and item the best rule, and its ``place`` among the antecedent's items."""
    place = W.partitionBy("antecedent").orderBy("rule_rank", "item")
    return (
        ranked.select("antecedent", F.explode("consequent").alias("item"), "rule_rank")
        .groupBy("antecedent", "item")
        .agg(F.min("rule_rank").alias("rule_rank"))
        .withColumn("place", F.row_number().over(place))
    )


def best_picks(carts: DataFrame, serving: Serving, top_n: int) -> DataFrame:
    """Per cart the ``top_n`` items by their best rule: cart_id, rank, item, rule_rank.

    A cart has at most one match per rule, so its group is bounded by the rule table.
    """
    place = W.partitionBy("cart_id").orderBy("rule_rank", "item")
    return (
        fired(carts, serving.offers, serving.numbers, top_n)
        .groupBy("cart_id", "item")
        .agg(F.min("rule_rank").alias("rule_rank"))
        .withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= top_n)
        .select("cart_id", "rank", "item", "rule_rank")
    )


def rule_details(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "rule_rank",
        rule_label(F.col("antecedent"), F.col("consequent")).alias("rule"),
        "confidence",
        "lift",
        "support",
    )


def recommend(
    carts: DataFrame, rules: DataFrame, top_n: int = RECOMMENDATIONS, serving: Serving | None = None
) -> DataFrame:
    """Up to ``top_n`` items per cart by lift, each with the rule that explains it."""
    served = prepare(rules) if serving is None else serving
    return best_picks(carts, served, top_n).join(served.details, "rule_rank").select(
        "cart_id",
        "rank",
        "item",
        F.lit(RULE_SOURCE).alias("source"),
        "rule",
        "confidence",
        "lift",
        "support",
    )


def popular_list(popular: DataFrame, reach: int) -> Column:
    """The ``reach`` best sellers of the sales table (item, total_sales) as one sorted array of names.

    A scalar subquery: computed once and handed to every task as a constant.  For a
    number the caller fixes; carts of any size are served by ``free_places``.
    """
    popular = popular.orderBy(F.desc("total_sales"), "item").limit(reach)
    ranked = F.array_sort(
        F.collect_list(F.struct((-F.col("total_sales")).alias("order"), F.col("item").alias("item")))
    )
    return popular.agg(F.transform(ranked, lambda p: p["item"])).scalar()


def not_in(items: Column, cart: Column) -> Column:
    """The items that the cart does not hold, in their order."""
    return F.array_except(items, cart)


def free_places(carts: DataFrame, places: DataFrame, n: int) -> DataFrame:
    """(cart_id, free): the first ``n`` places of the best sellers that each cart leaves free.

    The items of a cart are looked up, not the list: of the first n + k places a cart
    with k of them among its items leaves n free.  So a cart costs as much as its items,
    and no cart costs more because another one is large.
    """
    held = carts.select(
        "cart_id", F.explode(F.array_distinct("items")).alias("item"), F.size("items").alias("n_items")
    )
    reach = F.col("place") <= F.lit(n) + F.col("n_items")
    taken = held.join(places, "item", "left").groupBy("cart_id").agg(F.collect_list(F.when(reach, F.col("place"))).alias("taken"))
    first = F.sequence(F.lit(1).cast("long"), F.size("taken").cast("long") + n)
    return taken.select("cart_id", F.slice(F.array_except(first, "taken"), 1, n).alias("free"))


def popular_for(carts: DataFrame, places: DataFrame, n: int) -> DataFrame:
    """Per cart that holds something the ``n`` most popular items it does not hold: cart_id, rank, item."""
    return (
        free_places(carts, places, n)
        .select("cart_id", F.posexplode("free").alias("pos", "place"))
        .join(places, "place")
        .select("cart_id", (F.col("pos") + 1).alias("rank"), "item")
    )


def sale_places(popular: DataFrame) -> DataFrame:
    """(item, place): the items by sales (item, total_sales), place 1 first; a written table."""
    best_first = [F.desc("total_sales"), "item"]
    placed = numbered(popular.select("item", "total_sales"), best_first, "place", "sorted-sales")
    return materialize(placed.select("item", "place"), "places")


def fallback(
    carts: DataFrame, served: DataFrame, popular: DataFrame, n: int = FALLBACK_ITEMS
) -> DataFrame:
    """Popular items for carts that hold something but got no recommendation."""
    unserved = carts.filter(F.size("items") > 0).join(
        served.select("cart_id").distinct(), "cart_id", "left_anti"
    )
    nothing = F.lit(None).cast("double")
    return popular_for(unserved, sale_places(popular), n).select(
        "cart_id",
        "rank",
        "item",
        F.lit(POPULAR_SOURCE).alias("source"),
        F.lit(FALLBACK_LABEL).alias("rule"),
        nothing.alias("confidence"),
        nothing.alias("lift"),
        nothing.alias("support"),
    )


def recommend_with_fallback(
    carts: DataFrame,
    rules: DataFrame,
    popular: DataFrame,
    top_n: int = RECOMMENDATIONS,
    fallback_n: int = FALLBACK_ITEMS,
    serving: Serving | None = None,
) -> DataFrame:
    """Rule recommendations, and the labelled popular items where no rule fires.

    An empty cart gets nothing.  The picks of a cart are packed (at most ``top_n``) and
    meet the free places of all carts, which also shows the carts left without any pick.
    Names and rule texts are joined last, to the rows shown.  ``serving`` saves the
    preparation when many batches of carts meet the same rules and sales.
    """
    ready = prepare(rules, popular) if serving is None else serving
    if ready.places is None:
        raise ValueError("the fallback needs the sales; prepare the rules with them")
    packed = (
        best_picks(carts, ready, top_n)
        .groupBy("cart_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "item", "rule_rank"))).alias("picks"))
    )
    slot = "array<struct<item: string, rule_rank: long, place: long>>"
    by_rule = F.transform("picks", lambda p: F.struct(p["item"], p["rule_rank"], F.lit(None))).cast(slot)
    by_sales = F.transform("free", lambda p: F.struct(F.lit(None), F.lit(None), p)).cast(slot)
    shown = (
        free_places(carts, ready.places, fallback_n)
        .join(packed, "cart_id", "left")
        .select("cart_id", F.posexplode(F.coalesce(by_rule, by_sales)).alias("pos", "slot"))
        .select("cart_id", (F.col("pos") + 1).alias("rank"), "slot.*")
    )
    by_rank = F.col("place").isNull()
    return (
        shown.join(ready.details, "rule_rank", "left")
        .join(ready.places.withColumnRenamed("item", "sold"), "place", "left")
        .filter(by_rank | F.col("sold").isNotNull())
        .select(
            "cart_id",
            "rank",
            F.coalesce("item", "sold").alias("item"),
            F.when(by_rank, F.lit(RULE_SOURCE)).otherwise(F.lit(POPULAR_SOURCE)).alias("source"),
            F.when(by_rank, F.col("rule")).otherwise(F.lit(FALLBACK_LABEL)).alias("rule"),
            "confidence",
            "lift",
            "support",
        )
    )


def item_selector(
    rules: DataFrame, popular: DataFrame, long_tail: Sequence[str] = (), best_sellers: int = TOP_PRODUCTS
) -> DataFrame:
    """Items a shopper can pick: rule antecedents, the ``best_sellers`` first items by sales and
    whatever else the caller names, sorted.

    A fixed list takes over when all three are empty.
    """
    spark = rules.sparkSession
    parts = rules.select(F.explode("antecedent").alias("item")).union(
        popular.orderBy(F.desc("total_sales"), "item").limit(best_sellers).select("item")
    )
    if long_tail:
        parts = parts.union(spark.createDataFrame([(i,) for i in long_tail], "item string"))
        return parts.distinct().orderBy("item")
    defaults = spark.createDataFrame([(i,) for i in DEFAULT_SELECTOR_ITEMS], "item string")
    empty = ~parts.exists()
    return parts.distinct().union(defaults.filter(empty)).orderBy("item")


def known_items(carts: DataFrame, selector: DataFrame) -> DataFrame:
    """Carts restricted to items of the selector, order kept; a cart may become empty."""
    picked = carts.select("cart_id", F.posexplode_outer("items").alias("pos", "item"))
    known = selector.select("item", F.lit(True).alias("known"))
    return (
        picked.join(known, "item", "left")
        .groupBy("cart_id")
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("known"), F.struct("pos", "item")))
            ).alias("kept")
        )
        .select("cart_id", F.transform("kept", lambda k: k["item"]).alias("items"))
    )
