"""Frequent itemsets, association rules and the parameter sweep.

Itemsets are mined once, from projected baskets, and written; rules, statistics and
every sweep configuration derive from that table by joins.  Item arrays are
sorted, so an array is a join key and set equality is plain equality.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlab.functions.labels import MIN_LIFT, SWEEP_CONFIGS
from basketlab.functions.measures import min_count
from basketlab.functions.text import itemset_label, mentions, rule_label, same_items
from basketlab.operators.order import numbered
from basketlab.storage import materialize


# a partition holds the baskets of so many items, and so many baskets
ITEMS_A_GROUP = 64
BASKETS_A_GROUP = 20_000
BASKETS_A_PARTITION = 500_000


def item_groups(n_items: int, n_baskets: int) -> int:
    """Groups that items or baskets ask for, whatever the cores; one item each at least."""
    wanted = max(-(-n_items // ITEMS_A_GROUP), -(-n_baskets // BASKETS_A_GROUP))
    return max(1, min(n_items, wanted))


def _frequent(found: DataFrame, at_least: int, label: str) -> DataFrame:
    """(prefix, number, frequency): the extensions of every prefix that reach the count; a written table."""
    counts = found.groupBy("prefix", "number").agg(F.sum("weight").alias("frequency"))
    return materialize(counts.filter(F.col("frequency") >= at_least), label)


def _numbered_baskets(baskets: DataFrame, numbers: DataFrame) -> DataFrame:
    """(tail, weight): the frequent items of each basket as ascending numbers, equal ones counted once.

    Baskets of one frequent item are left out; items travel one a row, as numbers.
    """
    unique = F.when(F.size(F.array_distinct("items")) == F.size("items"), F.col("items")).otherwise(
        F.raise_error(F.lit("items in a basket must be unique")).cast(baskets.schema["items"].dataType)
    )
    held = baskets.select(F.monotonically_increasing_id().alias("basket"), unique.alias("items"))
    held = held.select("basket", F.explode("items").alias("held"))
    return (
        held.join(numbers, F.col("held").eqNullSafe(F.col("item")))
        .groupBy("basket")
        .agg(F.sort_array(F.collect_list("number")).alias("tail"))
        .filter(F.size("tail") >= 2)
        .groupBy("tail")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def mine(
    baskets: DataFrame,
    min_support: float,
    n_baskets: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """All itemsets with frequency >= ceil(min_support * N): items, k, frequency, support.

    ``baskets`` should be a written table; an item that a basket names twice is an error.
    Itemsets grow item by item, as in FP-Growth, from projected baskets: for a frequent
    prefix the items that follow it in a basket.  They are plain rows (prefix, tail,
    weight), so no task holds a tree or all baskets of an item.  Equal rows travel as one
    with their number, and a tail keeps only the items that are frequent after its
    prefix.  A round counts by (prefix, item) with partial sums on the map side; its work
    is in proportion to the baskets.  The rows are dealt to ``num_partitions``
    partitions, by default as many as items and baskets ask for.
    """
    spark = baskets.sparkSession
    n = baskets.count() if n_baskets is None else n_baskets
    if n == 0 or min_support > 1:
        empty = "items array<string>, k int, frequency long, support double"
        return spark.createDataFrame([], empty)
    least = min_count(min_support, n)
    held = baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("frequency"))
    # the rarest first: few baskets hold the prefixes that have many items to follow
    numbers = numbered(held.filter(F.col("frequency") >= least), ["frequency", "item"], "number", "frequent-items")
    numbers = materialize(numbers.withColumn("number", F.col("number").cast("int")), "item-numbers")
    n_items = numbers.count()
    partitions = num_partitions or max(item_groups(n_items, n), n // BASKETS_A_PARTITION)

    none = F.array().cast("array<int>")
    levels = [numbers.select(none.alias("prefix"), "number", "frequency")]
    rows = _numbered_baskets(baskets, numbers.select("item", "number")).withColumn("prefix", none)
    rows = materialize(rows.repartition(partitions, "prefix", "tail"), "projected")
    while True:
        projected = (
            rows.select("prefix", "tail", "weight", F.posexplode("tail").alias("pos", "number"))
            .filter(F.col("pos") + 1 < F.size("tail"))
            .select(
                F.concat("prefix", F.array("number")).alias("prefix"),
                F.slice("tail", F.col("pos") + 2, F.size("tail")).alias("tail"),
                "weight",
            )
        )
        grown = _frequent(projected.select("prefix", F.explode("tail").alias("number"), "weight"), least, "grown")
        if grown.isEmpty():
            break
        levels.append(grown)
        followers = grown.groupBy("prefix").agg(F.collect_list("number").alias("followers"))
        rows = (
            projected.filter(F.size("tail") >= 2)
            .join(followers, "prefix")
            .select("prefix", F.array_intersect("tail", "followers").alias("tail"), "weight")
            .filter(F.size("tail") >= 2)
            .groupBy("prefix", "tail")
            .agg(F.sum("weight").alias("weight"))
        )
        rows = materialize(rows.repartition(partitions, "prefix", "tail"), "projected")
    return _itemsets(levels, numbers, n)


def _itemsets(levels: Sequence[DataFrame], numbers: DataFrame, n: int) -> DataFrame:
    """The itemsets of all levels with the names of their items; a written table."""
    found = reduce(DataFrame.unionByName, levels)
    sets = found.select(F.concat("prefix", F.array("number")).alias("numbers"), "frequency")
    # in structs, since a null is an item here and collect_list drops nulls
    named = (
        sets.select("numbers", "frequency", F.explode("numbers").alias("number"))
        .join(numbers.select("number", "item"), "number")
        .groupBy("numbers", "frequency")
        .agg(F.collect_list(F.struct("item")).alias("named"))
    )
    itemsets = named.select(
        F.array_sort(F.transform("named", lambda s: s["item"])).alias("items"),
        F.size("numbers").alias("k"),
        "frequency",
        (F.col("frequency") / F.lit(float(n))).alias("support"),
    )
    return materialize(itemsets, "itemsets")


RULE_COLUMNS = ["antecedent", "consequent", "confidence", "lift", "support"]


def association_rules(itemsets: DataFrame, n_baskets: int, min_confidence: float) -> DataFrame:
    """Rules with one consequent item: antecedent, consequent, confidence, lift, support."""
    return counted_rules(itemsets, n_baskets, min_confidence).select(*RULE_COLUMNS)


def counted_rules(itemsets: DataFrame, n_baskets: int, min_confidence: float) -> DataFrame:
    """Rules with ``frequency``, the number of baskets that hold both sides.

    Every item of a larger itemset takes a turn as consequent.  The remaining items are
    a frequent itemset themselves, so both frequencies come from equi-joins with the
    itemset table.
    """
    whole = itemsets.filter(F.col("k") >= 2).select(
        "items", F.col("frequency").alias("f_union"), F.explode("items").alias("item")
    )
    candidates = whole.select(
        F.array_remove("items", F.col("item")).alias("antecedent"), "item", "f_union"
    )
    antecedents = itemsets.select(
        F.col("items").alias("antecedent"), F.col("frequency").alias("f_antecedent")
    )
    singles = itemsets.filter(F.col("k") == 1).select(
        F.element_at("items", 1).alias("item"), F.col("frequency").alias("f_consequent")
    )
    n = F.lit(float(n_baskets))
    return (
        candidates.join(antecedents, "antecedent")
        .withColumn("confidence", F.col("f_union") / F.col("f_antecedent"))
        .filter(F.col("confidence") >= min_confidence)
        .join(singles, "item")
        .select(
            "antecedent",
            F.array("item").alias("consequent"),
            "confidence",
            (F.col("confidence") / (F.col("f_consequent") / n)).alias("lift"),
            (F.col("f_union") / n).alias("support"),
            F.col("f_union").alias("frequency"),
        )
    )


def rule_order() -> list[Column]:
    """Total order of rules: lift, then confidence, then the items."""
    return [F.desc("lift"), F.desc("confidence"), F.asc("antecedent"), F.asc("consequent")]


def strong_rules(rules: DataFrame, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules with lift strictly above the limit, best first."""
    return rules.filter(F.col("lift") > min_lift).orderBy(*rule_order())


def filter_rules(
    rules: DataFrame, min_lift: float, min_confidence_pct: float, keyword: str = ""
) -> DataFrame:
    """Rules at or above both limits that mention the keyword on either side."""
    kept = rules.filter(
        (F.col("lift") >= min_lift) & (F.col("confidence") * 100 >= min_confidence_pct)
    )
    if keyword.strip():
        kept = kept.filter(mentions(F.col("antecedent"), keyword) | mentions(F.col("consequent"), keyword))
    return kept


def rules_with_antecedent_item(rules: DataFrame, item: str) -> DataFrame:
    return rules.filter(F.array_contains("antecedent", item))


def find_rule(rules: DataFrame, antecedent: Sequence[str], consequent: Sequence[str]) -> DataFrame:
    def literal(items: Sequence[str]) -> Column:
        return F.array(*[F.lit(i) for i in items])

    return rules.filter(
        same_items(F.col("antecedent"), literal(antecedent))
        & same_items(F.col("consequent"), literal(consequent))
    )


def find_itemset(itemsets: DataFrame, items: Sequence[str]) -> DataFrame:
    """The itemset with exactly these items, in whatever order they are given."""
    return itemsets.filter(same_items(F.col("items"), F.array(*[F.lit(i) for i in items])))


def posted(postings: DataFrame, item: str) -> DataFrame:
    """The rows of a posting table (see ``publish.write_postings``) under an item; the scan skips the others."""
    return postings.filter(F.col("item") == item).drop("item")


def posted_rule(postings: DataFrame, antecedent: Sequence[str], consequent: Sequence[str]) -> DataFrame:
    """``find_rule`` by the postings of the antecedent."""
    return find_rule(posted(postings, antecedent[0]), antecedent, consequent)


def posted_itemset(postings: DataFrame, items: Sequence[str]) -> DataFrame:
    """``find_itemset`` by the postings of the items."""
    return find_itemset(posted(postings, items[0]), items)


def filter_itemsets(itemsets: DataFrame, k_mode: str = "all", keyword: str = "") -> DataFrame:
    """Itemsets by size (``all``, ``single``, ``multi``) and keyword."""
    if k_mode not in ("all", "single", "multi"):
        raise ValueError(f"unknown size filter: {k_mode}")
    kept = itemsets
    if k_mode == "multi":
        kept = kept.filter(F.col("k") >= 2)
    elif k_mode == "single":
        kept = kept.filter(F.col("k") == 1)
    return kept.filter(mentions(F.col("items"), keyword)) if keyword.strip() else kept


def itemset_order() -> list[Column]:
    return [F.desc("support"), F.asc("k"), F.asc("items")]


def itemset_counts(itemsets: DataFrame) -> DataFrame:
    """Totals: all itemsets, single items, larger ones."""
    return itemsets.agg(
        F.count(F.lit(1)).alias("total_itemsets"),
        F.count_if(F.col("k") == 1).alias("total_1_itemsets"),
        F.count_if(F.col("k") >= 2).alias("total_multi_itemsets"),
    )


def itemsets_by_size(itemsets: DataFrame) -> DataFrame:
    return itemsets.groupBy("k").agg(F.count(F.lit(1)).alias("itemsets"))


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rules with the highest lift, labelled for a chart."""
    return (
        rules.orderBy(*rule_order())
        .limit(n)
        .select(
            rule_label(F.col("antecedent"), F.col("consequent")).alias("rule"),
            F.round("lift", 2).alias("lift"),
        )
    )


def top_itemsets(itemsets: DataFrame, n: int = 10) -> DataFrame:
    return (
        itemsets.orderBy(*itemset_order())
        .limit(n)
        .select(
            itemset_label(F.col("items")).alias("itemset"),
            "k",
            (F.col("support") * 100).alias("support_pct"),
        )
    )


def rule_stats(rules: DataFrame) -> DataFrame:
    """Number of rules, highest lift, mean confidence, lowest support; 0 without rules."""
    none = F.lit(0.0)
    return rules.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.coalesce(F.max("lift"), none).alias("max_lift"),
        F.coalesce(F.avg("confidence"), none).alias("avg_confidence"),
        F.coalesce(F.min("support"), none).alias("min_support"),
    )


def rule_sides(rules: DataFrame, catalog_size: Column) -> DataFrame:
    """Distinct items on either side, and the share of the catalog that rules can reach."""
    sides = F.explode(
        F.concat(
            F.transform("antecedent", lambda i: F.struct(F.lit("a").alias("side"), i.alias("item"))),
            F.transform("consequent", lambda i: F.struct(F.lit("c").alias("side"), i.alias("item"))),
        )
    )
    distinct = rules.select(sides.alias("s")).select("s.side", "s.item").distinct()
    return distinct.agg(
        F.count_if(F.col("side") == "a").alias("unique_antecedents"),
        F.count_if(F.col("side") == "c").alias("unique_consequents"),
    ).withColumn(
        "coverage_ceiling_pct",
        F.round(
            F.coalesce(
                F.col("unique_consequents") / F.when(catalog_size > 0, catalog_size) * 100,
                F.lit(0.0),
            ),
            2,
        ),
    )


def explain_rules(rules: DataFrame, itemsets: DataFrame, n_baskets: int) -> DataFrame:
    """The numbers behind each rule: frequencies and supports of A and B, of A and of B.

    Each figure comes from the itemset table; one that is missing there is derived from
    the measures of the rule.
    """
    table = itemsets.select("items", "frequency", "support")

    def lookup(name: str) -> DataFrame:
        return table.select(
            F.col("items").alias(f"{name}_items"),
            F.col("frequency").alias(f"{name}_found"),
            F.col("support").alias(f"{name}_support_found"),
        )

    n = F.lit(float(n_baskets))
    conf_pct = F.col("confidence") * 100

    def whole(x: Column) -> Column:
        return F.bround(x, 0).cast("long")

    found = (
        rules.withColumn("pair_key", F.array_sort(F.concat("antecedent", "consequent")))
        .withColumn("ant_key", F.array_sort("antecedent"))
        .withColumn("cons_key", F.array_sort("consequent"))
        .join(lookup("pair"), F.col("pair_key") == F.col("pair_items"), "left")
        .join(lookup("ant"), F.col("ant_key") == F.col("ant_items"), "left")
        .join(lookup("cons"), F.col("cons_key") == F.col("cons_items"), "left")
        .withColumn("freq_pair", F.coalesce("pair_found", whole(F.col("support") * n)))
    )
    return (
        found.withColumn(
            "freq_antecedent",
            F.coalesce("ant_found", whole(F.col("freq_pair") / (conf_pct / 100))),
        )
        .withColumn(
            "freq_consequent",
            F.coalesce("cons_found", whole(n * (conf_pct / (F.col("lift") * 100)))),
        )
        .select(
            "antecedent",
            "consequent",
            "freq_pair",
            "freq_antecedent",
            "freq_consequent",
            (F.col("support") * 100).alias("pair_support_pct"),
            (F.coalesce("ant_support_found", F.col("freq_antecedent") / n) * 100).alias(
                "antecedent_support_pct"
            ),
            F.coalesce(F.col("cons_support_found") * 100, conf_pct / F.col("lift")).alias(
                "consequent_support_pct"
            ),
            conf_pct.alias("confidence_pct"),
            "lift",
        )
    )


def _step(value: Column, limits: Sequence[float]) -> Column:
    """How many of the ascending limits the value reaches."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x <= value))


def _cumulated(cells: DataFrame, supports: int, confidences: int) -> DataFrame:
    """Cells (a, b, n, total, most) summed over all cells at or beyond each point of the grid.

    Two running aggregates, first along one axis, then along the other; the grid has as
    many rows as there are pairs of limits, whatever the data.
    """
    spark = cells.sparkSession
    axes = spark.range(1, supports + 1).select(F.col("id").cast("int").alias("a")).withColumn(
        "b", F.explode(F.sequence(F.lit(1), F.lit(confidences)))
    )
    grid = axes.join(cells, ["a", "b"], "left")
    for fixed, along in (("b", "a"), ("a", "b")):
        beyond = W.partitionBy(fixed).orderBy(F.desc(along))
        grid = grid.select(
            "a",
            "b",
            F.sum(F.coalesce("n", F.lit(0))).over(beyond).alias("n"),
            F.sum(F.coalesce("total", F.lit(0.0))).over(beyond).alias("total"),
            F.max("most").over(beyond).alias("most"),
        )
    return grid


def sweep(
    itemsets: DataFrame,
    n_baskets: int,
    configs: Sequence[tuple[str, float, float]] = SWEEP_CONFIGS,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """Itemsets, strong rules, highest lift and mean confidence per configuration, in their order.

    ``itemsets`` are mined at the lowest support of all configurations.  A larger
    support keeps exactly the itemsets that reach its count, and a rule exactly when
    its union does.  So a rule counts for every configuration that its support and its
    confidence dominate: each rule is numbered once by the highest limits it reaches on
    either axis, the rules of a cell are aggregated, and the cells are cumulated along
    both axes.  The plan is the same for five configurations and for thousands.
    """
    spark = itemsets.sparkSession
    counts = sorted({min_count(support, n_baskets) for _, support, _ in configs})
    shares = sorted({float(confidence) for *_, confidence in configs})
    rules = counted_rules(itemsets.filter(F.col("frequency") >= counts[0]), n_baskets, shares[0]).filter(
        F.col("lift") > min_lift
    )
    # itemsets without a rule of their own lie on an axis of their own, b = 0
    facts = itemsets.select("frequency", F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("double").alias("lift"))
    facts = facts.unionByName(rules.select("frequency", "confidence", "lift"))
    steps = facts.select(
        _step(F.col("frequency"), counts).alias("a"),
        F.when(F.col("lift").isNull(), F.lit(0)).otherwise(_step(F.col("confidence"), shares)).alias("b"),
        "confidence",
        "lift",
    )
    cells = materialize(
        steps.groupBy("a", "b").agg(
            F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("total"), F.max("lift").alias("most")
        ),
        "sweep-cells",
    )
    found = _cumulated(cells.filter("b > 0"), len(counts), len(shares))
    larger = W.orderBy(F.desc("a"))
    frequent = (
        spark.range(1, len(counts) + 1)
        .select(F.col("id").cast("int").alias("a"))
        .join(cells.filter("b = 0").select("a", "n"), "a", "left")
        .select("a", F.sum(F.coalesce("n", F.lit(0))).over(larger).alias("frequent_itemsets"))
    )
    asked = spark.createDataFrame(
        [
            (i, name, float(support), float(confidence), counts.index(min_count(support, n_baskets)) + 1, shares.index(float(confidence)) + 1)
            for i, (name, support, confidence) in enumerate(configs)
        ],
        "place int, config_id string, min_support double, min_confidence double, a int, b int",
    )
    return (
        asked.join(found, ["a", "b"])
        .join(frequent, "a")
        .orderBy("place")
        .select(
            "config_id",
            "min_support",
            "min_confidence",
            "frequent_itemsets",
            F.col("n").alias("association_rules"),
            F.round(F.coalesce("most", F.lit(0.0)), 4).alias("max_lift"),
            F.round(F.coalesce(F.col("total") / F.when(F.col("n") > 0, F.col("n")), F.lit(0.0)), 4).alias("avg_confidence"),
        )
    )
