import glob
import itertools
import random

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from basketlab.functions.measures import min_count
from basketlab.operators import mining as M
from basketlab.sources.schemas import ITEMSETS, RULES
from basketlab.storage import shared_root

random.seed(11)
ITEMS = list("abcdefgh")
BASKETS = [sorted(random.sample(ITEMS, random.randint(2, 5))) for _ in range(150)] + [["a", "b", "c"]] * 60


@pytest.fixture(scope="module")
def baskets(spark):
    return spark.createDataFrame([(b,) for b in BASKETS], "items array<string>").cache()


@pytest.fixture(scope="module")
def itemsets(spark, baskets):
    return M.mine(baskets, 0.05).cache()


def counted(min_support):
    found = {}
    for basket in BASKETS:
        for k in range(1, len(basket) + 1):
            for part in itertools.combinations(basket, k):
                found[part] = found.get(part, 0) + 1
    return {p: n for p, n in found.items() if n >= min_count(min_support, len(BASKETS))}


def test_itemsets_by_hand(itemsets):
    got = {tuple(r["items"]): r["frequency"] for r in itemsets.collect()}
    assert got == counted(0.05)
    assert max(len(p) for p in got) >= 3


def test_itemset_rows(itemsets):
    for r in itemsets.collect():
        assert r["k"] == len(r["items"]) == len(set(r["items"]))
        assert r["support"] == r["frequency"] / len(BASKETS) > 0


def test_support_shrinks_with_size(itemsets):
    support = {tuple(r["items"]): r["support"] for r in itemsets.collect()}
    for items, value in support.items():
        for i in range(len(items)):
            rest = items[:i] + items[i + 1 :]
            assert not rest or support[rest] >= value


def test_rules_equal_mllib(baskets, itemsets):
    model = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.3).fit(baskets)
    theirs = {
        (tuple(sorted(r["antecedent"])), r["consequent"][0]): (r["confidence"], r["lift"], r["support"])
        for r in model.associationRules.collect()
    }
    ours = {
        (tuple(r["antecedent"]), r["consequent"][0]): (r["confidence"], r["lift"], r["support"])
        for r in M.association_rules(itemsets, len(BASKETS), 0.3).collect()
    }
    assert ours.keys() == theirs.keys() and len(ours) > 50
    for key, values in ours.items():
        assert values == pytest.approx(theirs[key], rel=1e-12)


def test_lift_is_symmetric_for_pairs(itemsets):
    lifts = {
        (r["antecedent"][0], r["consequent"][0]): r["lift"]
        for r in M.association_rules(itemsets, len(BASKETS), 0.0).filter(F.size("antecedent") == 1).collect()
    }
    assert lifts and all(lifts[b, a] == pytest.approx(v) for (a, b), v in lifts.items())


def test_strong_rules_exclude_the_limit(spark):
    rules = spark.createDataFrame(
        [(["a"], ["b"], 0.5, 1.2, 0.1), (["b"], ["c"], 0.5, 1.21, 0.1), (["a"], ["c"], 0.6, 1.21, 0.1)], RULES
    )
    assert [r["antecedent"] for r in M.strong_rules(rules).collect()] == [["a"], ["b"]]


def test_rule_filter_includes_the_limits_and_trims_the_keyword(spark):
    rules = spark.createDataFrame(
        [(["Red Plum"], ["Kiwi"], 0.08, 1.5, 0.1), (["Fig"], ["Pear"], 0.07, 1.5, 0.1)], RULES
    )
    assert M.filter_rules(rules, 1.5, 8).count() == 1
    assert M.filter_rules(rules, 1.5, 1, "  kIW ").count() == 1
    assert M.filter_rules(rules, 1.5, 1, "   ").count() == 2
    assert M.filter_rules(rules, 1.5, 1, "plum kiwi").count() == 0


def test_lookups(itemsets):
    assert M.find_itemset(itemsets, ["c", "a", "b"]).count() == 1
    rules = M.association_rules(itemsets, len(BASKETS), 0.0)
    assert M.find_rule(rules, ["b", "a"], ["c"]).count() == 1
    assert M.rules_with_antecedent_item(rules, "a").filter(~F.array_contains("antecedent", "a")).count() == 0
    assert M.filter_itemsets(itemsets, "single").count() == len(ITEMS)
    with pytest.raises(ValueError):
        M.filter_itemsets(itemsets, "triples")


def test_sweep_equals_mining_each_configuration(spark, baskets, itemsets):
    configs = [("low", 0.05, 0.2), ("mid", 0.1, 0.4), ("high", 0.6, 0.5)]
    got = {r["config_id"]: r for r in M.sweep(itemsets, len(BASKETS), configs, 1.1).collect()}
    for name, support, confidence in configs:
        model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
        strong = model.associationRules.filter(F.col("lift") > 1.1)
        stats = strong.agg(F.count(F.lit(1)), F.max("lift"), F.avg("confidence")).first()
        row = got[name]
        assert row["frequent_itemsets"] == model.freqItemsets.count()
        assert row["association_rules"] == stats[0]
        assert row["max_lift"] == pytest.approx(stats[1] or 0.0, abs=1e-4)
        assert row["avg_confidence"] == pytest.approx(stats[2] or 0.0, abs=1e-4)
    assert got["high"]["association_rules"] == 0 and got["high"]["max_lift"] == 0.0


def test_sweep_over_a_large_grid(spark, itemsets):
    """1600 configurations in any order, some equal: as if each were counted alone; the plan does not widen."""
    rng = random.Random(3)
    configs = [(f"{s}-{c}", 0.05 + 0.005 * s, 0.02 * c) for s in range(40) for c in range(40)]
    rng.shuffle(configs)
    configs += configs[:3]
    rows = M.sweep(itemsets, len(BASKETS), configs, 1.05).collect()
    assert [r["config_id"] for r in rows] == [c[0] for c in configs]
    rules = M.counted_rules(itemsets, len(BASKETS), 0.0).filter("lift > 1.05").collect()
    frequencies = [r["frequency"] for r in itemsets.collect()]
    for row, (_, support, confidence) in zip(rows, configs):
        least = min_count(support, len(BASKETS))
        kept = [r for r in rules if r["frequency"] >= least and r["confidence"] >= confidence]
        assert row["frequent_itemsets"] == sum(f >= least for f in frequencies)
        assert row["association_rules"] == len(kept)
        assert row["max_lift"] == pytest.approx(max((r["lift"] for r in kept), default=0.0), abs=1e-4)
        mean = sum(r["confidence"] for r in kept) / len(kept) if kept else 0.0
        assert row["avg_confidence"] == pytest.approx(mean, abs=1e-4)

    def width(grid):
        return len(M.sweep(itemsets, len(BASKETS), grid)._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert width(configs) == width(configs[:2])


def test_baskets_of_one_item_are_dealt_out(spark, no_broadcast):
    """Every basket holds item 0, so one item has them all; they still lie in many parts. A null counts as an item."""
    rng = random.Random(5)
    rows = [[0, *rng.sample([None, *range(1, 12)], rng.randint(2, 9))] for _ in range(300)]
    data = spark.createDataFrame([(b,) for b in rows + rows[:40]], "items array<int>")
    before = set(glob.glob(f"{_scratch(spark)}/projected-*"))
    found = M.mine(data, 0.1, num_partitions=6)
    got = {frozenset(r["items"]): r["frequency"] for r in found.collect()}
    theirs = FPGrowth(itemsCol="items", minSupport=0.1).fit(data).freqItemsets.collect()
    assert got == {frozenset(r["items"]): r["freq"] for r in theirs} and max(map(len, got)) > 3
    written = [spark.read.parquet(p) for p in set(glob.glob(f"{_scratch(spark)}/projected-*")) - before]
    whole = [t for t in written if t.filter("size(prefix) = 0").count()]
    assert len(whole) == 1 and whole[0].agg(F.sum("weight")).first()[0] == len(rows) + 40
    assert whole[0].select("tail").distinct().count() == whole[0].count() <= len(rows)
    spread = whole[0].groupBy(F.input_file_name()).count().collect()
    assert len(spread) == 6 and max(r["count"] for r in spread) < len(rows) / 2


def _scratch(spark):
    return f"{shared_root(spark).removeprefix('file://')}/{spark.sparkContext.applicationId}"


def test_an_item_named_twice_is_an_error(spark):
    twice = spark.createDataFrame([(["a", "b", "a"],), (["a", "b"],)], "items array<string>")
    with pytest.raises(Exception, match="must be unique"):
        M.mine(twice, 0.5)


def test_item_groups_follow_items_and_baskets():
    assert M.item_groups(0, 0) == 1 and M.item_groups(5, 10**9) == 5
    assert M.item_groups(64_000, 10) == 1000 and M.item_groups(64_000, 10**8) == 5000


def test_explained_rule_falls_back_to_derived_numbers(spark):
    rules = spark.createDataFrame([(["a"], ["b"], 0.25, 2.5, 0.05)], RULES)
    none = spark.createDataFrame([], ITEMSETS)
    row = M.explain_rules(rules, none, 1000).first()
    assert (row["freq_pair"], row["freq_antecedent"], row["freq_consequent"]) == (50, 200, 100)
    assert row["antecedent_support_pct"] == pytest.approx(20)
    assert row["consequent_support_pct"] == pytest.approx(10)
    known = spark.createDataFrame([(["a"], 1, 210, 0.21)], ITEMSETS)
    assert M.explain_rules(rules, known, 1000).first()["freq_antecedent"] == 210


def test_rule_statistics_without_rules(spark):
    row = M.rule_stats(spark.createDataFrame([], RULES)).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0)
    sides = M.rule_sides(spark.createDataFrame([], RULES), F.lit(10)).first()
    assert tuple(sides) == (0, 0, 0.0)


def test_no_baskets(spark):
    assert M.mine(spark.createDataFrame([], "items array<string>"), 0.1).count() == 0


def test_threshold_above_the_number_of_baskets(baskets):
    assert M.mine(baskets, 1.5).count() == 0
