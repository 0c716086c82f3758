import random

import pytest
from pyspark.sql import functions as F

from basketlab.operators import evaluate as E
from basketlab.sources.schemas import RULES
from test_recommend import RULE_ROWS

BASKETS = "order_id long, items array<string>, first_item string"


def popular(spark, items):
    return spark.createDataFrame(
        [(item, 100 - i) for i, item in enumerate(items)], "item string, total_sales long"
    )


def run(spark, baskets, rules, popular_items, catalog, ks=(3, 5, 10)):
    df = E.evaluate(
        spark.createDataFrame(baskets, BASKETS),
        spark.createDataFrame(rules, RULES),
        popular(spark, popular_items),
        F.lit(catalog),
        ks,
    )
    return {r["k"]: r.asDict() for r in df.collect()}


def test_fixture_basket(spark):
    got = run(spark, [(1, ["A", "B", "Z"], "A"), (2, ["A"], "A")], RULE_ROWS, ["Z", "A", "B", "C", "Y"], 10)
    three = got[3]
    assert three["rules_precision"] == pytest.approx(2 / 3, abs=1e-6)
    assert three["rules_recall"] == 1 and three["rules_hit_rate"] == 1
    assert three["popular_precision"] == pytest.approx(2 / 3, abs=1e-6)
    assert three["rules_coverage"] == 0.3 and three["popular_coverage"] == 0.3


def test_header_counts_single_item_baskets(spark):
    df = spark.createDataFrame([(1, ["A", "B"], "A"), (2, ["A"], "A")], BASKETS)
    assert E.evaluation_header(df).first().asDict() == {
        "baskets_queried": 2,
        "baskets_evaluated": 1,
        "baskets_skipped": 1,
    }


def test_no_baskets(spark):
    got = run(spark, [], RULE_ROWS, ["Z"], 10)
    assert got[3]["rules_precision"] == 0 and got[10]["popular_coverage"] == 0


def by_hand(baskets, rules, top, catalog, ks):
    ordered = sorted(rules, key=lambda r: (-r[3], -r[2], r[0], r[1]))
    out = {}
    for k in ks:
        sums, reached, n = {"rules": [0, 0, 0], "popular": [0, 0, 0]}, {"rules": set(), "popular": set()}, 0
        for _, items, first in baskets:
            if len(items) < 2:
                continue
            n += 1
            truth = set(items) - {first}
            fired = []
            for ant, cons, *_ in ordered:
                fired += [c for c in cons if set(ant) <= {first} and c != first and c not in fired]
            padded = fired + [p for p in top if p != first and p not in fired]
            for side, shown in (("rules", padded[:k]), ("popular", [p for p in top if p != first][:k])):
                hits = len(truth & set(shown))
                reached[side] |= set(shown)
                for i, x in enumerate((hits / k, hits / len(truth), hits > 0)):
                    sums[side][i] += x
        out[k] = {
            f"{side}_{m}": sums[side][i] / n
            for side in sums
            for i, m in enumerate(("precision", "recall", "hit_rate"))
        } | {f"{side}_coverage": len(reached[side]) / catalog for side in reached}
    return out


def test_random_baskets_by_hand(spark, no_broadcast):
    random.seed(3)
    items = [f"i{n:02d}" for n in range(15)]
    baskets = []
    for n in range(300):
        picked = sorted(random.sample(items, random.randint(1, 6)))
        # a third of the baskets starts with the same item
        first = picked[0] if n % 3 else min(picked)
        baskets.append((n, picked, first))
    rules = []
    for _ in range(60):
        a, b, c = random.sample(items, 3)
        rules.append(([a], [b], random.random(), random.choice([1.3, 1.7, 2.1]), 0.1))
        rules.append((sorted([a, c]), [b], random.random(), 2.5, 0.1))
    unique = {(tuple(r[0]), tuple(r[1])): r for r in rules}
    got = run(spark, baskets, list(unique.values()), items[:10], 15)
    want = by_hand(baskets, list(unique.values()), items[:10], 15, (3, 5, 10))
    for k, measures in want.items():
        for name, value in measures.items():
            assert got[k][name] == pytest.approx(value, abs=1e-6), (k, name)


def test_sample_is_repeatable_for_large_ids(spark):
    ids = spark.range(0, 10**12, 10**10).select(F.col("id").alias("order_id"))
    first = [r[0] for r in E.evaluation_sample(ids, 10).collect()]
    assert first == [r[0] for r in E.evaluation_sample(ids.repartition(7), 10).collect()]
    assert len(set(first)) == 10
