import random

import pytest
from pyspark.sql import functions as F

from basketlab.functions.labels import FALLBACK_LABEL
from basketlab.operators import recommend as R
from basketlab.sources.schemas import CARTS, RULES

RULE_ROWS = [
    (["A"], ["B"], 0.13, 3.9, 0.01),
    (["B"], ["A"], 0.26, 3.9, 0.01),
    (["D"], ["C"], 0.10, 3.0, 0.01),
    (["A"], ["C"], 0.20, 2.8, 0.01),
    (["A", "D"], ["E"], 0.30, 2.0, 0.01),
]
POPULAR = ["Z", "A", "B", "C", "Y"]


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULE_ROWS, RULES)


@pytest.fixture(scope="module")
def popular(spark):
    return spark.createDataFrame(
        [(item, 100 - i) for i, item in enumerate(POPULAR)], "item string, total_sales long"
    )


def carts(spark, *items):
    return spark.createDataFrame(list(enumerate(items)), CARTS)


def shown(df):
    rows = df.orderBy("cart_id", "rank").collect()
    return {c: [(r["item"], r["lift"]) for r in rows if r["cart_id"] == c] for c in {r["cart_id"] for r in rows}}


def test_fixture_carts(spark, rules, popular):
    given = carts(spark, ["A"], ["A", "D"], ["A", "B"], ["Q"], [])
    assert shown(R.recommend_with_fallback(given, rules, popular)) == {
        0: [("B", 3.9), ("C", 2.8)],
        1: [("B", 3.9), ("C", 3.0), ("E", 2.0)],
        2: [("C", 2.8)],
        3: [("Z", None), ("A", None), ("B", None)],
    }


def test_fallback_is_labelled_and_leaves_out_the_cart(spark, rules, popular):
    given = carts(spark, ["Q", "Z"], ["A"], [])
    served = R.recommend(given, rules)
    rows = R.fallback(given, served, popular).orderBy("rank").collect()
    assert [(r["cart_id"], r["item"]) for r in rows] == [(0, "A"), (0, "B"), (0, "C")]
    assert {(r["source"], r["rule"]) for r in rows} == {("popular", FALLBACK_LABEL)}


def test_explanation_is_the_best_rule(spark, rules):
    row = R.recommend(carts(spark, ["A", "D"]), rules).filter(F.col("item") == "C").first()
    assert row["rule"] == "D → C"


def test_top_n_and_ties(spark):
    tied = spark.createDataFrame(
        [(["A"], [x], 0.5, 2.0, 0.1) for x in "FEDCBG"] + [(["A"], ["H"], 0.6, 2.0, 0.1)], RULES
    )
    assert [i for i, _ in shown(R.recommend(carts(spark, ["A"]), tied))[0]] == list("HBCDE")


def test_no_rules_no_carts(spark, rules, popular):
    none = spark.createDataFrame([], RULES)
    assert R.recommend(carts(spark, ["A"]), none).count() == 0
    assert [i for i, _ in shown(R.recommend_with_fallback(carts(spark, ["A"]), none, popular))[0]] == ["Z", "B", "C"]
    assert R.recommend_with_fallback(spark.createDataFrame([], CARTS), rules, popular).count() == 0


def expected(cart, top_n=5):
    best = {}
    for ant, cons, conf, lift, _ in RANDOM_RULES:
        for item in cons:
            if set(ant) <= set(cart) and item not in cart:
                key = (-lift, -conf, ant, cons)
                best[item] = min(best.get(item, key), key)
    return [i for i, _ in sorted(best.items(), key=lambda kv: (kv[1], kv[0]))][:top_n]


random.seed(7)
ITEMS = list("ABCDEFGHIJ")
RANDOM_RULES = []
for _ in range(120):
    picked = sorted(random.sample(ITEMS, random.choice([2, 3, 4])))
    cons = random.choice(picked)
    RANDOM_RULES.append(
        (
            [i for i in picked if i != cons],
            [cons],
            random.choice([0.1, 0.2, 0.3]),
            random.choice([1.5, 2.0, 2.5]),
            0.1,
        )
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_random_carts_against_set_matching(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    some = [random.sample(ITEMS, random.randint(0, 6)) for _ in range(200)]
    # a third of all carts are the same hot pair
    some += [["A", "B"]] * 100
    rules = spark.createDataFrame(RANDOM_RULES, RULES)
    got = shown(R.recommend(carts(spark, *some), rules))
    for cart_id, cart in enumerate(some):
        assert [i for i, _ in got.get(cart_id, [])] == expected(cart)


def test_many_rules_of_one_antecedent(spark):
    """The best rules point into the cart, so later places have to move up."""
    names = [f"x{n:02d}" for n in range(40)]
    rules = spark.createDataFrame(
        [(["A"], [x], 0.5, 9.0 - n / 10, 0.1) for n, x in enumerate(names)]
        + [(["A"], ["x39"], 0.4, 1.5, 0.1), (["x03"], ["x30"], 0.5, 8.95, 0.1)],
        RULES,
    )
    got = shown(R.recommend(carts(spark, ["A", *names[:9]], ["A"], ["A", *names[:38]]), rules))
    assert [i for i, _ in got[0]] == ["x30", *names[9:13]]
    assert [i for i, _ in got[1]] == names[:5]
    assert [i for i, _ in got[2]] == names[38:]


def test_selector_and_known_items(spark, rules, popular):
    top = popular.limit(2)
    listed = [r["item"] for r in R.item_selector(rules, top, ["Kiwi"]).collect()]
    assert listed == ["A", "B", "D", "Kiwi", "Z"]
    empty_rules, empty_top = spark.createDataFrame([], RULES), popular.limit(0)
    assert [r["item"] for r in R.item_selector(empty_rules, empty_top, []).collect()] == sorted(
        ["Banana", "Bag of Organic Bananas", "Organic Strawberries", "Limes"]
    )
    kept = R.known_items(carts(spark, ["Q", "D", "A"], ["Q"], []), R.item_selector(rules, top, []))
    assert {r["cart_id"]: r["items"] for r in kept.collect()} == {0: ["D", "A"], 1: [], 2: []}


def test_carts_full_of_best_sellers_still_get_three(spark):
    popular = spark.createDataFrame([(f"p{i:02d}", 100 - i) for i in range(20)], "item string, total_sales long")
    carts = spark.createDataFrame(
        [(1, [f"p{i:02d}" for i in range(12)]), (2, [f"p{i:02d}" for i in range(8)]), (3, ["x"]), (4, [])], CARTS
    )
    rows = R.recommend_with_fallback(carts, spark.createDataFrame([], RULES), popular).collect()
    got = {c: [r["item"] for r in sorted(rows, key=lambda r: r["rank"]) if r["cart_id"] == c] for c in (1, 2, 3, 4)}
    assert got == {1: ["p12", "p13", "p14"], 2: ["p08", "p09", "p10"], 3: ["p00", "p01", "p02"], 4: []}


@pytest.mark.parametrize("sales", [None, [("a", 2000), ("b", 9000)] + [(f"r{i:03d}", 1) for i in range(300)]])
def test_rules_that_share_a_best_seller_are_tried_by_their_rare_item(spark, sales):
    rules = spark.createDataFrame([(["a", f"r{i:03d}"], ["z"], 0.5, 2.0, 0.1) for i in range(300)], RULES)
    carts = spark.createDataFrame([(i, ["a", f"r{i:03d}"] if i < 300 else ["a", "b"]) for i in range(2000)], CARTS)
    sold = None if sales is None else spark.createDataFrame(sales, "item string, total_sales long")
    ready = R.prepare(rules, sold)
    met = R.cart_items(carts, ready.numbers).join(ready.offers.table, F.col("number") == F.col("key")).count()
    assert met == R.match_rules(carts, rules, sold).count() == 300


def test_prefix_filter_asks_for_the_second_rarest_item(spark):
    """Candidates that share only their rarest item with a cart are gone before the rest is looked at."""
    rules = spark.createDataFrame([(["k", f"s{i:03d}", "t", "u"], ["z"], 0.5, 2.0, 0.1) for i in range(200)], RULES)
    sales = spark.createDataFrame(
        [("k", 1), ("t", 500), ("u", 600), ("z", 700)] + [(f"s{i:03d}", 2) for i in range(200)], "item string, total_sales long"
    )
    ready = R.prepare(rules, sales)
    assert ready.offers.longest == 4
    rows = ready.offers.table.collect()
    assert len({r["key"] for r in rows}) == 1 and len({r["second"] for r in rows}) == 200
    assert all(len(r["rest"]) == 2 and r["rest"] == sorted(r["rest"]) for r in rows)
    carts = spark.createDataFrame([(1, ["k", "t", "u", "s007"]), (2, ["k", "t", "u"]), (3, ["k", "s007", "t"])], CARTS)
    assert [r["cart_id"] for r in R.match_rules(carts, rules, sales).collect()] == [1]


def shuffled_bytes(spark, run):
    """Bytes that all stages of ``run`` wrote for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway
    nothing = gateway.new_array(gateway.jvm.double, 0)

    def total():
        stages = store.stageList(None, False, False, nothing, None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_shuffled_bytes_grow_with_the_cart_not_its_square(spark, no_broadcast):
    """One cart of 20,000 items against one of 2,000: nothing copies a cart onto its items."""
    names = [f"i{n:05d}" for n in range(21_000)]
    rules = spark.createDataFrame(
        [([names[n]], [names[n + 500]], 0.5, 2.0, 0.1) for n in range(0, 20_500, 10)]
        + [(sorted([names[n], names[n + 1], names[n + 2]]), ["z"], 0.5, 1.5, 0.1) for n in range(0, 20_000, 50)],
        RULES,
    )
    sales = spark.createDataFrame([(n, 1 + i % 97) for i, n in enumerate([*names, "z"])], "item string, total_sales long")
    ready = R.prepare(rules, sales)
    moved = {}
    for size in (2_000, 20_000):
        carts = spark.createDataFrame([(1, names[:size])], CARTS)
        served = R.recommend_with_fallback(carts, rules, sales, serving=ready)
        moved[size] = shuffled_bytes(spark, served.collect)
        assert {r["source"] for r in served.collect()} == {"rule"}
    assert 0 < moved[20_000] < 20 * moved[2_000] and moved[20_000] < 20_000 * 400


def test_one_huge_cart_does_not_weigh_on_the_small_ones(spark):
    """Free places of best sellers: the huge cart gets the three behind its own, the others the first three."""
    sold = [f"p{n:05d}" for n in range(30_000)]
    popular = spark.createDataFrame([(p, 100_000 - n) for n, p in enumerate(sold)], "item string, total_sales long")
    carts = spark.createDataFrame([(0, sold[:20_000])] + [(i, [sold[i % 5]]) for i in range(1, 2001)], CARTS)
    got = {}
    for r in R.recommend_with_fallback(carts, spark.createDataFrame([], RULES), popular).collect():
        got.setdefault(r["cart_id"], {})[r["rank"]] = r["item"]
    assert list(got[0].values()) == sold[20_000:20_003] and len(got) == 2001
    for i in (1, 2, 3, 4, 5, 2000):
        assert [got[i][k] for k in (1, 2, 3)] == [p for n, p in enumerate(sold[:5]) if n != i % 5][:3]
    places = R.sale_places(popular)
    held = R.free_places(carts, places, 3)
    # what a small cart carries is as long as itself plus three
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and held.filter("cart_id > 0 AND size(free) <> 3").isEmpty()


def test_fewer_best_sellers_than_asked_for(spark):
    popular = spark.createDataFrame([("a", 3), ("b", 2)], "item string, total_sales long")
    given = carts(spark, ["a"], ["a", "b"], ["x", "x"])
    rows = R.recommend_with_fallback(given, spark.createDataFrame([], RULES), popular).collect()
    assert sorted((r["cart_id"], r["rank"], r["item"]) for r in rows) == [(0, 1, "b"), (2, 1, "a"), (2, 2, "b")]


def test_rules_without_antecedent_are_an_error(spark):
    rules = spark.createDataFrame([([], ["z"], 0.5, 2.0, 0.1)], RULES)
    with pytest.raises(Exception, match="empty antecedent"):
        R.match_rules(spark.createDataFrame([(1, ["a"])], CARTS), rules).collect()
