import random
import re

import pytest
from pyspark.sql import functions as F

from basketlab.operators import baskets as B
from basketlab.operators import items as I
from basketlab.operators import trace as TR
from basketlab.operators.quality import order_facts

LINES = "order_id long, product_id long, add_to_cart_order int"
PRODUCTS = "product_id long, product_name string"
ORDERS = "order_id long, user_id long, order_dow int, order_hour_of_day int"
NAMES = [(1, "Apple"), (2, "Bread"), (3, "Cheese"), (4, "Bread"), (9, "Rare")]
ROWS = [
    # order 1: a duplicate line, two core items
    (1, 2, 1), (1, 1, 2), (1, 2, 3),
    # order 2: one product, twice
    (2, 1, 1), (2, 1, 2),
    # order 3: rare products only
    (3, 9, 1), (3, 8, 2),
    # order 4: one core product
    (4, 9, 1), (4, 3, 2),
    # order 5: two core products of the same name
    (5, 2, 1), (5, 4, 2),
    # order 6: three core items
    (6, 3, 1), (6, 2, 2), (6, 1, 3),
    # order 8 has lines but is not among the orders
    (8, 3, 1), (8, 4, 2), (8, 1, 3),
]


@pytest.fixture(scope="module")
def data(spark):
    return (
        spark.createDataFrame(ROWS, LINES),
        spark.createDataFrame(NAMES, PRODUCTS),
        spark.createDataFrame([(i, 10 * i, i % 7, i % 24) for i in range(1, 8)], ORDERS),
    )


def test_pruned_baskets(data):
    lines, products, _ = data
    got = {r["order_id"]: (r["items"], r["first_item"]) for r in B.build_baskets(lines, products, 2).collect()}
    # product 9 occurs twice and is core at this threshold, product 8 is unknown
    assert got == {
        1: (["Apple", "Bread"], "Bread"),
        4: (["Cheese", "Rare"], "Rare"),
        6: (["Apple", "Bread", "Cheese"], "Cheese"),
        8: (["Apple", "Bread", "Cheese"], "Cheese"),
    }


def test_frequency_counts_raw_lines(data):
    lines, products, _ = data
    counts = {r["product_id"]: r["item_count"] for r in I.item_frequency(lines).collect()}
    assert counts[1] == 5 and counts[2] == 4
    sales = [tuple(r) for r in I.top_items(I.item_sales(I.item_frequency(lines), products), 2).collect()]
    assert sales == [("Bread", 6), ("Apple", 5)]


def test_unpruned_baskets_name_unknown_products_and_keep_missing_metadata(data):
    lines, products, orders = data
    got = {r["order_id"]: r for r in B.build_unpruned_baskets(lines, orders, products).collect()}
    assert got[3]["items"] == ["Product_8", "Rare"]
    assert got[8]["user_id"] is None and got[8]["items_count"] == 3
    assert 5 not in got


def test_exclusion_groups_reconcile(data):
    lines, products, orders = data
    catalog = B.core_catalog(lines, products, 3)
    profiles = B.audit_profiles(lines, orders, catalog).cache()
    groups = {r["order_id"]: r["exclusion_group"] for r in profiles.collect()}
    # 1 and 2 and 3 are core (at least three lines), 4 occurs twice
    assert groups == {1: "qualified", 2: "G1", 3: "G2", 4: "G3", 5: "G3", 6: "qualified", 7: "G0"}
    rows = B.exclusion_breakdown(profiles).collect()
    assert sum(r["orders_count"] for r in rows) == 5
    assert {r["group_id"]: r["percentage"] for r in rows}["G3"] == "40.00%"
    after = {r["metric"]: r for r in B.before_after(profiles).collect()}
    assert after["orders"]["removed_records"] == 5
    assert after["transactions"]["removed_records"] == (
        after["transactions"]["removed_duplicates"] + after["transactions"]["removed_rare"]
    )


def test_same_name_group_and_trace(data):
    lines, products, orders = data
    profiles = B.audit_profiles(lines, orders, B.core_catalog(lines, products, 2))
    traced = {r["order_id"]: r for r in TR.trace_orders(profiles, 1, 7).collect()}
    assert traced[5]["items_after_count"] == 2 and traced[5]["items_after_sample"] == ["Bread"]
    assert traced[1]["status"] == "Chấp nhận (Qualified)" and traced[1]["items_before_count"] == 3
    assert traced[1]["reason"] == "Đủ điều kiện (>= 2 món cốt lõi: 2 món)"
    assert traced[2]["reason"] == "Nhóm 1: Đơn vốn chỉ có 1 món ban đầu (C_raw = 1)"
    assert traced[3]["reason"] == "Nhóm 3: Sau lọc chỉ còn 1 món cốt lõi (Rare)"
    assert traced[7]["items_before_count"] == 0
    assert TR.trace_orders(profiles, 2, 3).count() == 2
    assert {r["order_id"] for r in TR.sample_records(TR.trace_orders(profiles)).collect()} == {1, 4, 6}


def test_first_orders(data):
    lines, _, orders = data
    chosen, theirs = B.first_orders(orders, lines, 3)
    assert sorted(r["order_id"] for r in chosen.collect()) == [1, 2, 3]
    assert {r["order_id"] for r in theirs.collect()} == {1, 2, 3} and theirs.count() == 7


def test_empty_input(spark, data):
    _, products, orders = data
    none = spark.createDataFrame([], LINES)
    assert B.build_baskets(none, products, 2).count() == 0
    profiles = B.audit_profiles(none, orders, B.core_catalog(none, products, 2))
    rows = {r["group_id"]: r["orders_count"] for r in B.exclusion_breakdown(profiles).collect()}
    assert rows == {"G0": 7, "G1": 0, "G2": 0, "G3": 0, "G4": 0}
    empty = B.exclusion_breakdown(profiles.filter(F.lit(False))).collect()
    assert all(r["percentage"] is None for r in empty)


def test_hot_order_and_hot_product(spark, no_broadcast):
    """A third of the lines in one order, a third in one product, and no broadcast join."""
    random.seed(5)
    rows = [(0, random.randrange(50), i) for i in range(3000)]
    rows += [(random.randrange(1, 500), 7, i) for i in range(3000)]
    rows += [(random.randrange(1, 500), random.randrange(50), i) for i in range(3000)]
    lines = spark.createDataFrame(rows, LINES).repartition(6)
    products = spark.createDataFrame([(i, f"p{i // 2:02d}") for i in range(50)], PRODUCTS)
    want = {}
    counts = {}
    for _, p, _ in rows:
        counts[p] = counts.get(p, 0) + 1
    core = {p for p, n in counts.items() if n >= 115}
    for o, p, _ in rows:
        if p in core:
            want.setdefault(o, set()).add(f"p{p // 2:02d}")
    got = {r["order_id"]: r["items"] for r in B.build_baskets(lines, products, 115).collect()}
    assert got == {o: sorted(s) for o, s in want.items() if len(s) >= 2}


def test_audit_reads_and_shuffles_the_lines_once(spark, data, tmp_path):
    rows, products, orders = data
    rows.write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    catalog = B.core_catalog(lines, products, 2)
    plan = B.exclusion_breakdown(B.audit_profiles(lines, orders, catalog))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/lines]") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L, product_id#\d+L", plan)) == 1


def test_facts_give_the_same_baskets_as_the_lines(data):
    lines, products, _ = data
    catalog = B.core_catalog(lines, products, 2)
    for size in (1, 2):
        one = B.baskets_of(order_facts(lines, catalog), size)
        two = B.catalog_baskets(lines, catalog, size)
        assert one.columns == two.columns and sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
