import pytest
from pyspark.sql import functions as F

from basketlab.operators import quality as Q
from basketlab.operators import temporal as T
from basketlab.plans import queries
from basketlab.sources import schemas
from conftest import SMALL

LINES = "order_id long, product_id long, add_to_cart_order int"


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [(1, 1, 1), (1, 1, 2), (1, 2, 3), (2, 1, 1), (None, 1, 1), (3, None, 1), (3, 9, 2)], LINES
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "product_id long, product_name string")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([(1,), (2,)], "order_id long")


def test_integrity(lines, orders, products):
    assert Q.integrity_report(lines, orders, products).first().asDict() == {
        "total_lines": 7,
        "distinct_pairs": 6,
        "duplicate_pairs": 1,
        "null_keys": 2,
        "null_cells": 2,
        "orphan_orders": 3,
        "orphan_products": 2,
    }


def test_integrity_of_nothing(spark, lines, orders, products):
    row = Q.integrity_report(lines.filter(F.lit(False)), orders, products).first()
    assert set(row.asDict().values()) == {0}


def test_dedup_keeps_the_first_position(lines):
    kept = {(r["order_id"], r["product_id"]): r["add_to_cart_order"] for r in Q.dedup_lines(lines).collect()}
    assert kept[1, 1] == 1 and len(kept) == 6


def test_duplicates_across_partitions(lines):
    spread = lines.repartition(7)
    assert Q.duplicate_keys(spread, ["order_id", "product_id"]).first()["surplus_rows"] == 1
    assert Q.pk_duplicates(spread, "lines", ["order_id", "product_id"]).first()["duplicates"] == 1


def test_audit_row(lines, orders, products):
    row = Q.audit_table(
        lines,
        "lines",
        ["order_id", "product_id"],
        [("product_id", products, "product_id"), ("order_id", orders, "order_id")],
    ).first()
    assert row["null_count"] == 2 and row["null_rate"] == "9.52%"
    assert row["duplicates"] == 1 and row["foreign_key_valid"] is False
    assert Q.audit_table(products, "products", ["product_id"]).first()["foreign_key_valid"] is True


def test_audit_reads_a_table_once_for_all_its_references(spark, lines, orders, products, tmp_path):
    lines.withColumn("supplier_id", F.lit(4)).write.parquet(f"{tmp_path}/lines")
    stored = spark.read.parquet(f"{tmp_path}/lines")
    suppliers = spark.createDataFrame([(4,), (4,), (5,)], "supplier_id int")
    references = [
        ("product_id", products, "product_id"), ("order_id", orders, "order_id"), ("supplier_id", suppliers, "supplier_id")
    ]
    facts = Q.audit_facts(stored, ["order_id", "product_id"], references)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/lines") == 1
    # a parent key that repeats counts no line twice
    assert facts.first().asDict() == {"total_rows": 7, "null_count": 2, "duplicates": 1, "orphans": [2, 3, 0]}
    assert "ENSURE_REQUIREMENTS" in plan and plan.count("Exchange hashpartitioning(ref#") <= 2 + len(references)


def test_audit_with_text_keys_and_odd_names(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("0", 0)], "`code.x` string, n int")
    parents = spark.createDataFrame([("a",), ("0",), (None,)], "id string")
    counts = spark.createDataFrame([(1,), (0,)], "n long")
    facts = Q.audit_facts(rows, ["code.x", "n"], [("code.x", parents, "id"), ("n", counts, "n")]).first()
    assert (facts["total_rows"], facts["duplicates"], facts["orphans"]) == (4, 1, [1, 1])


@pytest.mark.parametrize("broken", [False, True])
def test_supplier_is_audited(spark, broken, tmp_path):
    """A line with an unknown supplier, a supplier with an unknown nation, and one that is there twice show."""
    for name in schemas.STAR:
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    if broken:
        first = spark.read.parquet(f"{SMALL}/supplier.parquet").limit(1)
        first.withColumn("s_nationkey", F.lit(99)).write.mode("append").parquet(f"{tmp_path}/supplier.parquet")
        line = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(1)
        line.withColumn("l_suppkey", F.lit(-1).cast("long")).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    rows = {r["table_name"]: r for r in queries.REGISTRY["table_audit"](spark, str(tmp_path)).collect()}
    assert rows["supplier"]["foreign_key_valid"] is not broken and rows["lineitem"]["foreign_key_valid"] is not broken
    assert (rows["supplier"]["duplicates"] > 0) is broken
    assert rows.keys() == queries.PRIMARY_KEYS.keys() == schemas.STAR.keys()


def test_audit_of_an_empty_table(products):
    row = Q.audit_table(products.filter(F.lit(False)), "products", ["product_id"]).first()
    assert (row["total_rows"], row["null_rate"], row["duplicates"]) == (0, "0.00%", 0)


def test_orphan_rows_and_count_agree(lines, products, no_broadcast):
    rows = Q.orphan_rows(lines, "product_id", products, "product_id").count()
    assert rows == Q.orphan_count(lines, "product_id", products, "product_id").first()["orphans"] == 2


def test_scan_totals(spark):
    df = spark.createDataFrame(
        [(1, "prior", None), (1, "prior", 2.0), (2, "train", 3.0)],
        "order_id long, eval_set string, days_since_prior_order double",
    )
    assert Q.scan_totals(df, ["order_id"], "eval_set").first().asDict() == {
        "total_rows": 3,
        "null_count": 1,
        "duplicates": 1,
        "prior_orders": 2,
        "train_orders": 1,
    }
    assert tuple(Q.null_count(df, "days_since_prior_order").first()) == (3, 1)


def test_heat_map_order_fill_and_unknown_days(spark):
    times = spark.createDataFrame(
        [(0, 5), (0, 5), (6, 23), (1, 0), (9, 3), (None, 24)], "order_dow int, order_hour_of_day int"
    )
    density = T.orders_per_dow_hour(times)
    rows = T.heat_pivot(density).collect()
    assert [r["day"] for r in rows] == ["Thứ Hai", "Thứ Bảy", "Chủ Nhật", None]
    assert rows[3]["h03"] == 1 and rows[3]["other"] == 1
    assert rows[2]["h05"] == 2 and rows[2]["h06"] == 0
    assert "Ngày 9" in {r["day"] for r in T.day_labels(density).collect()}
    check = T.reconciliation(times).first()
    assert check["reconciled"] and check["total_orders"] == check["heat_total"] == 6


def test_the_time_profile_reads_the_orders_once(spark, tmp_path):
    times = spark.createDataFrame([(0, 5), (0, 5), (6, 23), (None, 5), (3, None)], "order_dow int, order_hour_of_day int")
    times.write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    rows = T.profile(orders)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
    got = {(r["kind"], r["dow"], r["hour"]): r["orders_count"] for r in rows.collect()}
    assert got[T.ALL, None, None] == 5 and got[T.HOUR, None, 5] == 3 and got[T.HOUR, None, None] == 1
    assert got[T.CELL, None, 5] == 1 and got[T.CELL, 0, 5] == 2 and got[T.CELL, 3, None] == 1
    # what the report reads is the written profile, never the orders
    report = T.reconciliation(orders)
    assert f"{tmp_path}/orders" not in report._jdf.queryExecution().executedPlan().toString()
    row = report.first()
    assert row["reconciled"] and row["hour_total"] == row["heat_total"] == 5 and row["cells"] == 4
    empty = T.reconciliation(orders.limit(0)).first()
    assert empty["total_orders"] == 0 and empty["reconciled"]
