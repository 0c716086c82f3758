import json

import pytest
from pyspark.sql import functions as F

from basketlab import versions
from basketlab.operators import mining as M
from basketlab.plans import evaluation as EV
from basketlab.plans import market_basket as MB
from basketlab.plans.runs import RunRecorder, merge_live_row
from basketlab.sinks import publish as P
from basketlab.sources import logs, retail, schemas, tables
from basketlab.storage import materialize, scratch_path, shared_root
from conftest import SMALL


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        "1,7,prior,1,0,9,\n2,7,prior,2,3,10,5.0\n3,8,train,1,6,23,\n"
    )
    (tmp_path / "order_products__train.csv").write_text(
        "order_id,product_id,add_to_cart_order,reordered\n3,1,1,0\n3,2,2,1\n"
    )
    (tmp_path / "products.csv").write_text(
        'product_id,product_name,aisle_id,department_id\n1,"Tea, green",1,1\n2,Milk,9,1\n'
    )
    return tmp_path


def test_csv_layout_and_alternate_lines(spark, csv_dir):
    loaded = retail.load_csv(spark, str(csv_dir))
    assert loaded.lines.count() == 2
    assert retail.split_orders(loaded.orders, "prior").count() == 2
    assert loaded.products.filter("product_id = 1").first()["product_name"] == "Tea, green"
    (csv_dir / "order_products__prior.csv").write_text(
        "order_id,product_id,add_to_cart_order,reordered\n1,1,1,0\n"
    )
    assert retail.load_csv(spark, str(csv_dir)).lines.count() == 1


def test_whole_job_on_csv_sees_lines_without_an_order(spark, csv_dir, tmp_path):
    (csv_dir / "order_products__prior.csv").write_text(
        "order_id,product_id,add_to_cart_order,reordered\n1,1,1,0\n1,2,2,0\n2,2,1,0\n2,1,2,0\n9,1,1,0\n2,7,3,0\n"
    )
    out = str(tmp_path / "job")
    settings = MB.Settings(min_item_freq=2, min_confidence=0.1, min_lift=0.5)
    model = MB.run_pipeline(spark, retail.load_csv(spark, str(csv_dir)), settings, out, "csv")
    row = tables.read_table(spark, f"{out}/integrity").first()
    assert (row["total_lines"], row["orphan_orders"], row["orphan_products"]) == (6, 1, 1)
    assert model.n_baskets == 2 and model.min_support == 1.0
    assert {tuple(r["antecedent"] + r["consequent"]) for r in model.rules.collect()} == {
        ("Milk", "Tea, green"),
        ("Tea, green", "Milk"),
    }
    report = json.loads(tables.read_table(spark, f"{out}/quality").toJSON().first())
    tables_ok = {t["table_name"]: t["foreign_key_valid"] for t in report["tables"]}
    # the catalog refers to aisles and departments, whose files are not there
    assert tables_ok == {
        "products": False, "orders": True, "order_products__train": True, "order_products__prior": False
    }
    orders = next(t for t in report["tables"] if t["table_name"] == "orders")
    assert (orders["total_rows"], orders["total_cols"], orders["null_count"]) == (3, 7, 2)
    summaries = [tables.read_table(spark, f"{out}/{name}").first() for name in ("summary_prior", "summary")]
    assert summaries[0] == summaries[1] and summaries[0]["training_time_seconds"] > 0
    assert tables.read_table(spark, f"{out}/itemset_totals").first()["total_1_itemsets"] == 2


def test_csv_without_lines_and_without_schema(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        retail.load_csv(spark, str(tmp_path))
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "x.csv"))


def test_enriched_products_keep_missing_parents_null(spark, csv_dir):
    products = tables.read_table(spark, str(csv_dir / "products.csv"), schemas.PRODUCTS)
    aisles = spark.createDataFrame([(1, "tea")], schemas.AISLES)
    departments = spark.createDataFrame([(1, "drinks")], schemas.DEPARTMENTS)
    rows = {r["product_id"]: r for r in retail.enriched_products(products, aisles, departments).collect()}
    assert rows[1]["aisle"] == "tea" and rows[2]["aisle"] is None and rows[2]["department"] == "drinks"


def test_count_or_zero(spark, csv_dir):
    assert tables.count_or_zero(spark, str(csv_dir / "aisles.csv"), schemas.AISLES) == 0
    assert tables.count_or_zero(spark, str(csv_dir / "products.csv"), schemas.PRODUCTS) == 2


def test_fallback_chain_ends_in_an_empty_table(spark, tmp_path):
    df, source = tables.read_first_available(spark, [str(tmp_path / "a"), str(tmp_path / "b")], schemas.RULES)
    assert source == "none" and df.count() == 0 and df.schema == schemas.RULES


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root and scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    stored = materialize(spark.range(5).toDF("id"), "ids")
    assert stored.count() == 5 and all(root in f for f in stored.inputFiles())


LOG = """2024-01-01 INFO  [SparkContext] Running Spark version 4.1.2
INFO SparkSession & JVM Context initialized in 18.70s. Master: local
INFO Job 0 finished in 14.04s. Processed
INFO Job 0 finished in 15.04s. Processed
INFO Job 1 finished in 2.56s.
INFO Job 2 finished in 7.05s.
INFO Job 3 finished in 33.33s.
INFO Job 4 (FPGrowth.fit) finished in 62.60s.
INFO Step 6 completed in 143.10s.
INFO Total Pipeline Run Duration: 923.27 seconds.
"""


def test_log_marks(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text(LOG)
    timings = logs.checked_timings(logs.log_marks(logs.read_log_lines(spark, str(path))))
    assert timings["job0"] == 15.04 and timings["total"] == 923.27 and timings["spark_version"] == "4.1.2"


def test_last_mark_follows_time_then_part_number(spark, tmp_path):
    line = "INFO Job 0 finished in {}s."
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "part-99999-a.txt").write_text(line.format(1) + "\n" + line.format(2))
    (plain / "part-100000-a.txt").write_text(line.format(3) + "\n" + line.format(4))
    stamped = tmp_path / "stamped"
    stamped.mkdir()
    (stamped / "part-00001.txt").write_text("2024-01-02 10:00:00,250 " + line.format(5) + "\n24/01/02 09:59:59 " + line.format(6))
    (stamped / "part-00002.txt").write_text("2024-01-02T10:00:00.249 " + line.format(7) + "\n" + line.format(8))
    same = tmp_path / "same"
    same.mkdir()
    for part in (99999, 100000):
        (same / f"part-{part}.txt").write_text(f"24/01/02 09:59:59 {line.format(part)}")
    (same / "part-100001.txt").write_text("24/13/45 09:59:59 " + line.format(9))

    def last(folder):
        return logs.log_marks(logs.read_log_lines(spark, str(folder))).first()["value"]

    assert (last(plain), last(stamped), last(same)) == ("4", "5", "100000")


def test_log_without_required_mark_or_version(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text("\n".join(LOG.splitlines()[1:]))
    marks = logs.log_marks(logs.read_log_lines(spark, str(path)))
    assert logs.checked_timings(marks)["spark_version"] == spark.version
    with pytest.raises(ValueError, match="job3"):
        logs.checked_timings(marks.filter(F.col("mark") != "job3"))


def test_export_stays_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], schemas.BASKET_LINES)
    path = str(tmp_path / "out.json")
    P.export_baskets_json(df, path)
    P.export_baskets_json(df.union(df), path)
    assert [tuple(r) for r in tables.read_baskets_json(spark, path).collect()] == [(1, ["a", "b"])]


class Broken(Exception):
    pass


def broken_after(files_written, df, tmp_path):
    """Writes like a job that dies: some files of the new folder are there, then the driver is gone."""

    def write(folder):
        df.write.parquet(f"{folder}/part")
        files_written.append(folder)
        raise Broken

    return write


def test_broken_write_leaves_the_old_rows(spark, tmp_path):
    path, left = str(tmp_path / "rules"), []
    P.write_table(spark.range(5), path)
    with pytest.raises(Broken):
        versions.replace(spark, path, broken_after(left, spark.range(9), tmp_path))
    assert left and tables.read_table(spark, path).count() == 5
    # a job that failed inside Spark leaves them too
    with pytest.raises(Exception, match="bad row"):
        P.write_table(spark.range(9).select(F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("bad row")))), path)
    assert tables.read_table(spark, path).count() == 5
    P.write_table(spark.range(7), path)
    assert tables.read_table(spark, path).count() == 7
    # the remains are gone; the version before stays for those who still read it
    folders = [f.name for f in tmp_path.joinpath("rules").iterdir() if f.name.startswith("data-")]
    assert len(folders) == 2 and not any(f in folder for folder in left for f in folders)


def test_half_written_store_is_rewritten_under_keep(spark, tmp_path):
    documents = spark.createDataFrame([(1, ["a"]), (2, ["b"])], schemas.BASKET_LINES)
    path = str(tmp_path / "baskets")
    documents.limit(1).write.parquet(path)  # files without a manifest
    (tmp_path / "baskets" / "_SUCCESS").unlink()
    with pytest.raises(Broken):
        versions.replace(spark, path, broken_after([], documents.limit(1), tmp_path))
    assert P.load_baskets(documents, path, "keep") is True
    assert tables.read_table(spark, path).count() == 2
    assert P.load_baskets(documents.limit(0), path, "keep") is False
    assert tables.read_table(spark, path, documents.schema).count() == 2


def test_of_two_writers_one_wins(spark, tmp_path):
    path = str(tmp_path / "t")

    def late(folder):
        P.write_table(spark.range(3), path)  # another job finishes first
        spark.range(8).write.parquet(folder)

    with pytest.raises(RuntimeError, match="another job"):
        versions.replace(spark, path, late)
    assert tables.read_table(spark, path).count() == 3


def test_readers_of_the_old_version_are_not_disturbed(spark, tmp_path):
    path = str(tmp_path / "t")
    P.write_table(spark.range(4), path, "json")
    old = tables.read_table(spark, path)
    P.write_table(spark.range(6), path)
    assert (old.count(), tables.read_table(spark, path).count()) == (4, 6)
    assert versions.current(spark, path).kind == "parquet"


def test_summary_is_patched_in_place(spark, tmp_path):
    path = str(tmp_path / "summary")
    P.write_table(spark.createDataFrame([(5, 7)], "total_orders long, total_rules long"), path, "json")
    P.patch_summary(tables.read_table(spark, path), {"total_rules": F.lit(9).cast("long")}, path)
    assert tables.read_table(spark, path).first().asDict() == {"total_orders": 5, "total_rules": 9}


def test_report_sections_are_bounded(spark):
    with pytest.raises(Exception, match="more than 5 rows"):
        spark.range(1).select(P.rows_as_array(spark.range(6), ["id"], 5)).collect()
    assert len(spark.range(1).select(P.rows_as_array(spark.range(5), ["id"], 5)).first()[0]) == 5


def test_patch_rejects_unknown_fields(spark, tmp_path):
    with pytest.raises(ValueError):
        P.patch_summary(spark.range(1), {"total": F.lit(1)}, str(tmp_path / "s"))


def test_live_row_keeps_the_sweep_counts(spark):
    columns = "config_id string, frequent_itemsets long, association_rules long, max_lift double"
    sweep = spark.createDataFrame([("EXP-02", 5, 2, 4.5), ("EXP-03* (x)", 6, 3, 4.4)], columns)
    live = spark.createDataFrame([(350, 102)], "frequent_itemsets long, association_rules long")
    rows = {r["config_id"]: r for r in merge_live_row(sweep, live).collect()}
    assert rows["EXP-02"]["frequent_itemsets"] == 5 and rows["EXP-02"]["measured_by"] == "sweep"
    star = rows["EXP-03* (x)"]
    assert (star["frequent_itemsets"], star["association_rules"], star["max_lift"]) == (350, 102, 4.4)
    assert star["sweep_association_rules"] == 3 and star["measured_by"] == "live run"


def test_recorder(spark):
    recorder = RunRecorder(spark, "r")
    recorder.run("count", 3, lambda: spark.range(2))
    with recorder.step("write", 2) as out:
        out["rows_out"] = 2
    rows = recorder.metrics().orderBy("step_num").collect()
    assert [(r["step"], r["rows_in"], r["rows_out"]) for r in rows] == [("count", 3, 2), ("write", 2, 2)]
    assert all(r["seconds"] >= 0 and r["finished_at"] for r in rows)


@pytest.fixture
def many_files(spark):
    """Small partitions stay apart, as those of large data do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def scanned_rows(spark, df):
    """Result of a lookup and the rows that its scan handed on: those of row groups that were not skipped."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    nothing = gateway.new_array(gateway.jvm.double, 0)

    def total():
        stages = store.stageList(None, False, False, nothing, None)
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    rows = df.collect()
    return rows, total() - before


def test_lookups_skip_what_does_not_hold_the_item(spark, tmp_path, many_files):
    names = [f"i{n:05d}" for n in range(5000)]
    rules = spark.createDataFrame(
        [(sorted([names[n], names[(n * 7) % 5000], "hot"]), [names[n - 1]], 0.5, 2.0, 0.1) for n in range(1, 5000)], schemas.RULES
    )
    path = str(tmp_path / "postings")
    P.write_postings(rules, "antecedent", path)
    postings = tables.read_table(spark, path)
    every = postings.count()
    for item in ("i00042", "i04999", "absent"):
        got, read = scanned_rows(spark, M.posted(postings, item))
        assert sorted(map(tuple, got)) == sorted(map(tuple, M.rules_with_antecedent_item(rules, item).collect()))
        assert read < every / 2 and (item != "absent" or read == 0)
    wanted = rules.filter("array_contains(antecedent, 'i00042')").first()
    ask = list(reversed(wanted["antecedent"]))
    got, read = scanned_rows(spark, M.posted_rule(postings, ask, wanted["consequent"]))
    assert [r["consequent"] for r in got] == [wanted["consequent"]] and read < every
    itemsets = rules.select(F.col("antecedent").alias("items"), F.size("antecedent").alias("k"), F.lit(5).cast("long").alias("frequency"), "support")
    P.write_postings(itemsets, "items", path + "2")
    got, read = scanned_rows(spark, M.posted_itemset(tables.read_table(spark, path + "2"), ["i00043", "hot", "i00301"]))
    assert [r["items"] for r in got] == [["hot", "i00043", "i00301"]] and read < every / 2


def test_whole_job_publishes_consistent_results(spark, tmp_path):
    settings = MB.Settings(min_item_freq=8, min_support=0.01, min_confidence=0.05, min_lift=1.0)
    out = str(tmp_path / "job")
    data = retail.load_star(spark, SMALL)
    model = MB.run_pipeline(spark, data, settings, out, "run-1")
    MB.run_pipeline(spark, data, settings, out, "run-2")
    runs = spark.read.parquet(f"{out}/runs")
    assert runs.select("run_id").distinct().count() == 2
    assert runs.groupBy("run_id").count().first()["count"] >= 5
    baskets = tables.read_table(spark, f"{out}/baskets", schemas.BASKET_DOCUMENTS)
    assert baskets.count() == model.n_baskets > 0
    assert baskets.filter(F.size("items") != F.size(F.array_distinct("items"))).count() == 0
    assert baskets.agg(F.min("items_count")).first()[0] >= 2
    report = json.loads(tables.read_table(spark, f"{out}/quality").toJSON().first())
    kpis = report["kpis"]
    assert kpis["valid_baskets"] + kpis["excluded_baskets"] == kpis["total_prior_orders"]
    assert sum(g["orders_count"] for g in report["excluded_orders_breakdown"]) == kpis["excluded_baskets"]
    assert kpis["valid_baskets"] == model.n_baskets
    rules = tables.read_table(spark, f"{out}/rules")
    assert rules.count() == tables.read_table(spark, f"{out}/rules_prior").count() == model.rules.count() > 0
    assert rules.filter("lift <= 1.0 OR confidence <= 0 OR confidence > 1").count() == 0
    itemsets = tables.read_table(spark, f"{out}/itemsets")
    assert itemsets.filter(F.col("k") != F.size("items")).count() == 0
    summary = json.loads(tables.read_table(spark, f"{out}/summary").toJSON().first())
    assert summary["total_orders"] == kpis["total_prior_orders"]
    assert len(summary["top_products"]) == 15
    EV.publish_evaluation(model, model.baskets, F.lit(64), out)
    evaluation = json.loads(tables.read_table(spark, f"{out}/evaluation").toJSON().first())
    assert evaluation["baskets_queried"] == model.n_baskets
    assert [m["k"] for m in evaluation["metrics_by_k"]] == [3, 5, 10]
    experiments = [r["config_id"] for r in tables.read_table(spark, f"{out}/experiments").collect()]
    assert len(experiments) == 5  # also those below the support mined at
    assert M.itemset_counts(itemsets).first()["total_itemsets"] == itemsets.count()


def test_parameter_study(spark):
    data = retail.load_star(spark, SMALL)
    rows = EV.parameter_study(data, [("a", 0.01, 0.05), ("b", 0.03, 0.05)], MB.Settings(min_item_freq=8, mining_partitions=3)).collect()
    assert [r["config_id"] for r in rows] == ["a", "b"]
    assert rows[0]["frequent_itemsets"] > rows[1]["frequent_itemsets"] > 0
    assert all(0 <= r["training_seconds"] <= r["total_seconds"] for r in rows)


def test_threshold_or_support_is_needed(spark):
    with pytest.raises(ValueError):
        MB.train(retail.load_star(spark, SMALL), MB.Settings(min_item_freq=None))


def test_the_split_is_filtered_in_the_scan(spark):
    orders = MB.in_scope(retail.load_star(spark, SMALL), MB.Settings()).orders
    assert "EqualTo(o_orderstatus,F)" in orders._jdf.queryExecution().executedPlan().toString()


def test_train_lines_alone_make_a_whole_run(spark, tmp_path):
    star = retail.load_star(spark, SMALL)
    orders = star.orders.withColumns({"order_number": F.lit(1), "days_since_prior_order": F.lit(None).cast("double")})
    orders.write.option("header", True).csv(f"{tmp_path}/orders.csv")
    of_train = star.orders.where("eval_set = 'train'").select("order_id")
    lines = star.lines.join(of_train, "order_id", "left_semi").withColumn("reordered", F.lit(0))
    lines.select("order_id", "product_id", "add_to_cart_order", "reordered").write.option("header", True).csv(
        f"{tmp_path}/order_products__train.csv"
    )
    products = star.products.withColumns({"aisle_id": F.lit(1), "department_id": F.lit(1)})
    products.write.option("header", True).csv(f"{tmp_path}/products.csv")
    settings = MB.Settings(min_item_freq=None, min_support=0.02, min_confidence=0.05, min_lift=1.0, mining_partitions=3)
    model = MB.run_pipeline(spark, retail.load_csv(spark, str(tmp_path)), settings, f"{tmp_path}/out", "run")
    assert tables.read_table(spark, f"{tmp_path}/out/baskets").count() == model.n_baskets > 0
    integrity = tables.read_table(spark, f"{tmp_path}/out/integrity").first().asDict()
    assert not any(v for k, v in integrity.items() if "orphan" in k)
