import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from basketlab.operators import recommend as R
from basketlab.operators.temporal import orders_per_dow_hour
from basketlab.sources.schemas import CARTS, RULES
from basketlab.storage import materialize
from basketlab.streaming import carts as SC
from basketlab.streaming import density as SD
from test_recommend import POPULAR, RULE_ROWS

TIMES = T.StructType([T.StructField("ts", T.TimestampNTZType())])


@pytest.fixture(scope="module")
def model(spark):
    rules = materialize(spark.createDataFrame(RULE_ROWS, RULES), "rules")
    popular = spark.createDataFrame(
        [(item, 100 - i) for i, item in enumerate(POPULAR)], "item string, total_sales long"
    )
    return rules, materialize(popular, "popular")


def test_carts_arriving_in_files(spark, model, tmp_path):
    rules, popular = model
    given = spark.createDataFrame(
        [(0, ["A"]), (1, ["A", "D"]), (2, ["Q"]), (3, []), (4, ["B"])], CARTS
    )
    arriving, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    given.filter("cart_id < 2").coalesce(1).write.parquet(arriving)

    def score():
        SC.score_carts(
            SC.cart_stream(spark, arriving, 1), rules, popular, out, state
        ).awaitTermination()
        return {tuple(r) for r in spark.read.parquet(out).drop("batch_id").collect()}

    score()
    given.filter("cart_id >= 2").coalesce(1).write.mode("append").parquet(arriving)
    batch = {tuple(r) for r in R.recommend_with_fallback(given, rules, popular).collect()}
    assert score() == batch
    # nothing new: the result stays as it is
    assert score() == batch


def write_times(spark, path, stamps):
    spark.createDataFrame([(s,) for s in stamps], TIMES).coalesce(1).write.mode("append").parquet(path)


def run_density(spark, path, out, state):
    times = SD.order_time_stream(spark, path, TIMES, max_files_per_trigger=1)
    SD.keep_hourly_counts(SD.hourly_counts(times, "2 hours"), out, state).awaitTermination()
    return SD.current_counts(spark, out)


def test_density_equals_batch_and_drops_late_rows(spark, tmp_path):
    path, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    start = datetime(2024, 1, 7, 0, 30)
    write_times(spark, path, [start + timedelta(minutes=20 * i) for i in range(60)])
    run_density(spark, path, out, state)
    # a later hour, and a row that is late but within the delay
    write_times(spark, path, [start + timedelta(hours=21), start + timedelta(hours=18, minutes=40)])
    hours = run_density(spark, path, out, state)
    batch = orders_per_dow_hour(
        spark.read.schema(TIMES).parquet(path).select(
            (F.dayofweek("ts") - 1).alias("order_dow"), F.hour("ts").alias("order_hour_of_day")
        )
    )
    streamed = {tuple(r) for r in SD.density_from_hours(hours).collect()}
    assert streamed == {tuple(r) for r in batch.collect()}
    # a replayed batch changes nothing, and only the last two batches keep open hours
    kept = {tuple(r) for r in hours.collect()}
    last = max(int(f.name[9:]) for f in (tmp_path / "out").glob("batch_id=*"))
    changed = hours.filter("hour_start >= '2024-01-07 18:00:00'")
    SD.store_hours(materialize(changed, "replay"), last, out)
    assert {tuple(r) for r in SD.current_counts(spark, out).collect()} == kept
    assert len(list((tmp_path / "out").glob("batch_id=*/closed=false"))) <= 2
    assert list((tmp_path / "out").glob("batch_id=*/closed=true"))
    # far beyond the delay: dropped
    write_times(spark, path, [start])
    late = {tuple(r) for r in SD.density_from_hours(run_density(spark, path, out, state)).collect()}
    assert late == streamed


def test_files_stay_few_over_many_batches(spark, tmp_path):
    """200 batches of one new hour each: closed hours move into one file, also when batches are replayed."""
    out = tmp_path / "out"
    start, want = datetime(2024, 3, 1), {}
    most = 0
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    for batch_id in range(200):
        at = start + timedelta(hours=batch_id)
        again = start + timedelta(hours=max(0, batch_id - 1))  # the hour before still gets orders
        rows = {(again, 4): batch_id + 1000, (at, 4): batch_id + 1}
        want.update(rows)
        values = ", ".join(f"(TIMESTAMP '{h}', {d}, {h.hour}, {n}L)" for (h, d), n in rows.items())
        batch = spark.sql(f"SELECT * FROM VALUES {values} AS t(hour_start, dow, hour, orders_count)")
        for _ in range(2 if batch_id % 20 in (0, 19) else 1):
            SD.store_hours(batch, batch_id, str(out))
        if batch_id % 10 == 9:
            most = max(most, sum(1 for _ in out.rglob("*.parquet")))
    assert most <= 3 * SD.MERGE_EVERY + 4 and len(list(out.glob("batch_id=*"))) <= SD.MERGE_EVERY + 2
    got = {(r["hour_start"], r["dow"]): r["orders_count"] for r in SD.current_counts(spark, str(out)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == want and SD.current_counts(spark, str(out)).count() == 200


def test_a_batch_of_carts_counts_no_items(spark, model):
    """Rules and sales are keyed once; the plan of a batch aggregates by cart only and moves no offers."""
    rules, popular = model
    ready = R.prepare(rules, popular, 4)
    batch = spark.createDataFrame([(0, ["A", "D"]), (1, ["Q"])], CARTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        served = R.recommend_with_fallback(batch, rules, popular, serving=ready)
        plan = served._jdf.queryExecution().executedPlan().toString()
        rows = served.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan)
    assert keys and all("cart_id" in k for k in keys)
    assert "Bucketed: true" in plan and {r["cart_id"] for r in rows} == {0, 1}
