"""Times the steps of the whole job on many copies of the sf0.1 lines.

Run by hand:  python bench/scale.py [copies] [shuffle_partitions] [steepness] [hot_order_share]

Spark derives the input from the given tables: every copy shifts the order ids and
draws products anew with a steep popularity curve, so one product alone holds a large
share of all lines (steepness 4: 8 %, 9: a third) and baskets differ between copies.  A
share of all lines can be moved into one single order.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from basketlab.operators import baskets as B  # noqa: E402
from basketlab.operators import items as I  # noqa: E402
from basketlab.operators import mining as M  # noqa: E402
from basketlab.operators import quality as Q  # noqa: E402
from basketlab.operators import recommend as R  # noqa: E402
from basketlab.operators import evaluate as E  # noqa: E402
from basketlab.operators import temporal as T  # noqa: E402
from basketlab.session import local_session  # noqa: E402
from basketlab.sinks import publish as P  # noqa: E402
from basketlab.sources import retail  # noqa: E402
from basketlab.storage import materialize, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    partitions = int(sys.argv[2]) if len(sys.argv) > 2 else 64
    steepness = float(sys.argv[3]) if len(sys.argv) > 3 else 4.0
    hot_order = float(sys.argv[4]) if len(sys.argv) > 4 else 0.0
    spark = local_session(
        cores=os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=partitions, driver_memory="20g"
    )
    base = retail.load_star(spark, SF_DIR)
    n_products = base.products.count()
    n_orders = base.orders.agg(F.max("order_id")).first()[0] + 1
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    draw = F.pmod(F.xxhash64("copy", "order_id", "product_id"), F.lit(1_000_000)) / 1_000_000
    # the source is one row group; spread the copies so that scans use all cores
    lines = materialize(
        base.lines.repartition(partitions).select("*", copy).select(
            F.when(draw * 7919 % 1 < hot_order, F.lit(0).cast("long"))
            .otherwise(F.col("order_id") + F.col("copy") * n_orders)
            .alias("order_id"),
            F.floor(F.pow(draw, steepness) * n_products).alias("product_id"),
            "add_to_cart_order",
        ),
        "lines",
    )
    orders = materialize(
        base.orders.repartition(partitions).select("*", copy).select(
            (F.col("order_id") + F.col("copy") * n_orders).alias("order_id"),
            "user_id",
            F.pmod(F.col("order_id"), F.lit(7)).cast("int").alias("order_dow"),
            F.pmod(F.xxhash64("order_id"), F.lit(24)).cast("int").alias("order_hour_of_day"),
        ),
        "orders",
    )
    products = base.products.select(
        "product_id", F.concat_ws(" ", "product_name", F.format_string("%06d", "product_id")).alias("product_name")
    )
    seconds: dict[str, float] = {}

    def timed(step, work):
        started = time.perf_counter()
        result = work()
        seconds[step] = round(time.perf_counter() - started, 2)
        return result

    rows = lines.count()
    min_freq = rows // 2000
    timed("temporal", lambda: T.reconciliation(orders).collect())
    frequency = timed("item_frequency", lambda: materialize(I.item_frequency(lines), "frequency"))
    catalog = timed("core_catalog", lambda: B.core_catalog(lines, products, min_freq, frequency))
    facts = timed("order_facts", lambda: materialize(Q.order_facts(lines, catalog), "facts"))
    timed(
        "integrity",
        lambda: Q.integrity_report(lines, orders, products, facts, frequency).collect(),
    )
    baskets = B.baskets_of(facts)
    profiles = timed(
        "exclusion_audit",
        lambda: materialize(B.order_profiles(facts, orders), "profiles"),
    )
    n = baskets.count()
    itemsets = timed("itemsets", lambda: M.mine(baskets, 0.003, n))
    rules = timed(
        "rules",
        # drawn independently, so no lift limit: every confident rule is served below
        lambda: materialize(M.association_rules(itemsets, n, 0.03), "rules"),
    )
    popular = materialize(I.item_sales(frequency, products), "popular")
    carts = baskets.select(F.col("order_id").alias("cart_id"), "items")
    served = timed(
        "recommend",
        lambda: R.recommend_with_fallback(carts, rules, popular)
        .agg(F.count(F.lit(1)).alias("rows"), F.max("rank"), F.max("rule"), F.max("lift"))
        .first(),
    )
    timed("evaluate", lambda: E.evaluate(baskets, rules, popular, F.lit(catalog.count())).collect())
    timed(
        "store_baskets",
        lambda: P.write_baskets(B.basket_documents(baskets, orders), scratch_path(spark, "store")),
    )
    timed("sweep", lambda: M.sweep(itemsets, n).collect())
    hottest = frequency.agg(F.max("item_count")).first()[0]
    print(
        json.dumps(
            {
                "lines": rows,
                "orders": orders.count(),
                "baskets": n,
                "core_items": catalog.count(),
                "hottest_item_share": round(hottest / rows, 4),
                "hottest_order_share": round(
                    facts.agg(F.max("raw_lines")).first()[0] / rows, 4
                ),
                "itemsets": itemsets.count(),
                "rules": rules.count(),
                "recommended_rows": served["rows"],
                "excluded": profiles.filter(F.col("exclusion_group") != B.QUALIFIED).count(),
                "seconds": seconds,
                "total": round(sum(seconds.values()), 2),
            }
        )
    )


if __name__ == "__main__":
    main()
