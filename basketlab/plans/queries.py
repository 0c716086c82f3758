"""The registered queries: each reads the star schema below a folder.

Item arrays leave as joined text and measures rounded to six digits, so results can
be compared value by value with another engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketlab.functions import labels as L
from basketlab.functions import measures, text
from basketlab.operators import baskets as B
from basketlab.operators import evaluate as E
from basketlab.operators import items as I
from basketlab.operators import mining as M
from basketlab.operators import quality as Q
from basketlab.operators import recommend as R
from basketlab.operators import temporal as T
from basketlab.operators import trace as TR
from basketlab.plans import evaluation as EV
from basketlab.plans import market_basket as MB
from basketlab.plans import runs
from basketlab.sinks import publish as P
from basketlab.sources import logs, retail, schemas, tables
from basketlab.storage import materialize, scratch_path
from basketlab.streaming import carts as stream_carts
from basketlab.streaming import density as stream_density

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the queries on the star schema.
MIN_ITEM_FREQ = 33
MIN_SUPPORT = 0.003
MIN_CONFIDENCE = 0.05
MINING = MB.Settings(
    min_item_freq=None, min_support=MIN_SUPPORT, min_confidence=MIN_CONFIDENCE, split=None
)
MINING_PRIOR = MB.Settings(
    min_item_freq=None, min_support=MIN_SUPPORT, min_confidence=MIN_CONFIDENCE, split="prior"
)
MINING_FOLDS = MB.Settings(
    min_item_freq=None, min_support=MIN_SUPPORT, min_confidence=MIN_CONFIDENCE, split=None, hold_out=10
)
SWEEP = [
    *L.SWEEP_CONFIGS,
    ("FINE-01", 0.006, 0.08),
    ("FINE-02", 0.004, 0.06),
    ("FINE-03", 0.003, 0.05),
]
ITEM_KEYWORD = " Red "
RULE_KEYWORD = "BOLT "
LOOKUP_ITEM = "red plate"
EVALUATION_MEASURES = ["precision", "recall", "hit_rate", "coverage"]
PRIMARY_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_partkey"],
    "events": ["event_id"],
}
FOREIGN_KEYS = {
    "nation": [("n_regionkey", "region", "r_regionkey")],
    "customer": [("c_nationkey", "nation", "n_nationkey")],
    "supplier": [("s_nationkey", "nation", "n_nationkey")],
    "orders": [("o_custkey", "customer", "c_custkey")],
    "lineitem": [
        ("l_partkey", "part", "p_partkey"),
        ("l_orderkey", "orders", "o_orderkey"),
        ("l_suppkey", "supplier", "s_suppkey"),
    ],
    "events": [("user_id", "customer", "c_custkey")],
}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def joined(column: str | Column) -> Column:
    return F.array_join(column, "|")


def r6(column: str) -> Column:
    return F.round(F.col(column), 6).alias(column)


def retail_tables(spark: SparkSession, sf: str) -> retail.Retail:
    return retail.load_star(spark, sf)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return B.audit_profiles(
        r.lines, r.orders, B.core_catalog(r.lines, r.products, MIN_ITEM_FREQ)
    )


def pruned_baskets(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return B.build_baskets(r.lines, r.products, MIN_ITEM_FREQ)


def trained(spark: SparkSession, sf: str, settings: MB.Settings = MINING) -> MB.Model:
    return MB.train(retail_tables(spark, sf), settings)


def mined(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    r = retail_tables(spark, sf)
    baskets = materialize(B.build_baskets(r.lines, r.products).select("items"), "baskets")
    n = baskets.count()
    return M.mine(baskets, MIN_SUPPORT, n), n


def all_rules(spark: SparkSession, sf: str) -> DataFrame:
    itemsets, n = mined(spark, sf)
    return M.association_rules(itemsets, n, MIN_CONFIDENCE)


def shopper_carts(spark: SparkSession, sf: str, baskets: DataFrame) -> DataFrame:
    """Baskets of the orders outside the prior split, as carts."""
    others = retail.star_orders(spark, sf).filter(F.col("eval_set") != "prior")
    return baskets.join(others.select("order_id"), "order_id", "left_semi").select(
        F.col("order_id").alias("cart_id"), "items"
    )


def flat_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        joined("antecedent").alias("antecedent"),
        joined("consequent").alias("consequent"),
        r6("confidence"),
        r6("lift"),
        r6("support"),
    )


def flat_itemsets(itemsets: DataFrame) -> DataFrame:
    return itemsets.select(joined("items").alias("items"), "k", "frequency", r6("support"))


def flat_recommendations(df: DataFrame) -> DataFrame:
    return df.select(
        "cart_id", "rank", "item", "source", "rule", r6("confidence"), r6("lift"), r6("support")
    )


# --- orders, keys and nulls -------------------------------------------------------


@query
def split_orders(spark: SparkSession, sf: str) -> DataFrame:
    return retail.star_orders(spark, sf, "prior")


@query
def null_key_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = retail.star_lines(spark, sf)
    return Q.null_key_rows(lines, ["order_id", "product_id"]).agg(
        F.count(F.lit(1)).alias("null_key_rows")
    )


def order_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their line count, null for an order without lines."""
    counts = Q.key_counts(retail.star_lines(spark, sf), ["order_id"])
    return retail.star_orders(spark, sf).join(counts, "order_id", "left").select(
        "order_id", F.col("n").alias("line_count")
    )


@query
def null_column_count(spark: SparkSession, sf: str) -> DataFrame:
    return Q.null_count(order_sizes(spark, sf), "line_count")


@query
def null_cells_by_table(spark: SparkSession, sf: str) -> DataFrame:
    audits = [Q.null_audit(retail.star_table(spark, sf, t), t) for t in schemas.STAR]
    return Q.stack([*audits, Q.null_audit(order_sizes(spark, sf), "order_sizes")])


@query
def dup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return Q.duplicate_keys(retail.star_lines(spark, sf), ["order_id", "product_id"])


@query
def dedup_lines(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dedup_lines(retail.star_lines(spark, sf))


@query
def pk_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return Q.stack(
        [
            Q.pk_duplicates(retail.star_table(spark, sf, t), t, key)
            for t, key in PRIMARY_KEYS.items()
        ]
    )


@query
def table_audit(spark: SparkSession, sf: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return retail.star_table(spark, sf, name)

    return Q.stack(
        [
            Q.audit_table(
                table(t),
                t,
                key,
                [(column, table(p), pk) for column, p, pk in FOREIGN_KEYS.get(t, [])],
            )
            for t, key in PRIMARY_KEYS.items()
        ]
    )


@query
def scan_totals(spark: SparkSession, sf: str) -> DataFrame:
    return Q.scan_totals(retail.star_orders(spark, sf), ["order_id"], "eval_set")


@query
def orphan_parts(spark: SparkSession, sf: str) -> DataFrame:
    """All lines, and those whose product is not in the catalog."""
    r = retail_tables(spark, sf)
    return Q.orphan_count(r.lines, "product_id", r.products, "product_id", "orphan_lines")


@query
def orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose order is outside the prior split."""
    r = retail_tables(spark, sf)
    return Q.orphan_rows(r.lines, "order_id", r.orders_of("prior"), "order_id")


@query
def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return Q.integrity_report(r.lines, r.orders_of("prior"), r.products)


# --- time profiles ----------------------------------------------------------------


@query
def orders_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    return T.orders_per_hour(retail.star_timing(spark, sf))


@query
def orders_per_dow_hour(spark: SparkSession, sf: str) -> DataFrame:
    return T.day_labels(T.orders_per_dow_hour(retail.star_timing(spark, sf)))


@query
def heat_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return T.heat_pivot(T.orders_per_dow_hour(retail.star_timing(spark, sf)))


@query
def temporal_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return T.reconciliation(retail.star_timing(spark, sf))


# --- items and catalog ------------------------------------------------------------


@query
def item_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return I.item_frequency(retail.star_lines(spark, sf))


@query
def core_items(spark: SparkSession, sf: str) -> DataFrame:
    return I.core_items(I.item_frequency(retail.star_lines(spark, sf)), MIN_ITEM_FREQ)


@query
def top_items(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return I.top_items(I.item_sales(I.item_frequency(r.lines), r.products))


@query
def top_products(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    core = I.core_items(I.item_frequency(r.lines), MIN_ITEM_FREQ)
    return I.top_products(core, r.products)


@query
def popular_items(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best sellers, a report."""
    return I.top_items(MB.popular_items(retail_tables(spark, sf)), L.POPULAR_REPORT_ITEMS)


@query
def catalog_denormalised(spark: SparkSession, sf: str) -> DataFrame:
    return retail.denormalise(
        retail.star_table(spark, sf, "customer"),
        [
            (retail.star_table(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
            (retail.star_table(spark, sf, "region"), "n_regionkey", "r_regionkey"),
        ],
    ).select("c_custkey", "c_name", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query
def catalog_lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    """Names of sold products where only core products have one."""
    r = retail_tables(spark, sf)
    names = B.core_catalog(r.lines, r.products, MIN_ITEM_FREQ)
    sold = I.item_frequency(r.lines)
    return sold.join(names, "product_id", "left").select(
        "product_id",
        "item_count",
        text.default_name(F.col("product_name"), F.col("product_id"), L.LOADER_DEFAULT_NAME).alias(
            "loader_name"
        ),
        text.default_name(F.col("product_name"), F.col("product_id"), L.TRACE_DEFAULT_NAME).alias(
            "trace_name"
        ),
    )


# --- baskets ----------------------------------------------------------------------


@query
def baskets(spark: SparkSession, sf: str) -> DataFrame:
    return pruned_baskets(spark, sf).withColumn("items", joined("items"))


@query
def baskets_unpruned(spark: SparkSession, sf: str) -> DataFrame:
    """All items; metadata of prior orders only, so other baskets carry nulls."""
    r = retail_tables(spark, sf)
    prior = r.orders_of("prior")
    return B.build_unpruned_baskets(r.lines, prior, r.products).withColumn("items", joined("items"))


@query
def basket_documents(spark: SparkSession, sf: str) -> DataFrame:
    prior = retail.star_orders(spark, sf, "prior")
    return B.basket_documents(pruned_baskets(spark, sf), prior).withColumn("items", joined("items"))


@query
def basket_sample(spark: SparkSession, sf: str) -> DataFrame:
    return B.sample_baskets(pruned_baskets(spark, sf)).withColumn(
        "cleaned_items", joined("cleaned_items")
    )


@query
def orders_with_lines(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return B.orders_with_lines(r.orders, r.lines).select("order_id", "user_id", "eval_set")


@query
def first_orders_lines(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return B.first_orders(r.orders, r.lines, 1000)[1]


@query
def basket_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One basket by key, from the stored, order-sorted documents."""
    return _stored_baskets(spark, sf).transform(lambda d: B.basket_by_key(d, 2)).withColumn(
        "items", joined("items")
    )


@query
def basket_by_count(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_baskets(spark, sf).transform(lambda d: B.baskets_by_size(d, 5)).withColumn(
        "items", joined("items")
    )


def _stored_baskets(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    documents = B.basket_documents(B.build_baskets(r.lines, r.products), r.orders)
    path = scratch_path(spark, "orders")
    P.write_baskets(documents, path)
    return tables.read_table(spark, path, documents.schema)


# --- exclusion audit --------------------------------------------------------------


@query
def exclusion_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return B.exclusion_breakdown(profiles(spark, sf))


@query
def before_after(spark: SparkSession, sf: str) -> DataFrame:
    return B.before_after(profiles(spark, sf))


@query
def order_trace(spark: SparkSession, sf: str) -> DataFrame:
    return TR.trace_orders(profiles(spark, sf)).withColumn(
        "items_after_sample", joined("items_after_sample")
    )


@query
def order_trace_range(spark: SparkSession, sf: str) -> DataFrame:
    """The qualified orders of the traced key range, as report records."""
    traced = TR.trace_orders(profiles(spark, sf), 2, 12)
    return TR.sample_records(traced).withColumn("cleaned_items", joined("cleaned_items"))


# --- itemsets and rules -----------------------------------------------------------


@query
def itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return flat_itemsets(mined(spark, sf)[0])


@query
def itemset_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.itemset_counts(mined(spark, sf)[0])


@query
def itemsets_by_size(spark: SparkSession, sf: str) -> DataFrame:
    return M.itemsets_by_size(mined(spark, sf)[0])


@query
def itemset_search(spark: SparkSession, sf: str) -> DataFrame:
    return flat_itemsets(M.filter_itemsets(mined(spark, sf)[0], "multi", ITEM_KEYWORD))


@query
def itemset_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One itemset from the stored postings of its items."""
    path = scratch_path(spark, "itemset-postings")
    P.write_postings(mined(spark, sf)[0], "items", path)
    return flat_itemsets(M.posted_itemset(tables.read_table(spark, path), ["small widget", LOOKUP_ITEM]))


@query
def top_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return M.top_itemsets(M.filter_itemsets(mined(spark, sf)[0], "multi")).withColumn(
        "support_pct", F.round("support_pct", 6)
    )


@query
def rules(spark: SparkSession, sf: str) -> DataFrame:
    return flat_rules(all_rules(spark, sf))


@query
def strong_rules(spark: SparkSession, sf: str) -> DataFrame:
    return flat_rules(M.strong_rules(all_rules(spark, sf)))


@query
def rule_search(spark: SparkSession, sf: str) -> DataFrame:
    return flat_rules(M.filter_rules(all_rules(spark, sf), 1.1, 6, RULE_KEYWORD))


@query
def rule_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The rules whose antecedent holds an item, from the stored postings of the antecedents."""
    path = scratch_path(spark, "rule-postings")
    P.write_postings(all_rules(spark, sf), "antecedent", path)
    return flat_rules(M.posted(tables.read_table(spark, path), LOOKUP_ITEM))


@query
def rule_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = M.rule_stats(M.strong_rules(all_rules(spark, sf)))
    return stats.select("total_rules", r6("max_lift"), r6("avg_confidence"), r6("min_support"))


@query
def rule_sides(spark: SparkSession, sf: str) -> DataFrame:
    catalog = retail.star_products(spark, sf).agg(F.count_distinct("product_name")).scalar()
    return M.rule_sides(M.strong_rules(all_rules(spark, sf)), catalog)


@query
def top_rules(spark: SparkSession, sf: str) -> DataFrame:
    return M.top_rules(all_rules(spark, sf))


@query
def threshold_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    """Itemsets of the core products; the support follows from the item threshold."""
    settings = MB.Settings(min_item_freq=MIN_ITEM_FREQ, min_confidence=MIN_CONFIDENCE, split=None)
    return flat_itemsets(trained(spark, sf, settings).itemsets)


@query
def rule_explained(spark: SparkSession, sf: str) -> DataFrame:
    found, n = mined(spark, sf)
    strong = M.strong_rules(M.association_rules(found, n, MIN_CONFIDENCE))
    return _explained(M.explain_rules(strong, found, n))


@query
def rule_explained_derived(spark: SparkSession, sf: str) -> DataFrame:
    """The same numbers when the itemset table lacks the single items: derived from the rules."""
    found, n = mined(spark, sf)
    strong = M.strong_rules(M.association_rules(found, n, MIN_CONFIDENCE))
    return _explained(M.explain_rules(strong, found.filter(F.col("k") > 1), n))


def _explained(df: DataFrame) -> DataFrame:
    return df.select(
        joined("antecedent").alias("antecedent"),
        joined("consequent").alias("consequent"),
        "freq_pair",
        "freq_antecedent",
        "freq_consequent",
        r6("pair_support_pct"),
        r6("antecedent_support_pct"),
        r6("consequent_support_pct"),
        r6("confidence_pct"),
        r6("lift"),
    )


@query
def parameter_sweep(spark: SparkSession, sf: str) -> DataFrame:
    found, n = mined(spark, sf)
    return M.sweep(found, n, SWEEP)


# --- recommendations --------------------------------------------------------------


@query
def match_rules(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    return R.match_rules(shopper_carts(spark, sf, model.baskets), model.rules).select(
        "cart_id", "item", joined("antecedent").alias("antecedent"), r6("lift")
    )


@query
def recommend(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    carts = shopper_carts(spark, sf, model.baskets)
    return flat_recommendations(R.recommend(carts, model.rules))


@query
def fallback(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    carts = shopper_carts(spark, sf, model.baskets)
    served = R.match_rules(carts, model.rules)
    return R.fallback(carts, served, model.popular).select("cart_id", "rank", "item", "source")


@query
def recommend_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    carts = shopper_carts(spark, sf, model.baskets)
    return flat_recommendations(R.recommend_with_fallback(carts, model.rules, model.popular))


@query
def item_selector(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    return R.item_selector(model.rules, model.popular)


@query
def known_cart_items(spark: SparkSession, sf: str) -> DataFrame:
    """Carts restricted to the best sellers, the shortest list a selector can offer."""
    r = retail_tables(spark, sf)
    carts = B.build_baskets(r.lines, r.products).select(F.col("order_id").alias("cart_id"), "items")
    return R.known_items(carts, I.top_items(MB.popular_items(r), L.POPULAR_REPORT_ITEMS)).withColumn("items", joined("items"))


# --- evaluation -------------------------------------------------------------------


def name_catalog_size(spark: SparkSession, sf: str) -> Column:
    return retail.star_products(spark, sf).agg(F.count_distinct("product_name")).scalar()


@query
def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluated on the baskets the rules were learnt from."""
    model = trained(spark, sf)
    return E.evaluate(model.baskets, model.rules, model.popular, name_catalog_size(spark, sf))


def held_out_baskets(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    scope = MB.in_scope(r, MB.Settings(split="train"))
    return B.build_baskets(scope.lines, scope.products)


@query
def evaluate_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of the prior split, evaluated on the baskets of the train split."""
    model = trained(spark, sf, MINING_PRIOR)
    unseen = materialize(held_out_baskets(spark, sf), "held-out")
    return E.evaluate(unseen, model.rules, model.popular, name_catalog_size(spark, sf))


@query
def evaluate_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of nine orders in ten, by order id, evaluated on the tenth."""
    model = trained(spark, sf, MINING_FOLDS)
    unseen = materialize(MB.held_out(retail_tables(spark, sf), MINING_FOLDS), "held-out")
    return E.evaluate(unseen, model.rules, model.popular, name_catalog_size(spark, sf))


@query
def train_lines_job(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run on the other line file, where the first is missing: the baskets it publishes."""
    out = scratch_path(spark, "train-job")
    settings = MB.Settings(min_item_freq=None, min_support=0.02, min_confidence=MIN_CONFIDENCE)
    MB.run_pipeline(spark, retail.load_csv(spark, _csv_layout(spark, sf, ["train"])), settings, out, "train")
    stored = tables.read_table(spark, f"{out}/baskets", schemas.BASKET_DOCUMENTS)
    return stored.withColumn("items", joined("items"))


@query
def evaluation_sample(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return E.evaluation_sample(B.build_baskets(r.lines, r.products)).select(
        "order_id", "items_count", joined("items").alias("items")
    )


@query
def evaluate_header(spark: SparkSession, sf: str) -> DataFrame:
    """Over all orders with lines, so that single-item baskets are there to skip."""
    r = retail_tables(spark, sf)
    return E.evaluation_header(B.build_baskets(r.lines, r.products, min_size=1))


@query
def observed_items(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    return E.split_baskets(B.build_baskets(r.lines, r.products)).withColumn("truth", joined("truth"))


@query
def recommendation_lists(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    observed = E.split_baskets(model.baskets).select("observed").distinct()
    return E.recommendation_lists(observed, model.rules, model.popular, 10).select(
        "observed", joined("fp_list").alias("fp_list"), joined("base_list").alias("base_list")
    )


@query
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    return E.coverage(model.baskets, model.rules, model.popular)


# --- sources and sinks ------------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All lines written as CSV and read back with a schema and two columns."""
    lines = retail.star_lines(spark, sf)
    path = f"{scratch_path(spark, 'lines')}.csv"
    lines.write.option("header", True).csv(path)
    return tables.read_table(spark, path, lines.schema, ["order_id", "product_id"])


@query
def count_or_zero(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table of the schema, 0 for one that does not exist."""
    counts = [
        (name, tables.count_or_zero(spark, f"{sf}/{name}.parquet"))
        for name in [*schemas.STAR, "order_products_train"]
    ]
    return spark.createDataFrame(counts, "table_name string, row_count long")


@query
def read_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Baskets from the first store that has any: one is missing, one is empty."""
    r = retail_tables(spark, sf)
    documents = B.basket_documents(B.build_baskets(r.lines, r.products), r.orders)
    primary, alternate, file = (scratch_path(spark, f"store{i}") for i in range(3))
    P.write_table(documents.filter(F.lit(False)), alternate)
    P.write_baskets(documents, file)
    df, source = tables.read_first_available(spark, [primary, alternate, file], documents.schema)
    served = {primary: "primary", alternate: "alternate", file: "file"}.get(source, source)
    return tables.with_source(df, served).select("order_id", "items_count", "source")


@query
def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Baskets exported as JSON lines and read back; a second export leaves the first."""
    r = retail_tables(spark, sf)
    built = B.build_baskets(r.lines, r.products)
    path = f"{scratch_path(spark, 'baskets')}.json"
    P.export_baskets_json(built, path)
    P.export_baskets_json(built.filter(F.lit(False)), path)
    return tables.read_baskets_json(spark, path).select(
        "order_id", F.size("items").alias("items_count"), joined("items").alias("items")
    )


@query
def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Stored basket documents with chosen fields, written twice over one path."""
    r = retail_tables(spark, sf)
    documents = B.basket_documents(B.build_baskets(r.lines, r.products), r.orders)
    path = scratch_path(spark, "orders")
    P.write_table(documents, path)
    P.write_baskets(documents, path)
    return tables.read_stored(
        spark, path, documents.schema, ["order_id", "user_id", "order_dow", "items_count"]
    )


@query
def catalog_sink(spark: SparkSession, sf: str) -> DataFrame:
    catalog = catalog_denormalised(spark, sf)
    path = scratch_path(spark, "catalog")
    P.write_table(catalog, path)
    return tables.read_table(spark, path, catalog.schema)


@query
def itemset_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_path(spark, 'itemsets')}.json"
    P.write_itemsets(mined(spark, sf)[0], path, "json")
    return flat_itemsets(tables.read_table(spark, path, schemas.ITEMSETS))


@query
def publish_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Strong rules under two names, read back from both."""
    strong = M.strong_rules(all_rules(spark, sf))
    paths = {name: scratch_path(spark, name) for name in ("rules_prior", "rules")}
    P.write_rules(strong, list(paths.values()))
    return Q.stack(
        [
            flat_rules(tables.read_table(spark, path, schemas.RULES)).withColumn(
                "copy", F.lit(name)
            )
            for name, path in paths.items()
        ]
    )


@query
def skip_if_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """A store is kept or replaced as the caller says."""
    r = retail_tables(spark, sf)
    documents = materialize(
        B.basket_documents(B.build_baskets(r.lines, r.products), r.orders), "documents"
    )
    path = scratch_path(spark, "orders")
    steps = [
        ("first load", P.load_baskets(documents, path, "keep")),
        ("kept", P.load_baskets(documents.filter(F.lit(False)), path, "keep")),
        ("replaced", P.load_baskets(documents, path, "replace")),
    ]
    stored = tables.read_table(spark, path).agg(F.count(F.lit(1))).scalar()
    return spark.createDataFrame(steps, "step string, written boolean").select(
        "step", "written", stored.alias("stored_baskets")
    )


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_tables(spark, sf)
    timing = materialize(T.orders_per_dow_hour(retail.star_timing(spark, sf)), "density")
    hourly = timing.groupBy("hour").agg(F.sum("orders_count").alias("orders_count"))
    best = I.top_items(I.item_sales(I.item_frequency(r.lines), r.products))
    built = pruned_baskets(spark, sf)
    totals = r.orders.agg(F.count(F.lit(1)).alias("total_orders")).select(
        "total_orders",
        built.agg(F.count(F.lit(1))).scalar().alias("total_valid_baskets"),
        r.lines.agg(F.count(F.lit(1))).scalar().alias("total_transactions"),
        F.lit(0).cast("long").alias("total_rules"),
    )
    return P.summary_document(totals, best, hourly, timing)


SUMMARY_SCHEMA = (
    "total_orders long, total_valid_baskets long, total_transactions long, total_rules long, "
    "top_products array<struct<item: string, total_sales: long>>, "
    "hourly_data array<struct<hour: int, orders_count: long>>, "
    "heat_data array<struct<dow: int, hour: int, orders_count: long>>"
)


def _flat_summary(df: DataFrame) -> DataFrame:
    def pairs(column: str, *names: str) -> Column:
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws("=", *[s[n].cast("string") for n in names])),
            ";",
        ).alias(column)

    return df.select(
        "total_orders",
        "total_valid_baskets",
        "total_transactions",
        "total_rules",
        pairs("top_products", "item", "total_sales"),
        pairs("hourly_data", "hour", "orders_count"),
        pairs("heat_data", "dow", "hour", "orders_count"),
    )


@query
def summary_document(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_path(spark, 'summary')}.json"
    P.write_table(_summary(spark, sf), path, "json")
    return _flat_summary(tables.read_table(spark, path, SUMMARY_SCHEMA))


@query
def summary_patch(spark: SparkSession, sf: str) -> DataFrame:
    """The stored summary, patched in place with the totals of the prior split and the rule count."""
    path = f"{scratch_path(spark, 'summary')}.json"
    P.write_table(_summary(spark, sf), path, "json")
    prior = retail.star_orders(spark, sf, "prior")
    strong = M.strong_rules(all_rules(spark, sf))
    P.patch_summary(
        tables.read_table(spark, path, SUMMARY_SCHEMA),
        {
            "total_orders": prior.agg(F.count(F.lit(1))).scalar(),
            "total_rules": strong.agg(F.count(F.lit(1))).scalar(),
        },
        path,
    )
    return _flat_summary(tables.read_table(spark, path, SUMMARY_SCHEMA))


def _text_rows(report: DataFrame, section: str, key: str) -> DataFrame:
    """The rows of a report section as (section, row_key, content), content in the order of its fields."""
    fields = [f.name for f in report.schema[section].dataType.elementType.fields if f.name != key]
    kinds = {f.name: f.dataType.typeName() for f in report.schema[section].dataType.elementType.fields}
    return report.select(F.explode(section).alias("r")).select(
        F.lit(section).alias("section"),
        F.col(f"r.{key}").cast("string").alias("row_key"),
        F.concat_ws(
            "|", *[joined(f"r.{f}") if kinds[f] == "array" else F.col(f"r.{f}").cast("string") for f in fields]
        ).alias("content"),
    )


@query
def quality_document(spark: SparkSession, sf: str) -> DataFrame:
    """Every section of the stored quality report, row by row."""
    r = retail_tables(spark, sf)
    settings = MB.Settings(min_item_freq=MIN_ITEM_FREQ, split=None)
    path = f"{scratch_path(spark, 'quality')}.json"
    catalog = B.core_catalog(r.lines, r.products, MIN_ITEM_FREQ)
    facts = materialize(Q.order_facts(r.lines, catalog), "order-facts")
    report = MB.quality_report(
        "run",
        settings,
        r,
        materialize(B.order_profiles(facts, r.orders), "profiles"),
        materialize(Q.integrity_report(r.lines, r.orders, r.products, facts), "integrity"),
    )
    P.write_table(report, path, "json")
    stored = tables.read_table(spark, path, report.schema)
    kpis = stored.select(
        F.lit("kpis").alias("section"),
        F.when(F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"), F.col("run_id")).alias("row_key"),
        F.concat_ws(
            "|",
            *[f"kpis.{k}" for k in ("valid_baskets", "excluded_baskets", "total_prior_orders")],
            "parameters.min_item_freq",
        ).alias("content"),
    )
    return Q.stack(
        [
            kpis,
            _text_rows(stored, "tables", "table_name"),
            _text_rows(stored, "cleaning_stages", "metric"),
            _text_rows(stored, "excluded_orders_breakdown", "group_id"),
            _text_rows(stored, "sample_records", "order_id"),
            _text_rows(stored, "sample_traceability_orders", "order_id"),
        ]
    )


def _csv_layout(spark: SparkSession, sf: str, splits: Sequence[str] = ("prior", "train")) -> str:
    """The star tables as CSV files: days without a value for open orders, sizes as aisles, lines of the splits."""
    root = scratch_path(spark, "retail")
    orders, lines = retail.star_orders(spark, sf), retail.star_lines(spark, sf)
    part, nation, region = (retail.star_table(spark, sf, t) for t in ("part", "nation", "region"))
    days = F.when(F.col("eval_set") != "train", F.col("order_dow").cast("double"))
    files = {
        "orders": orders.select(
            "order_id", "user_id", "eval_set", F.lit(1).alias("order_number"), "order_dow", "order_hour_of_day",
            days.alias("days_since_prior_order"),
        ),
        "products": part.select(
            "p_partkey", "p_name", F.col("p_size").alias("aisle_id"), (F.col("p_size") % 5).alias("department_id")
        ),
        "aisles": nation.select("n_nationkey", "n_name"),
        "departments": region.select("r_regionkey", "r_name"),
    }
    for split in splits:
        chosen = lines.join(orders.filter(F.col("eval_set") == split).select("order_id"), "order_id", "left_semi")
        files[f"order_products__{split}"] = chosen.withColumn("reordered", F.lit(None).cast("int"))
    for name, df in files.items():
        df.write.option("header", True).csv(f"{root}/{name}.csv")
    return root


@query
def csv_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of all six files of the CSV layout, as the whole job publishes it."""
    r = retail.load_csv(spark, _csv_layout(spark, sf))
    out = scratch_path(spark, "csv-job")
    settings = MB.Settings(
        min_item_freq=None, min_support=0.02, min_confidence=MIN_CONFIDENCE, mining_partitions=8
    )
    MB.run_pipeline(spark, r, settings, out, "csv")
    audit = (
        "table_name string, total_rows long, total_cols long, primary_key string, null_count long, "
        "null_rate string, duplicates long, foreign_key_valid boolean"
    )
    stored = tables.read_table(spark, f"{out}/quality", f"tables array<struct<{audit}>>")
    return stored.select(F.inline("tables"))


@query
def published_job(spark: SparkSession, sf: str) -> DataFrame:
    """Both copies of the summary and the itemset totals that a whole run leaves."""
    out = scratch_path(spark, "job")
    MB.run_pipeline(spark, retail_tables(spark, sf), MINING, out, "run-1")
    totals = tables.read_table(spark, f"{out}/itemset_totals")
    names = ["total_itemsets", "total_1_itemsets", "total_multi_itemsets"]
    return Q.stack(
        [
            tables.read_table(spark, f"{out}/{copy}").select(
                F.lit(copy).alias("copy"),
                "dataset_name",
                "total_orders",
                "total_valid_baskets",
                "total_transactions",
                "total_rules",
                "min_support_percent",
                "min_confidence_percent",
                (F.col("training_time_seconds") > 0).alias("training_timed"),
                F.size("top_products").alias("top_products"),
                *[totals.select(n).scalar().alias(n) for n in names],
                totals.select("min_support").scalar().alias("min_support"),
            )
            for copy in ("summary_prior", "summary")
        ]
    )


@query
def evaluation_document(spark: SparkSession, sf: str) -> DataFrame:
    """The stored evaluation, one row per K with the header beside it."""
    model = trained(spark, sf)
    out = scratch_path(spark, "evaluation")
    EV.publish_evaluation(model, model.baskets, name_catalog_size(spark, sf), out)
    stored = tables.read_table(spark, f"{out}/evaluation")
    return stored.select("*", F.explode("metrics_by_k").alias("m")).select(
        "baskets_queried",
        "baskets_evaluated",
        "baskets_skipped",
        "catalog_size",
        "unique_antecedents",
        "unique_consequents",
        "coverage_ceiling_pct",
        F.col("m.k").cast("int").alias("k"),
        *[F.col(f"m.{side}_{x}") for side in ("rules", "popular") for x in EVALUATION_MEASURES],
    )


@query
def experiment_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The sweep of the fixed configurations, as the evaluation of a model publishes it."""
    model = trained(spark, sf)
    out = scratch_path(spark, "experiments")
    EV.publish_evaluation(model, model.baskets, name_catalog_size(spark, sf), out)
    return tables.read_table(spark, f"{out}/experiments")


# --- runs and logs ----------------------------------------------------------------

# One line of an execution log for each mark; a number stands for %s.
LOG_LINES = [
    "INFO [SparkContext] Running Spark version 4.%s",
    "INFO SparkSession & JVM Context initialized in %ss. Master: local",
    "INFO Job 0 finished in %ss.",
    "INFO Job 1 finished in %ss.",
    "INFO Job 2 finished in %ss.",
    "INFO Job 3 finished in %ss.",
    "INFO Job 4 (FPGrowth.fit) finished in %ss.",
    "INFO Step 6 completed in %ss.",
    "INFO Total Pipeline Run Duration: %s seconds.",
]


@query
def log_timings(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as one line of an execution log, its kind by the hour; the last value of each mark."""
    events = retail.star_table(spark, sf, "events")
    number = F.regexp_extract("props", r'"k": ([0-9]+)', 1)
    kind = F.hour("ts") % len(LOG_LINES)
    line = F.coalesce(*[F.when(kind == i, F.format_string(f, number)) for i, f in enumerate(LOG_LINES)])
    path = f"{scratch_path(spark, 'execution')}.txt"
    stamped = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), line)
    events.orderBy("event_id").select(stamped.alias("value")).write.text(path)
    return logs.log_marks(logs.read_log_lines(spark, path))


@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows read and written by every step of a whole run, read back from its sink."""
    path = scratch_path(spark, "run")
    MB.run_pipeline(spark, retail_tables(spark, sf), MINING, path, "run-1")
    return spark.read.parquet(f"{path}/runs").select("step_num", "step", "rows_in", "rows_out")


@query
def merge_live_row(spark: SparkSession, sf: str) -> DataFrame:
    """The reference configuration shows the pruned run, the sweep's counts stay beside it."""
    found, n = mined(spark, sf)
    stored = scratch_path(spark, "experiments")
    P.write_table(M.sweep(found, n), stored)
    strong = M.strong_rules(M.association_rules(found, n, MIN_CONFIDENCE))
    live = M.rule_stats(strong).select(
        F.lit(MIN_SUPPORT).alias("min_support"),
        F.lit(MIN_CONFIDENCE).alias("min_confidence"),
        found.agg(F.count(F.lit(1))).scalar().alias("frequent_itemsets"),
        F.col("total_rules").alias("association_rules"),
        F.round("max_lift", 4).alias("max_lift"),
        F.round("avg_confidence", 4).alias("avg_confidence"),
    )
    return runs.merge_live_row(tables.read_table(spark, stored), materialize(live, "live"))


# --- texts ------------------------------------------------------------------------


@query
def formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Display texts of all itemsets."""
    found, n = mined(spark, sf)
    return found.select(
        text.itemset_label(F.col("items")).alias("label"),
        F.array_join("items", ", ").alias("listed"),
        F.format_string("%d-itemset", "k").alias("size_text"),
        text.thousands(F.col("frequency")).alias("frequency_text"),
        text.percent_text(F.col("frequency"), F.lit(n)).alias("support_text"),
        F.round("support", 2).alias("support2"),
        F.round("support", 3).alias("support3"),
        F.round("support", 4).alias("support4"),
        F.round("support", 5).alias("support5"),
        F.col("frequency").cast("double").alias("frequency_double"),
    )


@query
def rule_texts(spark: SparkSession, sf: str) -> DataFrame:
    strong = M.strong_rules(all_rules(spark, sf))
    return strong.select(
        text.rule_label(F.col("antecedent"), F.col("consequent")).alias("rule"),
        F.round("lift", 2).alias("lift"),
        F.format_string("%.1f%%", F.round(F.col("confidence") * 100, 1)).alias("confidence_text"),
        F.format_string("%.2f%%", F.round(F.col("support") * 100, 2)).alias("support_text"),
    )


@query
def support_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """A given support as a count, and the support that an item threshold means, for the baskets at hand."""
    r = retail_tables(spark, sf)
    n = F.col("n_baskets")
    support = F.lit(L.DEFAULT_MIN_SUPPORT)
    return (
        B.build_baskets(r.lines, r.products)
        .agg(F.count(F.lit(1)).alias("n_baskets"))
        .select(
            "n_baskets",
            support.alias("min_support"),
            measures.estimated_min_count(support * 100, n).alias("min_count"),
            (F.lit(float(MIN_ITEM_FREQ)) / n).alias("threshold_support"),
        )
    )


# --- streams ----------------------------------------------------------------------


@query
def stream_recommend(spark: SparkSession, sf: str) -> DataFrame:
    """All carts as a stream of files, scored batch by batch."""
    model = trained(spark, sf)
    arriving, out, state = (scratch_path(spark, f"stream-{p}") for p in ("in", "out", "state"))
    shopper_carts(spark, sf, model.baskets).repartition(4).write.parquet(arriving)
    stream_carts.score_carts(
        stream_carts.cart_stream(spark, arriving, max_files_per_trigger=2),
        model.rules,
        model.popular,
        out,
        state,
    ).awaitTermination()
    return flat_recommendations(spark.read.parquet(out))


@query
def stream_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Order density kept by a stream of events that arrive in three parts; equals the batch result."""
    arriving, out, state = (scratch_path(spark, f"density-{p}") for p in ("in", "out", "state"))
    events = retail.star_table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    part = F.coalesce(F.floor(F.try_divide((at - F.lit(first)) * 3, F.lit(last) - F.lit(first) + 1)), F.lit(0))
    for arrived in range(3):
        events.filter(part == arrived).write.mode("append").parquet(arriving)
        times = stream_density.order_time_stream(spark, arriving, schemas.STAR["events"])
        stream_density.keep_hourly_counts(
            stream_density.hourly_counts(times), out, state
        ).awaitTermination()
    return stream_density.density_from_hours(stream_density.current_counts(spark, out))
