"""The registered queries in SQL, over whole tables, for another engine to repeat."""

from __future__ import annotations

from basketlab.functions import labels as L
from basketlab.sources.schemas import STAR

# Parameters of the queries, stated anew, so that a wrong one on the other side shows.
MIN_ITEM_FREQ = 33
MIN_SUPPORT = 0.003
MIN_CONFIDENCE = 0.05
MIN_LIFT = 1.2
FALLBACK_ITEMS = 3
EVALUATION_SAMPLE = 1000
ITEM_KEYWORD = " Red "
RULE_KEYWORD = "BOLT "
LOOKUP_ITEM = "red plate"
SWEEP_CONFIGS = [
    ("EXP-01", 0.010, 0.15),
    ("EXP-02", 0.008, 0.10),
    ("EXP-03* (Cấu hình chuẩn hệ thống)", 0.00726, 0.08),
    ("EXP-04", 0.005, 0.05),
    ("EXP-05", 0.003, 0.03),
]
SWEEP = [*SWEEP_CONFIGS, ("FINE-01", 0.006, 0.08), ("FINE-02", 0.004, 0.06), ("FINE-03", 0.003, 0.05)]
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
LOG_MARKS = ["spark_version", "init", "job0", "job1", "job2", "job3", "job4", "step6", "total"]

SPLIT = "CASE o_orderstatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train' WHEN 'P' THEN 'test' END"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def percent(part: str, whole: str) -> str:
    return f"printf('%.2f%%', {part} * 100.0 / {whole})"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Shared parts. Every chain starts with "WITH RECURSIVE" so that parts can be combined.

ORDERS = f"""ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, {SPLIT} AS eval_set,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
         CAST(hour(o_orderdate) AS INTEGER) AS order_hour_of_day
  FROM orders)"""

CORE = f"""core AS (
  SELECT l_partkey AS product_id, count(*) AS item_count FROM lineitem
  GROUP BY l_partkey HAVING count(*) >= {MIN_ITEM_FREQ})"""

NAMED_ALL = """named AS (
  SELECT l_orderkey AS order_id, p_name AS item, min(l_linenumber) AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_name)"""

NAMED_CORE = """named AS (
  SELECT l_orderkey AS order_id, p_name AS item, min(l_linenumber) AS pos
  FROM lineitem JOIN core ON l_partkey = product_id JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey, p_name)"""


def baskets_part(min_size: int = 2) -> str:
    return f"""baskets AS (
  SELECT order_id, CAST(count(*) AS INTEGER) AS items_count, list(item ORDER BY item) AS items,
         first(item ORDER BY pos, item) AS first_item
  FROM named GROUP BY order_id HAVING count(*) >= {min_size})"""


def mining_part(source: str = "baskets", support: str = str(MIN_SUPPORT)) -> str:
    """All itemsets by listing every subset of every basket, then the rules."""
    return f"""n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {source}),
basket_item AS (SELECT order_id, unnest(items) AS item FROM {source}),
subset(order_id, items, last) AS (
  SELECT order_id, [item], item FROM basket_item
  UNION ALL
  SELECT s.order_id, list_append(s.items, b.item), b.item
  FROM subset s JOIN basket_item b ON b.order_id = s.order_id AND b.item > s.last),
itemset AS (
  SELECT items, CAST(len(items) AS INTEGER) AS k, count(*) AS frequency
  FROM subset GROUP BY items
  HAVING count(*) >= (SELECT ceil({support} * n) FROM n)),
candidate AS (
  SELECT items, frequency AS f_union, unnest(items) AS item FROM itemset WHERE k >= 2),
sided AS (
  SELECT list_filter(items, lambda i: i <> item) AS antecedent, item, f_union FROM candidate),
rule AS (
  SELECT s.antecedent, [s.item] AS consequent, s.item AS item, s.f_union,
         CAST(s.f_union AS DOUBLE) / a.frequency AS confidence,
         (CAST(s.f_union AS DOUBLE) / a.frequency) / (c.frequency / n.n) AS lift,
         s.f_union / n.n AS support
  FROM sided s JOIN itemset a ON a.items = s.antecedent
  JOIN itemset c ON c.items = [s.item] CROSS JOIN n
  WHERE CAST(s.f_union AS DOUBLE) / a.frequency >= {MIN_CONFIDENCE}),
strong AS (SELECT * FROM rule WHERE lift > {MIN_LIFT})"""


POPULAR = f"""popular AS (
  SELECT item, total_sales, row_number() OVER (ORDER BY total_sales DESC, item) AS place
  FROM (SELECT p_name AS item, count(*) AS total_sales
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name)
  ORDER BY place)"""

RULE_ORDER = "lift DESC, confidence DESC, antecedent, consequent"

CARTS = """cart AS (
  SELECT order_id AS cart_id, items FROM baskets
  JOIN orders ON o_orderkey = order_id WHERE o_orderstatus <> 'F')"""

MATCHES = """matched AS (
  SELECT c.cart_id, r.* FROM cart c JOIN strong r
  ON list_has_all(c.items, r.antecedent) AND NOT list_contains(c.items, r.item))"""

RANKED = f"""best AS (
  SELECT *, row_number() OVER (PARTITION BY cart_id, item ORDER BY {RULE_ORDER}) AS choice
  FROM matched),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cart_id ORDER BY {RULE_ORDER}, item) AS INTEGER) AS rank
  FROM best WHERE choice = 1)"""

RULE_LABEL = (
    "array_to_string(antecedent, ', ') || ' → ' || array_to_string(consequent, ', ')"
)

RULE_ROWS = f"""SELECT cart_id, rank, item, 'rule' AS source, {RULE_LABEL} AS rule,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support
FROM ranked WHERE rank <= {L.RECOMMENDATIONS}"""

SUBSTITUTES = f"""substitute AS (
  SELECT u.cart_id, p.item,
         CAST(row_number() OVER (PARTITION BY u.cart_id ORDER BY p.place) AS INTEGER) AS rank
  FROM (SELECT * FROM cart WHERE cart_id NOT IN (SELECT cart_id FROM matched)) u
  JOIN popular p ON NOT list_contains(u.items, p.item))"""

FALLBACK_ROWS = f"""SELECT cart_id, rank, item, 'popular' AS source, {quoted(L.FALLBACK_LABEL)} AS rule,
  CAST(NULL AS DOUBLE) AS confidence, CAST(NULL AS DOUBLE) AS lift, CAST(NULL AS DOUBLE) AS support
FROM substitute WHERE rank <= {FALLBACK_ITEMS}"""

FLAT_RULE = """array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support"""

FLAT_ITEMSET = "array_to_string(items, '|') AS items, k, frequency, round(frequency / n.n, 6) AS support"


def chain(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


MINING = chain(NAMED_ALL, baskets_part(), mining_part())
SERVING = chain(NAMED_ALL, baskets_part(), mining_part(), CARTS, MATCHES)


def evaluation_parts(cases: str = "baskets") -> list[str]:
    ks = ", ".join(f"({k})" for k in L.EVALUATION_KS)
    return [
        f"""case_ AS (
  SELECT order_id, first_item AS observed, list_filter(items, lambda i: i <> first_item) AS truth
  FROM {cases} WHERE len(items) >= 2)""",
        "seen AS (SELECT DISTINCT observed FROM case_)",
        f"""by_rule AS (
  SELECT antecedent[1] AS observed, item,
         row_number() OVER (PARTITION BY antecedent[1] ORDER BY {RULE_ORDER}) AS place
  FROM strong WHERE len(antecedent) = 1)""",
        """base_list AS (
  SELECT s.observed, p.item, row_number() OVER (PARTITION BY s.observed ORDER BY p.place) AS pos
  FROM seen s JOIN popular p ON p.item <> s.observed)""",
        """filled AS (
  SELECT s.observed, r.item, r.place FROM seen s JOIN by_rule r ON r.observed = s.observed
  UNION ALL
  SELECT b.observed, b.item, 1000000000 + b.pos FROM base_list b
  WHERE NOT EXISTS (SELECT 1 FROM by_rule r WHERE r.observed = b.observed AND r.item = b.item))""",
        """fp_list AS (
  SELECT observed, item, row_number() OVER (PARTITION BY observed ORDER BY place) AS pos
  FROM filled)""",
        f"ks(k) AS (VALUES {ks})",
    ]


EVALUATION_TAIL = """, hits AS (
  SELECT k, c.order_id, len(c.truth) AS hidden,
         (SELECT count(*) FROM fp_list f WHERE f.observed = c.observed AND f.pos <= k
            AND list_contains(c.truth, f.item)) AS rule_hits,
         (SELECT count(*) FROM base_list b WHERE b.observed = c.observed AND b.pos <= k
            AND list_contains(c.truth, b.item)) AS popular_hits
  FROM case_ c CROSS JOIN ks),
catalog AS (SELECT count(DISTINCT p_name) AS size FROM part)
SELECT k,
  round(avg(CAST(rule_hits AS DOUBLE) / k), 6) AS rules_precision,
  round(avg(CAST(rule_hits AS DOUBLE) / hidden), 6) AS rules_recall,
  round(avg(CASE WHEN rule_hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS rules_hit_rate,
  round(avg(CAST(popular_hits AS DOUBLE) / k), 6) AS popular_precision,
  round(avg(CAST(popular_hits AS DOUBLE) / hidden), 6) AS popular_recall,
  round(avg(CASE WHEN popular_hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS popular_hit_rate,
  round((SELECT count(DISTINCT item) FROM fp_list f WHERE f.pos <= hits.k)
        / CAST((SELECT size FROM catalog) AS DOUBLE), 6) AS rules_coverage,
  round((SELECT count(DISTINCT item) FROM base_list b WHERE b.pos <= hits.k)
        / CAST((SELECT size FROM catalog) AS DOUBLE), 6) AS popular_coverage
FROM hits GROUP BY k"""

EVALUATION_HEADER = """SELECT (SELECT count(*) FROM baskets) AS baskets_queried,
  (SELECT count(*) FROM case_) AS baskets_evaluated, CAST(0 AS BIGINT) AS baskets_skipped,
  (SELECT size FROM catalog) AS catalog_size,
  (SELECT count(DISTINCT i) FROM (SELECT unnest(antecedent) AS i FROM strong)) AS unique_antecedents,
  (SELECT count(DISTINCT item) FROM strong) AS unique_consequents,
  (SELECT round(count(DISTINCT item) / CAST((SELECT size FROM catalog) AS DOUBLE) * 100, 2) FROM strong)
    AS coverage_ceiling_pct,"""

PROFILE = f"""size_ AS (
  SELECT l_orderkey AS order_id, count(*) AS raw_lines, count(DISTINCT l_partkey) AS c_raw,
         count(DISTINCT product_id) AS c_core,
         list(DISTINCT p_name ORDER BY p_name) FILTER (WHERE product_id IS NOT NULL) AS core_items
  FROM lineitem LEFT JOIN core ON l_partkey = product_id LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey),
profile AS (
  SELECT o_orderkey AS order_id, coalesce(raw_lines, 0) AS raw_lines, coalesce(c_raw, 0) AS c_raw,
         coalesce(c_core, 0) AS c_core, coalesce(core_items, []) AS core_items
  FROM orders LEFT JOIN size_ ON o_orderkey = order_id),
grouped AS (
  SELECT *, CASE WHEN len(core_items) >= 2 THEN 'qualified' WHEN c_raw = 0 THEN 'G0'
    WHEN c_raw = 1 THEN 'G1' WHEN c_core = 0 THEN 'G2' WHEN c_core = 1 THEN 'G3' ELSE 'G4' END AS grp
  FROM profile)"""


def trace(where: str = "TRUE") -> str:
    return f"""traced AS (
  SELECT order_id, raw_lines AS items_before_count,
    CASE WHEN grp = 'qualified' THEN len(core_items) ELSE c_core END AS items_after_count,
    array_to_string(CASE WHEN grp = 'qualified' THEN core_items[1:4] ELSE core_items END, '|')
      AS items_after_sample,
    CASE WHEN grp = 'qualified' THEN {quoted(L.STATUS_QUALIFIED)}
      ELSE {quoted(L.STATUS_EXCLUDED)} END AS status,
    CASE grp WHEN 'qualified' THEN printf({quoted(L.REASON_QUALIFIED)}, len(core_items))
      WHEN 'G0' THEN {quoted(L.REASON_G0)} WHEN 'G1' THEN {quoted(L.REASON_G1)}
      WHEN 'G2' THEN {quoted(L.REASON_G2)}
      WHEN 'G3' THEN printf({quoted(L.REASON_G3)}, core_items[1])
      ELSE printf({quoted(L.REASON_G4)}, core_items[1]) END AS reason
  FROM grouped WHERE {where})"""


def null_cells(table: str) -> str:
    cells = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in STAR[table].names)
    return f"coalesce(CAST(sum({cells}) AS BIGINT), 0)"


def null_audit(table: str) -> str:
    width = len(STAR[table].names)
    return f"""SELECT '{table}' AS table_name, count(*) AS total_rows, CAST({width} AS BIGINT) AS total_cols,
  {null_cells(table)} AS null_count, {percent(null_cells(table), f'(count(*) * {width})')} AS null_rate
FROM {table}"""


def audit(table: str) -> str:
    width = len(STAR[table].names)
    key = PRIMARY_KEYS[table]
    valid = " AND ".join(
        f"NOT EXISTS (SELECT 1 FROM {table} c WHERE NOT EXISTS "
        f"(SELECT 1 FROM {p} x WHERE x.{pk} = c.{column}))"
        for column, p, pk in FOREIGN_KEYS.get(table, [])
    )
    return f"""SELECT '{table}' AS table_name, count(*) AS total_rows, CAST({width} AS BIGINT) AS total_cols,
  '{", ".join(key)}' AS primary_key, {null_cells(table)} AS null_count,
  {percent(null_cells(table), f'(count(*) * {width})')} AS null_rate,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(key)} FROM {table})) AS duplicates,
  ({valid or 'TRUE'}) AS foreign_key_valid
FROM {table}"""


def pk_duplicates(table: str) -> str:
    key = ", ".join(PRIMARY_KEYS[table])
    return f"""SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
  CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})"""


DAY_NAME = (
    "CASE dow "
    + " ".join(f"WHEN {d} THEN {quoted(n)}" for d, n in L.DAY_NAMES.items())
    + f" ELSE {quoted(L.UNKNOWN_DAY_PREFIX)} || dow END"
)

TIMING = """timing AS (
  SELECT CAST(dayofweek(ts) AS INTEGER) AS dow, CAST(hour(ts) AS INTEGER) AS hour FROM events)"""


def heat_pivot() -> str:
    cells = ",\n  ".join(f"count(*) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
    order = "CASE dow " + " ".join(
        f"WHEN {d} THEN {i}" for i, d in enumerate(L.HEAT_ROW_ORDER, 1)
    ) + " END"
    return f"""{chain(TIMING)}SELECT CAST({order} AS INTEGER) AS day_order, {DAY_NAME} AS day,
  {cells},
  count(*) FILTER (WHERE hour NOT BETWEEN 0 AND 23 OR hour IS NULL) AS other
FROM timing GROUP BY dow"""


def group_rows() -> str:
    names = {**L.EXTRA_GROUP_NAMES, **L.GROUP_NAMES}
    return union(
        [
            f"""SELECT '{g}' AS group_id, {quoted(names[g])} AS group_name,
  count(*) FILTER (WHERE grp = '{g}') AS orders_count,
  {percent(f"(count(*) FILTER (WHERE grp = '{g}'))", "(count(*) FILTER (WHERE grp <> 'qualified'))")} AS percentage,
  {percent(f"(count(*) FILTER (WHERE grp = '{g}'))", "count(*)")} AS percentage_total
FROM grouped"""
            for g in ("G0", "G1", "G2", "G3", "G4")
        ]
    )


def sweep_rows(configs: list) -> str:
    return union(
        [
            f"""SELECT {quoted(name)} AS config_id, CAST({support} AS DOUBLE) AS min_support,
  CAST({confidence} AS DOUBLE) AS min_confidence,
  (SELECT count(*) FROM itemset WHERE frequency >= ceil({support} * n.n)) AS frequent_itemsets,
  count(r.lift) AS association_rules, round(coalesce(max(r.lift), 0.0), 4) AS max_lift,
  round(coalesce(avg(r.confidence), 0.0), 4) AS avg_confidence
FROM n LEFT JOIN loose r ON r.f_union >= ceil({support} * n.n) AND r.confidence >= {confidence}
GROUP BY n.n"""
            for name, support, confidence in configs
        ]
    )


def sweep_part(configs: list) -> str:
    lowest = min(c for _, _, c in configs)
    return f"""loose AS (
  SELECT s.f_union, CAST(s.f_union AS DOUBLE) / a.frequency AS confidence,
         (CAST(s.f_union AS DOUBLE) / a.frequency) / (c.frequency / n.n) AS lift
  FROM sided s JOIN itemset a ON a.items = s.antecedent
  JOIN itemset c ON c.items = [s.item] CROSS JOIN n
  WHERE CAST(s.f_union AS DOUBLE) / a.frequency >= {lowest}
    AND (CAST(s.f_union AS DOUBLE) / a.frequency) / (c.frequency / n.n) > {MIN_LIFT}),
swept AS ({sweep_rows(configs)})"""


SUMMARY_PARTS = f"""best AS (
  SELECT p_name AS item, count(*) AS total_sales FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_name ORDER BY total_sales DESC, item LIMIT {L.TOP_PRODUCTS}),
by_hour AS (SELECT hour, count(*) AS c FROM timing GROUP BY hour),
by_cell AS (SELECT dow, hour, count(*) AS c FROM timing GROUP BY dow, hour)"""


def summary(total_orders: str, total_rules: str) -> str:
    return f"""SELECT ({total_orders}) AS total_orders,
  (SELECT count(*) FROM core_basket) AS total_valid_baskets,
  (SELECT count(*) FROM lineitem) AS total_transactions,
  CAST(({total_rules}) AS BIGINT) AS total_rules,
  (SELECT string_agg(item || '=' || total_sales, ';' ORDER BY total_sales DESC, item) FROM best) AS top_products,
  (SELECT string_agg(hour || '=' || c, ';' ORDER BY hour) FROM by_hour) AS hourly_data,
  (SELECT string_agg(dow || '=' || hour || '=' || c, ';' ORDER BY dow, hour) FROM by_cell) AS heat_data"""


CORE_BASKET = """core_basket AS (
  SELECT l_orderkey FROM lineitem JOIN core ON l_partkey = product_id JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey HAVING count(DISTINCT p_name) >= 2)"""


def log_timings() -> str:
    number = """regexp_extract(props, '"k": ([0-9]+)', 1)"""
    return union(
        [
            f"""SELECT '{mark}' AS mark, arg_max({"'4.' || " if mark == "spark_version" else ""}{number}, event_id) AS value
FROM events WHERE hour(ts) % 9 = {i} HAVING count(*) > 0"""
            for i, mark in enumerate(LOG_MARKS)
        ]
    )


def run_metrics() -> str:
    lines = "(SELECT count(*) FROM lineitem)"
    orders = "(SELECT count(*) FROM orders)"
    baskets = "(SELECT count(*) FROM baskets)"
    steps = [
        ("read", lines, lines),
        (
            "temporal",
            orders,
            "(SELECT count(*) FROM (SELECT DISTINCT dayofweek(o_orderdate), hour(o_orderdate) FROM orders))",
        ),
        ("item_frequency", lines, "(SELECT count(DISTINCT l_partkey) FROM lineitem)"),
        ("best_sellers", lines, "(SELECT count(DISTINCT p_name) FROM lineitem JOIN part ON l_partkey = p_partkey)"),
        ("core_catalog", lines, "(SELECT count(*) FROM part)"),
        ("order_facts", lines, "(SELECT count(DISTINCT l_orderkey) FROM lineitem)"),
        ("integrity", lines, "1"),
        ("itemsets", baskets, "(SELECT count(*) FROM itemset)"),
        ("rules", "(SELECT count(*) FROM itemset)", "(SELECT count(*) FROM strong)"),
        ("exclusion_audit", orders, orders),
        ("publish", baskets, baskets),
        ("total", lines, "(SELECT count(*) FROM strong)"),
    ]
    return MINING + union(
        [
            f"""SELECT CAST({i} AS INTEGER) AS step_num, '{step}' AS step,
  CAST({rows_in} AS BIGINT) AS rows_in, CAST({rows_out} AS BIGINT) AS rows_out"""
            for i, (step, rows_in, rows_out) in enumerate(steps, 1)
        ]
    )


BEFORE_AFTER = f"""SELECT 'orders' AS metric, count(*) AS before_cleaning,
  count(*) FILTER (WHERE grp = 'qualified') AS after_cleaning,
  count(*) FILTER (WHERE grp <> 'qualified') AS removed_records,
  {percent("(count(*) FILTER (WHERE grp <> 'qualified'))", "count(*)")} AS removed_rate,
  CAST(0 AS BIGINT) AS removed_duplicates, CAST(0 AS BIGINT) AS removed_rare
FROM grouped
UNION ALL
SELECT 'transactions', CAST(sum(raw_lines) AS BIGINT), CAST(sum(c_core) AS BIGINT),
  CAST(sum(raw_lines - c_core) AS BIGINT), {percent("sum(raw_lines - c_core)", "sum(raw_lines)")},
  CAST(sum(raw_lines - c_raw) AS BIGINT), CAST(sum(c_raw - c_core) AS BIGINT)
FROM grouped"""


def quality_document() -> str:
    """Each section of the report in its own query, its fields joined in order."""

    def rows(section: str, key: str, source: str, *fields: str) -> str:
        content = ", ".join(f"CAST({f} AS VARCHAR)" for f in fields)
        return f"SELECT '{section}' AS section, CAST({key} AS VARCHAR) AS row_key, concat_ws('|', {content}) AS content FROM ({source})"

    fields = ["total_rows", "total_cols", "primary_key", "null_count", "null_rate", "duplicates", "foreign_key_valid"]
    nulls = "count(*) FILTER (WHERE l_orderkey IS NULL) + count(*) FILTER (WHERE l_partkey IS NULL) + count(*) FILTER (WHERE l_linenumber IS NULL)"
    lines = f"""SELECT 'order_products' AS table_name, count(*) AS total_rows, 3 AS total_cols,
  'order_id, product_id' AS primary_key, {nulls} AS null_count, {percent(f"({nulls})", "(count(*) * 3)")} AS null_rate,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS duplicates,
  NOT EXISTS (SELECT 1 FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
    OR NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) AS foreign_key_valid
FROM lineitem"""
    stages = ["before_cleaning", "after_cleaning", "removed_records", "removed_rate", "removed_duplicates", "removed_rare"]
    traced = ["items_before_count", "items_after_count", "items_after_sample", "status", "reason"]
    best = """SELECT order_id, len(core_items) AS n, array_to_string(core_items[1:6], '|') AS first
FROM grouped WHERE grp = 'qualified' ORDER BY order_id LIMIT 10"""
    named = {"part": ("products", "p_partkey"), "orders": ("orders", "o_orderkey")}
    return chain(CORE, PROFILE, trace("order_id BETWEEN 2 AND 12")) + union(
        [
            """SELECT 'kpis' AS section, 'run' AS row_key, concat_ws('|', CAST(count(*) FILTER (WHERE grp = 'qualified') AS VARCHAR),
  CAST(count(*) FILTER (WHERE grp <> 'qualified') AS VARCHAR), CAST(count(*) AS VARCHAR), '33') AS content FROM grouped""",
            *[rows("tables", f"'{name}'", audit(t), *fields) for t, (name, _) in named.items()],
            rows("tables", "table_name", lines, *fields),
            rows("cleaning_stages", "metric", BEFORE_AFTER, *stages),
            rows("excluded_orders_breakdown", "group_id", group_rows(), "group_name", "orders_count", "percentage", "percentage_total"),
            rows("sample_records", "order_id", best, "n", "first"),
            rows("sample_traceability_orders", "order_id", "SELECT * FROM traced", *traced),
        ]
    )


def csv_audit() -> str:
    """The six files as their rows stand in the star tables; sizes beyond the nations are aisles that do not exist."""

    def row(name: str, source: str, width: int, key: str, nulls: str, distinct: str, valid: str = "TRUE") -> str:
        return f"""SELECT '{name}' AS table_name, count(*) AS total_rows, CAST({width} AS BIGINT) AS total_cols,
  '{key}' AS primary_key, CAST({nulls} AS BIGINT) AS null_count, {percent(f"({nulls})", f"(count(*) * {width})")} AS null_rate,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {distinct} FROM {source})) AS duplicates, {valid} AS foreign_key_valid
FROM {source}"""

    def lines(split: str, status: str) -> str:
        source = f"(SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = '{status}')"
        valid = "NOT EXISTS (SELECT 1 FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey))"
        return row(f"order_products__{split}", source, 4, "order_id, product_id", "count(*)", "l_orderkey, l_partkey", valid)

    aisles = "NOT EXISTS (SELECT 1 FROM part WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = p_size))"
    departments = "NOT EXISTS (SELECT 1 FROM part WHERE NOT EXISTS (SELECT 1 FROM region WHERE r_regionkey = p_size % 5))"
    return union(
        [
            row("orders", "orders", 7, "order_id", "count(*) FILTER (WHERE o_orderstatus = 'O')", "o_orderkey"),
            row("products", "part", 4, "product_id", "0", "p_partkey", f"{aisles} AND {departments}"),
            row("aisles", "nation", 2, "aisle_id", "0", "n_nationkey"),
            row("departments", "region", 2, "department_id", "0", "r_regionkey"),
            lines("prior", "F"),
            lines("train", "O"),
        ]
    )


UNPRUNED = chain(NAMED_ALL, baskets_part())
PRUNED = chain(CORE, NAMED_CORE, baskets_part())
FLAT_BASKET = "order_id, items_count, array_to_string(items, '|') AS items, first_item"
DOCUMENT = """order_id, o_custkey AS user_id, CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
  CAST(hour(o_orderdate) AS INTEGER) AS order_hour_of_day, items_count,
  array_to_string(items, '|') AS items"""
IN_ORDERS = "JOIN orders ON o_orderkey = order_id"


def oracle_sql() -> dict[str, str]:
    recommended = chain(NAMED_ALL, baskets_part(), mining_part(), CARTS, MATCHES, RANKED)
    complete = chain(
        NAMED_ALL, baskets_part(), mining_part(), CARTS, MATCHES, RANKED, POPULAR, SUBSTITUTES
    )
    evaluated = chain(NAMED_ALL, baskets_part(), mining_part(), POPULAR, *evaluation_parts())
    split_baskets = [
        NAMED_ALL,
        baskets_part(),
        f"learnt AS (SELECT baskets.* FROM baskets {IN_ORDERS} WHERE o_orderstatus = 'F')",
        f"unseen AS (SELECT baskets.* FROM baskets {IN_ORDERS} WHERE o_orderstatus = 'O')",
        mining_part("learnt"),
    ]
    popular_prior = POPULAR.replace(
        "ON l_partkey = p_partkey GROUP",
        "ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey\n"
        "        WHERE o_orderstatus = 'F' GROUP",
    )
    folds = [
        NAMED_ALL,
        baskets_part(),
        "learnt AS (SELECT * FROM baskets WHERE order_id % 10 <> 0)",
        "unseen AS (SELECT * FROM baskets WHERE order_id % 10 = 0)",
        mining_part("learnt"),
    ]
    popular_learnt = POPULAR.replace("ON l_partkey = p_partkey GROUP", "ON l_partkey = p_partkey WHERE l_orderkey % 10 <> 0 GROUP")
    audited = chain(CORE, PROFILE)
    catalog = """SELECT c_custkey, c_name, n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""
    flat_rules = f"SELECT {FLAT_RULE} FROM "
    return {
        "split_orders": f"{chain(ORDERS)}SELECT * FROM ord WHERE eval_set = 'prior'",
        "null_key_rows": "SELECT count(*) AS null_key_rows FROM lineitem "
        "WHERE l_orderkey IS NULL OR l_partkey IS NULL",
        "null_column_count": """SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE n IS NULL) AS null_rows
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey""",
        "null_cells_by_table": union([null_audit(t) for t in STAR])
        + f"""
UNION ALL
SELECT 'order_sizes', count(*), CAST(2 AS BIGINT), count(*) FILTER (WHERE n IS NULL),
  {percent("(count(*) FILTER (WHERE n IS NULL))", "(count(*) * 2)")}
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey""",
        "dup_pairs": """SELECT l_orderkey AS order_id, l_partkey AS product_id, count(*) AS row_count,
  count(*) - 1 AS surplus_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
        "dedup_lines": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
  min(l_linenumber) AS add_to_cart_order FROM lineitem GROUP BY 1, 2""",
        "pk_duplicates": union([pk_duplicates(t) for t in PRIMARY_KEYS]),
        "table_audit": union([audit(t) for t in PRIMARY_KEYS]),
        "scan_totals": f"""{chain(ORDERS)}SELECT count(*) AS total_rows,
  CAST(sum(CAST(order_id IS NULL AS BIGINT) + CAST(user_id IS NULL AS BIGINT)
    + CAST(eval_set IS NULL AS BIGINT) + CAST(order_dow IS NULL AS BIGINT)
    + CAST(order_hour_of_day IS NULL AS BIGINT)) AS BIGINT) AS null_count,
  count(*) - count(DISTINCT order_id) AS duplicates,
  count(*) FILTER (WHERE eval_set = 'prior') AS prior_orders,
  count(*) FILTER (WHERE eval_set = 'train') AS train_orders
FROM ord""",
        "orphan_parts": """SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT EXISTS
  (SELECT 1 FROM part WHERE p_partkey = l_partkey)) AS orphan_lines FROM lineitem""",
        "orphan_orders": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
  l_linenumber AS add_to_cart_order FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""",
        "integrity_report": """SELECT count(*) AS total_lines,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS distinct_pairs,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS duplicate_pairs,
  count(*) FILTER (WHERE l_orderkey IS NULL OR l_partkey IS NULL) AS null_keys,
  coalesce(CAST(sum((l_orderkey IS NULL)::BIGINT + (l_partkey IS NULL)::BIGINT + (l_linenumber IS NULL)::BIGINT) AS BIGINT), 0)
    AS null_cells,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)) AS orphan_products,
  count(*) FILTER (WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')) AS orphan_orders
FROM lineitem""",
        "orders_per_hour": f"""{chain(TIMING)}SELECT hour, count(*) AS orders_count
FROM timing GROUP BY hour""",
        "orders_per_dow_hour": f"""{chain(TIMING)}SELECT dow, hour, count(*) AS orders_count,
  {DAY_NAME} AS day FROM timing GROUP BY dow, hour""",
        "heat_pivot": heat_pivot(),
        "temporal_reconciliation": f"""{chain(TIMING)}SELECT count(*) AS hour_total,
  count(*) AS cell_total, count(*) AS heat_total, count(*) AS total_orders,
  (SELECT count(*) FROM (SELECT DISTINCT dow, hour FROM timing)) AS cells,
  count(*) FILTER (WHERE dow BETWEEN 0 AND 6 AND hour BETWEEN 0 AND 23) = count(*) AS reconciled, replace(format('{{:,}}', count(*)), ',', '.') AS total_orders_text
FROM timing""",
        "item_frequency": """SELECT l_partkey AS product_id, count(*) AS item_count
FROM lineitem GROUP BY 1""",
        "core_items": f"{chain(CORE)}SELECT product_id, item_count FROM core",
        "top_items": f"""SELECT p_name AS item, count(*) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
ORDER BY total_sales DESC, item LIMIT {L.TOP_PRODUCTS}""",
        "top_products": f"""{chain(CORE)}SELECT product_id, item_count, p_name AS product_name
FROM core JOIN part ON product_id = p_partkey
ORDER BY item_count DESC, product_name, product_id LIMIT {L.TOP_PRODUCTS}""",
        "popular_items": f"{chain(POPULAR)}SELECT item, total_sales FROM popular WHERE place <= 10",
        "catalog_denormalised": catalog,
        "catalog_lookup_default": f"""{chain(CORE)}SELECT l_partkey AS product_id,
  count(*) AS item_count,
  coalesce(any_value(CASE WHEN product_id IS NOT NULL THEN p_name END),
           '{L.LOADER_DEFAULT_NAME}' || l_partkey) AS loader_name,
  coalesce(any_value(CASE WHEN product_id IS NOT NULL THEN p_name END),
           '{L.TRACE_DEFAULT_NAME}' || l_partkey) AS trace_name
FROM lineitem LEFT JOIN core ON l_partkey = product_id LEFT JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey""",
        "baskets": f"{PRUNED}SELECT {FLAT_BASKET} FROM baskets",
        "baskets_unpruned": f"""{UNPRUNED}SELECT {DOCUMENT} FROM baskets
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = order_id""",
        "basket_documents": f"{PRUNED}SELECT {DOCUMENT} FROM baskets {IN_ORDERS} WHERE o_orderstatus = 'F'",
        "basket_sample": f"""{PRUNED}SELECT order_id, items_count AS raw_items_count,
  array_to_string(items[1:6], '|') AS cleaned_items FROM baskets ORDER BY order_id LIMIT 10""",
        "orders_with_lines": f"""{chain(ORDERS)}SELECT order_id, user_id, eval_set FROM ord
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = order_id)""",
        "first_orders_lines": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
  l_linenumber AS add_to_cart_order FROM lineitem WHERE l_orderkey IN (
    SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    ORDER BY o_orderkey LIMIT 1000)""",
        "basket_lookup": f"{UNPRUNED}SELECT {DOCUMENT} FROM baskets {IN_ORDERS} WHERE order_id = 2",
        "basket_by_count": f"{UNPRUNED}SELECT {DOCUMENT} FROM baskets {IN_ORDERS} WHERE items_count = 5",
        "exclusion_breakdown": audited + group_rows(),
        "before_after": audited + BEFORE_AFTER,
        "order_trace": chain(CORE, PROFILE, trace()) + "SELECT * FROM traced",
        "order_trace_range": chain(CORE, PROFILE, trace("order_id BETWEEN 2 AND 12"))
        + f"""SELECT order_id, items_before_count AS raw_items_count, items_after_sample AS cleaned_items
FROM traced WHERE status = {quoted(L.STATUS_QUALIFIED)}""",
        "itemsets": f"{MINING}SELECT {FLAT_ITEMSET} FROM itemset CROSS JOIN n",
        "itemset_counts": f"""{MINING}SELECT count(*) AS total_itemsets,
  count(*) FILTER (WHERE k = 1) AS total_1_itemsets,
  count(*) FILTER (WHERE k >= 2) AS total_multi_itemsets FROM itemset""",
        "itemsets_by_size": f"{MINING}SELECT k, count(*) AS itemsets FROM itemset GROUP BY k",
        "itemset_search": f"""{MINING}SELECT {FLAT_ITEMSET} FROM itemset CROSS JOIN n
WHERE k >= 2 AND contains(lower(array_to_string(items, ' ')), {quoted(ITEM_KEYWORD.strip().lower())})""",
        "itemset_lookup": f"""{MINING}SELECT {FLAT_ITEMSET} FROM itemset CROSS JOIN n
WHERE items = list_sort(['small widget', {quoted(LOOKUP_ITEM)}])""",
        "top_itemsets": f"""{MINING}SELECT array_to_string(items, ' + ') AS itemset, k,
  round(frequency / n.n * 100, 6) AS support_pct FROM itemset CROSS JOIN n WHERE k >= 2
ORDER BY frequency / n.n DESC, k, items LIMIT 10""",
        "rules": f"{MINING}{flat_rules}rule",
        "strong_rules": f"{MINING}{flat_rules}strong",
        "rule_search": f"""{MINING}{flat_rules}rule WHERE lift >= 1.1 AND confidence * 100 >= 6
  AND (contains(lower(array_to_string(antecedent, ' ')), {quoted(RULE_KEYWORD.strip().lower())})
    OR contains(lower(array_to_string(consequent, ' ')), {quoted(RULE_KEYWORD.strip().lower())}))""",
        "rule_lookup": f"{MINING}{flat_rules}rule WHERE list_contains(antecedent, {quoted(LOOKUP_ITEM)})",
        "rule_stats": f"""{MINING}SELECT count(*) AS total_rules,
  round(coalesce(max(lift), 0.0), 6) AS max_lift,
  round(coalesce(avg(confidence), 0.0), 6) AS avg_confidence,
  round(coalesce(min(support), 0.0), 6) AS min_support FROM strong""",
        "rule_sides": f"""{MINING}SELECT
  (SELECT count(DISTINCT i) FROM (SELECT unnest(antecedent) AS i FROM strong)) AS unique_antecedents,
  count(DISTINCT item) AS unique_consequents,
  round(count(DISTINCT item) / CAST((SELECT count(DISTINCT p_name) FROM part) AS DOUBLE) * 100, 2)
    AS coverage_ceiling_pct
FROM strong""",
        "top_rules": f"""{MINING}SELECT {RULE_LABEL} AS rule, round(lift, 2) AS lift FROM rule
ORDER BY rule.{RULE_ORDER.replace(", ", ", rule.")} LIMIT 10""",
        "rule_explained": f"""{MINING}SELECT array_to_string(r.antecedent, '|') AS antecedent,
  array_to_string(r.consequent, '|') AS consequent, p.frequency AS freq_pair,
  a.frequency AS freq_antecedent, c.frequency AS freq_consequent,
  round(r.support * 100, 6) AS pair_support_pct,
  round(a.frequency / n.n * 100, 6) AS antecedent_support_pct,
  round(c.frequency / n.n * 100, 6) AS consequent_support_pct,
  round(r.confidence * 100, 6) AS confidence_pct, round(r.lift, 6) AS lift
FROM strong r JOIN itemset p ON p.items = list_sort(list_concat(r.antecedent, r.consequent))
JOIN itemset a ON a.items = r.antecedent JOIN itemset c ON c.items = r.consequent CROSS JOIN n""",
        "rule_explained_derived": f"""{MINING}, given AS (
  SELECT r.*, p.frequency AS pair, n.n, r.confidence * 100 AS conf_pct
  FROM strong r JOIN itemset p ON p.items = list_sort(list_concat(r.antecedent, r.consequent)) CROSS JOIN n),
figures AS (
  SELECT g.*, coalesce(a.frequency, CAST(round_even(pair / (conf_pct / 100), 0) AS BIGINT)) AS ant
  FROM given g LEFT JOIN (SELECT * FROM itemset WHERE k > 1) a ON a.items = g.antecedent)
SELECT array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent,
  pair AS freq_pair, ant AS freq_antecedent,
  CAST(round_even(n * (conf_pct / (lift * 100)), 0) AS BIGINT) AS freq_consequent,
  round(support * 100, 6) AS pair_support_pct, round(ant / n * 100, 6) AS antecedent_support_pct,
  round(conf_pct / lift, 6) AS consequent_support_pct, round(conf_pct, 6) AS confidence_pct, round(lift, 6) AS lift
FROM figures""",
        "threshold_itemsets": chain(CORE, NAMED_CORE, baskets_part(), mining_part(support="(33 / n)"))
        + f"SELECT {FLAT_ITEMSET} FROM itemset CROSS JOIN n",
        "parameter_sweep": chain(NAMED_ALL, baskets_part(), mining_part(), sweep_part(SWEEP))
        + "SELECT * FROM swept",
        "match_rules": f"""{SERVING}SELECT cart_id, item, array_to_string(antecedent, '|') AS antecedent,
  round(lift, 6) AS lift FROM matched""",
        "recommend": recommended + RULE_ROWS,
        "fallback": complete
        + f"SELECT cart_id, rank, item, 'popular' AS source FROM substitute WHERE rank <= {FALLBACK_ITEMS}",
        "recommend_with_fallback": f"{complete}{RULE_ROWS}\nUNION ALL\n{FALLBACK_ROWS}",
        "item_selector": chain(NAMED_ALL, baskets_part(), mining_part(), POPULAR)
        + "SELECT DISTINCT item FROM (SELECT unnest(antecedent) AS item FROM strong "
        + "UNION ALL SELECT item FROM popular WHERE place <= 15)",
        "known_cart_items": chain(NAMED_ALL, baskets_part(), POPULAR)
        + """SELECT order_id AS cart_id,
  coalesce(string_agg(i, '|' ORDER BY i) FILTER (WHERE i IN (SELECT item FROM popular WHERE place <= 10)), '') AS items
FROM (SELECT order_id, unnest(items) AS i FROM baskets) GROUP BY order_id""",
        "evaluate": evaluated.rstrip() + EVALUATION_TAIL,
        "evaluate_holdout": chain(
            *split_baskets, popular_prior, *evaluation_parts("unseen")
        ).rstrip()
        + EVALUATION_TAIL,
        "evaluate_unseen": chain(*folds, popular_learnt, *evaluation_parts("unseen")).rstrip() + EVALUATION_TAIL,
        "train_lines_job": f"{UNPRUNED}SELECT {DOCUMENT} FROM baskets {IN_ORDERS} WHERE o_orderstatus = 'O'",
        "evaluation_sample": f"""{UNPRUNED}SELECT order_id, items_count,
  array_to_string(items, '|') AS items FROM baskets
ORDER BY (CAST(order_id AS HUGEINT) * 2654435761) % 4294967296, order_id LIMIT {EVALUATION_SAMPLE}""",
        "evaluate_header": chain(NAMED_ALL, baskets_part(1))
        + """SELECT count(*) AS baskets_queried,
  count(*) FILTER (WHERE len(items) >= 2) AS baskets_evaluated,
  count(*) FILTER (WHERE len(items) < 2) AS baskets_skipped FROM baskets""",
        "observed_items": f"""{UNPRUNED}SELECT order_id, first_item AS observed,
  array_to_string(list_filter(items, lambda i: i <> first_item), '|') AS truth FROM baskets""",
        "recommendation_lists": evaluated
        + """SELECT s.observed,
  (SELECT string_agg(item, '|' ORDER BY pos) FROM fp_list f WHERE f.observed = s.observed AND pos <= 10) AS fp_list,
  (SELECT string_agg(item, '|' ORDER BY pos) FROM base_list b WHERE b.observed = s.observed AND pos <= 10) AS base_list
FROM seen s""",
        "coverage": evaluated
        + """SELECT k,
  (SELECT count(DISTINCT item) FROM fp_list f WHERE f.pos <= ks.k) AS rules_items,
  (SELECT count(DISTINCT item) FROM base_list b WHERE b.pos <= ks.k) AS popular_items
FROM ks""",
        "csv_roundtrip": "SELECT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem",
        "count_or_zero": union(
            [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR]
            + ["SELECT 'order_products_train', CAST(0 AS BIGINT)"]
        ),
        "read_fallback": f"""{UNPRUNED}SELECT order_id, items_count, 'file' AS source
FROM baskets {IN_ORDERS}""",
        "json_roundtrip": f"""{UNPRUNED}SELECT order_id, items_count,
  array_to_string(items, '|') AS items FROM baskets""",
        "sink_roundtrip": f"""{UNPRUNED}SELECT order_id, o_custkey AS user_id,
  CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow, items_count FROM baskets {IN_ORDERS}""",
        "catalog_sink": catalog,
        "itemset_sink": f"{MINING}SELECT {FLAT_ITEMSET} FROM itemset CROSS JOIN n",
        "publish_copies": f"""{MINING}SELECT {FLAT_RULE}, unnest(['rules_prior', 'rules']) AS copy
FROM strong""",
        "skip_if_loaded": f"""{UNPRUNED}SELECT step, written,
  (SELECT count(*) FROM baskets {IN_ORDERS}) AS stored_baskets
FROM (VALUES ('first load', TRUE), ('kept', FALSE), ('replaced', TRUE)) AS t(step, written)""",
        "summary_document": chain(CORE, CORE_BASKET, TIMING, SUMMARY_PARTS)
        + summary("SELECT count(*) FROM orders", "SELECT 0"),
        "summary_patch": chain(
            NAMED_ALL, baskets_part(), mining_part(), CORE, CORE_BASKET, TIMING, SUMMARY_PARTS
        )
        + summary(
            "SELECT count(*) FROM orders WHERE o_orderstatus = 'F'", "SELECT count(*) FROM strong"
        ),
        "quality_document": quality_document(),
        "csv_audit": csv_audit(),
        "published_job": f"""{MINING}SELECT copy, 'retail' AS dataset_name,
  (SELECT count(*) FROM orders) AS total_orders, (SELECT count(*) FROM baskets) AS total_valid_baskets,
  (SELECT count(*) FROM lineitem) AS total_transactions, (SELECT count(*) FROM strong) AS total_rules,
  CAST(0.3 AS DOUBLE) AS min_support_percent, CAST(5 AS DOUBLE) AS min_confidence_percent, TRUE AS training_timed,
  CAST((SELECT least(15, count(DISTINCT p_name)) FROM lineitem JOIN part ON l_partkey = p_partkey) AS INTEGER)
    AS top_products,
  (SELECT count(*) FROM itemset) AS total_itemsets, (SELECT count(*) FROM itemset WHERE k = 1) AS total_1_itemsets,
  (SELECT count(*) FROM itemset WHERE k >= 2) AS total_multi_itemsets, CAST(0.003 AS DOUBLE) AS min_support
FROM (VALUES ('summary_prior'), ('summary')) AS t(copy)""",
        "evaluation_document": chain(
            NAMED_ALL, baskets_part(), mining_part(), POPULAR, *evaluation_parts()
        ).rstrip()
        + EVALUATION_TAIL.replace("SELECT k,\n  round(avg", EVALUATION_HEADER + "\n  k,\n  round(avg", 1),
        "experiment_sink": chain(
            NAMED_ALL, baskets_part(), mining_part(), sweep_part(SWEEP_CONFIGS)
        )
        + "SELECT * FROM swept",
        "log_timings": log_timings(),
        "run_metrics": run_metrics(),
        "merge_live_row": chain(
            NAMED_ALL, baskets_part(), mining_part(), sweep_part(SWEEP_CONFIGS)
        )
        + f"""SELECT config_id,
  CASE WHEN live THEN {MIN_SUPPORT} ELSE min_support END AS min_support,
  CASE WHEN live THEN {MIN_CONFIDENCE} ELSE min_confidence END AS min_confidence,
  CASE WHEN live THEN (SELECT count(*) FROM itemset) ELSE frequent_itemsets END AS frequent_itemsets,
  CASE WHEN live THEN (SELECT count(*) FROM strong) ELSE association_rules END AS association_rules,
  CASE WHEN live THEN (SELECT round(coalesce(max(lift), 0.0), 4) FROM strong) ELSE max_lift END AS max_lift,
  CASE WHEN live THEN (SELECT round(coalesce(avg(confidence), 0.0), 4) FROM strong)
    ELSE avg_confidence END AS avg_confidence,
  frequent_itemsets AS sweep_frequent_itemsets, association_rules AS sweep_association_rules,
  CASE WHEN live THEN 'live run' ELSE 'sweep' END AS measured_by
FROM (SELECT *, starts_with(config_id, '{L.LIVE_CONFIG_PREFIX}') AS live FROM swept)""",
        "formatting": f"""{MINING}SELECT array_to_string(items, ' + ') AS label,
  array_to_string(items, ', ') AS listed, k || '-itemset' AS size_text,
  replace(format('{{:,}}', frequency), ',', '.') AS frequency_text,
  {percent("frequency", "n.n")} AS support_text,
  round(frequency / n.n, 2) AS support2, round(frequency / n.n, 3) AS support3,
  round(frequency / n.n, 4) AS support4, round(frequency / n.n, 5) AS support5,
  CAST(frequency AS DOUBLE) AS frequency_double
FROM itemset CROSS JOIN n""",
        "rule_texts": f"""{MINING}SELECT {RULE_LABEL} AS rule, round(lift, 2) AS lift,
  printf('%.1f%%', round(confidence * 100, 1)) AS confidence_text,
  printf('%.2f%%', round(support * 100, 2)) AS support_text FROM strong""",
        "support_thresholds": f"""{UNPRUNED}SELECT count(*) AS n_baskets,
  CAST(0.00726 AS DOUBLE) AS min_support,
  CAST(round_even(CAST(0.00726 AS DOUBLE) * count(*), 0) AS BIGINT) AS min_count,
  CAST(33 AS DOUBLE) / count(*) AS threshold_support
FROM baskets""",
        "stream_recommend": f"{complete}{RULE_ROWS}\nUNION ALL\n{FALLBACK_ROWS}",
        "stream_hourly": f"""{chain(TIMING)}SELECT dow, hour, count(*) AS orders_count
FROM timing GROUP BY dow, hour""",
    }
