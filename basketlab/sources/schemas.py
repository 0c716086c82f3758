"""Schemas of the retail tables and of the stored results."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


INT, LONG, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
ITEMS = T.ArrayType(STRING)

ORDERS = _struct(
    ("order_id", INT),
    ("user_id", INT),
    ("eval_set", STRING),
    ("order_number", INT),
    ("order_dow", INT),
    ("order_hour_of_day", INT),
    ("days_since_prior_order", DOUBLE),
)
ORDER_PRODUCTS = _struct(
    ("order_id", INT), ("product_id", INT), ("add_to_cart_order", INT), ("reordered", INT)
)
PRODUCTS = _struct(
    ("product_id", INT), ("product_name", STRING), ("aisle_id", INT), ("department_id", INT)
)
AISLES = _struct(("aisle_id", INT), ("aisle", STRING))
DEPARTMENTS = _struct(("department_id", INT), ("department", STRING))

BASKET_LINES = _struct(("order_id", LONG), ("items", ITEMS))
BASKET_DOCUMENTS = _struct(
    ("order_id", LONG),
    ("user_id", LONG),
    ("order_dow", INT),
    ("order_hour_of_day", INT),
    ("items_count", INT),
    ("items", ITEMS),
)
CARTS = _struct(("cart_id", LONG), ("items", ITEMS))
ITEMSETS = _struct(("items", ITEMS), ("k", INT), ("frequency", LONG), ("support", DOUBLE))
RULES = _struct(
    ("antecedent", ITEMS),
    ("consequent", ITEMS),
    ("confidence", DOUBLE),
    ("lift", DOUBLE),
    ("support", DOUBLE),
)

# The star schema that the queries run on.
NTZ = T.TimestampNTZType()
STAR = {
    "region": _struct(("r_regionkey", INT), ("r_name", STRING)),
    "nation": _struct(("n_nationkey", INT), ("n_name", STRING), ("n_regionkey", INT)),
    "customer": _struct(
        ("c_custkey", LONG),
        ("c_name", STRING),
        ("c_nationkey", INT),
        ("c_acctbal", DOUBLE),
        ("c_mktsegment", STRING),
    ),
    "supplier": _struct(
        ("s_suppkey", LONG), ("s_name", STRING), ("s_nationkey", INT), ("s_acctbal", DOUBLE)
    ),
    "part": _struct(
        ("p_partkey", LONG),
        ("p_name", STRING),
        ("p_brand", STRING),
        ("p_type", STRING),
        ("p_size", INT),
        ("p_retailprice", DOUBLE),
    ),
    "orders": _struct(
        ("o_orderkey", LONG),
        ("o_custkey", LONG),
        ("o_orderstatus", STRING),
        ("o_totalprice", DOUBLE),
        ("o_orderdate", NTZ),
        ("o_orderpriority", STRING),
    ),
    "lineitem": _struct(
        ("l_orderkey", LONG),
        ("l_partkey", LONG),
        ("l_suppkey", LONG),
        ("l_linenumber", INT),
        ("l_quantity", DOUBLE),
        ("l_extendedprice", DOUBLE),
        ("l_discount", DOUBLE),
        ("l_tax", DOUBLE),
        ("l_returnflag", STRING),
        ("l_linestatus", STRING),
        ("l_shipdate", NTZ),
    ),
    "events": _struct(
        ("event_id", LONG),
        ("ts", NTZ),
        ("user_id", LONG),
        ("event_type", STRING),
        ("value", DOUBLE),
        ("props", STRING),
    ),
}
