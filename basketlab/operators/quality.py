"""Integrity checks: nulls, duplicates, references, table audits.

Counts over keys aggregate by key first.  Partial aggregation then shrinks a key
that holds a large share of all rows to one row per task before anything moves, and
the joins against dimension tables see each key once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketlab.functions.text import percent_text


def _zero_if_null(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("long")


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which any of the keys is null."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(column).isNull()).alias("null_rows")
    )


def null_cells(columns: Sequence[str]) -> Column:
    """Number of null cells of a row."""
    return reduce(
        lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("long") for c in columns], F.lit(0)
    )


def null_audit(df: DataFrame, table_name: str) -> DataFrame:
    """Null cells of a whole table and their share of all cells."""
    width = len(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _zero_if_null(F.sum(null_cells(df.columns))).alias("null_count"),
    ).select(
        F.lit(table_name).alias("table_name"),
        "total_rows",
        F.lit(width).cast("long").alias("total_cols"),
        "null_count",
        F.coalesce(
            percent_text(F.col("null_count"), F.col("total_rows") * width), F.lit("0.00%")
        ).alias("null_rate"),
    )


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key with the number of rows ``n`` behind it."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def dedup_lines(lines: DataFrame, key: Sequence[str] = ("order_id", "product_id")) -> DataFrame:
    """Distinct (order, product) pairs; the earliest cart position stands for the pair."""
    return lines.groupBy(*key).agg(F.min("add_to_cart_order").alias("add_to_cart_order"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of surplus rows."""
    return (
        key_counts(df, key)
        .filter(F.col("n") > 1)
        .select(*key, F.col("n").alias("row_count"), (F.col("n") - 1).alias("surplus_rows"))
    )


def pk_duplicates(df: DataFrame, table_name: str, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows that repeat an earlier key, over the whole table."""
    return key_counts(df, key).agg(
        F.lit(table_name).alias("table_name"),
        _zero_if_null(F.sum("n")).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        _zero_if_null(F.sum(F.col("n") - 1)).alias("duplicates"),
    )


def scan_totals(df: DataFrame, key: Sequence[str], split_column: str) -> DataFrame:
    """Totals of one scan: rows, null cells, key duplicates, rows of the prior and train split."""
    return (
        df.groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(null_cells(df.columns)).alias("nulls"),
            F.count_if(F.col(split_column) == "prior").alias("prior"),
            F.count_if(F.col(split_column) == "train").alias("train"),
        )
        .agg(
            _zero_if_null(F.sum("n")).alias("total_rows"),
            _zero_if_null(F.sum("nulls")).alias("null_count"),
            _zero_if_null(F.sum(F.col("n") - 1)).alias("duplicates"),
            _zero_if_null(F.sum("prior")).alias("prior_orders"),
            _zero_if_null(F.sum("train")).alias("train_orders"),
        )
    )


def orphan_rows(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent; a null key has none.

    Parent keys are unique, so a hot key is heavy on the left side only, where
    adaptive execution splits it.
    """
    parents = parent.select(F.col(parent_key).alias("__parent"))
    return df.join(parents, df[key] == F.col("__parent"), "left_anti")


def orphan_total(counts: DataFrame, key: str, parent: DataFrame, parent_key: str) -> Column:
    """Rows without a parent, summed over key counts (key, n).

    A left join, because an anti join would be pushed below the counting and make the
    raw rows travel instead of one row per key.
    """
    parents = parent.select(F.col(parent_key).alias("__parent"), F.lit(True).alias("__known"))
    return (
        counts.join(parents, counts[key] == F.col("__parent"), "left")
        .agg(_zero_if_null(F.sum(F.when(F.col("__known").isNull(), F.col("n")))))
        .scalar()
    )


def orphan_count(
    df: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str = "orphans"
) -> DataFrame:
    """Rows of the whole table and how many of them have no parent."""
    counts = key_counts(df.select(key), [key])
    return counts.agg(_zero_if_null(F.sum("n")).alias("total_rows")).withColumn(
        name, orphan_total(counts, key, parent, parent_key)
    )


def order_facts(lines: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """One pass over the lines; one row per order with all that sizes, baskets and audits need.

    raw_lines, c_raw distinct products, c_core of them in the catalog, null_key_lines,
    null_cells over all columns of the lines, core_items the distinct catalog names in
    order, first_item the one of them first put in the cart (the name decides ties).

    Lines are grouped to (order, product) pairs first, so an order or a pair that holds
    a large share of the lines is spread over tasks before its order is assembled from
    at most one row per product.
    """
    pairs = lines.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(null_cells(lines.columns)).alias("nulls"),
        F.min("add_to_cart_order").alias("position"),
    )
    if catalog is None:
        flagged = pairs.withColumns({"is_core": F.lit(None).cast("boolean"), "item": F.lit(None).cast("string")})
    else:
        known = catalog.select("product_id", F.col("product_name").alias("item"), F.lit(True).alias("is_core"))
        flagged = pairs.join(known, "product_id", "left")
    null_key = F.col("order_id").isNull() | F.col("product_id").isNull()
    named = F.when(F.col("item").isNotNull(), F.struct("position", "item"))
    return flagged.groupBy("order_id").agg(
        F.sum("n").alias("raw_lines"),
        F.count(F.lit(1)).alias("c_raw"),
        F.count("is_core").alias("c_core"),
        _zero_if_null(F.sum(F.when(null_key, F.col("n")))).alias("null_key_lines"),
        F.sum("nulls").alias("null_cells"),
        F.array_sort(F.collect_set("item")).alias("core_items"),
        F.min(named)["item"].alias("first_item"),
    )


def integrity_report(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    facts: DataFrame | None = None,
    frequency: DataFrame | None = None,
) -> DataFrame:
    """All line checks in one row, from one row per order and one per product.

    ``facts`` and ``frequency`` (see ``order_facts``, ``item_frequency``) save the
    counting when they are at hand.
    """
    if facts is None:
        facts = order_facts(lines)
    if frequency is None:
        frequency = lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("item_count"))
    by_product = frequency.select("product_id", F.col("item_count").alias("n"))
    known = orders.select(F.col("order_id").alias("__order"), F.lit(True).alias("__known"))
    orphans = F.when(F.col("__known").isNull(), F.col("raw_lines"))
    return (
        facts.join(known, F.col("order_id") == F.col("__order"), "left")
        .agg(
            _zero_if_null(F.sum("raw_lines")).alias("total_lines"),
            _zero_if_null(F.sum("c_raw")).alias("distinct_pairs"),
            _zero_if_null(F.sum(F.col("raw_lines") - F.col("c_raw"))).alias("duplicate_pairs"),
            _zero_if_null(F.sum("null_key_lines")).alias("null_keys"),
            _zero_if_null(F.sum("null_cells")).alias("null_cells"),
            _zero_if_null(F.sum(orphans)).alias("orphan_orders"),
        )
        .withColumn(
            "orphan_products", orphan_total(by_product, "product_id", products, "product_id")
        )
    )


OWN_KEY = 0


def _keyed_rows(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Each row once for every key as (ref, k0, k1, ..., nulls); the null cells go with the first key.

    Whole numbers stay numbers; a table with any other key has them all as text.  Keys
    of fewer columns are filled up with 0.
    """
    whole = {"byte", "short", "integer", "long"}
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    common = "long" if all(kinds[c] in whole for key in keys for c in key) else "string"
    width = max(len(key) for key in keys)

    def row(ref: int, key: Sequence[str]) -> Column:
        cells = [F.col(f"`{c}`").cast(common) for c in key] + [F.lit(0).cast(common)] * (width - len(key))
        nulls = null_cells(df.columns) if ref == OWN_KEY else F.lit(0)
        return F.struct(
            F.lit(ref).alias("ref"), *[c.alias(f"k{i}") for i, c in enumerate(cells)], nulls.cast("long").alias("nulls")
        )

    return df.select(F.inline(F.array(*[row(ref, key) for ref, key in enumerate(keys)])))


def audit_facts(
    df: DataFrame, key: Sequence[str], parents: Sequence[tuple[str, DataFrame, str]] = ()
) -> DataFrame:
    """One row: total_rows, null_count, duplicates of the key, and orphans, an array with one number a reference.

    The table is read once.  Its own key and all its references are unpivoted to
    (reference, key) and counted in one aggregation, which shrinks hot keys within each
    task; the counts then meet the keys of all parents in one join.
    """
    counts = _keyed_rows(df, [key, *[[column] for column, _, _ in parents]])
    names = [c for c in counts.columns if c != "nulls"]
    counts = counts.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.sum("nulls").alias("nulls"))
    orphans: list[Column] = []
    if parents:
        kind = counts.schema["k0"].dataType
        filled = [F.lit(0).cast(kind).alias(c) for c in names[2:]]
        known = reduce(
            DataFrame.unionByName,
            [
                parent.select(F.lit(ref).alias("ref"), F.col(parent_key).cast(kind).alias("k0"), *filled).distinct()
                for ref, (_, parent, parent_key) in enumerate(parents, 1)
            ],
        ).withColumn("known", F.lit(True))
        # by all columns of the aggregation, so the counts stay where they are
        counts = counts.join(known, names, "left")
        lost = F.col("known").isNull()
        orphans = [
            _zero_if_null(F.sum(F.when((F.col("ref") == ref) & lost, F.col("n")))) for ref in range(1, len(parents) + 1)
        ]
    own = F.col("ref") == OWN_KEY
    return counts.agg(
        _zero_if_null(F.sum(F.when(own, F.col("n")))).alias("total_rows"),
        _zero_if_null(F.sum("nulls")).alias("null_count"),
        _zero_if_null(F.sum(F.when(own, F.col("n") - 1))).alias("duplicates"),
        (F.array(*orphans) if orphans else F.array().cast("array<long>")).alias("orphans"),
    )


def audit_table(
    df: DataFrame,
    table_name: str,
    key: Sequence[str],
    parents: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """One report row: rows, columns, key, nulls, null rate, duplicates, references valid.

    A reference is valid when no key is left without a parent.
    """
    width = len(df.columns)
    return audit_facts(df, key, parents).select(
        F.lit(table_name).alias("table_name"),
        "total_rows",
        F.lit(width).cast("long").alias("total_cols"),
        F.lit(", ".join(key)).alias("primary_key"),
        "null_count",
        F.coalesce(
            percent_text(F.col("null_count"), F.col("total_rows") * width), F.lit("0.00%")
        ).alias("null_rate"),
        "duplicates",
        F.forall("orphans", lambda n: n == 0).alias("foreign_key_valid"),
    )


def audit_from_integrity(integrity: DataFrame, table_name: str, width: int) -> DataFrame:
    """The report row of the line table from its integrity report, without another scan."""
    return integrity.select(
        F.lit(table_name).alias("table_name"),
        F.col("total_lines").alias("total_rows"),
        F.lit(width).cast("long").alias("total_cols"),
        F.lit("order_id, product_id").alias("primary_key"),
        F.col("null_cells").alias("null_count"),
        F.coalesce(
            percent_text(F.col("null_cells"), F.col("total_lines") * width), F.lit("0.00%")
        ).alias("null_rate"),
        F.col("duplicate_pairs").alias("duplicates"),
        ((F.col("orphan_products") == 0) & (F.col("orphan_orders") == 0)).alias(
            "foreign_key_valid"
        ),
    )


def stack(sections: Sequence[DataFrame]) -> DataFrame:
    """Report sections below one another, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), sections)
