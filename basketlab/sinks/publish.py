"""Result sinks.

Tables are written by the tasks that hold them; only one-row report documents are
assembled from sections of fixed size.  Every table is replaced by a new version that
becomes the current one in a single step (see ``versions``), so a job that dies while
writing leaves what was there; ``tables.read_table`` reads the current version.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketlab import versions
from basketlab.operators.mining import itemset_order, rule_order

SECTION_ROWS = 10_000


def write_table(df: DataFrame, path: str, kind: str = "parquet", if_exists: str = "replace") -> None:
    """Replace-on-write by default; ``keep`` leaves a complete table that is there."""
    load(df, path, if_exists, lambda: versions.write(df, path, kind))


def load(df: DataFrame, path: str, if_exists: str, write: Callable[[], versions.Version]) -> bool:
    """Write, or with ``if_exists="keep"`` leave a table that has a complete version; True when written."""
    if if_exists not in ("keep", "replace"):
        raise ValueError("if_exists is keep or replace")
    if if_exists == "keep" and versions.current(df.sparkSession, path) is not None:
        return False
    write()
    return True


def write_baskets(documents: DataFrame, path: str) -> versions.Version:
    """Basket documents, range-partitioned and sorted by order.

    Row groups then cover narrow order ranges, so a lookup by order reads one of them.
    """
    sorted_rows = documents.repartitionByRange("order_id").sortWithinPartitions("order_id")
    return versions.replace(documents.sparkSession, path, lambda folder: sorted_rows.write.parquet(folder))


def load_baskets(documents: DataFrame, path: str, if_exists: str) -> bool:
    """Write the store, or with ``if_exists="keep"`` leave a store that is there; True when written.

    A store is there when it has a manifest; files that a broken write left do not count.
    """
    return load(documents, path, if_exists, lambda: write_baskets(documents, path))


def export_baskets_json(documents: DataFrame, path: str) -> None:
    """One JSON object per line with order and items; an existing export stays."""
    write_table(documents.select("order_id", "items"), path, "json", "keep")


def write_itemsets(itemsets: DataFrame, path: str, kind: str = "parquet") -> None:
    stored = itemsets.withColumn("support", F.round("support", 6)).orderBy(*itemset_order())
    write_table(stored, path, kind)


def write_copies(df: DataFrame, paths: Sequence[str], kind: str = "parquet", order: Sequence[Column] = ()) -> None:
    """One table under every given name, computed once; the others are copied from the first."""
    spark = df.sparkSession
    first, *others = paths
    stored = versions.write(df.orderBy(*order) if order else df, first, kind)
    copy = spark.read.schema(df.schema).format(kind).load(stored.folder)
    for path in others:
        versions.write(copy.orderBy(*order) if order else copy, path, kind)


def write_rules(rules: DataFrame, paths: Sequence[str], kind: str = "parquet") -> None:
    """The rules, best first, under every given name."""
    write_copies(rules, paths, kind, rule_order())


def write_postings(rows: DataFrame, items: str, path: str) -> versions.Version:
    """Every row once for each of its ``items``, range-partitioned and sorted by ``item``.

    Files and row groups then cover narrow ranges of items and carry a Bloom filter for
    them, so a lookup by item skips all but a few, in any session and without an index
    server.  An item that many rows hold is spread over several files by the whole set.
    """
    spread = rows.withColumn("item", F.explode(F.array_distinct(items)))
    ordered = spread.repartitionByRange("item", F.xxhash64(items)).sortWithinPartitions("item")
    writer = ordered.write.option("parquet.bloom.filter.enabled#item", "true")
    return versions.replace(rows.sparkSession, path, lambda folder: writer.parquet(folder))


def rows_as_array(df: DataFrame, order: Sequence[str | Column], most: int = SECTION_ROWS) -> Column:
    """A section of at most ``most`` rows as one array of structs, as a scalar subquery.

    A section that grows with the data belongs in a table; more rows are an error.
    """
    key = F.struct(*order).alias("order")
    row = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    packed = F.array_sort(F.collect_list(F.struct(key, row)))
    rows = F.transform(packed, lambda p: p["row"])
    too_many = F.raise_error(F.lit(f"a report section has more than {most} rows")).cast(_array_type(df))
    return df.limit(most + 1).agg(F.when(F.count(F.lit(1)) <= most, rows).otherwise(too_many).alias("rows")).scalar()


def _array_type(df: DataFrame) -> T.ArrayType:
    return T.ArrayType(df.schema)


def summary_document(
    scalars: DataFrame, top_products: DataFrame, hourly: DataFrame, density: DataFrame
) -> DataFrame:
    """One row: the scalars plus best sellers, 24 hours and 168 cells as arrays."""
    return scalars.select(
        "*",
        rows_as_array(top_products, [-F.col("total_sales"), "item"]).alias("top_products"),
        rows_as_array(hourly, ["hour"]).alias("hourly_data"),
        rows_as_array(density, ["dow", "hour"]).alias("heat_data"),
    )


def report_document(
    header: Mapping[str, Column], sections: Mapping[str, tuple[DataFrame, Sequence[str]]], base: DataFrame
) -> DataFrame:
    """One nested report row from a one-row base, header fields and small sections."""
    return base.select(
        *[column.alias(name) for name, column in header.items()],
        *[rows_as_array(df, order).alias(name) for name, (df, order) in sections.items()],
    )


def patch_summary(df: DataFrame, changes: Mapping[str, Column], path: str) -> None:
    """Overwrite some fields of a stored one-row summary.

    ``path`` may be where ``df`` was read from: the version read stays until the patched
    one is in force.
    """
    unknown = [name for name in changes if name not in df.columns]
    if unknown:
        raise ValueError(f"the summary has no field {', '.join(unknown)}")
    versions.write(df.withColumns(dict(changes)), path, "json")


def append_run(metrics: DataFrame, path: str) -> None:
    """Run metrics accumulate, partitioned by run."""
    metrics.write.mode("append").partitionBy("run_id").parquet(path)
